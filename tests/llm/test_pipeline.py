"""The pipeline's stages on a small table of hard cases, and on no rows at all."""

import re
from collections import Counter

import corpus_pipeline

from .helpers import SCHEMA, frame, rows_of, table


def test_pipeline_on_hard_cases(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows and clashing names: each stage keeps what it should."""
    rows = [*table(), (None,) * 12, (None, "a text of its own", None, None, None, None, None, None, None, None, None, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    before, columns, held = docs, docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        before = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = before
        assert name == "packing" or before.columns == columns
    texts = {k: Counter(r["text"] or "" for r in rows_of(v)) for k, v in held.items() if k != "packing"}
    plain = {k: re.sub(r"[\x20\x09-\x0D]+", " ", k) for k in texts["language ID"]}
    assert set(texts["language ID"]) <= {r[1] or "" for r in rows}
    assert {plain[t] for t in texts["exact dedup"]} == set(plain.values()) and sum(texts["exact dedup"].values()) == len(set(plain.values()))
    assert not texts["near-dedup"] - texts["exact dedup"] and 1 < sum(texts["near-dedup"].values()) < sum(texts["exact dedup"].values())
    assert all(n <= 3 * texts["near-dedup"][t] for t, n in texts["mixing"].items())
    packed = rows_of(held["packing"])
    assert sum(r["piece"] == 0 for r in packed) == sum(texts["mixing"].values())
    by = {}
    for r in packed:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in by.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048


def test_pipeline_on_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(corpus_pipeline.run(spark, str(tmp_path))) == []
