import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera import schemas
from tessera.config import Config, expand, merge
from tessera.functions import identity, numbers, text, vectors
from tessera.plans.catalogue import QUERIES


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


def content(data):
    return hashlib.sha256(json.dumps(data, sort_keys=True, ensure_ascii=False).encode()).hexdigest()


def test_rounding_is_the_language_s(spark):
    r = random.Random(1)
    xs = [0.0, 0.125, 0.375, 2.675, 1.005, 12.345, 0.005, 0.015, 1e6 + 0.125, 5.0, 3.14159, *(round(r.random() * 5000, 3) for _ in range(3000)), *(k / 1000 + 0.005 for k in range(0, 3000, 10))]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", numbers.json_number(numbers.round_half_even_2(F.col("x"))).alias("t"))
    for row in df.collect():
        assert row.t == repr(round(row.x, 2)), row.x


def test_utterance_ids(spark):
    rows = [("EP é", 0, 'He said "no"\\ \n\t\x01 é', "A", 0.0, 1.5), ("EP", 12, "x", "B\x7f", 2.675, 1234567.891), ("", 999999, "", "", 0.125, 0.375)]
    df = spark.createDataFrame(rows, "e string, p int, t string, s string, a double, b double")
    got = df.select(identity.utterance_id(*(F.col(c) for c in "eptsab")).alias("i")).collect()
    for (e, p, t, s, a, b), g in zip(rows, got, strict=True):
        want = f"utt_{hashlib.sha256(e.encode()).hexdigest()[:12]}_{p:06d}_{content({'text': t, 'speaker': s, 'start': round(a, 2), 'end': round(b, 2)})[:8]}"
        assert g.i == want
    assert one(spark, identity.time_text(F.lit("5"), F.lit(5.0))) == "5" and one(spark, identity.time_text(F.lit("5.0"), F.lit(5.0))) == "5.0"


def test_parent_ids(spark):
    ids, body = ["b", "a"], "text"
    key = hashlib.sha256(body.encode()).hexdigest()[:16]
    e = hashlib.sha256(b"E").hexdigest()[:12]
    arr = F.array(F.lit("b"), F.lit("a"))
    assert one(spark, identity.span_id(F.lit("E"), F.lit(3), F.lit("S"), arr, F.lit(body))) == f"spn_{e}_000003_{content({'speaker': 'S', 'utterance_ids': sorted(ids), 'text_hash': key})[:8]}"
    assert one(spark, identity.beat_id(F.lit("E"), F.lit(0), arr, F.lit(body))) == f"bet_{e}_000000_{content({'span_ids': sorted(ids), 'text_hash': key})[:8]}"
    assert one(spark, identity.section_id(F.lit("E"), F.lit(0), arr, F.lit(body))) == f"sec_{e}_000000_{content({'beat_ids': sorted(ids), 'text_hash': key})[:8]}"
    made = one(spark, identity.valid_id(identity.beat_id(F.lit("E"), F.lit(0), arr, F.lit(body)), "beat"))
    assert made is True and one(spark, identity.valid_id(F.lit("bet_1_2_3"), "beat")) is False and one(spark, identity.valid_id(F.lit(None).cast("string"), "beat")) is False
    with pytest.raises(ValueError, match="algorithm"):
        identity.content_hash(F.lit("x"), "crc")


def test_text(spark):
    assert one(spark, text.normalise(F.lit("  A  b\n C "))) == "a b c"
    assert one(spark, text.tokens(F.lit(" a b  c "))) == ["a", "b", "c"]
    assert one(spark, text.clean_words(F.lit("Hello, (world)! 12 -x- ''"), text.STRIP_TERMS)) == ["hello", "world", "x"]
    assert one(spark, text.likeness(F.lit("the cat sat"), F.lit("the dog sat"))) == pytest.approx(1 / 3)
    assert one(spark, text.likeness(F.lit("cat sat"), F.lit("dog sat"), "overlap")) == 0.5
    assert one(spark, text.likeness(F.lit(""), F.lit("x"))) == 0.0
    with pytest.raises(ValueError, match="likeness"):
        text.likeness(F.lit("a"), F.lit("b"), "cosine")
    assert one(spark, text.excerpt(F.lit('a  "b" ' + "c" * 50), 20)) == 'a ""b"" ' + "c" * 11 + "..."
    assert one(spark, text.title_of(F.lit("S - #1 - 2020-01-02 - A - B"))) == "A - B" and one(spark, text.title_of(F.lit("S - x"))) == "S - x"
    assert one(spark, text.date_of(F.lit("S - #1 - 2020-01-02 - A"))) == "2020-01-02" and one(spark, text.date_of(F.lit("S - #1 - soon - A"))) is None and one(spark, text.date_of(F.lit("S"))) is None
    assert len(set(text.STOP_TERMS)) > len(set(text.STOP_THEMES)) > len(set(text.STOP_LIKENESS))


def test_texts_are_cut_into_words_once_for_both_measures(spark, monkeypatch, tmp_path):
    """lexical_similarity makes each text's word set once, before the join, and repeats, nulls and empty texts count as before."""
    texts = ["The cat, the CAT sat; a dog " * 3, "cat sat  \u00a0mat", None, "", "\u00a0 -- 12"]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)] + [(k + 20, t, "en", "s") for k, t in enumerate(texts[1:] + texts[:1])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["lexical_similarity"](spark, str(tmp_path))
    words = lambda t: {w for x in (t or "").lower().split() if len(w := x.strip(text.STRIP_THEMES)) >= 2 and x not in text.STOP_LIKENESS and any(c.isalpha() for c in x)}
    want = {k: (words(a), words(b)) for k, (a, b) in enumerate(zip(texts, texts[1:] + texts[:1], strict=True))}
    got = {r.id_a: (r.jaccard, r.dice) for r in df.collect()}
    assert got == {k: (round(len(a & b) / len(a | b), 9), round(2 * len(a & b) / (len(a) + len(b)), 9)) if a and b else (0, 0) for k, (a, b) in want.items()}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "split(" not in plan and "Join" in plan


def test_vectors(spark):
    a, b = F.array(*map(F.lit, (3.0, 4.0))), F.array(*map(F.lit, (4.0, -3.0)))
    assert one(spark, vectors.norm(a)) == 5 and one(spark, vectors.dot(a, b)) == 0
    assert one(spark, vectors.cosine(a, a)) == pytest.approx(1) and one(spark, vectors.cosine(a, F.array(F.lit(1.0)))) is None
    minus = F.array(*map(F.lit, (-3.0, -4.0)))
    assert one(spark, vectors.cosine(a, minus)) == pytest.approx(-1) and one(spark, vectors.cosine(a, minus, clamp=True)) == 0
    assert math.hypot(*one(spark, vectors.unit(a))) == pytest.approx(1, abs=1e-6)
    assert one(spark, numbers.missing(F.lit(float("nan")))) is True and one(spark, numbers.missing(F.lit(1.0))) is False


def test_schemas(spark):
    assert schemas.required_fields("beat") == [f for f in schemas.field_names("beat") if f != "topic_label"]
    assert schemas.missing_and_extra(["utterance_id", "zz"], "utterance")[1] == ["zz"]
    with pytest.raises(ValueError, match="unknown"):
        schemas.get_schema("nope")
    with pytest.raises(ValueError, match="lacks"):
        schemas.conform(spark.range(1), "utterance")
    assert schemas.field_types("span")["utterance_ids"] == "array<string>"


def test_config(tmp_path, monkeypatch):
    (tmp_path / "aggregation_config.yaml").write_text("spans: {min_duration: 2}\nextra: 1\n")
    c = Config(str(tmp_path))
    assert c.get("aggregation", "spans", "min_duration") == 2 and c.get("aggregation", "spans", "max_silence_gap") == 0.5
    assert c.get("aggregation", "no", "such", default=7) == 7
    monkeypatch.setenv("EMBEDDING_API_KEY", "k")
    assert c.get("embedding", "remote", "api_key") == "k"
    assert merge({"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}}
    monkeypatch.setenv("HERE", "x")
    assert expand({"p": ["${HERE}/${GONE:-y}"]}) == {"p": ["x/y"]}
    with pytest.raises(ValueError, match="unknown"):
        c.section("nope")
