"""Lempel-Ziv phrase fingerprints.

LZ78 parses a text into dictionary phrases, each the longest known phrase and one character more. The phrases' hashes are
spread over BINS bins, whose least values are the minimum-hash signature; the share of agreeing bins estimates the
likeness (Jaccard) of two phrase sets, as texts that compress together have phrases in common.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, per_partition, prepare, span_hashes

#: Bins of a signature, each a value of 16 bits (0: no phrase falls into it).
BINS = 128


def parse(phrases: set[str], start: str, text: str) -> str:
    """Adds the phrases of text to the dictionary, going on from the open phrase start; returns the phrase that is open at the end."""
    add, w = phrases.add, start
    for c in text:
        w += c
        if w not in phrases:
            add(w)
            w = ""
    return w


def signature(phrases: set[str]) -> np.ndarray:
    out = np.zeros(BINS, np.uint16)
    if phrases:
        every = list(phrases)
        codes = np.frombuffer("".join(every).encode("utf-32-le", "surrogatepass"), "<u4")
        ends = np.cumsum(np.fromiter(map(len, every), np.int64, len(every)))
        h = span_hashes(codes, np.concatenate(([0], ends[:-1])), ends)
        least = np.full(BINS, 1 << 16, np.int64)
        np.minimum.at(least, (h >> U64(57)).astype(np.int64), ((h >> U64(20)) % U64(65535)).astype(np.int64) + 1)
        out[least <= 65535] = least[least <= 65535]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard likeness of two phrase sets; two empty ones are alike."""
    used = (a > 0) | (b > 0)
    return float(np.mean(a[used] == b[used])) if used.any() else 1.0


def fingerprint(text: str) -> np.ndarray:
    phrases: set[str] = set()
    parse(phrases, "", text)
    return signature(phrases)


def with_edited(text: str, following: str) -> tuple[np.ndarray, np.ndarray, str]:
    """Fingerprints of a text and of its edited text, and that text. What both start with is parsed once."""
    n = len(text) // 2
    first, second, put = text[: len(text) - n], text[len(text) - n :], following[:n]
    phrases: set[str] = set()
    open_ = parse(phrases, "", first)
    other = phrases.copy()
    parse(phrases, open_, second)
    parse(other, open_, put)
    return signature(phrases), signature(other), first + put


def lz_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (4 hex digits for each bin) of each row of docs. Null texts count as empty; their bins are all 0."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array([fingerprint(t or "").astype(">u2").tobytes().hex() for t in b["text"].to_pylist()], pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def neighbour_likeness(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """A row for each row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one of the next smaller (doc_id, text), after the last the first; null ids are the smallest,
    and a sole document is its own next. Texts move once, to ranges of doc_id; the document that the least one of a range
    needs comes along as a second row. Null texts count as empty. No rows give no rows."""
    prepare(docs.sparkSession)
    least = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    parts = parts or per_partition(docs)
    bounds = rows.agg(F.percentile_approx("key", [k / parts for k in range(1, parts)], max(10000, 20 * parts))).first()[0] if parts > 1 else None
    bounds = sorted(set(bounds or []))
    own = sum(((F.col("key") > b).cast("int") for b in bounds), F.lit(0)) if len(bounds) <= 8 else F.expr(f"aggregate(array({','.join(f'{b}L' if b != least else 'cast(-9223372036854775808 as long)' for b in bounds)}), 0, (n, b) -> n + cast(key > b as int))")
    ranges = rows.select("key").withColumn("part", own).groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("part").collect()
    # A row for each range: the greatest key of the range below goes there too, and the greatest of all to the lowest range.
    also = {int(ranges[k - 1].high): int(ranges[k].part) for k in range(1, len(ranges))}
    wrap = (int(ranges[-1].high), int(ranges[0].part)) if ranges else (0, 0)
    halo = [F.when(F.col("key") == wrap[0], F.struct(F.lit(wrap[1]).alias("part"), F.lit(1).alias("kind")))]
    if also:
        part_of = F.element_at(F.create_map(*[F.lit(x) for pair in also.items() for x in pair]), F.col("key"))
        halo.append(F.when(F.col("key").isin(list(also)), F.struct(part_of.alias("part"), F.lit(1).alias("kind"))))
    placed = F.array_compact(F.array(F.struct(own.alias("part"), F.lit(0).alias("kind")), *halo))
    # Kind 1 comes after the range's own documents: the first such row is what the least of them is followed by.
    dealt = rows.select("key", "text", F.explode(placed).alias("p")).select(F.col("p.part").cast("int").alias("part"), F.col("p.kind").alias("kind"), "key", "text")
    dealt = dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions("part", "kind", F.desc("key"), F.desc("text"))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def judge(key, text, following):
        own, edited, put = with_edited(text, following)
        texts = (hashlib.sha256(put.encode("utf-8", "surrogatepass")).hexdigest(), *(x.astype(">u2").tobytes().hex() for x in (own, edited)))
        return (None if key == least else key, len(text), *texts, round(likeness(own, edited), 6)), own

    def run(batches):
        held = waits = None  # a document without its next one yet; the one before it, judged but for the likeness to held
        out: list = []
        for b in batches:
            for kind, key, text in zip(*(b[k].to_pylist() for k in ("kind", "key", "text")), strict=True):
                if held is not None:
                    row, own = judge(*held, text)
                    if waits is not None:
                        out.append((*waits[0], round(likeness(waits[1], own), 6)))
                    waits = (row, own)
                    if kind:
                        out.append((*row, round(likeness(own, fingerprint(text)), 6)))
                        waits = None
                held = None if kind else (key, text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)], names=names)
                out = []

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
