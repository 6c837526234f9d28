"""What the operators share: session set-up, scratch tables in the shared folder, fixed-size Bloom filters and vectorised word hashes."""

import atexit
import os
import shutil
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import save, scratch_root  # noqa: F401 (the operators import them from here)

#: White space of the contracts, as a Java pattern.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
U64 = np.uint64
#: Arrow batches that go to Python hold at most so many rows and bytes, so a batch of long texts stays small.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session, and ship this package to the executors once per application."""
    for k, v in BATCH.items():
        spark.conf.set(k, v)
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="tessera-")
    atexit.register(shutil.rmtree, folder, True)
    archive = os.path.join(folder, "tessera.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for d, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    p = os.path.join(d, name)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._tessera_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def per_partition(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# Vectorised hashes. Polynomials modulo 2**64 over an odd base, taken as differences of prefix sums and mixed at the end.

BASE = 0x9E3779B97F4A7C15 | 1
_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            x = np.full(size, b, U64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of codes[s:e] for each s, e; equal spans have equal hashes."""
    n = len(codes)
    up, down = powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((codes.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


# A Bloom filter of a fixed number of bits. It only spares work: what it lets through by chance is judged exactly afterwards.

BLOOM_BITS = 1 << 24
_SEEDS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    return [mix(keys.astype(np.int64).view(U64) ^ U64(s)) % U64(bits) for s in _SEEDS]


def bloom(df: DataFrame, key: str, bits: int = BLOOM_BITS) -> np.ndarray:
    """The filter of a long column: partitions build their bitmaps, words are or-ed; at most bits / 64 numbers reach the driver."""

    def build(batches):
        words = np.zeros(bits >> 6, U64)
        for b in batches:
            keys = b.column(0).to_numpy(zero_copy_only=False)
            for p in _places(keys, bits):
                np.bitwise_or.at(words, (p >> U64(6)).astype(np.int64), U64(1) << (p & U64(63)))
        at = np.flatnonzero(words)
        for k in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + (1 << 16)], pa.int64()), pa.array(words[at[k : k + (1 << 16)]].view(np.int64), pa.int64())], names=["at", "word"])

    got = df.select(F.col(key).cast("long").alias("k")).where("k is not null").mapInArrow(build, "at long, word long").groupBy("at").agg(F.bit_or("word").alias("word")).toArrow()
    out = np.zeros(bits >> 6, U64)
    out[got["at"].to_numpy()] = got["word"].to_numpy().view(U64)
    return out


def among(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be in the filter."""
    bits, found = len(words) << 6, np.ones(len(keys), bool)
    for p in _places(keys, bits):
        found &= (words[(p >> U64(6)).astype(np.int64)] >> (p & U64(63))) & U64(1) == U64(1)
    return found


def may_be_in(spark: SparkSession, words: np.ndarray):
    """A function of a long column: whether its value may be in the filter; null is not.

    Not for rows that go to Python anyway: each Python step of a task takes a worker of its own, and so its memory."""
    shared = spark.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def test(keys: pa.Array) -> pa.Array:
        return pa.array(keys.is_valid().to_numpy(zero_copy_only=False) & among(shared.value, keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)))

    return test


def drop_rows(docs: DataFrame, decided: DataFrame, mark, key: str = "doc_id") -> DataFrame:
    """docs without the rows that decided (key, mark, kept) drops.

    mark: the column of docs that, with the key, tells which row a decision is about; so the very rows decided on stay, also
    where one key, or null, has several texts. Only rows whose key may be among the dropped ones are joined; the others, with
    their texts, are not moved. Of rows alike in key and mark as many stay as decided keeps."""
    spark, cols = docs.sparkSession, docs.columns
    gone = decided.groupBy(F.col(key).alias("_key"), F.col("mark").alias("_mark")).agg(F.sum(F.col("kept").cast("long")).alias("_stay"), F.count(F.lit(1)).alias("_all"))
    gone = save(gone.where("_stay < _all"), "gone")
    test = may_be_in(spark, bloom(gone.select("_key").distinct(), "_key"))
    marked = docs.withColumn("_maybe", test(F.col(key).cast("long")) | F.col(key).isNull())
    rest = marked.where("_maybe").withColumn("_own", mark).join(gone, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_own") == F.col("_mark")), "left")
    some = rest.where("_stay > 0").withColumn("_nth", F.expr(f"row_number() over (partition by `{key}`, _own order by text)")).where("_nth <= _stay")
    return marked.where("not _maybe").select(*cols).unionByName(rest.where("_stay is null").select(*cols)).unionByName(some.select(*cols))


def one_of_each(rows: DataFrame, group: str) -> DataFrame:
    """The decisions that keep one row of each group: rows has id, mark, row and the group. The smallest id stays, any before null."""
    order = F.struct(F.col("id").isNull(), "id", "mark", "row")
    groups = rows.groupBy(F.col(group).alias("_group")).agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(groups, F.col(group) == F.col("_group")).select(F.col("id").alias("doc_id"), "mark", (F.col("row") == F.col("first.row")).alias("kept"))


def text_mark(text):
    """What tells the rows of one id apart: a digest of the text; null counts as an empty one."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)
