"""Exact dedup by an extendible-hash index on shared files.

1. A narrow pass takes a 64-bit key and the SHA-256 of each normalised text; texts are not moved. Each task merges what it has
   of a (key, SHA-256) to one entry: rows and smallest id.
2. Owner tasks each take a range of keys, so that the directory's upper part is the ranges and no task, nor the driver, holds
   the whole. An owner merges the entries of its range into buckets by directory doubling: from one bucket for the range on, a
   bucket over capacity splits on one more bit of the key (a bucket whose entries share a key can't split; they chain). Each
   bucket is a row of the index's files. `add` gives owners the buckets that they have and another batch's entries.
3. Of keys with several rows the owner gets the texts too, copies merged by the tasks that send them. It goes through its
   buckets, finds a text's entry in the chain of its key, and compares the text's bytes with those that the entry stands for.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOOM_BITS, SPACES, among, bloom, drop_rows, per_partition, prepare, save

#: Entries of a bucket, and bytes of texts that a task holds before it sends what it has merged.
BUCKET_CAPACITY, HELD = 8192, 8 << 20
_ENTRY = pa.schema([("key", pa.int64()), ("sha", pa.binary()), ("id", pa.int64()), ("n", pa.int64())])
INDEX = "owner int, depth int, prefix long, entries int, body binary"


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def owner_bits(df: DataFrame) -> int:
    """Owners are ranges of keys with the same so many leading bits; there are about as many as shuffle partitions."""
    return max(0, (per_partition(df) - 1).bit_length())


def owner_of(key, bits: int):
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def merged(t: pa.Table) -> pa.Table:
    """One entry of each (key, SHA-256): the smallest id, any before null, and all rows."""
    return t.group_by(["key", "sha"]).aggregate([("id", "min"), ("n", "sum")]).select(["key", "sha", "id_min", "n_sum"]).rename_columns(_ENTRY.names)


def merge_entries(batches):
    """A task's rows, some 2**18 at a time, as entries."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= 1 << 18:
            held = merged(pa.Table.from_batches(held)).to_batches()
            yield from held
            held, n = [], 0
    if n:
        yield from merged(pa.Table.from_batches(held)).to_batches()


def double(keys: np.ndarray, capacity: int, bits: int = 0) -> list[tuple[int, int, int]]:
    """Buckets (local depth, start, end) over sorted unsigned keys that share their first `bits` bits."""
    done, todo = [], [(bits, 0, len(keys))]
    while todo:
        d, s, e = todo.pop()
        if e - s > capacity and d < 64 and keys[s] != keys[e - 1]:
            half = (int(keys[s]) >> (64 - d) << 1 | 1) << (63 - d) if d else 1 << 63
            m = s + int(np.searchsorted(keys[s:e], np.uint64(half)))
            todo += [(d + 1, m, e), (d + 1, s, m)]
        else:
            done.append((d, s, e))
    return done


def pack_bucket(t: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, _ENTRY) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


def unpack_bucket(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def build(entries: DataFrame, capacity: int, bits: int) -> DataFrame:
    """The index of entries (key, sha, id, n; of one key and SHA-256 there may be several): a row for each bucket."""

    def own(batches):
        at, held = None, []

        def out():
            t = merged(pa.Table.from_batches(held).select(_ENTRY.names)).cast(_ENTRY)
            keys = t["key"].to_numpy().view(np.uint64)
            order = np.argsort(keys, kind="stable")
            t, keys = t.take(pa.array(order)), keys[order]
            for d, s, e in double(keys, capacity, bits):
                if e > s:
                    prefix = int(keys[s]) >> (64 - d) if d else 0
                    yield pa.RecordBatch.from_pydict({"owner": pa.array([at], pa.int32()), "depth": pa.array([d], pa.int32()), "prefix": pa.array([prefix - (1 << 64) if prefix >> 63 else prefix], pa.int64()), "entries": pa.array([e - s], pa.int32()), "body": pa.array([pack_bucket(t.slice(s, e - s))], pa.binary())})

        for b in batches:
            owners = b["owner"].to_numpy()
            cuts = [0, *(np.flatnonzero(owners[1:] != owners[:-1]) + 1).tolist(), len(owners)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if e > s:
                    if held and owners[s] != at:
                        yield from out()
                        held = []
                    at = int(owners[s])
                    held.append(b.slice(s, e - s))
        if held:
            yield from out()

    dealt = entries.select(owner_of(F.col("key"), bits).alias("owner"), *_ENTRY.names).repartitionById(1 << bits, F.col("owner")).sortWithinPartitions("owner")
    return dealt.mapInArrow(own, INDEX)


def entries_of(index: DataFrame, least: int = 1) -> DataFrame:
    """The entries of an index's buckets that stand for so many rows or more: key, sha, id, n."""

    def run(batches):
        for b in batches:
            for body in b["body"]:
                t = unpack_bucket(body.as_py())
                yield from t.filter(pc.greater_equal(t["n"], least)).to_batches()

    return index.select("body").mapInArrow(run, "key long, sha binary, id long, n long")


def add(index: DataFrame | None, rows: DataFrame, capacity: int, bits: int, name: str = "index") -> DataFrame:
    """The index with the rows (key, sha, id) of another batch, written to the shared folder."""
    new = rows.select("key", "sha", "id", F.lit(1).cast("long").alias("n")).mapInArrow(merge_entries, "key long, sha binary, id long, n long")
    return save(build(new if index is None else new.unionByName(entries_of(index)), capacity, bits), name)


def merge_copies(batches, words: np.ndarray):
    """A task's texts whose key may be in a filter, with a row for each text that it holds at a time: key, text, rows."""
    held: dict[tuple[int, str], int] = {}
    size = 0

    def out():
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in held], pa.int64()), pa.array([t for _, t in held], pa.string()), pa.array(held.values(), pa.int64())], names=["key", "text", "n"])

    for b in batches:
        b = b.filter(pa.array(among(words, b["key"].to_numpy())))
        for x in zip(b["key"].to_pylist(), b["text"].to_pylist(), strict=True):
            if x not in held:
                size += len(x[1])
                held[x] = 0
            held[x] += 1
            if size > HELD:
                yield out()
                held, size = {}, 0
    if held:
        yield out()


def compare(batches):
    """The owner: its range's entries and texts, sorted by key, entries first. Entries of a key are a chain.

    A text's entry is that of its SHA-256; its bytes are compared with those of the entry's first text. Each entry must get
    as many rows as it stands for."""
    at, chain = None, {}

    def out():
        if any(got != n for _, n, _, got in chain.values()):
            raise ValueError(f"the index does not hold the rows of key {at}")
        rows = [(at, sha, i, n) for sha, (i, n, _, _) in chain.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["key", "sha", "keep_id", "group_size"])

    for b in batches:
        for key, sha, i, n, text in zip(b["key"].to_pylist(), b["sha"].to_pylist(), b["id"].to_pylist(), b["n"].to_pylist(), b["text"].cast(pa.binary()).to_pylist(), strict=True):
            if key != at:
                if chain:
                    yield out()
                at, chain = key, {}
            if text is None:
                chain[sha] = [i, n, None, 0]
                continue
            entry = chain.get(hashlib.sha256(text).digest())
            if entry is None or entry[2] not in (None, text):
                raise ValueError(f"the index does not hold a text of key {key}, or two texts share their SHA-256")
            entry[2] = text
            entry[3] += n
    if chain:
        yield out()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_CAPACITY, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """A row for each row of docs: id_col, keep_id, group_size, kept, text_sha256.

    Null counts as an empty text, which equals one of no characters; a text of white space only is one space. Of equal
    texts the smallest id stays; a null id stays only where no other has that text (keep_id is null then). Of rows that
    share text and id one stays; rows that share an id only are judged each by its text. Texts are compared whole, whatever
    their length. No rows give no rows. Other columns of docs, whatever their names, are ignored."""
    prepare(docs.sparkSession)
    bits = owner_bits(docs)
    source = docs.select(F.col(id_col).cast("long").alias("id"), normalised(F.col(text_col)).alias("text"))
    rows = save(source.select("id", F.monotonically_increasing_id().alias("row"), F.xxhash64("text").alias("key"), F.unhex(F.sha2("text", 256)).alias("sha")), "rows")
    index = add(None, rows, capacity, bits)

    # Keys with several rows, and the entries of these keys: those that stand for one row chain with the others.
    several = save(entries_of(index, 2).select(F.col("key").alias("k")).distinct(), "several")
    words = docs.sparkSession.sparkContext.broadcast(bloom(several, "k", bloom_bits))
    texts = source.select(F.xxhash64("text").alias("key"), "text").mapInArrow(lambda batches: merge_copies(batches, words.value), "key long, text string, n long")
    texts = texts.join(several, F.col("key") == F.col("k")).select("key", F.lit(None).cast("binary").alias("sha"), F.lit(None).cast("long").alias("id"), "n", "text")
    own = entries_of(index).join(several, F.col("key") == F.col("k")).select("key", "sha", "id", "n", F.lit(None).cast("string").alias("text"))
    owned = own.unionByName(texts).withColumn("owner", owner_of(F.col("key"), bits)).repartitionById(1 << bits, F.col("owner")).sortWithinPartitions("owner", "key", F.col("text").isNotNull())
    classes = owned.select("key", "sha", "id", "n", "text").mapInArrow(compare, "key long, sha binary, keep_id long, group_size long").where("group_size > 1")
    classes = save(classes.select(F.col("key").alias("k"), F.col("sha").alias("s"), "keep_id", "group_size"), "classes")

    twins = rows.groupBy("id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("twins")).where("twins > 1 or id is null")
    twins = rows.join(twins.select(F.col("id").alias("i")), F.col("id").eqNullSafe(F.col("i")), "left_semi").groupBy("id", "sha").agg(F.min("row").alias("first"))
    twins = twins.select(F.col("id").alias("i"), F.col("sha").alias("s2"), "first")
    joined = rows.join(classes, (F.col("key") == F.col("k")) & (F.col("sha") == F.col("s")), "left").join(twins, F.col("id").eqNullSafe(F.col("i")) & (F.col("sha") == F.col("s2")), "left")
    keep = F.when(F.col("k").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("id").eqNullSafe(keep) & (F.col("first").isNull() | (F.col("first") == F.col("row")))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """docs without the rows that exact_dedup drops; cases as there. The rows that stay keep all their columns."""
    return drop_rows(docs, exact_dedup(docs).select("doc_id", F.col("text_sha256").alias("mark"), "kept"), F.sha2(normalised(F.col("text")), 256))


ORACLE = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as x from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, sha256(x) as text_sha256
from t window w as (partition by x)
"""
