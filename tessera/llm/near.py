"""Near-dedup: SimHash links, completed by word shingles.

Texts are linked where their SimHash fingerprints are (`simhash.roots`, the Gray-order index, at its four bits). Four bits of
64 reach nearly equal texts only, so links are completed: every two texts whose sets of 5-word shingles have a Jaccard
likeness of 0.8 or more are linked as well, and only pairs that SimHash has not joined yet are looked at.

The search for those candidates is a prefix filter, which loses no pair: with all shingles in one order, two such sets share one
among the first fifth of each. The order goes by a sketch of how often shingles occur, rare ones first, so that a common
passage makes few candidates; any order would find the same links. Pairs are confirmed on the whole sets, in three
rounds: first every text is paired, for each of its prefix shingles, with one text of another component, then with some CELL
texts; the last round takes all pairs of texts that share one and are still in different components. So a group of near copies
costs some pairs for each text and shingle, not all its pairs.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import U64, among, bloom, drop_rows, one_of_each, prepare, save, span_hashes, text_mark
from .components import components

WORDS = 5
#: Texts of a shingle that meet each other in the second round.
CELL = 32
#: The sketch: 2 ** CELLS counts, which tasks send in slices.
CELLS, SLICE = 20, 1 << 16
#: Rows of prefixes that a task sends at once.
PART = 1 << 15


def words_of(text: bytes | None) -> bytes:
    """The words of a UTF-8 text with a blank between; A-Z are lower-cased."""
    return b" ".join((text or b"").lower().split())


def node_of(flat: bytes) -> int:
    return int(np.uint64(xxhash.xxh64_intdigest(flat, 42)).view(np.int64))


def shingles(flat: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, sorted. Fewer words, or none, make one shingle."""
    codes = np.frombuffer(flat, np.uint8)
    gaps = np.flatnonzero(codes == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(codes)]))
    k = min(words, len(starts))
    return np.unique(span_hashes(codes, starts[: len(starts) - k + 1], ends[k - 1 :]))


def alike(common, a, b):
    """Whether sets of a and b members with so many in common have a Jaccard likeness of 0.8 or more."""
    return 9 * common >= 4 * (a + b)


def _flats(batch):
    """The words of each text of a batch, one text at a time; what the batch before took is given back first."""
    pa.default_memory_pool().release_unused()
    return (words_of(t.as_py()) for t in batch["text"].cast(pa.binary()))


def nodes_and_sketch(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """id, row, mark, node, fp for each row of docs (texts of the same words are one node), and the sketch of all shingles."""

    def run(batches):
        counts = np.zeros(1 << CELLS, np.int64)
        for b in batches:
            nodes, fps = [], []
            for flat in _flats(b):
                nodes.append(node_of(flat))
                fps.append(simhash.fingerprint(flat))
                np.add.at(counts, (shingles(flat) >> U64(64 - CELLS)).astype(np.int64), 1)
            none = pa.nulls(len(nodes), pa.int32()), pa.nulls(len(nodes), pa.binary())
            yield pa.RecordBatch.from_arrays([b["id"], b["row"], b["mark"], pa.array(nodes, pa.int64()), pa.array(np.array(fps, U64).view(np.int64)), *none], names=["id", "row", "mark", "node", "fp", "slice", "body"])
        counts = np.minimum(counts, 65535).astype("<u2").reshape(-1, SLICE)
        for k in np.flatnonzero(counts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pydict({"id": pa.nulls(1, pa.int64()), "row": pa.nulls(1, pa.int64()), "mark": pa.nulls(1, pa.string()), "node": pa.nulls(1, pa.int64()), "fp": pa.nulls(1, pa.int64()), "slice": pa.array([k], pa.int32()), "body": pa.array([counts[k].tobytes()], pa.binary())})

    def merge(t: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for body in t["body"]:
            total += np.frombuffer(body.as_py(), "<u2")
        return pa.table({"slice": t["slice"][:1], "body": pa.array([np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()], pa.binary())})

    source = docs.select(F.col("doc_id").cast("long").alias("id"), F.monotonically_increasing_id().alias("row"), text_mark(F.col("text")).alias("mark"), "text")
    made = save(source.mapInArrow(run, "id long, row long, mark string, node long, fp long, slice int, body binary"), "nodes")
    sketch = np.zeros(1 << CELLS, np.uint32)
    for r in made.where("slice is not null").select("slice", "body").groupBy("slice").applyInArrow(merge, "slice int, body binary").collect():
        sketch[r["slice"] * SLICE : (r["slice"] + 1) * SLICE] = np.frombuffer(r["body"], "<u4")
    return made.where("node is not null").select("id", "row", "mark", "node", "fp"), sketch


def prefixes(docs: DataFrame, shared, known=None) -> DataFrame:
    """h, node, size, left: a row for each shingle of a text's prefix, with the set's size and how many of it come from there on.

    known: only shingles that may be in this filter."""

    def rows(out):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(k)) for c, k in zip(zip(*out), (np.int64, np.int64, np.int32, np.int32), strict=True)], names=["h", "node", "size", "left"])

    def run(batches):
        counts = shared.value
        for b in batches:
            out, n_out = [], 0
            for flat in _flats(b):
                h = shingles(flat)
                n = len(h)
                h = h[np.lexsort((h, counts[(h >> U64(64 - CELLS)).astype(np.int64)]))][: n - -(-4 * n // 5) + 1]
                left = n - np.arange(len(h))
                if known is not None:
                    fit = among(known.value, h.view(np.int64))
                    h, left = h[fit], left[fit]
                out.append((h.view(np.int64), np.full(len(h), node_of(flat)), np.full(len(h), n), left))
                n_out += len(h)
                if n_out >= PART:
                    yield rows(out)
                    out, n_out = [], 0
            if out:
                yield rows(out)

    return docs.select("text").mapInArrow(run, "h long, node long, size int, left int")


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs u, v of nodes whose sets are alike."""
    wanted = docs.sparkSession.sparkContext.broadcast(bloom(pairs.select("u").unionByName(pairs.select(F.col("v").alias("u"))).distinct(), "u"))

    def sets(batches):
        for b in batches:
            for flat in _flats(b):
                if among(wanted.value, node := np.array([node_of(flat)], np.int64))[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(node), pa.array([shingles(flat).tobytes()], pa.binary())], names=["node", "body"])

    def test(batches):
        for b in batches:
            keep = []
            for x, y in zip(b["a"], b["b"], strict=True):
                x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
                keep.append(alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    made = save(docs.select("text").mapInArrow(sets, "node long, body binary").groupBy("node").agg(F.first("body").alias("body")), "sets")
    one, other = (made.select(F.col("node").alias(n), F.col("body").alias(c)) for n, c in (("u", "a"), ("v", "b")))
    return save(pairs.join(one, "u").join(other, "v").select("u", "v", "a", "b").mapInArrow(test, "u long, v long"), "links")


def simhash_links(rows: DataFrame) -> DataFrame:
    """Links u, v of each node with the smallest one of its SimHash component."""
    nodes = save(rows.select("node", "fp").distinct(), "nodes")
    roots = simhash.roots(nodes.select("fp").distinct()).select(F.col("node").alias("_f"), "root")
    of = nodes.join(roots, F.col("fp") == F.col("_f"), "left").select("node", F.coalesce("root", "fp").alias("r"))
    heads = of.groupBy("r").agg(F.min("node").alias("u"), F.max("node").alias("last")).where("u < last").select("r", "u")
    return save(of.join(heads, "r").where("node > u").select("u", F.col("node").alias("v")), "links")


def near_roots(docs: DataFrame, sketch: np.ndarray, known: DataFrame) -> DataFrame:
    """node, root for each node that isn't the smallest of its component. known: links that hold already, of each node v with the smallest one u of its component."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(sketch)
    several = save(prefixes(docs, shared).select("h", "node").groupBy("h").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("h"), "shared")
    members = save(prefixes(docs, shared, sc.broadcast(bloom(several, "h"))).distinct().join(several, "h"), "members")
    links, roots, tested = known, known.select(F.col("v").alias("node"), F.col("u").alias("root")), None
    for paired in (linear_pairs, lambda x: all_pairs(x, CELL), all_pairs):
        of = roots.withColumnRenamed("node", "_n")
        named = save(members.join(of, F.col("node") == F.col("_n"), "left").select("h", "node", "size", "left", F.coalesce("root", "node").alias("root")), "named")
        pairs = paired(named)
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = save(pairs, "pairs")
        if not pairs.isEmpty():
            links = links.unionByName(confirmed(docs, pairs))
            roots = components(links)
            tested = pairs if tested is None else tested.unionByName(pairs)
    return roots


def linear_pairs(named: DataFrame) -> DataFrame:
    """u, v: each text that has a shingle with one text of another component that has it, the smallest or the largest component's."""
    one = F.struct("root", "node", "size", "left")
    ends = named.groupBy("h").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low.root < high.root")
    both = named.join(ends, "h").withColumn("far", F.when(F.col("root") == F.col("low.root"), F.col("high")).otherwise(F.col("low")))
    fits = both.where(alike(F.least("left", "far.left"), F.col("size"), F.col("far.size")))
    return fits.select(F.least("node", "far.node").alias("u"), F.greatest("node", "far.node").alias("v")).distinct()


def all_pairs(named: DataFrame, cell: int | None = None) -> DataFrame:
    """u, v: all pairs of texts of different components that share a shingle.

    cell: only pairs within cells of about so many texts, to which a hash deals those of a shingle."""
    mixed = named.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select("h", "n")
    a = named.join(mixed, "h").withColumn("cell", F.pmod(F.xxhash64("h", "node"), F.ceil(F.col("n") / cell)) if cell else F.lit(0)).drop("n")
    b = a.select("h", "cell", *[F.col(c).alias(f"{c}2") for c in ("node", "size", "left", "root")])
    fits = a.join(b, ["h", "cell"]).where("node < node2 and root <> root2").where(alike(F.least("left", "left2"), F.col("size"), F.col("size2")))
    return fits.select(F.col("node").alias("u"), F.col("node2").alias("v")).distinct()


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of each component of near copies: that of the smallest doc_id, or of any id before a null one.

    A null text counts as an empty one; texts of no words are alike. Texts are read whole, whatever their length. Of rows that
    share id and text one stays; rows that share an id only are judged each by its text. Sets and texts of the same words are
    told by 64-bit hashes. Other columns, whatever their names, come along. No rows give no rows."""
    prepare(docs.sparkSession)
    rows, sketch = nodes_and_sketch(docs)
    roots = near_roots(docs, sketch, simhash_links(rows))
    rows = save(rows.join(roots.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("id", "row", "mark", F.coalesce("root", "node").alias("root")), "rows")
    return drop_rows(docs, one_of_each(rows, "root"), text_mark(F.col("text")))
