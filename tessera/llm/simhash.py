"""SimHash near-dedup by a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, several times. The 64 bits are cut into groups, more than the bits that may
differ; each order leads with other groups, so that two fingerprints to be linked agree on the leading bits of one order at
least. Those that share the leading bits of an order are an upper node of the index, and only they are compared: the work
grows with the size of upper nodes, not with pairs of all blocks. Below, groups of FAN ** k neighbours form the nodes of
level k; a node keeps the bits that all its fingerprints share (a mask and a pattern). Two nodes whose shared patterns differ
in more bits than allowed can hold no link, so the pair is pruned with all below it; the differences grow from level to
level, as masks do. A pair of nodes whose fingerprints are all in one component already is pruned too, so that a large group
of near copies costs little more than its size.

An upper node that crosses the border of two tasks, or fills several, goes on as blocks that are compared in pairs, each pair
a task's work of bounded size. Tasks return spanning forests of the links that they find (never all pairs of a group), and
alternating star rounds join the forests to components.
"""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, per_partition, prepare, save
from .components import components

WORDS, BITS, FAN = 4, 4, 8
#: Fingerprints of a block, and rows of an order that a task sorts.
BLOCK, TASK_ROWS = 1 << 16, 1 << 20
#: Upper nodes hold some so many fingerprints; with more fingerprints in all, more bits lead.
NODE = 1 << 12
_CHUNK = 1 << 17


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the shingles of a UTF-8 text; A-Z are lower-cased. No words: 0."""
    ws = text.lower().split()
    if not ws:
        return 0
    flat = b" ".join(ws)
    if len(ws) <= words:
        return xxhash.xxh64_intdigest(flat, 42)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: 1 - words].tolist()
    ends, of = ends[words - 1 :].tolist(), xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for k in range(0, len(ends), 1 << 15):
        h = np.array([of(flat[s:e], 42) for s, e in zip(starts[k : k + (1 << 15)], ends[k : k + (1 << 15)], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, fp (the 64 bits as a long)."""

    def run(batches):
        for b in batches:
            got = np.array([fingerprint(t.as_py() or b"", words) for t in b["text"].cast(pa.binary())], U64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(got.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the reflected Gray sequence: a prefix xor over its bits."""
    for k in (1, 2, 4, 8, 16, 32):
        codes = codes ^ (codes >> U64(k))
    return codes


def orders(n: int, bits: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each order the groups of bits (shift, width), the leading ones first, and the mask of the leading ones.

    Codes that differ in `bits` bits agree on all but `bits` groups: with g groups those that agree are among the choices of
    g - bits. More groups make more orders and longer leading parts; n codes get as few as keep upper nodes near NODE."""
    for groups in range(bits + 1, 65):
        ends = [64 * k // groups for k in range(groups + 1)]
        every = [(s, e - s) for s, e in zip(ends, ends[1:], strict=False)]
        if n >> sum(w for _, w in every[: groups - bits]) <= NODE or groups >= bits + 3:
            break
    out = []
    for lead in itertools.combinations(every, groups - bits):
        out.append(([*lead, *(x for x in every if x not in lead)], sum(((1 << w) - 1) << s for s, w in lead)))
    return out


def in_order(codes: np.ndarray, groups: list[tuple[int, int]]) -> np.ndarray:
    """The codes with their groups of bits rearranged, the first one leading."""
    out = np.zeros(len(codes), U64)
    for s, w in groups:
        out = (out << U64(w)) | ((codes >> U64(s)) & U64((1 << w) - 1))
    return out


def levels(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Shared patterns and masks of nodes, from the leaves (single codes, full masks) up to one node."""
    ones, zeros = codes, ~codes
    out = [(codes, np.full(len(codes), ~U64(0), U64))]
    while len(ones) > 1:
        at = np.arange(0, len(ones), FAN)
        ones, zeros = np.bitwise_and.reduceat(ones, at), np.bitwise_and.reduceat(zeros, at)
        out.append((ones, ones | zeros))
    return out


def labels(up: np.ndarray, depth: int) -> list[np.ndarray]:
    """For the nodes of each level the component that all their leaves are in, or -1."""
    low = high = up
    out = [up]
    for _ in range(depth - 1):
        at = np.arange(0, len(low), FAN)
        low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
        out.append(np.where(low == high, low, -1))
    return out


def forest_of(first: np.ndarray, second: np.ndarray | None, lead: int, bits: int) -> np.ndarray:
    """A spanning forest of the links between two sorted arrays of codes, or within the first alone: rows of two linked codes."""
    codes, _, found = linked(first, second, lead, bits)
    return codes[np.array(found, np.int64).reshape(-1, 2)]


def stars_of(first: np.ndarray, second: np.ndarray | None, lead: int, bits: int) -> np.ndarray:
    """The components of those links as stars, which later rounds join sooner: rows of a code and the first one of its component."""
    codes, forest, _ = linked(first, second, lead, bits)
    forest.flatten()
    some = np.flatnonzero(forest.up != np.arange(len(codes)))
    return codes[np.stack([some, forest.up[some]], axis=1)]


def linked(first: np.ndarray, second: np.ndarray | None, lead: int, bits: int) -> tuple[np.ndarray, "Forest", list[tuple[int, int]]]:
    """The codes of both arrays, their forest, and the links, as places of codes, that joined two trees of it.

    Only codes that agree on the bits of lead are linked. One chunk of node pairs is followed down at a time."""
    same, lead = second is None, U64(lead)
    a = levels(first)
    b = a if same else levels(second)
    codes, shift = (first, 0) if same else (np.concatenate([first, second]), len(first))
    forest, found = Forest(len(codes)), []
    known = [labels(forest.up[: len(first)], len(a)), labels(forest.up[shift:], len(b))]

    def apart(k, i, j):
        x, y = known[0][min(k, len(a) - 1)][i], known[1][min(k, len(b) - 1)][j]
        return (x != y) | (x < 0)

    def surviving(k, i, j):
        (pa_, ma), (pb, mb) = a[min(k, len(a) - 1)], b[min(k, len(b) - 1)]
        fit = (i < len(pa_)) & (j < len(pb))
        if same:
            fit &= i < j if k == 0 else i <= j
        i, j = i[fit], j[fit]
        differ = (pa_[i] ^ pb[j]) & ma[i] & mb[j]
        near = (np.bitwise_count(differ) <= bits) & (differ & lead == U64(0)) & apart(k, i, j)
        return i[near], j[near]

    top = max(len(a), len(b)) - 1
    step = _CHUNK // (FAN * FAN)
    stack = [(top, *surviving(top, np.zeros(1, np.int64), np.zeros(1, np.int64)))]
    while stack:
        k, i, j = stack.pop()
        if k == 0:
            if new := forest.add(i, j + shift):
                found += new
                forest.flatten()
                known = [labels(forest.up[: len(first)], len(a)), labels(forest.up[shift:], len(b))]
            continue
        if len(i) > step:
            stack.append((k, i[step:], j[step:]))
            i, j = i[:step], j[:step]
        keep = apart(k, i, j)
        i, j = i[keep], j[keep]
        x = (i[:, None] * FAN + np.arange(FAN)) if k < len(a) else i[:, None]
        y = (j[:, None] * FAN + np.arange(FAN)) if k < len(b) else j[:, None]
        stack.append((k - 1, *surviving(k - 1, np.repeat(x, y.shape[1], axis=1).ravel(), np.tile(y, (1, x.shape[1])).ravel())))
    return codes, forest, found


class Forest:
    """Union-find over the codes of a task; add() tells which links join two trees."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
        up, out = self.up, []
        differ = up[i] != up[j]
        for a, b in zip(i[differ].tolist(), j[differ].tolist(), strict=True):
            x, y = a, b
            while up[x] != x:
                up[x] = x = up[up[x]]
            while up[y] != y:
                up[y] = y = up[up[y]]
            if x != y:
                up[max(x, y)] = min(x, y)
                out.append((a, b))
        return out

    def flatten(self) -> None:
        while (self.up != self.up[self.up]).any():
            self.up = self.up[self.up]


def near_pairs(codes: DataFrame, bits: int = BITS, block: int = BLOCK, task_rows: int = TASK_ROWS) -> DataFrame:
    """codes: fp (distinct). Edges u, v between them whose components are those of all pairs at `bits` or fewer differences."""
    n = codes.count()
    every = orders(n, bits)
    sign = U64(1 << 63)  # turned, so that signed order is unsigned order

    def ranks(batches):
        for b in batches:
            fp = b["fp"].to_numpy().view(U64)
            for k, (groups, _) in enumerate(every):
                rank = (gray_rank(in_order(fp, groups)) ^ sign).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), k, np.int32)), pa.array(rank), b["fp"]], names=["order", "rank", "fp"])

    def within(batches):
        """Links within the upper nodes that end in this task, and blocks of its first and last upper node."""
        held = [(b["order"].to_numpy(), b["fp"].to_numpy().view(U64)) for b in batches if b.num_rows]
        if not held:
            return
        order, fp = (np.concatenate(x) for x in zip(*held, strict=True))
        del held
        cut = [*np.flatnonzero(np.concatenate(([True], order[1:] != order[:-1]))).tolist(), len(order)]
        for s, e in zip(cut, cut[1:], strict=False):
            k, some = int(order[s]), fp[s:e]
            lead = some & U64(every[k][1])
            at = [*np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1]))).tolist(), len(lead)]
            low, high = at[1] if s == 0 else 0, at[-2] if e == len(order) else len(some)
            open_ = [(0, low)] * (s == 0) + [(high, len(some))] * (e == len(order) and high >= low)
            for x, y in open_:
                for z in range(x, y, block):
                    part = some[z : min(y, z + block)]
                    ones, zeros = (int(np.bitwise_and.reduce(p).view(np.int64)) for p in (part, ~part))
                    yield pa.RecordBatch.from_pydict({"order": pa.array([k], pa.int32()), "lead": pa.array(lead[x : x + 1].view(np.int64)), "ones": [ones], "zeros": [zeros], "body": pa.array([part.tobytes()], pa.binary()), "u": pa.nulls(1, pa.int64()), "v": pa.nulls(1, pa.int64())})
            if low < high:
                got = stars_of(some[low:high], None, every[k][1], bits).view(np.int64)
                none = pa.nulls(len(got), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.nulls(len(got), pa.int32()), none, none, none, pa.nulls(len(got), pa.binary()), pa.array(np.ascontiguousarray(got[:, 0])), pa.array(np.ascontiguousarray(got[:, 1]))], names=["order", "lead", "ones", "zeros", "body", "u", "v"])

    def compare(t: pa.Table) -> pa.Table:
        both = [np.frombuffer(x, U64) for _, x in sorted(zip(t["side"].to_pylist(), t["body"].to_pylist(), strict=True))]
        got = stars_of(both[0], both[1] if len(both) > 1 else None, every[t["order"][0].as_py()][1], bits).view(np.int64)
        return pa.table({"u": np.ascontiguousarray(got[:, 0]), "v": np.ascontiguousarray(got[:, 1])})

    parts = max(per_partition(codes), -(-n * len(every) // task_rows))
    dealt = codes.select("fp").mapInArrow(ranks, "order int, rank long, fp long").repartitionByRange(parts, "order", "rank").sortWithinPartitions("order", "rank")
    made = save(dealt.select("order", "fp").mapInArrow(within, "order int, lead long, ones long, zeros long, body binary, u long, v long"), "within")
    blocks = save(made.where("body is not null").select(F.monotonically_increasing_id().alias("block"), "order", "lead", "ones", "zeros", "body"), "blocks")
    one, other = (blocks.select("order", "lead", *[F.col(c).alias(f"{c}{x}") for c in ("block", "ones", "zeros")]) for x in "12")
    differ = "bit_count((ones1 ^ ones2) & (ones1 | zeros1) & (ones2 | zeros2))"
    pairs = save(one.join(other, ["order", "lead"]).where(f"block1 <= block2 and {differ} <= {bits}").select(F.monotonically_increasing_id().alias("pair"), "order", "block1", "block2"), "pairs")
    pairs = pairs.select("pair", "order", F.posexplode(F.expr("if(block1 = block2, array(block1), array(block1, block2))")).alias("side", "b"))
    rows = pairs.join(blocks.select("block", "body"), F.col("b") == F.col("block")).select("pair", "order", "side", "body")
    # A pair is work, however few its bytes: pairs are dealt to many tasks, which adaptive planning would join again.
    rows = rows.repartition(2 * per_partition(codes), "pair")
    return made.where("u is not null").select("u", "v").unionByName(rows.groupBy("pair").applyInArrow(compare, "u long, v long"))


def roots(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """fps: fp (distinct). node, root for each fingerprint that isn't the smallest (as a long) of its component."""
    return components(near_pairs(fps, bits))


def simhash_groups(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """A row for each row of docs: doc_id, fingerprint (16 hex digits), component_id, group_links (equal fingerprints besides).

    Fingerprints, which are never null, are the nodes; a component's smallest doc_id names it afterwards. A null or empty text
    has fingerprint zero and links as any other; fewer than `words` words make one shingle. Rows without an id link as others
    do, but never name a component (component_id is null where no row of it has an id). Rows of one id may be in several
    components, each named on its own. Texts are read whole, whatever their length. Repeated rows have a row each. No rows give
    no rows."""
    prepare(docs.sparkSession)
    fps = save(fingerprints(docs, words), "fps")
    classes = save(fps.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    linked = classes.join(roots(classes.select("fp"), bits), F.col("fp") == F.col("node"), "left").select(F.col("fp").alias("f"), F.coalesce("root", "fp").alias("root"), "rep", "n")
    names = linked.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("name"), F.count(F.lit(1)).alias("fps"))
    named = linked.join(names, F.col("root") == F.col("r")).where("n > 1 or fps > 1").select("f", "name", "n")
    out = fps.join(save(named, "named"), F.col("fp") == F.col("f"), "left")
    component = F.when(F.col("f").isNull(), F.col("doc_id")).otherwise(F.col("name")).alias("component_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component, (F.coalesce("n", F.lit(1)) - 1).cast("long").alias("group_links"))
