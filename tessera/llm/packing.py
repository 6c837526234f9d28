"""Best-fit packing, hierarchical.

Documents become pieces of at most `capacity` tokens (only longer ones are cut; the odd piece comes first). Full pieces are
sequences. The others are dealt to nodes by hash, each of about NODE items, so that all nodes see the same mix of lengths.
A node packs its items best-fit, the longest first, and emits its nearly full bins: those whose room takes at most a share
SMALL of the items there are, by a histogram of all lengths. The underfull bins go up as items, where the nodes of a tree (FAN
children each) repeat the rounds, until one node is left. Best-fit leaves few underfull bins of many items, so levels shrink;
where they don't (items over half a sequence, which no other fits), as many nodes as their items need work at the next level,
and the tree ends when a level packs nothing together, so no node ever holds more than about NODE items. No bin is cut short
by a cap.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_partition, prepare, save
from .tokens import crc32, encode_all

CAPACITY, END = 2048, 0
NODE, FAN = 1 << 15, 8
#: A bin is nearly full where at most this share of all items fits into its room.
SMALL = 0.001


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and offset of each item, and the fill of each bin. Room is found by a bit mask of rooms in use."""
    order = np.argsort(-sizes, kind="stable").tolist()
    where, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    length = sizes.tolist()
    for k in order:
        s = length[k]
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        where[k], offset[k] = b, fill[b]
        fill[b] += s
        if room := room - s:
            by_room[room].append(b)
            rooms |= 1 << room
    return where, offset, np.array(fill, np.int64)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each piece of each document."""

    def cut(batches):
        for b in batches:
            rows = []
            for i, ids in zip(b["doc_id"].to_pylist(), encode_all(tokenizer, b["text"].to_pylist(), end), strict=True):
                n = len(ids) // 4
                at, first = 0, n % capacity or capacity
                while at < n:
                    size = capacity if at else first
                    rows.append((i, 0 if not at else 1 + (at - first) // capacity, at, size, crc32(ids[4 * at : 4 * (at + size)])))
                    at += size
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def node_round(level: int, last: bool, capacity: int, room: int):
    """What a node does with its items: bins with `room` or more go up. At the last level all bins are emitted."""

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        where, offset, fill = best_fit(t["length"].to_numpy(), capacity)
        going = np.zeros(len(fill), bool) if last else fill + room <= capacity
        bins = (level << 56) + (key[0].as_py() << 24) + np.arange(len(fill))
        return pa.table({"item": t["item"], "bin": bins[where], "offset": offset, "fill": fill[where], "going": going[where]})

    return run


def least_room(lengths: DataFrame, small: float) -> tuple[int, int]:
    """The number of items, and the length that more than a share `small` of them do not exceed."""
    at = n = 0
    counts = sorted(lengths.groupBy("length").count().collect())  # a row for each length, so fewer than the capacity
    total = sum(c for _, c in counts)
    for at, c in counts:
        n += c
        if n > small * total:
            break
    return total, at


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END, node: int = NODE, small: float = SMALL) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one token, the end. Long texts are read whole and cut. Equal rows, and rows of one id, are packed
    each on its own; ties go by the items' order in their node. Other columns of docs are ignored. No rows give no rows."""
    prepare(docs.sparkSession)
    cut = save(pieces(docs, tokenizer, capacity, end).withColumn("item", F.monotonically_increasing_id()), "pieces")
    items, level, rounds = cut.where(F.col("length") < capacity).select("item", "length"), 0, []
    n, room = least_room(items, small)
    while n:
        nodes = -(-n // node)
        dealt = items.withColumn("node", F.pmod(F.xxhash64("item"), F.lit(nodes)))
        fit = node_round(level, nodes == 1, capacity, room)
        done = save(dealt.groupBy("node").applyInArrow(fit, "item long, bin long, offset long, fill long, going boolean"), f"round{level}")
        rounds.append(done)
        if nodes == 1:
            break
        items = save(done.where("going").groupBy(F.col("bin").alias("item")).agg(F.first("fill").alias("length")), f"items{level}")
        before, (n, room), level = n, least_room(items, small), level + 1
        if n > before * (FAN - 1) // FAN:  # hardly two of them fit together: what is left are sequences
            break
    if not rounds:
        return cut.select("doc_id", "piece", "start", "length", "ids_crc32", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    placed = rounds.pop().select("item", F.col("bin").alias("sequence_id"), "offset")
    while rounds:
        below = rounds.pop()
        above = placed.select(F.col("item").alias("b"), "sequence_id", F.col("offset").alias("more"))
        placed = below.join(above, F.col("bin") == F.col("b"), "left").select("item", F.coalesce("sequence_id", "bin").alias("sequence_id"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    out = cut.join(placed.select(F.col("item").alias("i"), "sequence_id", "offset"), F.col("item") == F.col("i"), "left")
    # a full piece is a sequence of its own; its number is negative, as no bin's is
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("sequence_id", -1 - F.col("item")).alias("sequence_id"), F.coalesce("offset", F.lit(0)).alias("offset"))
