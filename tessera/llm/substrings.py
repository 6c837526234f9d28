"""Substring dedup with a count-min prefilter.

The sketch counts anchors: the least 8-word gram hash of a window. Equal windows have equal anchors at different places, so
an anchor's count is never below the count of a window, nor is any cell that it falls into. The sketch has ROWS rows of
`width` counters; the width is a power of two of some SPARE times the anchors that so many bytes of text have, so the sketch
fits its data at any size. A row is cut into blocks of BLOCK counters. A task sends a sketch of its own: for each block the
places that it counts, four bytes each, as nearly all of its counters are zero; tasks add up the blocks of all partitions in
dense counters. A window may be repeated where its counter is two or more in all rows. These counters are known to the
second pass by a Bloom filter sized by their number; where that would be larger than MOST_BITS, as many passes are made, each
for a part of the cells. The second pass groups the windows let through by a 128-bit hash (two independent polynomials over
the words' bytes), exactly. What the sketch or the filter let through in vain costs work and changes nothing.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, among, bloom, mix, per_partition, powers, prepare, save, span_hashes

WINDOW, GRAM = 35, 8
#: Rows of the sketch, counters to an anchor, counters of a block, and bytes of text to an anchor.
ROWS, SPARE, BLOCK, ANCHOR_BYTES = 2, 4, 1 << 22, 20
#: Bits of the Bloom filter: so many for each repeated counter, and at most so many in a pass.
EACH_BITS, MOST_BITS = 12, 1 << 28
#: Anchors that a task counts before it sends its sketch.
HELD = 1 << 20
_SEEDS = (0x452821E638D01377, 0xBE5466CF34E90C6C)
_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Another code for each byte, by which words get a second hash that has nothing to do with the first.
_OTHER = mix(np.arange(256, dtype=U64) + U64(0x3F84D5B5B5470917))


class Words:
    """Words of consecutive texts (UTF-8): their hashes, and which text each is of."""

    def __init__(self, texts: list[bytes]) -> None:
        self.raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = _SPACE[self.raw]
        before = np.concatenate(([True], space[:-1]))
        self.starts, self.ends = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
        stops = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(stops, self.starts, "right")
        self.first = np.searchsorted(self.starts, np.concatenate(([0], stops[:-1])))  # number of each text's first word
        self.hashes = span_hashes(self.raw, self.starts, self.ends)

    def others(self) -> np.ndarray:
        """The words' second hashes."""
        return span_hashes(_OTHER[self.raw], self.starts, self.ends)


def rolling(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of each width consecutive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers(len(hashes) + 1)
    sums = np.concatenate((np.zeros(1, U64), np.cumsum(mix(hashes ^ U64(seed)) * up[:-1])))
    return mix((sums[width:] - sums[:n]) * down[:n])


def least(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of each width consecutive values, and its leftmost place."""
    value, place, have = x, np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        right = value[step:] < value[:-step]
        value, place, have = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step]), have + step
    return value, place


def anchors(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one text, each window's anchor, and the anchor's place."""
    n = len(w.hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    value, place = least(rolling(w.hashes, gram, 0x51ED270B), window - gram + 1)
    own = np.flatnonzero(w.text[:n] == w.text[window - 1 :])
    return own, value[own], place[own]


def cells(anchor: np.ndarray, width: int) -> list[np.ndarray]:
    """The counter of each anchor in each row, numbered through all rows."""
    return [(mix(anchor ^ U64(_SEEDS[r])) & U64(width - 1)).astype(np.int64) + r * width for r in range(ROWS)]


def pieces(text: bytes, window: int, most: int):
    """A text as (words before, part): parts of about `most` bytes, each with the window - 1 words that follow it.

    Every window lies whole in the part that its first word is of, and in no other."""
    at = before = 0
    while at < len(text):
        own = _WORD.search(text, min(len(text), at + most))
        cut = own.start() if own else len(text)
        if own and cut and not _SPACE[text[cut - 1]]:  # within a word: the part goes on to its end
            cut = own.end()
        end, k = cut, 0
        for m in _WORD.finditer(text, cut):
            end, k = m.end(), k + 1
            if k == window - 1:
                break
        yield before, text[at:end]
        before += len(text[at:cut].split())
        at = cut


def chunks(texts: list[bytes | None], window: int, most: int | None = None):
    """Runs of texts of about `most` bytes each, as (first, texts, words before); a longer text comes in pieces."""
    most = most or _BYTES
    at, held, size = 0, [], 0
    for k, t in enumerate(texts):
        t = t or b""
        if held and size + len(t) > most:
            yield at, held, 0
            at, held, size = k, [], 0
        if len(t) > most:
            for before, part in pieces(t, window, most):
                yield k, [part], before
            at = k + 1
            continue
        held.append(t)
        size += len(t)
    if held:
        yield at, held, 0


def kept_words(text: bytes, starts: np.ndarray | None, window: int) -> tuple[int, int, list[bytes]]:
    """The number of words and of removed ones, and the kept words; starts: the repeated windows' first words."""
    words = text.split()
    n = len(words)
    if starts is not None and len(starts):
        edge = np.zeros(n + 1, np.int64)
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + window, -1)
        gone = (np.cumsum(edge)[:n] > 0).tolist()
        words = [x for x, g in zip(words, gone, strict=True) if not g]
    return n, n - len(words), words


def width_for(n_bytes: int) -> int:
    """Counters of a row of the sketch for so many bytes of text."""
    return max(BLOCK, 1 << (SPARE * n_bytes // ANCHOR_BYTES).bit_length())


def repeated_cells(docs: DataFrame, window: int, gram: int, width: int) -> DataFrame:
    """cell: the counters of the merged sketch that are two or more."""
    block = min(BLOCK, width)

    def sketch(batches):
        held, n = [], 0

        def out():
            every = np.concatenate(held)
            for r, cell in enumerate(cells(every, width)):
                cell = np.sort(cell)
                third = np.concatenate((cell[2:] == cell[:-2], [False, False]))[: len(cell)]
                cell = cell[~third]  # a counter is told of two at most, as more make no difference
                at = np.flatnonzero(np.concatenate(([True], cell[1:] // block != cell[:-1] // block)))
                for part in np.split(cell, at[1:]):
                    yield pa.RecordBatch.from_pydict({"block": [int(part[0]) // block], "body": pa.array([(part % block).astype("<u4").tobytes()], pa.binary())})

        for b in batches:
            for _, texts, _ in chunks(b["text"].cast(pa.binary()).to_pylist(), window):
                _, anchor, place = anchors(Words(texts), window, gram)
                if len(anchor):
                    held.append(anchor[np.concatenate(([True], place[1:] != place[:-1]))])  # an anchor counts once at a place
                    n += len(held[-1])
                if n >= HELD:
                    yield from out()
                    held, n = [], 0
        if held:
            yield from out()

    def add_up(t: pa.Table) -> pa.Table:
        counts = np.zeros(block, np.uint8)
        for body in t["body"]:
            place, n = np.unique(np.frombuffer(body.as_py(), "<u4"), return_counts=True)
            counts[place] = np.minimum(counts[place] + n.astype(np.uint8), 2)
        return pa.table({"cell": np.flatnonzero(counts > 1) + t["block"][0].as_py() * block})

    return docs.select("text").mapInArrow(sketch, "block long, body binary").groupBy("block").applyInArrow(add_up, "cell long")


def flagged(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, width: int | None = None, most_bits: int = MOST_BITS) -> DataFrame:
    """docs: rid (unique), text. Rows rid, starts (binary of int32): places of windows whose words also start elsewhere."""
    width = width or width_for(docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0])
    repeated = save(repeated_cells(docs, window, gram, width), "repeated")
    bits = 1 << max(6, (EACH_BITS * repeated.count()).bit_length())
    passes = max(1, bits // most_bits)
    out = None
    for k in range(passes):
        words = bloom(repeated if passes == 1 else repeated.where(F.col("cell") % passes == k), "cell", bits // passes)
        part = save(one_pass(docs, window, gram, width, words, k, passes), "marks")
        out = part if out is None else out.unionByName(part)
    return out


def one_pass(docs: DataFrame, window: int, gram: int, width: int, words: np.ndarray, turn: int, passes: int) -> DataFrame:
    """`flagged` for the windows whose counter in the first row is of this turn. The filter has this turn's counters only."""
    repeated = docs.sparkSession.sparkContext.broadcast(words)

    def maybe_repeated(anchor):
        fit = np.ones(len(anchor), bool)
        for r, cell in enumerate(cells(anchor, width)):
            if r == 0:
                fit &= cell % passes == turn
            fit[fit] = among(repeated.value, cell[fit]) | (cell[fit] % passes != turn)
        return fit

    def windows(batches):
        names = ["h1", "h2", "rid", "place", "starts"]
        for b in batches:
            rids = b["rid"].to_numpy()
            for first, texts, before in chunks(b["text"].cast(pa.binary()).to_pylist(), window):
                w = Words(texts)
                own, anchor, _ = anchors(w, window, gram)
                if not len(own):
                    continue
                maybe = own[maybe_repeated(anchor)]
                if not len(maybe):
                    continue
                h1, h2 = rolling(w.hashes, window, 0x2545F491)[maybe].view(np.int64), rolling(w.others(), window, 0x6A09E667)[maybe].view(np.int64)
                order = np.lexsort((h2, h1))
                h1, h2, maybe = h1[order], h2[order], maybe[order]
                new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
                at = np.flatnonzero(new)
                size = np.diff(np.append(at, len(new)))
                of = w.text[maybe]
                place = (maybe - w.first[of] + before).astype(np.int32)
                # A window that this chunk repeats is decided here; one row tells the others of it, with place -1.
                sent = np.where(size > 1, -1, place[at]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(h1[at]), pa.array(h2[at]), pa.array(rids[first + of[at]]), pa.array(sent), pa.nulls(len(at), pa.binary())], names=names)
                many = np.repeat(size > 1, size)
                if many.any():
                    yield by_text(rids[first + of[many]], place[many], names)

    def by_text(rids, place, names):
        """Decided places as a row for each text; with names, in the form of windows()."""
        order = np.lexsort((place, rids))
        rids, place = rids[order], place[order].astype("<i4")
        at = np.flatnonzero(np.concatenate(([True], rids[1:] != rids[:-1])))
        body = pa.array([x.tobytes() for x in np.split(place, at[1:])], pa.binary())
        if names is None:
            return pa.RecordBatch.from_arrays([pa.array(rids[at]), body], names=["rid", "starts"])
        return pa.RecordBatch.from_arrays([pa.array(mix(rids[at].view(U64)).view(np.int64)), pa.array(np.zeros(len(at), np.int64)), pa.array(rids[at]), pa.array(np.full(len(at), -2, np.int32)), body], names=names)

    def group(batches):
        """Rows come sorted by h1, h2. The last run of a batch waits for the next one."""
        key, waits, open_ = None, None, False  # of the run at the end: its hashes, a row not yet decided, whether it is repeated
        for b in batches:
            place = b["place"].to_numpy()
            if (ready := place == -2).any():
                yield pa.RecordBatch.from_arrays([b["rid"].filter(pa.array(ready)), b["starts"].filter(pa.array(ready))], names=["rid", "starts"])
            use = ~ready
            h1, h2, rid, place = b["h1"].to_numpy()[use], b["h2"].to_numpy()[use], b["rid"].to_numpy()[use], place[use]
            if not len(h1):
                continue
            new = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            at = np.flatnonzero(new)
            weight = np.add.reduceat(np.where(place == -1, 2, 1), at)
            goes_on = key == (h1[0], h2[0])
            if goes_on:
                weight[0] += 2 if open_ else 1
            size = np.diff(np.append(at, len(h1)))
            hit = np.repeat(weight > 1, size) & (place >= 0)
            got = [(rid[hit], place[hit])]
            if goes_on and waits is not None:
                got.append((np.array([waits[0]]), np.array([waits[1]], np.int32)))
            key, open_ = (h1[-1], h2[-1]), bool(weight[-1] > 1)
            waits = None if open_ else (rid[-1], place[-1])
            rids, places = np.concatenate([x[0] for x in got]), np.concatenate([x[1] for x in got])
            if len(rids):
                yield by_text(rids, places, None)

    rows = docs.mapInArrow(windows, "h1 long, h2 long, rid long, place int, starts binary")
    dealt = rows.repartition(per_partition(docs), "h1").sortWithinPartitions("h1", "h2")
    return dealt.mapInArrow(group, "rid long, starts binary")


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, width: int | None = None, most_bits: int = MOST_BITS, texts: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, n_removed, kept_sha256 (texts: and kept, the words joined by spaces).

    Every word that lies in a window of `window` words is removed if these words also start anywhere else, in the same text
    too. Null and empty texts have no words; texts of fewer words than a window keep all of them; equal rows, and rows of one
    id, are rows of their own and lose what they share. Long texts are worked through in pieces. Other columns of docs are
    ignored. No rows give no rows."""
    prepare(spark := docs.sparkSession)
    rows = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("rid")), "numbered")
    marks = flagged(rows.select("rid", "text"), window, gram, width, most_bits)
    words = spark.sparkContext.broadcast(bloom(marks, "rid"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts

    def finish(batches, untouched: bool):
        for b in batches:
            if untouched:
                b = b.filter(pa.array(~among(words.value, b["rid"].to_numpy())))
            out = []
            for i, t, some in zip(b["doc_id"], b["text"].cast(pa.binary()), b["marks"].to_pylist() if "marks" in b.schema.names else [None] * b.num_rows, strict=True):
                starts = np.unique(np.concatenate([np.frombuffer(m, "<i4") for m in some])).astype(np.int64) if some else None
                n, removed, left = kept_words(t.as_py() or b"", starts, window)
                flat = b" ".join(left)
                out.append((i.as_py(), n, removed, hashlib.sha256(flat).hexdigest(), *[flat.decode()] * texts))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=False)], names=["doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * texts])

    def chosen(batches):
        for b in batches:
            yield b.filter(pa.array(among(words.value, b["rid"].to_numpy())))

    by_rid = marks.groupBy(F.col("rid").alias("r")).agg(F.collect_list("starts").alias("marks"))
    touched = rows.mapInArrow(chosen, "doc_id long, text string, rid long")  # by the filter, so other texts are not moved
    touched = touched.join(by_rid, F.col("rid") == F.col("r"), "left").select("doc_id", "text", "marks")
    return rows.mapInArrow(lambda x: finish(x, True), schema).unionByName(touched.mapInArrow(lambda x: finish(x, False), schema))


ORACLE = r"""
with w as (select row_number() over () as r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
s as (select r, i, array_to_string(ws[i:i + 34], ' ') as x from (select r, ws, unnest(range(1, len(ws) - 33)) as i from w)),
rep as (select r, list(i) as starts from (select r, i, count(*) over (partition by x) as c from s) where c > 1 group by r),
cov as (select r, list_distinct(flatten(list_transform(starts, lambda i: range(i, i + 35)))) as gone from rep),
k as (select w.doc_id, ws, w.r, unnest(range(1, len(ws) + 1)) as i from w),
g as (select r, unnest(gone) as i from cov),
kept as (select k.r, string_agg(ws[k.i], ' ' order by k.i) as x, count(*) as n from k anti join g on k.r = g.r and k.i = g.i group by k.r)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(kept.x, '')) as kept_sha256
from w left join kept on w.r = kept.r
"""
