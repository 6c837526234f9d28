"""Quality metrics of segments: coverage, distribution, integrity, duplicates, balance, text. DataFrame in, DataFrame out."""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.numbers import missing
from ..scratch import save
from . import intervals

# Coverage


def in_seconds(episodes: DataFrame) -> DataFrame:
    """episodes with duration_seconds: as given, else duration_minutes * 60, else duration; none of them is an error."""
    if "duration_seconds" in episodes.columns:
        return episodes
    if "duration_minutes" in episodes.columns:
        return episodes.withColumn("duration_seconds", F.col("duration_minutes") * 60)
    if "duration" in episodes.columns:
        return episodes.withColumn("duration_seconds", F.col("duration"))
    raise ValueError("episodes have none of duration_seconds, duration_minutes and duration")


def episode_coverage(episodes: DataFrame, spans: DataFrame, beats: DataFrame) -> DataFrame:
    """Each episode's coverage by spans (their union, at most 100 %) and by beats (summed durations, not capped), and counts.

    episodes: episode_id and a length, as in_seconds takes it."""
    episodes = in_seconds(episodes)
    s = intervals.union_duration(spans, "episode_id").withColumnRenamed("union_duration", "span_seconds")
    ns = spans.groupBy("episode_id").agg(F.count(F.lit(1)).alias("span_count"))
    b = beats.groupBy("episode_id").agg(F.count(F.lit(1)).alias("beat_count"), F.sum(F.col("end_time") - F.col("start_time")).alias("beat_seconds"))
    out = episodes.select("episode_id", "duration_seconds").join(ns, "episode_id", "left").join(s, "episode_id", "left").join(b, "episode_id", "left").na.fill(0)
    pct = lambda c: F.when(F.col("duration_seconds") > 0, F.col(c) / F.col("duration_seconds") * 100).otherwise(0.0)
    return out.withColumn("span_coverage_pct", F.round(F.least(pct("span_seconds"), F.lit(100.0)), 2)).withColumn("beat_coverage_pct", F.round(pct("beat_seconds"), 2))


def global_coverage(per_episode: DataFrame) -> DataFrame:
    total = F.sum("duration_seconds")
    pct = lambda c: F.when(total > 0, F.sum(c) / total * 100).otherwise(0.0)
    return per_episode.agg(
        F.count(F.lit(1)).alias("episodes"), F.coalesce(total, F.lit(0.0)).alias("total_seconds"), F.coalesce(F.sum("span_count"), F.lit(0)).alias("span_count"), F.coalesce(F.sum("beat_count"), F.lit(0)).alias("beat_count"),
        F.round(F.least(pct("span_seconds"), F.lit(100.0)), 2).alias("span_coverage_pct"), F.round(pct("beat_seconds"), 2).alias("beat_coverage_pct"),
    )


def gap_overlap_summary(segments: DataFrame, episodes: DataFrame, total: str = "duration_seconds", tie: str = "end_time") -> DataFrame:
    """Gaps and overlaps of each episode: counts, seconds, and percents of its length."""
    g = intervals.gaps(segments, "episode_id", episodes, total, tie=tie).groupBy("episode_id").agg(F.count(F.lit(1)).alias("gap_count"), F.round(F.sum("gap_duration"), 2).alias("gap_seconds"))
    o = intervals.overlaps(segments, "episode_id").groupBy("episode_id").agg(F.count(F.lit(1)).alias("overlap_count"), F.round(F.sum("overlap_duration"), 2).alias("overlap_seconds"))
    out = episodes.select("episode_id", F.col(total)).join(g, "episode_id", "left").join(o, "episode_id", "left").na.fill(0)
    pct = lambda c: F.when(F.col(total) > 0, F.round(F.col(c) / F.col(total) * 100, 2)).otherwise(0.0)
    return out.withColumn("gap_percent", pct("gap_seconds")).withColumn("overlap_percent", pct("overlap_seconds"))


# Distribution


def duration_of(df: DataFrame) -> Column:
    """`duration`, else end_time - start_time; neither is an error."""
    if "duration" in df.columns:
        return F.col("duration")
    if {"start_time", "end_time"} <= set(df.columns):
        return F.col("end_time") - F.col("start_time")
    raise ValueError("segments have neither duration nor start_time and end_time")


#: So many values are sent to the driver at most when percentiles are looked up.
VALUES_LEFT = 1 << 16


def _keys(values: np.ndarray) -> np.ndarray:
    """Doubles as unsigned numbers in the same order; both zeros alike."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _digits(d: DataFrame, shift: int, heads: list[int], count: bool) -> pa.Table:
    """Of values whose key's bits above shift + 16 are among heads: how often each next 16 bits occur (head, digit, n), or their keys."""

    def scan(batches):
        seen = {h: np.zeros(1 << 16, np.int64) for h in heads}
        for batch in batches:
            keys = _keys(batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64, copy=False))
            above = keys >> np.uint64(shift + 16) if shift < 48 else np.zeros_like(keys)
            for h in heads:
                own = keys[above == np.uint64(h)]
                if count:
                    seen[h] += np.bincount((own >> np.uint64(shift)).astype(np.int64) & 0xFFFF, minlength=1 << 16) if len(own) else 0
                elif len(own):
                    yield pa.RecordBatch.from_pydict({"key": own.view(np.int64)})
        for h in heads if count else ():
            at = np.flatnonzero(seen[h])
            yield pa.RecordBatch.from_pydict({"head": np.full(len(at), h, np.int64), "digit": at.astype(np.int64), "n": seen[h][at]})

    if not count:
        return d.mapInArrow(scan, "key long").toArrow()
    return d.mapInArrow(scan, "head long, digit long, n long").groupBy("head", "digit").agg(F.sum("n").alias("n")).toArrow()


def percentiles(d: DataFrame, shares: list[float]) -> list[float | None]:
    """Exact interpolated percentiles of a table's only column of doubles, neither null nor NaN; nulls if it has no rows.

    Each round counts 16 more bits of the values that may stand at the wanted places, from the highest; once few are left,
    they are fetched. Memory doesn't grow with the number of distinct values, and the table is read four times at most."""
    places: dict[int, tuple[int, int]] = {}  # place wanted: head, place among the values of that head
    shift, heads, n, left = 48, [0], None, None
    while True:
        got = _digits(d, shift, heads, True).sort_by([("head", "ascending"), ("digit", "ascending")])
        head, digit, count = (got[c].to_numpy() for c in ("head", "digit", "n"))
        if n is None:
            n = int(count.sum())
            if not n:
                return [None for _ in shares]
            places = {k: (0, k) for x in shares for k in (math.floor((n - 1) * x), math.ceil((n - 1) * x))}
        left = {}
        for k, (h, at) in places.items():
            own = np.flatnonzero(head == h)
            before = np.cumsum(count[own]) - count[own]
            x = int(np.searchsorted(before, at, side="right")) - 1
            places[k] = (h << 16 | int(digit[own][x]), at - int(before[x]))
            left[places[k][0]] = int(count[own][x])
        if not shift or sum(left.values()) <= VALUES_LEFT:
            break
        shift, heads = shift - 16, sorted(left)
    if shift:
        keys = np.sort(_digits(d, shift - 16, sorted(left), False)["key"].to_numpy().view(np.uint64))
        key = {k: int(keys[np.searchsorted(keys, np.uint64(h << shift)) + at]) for k, (h, at) in places.items()}
    else:
        key = {k: h for k, (h, _) in places.items()}
    value = {k: np.array([x & ~(1 << 63) if x >> 63 else ~x & (1 << 64) - 1], np.uint64).view(np.float64)[0].item() for k, x in key.items()}

    def between(x: float) -> float:
        low, high = value[math.floor(x)], value[math.ceil(x)]
        return low if low == high else (math.ceil(x) - x) * low + (x - math.floor(x)) * high

    return [between((n - 1) * x) for x in shares]


def duration_statistics(segments: DataFrame, exact: bool = True) -> DataFrame:
    """Count, least, most, mean, median, 5th and 95th percentile, sample deviation of durations that are neither missing nor negative.

    exact: interpolated percentiles, found in jobs that run at once; otherwise percentile_approx. The state of both is bounded."""
    d = segments.select(duration_of(segments).cast("double").alias("d")).where(~missing(F.col("d")) & (F.col("d") >= 0))
    shares = [0.5, 0.05, 0.95]
    p = F.array(*[F.lit(x).cast("double") for x in percentiles(d, shares)]) if exact else F.percentile_approx("d", shares, 10000)
    got = d.agg(F.count(F.lit(1)).alias("count"), F.min("d").alias("min"), F.max("d").alias("max"), F.avg("d").alias("mean"), *([] if exact else [p.alias("p")]), F.stddev_samp("d").alias("std"))
    p = p if exact else F.col("p")
    return got.select("count", *[F.round(c, 2).alias(n) for n, c in (("min", "min"), ("max", "max"), ("mean", "mean"), ("median", F.get(p, F.lit(0))), ("p5", F.get(p, F.lit(1))), ("p95", F.get(p, F.lit(2))), ("std", "std"))])


def length_compliance(segments: DataFrame, least: float, most: float) -> DataFrame:
    """Rows within the bounds, shorter and longer, and percents; the longer ones' is what the other two leave."""
    d = segments.select(duration_of(segments).alias("d"))
    n = F.count(F.lit(1))
    a = d.agg(n.alias("total"), F.count_if(F.col("d").between(least, most)).alias("within"), F.count_if(F.col("d") < least).alias("too_short"), F.count_if(F.col("d") > most).alias("too_long"))
    pct = lambda c: F.when(F.col("total") > 0, F.round(F.col(c) / F.col("total") * 100, 2)).otherwise(0.0)
    a = a.withColumn("within_pct", pct("within")).withColumn("too_short_pct", pct("too_short"))
    return a.withColumn("too_long_pct", F.when(F.col("total") > 0, F.round(100 - F.col("within_pct") - F.col("too_short_pct"), 2)).otherwise(0.0))


#: Edges of the bins, the last one open.
EDGES = {"span": (0, 20, 40, 60, 90, 120, 180), "beat": (0, 60, 90, 120, 150, 180, 240)}


def duration_histogram(segments: DataFrame, kind: str = "span", edges: tuple[float, ...] | None = None) -> DataFrame:
    """Left-closed bins with their counts, empty ones too: bin, low, high (null: open), count."""
    edges = edges or EDGES[kind]
    bins = segments.sparkSession.createDataFrame([(k, float(x), float(edges[k + 1]) if k + 1 < len(edges) else None) for k, x in enumerate(edges)], "bin int, low double, high double")
    d = duration_of(segments)
    number = sum(((d >= e).cast("int") for e in edges), F.lit(0)) - 1
    counts = segments.where(d >= edges[0]).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return bins.join(counts, "bin", "left").na.fill(0, ["count"])


def equal_width_histogram(segments: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width bins from the least to the greatest duration, the last one closed."""
    d = segments.select(duration_of(segments).cast("double").alias("d")).where("d is not null")
    low, high = d.agg(F.min("d"), F.max("d")).first()
    if low is None:
        return segments.sparkSession.createDataFrame([], "bin int, low double, high double, count long")
    low, high = (low - 0.5, high + 0.5) if low == high else (low, high)
    width = (high - low) / bins
    at = F.least(F.floor((F.col("d") - low) / width), F.lit(bins - 1)).cast("int")
    frame = segments.sparkSession.createDataFrame([(k, low + k * width, low + (k + 1) * width) for k in range(bins)], "bin int, low double, high double")
    return frame.join(d.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("count")), "bin", "left").na.fill(0, ["count"])


# Integrity


def integrity_counts(segments: DataFrame, id_col: str) -> DataFrame:
    """One row of counts: durations, missing fields, negative times."""
    d = F.col("end_time") - F.col("start_time")
    blank = lambda c: F.col(c).isNull() | (F.regexp_replace(c, r"(?U)\s", "") == "")
    return segments.agg(
        F.count(F.lit(1)).alias("total_segments"), F.count_if(d < 0).alias("negative_duration_count"), F.count_if(d == 0).alias("zero_duration_count"), F.count_if(blank("episode_id")).alias("missing_episode_id_count"),
        F.count_if(blank(id_col)).alias("missing_id_count"), F.count_if(blank("speaker")).alias("missing_speaker_count"), F.count_if(blank("text")).alias("missing_text_count"),
        F.count_if(missing(F.col("start_time")) | missing(F.col("end_time"))).alias("missing_timestamp_count"), F.count_if((F.col("start_time") < 0) | (F.col("end_time") < 0)).alias("negative_timestamp_count"),
    )


def integrity_rows(segments: DataFrame, id_col: str) -> DataFrame:
    """A row for each fault: id, fault."""
    d = F.col("end_time") - F.col("start_time")
    blank = lambda c: F.col(c).isNull() | (F.regexp_replace(c, r"(?U)\s", "") == "")
    rules = {"negative_duration": d < 0, "zero_duration": d == 0, "missing_episode_id": blank("episode_id"), "missing_speaker": blank("speaker"), "missing_text": blank("text"), "missing_timestamp": missing(F.col("start_time")) | missing(F.col("end_time"))}
    return segments.select(id_col, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("fault"))


def regression_counts(segments: DataFrame, tie: str) -> DataFrame:
    """Rows that start before the one before them ends, by episode and by speaker within it."""
    one = lambda keys, name: intervals.regressions(segments, keys, tie=tie).agg(F.count(F.lit(1)).alias("n")).withColumn("name", F.lit(name))
    both = one(["episode_id"], "e").unionAll(one(["episode_id", "speaker"], "s"))
    return both.agg(F.sum(F.when(F.col("name") == "e", F.col("n"))).alias("episode_regression_count"), F.sum(F.when(F.col("name") == "s", F.col("n"))).alias("speaker_regression_count"))


def with_duplicate_key(segments: DataFrame, least: int = 10, bin_seconds: float = 300.0) -> DataFrame:
    """Rows that take part in duplicate detection, with norm_text and time_bin; rows without episode or start are left out."""
    start = F.col("start_time") if "start_time" in segments.columns else F.lit(0.0)
    speaker = F.coalesce("speaker", F.lit("NO_SPEAKER")) if "speaker" in segments.columns else F.lit("NO_SPEAKER")
    keyed = segments.withColumn("norm_text", text.normalise(F.col("text"))).withColumn("time_bin", intervals.time_bin(start, bin_seconds)).withColumn("dup_speaker", speaker)
    return keyed.where((F.length("norm_text") >= least) & F.col("episode_id").isNotNull() & F.col("time_bin").isNotNull())


def exact_duplicates(segments: DataFrame, id_col: str, least: int = 10, bin_seconds: float = 300.0) -> DataFrame:
    """Groups of rows alike in normalised text, episode, speaker and time bin: duplicate_count, first_id, text_preview.

    The text is grouped by its hash, so that long texts aren't shuffled."""
    k = with_duplicate_key(segments, least, bin_seconds).withColumn("text_key", F.sha2("norm_text", 256))
    g = k.groupBy("text_key", "episode_id", "dup_speaker", "time_bin").agg(F.count(F.lit(1)).alias("count"), F.min(id_col).alias("first_id"), F.min(F.substring("text", 1, 100)).alias("text_preview"))
    return g.where("count > 1").withColumn("duplicate_count", F.col("count") - 1).drop("text_key")


def duplicate_rows(segments: DataFrame, id_col: str, least: int = 10, bin_seconds: float = 300.0) -> DataFrame:
    """Ids of all rows of a duplicate group but its first."""
    k = with_duplicate_key(segments, least, bin_seconds).withColumn("text_key", F.sha2("norm_text", 256))
    w = Window.partitionBy("text_key", "episode_id", "dup_speaker", "time_bin").orderBy(id_col)
    return k.withColumn("_n", F.row_number().over(w)).where("_n > 1").select(id_col)


def indel_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over the sum of lengths, by bit-parallel rows."""
    if not a and not b:
        return 1.0
    at: dict[str, int] = {}
    for k, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        u = row & at.get(c, 0)
        row = ((row + u) | (row - u)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


#: Texts and characters that a block of near-duplicate search holds, and rows of two blocks compared at once.
BLOCK_TEXTS, BLOCK_CHARS, TILE = 16384, 8 << 20, (256, 1024)


def _counts(texts: list[str], sizes: np.ndarray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Each text's letters in 64 counters, and its pairs of neighbouring letters in 128."""
    code = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), sizes)
    two = (row[:-1] * 128 + (code[:-1] * 31 + code[1:]) % 128)[row[:-1] == row[1:]]
    return tuple(np.bincount(at, minlength=n * len(texts)).reshape(-1, n).astype(kind) for at, n in ((row * 64 + code % 64, 64), (two, 128)))


def alike_pairs(a: list[str], b: list[str] | None, threshold: float) -> Iterator[tuple[int, int]]:
    """Places of all alike pairs of a text of a and one of b (None: of two texts of a), by Indel ratio.

    Texts n and m long are alike if at most (1-t)(n+m) insertions and deletions part them. Each changes one letter's count by
    one and at most three counts of letter pairs, so counts that differ by more rule a pair out: first those of the 15 most
    frequent letters and the rest, tile by tile, then all. No pair is lost; what is left is compared exactly."""
    other = a if b is None else b
    sizes = [np.array([len(t) for t in x], np.int64) for x in (a, other)]
    kind = np.int16 if max(x.max(initial=0) for x in sizes) < 16000 else np.int32
    ones_a, twos_a = _counts(a, sizes[0], kind)
    ones_b, twos_b = (ones_a, twos_a) if b is None else _counts(b, sizes[1], kind)
    fold = np.zeros((64, 16), kind)
    fold[np.argsort(-(ones_a.sum(0) + ones_b.sum(0)), kind="stable"), np.minimum(np.arange(64), 15)] = 1
    order_a, order_b = (np.argsort(x, kind="stable") for x in sizes)
    few_a, few_b = np.ascontiguousarray((ones_a @ fold)[order_a].T), np.ascontiguousarray((ones_b @ fold)[order_b].T)
    n, m, most = sizes[0][order_a], sizes[1][order_b], (2 - threshold) / threshold
    for s in range(0, len(a), TILE[0]):
        at = slice(s, min(s + TILE[0], len(a)))
        low, high = np.searchsorted(m, [int(n[at][0] / most) - 1, int(n[at][-1] * most) + 2])
        for e in range(max(low, s) if b is None else low, high, TILE[1]):
            to = slice(e, min(e + TILE[1], high))
            apart = np.zeros((at.stop - s, to.stop - e), kind)
            one = np.empty_like(apart)
            for x, y in zip(few_a[:, at], few_b[:, to], strict=True):
                np.subtract(x[:, None], y[None, :], out=one)
                np.abs(one, out=one)
                apart += one
            edits = ((1 - threshold) * (n[at][:, None] + m[to][None, :]) + 1e-6).astype(kind)
            p, q = np.nonzero(apart <= edits)
            if b is None:
                p, q = p[e + q > s + p], q[e + q > s + p]
            i, j, edits = order_a[at][p], order_b[to][q], edits[p, q]
            for x, y, times in ((ones_a, ones_b, 1), (twos_a, twos_b, 3)):
                keep = np.abs(x[i] - y[j]).sum(axis=1) <= times * edits.astype(np.int64)
                i, j, edits = i[keep], j[keep], edits[keep]
            yield from ((x, y) for x, y in zip(i.tolist(), j.tolist(), strict=True) if indel_ratio(a[x], other[y]) >= threshold)


def _alike(texts: DataFrame, threshold: float) -> DataFrame:
    """All alike pairs of texts (rank_id, norm_text): x, y, the lesser id first.

    Texts alike differ in length by (2-t)/t at most, so classes of lengths that grow by that only meet their own and the
    next. Classes are cut in blocks of bounded size, and a task gets two blocks: memory doesn't grow with the table."""
    kind = dict(texts.dtypes)["rank_id"]
    base = max(1.05, 1.001 * (2 - threshold) / threshold)
    of = texts.withColumn("c", F.floor(F.log(F.length("norm_text").cast("double")) / F.lit(math.log(base))).cast("int"))
    blocks = {r["c"]: max(1, -(-r["n"] // BLOCK_TEXTS), -(-r["s"] // BLOCK_CHARS)) for r in of.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("norm_text")).alias("s")).collect()}
    if not blocks:
        return texts.select(F.col("rank_id").alias("x"), F.col("rank_id").alias("y")).where("false")
    number = F.create_map(*[F.lit(v) for kv in blocks.items() for v in kv])
    of = of.withColumn("b", F.pmod(F.xxhash64("norm_text"), number[F.col("c")]).cast("int"))
    every = lambda c: F.when(number[c].isNotNull(), F.sequence(F.lit(0), (number[c] - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    met = lambda low, i, high, j, side: F.struct(low.alias("low"), i.alias("i"), high.alias("high"), j.alias("j"), side.alias("side"))
    c, b = F.col("c"), F.col("b")
    keys = F.concat(
        F.transform(every(c), lambda j: met(c, F.least(b, j), c, F.greatest(b, j), (j < b).cast("int"))),
        F.transform(every(c + 1), lambda j: met(c, b, c + 1, j, F.lit(0))),
        F.transform(every(c - 1), lambda j: met(c - 1, j, c, b, F.lit(1))),
    )
    dealt = of.select("rank_id", "norm_text", F.explode(keys).alias("k")).select("rank_id", "norm_text", "k.*")

    def compare(key: tuple, rows: pa.Table) -> pa.Table:
        sides = [rows.filter(pc.equal(rows["side"], k)) for k in (0, 1)]
        own = key[0].as_py() == key[2].as_py() and key[1].as_py() == key[3].as_py()
        left, right = sides[0], sides[0] if own else sides[1]
        found = list(alike_pairs(left["norm_text"].to_pylist(), None if own else right["norm_text"].to_pylist(), threshold)) if left.num_rows and right.num_rows else []
        return pa.table({"a": left["rank_id"].take(pa.array([x for x, _ in found], pa.int64())), "b": right["rank_id"].take(pa.array([y for _, y in found], pa.int64()))})

    pairs = dealt.groupBy("low", "i", "high", "j").applyInArrow(compare, f"a {kind}, b {kind}")
    return pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))


def near_duplicates(segments: DataFrame, id_col: str, threshold: float = 0.95, least: int = 10) -> DataFrame:
    """Rows whose normalised text is alike, by Indel ratio, to another's: id_col, leader_id (its cluster).

    Distinct texts are taken in order of their least id: one without an earlier leader alike leads, the others join the
    first such leader. Leaders come out in rounds (a text none of whose earlier partners is open leads, its later partners
    are eliminated), as many as a chain is long. Tables are joined by sort and merge, as the driver holds what is broadcast."""
    keyed = with_duplicate_key(segments, least, 300.0)
    texts = save(keyed.groupBy("norm_text").agg(F.min(id_col).alias("rank_id")), "texts")
    alike = save(_alike(texts, threshold), "alike")
    open_, eliminated = alike, alike.select("y").where("false")
    while not open_.isEmpty():
        first = open_.join(open_.select(F.col("y").alias("w")).distinct().hint("merge"), F.col("x") == F.col("w"), "left_anti")
        gone = save(first.select("y").distinct(), "gone")
        eliminated = save(eliminated.unionByName(gone), "eliminated")
        rest = open_.join(gone.hint("merge"), "y", "left_anti")
        open_ = save(rest.join(gone.select(F.col("y").alias("w")).hint("merge"), F.col("x") == F.col("w"), "left_anti"), "open")
    led = alike.join(eliminated.select(F.col("y").alias("w")).hint("merge"), F.col("x") == F.col("w"), "left_anti").groupBy("y").agg(F.min("x").alias("leader_id"))
    names = led.unionByName(led.select(F.col("leader_id").alias("y"), "leader_id").distinct())
    by_text = texts.join(names.hint("merge"), F.col("rank_id") == F.col("y")).select("norm_text", "leader_id")
    return keyed.select(id_col, "norm_text").join(by_text.hint("merge"), "norm_text").select(id_col, "leader_id")


# Balance


def speaker_distribution(segments: DataFrame, top: int = 10) -> DataFrame:
    """Speakers with count, percent of all rows, total and mean duration and rank; those after the first `top` as one row (rank null)."""
    who = F.coalesce("speaker_canonical", "speaker") if "speaker_canonical" in segments.columns else F.col("speaker")
    by = segments.where(who.isNotNull()).groupBy(who.alias("speaker")).agg(F.count(F.lit(1)).alias("count"), F.sum(duration_of(segments)).alias("total_duration"))
    all_ = Window.partitionBy()
    ranked = by.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "speaker"))).withColumn("all", F.sum("count").over(all_))
    head = F.col("rank") <= top
    out = ranked.groupBy(F.when(head, F.col("rank")).alias("rank"), F.when(head, F.col("speaker")).alias("speaker"), "all").agg(F.sum("count").alias("count"), F.sum("total_duration").alias("total_duration"), F.count(F.lit(1)).alias("speakers"))
    return out.select("rank", "speaker", "speakers", "count", F.round(F.col("count") / F.col("all") * 100, 2).alias("percent"), F.round("total_duration", 2).alias("total_duration"), F.round(F.col("total_duration") / F.col("count"), 2).alias("avg_duration"))


def series_balance(segments: DataFrame, episodes: DataFrame) -> DataFrame:
    """A row for each series: episodes, segments, speakers, total and mean duration, and the largest series' size over this one's."""
    on = segments.join(episodes.select("episode_id", "series"), "episode_id", "left")
    by = on.groupBy("series").agg(F.count_distinct("episode_id").alias("episodes"), F.count(F.lit(1)).alias("segments"), F.count_distinct("speaker").alias("speakers"), F.sum(duration_of(segments)).alias("total_duration"))
    return by.select("series", "episodes", "segments", "speakers", F.round("total_duration", 2).alias("total_duration"), F.round(F.col("total_duration") / F.col("segments"), 2).alias("avg_duration"), F.round(F.max("segments").over(Window.partitionBy()) / F.col("segments"), 2).alias("largest_ratio"))


# Text


def text_counts(segments: DataFrame, id_col: str) -> DataFrame:
    """Tokens, words (tokens with a letter) and characters of each row."""
    t = text.tokens(F.col("text"))
    return segments.select(id_col, F.size(t).alias("tokens"), F.size(F.filter(t, text.has_letter)).alias("words"), F.length(F.coalesce("text", F.lit(""))).alias("characters"))


def text_metrics(segments: DataFrame, id_col: str) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("tokens", "words", "characters")]
    means = [F.round(F.avg(c), 2).alias(f"avg_{c}") for c in ("tokens", "words", "characters")]
    return text_counts(segments, id_col).agg(F.count(F.lit(1)).alias("total_segments"), *sums, *means)


def densities(segments: DataFrame, id_col: str) -> DataFrame:
    """Words, stop words and lexical density (content words over words) of each row."""
    w = text.clean_words(F.col("text"), text.STRIP_DENSITY)
    rows = segments.select(id_col, w.alias("w")).select(id_col, F.size("w").alias("words"), F.size(F.filter("w", lambda t: text.one_of(t, text.STOP_TERMS))).alias("stopwords"))
    return rows.withColumn("density", F.when(F.col("words") > 0, F.round((F.col("words") - F.col("stopwords")) / F.col("words"), 3)).otherwise(0.0))


def lexical_density(segments: DataFrame, id_col: str) -> DataFrame:
    """In all, and the mean over rows with words."""
    d, n = densities(segments, id_col), F.sum("words")
    return d.agg(
        F.coalesce(n, F.lit(0)).alias("total_words"), F.coalesce(F.sum("stopwords"), F.lit(0)).alias("stopword_count"), F.coalesce(F.round((n - F.sum("stopwords")) / n, 3), F.lit(0.0)).alias("lexical_density"),
        F.coalesce(F.round(F.avg(F.when(F.col("words") > 0, F.col("density"))), 3), F.lit(0.0)).alias("avg_lexical_density"),
    )


def punctuation(segments: DataFrame, id_col: str) -> DataFrame:
    """Characters that aren't white space, ASCII punctuation among them, and their ratio, for each row."""
    solid = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?U)\s", "")
    rows = segments.select(id_col, F.length(solid).alias("characters"), F.length(F.regexp_replace(solid, r"[^!-/:-@\[-`{-~]", "")).alias("punctuation"))
    return rows.withColumn("ratio", F.when(F.col("characters") > 0, F.round(F.col("punctuation") / F.col("characters"), 3)).otherwise(0.0))


def punctuation_ratio(segments: DataFrame, id_col: str) -> DataFrame:
    rows, n = punctuation(segments, id_col), F.sum("characters")
    return rows.agg(
        F.coalesce(n, F.lit(0)).alias("total_characters"), F.coalesce(F.sum("punctuation"), F.lit(0)).alias("punctuation_count"), F.coalesce(F.round(F.sum("punctuation") / n, 3), F.lit(0.0)).alias("punctuation_ratio"),
        F.coalesce(F.round(F.avg(F.when(F.col("characters") > 0, F.col("ratio"))), 3), F.lit(0.0)).alias("avg_punctuation_ratio"),
    )


def unigram_counts(segments: DataFrame) -> DataFrame:
    w = F.filter(text.clean_words(F.col("text"), text.STRIP_TERMS), lambda t: ~text.one_of(t, text.STOP_TERMS))
    return segments.select(F.explode(w).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def bigram_counts(segments: DataFrame) -> DataFrame:
    """Pairs of neighbouring words of which at least one is not a stop word."""
    words = segments.select(text.clean_words(F.col("text"), text.STRIP_TERMS).alias("w"))
    pair = F.zip_with("w", F.slice("w", 2, 1 << 30), lambda a, b: F.when(b.isNotNull() & ~(text.one_of(a, text.STOP_TERMS) & text.one_of(b, text.STOP_TERMS)), F.concat_ws(" ", a, b)))
    return words.select(F.explode(F.array_compact(pair)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("count"))


def top_terms(counts: DataFrame, n: int = 20) -> DataFrame:
    """The n most frequent terms, ties in order of the term (a report of fixed size)."""
    return counts.orderBy(F.desc("count"), "term").limit(n)
