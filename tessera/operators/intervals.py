"""Interval algebra over (key, start_time, end_time)."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(key: str, *order: str | Column):
    return Window.partitionBy(key).orderBy(*order)


def islands(df: DataFrame, key: str, start: str, end: str, tie: str) -> DataFrame:
    """df with `island`: intervals of a key that touch or overlap share one."""
    before = F.max(end).over(_by(key, start, tie).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_new", F.when(before.isNull() | (F.col(start) > before), 1).otherwise(0)).withColumn("island", F.sum("_new").over(_by(key, start, tie))).drop("_new")


def union_duration(df: DataFrame, key: str, start: str = "start_time", end: str = "end_time", tie: str | None = None) -> DataFrame:
    """Time covered by the union of a key's intervals: key, union_duration. Null times are left out."""
    known = df.where(F.col(start).isNotNull() & F.col(end).isNotNull())
    merged = islands(known, key, start, end, tie or end).groupBy(key, "island").agg((F.max(end) - F.min(start)).alias("length"))
    return merged.groupBy(key).agg(F.sum("length").alias("union_duration"))


def gaps(df: DataFrame, key: str, episodes: DataFrame, total: str, start: str = "start_time", end: str = "end_time", tie: str | None = None, strict: bool = False) -> DataFrame:
    """Uncovered stretches of each episode: key, gap_start, gap_end, gap_duration.

    episodes has key and its length in `total`. A gap lies between the end of a row and the start of the next (strict: the
    latest end so far, so that a nested interval opens none), before the first row from 0, and after the last one's end."""
    w = _by(key, start, tie or end)
    prev = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1)) if strict else F.lag(end).over(w)
    inner = df.select(key, F.coalesce(prev, F.lit(0.0)).alias("gap_start"), F.col(start).alias("gap_end"))
    last = df.groupBy(key).agg((F.max(end) if strict else F.max_by(end, F.struct(start, tie or end))).alias("_last"))
    tail = episodes.select(key, F.col(total).alias("gap_end")).join(last, key, "left").select(key, F.coalesce("_last", F.lit(0.0)).alias("gap_start"), "gap_end")
    return inner.unionByName(tail).where("gap_end > gap_start").withColumn("gap_duration", F.round(F.col("gap_end") - F.col("gap_start"), 2))


def overlaps(df: DataFrame, key: str, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Stretches where two or more intervals are active, cut at each end: key, overlap_start, overlap_end, overlap_duration, segment_count.

    A sweep over start (+1) and end (-1) events; at one time starts come first. A stretch opens when a second interval
    starts and closes at the next end; segment_count is the most that were active in it."""
    events = df.select(key, F.col(start).alias("t"), F.lit(1).alias("d")).unionAll(df.select(key, F.col(end).alias("t"), F.lit(-1).alias("d")))
    w = _by(key, "t", F.desc("d"))
    rows = w.rowsBetween(Window.unboundedPreceding, 0)
    swept = events.withColumn("active", F.sum("d").over(rows)).withColumn("n", F.row_number().over(w))
    # The events from one end to the next belong together: number them by the ends before.
    swept = swept.withColumn("piece", F.sum(F.when(F.col("d") < 0, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    carried = swept.withColumn("was", F.lag("active").over(w)).withColumn("since", F.lag("t").over(w))
    ends = carried.where("d < 0 and was >= 2").select(key, F.coalesce("piece", F.lit(0)).alias("piece"), F.col("t").alias("overlap_end"), F.col("was"))
    opens = carried.where("d > 0 and active >= 2").groupBy(key, F.coalesce("piece", F.lit(0)).alias("piece")).agg(F.min("t").alias("opened"))
    starts = carried.where("d < 0").select(key, (F.coalesce("piece", F.lit(0)) + 1).alias("piece"), F.col("t").alias("cut"), F.col("active").alias("left"))
    out = ends.join(opens, [key, "piece"], "left").join(starts, [key, "piece"], "left")
    # A piece that starts with two still active begins at the cut, one that starts with fewer where the second came.
    begin = F.when(F.coalesce("left", F.lit(0)) >= 2, F.col("cut")).otherwise(F.col("opened"))
    out = out.select(key, begin.alias("overlap_start"), "overlap_end", F.col("was").cast("long").alias("segment_count"))
    return out.where("overlap_end > overlap_start").withColumn("overlap_duration", F.round(F.col("overlap_end") - F.col("overlap_start"), 2))


def regressions(df: DataFrame, keys: list[str], start: str = "start_time", end: str = "end_time", tie: str | None = None) -> DataFrame:
    """Rows that start before the row before them ends: keys, previous_end, start, overlap."""
    w = Window.partitionBy(*keys).orderBy(start, tie or end)
    prev = df.withColumn("previous_end", F.lag(end).over(w))
    return prev.where(F.col("previous_end") > F.col(start)).withColumn("overlap", F.round(F.col("previous_end") - F.col(start), 2))


def adjacent(episode_a: Column, start_a: Column, end_a: Column, episode_b: Column, start_b: Column, end_b: Column, tolerance: float = 5.0) -> Column:
    """Whether two segments of one episode follow each other within the tolerance."""
    near = (F.abs(start_b - end_a) <= tolerance) | (F.abs(start_a - end_b) <= tolerance)
    return F.coalesce((episode_a == episode_b) & near, F.lit(False))


def time_bin(start: Column, seconds: float = 300.0) -> Column:
    return F.floor(start / seconds)
