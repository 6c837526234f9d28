"""Catalogs of episodes and speakers."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def episode_catalog(utterances: DataFrame, file_col: str = "source_file") -> DataFrame:
    """A row for each file and episode. avg_utterance_duration is the wall span over the count."""
    by = utterances.groupBy(file_col, "episode_id").agg(
        F.min("start").alias("start_time"), F.max("end").alias("end_time"), F.count(F.lit(1)).alias("utterance_count"), F.count_distinct("speaker").alias("speaker_count"),
        F.array_join(F.array_sort(F.collect_set("speaker")), ", ").alias("speaker_list"),
    )
    out = by.withColumn("duration", F.col("end_time") - F.col("start_time"))
    return out.withColumns({
        "title": text.title_of(F.col("episode_id")), "date": text.date_of(F.col("episode_id")), "duration_minutes": F.round(F.col("duration") / 60, 2),
        "avg_utterance_duration": F.round(F.col("duration") / F.col("utterance_count"), 2),
    })


def episode_summary(utterances: DataFrame, episode_id: str) -> DataFrame:
    """One episode, with the mean of its utterances' own durations."""
    one = utterances.where(F.col("episode_id") == episode_id)
    return one.groupBy("episode_id").agg(
        F.min("start").alias("start_time"), F.max("end").alias("end_time"), F.count(F.lit(1)).alias("utterance_count"), F.count_distinct("speaker").alias("speaker_count"),
        F.avg(F.col("end") - F.col("start")).alias("avg_duration"),
    )


def speaker_by_file(utterances: DataFrame, file_col: str = "source_file") -> DataFrame:
    """The first level: a row for each file and speaker."""
    length = F.col("end") - F.col("start")
    return utterances.groupBy(file_col, "speaker").agg(
        F.count_distinct("episode_id").alias("episodes"), F.count(F.lit(1)).alias("utterances"), F.sum(length).alias("total"), F.avg(length).alias("mean"),
        F.min(length).alias("least"), F.max(length).alias("most"), F.collect_set("episode_id").alias("ids"),
    )


def speaker_catalog(utterances: DataFrame, file_col: str = "source_file") -> DataFrame:
    """A row for each speaker over all files: sums of the files' figures, the mean of their means, and the weighted mean.

    An episode in two files counts twice. Participation is episodes over the number of files."""
    level = speaker_by_file(utterances, file_col)
    n = utterances.agg(F.count_distinct(file_col)).first()[0]
    out = level.groupBy(F.col("speaker").alias("speaker_name")).agg(
        F.sum("episodes").alias("episode_count"), F.sum("utterances").alias("total_utterances"), F.sum("total").alias("total_duration"), F.avg("mean").alias("avg_duration"),
        F.min("least").alias("min_duration"), F.max("most").alias("max_duration"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), ", ").alias("episode_list"),
    )
    return out.withColumns({
        "weighted_avg_duration": F.col("total_duration") / F.col("total_utterances"), "total_minutes": F.round(F.col("total_duration") / 60, 2), "total_hours": F.round(F.col("total_duration") / 3600, 2),
        "utterance_frequency": F.round(F.col("total_utterances") / F.col("episode_count"), 2), "participation": F.round(F.col("episode_count") / F.lit(max(n, 1)), 4),
    })


def speaker_summary(utterances: DataFrame, speaker: str) -> DataFrame:
    """One speaker over all files."""
    length = F.col("end") - F.col("start")
    return utterances.where(F.col("speaker") == speaker).groupBy("speaker").agg(
        F.count_distinct("episode_id").alias("episodes"), F.count(F.lit(1)).alias("utterances"), F.sum(length).alias("total_duration"), F.avg(length).alias("avg_duration"), F.min(length).alias("min_duration"), F.max(length).alias("max_duration")
    )


def rankings(catalog: DataFrame, metric: str = "total_duration", limit: int = 10) -> DataFrame:
    """The first speakers by a metric, ties by name, with their rank."""
    top = catalog.orderBy(F.desc(metric), "speaker_name").limit(limit)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(metric), "speaker_name")))


def episode_statistics(catalog: DataFrame) -> DataFrame:
    names = catalog.select(F.explode(F.split("speaker_list", ", ")).alias("s")).agg(F.count_distinct("s").alias("distinct_speakers"))
    figures = catalog.agg(
        F.count(F.lit(1)).alias("episodes"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"), F.avg("duration").alias("avg_duration"), F.min("duration").alias("min_duration"),
        F.max("duration").alias("max_duration"), F.coalesce(F.sum("utterance_count"), F.lit(0)).alias("total_utterances"), F.avg("utterance_count").alias("avg_utterances"),
    )
    return figures.withColumn("_k", F.lit(1)).join(names.withColumn("_k", F.lit(1)), "_k").drop("_k")


def speaker_statistics(catalog: DataFrame) -> DataFrame:
    by = lambda c: F.max_by("speaker_name", F.struct(F.col(c), F.col("speaker_name")))
    return catalog.agg(
        F.count(F.lit(1)).alias("speakers"), F.coalesce(F.sum("total_duration"), F.lit(0.0)).alias("total_duration"), F.avg("total_duration").alias("avg_duration"),
        F.max("total_duration").alias("max_duration"), F.coalesce(F.sum("total_utterances"), F.lit(0)).alias("total_utterances"), by("total_utterances").alias("most_active"), by("episode_count").alias("most_frequent"),
    )
