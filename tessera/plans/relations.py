"""Transcript relations derived from the driver's tables, the same way in Spark and in SQL.

Lengths are sixteenths and gaps quarters of a second, so that sums of times are exact in any order."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of conversations: an episode for each conversation, a speaker for each role."""
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("speaker"), F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    lines = lines.where(F.trim("text") != "").withColumn("line", F.col("pos") + 1)
    gap = F.when((F.col("turn") % 5 == 4) & (F.col("line") == 1), 6.0).when(F.col("line") % 4 == 0, 0.75).otherwise(0.25)
    lines = lines.withColumn("duration", F.length("text") / 16.0).withColumn("gap", gap)
    lines = lines.withColumn("utterance_id", F.concat_ws("-", F.col("conv_id").cast("string"), F.lpad(F.col("turn").cast("string"), 4, "0"), F.lpad(F.col("line").cast("string"), 6, "0")))
    w = Window.partitionBy("conv_id").orderBy("turn", "line").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("end", F.sum(F.col("gap") + F.col("duration")).over(w))
    return lines.select("utterance_id", F.col("conv_id").cast("string").alias("episode_id"), (F.col("end") - F.col("duration")).alias("start"), "end", "speaker", "text", "duration", F.concat(F.lit("part-"), (F.col("conv_id") % 4).cast("string")).alias("source_file"))


UTTERANCES = r"""l as (select conv_id, turn, role, string_split(text, chr(10)) as a from conversations),
l1 as (select conv_id, turn, role, a, unnest(range(1, len(a) + 1)) as line from l),
l2 as (select conv_id, turn, role, a[line] as text, line, length(a[line]) / 16.0::double as duration,
  case when turn % 5 = 4 and line = 1 then 6.0::double when line % 4 = 0 then 0.75::double else 0.25::double end as gap from l1 where trim(a[line]) <> ''),
l3 as (select *, sum(gap + duration) over (partition by conv_id order by turn, line rows unbounded preceding) as "end" from l2),
u as (select conv_id::varchar || '-' || lpad(turn::varchar, 4, '0') || '-' || lpad(line::varchar, 6, '0') as utterance_id, conv_id::varchar as episode_id, "end" - duration as start, "end", role as speaker, text, duration, 'part-' || (conv_id % 4)::varchar as source_file from l3)"""


def intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping and gapped intervals from events: an episode for each user; times in microseconds are exact, in seconds they are doubles."""
    e = table(spark, sf_dir, "events")
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts as timestamp_ntz))")
    start = (micros / 1000000.0).cast("double")
    e = e.select(F.col("event_id").alias("segment_id"), F.col("user_id").alias("episode_id"), F.col("event_type").alias("speaker"), start.alias("start_time"), F.round(F.col("value") * 60).alias("len"), F.coalesce("props", F.lit("")).alias("text"))
    return e.withColumn("end_time", F.col("start_time") + F.col("len")).drop("len")


INTERVALS = r"""iv as (select event_id as segment_id, user_id as episode_id, event_type as speaker, epoch_us(ts) / 1000000.0::double as start_time,
  epoch_us(ts) / 1000000.0::double + round(value * 60) as end_time, coalesce(props, '') as text from events)"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text segments: an episode for each source, a speaker for each language."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("segment_id"), F.col("source").alias("episode_id"), F.col("lang").alias("speaker"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with a group, and times for adjacency: vec_id seconds apart, of sizes that differ."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("artifact_id"), "embedding", F.col("label").alias("speaker"))
    e = e.withColumn("episode_id", F.col("artifact_id") % 9).withColumn("start_time", F.col("artifact_id").cast("double"))
    return e.withColumn("end_time", F.col("start_time") + (F.col("artifact_id") % 7 + 1)).withColumn("duration", F.col("end_time") - F.col("start_time"))


VECTORS = r"""e as (select vec_id as artifact_id, embedding::double[] as v, label as speaker, vec_id % 9 as episode_id, vec_id::double as start_time, vec_id + vec_id % 7 + 1.0::double as end_time, (vec_id % 7 + 1)::double as duration from embeddings)"""
