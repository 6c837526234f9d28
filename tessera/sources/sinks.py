"""Writers of tables and reports."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import text


def write_table(df: DataFrame, path: str, artifact: str | None = None, overwrite: bool = False) -> str:
    """df, cast to its artifact's schema, as Parquet. An existing table is only replaced if asked for."""
    out = schemas.conform(df, artifact) if artifact else df
    out.write.mode("overwrite" if overwrite else "errorifexists").option("compression", "snappy").parquet(path)
    return path


def append_table(df: DataFrame, path: str, artifact: str | None = None) -> str:
    (schemas.conform(df, artifact) if artifact else df).write.mode("append").parquet(path)
    return path


def write_versioned(df: DataFrame, base: str, folder: str, version: str = "v1", artifact: str | None = None, overwrite: bool = True) -> str:
    """<base>/<folder>/<version>."""
    return write_table(df, f"{base}/{folder}/{version}", artifact, overwrite)


def write_embeddings(df: DataFrame, folder: str, overwrite: bool = True) -> dict:
    """Vectors by artifact type, and their metadata beside them."""
    schemas.conform(df, "embedding").write.mode("overwrite" if overwrite else "append").partitionBy("artifact_type").parquet(folder)
    stored = df.sparkSession.read.parquet(folder)
    rows = stored.groupBy("artifact_type").agg(F.count(F.lit(1)).alias("n"), F.first(F.size("embedding")).alias("d"), F.first("model_name").alias("m")).collect()
    meta = {"model_name": rows[0].m if rows else None, "dimension": rows[0].d if rows else 0, "total": sum(r.n for r in rows), "counts": {r.artifact_type: r.n for r in rows}}
    write_text(df.sparkSession, f"{folder}/_info.json", json.dumps(meta, indent=2))
    return meta


def write_text(spark: SparkSession, path: str, body: str) -> str:
    """A small file in any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(body.encode()))
    finally:
        stream.close()
    return path


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.format("text").option("wholetext", True).load(path).collect())


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path


def save_catalog(df: DataFrame, folder: str, name: str, stamp: str, formats: tuple[str, ...] = ("parquet",)) -> list[str]:
    """<folder>/<name>_<stamp>.parquet and / or .json."""
    made = []
    for f in formats:
        if f not in ("parquet", "json"):
            raise ValueError(f"unknown format {f!r}")
        made.append(write_table(df, f"{folder}/{name}_{stamp}.parquet", overwrite=True) if f == "parquet" else write_json(df, f"{folder}/{name}_{stamp}.json"))
    return made


#: Columns of the exports, in order; those that a table lacks are left out.
EPISODE_COLUMNS = ("episode_id", "title", "date", "duration_seconds", "span_count", "beat_count", "span_coverage_pct", "beat_coverage_pct", "gap_count", "gap_percent", "overlap_count", "overlap_percent")


def episodes_csv(per_episode: DataFrame, path: str) -> str:
    return write_csv(per_episode.select(*[c for c in EPISODE_COLUMNS if c in per_episode.columns]), path)


def segments_csv(segments: DataFrame, id_col: str, kind: str, duplicates: DataFrame, least: float, most: float, path: str) -> str:
    """Segments with flags for repeats and lengths out of bounds, and an excerpt."""
    twice = duplicates.select(F.col(id_col).alias("_d"))
    out = segments.join(twice, F.col(id_col) == F.col("_d"), "left").select(
        F.lit(kind).alias("segment_type"), F.col(id_col).alias("segment_id"), "episode_id", "start_time", "end_time", "duration", F.col("_d").isNotNull().alias("is_duplicate"),
        (F.col("duration") < least).alias("is_too_short"), (F.col("duration") > most).alias("is_too_long"), text.excerpt(F.col("text")).alias("excerpt"),
    )
    return write_csv(out, path)


def neighbours_csv(lists: DataFrame, path: str) -> str:
    """One row for each query and neighbour."""
    return write_csv(lists.select("query_id", "query_excerpt", F.explode("neighbors").alias("n")).select("query_id", "query_excerpt", "n.*"), path)
