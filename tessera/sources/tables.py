"""Readers of stored tables."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob has anything, in whatever store."""
    p, fs = _path(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def listing(spark: SparkSession, pattern: str) -> list[tuple[str, int, int]]:
    """(path, modification time, bytes) of what matches a glob."""
    p, fs = _path(spark, pattern)
    return sorted((s.getPath().toString(), s.getModificationTime(), s.getLen()) for s in (fs.globStatus(p) or []))


def latest(spark: SparkSession, pattern: str) -> str | None:
    """The most recently modified match."""
    found = listing(spark, pattern)
    return max(found, key=lambda x: (x[1], x[0]))[0] if found else None


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet table, pruned to columns. A path without a table is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(path)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def load_embeddings(spark: SparkSession, folder: str, artifact: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """Vectors of one artifact type, or of all; no rows if there are none."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schemas.EMBEDDING).select(*(columns or schemas.EMBEDDING.names))
    df = spark.read.parquet(folder)
    df = df.where(F.col("artifact_type") == artifact) if artifact else df
    return df.select(*columns) if columns else df


def row_count(spark: SparkSession, path: str) -> int | None:
    """Rows of a Parquet table, from its footers; None for other files."""
    if not path.rstrip("/").endswith(".parquet") and not exists(spark, f"{path}/*.parquet"):
        return None
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return spark.read.parquet(path).count()


def file_info(spark: SparkSession, path: str) -> dict:
    """Rows, columns, schema, files and bytes of a Parquet table."""
    df = spark.read.parquet(path)
    sizes = [x[2] for x in listing(spark, f"{path}/*.parquet") or listing(spark, path)]
    return {"rows": df.count(), "columns": len(df.columns), "schema": {f.name: f.dataType.simpleString() for f in df.schema}, "files": len(sizes), "bytes": sum(sizes)}


def lookup(spark: SparkSession, path: str, sql: str, **args) -> DataFrame:
    """SQL over a table, which it calls `t`, with named parameters."""
    spark.read.parquet(path).createOrReplaceTempView("t")
    return spark.sql(sql, args=args)


def load_latest(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The newest saved catalog of a name, by modification time."""
    path = latest(spark, f"{folder}/{name}_*.parquet")
    if path is None:
        raise FileNotFoundError(f"{folder}/{name}_*.parquet")
    return spark.read.parquet(path)


def embedding_info(spark: SparkSession, folder: str) -> dict:
    """The metadata beside stored vectors, with `exists`; nothing else where there are none."""
    if not exists(spark, f"{folder}/_info.json"):
        return {"exists": False}
    p, fs = _path(spark, f"{folder}/_info.json")
    stream = fs.open(p)
    try:
        body = bytes(x & 0xFF for x in stream.readAllBytes())
    finally:
        stream.close()
    return {"exists": True, **json.loads(body)}
