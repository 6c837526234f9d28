"""The schema manifest: what artifacts a lake has, how full they are, and whether they comply."""

import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..sources import tables
from .layout import SCHEMA_OF, Lake

COLUMNS = (
    "artifact_type string, version string, location string, files_exist boolean, file_count int, row_count long, field_names string, schema_definition string,"
    "missing string, extra string, has_data boolean, data_completeness double, manifest_generated string"
)


def schema_manifest(lake: Lake, version: str = "v1") -> DataFrame:
    """A row for each artifact; completeness is its file count over the largest."""
    spark, rows = lake.spark, []
    for folder, artifact in SCHEMA_OF.items():
        path = lake.path(folder, version)
        files = tables.listing(spark, f"{path}/*.parquet") or tables.listing(spark, f"{path}/*/*.parquet")
        df = spark.read.parquet(path) if files else None
        lacking, extra = schemas.missing_and_extra(df.columns, artifact) if df is not None else ([], [])
        rows.append((folder, version, path, bool(files), len(files), df.count() if df is not None else 0, ", ".join(schemas.field_names(artifact)), json.dumps(schemas.field_types(artifact)), ", ".join(lacking), ", ".join(extra)))
    most = max((r[4] for r in rows), default=0) or 1
    now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
    return spark.createDataFrame([(*r, r[5] > 0, round(r[4] / most, 4), now) for r in rows], COLUMNS)


def schema_statistics(manifest: DataFrame) -> DataFrame:
    """Artifacts, those with files, files in all, their mean, most and fewest, and mean completeness."""
    return manifest.agg(
        F.count(F.lit(1)).alias("artifacts"), F.count_if("files_exist").alias("with_files"), F.sum("file_count").alias("files"), F.avg("file_count").alias("avg_files"),
        F.max("file_count").alias("most_files"), F.min("file_count").alias("fewest_files"), F.avg("data_completeness").alias("avg_completeness"),
    )


def file_compliance(lake: Lake, folder: str, version: str = "v1") -> DataFrame:
    """A row for each file of an artifact: columns missing and extra, by its own schema."""
    spark, artifact = lake.spark, SCHEMA_OF[folder]
    path = lake.path(folder, version)
    rows = []
    for file, *_ in tables.listing(spark, f"{path}/*.parquet") or tables.listing(spark, f"{path}/*/*.parquet"):
        lacking, extra = schemas.missing_and_extra(spark.read.option("basePath", path).parquet(file).columns, artifact)
        rows.append((file, not lacking, ", ".join(lacking), ", ".join(extra)))
    return spark.createDataFrame(rows, "file string, complies boolean, missing string, extra string")


def artifact_schema(artifact: str) -> list[dict]:
    """The fields of an artifact: name, type, whether it may be null."""
    return [{"name": f.name, "type": f.dataType.simpleString(), "nullable": f.nullable} for f in schemas.get_schema(artifact)]
