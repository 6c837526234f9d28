"""Readers of raw transcripts: JSON lines and JSON, one file or a folder, as rows with their file and line.

Numbers are read as their literals too, since ids hash integers and decimals as they were written."""

import os
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

FIELDS = ("episode_id", "start", "end", "speaker", "text")
#: Each value as its raw JSON text, so that a string "5" and a number 5 differ.
_RAW = "map<string,string>"


def _typed(lines: DataFrame) -> DataFrame:
    """lines (source_file, line, value: a JSON object) as utterance rows; what isn't an object is dropped.

    A text field that isn't a JSON string, or a time that isn't a JSON number, is null; `present` lists the keys given."""
    known = lines.withColumn("keys", F.expr("json_object_keys(value)")).where("keys is not null")
    variant = known.withColumn("v", F.expr("try_parse_json(value)")).where("v is not null")

    def field(name: str):
        kind = F.expr(f"schema_of_variant(variant_get(v, '$.{name}', 'variant'))")
        literal = F.get_json_object("value", f"$.{name}")
        if name in ("start", "end"):
            number = kind.isin("BIGINT", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT") | kind.startswith("DECIMAL")
            return [F.when(number, F.expr(f"try_variant_get(v, '$.{name}', 'double')")).alias(name), F.when(number, literal).alias(f"{name}_literal")]
        return [F.when(kind == "STRING", literal).alias(name)]

    return variant.select("source_file", "line", *[c for n in FIELDS for c in field(n)], F.col("keys").alias("present"), F.col("value").alias("raw"))


def _whole(spark: SparkSession, path: str, pattern: str | None = None, skip: bool = False) -> DataFrame:
    reader = spark.read.option("wholetext", True).option("ignoreCorruptFiles", skip)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.format("text").load(path).select(F.col("_metadata.file_path").alias("source_file"), "value")


def read_jsonl(spark: SparkSession, path: str, pattern: str | None = None, skip: bool = False) -> DataFrame:
    """One object per line; blank and malformed lines are skipped. Lines count from 0. skip: so are files that can't be read."""
    lines = _whole(spark, path, pattern, skip).select("source_file", F.posexplode(F.split("value", "\r?\n")).alias("line", "value"))
    return _typed(lines.where(F.trim("value") != ""))


def read_json(spark: SparkSession, path: str, pattern: str | None = None, skip: bool = False) -> DataFrame:
    """A list of rows, an object with `utterances`, or one row; malformed files are an error, or skipped."""
    files = _whole(spark, path, pattern, skip)
    good = files.withColumn("_v", F.expr(f"{'try_' * skip}parse_json(value)"))  # fails on a malformed file
    if skip:
        good = good.where("_v is not null")
    kind = F.expr("schema_of_variant(_v)")
    rows = F.when(kind.startswith("ARRAY"), F.from_json("value", "array<string>")).when(F.expr("array_contains(json_object_keys(value), 'utterances')"), F.from_json(F.get_json_object("value", "$.utterances"), "array<string>")).otherwise(F.array("value"))
    return _typed(good.select("source_file", F.posexplode(rows).alias("line", "value")))


def is_jsonl(path: str, first_line: str | None = None) -> bool:
    """By suffix; otherwise whether the first line is a JSON value of its own."""
    if path.endswith((".jsonl", ".json")):
        return path.endswith(".jsonl")
    import json

    try:
        json.loads(first_line or "")
    except ValueError:
        return False
    return True


def read_transcript(spark: SparkSession, path: str) -> DataFrame:
    """One file, by its format."""
    first = None
    if not path.endswith((".jsonl", ".json")):
        head = spark.read.text(path).limit(1).collect()
        first = head[0][0] if head else None
    return read_jsonl(spark, path) if is_jsonl(path, first) else read_json(spark, path)


def read_directory(spark: SparkSession, folder: str, pattern: str = "*.jsonl") -> DataFrame:
    """All files of a folder that match, in one job; rows keep their file. Unreadable and malformed files are skipped."""
    return read_jsonl(spark, folder, pattern, skip=True) if pattern.endswith("jsonl") else read_json(spark, folder, pattern, skip=True)


def episode_ids(rows: DataFrame) -> DataFrame:
    """The episode of each file: its first row's, else the file's stem."""
    stem = F.regexp_extract(F.url_decode(F.regexp_replace("source_file", r"\+", "%2B")), r"([^/]*?)(\.[^./]*)?$", 1)
    return rows.groupBy("source_file").agg(F.min_by("episode_id", "line").alias("_first")).select("source_file", F.coalesce("_first", stem).alias("episode_id"))


def iterate(rows: DataFrame) -> Iterator[Row]:
    """Rows one by one, a partition at a time."""
    return rows.toLocalIterator()


def stem(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[0]
