"""Validation and normalisation of raw utterances. Times come as doubles, and as their literals for the ids."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.numbers import missing

REQUIRED = ("episode_id", "start", "end", "speaker", "text")
ERROR = "struct<error_type:string,message:string,field:string>"


def _error(kind: str, message, field: str):
    return F.struct(F.lit(kind).alias("error_type"), (F.lit(message) if isinstance(message, str) else message).alias("message"), F.lit(field).alias("field"))


def with_errors(rows: DataFrame) -> DataFrame:
    """rows with `errors`, an array of (error_type, message, field) in the order of the rules.

    Absent fields end the list. `present` (array of keys) tells null from absent; without it null counts as absent."""
    keys = F.col("present") if "present" in rows.columns else F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in REQUIRED]))
    absent = F.transform(F.filter(F.lit(list(REQUIRED)), lambda f: ~F.array_contains(keys, f)), lambda f: F.struct(F.lit("missing_field").alias("error_type"), F.concat(F.lit("Required field '"), f, F.lit("' is missing")).alias("message"), f.alias("field")))
    blank = lambda c: F.coalesce(F.regexp_replace(c, r"(?U)\s", "") == "", F.lit(True))
    rules = [F.when(blank(F.col("episode_id")), _error("invalid_episode_id", "episode_id must be a non-empty string", "episode_id"))]
    for f in ("start", "end"):
        c = F.col(f)
        rules.append(F.when(missing(c), _error("invalid_timestamp", f"{f} must be a number", f)).when(c < 0, _error("negative_timestamp", F.concat(F.lit(f"{f} must be non-negative, got "), c.cast("string")), f)))
    rules += [
        F.when(F.col("end") <= F.col("start"), _error("invalid_time_range", F.concat(F.lit("end ("), F.col("end").cast("string"), F.lit(") must be greater than start ("), F.col("start").cast("string"), F.lit(")")), "end")),
        F.when(blank(F.col("speaker")), _error("invalid_speaker", "speaker must be a non-empty string", "speaker")),
        F.when(F.col("text").isNull(), _error("invalid_text", "text must be a string", "text")).when(blank(F.col("text")), _error("empty_text", "text must not be empty", "text")),
    ]
    return rows.withColumn("_absent", absent).withColumn("errors", F.when(F.size("_absent") > 0, F.col("_absent")).otherwise(F.array_compact(F.array(*rules)))).drop("_absent")


def validation_summary(checked: DataFrame, *by: str) -> DataFrame:
    """Rows, valid rows, invalid rows and errors, in all or by columns."""
    ok = F.size("errors") == 0
    return checked.groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"), F.coalesce(F.sum(F.size("errors")), F.lit(0)).cast("long").alias("errors"))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("errors") == 0).drop("errors")


def normalise(rows: DataFrame, tie: str = "line") -> DataFrame:
    """Valid rows in order of start (then tie) within their episode: position, duration and id; other columns are carried."""
    w = Window.partitionBy("episode_id").orderBy("start", tie)
    literal = [F.col(f"{f}_literal") if f"{f}_literal" in rows.columns else None for f in ("start", "end")]
    out = rows.withColumn("position", (F.row_number().over(w) - 1).cast("long")).withColumn("duration", F.col("end") - F.col("start"))
    made = identity.utterance_id(F.col("episode_id"), F.col("position"), F.col("text"), F.col("speaker"), F.col("start"), F.col("end"), *literal)
    return out.withColumn("utterance_id", made)


def single_episode(rows: DataFrame) -> DataFrame:
    """rows, or an error if they are of more than one episode (one aggregate tells)."""
    low, high = rows.agg(F.min("episode_id"), F.max("episode_id")).first()
    if low != high:
        raise ValueError("utterances of more than one episode")
    return rows


def new_episodes(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of episodes that aren't stored yet."""
    return rows.join(stored.select("episode_id").distinct(), "episode_id", "left_anti")
