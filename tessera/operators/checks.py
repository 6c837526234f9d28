"""Table checks. Each gives rows check, passed, severity, message, details (a JSON text); a table's figures come from one pass."""

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.numbers import missing

COLUMNS = "check string, passed boolean, severity string, message string, details string"
TIMES = ("start", "end", "start_time", "end_time")
CHILDREN = {"span": "utterance_ids", "beat": "span_ids", "section": "beat_ids"}


def _rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame([(n, p, s, m, json.dumps(d, sort_keys=True)) for n, p, s, m, d in rows], COLUMNS)


def profile(df: DataFrame) -> dict[str, object]:
    """Every figure that the checks need, as one aggregate."""
    kinds = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in TIMES:
        if c in kinds:
            aggs += [F.count_if(missing(F.col(c).cast("double"))).alias(f"null:{c}"), F.count_if(F.col(c) < 0).alias(f"negative:{c}")]
    for s, e in (("start", "end"), ("start_time", "end_time")):
        if s in kinds and e in kinds:
            aggs.append(F.count_if(F.col(s) > F.col(e)).alias(f"order:{s}"))
    if "text" in kinds:
        n = F.length("text")
        aggs += [F.count_if(F.col("text").isNull()).alias("null:text"), F.count_if(F.trim("text") == "").alias("empty:text"), F.min(n).alias("min:text"), F.max(n).alias("max:text"), F.avg(n).alias("mean:text")]
    for c in kinds:
        if c.endswith("_id"):
            aggs += [F.count_if(F.col(c).isNull()).alias(f"null:{c}"), F.count_distinct(c).alias(f"distinct:{c}")]
        if c in CHILDREN.values():
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"null:{c}"))
        if kinds[c] in ("double", "float"):
            aggs += [F.count_if(missing(F.col(c))).alias(f"nan:{c}"), F.count_if(F.abs(c) == float("inf")).alias(f"inf:{c}")]
    return df.agg(*aggs).first().asDict()


def check_non_empty(p: dict) -> list[tuple]:
    return [("non_empty", p["rows"] > 0, "error", f"{p['rows']} rows", {"rows": p["rows"]})]


def check_required_fields(columns: list[str], artifact: str) -> list[tuple]:
    lacking = schemas.missing_and_extra(columns, artifact)[0]
    return [("required_fields", not lacking, "error", f"missing: {', '.join(lacking)}" if lacking else "all present", {"missing": lacking})]


def check_schema(columns: list[str], artifact: str) -> list[tuple]:
    lacking, extra = schemas.missing_and_extra(columns, artifact)
    return [("schema_compliance", not lacking, "error", "complies" if not lacking else "does not comply", {"missing": lacking, "extra": extra})]


def check_timestamps(p: dict) -> list[tuple]:
    out = []
    for c in TIMES:
        if f"negative:{c}" in p:
            out += [(f"timestamp_nulls_{c}", not p[f"null:{c}"], "error", f"{p[f'null:{c}']} null values", {"count": p[f"null:{c}"]}), (f"timestamp_negative_{c}", not p[f"negative:{c}"], "error", f"{p[f'negative:{c}']} negative values", {"count": p[f"negative:{c}"]})]
    out += [("timestamp_order", not p[k], "error", f"{p[k]} rows start after they end", {"count": p[k]}) for k in p if k == "order:start_time"]
    return out


def check_text(p: dict) -> list[tuple]:
    if "null:text" not in p:
        return []
    lengths = {k: p[f"{k}:text"] for k in ("min", "max", "mean")}
    return [("text_nulls", not p["null:text"], "error", f"{p['null:text']} null texts", {"count": p["null:text"]}), ("text_empty", not p["empty:text"], "warning", f"{p['empty:text']} empty texts", {"count": p["empty:text"]}), ("text_length", True, "info", "lengths", lengths)]


def check_ids(p: dict, artifact: str) -> list[tuple]:
    """Nulls in each id column; repeats in the table's own (null repeats too); distinct values of the others."""
    out = []
    for k in [k for k in p if k.startswith("distinct:")]:
        c = k[9:]
        out.append((f"id_nulls_{c}", not p[f"null:{c}"], "error", f"{p[f'null:{c}']} null ids", {"count": p[f"null:{c}"]}))
        if c == f"{artifact}_id":
            twice = p["rows"] - p[k] - (1 if p[f"null:{c}"] else 0)
            out.append((f"id_duplicates_{c}", not twice, "error", f"{twice} repeated ids", {"count": twice}))
        else:
            out.append((f"id_references_{c}", True, "info", f"{p[k]} distinct values", {"distinct": p[k]}))
    return out


def check_references(p: dict, artifact: str) -> list[tuple]:
    c = CHILDREN.get(artifact)
    return [("referential_integrity", not p[f"null:{c}"], "error", f"{p[f'null:{c}']} rows without {c}", {"count": p[f"null:{c}"]})] if f"null:{c}" in p else []


def check_numbers(p: dict) -> list[tuple]:
    out = []
    for k in [k for k in p if k.startswith("nan:")]:
        c = k[4:]
        out += [(f"numeric_nan_{c}", not p[k], "warning", f"{p[k]} missing values", {"count": p[k]}), (f"numeric_inf_{c}", not p[f"inf:{c}"], "error", f"{p[f'inf:{c}']} infinite values", {"count": p[f"inf:{c}"]})]
    return out


def dangling(parents: DataFrame, children_col: str, children: DataFrame, id_col: str) -> DataFrame:
    """Child ids that no child has: a real look-up, beyond the check for null lists."""
    return parents.select(F.explode(children_col).alias(id_col)).join(children.select(id_col), id_col, "left_anti").distinct()


ROUTED = {"timestamps": "timestamp_validity", "text": "text_quality", "ids": "id_join_back", "references": "referential_integrity", "numbers": "numeric_quality"}


def validate(df: DataFrame, artifact: str, router: "Router | None" = None, table: str | None = None) -> DataFrame:
    """All checks of one table: three general ones, and those that the router wants for it (without one: all)."""
    columns = df.columns
    p = profile(df)
    wanted = lambda k: router is None or router.runs(table or f"{artifact}s", ROUTED[k])
    out = check_non_empty(p) + check_required_fields(columns, artifact) + check_schema(columns, artifact)
    out += check_timestamps(p) if wanted("timestamps") else []
    out += check_text(p) if wanted("text") else []
    out += check_ids(p, artifact) if wanted("ids") else []
    out += check_references(p, artifact) if wanted("references") else []
    out += check_numbers(p) if wanted("numbers") else []
    return _rows(df.sparkSession, out)


def report_counts(checks: DataFrame, *by: str) -> DataFrame:
    """Checks, passed and failed ones, errors and warnings among the failed, and whether the table is valid (no failed error)."""
    failed = ~F.col("passed")
    errors = F.count_if(failed & (F.col("severity") == "error"))
    return checks.groupBy(*by).agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("passed").alias("passed"), F.count_if(failed).alias("failed"), errors.alias("errors"),
        F.count_if(failed & (F.col("severity") == "warning")).alias("warnings"), (errors == 0).alias("is_valid"),
    )


class Router:
    """Which checks run on which table. An unknown table gets all of them."""

    def __init__(self, config: dict) -> None:
        self.tables, self.needs = config.get("tables") or {}, config.get("check_requirements") or {}
        for name, t in self.tables.items():
            if not isinstance(t, dict) or "role" not in t or not isinstance(t.get("checks"), list):
                raise ValueError(f"table {name!r} needs a role and a list of checks")

    def runs(self, table: str, check: str) -> bool:
        return table not in self.tables or check in self.tables[table]["checks"]

    def role(self, table: str) -> str | None:
        return (self.tables.get(table) or {}).get("role")

    def checks(self, table: str) -> list[str]:
        return list((self.tables.get(table) or {}).get("checks") or [])

    def fits(self, table: str, check: str, columns: list[str]) -> tuple[bool, str]:
        """Whether the table has the columns that the check needs, and why not."""
        lacking = [c for c in (self.needs.get(check) or {}).get("required_columns", []) if c not in columns]
        return not lacking, f"missing columns: {', '.join(lacking)}" if lacking else ""

    def summary(self) -> dict[str, dict]:
        return {t: {"role": self.role(t), "checks": self.checks(t)} for t in self.tables}


