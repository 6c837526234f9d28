"""Reports of an assessment and of table checks: Markdown, JSON, CSV, console."""

import json
import re

from pyspark.sql import DataFrame, SparkSession

from ..sources import sinks, tables
from .assessor import Assessment

#: What to do about the violations of a family.
ADVICE = {
    "coverage": "Look for episodes whose segments leave gaps, and lower the silence limit or the least span length.",
    "distribution": "Adjust the segment length rules, or the bounds that segments are held against.",
    "integrity": "Repair the source rows: order of times, empty fields, repeated segments.",
    "embedding": "Check whether vectors encode speaker, episode or length rather than content.",
}


def _table(rows: list[dict]) -> list[str]:
    if not rows:
        return ["(none)", ""]
    names = list(rows[0])
    return [f"| {' | '.join(names)} |", f"|{'---|' * len(names)}", *[f"| {' | '.join(str(r.get(n, '')) for n in names)} |" for r in rows], ""]


def _figures(m: dict) -> list[str]:
    return [f"- {k}: {v}" for k, v in m.items() if not isinstance(v, (dict, list))] + [""]


def bars(histogram: list[dict], width: int = 40) -> list[str]:
    """A histogram as text, its longest bar `width` characters."""
    most = max((r["count"] for r in histogram), default=0) or 1
    return [f"{r['low']:8.1f} - {r['high'] if r['high'] is not None else float('inf'):8.1f} | {'#' * round(width * r['count'] / most)} {r['count']}" for r in histogram]


def markdown(a: Assessment, title: str = "Quality assessment") -> str:
    """Summary, then a section for each family, violations with advice, and the thresholds used."""
    out = [f"# {title}", "", f"Status: {a.status}. {len(a.errors())} errors, {len(a.warnings())} warnings.", "", f"Go / no-go: {'no-go' if a.errors() else 'go with remarks' if a.warnings() else 'go'}.", ""]
    for name, m in a.metrics.items():
        out += [f"## {name.replace('_', ' ').capitalize()}", "", *_figures(m)]
        for k, v in m.items():
            if k == "histogram":
                out += ["```", *bars(v), "```", ""]
            elif isinstance(v, list):
                out += [f"### {k}", "", *_table(v)]
            elif isinstance(v, dict):
                out += [f"### {k}", "", *_figures(v)]
    out += ["## Violations", "", *_table(a.violations)]
    for family in dict.fromkeys(v["where"].split()[0] for v in a.violations):
        out += [f"- {family}: {ADVICE.get(family, '')}"]
    return "\n".join([*out, "", "## Thresholds", "", *_figures(a.thresholds.to_dict())])


def inconsistencies(a: Assessment) -> list[str]:
    """Totals that should agree and do not."""
    c, out = a.metrics.get("coverage", {}), []
    for level, n in (("spans", "span_count"), ("beats", "beat_count")):
        i = a.metrics.get(f"integrity_{level}")
        if i and i["total_segments"] != c.get(n):
            out.append(f"{level}: {i['total_segments']} rows, {c.get(n)} in episodes")
    return out


def save(a: Assessment, spark: SparkSession, folder: str, stamp: str | None = None) -> str:
    """<folder>/[<stamp>/]: report/quality_assessment.md, metrics/*.json and .csv, diagnostics/*.csv."""
    root = f"{folder}/{stamp}" if stamp else folder
    sinks.write_text(spark, f"{root}/report/quality_assessment.md", markdown(a))
    sinks.write_text(spark, f"{root}/metrics/global.json", json.dumps(a.to_dict(), indent=2, default=str))
    if "episodes" in a.tables:
        sinks.episodes_csv(a.tables["episodes"], f"{root}/metrics/episodes.csv")
    for name, df in a.tables.items():
        if name.startswith("outliers"):
            sinks.write_csv(df, f"{root}/diagnostics/{name}.csv")
        elif name.startswith("neighbors"):
            sinks.neighbours_csv(df, f"{root}/diagnostics/{name}.csv")
    return root


_STAMP = re.compile(r"\d{8}_\d{6}")
#: The status line of a Markdown report, with or without emphasis.
_STATUS = re.compile(r"status[\s:*_]*\b(GREEN|AMBER|RED|PASS|FAIL)\b", re.I)


def latest(spark: SparkSession, folder: str) -> str | None:
    """The report folder of the newest stamp (YYYYMMDD_HHMMSS) that holds a Markdown report."""
    found = [p for p, *_ in tables.listing(spark, f"{folder}/*/report/quality_assessment.md") if _STAMP.fullmatch(p.split("/")[-3])]
    return max(found, key=lambda p: p.split("/")[-3]).rsplit("/", 2)[0] if found else None


def status_of(spark: SparkSession, root: str) -> str:
    """GREEN, AMBER or RED of a saved report: its figures tell, else the status line of its Markdown; UNKNOWN without either."""
    if tables.exists(spark, f"{root}/metrics/global.json"):
        try:
            given = json.loads(sinks.read_text(spark, f"{root}/metrics/global.json"))
        except ValueError:
            given = None
        if isinstance(given, dict) and isinstance(given.get("status"), str):
            return given["status"].upper()
    text = sinks.read_text(spark, f"{root}/report/quality_assessment.md") if tables.exists(spark, f"{root}/report/quality_assessment.md") else ""
    if not (m := _STATUS.search(text)):
        return "UNKNOWN"
    return {"PASS": "GREEN", "FAIL": "RED"}.get(m[1].upper(), m[1].upper())


def validation_text(checks: DataFrame, name: str = "", detailed: bool = False) -> str:
    """Counts of one table's checks, the failed ones, and with detailed all of them."""
    rows = [r.asDict() for r in checks.collect()]
    failed = [r for r in rows if not r["passed"]]
    errors = sum(r["severity"] == "error" for r in failed)
    out = [f"{name or 'table'}: {len(rows) - len(failed)} of {len(rows)} checks passed, {errors} errors, {sum(r['severity'] == 'warning' for r in failed)} warnings: {'valid' if not errors else 'invalid'}"]
    return "\n".join([*out, *[f"  [{'ok' if r['passed'] else r['severity']}] {r['check']}: {r['message']}" for r in (rows if detailed else failed)]])


def validation_json(checks: DataFrame) -> str:
    return json.dumps([r.asDict() | {"details": json.loads(r.details)} for r in checks.collect()], indent=2)
