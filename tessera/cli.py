"""Command line: ingest, materialize, catalog, validate, quality, snapshot."""

import argparse
import json
import logging
import sys
import time

from pyspark.sql import SparkSession

from .config import Config
from .operators import catalogs, checks, rules
from .plans import assessor, manifest, pipeline, report, snapshot
from .plans.layout import SCHEMA_OF, Lake
from .sources import sinks, tables

log = logging.getLogger("tessera")


def session(name: str = "tessera") -> SparkSession:
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("tessera")
    p.add_argument("--lake", default="lake")
    p.add_argument("--config-dir")
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--log-file")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, *options: tuple, **kw) -> argparse.ArgumentParser:
        c = sub.add_parser(name, **kw)
        c.add_argument("--version", default="v1")
        for flags, opts in options:
            c.add_argument(*flags.split(), **opts)
        return c

    flag = {"action": "store_true"}
    command("ingest", ("path", {}), ("--pattern", {}), ("--dry-run", flag), ("--incremental", flag), ("--fail-on-invalid", flag), ("--update-catalog", flag))
    command("materialize", *[(f"--{s}-only", flag) for s in pipeline.STEPS], ("--all", flag))
    command("catalog", ("--catalog-type", {"choices": ["episodes", "speakers", "schema"], "default": "episodes"}), ("--output-format", {"choices": ["text", "json"], "default": "text"}), ("--save-catalog", flag), ("--output-dir", {}), ("--episode-id", {}), ("--speaker-name", {}), ("--rankings", {}), ("--statistics", flag))
    command("validate", ("--artifact-type", {"choices": sorted(SCHEMA_OF)}), ("--output-format", {"choices": ["text", "json"], "default": "text"}), ("--save-report", flag), ("--output-dir", {}), ("--detailed", flag), ("--fail-fast", flag))
    command("quality", ("--level", {"choices": ["spans", "beats", "all"], "default": "all"}), ("--output-dir", {"default": "quality"}), ("--sample-size", {"type": int}), ("--neighbor-k", {"type": int}), ("--coverage-min", {"type": float}), ("--span-length-min", {"type": float}), ("--span-length-max", {"type": float}), ("--beat-length-min", {"type": float}), ("--beat-length-max", {"type": float}), ("--no-timestamp", flag), ("--force-duplicate-check", flag))
    c = command("snapshot", ("--snapshot-root", {}), ("--snapshot-version", {}), ("--check", {"metavar": "PATH", "help": "validate a snapshot instead"}))
    c.add_argument("--qa-status", help="instead of the newest report's")
    c.add_argument("--qa-reports", default="quality")
    return p


def ingest(a, lake: Lake, config: Config) -> int:
    if a.dry_run:
        pipeline.dry_run(lake.spark, a.path, a.pattern).show(1000, False)
        return 0
    result = pipeline.ingest_into(lake.initialize(), a.path, a.pattern, a.version, not a.fail_on_invalid, a.incremental)
    result.show(1000, False)
    if a.update_catalog:
        _save(lake, "episodes", catalogs.episode_catalog(_utterances(lake, a.version)), None, ("parquet",))
    return int(not result.isEmpty() and result.where("success").isEmpty())


def _utterances(lake: Lake, version: str):
    from pyspark.sql import functions as F

    return lake.spark.read.parquet(lake.path("normalized", version)).withColumn("source_file", F.col("_metadata.file_path"))


def _save(lake: Lake, name: str, df, folder: str | None, formats: tuple[str, ...]) -> None:
    sinks.save_catalog(df, folder or lake.catalogs, name, time.strftime("%Y%m%d_%H%M%S"), formats)


def materialize(a, lake: Lake, config: Config) -> int:
    steps = tuple(s for s in pipeline.STEPS if getattr(a, f"{s}_only")) or pipeline.STEPS
    print(json.dumps(pipeline.materialize(lake, config, a.version, steps)))
    return 0


def catalog(a, lake: Lake, config: Config) -> int:
    if a.catalog_type == "schema":
        df = manifest.schema_manifest(lake, a.version)
    else:
        u = _utterances(lake, a.version)
        if a.catalog_type == "episodes":
            df = catalogs.episode_catalog(u)
            df = catalogs.episode_summary(u, a.episode_id) if a.episode_id else catalogs.episode_statistics(df) if a.statistics else df.orderBy("episode_id")
        else:
            df = catalogs.speaker_catalog(u)
            df = catalogs.speaker_summary(u, a.speaker_name) if a.speaker_name else catalogs.rankings(df, a.rankings) if a.rankings else catalogs.speaker_statistics(df) if a.statistics else df.orderBy("speaker_name")
    if a.save_catalog:
        _save(lake, a.catalog_type, df, a.output_dir, ("parquet", "json"))
    if a.output_format == "json":
        print("\n".join(df.toJSON().toLocalIterator()))
    else:
        df.show(1000, 80)
    return 0


def validate(a, lake: Lake, config: Config) -> int:
    routing = config.section("routing")
    router, worst, parts = checks.Router(routing) if routing else None, 0, []
    for folder in [a.artifact_type] if a.artifact_type else SCHEMA_OF:
        if not lake.exists(folder, a.version):
            continue
        found = checks.validate(lake.spark.read.parquet(lake.path(folder, a.version)), SCHEMA_OF[folder], router, folder).persist()
        parts.append(report.validation_json(found) if a.output_format == "json" else report.validation_text(found, folder, a.detailed))
        print(parts[-1])
        worst = max(worst, int(not checks.report_counts(found).first().is_valid))
        found.unpersist()
        if worst and a.fail_fast:
            break
    if a.save_report:
        sinks.write_text(lake.spark, f"{a.output_dir or lake.catalogs + '/validation_reports'}/{time.strftime('%Y%m%d_%H%M%S')}.txt", "\n".join(parts))
    return worst


def quality(a, lake: Lake, config: Config) -> int:
    from pyspark.sql import functions as F

    t = rules.Thresholds.from_dict(config.section("quality")).with_overrides(
        neighbor_sample_size=a.sample_size, neighbor_k=a.neighbor_k, coverage_min=a.coverage_min, span_length_min=a.span_length_min, span_length_max=a.span_length_max, beat_length_min=a.beat_length_min, beat_length_max=a.beat_length_max
    )
    spans, beats = (lake.spark.read.parquet(lake.path(x, a.version)) for x in ("spans", "beats"))
    episodes = catalogs.episode_catalog(_utterances(lake, a.version)).groupBy("episode_id").agg(F.max("end_time").alias("duration_seconds"))
    vectors = tables.load_embeddings(lake.spark, lake.path("embeddings", a.version))
    levels = ("spans", "beats") if a.level == "all" else (a.level,)
    found = assessor.Assessor(t, a.force_duplicate_check).run(episodes, spans, beats, vectors, levels)
    print(f"{found.status}: {report.save(found, lake.spark, a.output_dir, None if a.no_timestamp else time.strftime('%Y%m%d_%H%M%S'))}")
    return int(found.status == "RED")


def snapshots(a, lake: Lake, config: Config) -> int:
    if a.check:
        found = snapshot.validate(lake.spark, a.check)
        print(snapshot.validation_report(found))
        return int(not found["valid"])
    c = config.section("snapshot")
    v = c["version"]
    start = a.snapshot_version or snapshot.format_version((v["major"], v["minor"], v["patch"], v["suffix"]))
    print(snapshot.create(lake, a.snapshot_root or c["root"], start, a.version, c["auto_increment"], a.qa_status, a.qa_reports))
    return 0


COMMANDS = {"ingest": ingest, "materialize": materialize, "catalog": catalog, "validate": validate, "quality": quality, "snapshot": snapshots}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=a.log_level, filename=a.log_file, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    return COMMANDS[a.command](a, Lake(spark or session(), a.lake), Config(a.config_dir))


if __name__ == "__main__":
    sys.exit(main())
