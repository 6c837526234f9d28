"""Ingestion and materialisation. Each step is one lazy plan over all files and episodes, written once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import ingest, roles, segment, vectors
from ..sources import sinks, tables, transcripts
from .layout import Lake


def ingest_rows(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Raw rows of a file or (with a pattern) a folder, with their errors."""
    rows = transcripts.read_directory(spark, path, pattern) if pattern else transcripts.read_transcript(spark, path)
    return ingest.with_errors(rows)


def dry_run(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Totals by file; nothing is written."""
    return ingest.validation_summary(ingest_rows(spark, path, pattern), "source_file")


def ingest_into(lake: Lake, path: str, pattern: str | None = None, version: str = "v1", skip_invalid: bool = True, incremental: bool = False) -> DataFrame:
    """Utterances of the files into the lake, and the raw rows beside them. Returns a row for each file.

    skip_invalid keeps the valid rows of every file; otherwise a file with any error fails and is left out. incremental
    leaves out episodes that are stored, and adds to the table; without it the table is replaced."""
    spark = lake.spark
    rows = ingest_rows(spark, path, pattern)
    stored = lake.path("normalized", version)
    old = incremental and tables.exists(spark, stored)
    if old:
        rows = ingest.new_episodes(rows, spark.read.parquet(stored))
    rows = rows.persist()
    result = ingest.validation_summary(rows, "source_file")
    result = result.withColumn("success", F.lit(True) if skip_invalid else F.col("invalid") == 0)
    kept = ingest.valid_rows(rows if skip_invalid else rows.join(result.where("not success"), "source_file", "left_anti"))
    normal = ingest.normalise(kept)
    (sinks.append_table if old else lambda d, p, a: sinks.write_table(d, p, a, True))(normal, stored, "utterance")
    rows.select("source_file", "line", "raw").write.mode("append" if old else "overwrite").parquet(lake.raw)
    out = spark.createDataFrame(result.collect(), result.schema)  # a row for each file
    rows.unpersist()
    return out


def span_rules(c: Config) -> segment.SpanRules:
    s = c.section("aggregation")["spans"]
    return segment.SpanRules(s["min_duration"], s["max_silence_gap"], s["break_on_speaker_change"])


def beat_rules(c: Config) -> segment.BeatRules:
    b = c.section("aggregation")["beats"]
    return segment.BeatRules(b["similarity_threshold"], b["min_spans_per_beat"], b["max_spans_per_beat"], b["use_embeddings"])


def section_rules(c: Config) -> segment.SectionRules:
    s = c.section("aggregation")["sections"]
    return segment.SectionRules(
        s["target_duration_minutes"], s["min_duration_minutes"], s["max_duration_minutes"], s["allow_semantic_overflow"], s["boundary_similarity_threshold"],
        s["strong_boundary_multiplier"], s["semantic_check_multiplier"], s["prefer_time_boundaries"], s["require_embeddings"],
    )


def role_config(c: Config) -> roles.RoleConfig:
    r = c.section("speaker_roles")
    return roles.RoleConfig(tuple(r.get("experts") or ()), r.get("roles") or {}, r.get("default_role") or "other")


def make_model(c: Config) -> vectors.Provider:
    m, f = c.section("embedding")["model"], c.section("embedding")["fallback"]
    first = vectors.provider(m["provider"], **({"name": m["name"]} if m.get("name") and m["provider"] != "hashing" else {}))
    return vectors.working(first, vectors.provider(f["provider"]) if f.get("enabled") else None)


STEPS = ("spans", "beats", "embeddings", "sections", "index")


def materialize(lake: Lake, config: Config, version: str = "v1", steps: tuple[str, ...] = STEPS) -> dict[str, int]:
    """The hierarchy from the stored utterances: spans, beats, their vectors, sections, the index, as far as asked for.

    Vectors come before sections, which use those of their beats."""
    spark, made = lake.spark, {}
    read = lambda a: spark.read.parquet(lake.path(a, version))
    c = config.section("aggregation")
    if "spans" in steps:
        spans = segment.within_guardrail(segment.make_spans(read("normalized"), span_rules(config)), c["spans"]["max_duration"])
        made["spans"] = _write(lake, roles.enrich_spans(spans, role_config(config)), "spans", version, "span")
    if "beats" in steps:
        spans = read("spans")
        beats = segment.within_guardrail(segment.make_beats(spans, beat_rules(config)), c["beats"]["max_duration"])
        made["beats"] = _write(lake, roles.enrich_beats(beats, spans), "beats", version, "beat")
    if "embeddings" in steps:
        model = make_model(config)
        both = vectors.generate(read("spans"), "span", model).unionByName(vectors.generate(read("beats"), "beat", model))
        made["embeddings"] = sinks.write_embeddings(both, lake.path("embeddings", version))["total"]
    if "sections" in steps:
        rules = section_rules(config)
        beats = read("beats")
        found = tables.load_embeddings(spark, lake.path("embeddings", version), "beat")
        if rules.require_embeddings or tables.exists(spark, lake.path("embeddings", version)):
            beats = segment.with_vectors(beats, found, rules.require_embeddings)
        made["sections"] = _write(lake, segment.make_sections(beats, rules), "sections", version, "section")
    if "index" in steps:
        index = vectors.build_index(tables.load_embeddings(spark, lake.path("embeddings", version)))
        made["index"] = _write(lake, index, "ann_index", version, None)
    return made


def _write(lake: Lake, df: DataFrame, folder: str, version: str, artifact: str | None) -> int:
    path = sinks.write_versioned(df, lake.root, folder, version, artifact)
    return tables.row_count(lake.spark, path) or 0
