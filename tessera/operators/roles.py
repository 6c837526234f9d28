"""Speaker roles: enrichment of spans and beats."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = ("expert", "host", "guest", "caller", "other")


@dataclass(frozen=True)
class RoleConfig:
    """Who is an expert, further roles by name, and the role of everyone else."""

    experts: tuple[str, ...] = ()
    roles: dict[str, str] = field(default_factory=dict)
    default_role: str = "other"

    def __post_init__(self) -> None:
        for role in (*self.roles.values(), self.default_role):
            if role not in ROLES:
                raise ValueError(f"unknown role {role!r}; known: {', '.join(ROLES)}")

    def role_of(self, name: str | None) -> tuple[str, str, bool]:
        """Canonical name, role, whether an expert: the role table comes before the list of experts, then the default."""
        role = self.default_role if not name or not name.strip() else self.roles.get(name, "expert" if name in self.experts else self.default_role)
        return name or "", role, role == "expert"

    def table(self, spark: SparkSession) -> DataFrame:
        """A row for each named speaker."""
        names = sorted({*self.experts, *self.roles})
        return spark.createDataFrame([(n, self.role_of(n)[1]) for n in names], "role_name string, role string")


def enrich_spans(spans: DataFrame, config: RoleConfig) -> DataFrame:
    """spans with speaker_canonical, speaker_role and is_expert. The table is the size of the configuration, so it is broadcast."""
    out = spans.drop("speaker_canonical", "speaker_role", "is_expert").join(F.broadcast(config.table(spans.sparkSession)), F.col("speaker") == F.col("role_name"), "left")
    blank = F.coalesce(F.trim("speaker") == "", F.lit(True))
    role = F.when(blank, F.lit(config.default_role)).otherwise(F.coalesce("role", F.lit(config.default_role)))
    return out.withColumn("speaker_canonical", F.coalesce("speaker", F.lit(""))).withColumn("speaker_role", role).withColumn("is_expert", role == "expert").drop("role_name", "role")


def enrich_beats(beats: DataFrame, spans: DataFrame) -> DataFrame:
    """beats with speakers_set (in order of appearance), expert_span_ids and expert_coverage_pct; unknown span ids are skipped.

    Coverage weighs spans by token_count if any span of the beat has one, else by the length of the text."""
    tokens = F.col("token_count") if "token_count" in spans.columns else F.lit(None).cast("long")
    facts = spans.select("span_id", F.coalesce("speaker_canonical", "speaker").alias("who"), F.col("is_expert").alias("expert"), F.length("text").cast("long").alias("chars"), tokens.alias("tokens"))
    lines = beats.select("beat_id", F.posexplode("span_ids").alias("pos", "span_id")).join(facts, "span_id")
    row = F.struct("pos", "span_id", "who", "expert")
    total = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0)))
    expert = lambda c: F.sum(F.when(F.col("expert"), F.coalesce(F.col(c), F.lit(0))).otherwise(0))
    by = lines.groupBy("beat_id").agg(F.array_sort(F.collect_list(row)).alias("rows"), F.count("tokens").alias("counted"), total("tokens").alias("t"), expert("tokens").alias("te"), total("chars").alias("c"), expert("chars").alias("ce"))
    share = F.when(F.col("counted") > 0, F.when(F.col("t") > 0, F.col("te") / F.col("t"))).otherwise(F.when(F.col("c") > 0, F.col("ce") / F.col("c")))
    by = by.select(
        "beat_id", F.array_distinct(F.transform("rows", lambda r: r["who"])).alias("speakers_set"),
        F.transform(F.filter("rows", lambda r: r["expert"]), lambda r: r["span_id"]).alias("expert_span_ids"), (F.coalesce(share, F.lit(0.0)) * 100.0).alias("expert_coverage_pct"),
    )
    none = F.array().cast("array<string>")
    out = beats.drop("speakers_set", "expert_span_ids", "expert_coverage_pct").join(by, "beat_id", "left")
    return out.withColumns({"speakers_set": F.coalesce("speakers_set", none), "expert_span_ids": F.coalesce("expert_span_ids", none), "expert_coverage_pct": F.coalesce("expert_coverage_pct", F.lit(0.0))})
