"""Thresholds as rules over metric tables, violations, and the red/amber/green status."""

from dataclasses import asdict, dataclass, fields, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Thresholds:
    """Every tunable of the assessment. from_dict takes them flat or by group; unknown keys are ignored."""

    coverage_min: float = 95.0
    gap_max_percent: float = 2.0
    overlap_max_percent: float = 2.0
    span_length_min: float = 20.0
    span_length_max: float = 120.0
    span_length_compliance_min: float = 90.0
    beat_length_min: float = 60.0
    beat_length_max: float = 180.0
    beat_length_compliance_min: float = 90.0
    timestamp_regressions_max: int = 0
    negative_duration_max: int = 0
    exact_duplicate_max_percent: float = 1.0
    near_duplicate_max_percent: float = 3.0
    near_duplicate_threshold: float = 0.95
    same_speaker_neighbor_max_percent: float = 60.0
    same_episode_neighbor_max_percent: float = 70.0
    length_bias_correlation_max: float = 0.3
    adjacency_bias_max_percent: float = 40.0
    adjacency_tolerance_seconds: float = 5.0
    neighbor_sample_size: int = 100
    neighbor_k: int = 10
    random_pairs_sample_size: int = 500
    outlier_count: int = 20
    neighbor_list_sample_size: int = 30
    top_speakers_count: int = 10
    random_seed: int = 42

    @classmethod
    def from_dict(cls, config: dict) -> "Thresholds":
        flat: dict = {}
        for k, v in config.items():
            flat.update(v if isinstance(v, dict) else {k: v})
        return cls(**{k: v for k, v in flat.items() if k in {f.name for f in fields(cls)}})

    def with_overrides(self, **values) -> "Thresholds":
        """Values that are None override nothing."""
        return replace(self, **{k: v for k, v in values.items() if v is not None})

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Rule:
    """Holds a metric column against a limit: `broken` says when the rule is violated."""

    name: str
    metric: str
    limit: float
    severity: str = "error"
    sense: str = "<="
    message: str = ""

    def broken(self) -> Column:
        c = F.abs(self.metric) if self.sense == "abs<=" else F.col(self.metric)
        return c < self.limit if self.sense == ">=" else c > self.limit


VIOLATION = "rule string, expected string, actual double, severity string, message string"


def violations(metrics: DataFrame, rules: list[Rule], *carry: str) -> DataFrame:
    """A row for each violated rule of each metrics row, with the columns to carry. Null metrics violate nothing."""
    made = [
        F.when(x.broken(), F.struct(F.lit(x.name).alias("rule"), F.lit(f"{x.sense} {x.limit:g}").alias("expected"), F.col(x.metric).cast("double").alias("actual"), F.lit(x.severity).alias("severity"), F.lit(x.message or f"{x.metric} violates {x.sense} {x.limit:g}").alias("message")))
        for x in rules if x.metric in metrics.columns
    ]
    if not made:
        return metrics.sparkSession.createDataFrame([], VIOLATION)
    return metrics.select(*carry, F.explode(F.array_compact(F.array(*made))).alias("v")).select(*carry, "v.*")


def coverage_rules(t: Thresholds) -> list[Rule]:
    return [Rule("coverage_min_global_spans", "span_coverage_pct", t.coverage_min, "error", ">="), Rule("coverage_min_global_beats", "beat_coverage_pct", t.coverage_min, "error", ">=")]


def episode_rules(t: Thresholds) -> list[Rule]:
    return [Rule("coverage_min_episode", "span_coverage_pct", t.coverage_min, "warning", ">="), Rule("gap_max_percent", "gap_percent", t.gap_max_percent, "warning"), Rule("overlap_max_percent", "overlap_percent", t.overlap_max_percent, "warning")]


def length_rules(kind: str, t: Thresholds) -> list[Rule]:
    """For spans or beats, in the singular or plural."""
    kind = kind.rstrip("s")
    return [Rule(f"{kind}_length_compliance_min", "within_pct", getattr(t, f"{kind}_length_compliance_min"), "error", ">=")]


def integrity_rules(t: Thresholds) -> list[Rule]:
    return [
        Rule("timestamp_regressions_max", "episode_regression_count", t.timestamp_regressions_max), Rule("speaker_timestamp_regressions_max", "speaker_regression_count", t.timestamp_regressions_max),
        Rule("negative_duration_max", "negative_duration_count", t.negative_duration_max), Rule("zero_duration_max", "zero_duration_count", t.negative_duration_max, "warning"),
        Rule("exact_duplicate_max_percent", "exact_duplicate_percent", t.exact_duplicate_max_percent), Rule("near_duplicate_max_percent", "near_duplicate_percent", t.near_duplicate_max_percent, "warning"),
        Rule("missing_episode_id", "missing_episode_id_count", 0), Rule("missing_speaker", "missing_speaker_count", 0, "warning"), Rule("missing_text", "missing_text_count", 0),
    ]


def leakage_rules(t: Thresholds) -> list[Rule]:
    return [Rule("same_speaker_neighbor_max_percent", "speaker_leakage_pct", t.same_speaker_neighbor_max_percent, "warning"), Rule("same_episode_neighbor_max_percent", "episode_leakage_pct", t.same_episode_neighbor_max_percent, "warning")]


def bias_rules(t: Thresholds) -> list[Rule]:
    return [
        Rule("length_bias_norm_correlation", "norm_corr", t.length_bias_correlation_max, "warning", "abs<="), Rule("length_bias_similarity_correlation", "similarity_corr", t.length_bias_correlation_max, "warning", "abs<="),
        Rule("adjacency_bias_max_percent", "adjacency_pct", t.adjacency_bias_max_percent, "warning"),
    ]


def status(found: DataFrame, strict: bool = False) -> DataFrame:
    """RED on any error, AMBER on any warning, else GREEN; strict: more than two warnings are RED too."""
    n, w = F.count_if(F.col("severity") == "error"), F.count_if(F.col("severity") == "warning")
    red = (n > 0) | (w > 2) if strict else n > 0
    return found.agg(F.when(red, "RED").when(w > 0, "AMBER").otherwise("GREEN").alias("status"), n.alias("errors"), w.alias("warnings"))
