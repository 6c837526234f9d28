"""The quality assessment: seven families of metrics, their violations, and a status.

Tables are read once and persisted; the sample and the neighbour table of a level are computed once and serve all metrics of
that level. What comes to the driver is one row per metric table."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import neighbours, quality, rules, vectors

LEVELS = {"spans": "span_id", "beats": "beat_id"}


@dataclass
class Assessment:
    """Metrics by family (small dicts), violations, status, and tables for the exports."""

    thresholds: rules.Thresholds
    metrics: dict[str, dict] = field(default_factory=dict)
    violations: list[dict] = field(default_factory=list)
    status: str = "GREEN"
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def errors(self) -> list[dict]:
        return [v for v in self.violations if v["severity"] == "error"]

    def warnings(self) -> list[dict]:
        return [v for v in self.violations if v["severity"] == "warning"]

    def to_dict(self) -> dict:
        return {"status": self.status, "metrics": self.metrics, "violations": self.violations, "thresholds": self.thresholds.to_dict()}


def _row(df: DataFrame) -> dict:
    got = df.first()
    return got.asDict(recursive=True) if got else {}


def _rows(df: DataFrame) -> list[dict]:
    """All rows of a report's table: rankings, histograms, and violations, at most a short row for each rule and episode."""
    return [r.asDict(recursive=True) for r in df.collect()]


class Assessor:
    def __init__(self, thresholds: rules.Thresholds | None = None, near_duplicates: bool = True) -> None:
        """near_duplicates: look for them, whatever the size of the tables; their metrics are left out otherwise."""
        self.t, self.near = thresholds or rules.Thresholds(), near_duplicates

    def run(self, episodes: DataFrame, spans: DataFrame, beats: DataFrame, embeddings: DataFrame | None = None, levels: tuple[str, ...] = ("spans", "beats")) -> Assessment:
        """episodes: episode_id and duration_seconds, duration_minutes or duration."""
        episodes = quality.in_seconds(episodes)
        out = Assessment(self.t)
        tables = {"spans": spans.persist(), "beats": beats.persist()}
        try:
            self._coverage(out, episodes, **tables)
            for level in levels:
                self._distribution(out, level, tables[level])
                self._integrity(out, level, tables[level])
            self._text_and_balance(out, spans, beats)
            for level in levels if embeddings is not None else ():
                self._embedding(out, level, tables[level], embeddings)
        finally:
            for df in tables.values():
                df.unpersist()
        out.status = "RED" if out.errors() else "AMBER" if out.warnings() else "GREEN"
        return out

    def _judge(self, out: Assessment, metrics: DataFrame, made: list[rules.Rule], where: str, *carry: str) -> None:
        out.violations += [{"where": where, **v} for v in _rows(rules.violations(metrics, made, *carry))]

    def _one(self, out: Assessment, metrics: dict) -> DataFrame:
        """A metrics row as a table, for the rules."""
        from pyspark.sql import SparkSession

        flat = {k: float(v) for k, v in metrics.items() if isinstance(v, (int, float)) and not isinstance(v, bool)}
        return SparkSession.getActiveSession().createDataFrame([tuple(flat.values())], ", ".join(f"`{k}` double" for k in flat)) if flat else SparkSession.getActiveSession().range(1)

    def _coverage(self, out: Assessment, episodes: DataFrame, spans: DataFrame, beats: DataFrame) -> None:
        per = quality.episode_coverage(episodes, spans, beats)
        gaps = quality.gap_overlap_summary(spans, episodes).drop("duration_seconds")
        per = per.join(gaps, "episode_id").persist()
        out.tables["episodes"] = per
        total = quality.global_coverage(per)
        out.metrics["coverage"] = _row(total)
        self._judge(out, total, rules.coverage_rules(self.t), "coverage")
        self._judge(out, per, rules.episode_rules(self.t), "coverage", "episode_id")

    def _distribution(self, out: Assessment, level: str, df: DataFrame) -> None:
        kind = level[:-1]
        least, most = getattr(self.t, f"{kind}_length_min"), getattr(self.t, f"{kind}_length_max")
        fits = quality.length_compliance(df, least, most)
        out.metrics[f"distribution_{level}"] = _row(quality.duration_statistics(df)) | _row(fits) | {"histogram": _rows(quality.duration_histogram(df, kind).orderBy("bin"))}
        self._judge(out, fits, rules.length_rules(level, self.t), f"distribution {level}")

    def _integrity(self, out: Assessment, level: str, df: DataFrame) -> None:
        id_col = LEVELS[level]
        if "speaker" not in df.columns:
            df = df.withColumn("speaker", F.element_at("speakers_set", 1) if "speakers_set" in df.columns else F.lit("-"))
        m = _row(quality.integrity_counts(df, id_col)) | _row(quality.regression_counts(df, id_col))
        total = max(1, m["total_segments"])
        groups = quality.exact_duplicates(df, id_col)
        m["exact_duplicate_count"] = int(groups.agg(F.coalesce(F.sum("duplicate_count"), F.lit(0))).first()[0])
        m["exact_duplicate_percent"] = round(100 * m["exact_duplicate_count"] / total, 2)
        out.tables[f"duplicates_{level}"] = quality.duplicate_rows(df, id_col)
        if self.near:
            near = quality.near_duplicates(df.join(out.tables[f"duplicates_{level}"], id_col, "left_anti"), id_col, self.t.near_duplicate_threshold)
            n, clusters = near.agg(F.count(F.lit(1)), F.count_distinct("leader_id")).first()
            m["near_duplicate_count"] = n - clusters
            m["near_duplicate_percent"] = round(100 * (n - clusters) / total, 2)
        out.metrics[f"integrity_{level}"] = m
        self._judge(out, self._one(out, m), rules.integrity_rules(self.t), f"integrity {level}")

    def _text_and_balance(self, out: Assessment, spans: DataFrame, beats: DataFrame) -> None:
        """Over spans and beats together, and by level."""
        if "speaker" in spans.columns:
            out.metrics["balance"] = {"speakers": _rows(quality.speaker_distribution(spans, self.t.top_speakers_count).orderBy(F.col("rank").asc_nulls_last()))}
        s, b = (df.select(F.col(i).alias("id"), "text") for df, i in ((spans, "span_id"), (beats, "beat_id")))
        for name, df in (("all", s.unionByName(b)), ("spans", s), ("beats", b)):
            words = quality.unigram_counts(df).persist()
            pairs = quality.bigram_counts(df).persist()
            out.metrics[f"text_{name}"] = _row(quality.text_metrics(df, "id")) | _row(quality.lexical_density(df, "id")) | _row(quality.punctuation_ratio(df, "id")) | {
                "top_unigrams": _rows(quality.top_terms(words)), "top_bigrams": _rows(quality.top_terms(pairs)), "unique_unigrams": words.count(), "unique_bigrams": pairs.count(),
            }
            words.unpersist()
            pairs.unpersist()

    def _embedding(self, out: Assessment, level: str, df: DataFrame, embeddings: DataFrame) -> None:
        id_col, t = LEVELS[level], self.t
        if "speaker" not in df.columns:
            df = df.withColumn("speaker", F.element_at("speakers_set", 1))
        on = df.drop("embedding").join(embeddings.select(F.col("artifact_id").alias("_a"), "embedding"), F.col(id_col) == F.col("_a")).drop("_a").persist()
        if on.isEmpty():
            out.metrics[f"embedding_{level}"] = {"available": False}
            return
        k = t.neighbor_k
        sample = neighbours.stratified_sample(on, t.neighbor_sample_size, ["episode_id", "speaker"], id_col, t.random_seed)
        near = vectors.top_k(sample, on, k, id_col=id_col).persist()
        m: dict = {"available": True}
        for name, table in (
            ("speaker_leakage", neighbours.group_leakage(near, on, id_col, "speaker", k)), ("episode_leakage", neighbours.group_leakage(near, on, id_col, "episode_id", k)),
            ("adjacency", neighbours.adjacency_bias(near, on, id_col, k, t.adjacency_tolerance_seconds)),
        ):
            row = _row(table)
            m[name], m[f"{name}_pct"] = row, row.get("mean_pct")
        if "series" in on.columns:
            m["cross_series"] = _row(neighbours.group_leakage(near, on, id_col, "series", k, different=True))
        m |= _row(neighbours.length_bias(near, on, id_col))
        per = neighbours.themes(near, on, id_col)
        m["coherence"] = _row(neighbours.coherence(near, per)) | {"top_terms": _rows(neighbours.top_theme_terms(per))}
        pairs = neighbours.random_pairs(on, t.random_pairs_sample_size, id_col, t.random_seed)
        m["lexical"] = _row(neighbours.lexical_correlation(pairs, on, id_col))
        out.metrics[f"embedding_{level}"] = m
        out.tables[f"outliers_{level}"] = neighbours.outliers(on, id_col, t.outlier_count).unionByName(neighbours.isolation(near, t.outlier_count), allowMissingColumns=True)
        out.tables[f"neighbors_{level}"] = neighbours.neighbour_lists(near, on, id_col, t.neighbor_list_sample_size, t.random_seed)
        self._judge(out, self._one(out, m), rules.leakage_rules(t) + rules.bias_rules(t), f"embedding {level}")
