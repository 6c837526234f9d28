"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

`assessment` is the whole quality assessment (coverage, distribution, integrity, balance, text, neighbours) over spans made of
events and beats made of conversations, with vectors; its row count over its seconds compares with the recorded runs, in
which near duplicates were not evaluated either."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import segment, vectors  # noqa: E402
from tessera.plans import assessor, catalogue, relations  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "utterance_normalize", "validation_summary", "spans_islands", "beats_heuristic", "sections_fold", "expert_coverage", "speaker_rollup", "episode_catalog", "interval_union_coverage", "gaps", "overlap_total", "monotonicity",
    "duration_stats", "series_balance", "exact_duplicates", "text_metrics", "lexical_density", "top_bigrams", "cosine_topk", "label_leakage", "stratified_sample",
)


def assessment(spark: SparkSession, sf_dir: str) -> int:
    s = relations.intervals(spark, sf_dir)
    spans = s.select(F.concat(F.lit("s"), F.col("segment_id").cast("string")).alias("span_id"), F.col("episode_id").cast("string").alias("episode_id"), "speaker", "start_time", "end_time", (F.col("end_time") - F.col("start_time")).alias("duration"), "text")
    beats = segment.make_beats(segment.make_spans(relations.utterances(spark, sf_dir)), catalogue.BEATS).withColumn("speakers_set", F.array(F.lit("user")))
    episodes = spans.groupBy("episode_id").agg(F.max("end_time").alias("duration_seconds"))
    model = vectors.HashingProvider(64)
    found = vectors.generate(spans, "span", model).unionByName(vectors.generate(beats, "beat", model))
    a = assessor.Assessor(near_duplicates=False).run(episodes, spans, beats, found)
    return sum(a.metrics[f"integrity_{level}"]["total_segments"] for level in ("spans", "beats"))


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("bench").config("spark.sql.shuffle.partitions", CPUS).config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()  # start-up is not measured
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        catalogue.QUERIES[name](spark, SF).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    began = time.time()
    rows = assessment(spark, SF)
    seconds["assessment"] = round(time.time() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(SF), "assessment_segments": rows, "assessment_segments_per_s": round(rows / seconds["assessment"], 1)}))


if __name__ == "__main__":
    main()
