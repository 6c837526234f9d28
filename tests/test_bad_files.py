"""Files that can't be read, and reports over many episodes."""

import gzip

from tessera.operators import rules
from tessera.plans.assessor import Assessment, Assessor
from tessera.sources import transcripts

ROW = '{"episode_id": "e1", "start": 0, "end": 1.5, "speaker": "a", "text": "hello"}'


def test_a_folder_is_read_without_its_bad_files(spark, tmp_path):
    (tmp_path / "good.jsonl").write_text(f"{ROW}\nnot json\n\n{ROW}\n")
    (tmp_path / "good.json").write_text(f"[{ROW}]")
    (tmp_path / "bad.json").write_text("{")
    whole = gzip.compress(ROW.encode() * 1000)
    for kind in ("json", "jsonl"):
        (tmp_path / f"cut.{kind}.gz").write_bytes(whole[: len(whole) // 2])
    lines = transcripts.read_jsonl(spark, str(tmp_path), "*.jsonl*", skip=True).where("text = 'hello'")
    assert lines.count() == 2
    files = transcripts.read_directory(spark, str(tmp_path), "*.json*").where("text = 'hello' and source_file like '%good.json'")
    assert files.count() == 1


def test_no_violation_is_left_out(spark):
    out = Assessment(rules.Thresholds())
    per = spark.range(1500).selectExpr("cast(id as string) as episode_id", "0.0d as span_coverage_pct", "0.0d as gap_percent", "0.0d as overlap_percent")
    Assessor()._judge(out, per, rules.episode_rules(rules.Thresholds()), "coverage", "episode_id")
    assert len(out.violations) == len({v["episode_id"] for v in out.violations}) == 1500
