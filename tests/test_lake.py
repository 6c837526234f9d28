"""From files to a snapshot, through the command line."""

import json
import os
import random

import pytest

from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import vectors
from tessera.plans import assessor, manifest, report, snapshot
from tessera.plans.layout import Lake
from tessera.sources import sinks, tables


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    r = random.Random(4)
    os.makedirs(root / "in")
    for e in range(4):
        t, lines = 0.0, []
        for _ in range(60):
            d = r.randint(2, 30)
            lines.append({"episode_id": f"S - #{e} - 2020-01-0{e + 1} - Talk {e}", "start": round(t, 2), "end": round(t + d, 2), "speaker": r.choice(["Ann", "Ann", "Bob"]), "text": " ".join(r.choice(["tea", "cup", "the", "milk", "pot"]) for _ in range(d))})
            t += d + r.choice([0, 0.25, 0.25, 7])
        lines[5]["text"] = ""
        (root / "in" / f"e{e}.jsonl").write_text("\n".join(map(json.dumps, lines)))
    os.makedirs(root / "conf")
    (root / "conf" / "speaker_roles.yaml").write_text("experts: [Ann]\nroles: {Bob: host}\n")
    (root / "conf" / "aggregation.yaml").write_text("beats: {use_embeddings: false}\nsections: {target_duration_minutes: 3, min_duration_minutes: 2, max_duration_minutes: 4}\n")
    lk = Lake(spark, str(root / "lake"))
    run = lambda *a: cli.main(["--lake", lk.root, "--config-dir", str(root / "conf"), *a], spark)
    assert run("ingest", str(root / "in"), "--pattern", "*.jsonl", "--dry-run") == 0 and not lk.exists("normalized")
    assert run("ingest", str(root / "in"), "--pattern", "*.jsonl", "--update-catalog") == 0
    assert run("materialize", "--all") == 0
    return lk, run, root


def test_hierarchy(spark, lake):
    lk, run, root = lake
    t = {a: spark.read.parquet(lk.path(a)) for a in ("normalized", "spans", "beats", "sections", "embeddings", "ann_index")}
    assert t["normalized"].count() == 4 * 59 and spark.read.parquet(lk.raw).count() == 240
    for parent, column, child, key in (("beats", "span_ids", "spans", "span_id"), ("sections", "beat_ids", "beats", "beat_id")):
        ids = [i for r in t[parent].select(column).collect() for i in r[0]]
        assert len(ids) == len(set(ids)) and set(ids) <= {r[0] for r in t[child].select(key).collect()}
    assert t["embeddings"].groupBy("artifact_type").count().count() == 2 and t["ann_index"].count() == t["embeddings"].count()
    assert {r.speaker_role for r in t["spans"].collect()} == {"expert", "host"}
    assert tables.load_embeddings(spark, lk.path("embeddings"), "span", ["artifact_id"]).count() == t["spans"].count()
    assert tables.load_embeddings(spark, lk.path("embeddings", "v9")).count() == 0
    assert lk.versions("spans") == ["v1"] and lk.next_version("spans") == "v2" and lk.latest("nothing") is None
    with pytest.raises(ValueError, match="artifact"):
        lk.path("nope")
    assert tables.file_info(spark, lk.path("spans"))["rows"] == t["spans"].count() and tables.row_count(spark, str(root / "in" / "e0.jsonl")) is None
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(root / "none"))
    assert tables.lookup(spark, lk.path("spans"), "select count(*) as n from t where speaker = :who", who="Ann").first().n > 0


def test_schema_manifest_and_vectors(spark, lake):
    lk, _, _ = lake
    m = manifest.schema_manifest(lk)
    s = manifest.schema_statistics(m).first()
    assert (s.artifacts, s.with_files) == (5, 5) and {r.artifact_type for r in m.where("missing = ''").collect()} == set(manifest.SCHEMA_OF)
    assert all(r.complies for r in manifest.file_compliance(lk, "spans").collect()) and manifest.artifact_schema("span")[0] == {"name": "span_id", "type": "string", "nullable": False}
    info = tables.embedding_info(spark, lk.path("embeddings"))
    assert info["exists"] and info["dimension"] == 384 and info["total"] == sum(info["counts"].values())
    assert tables.embedding_info(spark, lk.path("embeddings", "v8")) == {"exists": False}
    e, spans = tables.load_embeddings(spark, lk.path("embeddings"), "span"), spark.read.parquet(lk.path("spans"))
    model = vectors.HashingProvider()
    one = spans.orderBy("span_id").first()
    hit = vectors.search(one.text, e, model, 3).where("rank = 1").first()
    assert hit.score == pytest.approx(1, abs=1e-5)
    ids = spans.limit(2).select(F.col("span_id").alias("artifact_id"))
    assert vectors.subset(e, ids.unionAll(ids)).count() == 2
    c = vectors.cluster_summary(vectors.clusters(e, 3), spans, "span_id")
    assert c.agg(F.sum("segments")).first()[0] == spans.count()
    assert tables.load_latest(spark, lk.catalogs, "episodes").count() >= 4
    with pytest.raises(FileNotFoundError):
        tables.load_latest(spark, lk.catalogs, "nothing")


def test_incremental_ingest(spark, lake):
    lk, run, root = lake
    assert run("ingest", str(root / "in"), "--pattern", "*.jsonl", "--incremental") == 0
    assert spark.read.parquet(lk.path("normalized")).count() == 4 * 59
    os.makedirs(root / "more", exist_ok=True)
    (root / "more" / "n.jsonl").write_text(json.dumps({"episode_id": "N", "start": 0, "end": 2, "speaker": "A", "text": "x"}))
    assert run("ingest", str(root / "more"), "--pattern", "*.jsonl", "--version", "v2") == 0 and lk.versions("normalized") == ["v1", "v2"]
    assert run("ingest", str(root / "in"), "--pattern", "*.jsonl", "--version", "v3", "--fail-on-invalid") == 1


@pytest.mark.parametrize("extra", [[], ["--catalog-type", "speakers", "--rankings", "total_duration"], ["--catalog-type", "speakers", "--speaker-name", "Ann"], ["--catalog-type", "speakers", "--statistics"], ["--statistics"], ["--episode-id", "S - #1 - 2020-01-02 - Talk 1"], ["--catalog-type", "schema", "--output-format", "json", "--save-catalog"]])
def test_catalog(lake, capsys, extra):
    lk, run, _ = lake
    assert run("catalog", *extra) == 0
    assert capsys.readouterr().out.strip()


def test_validate(lake, capsys):
    lk, run, _ = lake
    assert run("validate", "--save-report") == 0
    assert "spans: " in capsys.readouterr().out and tables.exists(lk.spark, f"{lk.catalogs}/validation_reports/*.txt")
    assert run("validate", "--artifact-type", "spans", "--output-format", "json") == 0
    assert json.loads(capsys.readouterr().out)[0]["check"] == "non_empty"


def test_quality(spark, lake, tmp_path):
    lk, run, _ = lake
    code = run("quality", "--output-dir", str(tmp_path), "--no-timestamp", "--sample-size", "20", "--neighbor-k", "3")
    whole = json.loads((tmp_path / "metrics" / "global.json").read_text())
    assert code == int(whole["status"] == "RED") and {"coverage", "distribution_spans", "integrity_beats", "balance", "text_all", "embedding_spans"} <= set(whole["metrics"])
    assert whole["metrics"]["embedding_spans"]["available"] and whole["metrics"]["integrity_spans"]["total_segments"] == whole["metrics"]["coverage"]["span_count"]
    assert (tmp_path / "report" / "quality_assessment.md").read_text().startswith("# Quality assessment")
    assert any((tmp_path / "diagnostics" / "outliers_spans.csv").iterdir()) and any((tmp_path / "diagnostics" / "neighbors_spans.csv").iterdir())


def test_assessment_without_vectors_and_rows(spark, lake, tmp_path):
    lk, _, _ = lake
    s, b = (spark.read.parquet(lk.path(x)) for x in ("spans", "beats"))
    eps = s.groupBy("episode_id").agg({"end_time": "max"}).withColumnRenamed("max(end_time)", "duration_seconds")
    a = assessor.Assessor().run(eps, s, b, None, ("spans",))
    assert not any(k.startswith("embedding") for k in a.metrics) and report.inconsistencies(a) == []
    twin = assessor.Assessor().run(eps, s.repartition(3), b.repartition(2), None, ("spans",))
    assert json.dumps(a.metrics, default=str) == json.dumps(twin.metrics, default=str)
    none = assessor.Assessor().run(eps.where("false"), s.where("false"), b.where("false"), None)
    assert none.metrics["coverage"]["episodes"] == 0
    sinks.segments_csv(s, "span_id", "span", a.tables["duplicates_spans"], 20, 120, str(tmp_path / "seg"))
    assert spark.read.option("header", True).csv(str(tmp_path / "seg")).count() == s.count()


def test_snapshots(spark, lake, tmp_path):
    lk, run, _ = lake
    root = str(tmp_path / "snap")
    assert run("snapshot", "--snapshot-root", root, "--snapshot-version", "v1.0.0", "--qa-status", "GREEN") == 0
    at = f"{root}/v1.0.0"
    found = snapshot.validate(spark, at)
    assert found == {"valid": True, "errors": [], "warnings": []}
    m = json.loads(open(f"{at}/lake_manifest.json").read())
    assert m["contracts"]["spans"]["rows"] == spark.read.parquet(f"{at}/spans").count() and all(len(f["sha256"]) == 64 for f in m["files"])
    assert snapshot.create(lk, root, "v1.0.0").endswith("v1.0.1")
    with pytest.raises(FileExistsError):
        snapshot.create(lk, root, "v1.0.0", auto_increment=False)
    reports = str(tmp_path / "reports")
    for stamp, status in (("20250101_000000", "GREEN"), ("20250301_000000", "RED"), ("zz", "GREEN")):
        os.makedirs(f"{reports}/{stamp}/report")
        open(f"{reports}/{stamp}/report/quality_assessment.md", "w").write(f"# Report\n\n**Overall status:** **{status}**\n\n| x | green |\n")
    assert report.latest(spark, reports).endswith("20250301_000000") and report.latest(spark, str(tmp_path / "no")) is None
    assert report.status_of(spark, f"{reports}/20250101_000000") == "GREEN" and report.status_of(spark, reports) == "UNKNOWN"
    other = snapshot.create(lk, root, "v1.0.0", reports=reports)
    n = json.loads(open(f"{other}/lake_manifest.json").read())
    assert n["qa_status"] == "RED" and snapshot.validate(spark, other)["warnings"]
    rows = {f["path"]: f["rows"] for f in n["files"]}
    assert sum(v for k, v in rows.items() if k.startswith("spans/") and v) == n["contracts"]["spans"]["rows"]
    assert rows["quality_report/report/quality_assessment.md"] is None
    victim = next(f["path"] for f in m["files"] if f["path"].endswith(".parquet"))
    body = bytearray(open(f"{at}/{victim}", "rb").read())
    body[10] ^= 1
    open(f"{at}/{victim}", "wb").write(body)
    crc = os.path.join(os.path.dirname(f"{at}/{victim}"), f".{os.path.basename(victim)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    assert "checksum" in snapshot.validate(spark, at)["errors"][0] and run("snapshot", "--check", at) == 1
    os.remove(f"{at}/{victim}")
    assert "missing" in snapshot.validate(spark, at)["errors"][0]
    assert snapshot.validate(spark, f"{root}/none")["errors"] and snapshot.archive(lk, "v1", str(tmp_path / "arch"), dry_run=True)
    assert snapshot.next_version(spark, root, "v2.0.0-rc.1") == "v2.0.0-rc.1" and snapshot.parse_version("1.2.3-x") == (1, 2, 3, "x")
    with pytest.raises(ValueError, match="version"):
        snapshot.parse_version("1.2")
    assert snapshot.writable(spark, root) and tables.latest(spark, f"{root}/v*") is not None


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("u", "E", 0.0, 1.0, "A", "x", 1.0, "extra")], "utterance_id string, episode_id string, start double, `end` double, speaker string, text string, duration double, more string")
    p = str(tmp_path / "t")
    sinks.write_table(df, p, "utterance")
    assert "more" not in spark.read.parquet(p).columns
    with pytest.raises(Exception, match="(?i)exist"):
        sinks.write_table(df, p, "utterance")
    sinks.append_table(df, p, "utterance")
    assert spark.read.parquet(p).count() == 2
    assert len(sinks.save_catalog(df, str(tmp_path), "c", "1", ("parquet", "json"))) == 2
    with pytest.raises(ValueError, match="format"):
        sinks.save_catalog(df, str(tmp_path), "c", "2", ("xml",))
