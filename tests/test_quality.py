import contextlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import catalogs, checks, neighbours, quality, rules, vectors

SEG = "id string, episode_id string, speaker string, start_time double, end_time double, text string"


def segs(spark, rows):
    return spark.createDataFrame([(f"s{k:03d}", *r) for k, r in enumerate(rows)], SEG)


@contextlib.contextmanager
def spark_conf(spark, key, value):
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, old)


def first(df):
    return df.first().asDict(recursive=True)


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b):
            row[k + 1], last = (last + 1 if x == y else max(row[k + 1], row[k])), row[k + 1]
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=30), st.text("abc", max_size=30))
def test_indel_ratio(a, b):
    assert quality.indel_ratio(a, b) == (2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0)


def greedy(texts, threshold):
    """Leaders in order, plainly."""
    led, taken = {}, set()
    for k, a in enumerate(texts):
        if a in taken:
            continue
        group = [b for b in texts[k + 1 :] if b not in taken and quality.indel_ratio(a, b) >= threshold]
        if group:
            taken |= {a, *group}
            led |= {x: a for x in (a, *group)}
        taken.add(a)
    return led


@pytest.mark.parametrize("threshold", [0.95, 0.8])
def test_near_duplicates_equal_the_greedy_walk(spark, threshold):
    r = random.Random(int(100 * threshold))
    texts = []
    for _ in range(12):
        base = "".join(r.choice("abcde ") for _ in range(r.randint(12, 70))).strip().replace("  ", " ")
        texts.append(base)
        for _ in range(4):
            t = list(base)
            for _ in range(r.randint(1, max(1, len(t) // 8))):
                k = r.randrange(len(t))
                t[k : k + r.randint(0, 1)] = r.choice("abcde")
            texts.append("".join(t))
    r.shuffle(texts)
    texts = list(dict.fromkeys(" ".join(t.split()) for t in texts if len(" ".join(t.split())) >= 10))
    df = segs(spark, [("E", "A", float(k), k + 1.0, t) for k, t in enumerate(texts)])
    got = {x.id: x.leader_id for x in quality.near_duplicates(df, "id", threshold).collect()}
    name = {t: f"s{k:03d}" for k, t in enumerate(texts)}
    assert got == {name[t]: name[x] for t, x in greedy(texts, threshold).items()}


@pytest.mark.parametrize("size", [5, 16384])
def test_near_duplicates_in_blocks(spark, monkeypatch, size):
    """Blocks of any size give the greedy walk; texts that only share passages are not compared; nothing is broadcast."""
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    apart = ["the same long passage of words, " + " ".join(word() for _ in range(r.randint(12, 30))) for _ in range(40)]
    texts = apart + [t[:k] + t[k + 1 :] for t in apart[:12] for k in (40, 60)]
    calls = []
    ratio = quality.indel_ratio
    monkeypatch.setattr(quality, "indel_ratio", lambda a, b: calls.append(1) or ratio(a, b))
    assert list(quality.alike_pairs(apart, None, 0.95)) == [] and len(calls) < 20
    assert {(x, y - 40) for x, y in quality.alike_pairs(texts, None, 0.95) if x < 40 <= y} | {(y, x - 40) for x, y in quality.alike_pairs(texts, None, 0.95) if y < 40 <= x} == set(quality.alike_pairs(apart, texts[40:], 0.95))
    monkeypatch.setattr(quality, "indel_ratio", ratio)
    monkeypatch.setattr(quality, "BLOCK_TEXTS", size)
    df = segs(spark, [("E", "A", float(k), k + 1.0, t) for k, t in enumerate(texts)])
    near = quality.near_duplicates(df, "id", 0.95)
    name = {t: f"s{k:03d}" for k, t in enumerate(texts)}
    assert {x.id: x.leader_id for x in near.collect()} == {name[t]: name[x] for t, x in greedy(texts, 0.95).items()}
    assert "Broadcast" not in near._jdf.queryExecution().executedPlan().toString()
    assert quality.near_duplicates(df.where("false"), "id").count() == 0


def test_exact_duplicates(spark):
    t = "a text that is long enough"
    df = segs(spark, [("E", "A", 0.0, 1.0, t), ("E", "A", 10.0, 11.0, t.upper() + " "), ("E", "A", 400.0, 401.0, t), ("E", "B", 0.0, 1.0, t), ("F", "A", 0.0, 1.0, t), ("E", None, 1.0, 2.0, t), ("E", None, 1.0, 2.0, t), ("E", "A", 0.0, 1.0, "short"), ("E", "A", 0.0, 1.0, "short"), (None, "A", 0.0, 1.0, t)])
    got = {(x.dup_speaker, x["count"], x.first_id) for x in quality.exact_duplicates(df, "id").collect()}
    assert got == {("A", 2, "s000"), ("NO_SPEAKER", 2, "s005")}
    assert {x.id for x in quality.duplicate_rows(df, "id").collect()} == {"s001", "s006"}


def test_coverage(spark):
    eps = spark.createDataFrame([("E", 100.0), ("F", 0.0), ("G", 10.0)], "episode_id string, duration_seconds double")
    s = segs(spark, [("E", "A", 0.0, 50.0, "x"), ("E", "A", 40.0, 60.0, "x"), ("G", "A", 0.0, 20.0, "x")])
    per = {r.episode_id: r for r in quality.episode_coverage(eps, s, s).collect()}
    assert (per["E"].span_coverage_pct, per["E"].beat_coverage_pct, per["F"].span_coverage_pct, per["G"].span_coverage_pct, per["G"].beat_coverage_pct) == (60, 70, 0, 100, 200)
    g = first(quality.global_coverage(quality.episode_coverage(eps, s, s)))
    assert g["span_count"] == 3 and g["span_coverage_pct"] == round(80 / 110 * 100, 2)
    gaps = {r.episode_id: r for r in quality.gap_overlap_summary(s, eps).collect()}
    assert (gaps["E"].gap_count, gaps["E"].gap_percent, gaps["E"].overlap_count, gaps["E"].overlap_seconds) == (1, 40, 1, 10)


def test_distribution(spark):
    df = spark.createDataFrame([(x,) for x in (10.0, 20.0, 30.0, 130.0, -5.0, float("nan"), None)], "duration double")
    s = first(quality.duration_statistics(df))
    ok = np.array([10.0, 20, 30, 130])
    assert (s["count"], s["median"], s["p5"], s["p95"], s["std"]) == (4, 25, round(np.percentile(ok, 5), 2), round(np.percentile(ok, 95), 2), round(ok.std(ddof=1), 2))
    c = first(quality.length_compliance(df.where("duration > 0 and not isnan(duration)"), 20, 120))
    assert (c["within"], c["too_short"], c["too_long"], c["within_pct"]) == (2, 1, 1, 50)
    h = {r.bin: r["count"] for r in quality.duration_histogram(df.where("not isnan(duration)"), "span").collect()}
    assert h == {0: 1, 1: 2, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0}
    assert first(quality.duration_statistics(df.where("false")))["count"] == 0
    assert [r["count"] for r in quality.equal_width_histogram(df.where("duration > 0 and not isnan(duration)"), 4).orderBy("bin").collect()] == [3, 0, 0, 1]
    assert quality.equal_width_histogram(df.where("false")).count() == 0
    with pytest.raises(ValueError, match="duration"):
        quality.duration_of(spark.range(1))


def test_percentiles_are_exact_and_bounded(spark, monkeypatch):
    """As NumPy's, whatever is left to fetch; no aggregate keeps all values."""
    r = np.random.default_rng(4)
    for x in (r.normal(50, 20, 999), np.array([3.5]), np.repeat([1.0, 2.0, 1e300, np.inf], [5, 1, 2, 9]), np.concatenate([r.exponential(5, 200) - 4, [0.0, -0.0, 1e-310]])):
        df = spark.createDataFrame([(float(v),) for v in x], "duration double").repartition(3)
        for most in (1 << 16, 20, 0):
            monkeypatch.setattr(quality, "VALUES_LEFT", most)
            assert quality.percentiles(df, [0.0, 0.05, 0.5, 0.95, 1.0]) == pytest.approx([df.agg(F.percentile("duration", F.lit(p))).first()[0] for p in (0.0, 0.05, 0.5, 0.95, 1.0)], rel=1e-12)
    assert quality.percentiles(df.where("false"), [0.5]) == [None]
    assert "percentile" not in quality.duration_statistics(df)._jdf.queryExecution().executedPlan().toString()


def test_integrity(spark):
    df = segs(spark, [("E", "A", 0.0, 5.0, "x"), ("E", "B", 4.0, 6.0, "y"), ("E", "A", 6.0, 6.0, ""), ("", None, 9.0, 8.0, None), ("E", "A", -1.0, None, "z")])
    c = first(quality.integrity_counts(df, "id"))
    assert (c["negative_duration_count"], c["zero_duration_count"], c["missing_episode_id_count"], c["missing_speaker_count"], c["missing_text_count"], c["missing_timestamp_count"], c["negative_timestamp_count"]) == (1, 1, 1, 1, 2, 1, 1)
    assert Counter(r.fault for r in quality.integrity_rows(df, "id").collect())["missing_text"] == 2
    assert first(quality.regression_counts(df.where("end_time is not null"), "id")) == {"episode_regression_count": 1, "speaker_regression_count": 0}


def test_text(spark):
    df = segs(spark, [("E", "A", 0.0, 1.0, "The cat, the DOG! 12"), ("E", "A", 0.0, 1.0, None), ("E", "A", 0.0, 1.0, "cat dog cat.")])
    m = first(quality.text_metrics(df, "id"))
    assert (m["total_tokens"], m["total_words"], m["total_characters"]) == (8, 7, 32)
    d = first(quality.lexical_density(df, "id"))
    assert (d["total_words"], d["stopword_count"], d["lexical_density"], d["avg_lexical_density"]) == (7, 2, 0.714, 0.75)
    p = first(quality.punctuation_ratio(df, "id"))
    assert (p["total_characters"], p["punctuation_count"]) == (26, 3)
    assert [(r.term, r["count"]) for r in quality.top_terms(quality.unigram_counts(df), 2).collect()] == [("cat", 3), ("dog", 2)]
    assert {(r.term, r["count"]) for r in quality.bigram_counts(df).collect()} == {("the cat", 1), ("cat the", 1), ("the dog", 1), ("cat dog", 1), ("dog cat", 1)}


def test_balance(spark):
    df = segs(spark, [("E", "A", 0.0, 2.0, "x")] * 3 + [("E", "B", 0.0, 4.0, "x")] * 2 + [("F", "C", 0.0, 1.0, "x")])
    got = [(r["rank"], r.speaker, r.speakers, r["count"], r.percent) for r in quality.speaker_distribution(df, 1).orderBy(F.col("rank").asc_nulls_last()).collect()]
    assert got == [(1, "A", 1, 3, 50.0), (None, None, 2, 3, 50.0)]
    eps = spark.createDataFrame([("E", "S"), ("F", "T")], "episode_id string, series string")
    assert {r.series: (r.segments, r.speakers, r.largest_ratio) for r in quality.series_balance(df, eps).collect()} == {"S": (5, 2, 1.0), "T": (1, 1, 5.0)}


def test_catalogs(spark):
    u = spark.createDataFrame([("f1", "E", 0.0, 2.0, "A"), ("f1", "E", 2.0, 8.0, "B"), ("f2", "E", 0.0, 4.0, "A"), ("f2", "S - #1 - 2020-01-02 - Tea", 0.0, 1.0, "A")], "source_file string, episode_id string, start double, `end` double, speaker string")
    c = {r.speaker_name: r for r in catalogs.speaker_catalog(u).collect()}
    assert (c["A"].episode_count, c["A"].total_utterances, c["A"].avg_duration, c["A"].weighted_avg_duration, c["A"].participation) == (3, 3, 2.25, pytest.approx(7 / 3), 1.5)
    assert c["A"].episode_list == "E, S - #1 - 2020-01-02 - Tea"
    e = {(r.source_file, r.title): r for r in catalogs.episode_catalog(u).collect()}
    assert e["f2", "Tea"].date == "2020-01-02" and e["f1", "E"].speaker_list == "A, B"
    assert catalogs.rankings(catalogs.speaker_catalog(u), "total_duration", 1).first().speaker_name == "A"
    assert first(catalogs.episode_statistics(catalogs.episode_catalog(u)))["distinct_speakers"] == 2
    assert first(catalogs.speaker_summary(u, "A"))["utterances"] == 3


def test_checks(spark):
    df = spark.createDataFrame([("u1", "E", 0.0, 1.0, "A", "x", 1.0), ("u1", None, -1.0, float("nan"), "A", " ", float("inf"))], "utterance_id string, episode_id string, start double, `end` double, speaker string, text string, duration double")
    got = {r.check: r.passed for r in checks.validate(df, "utterance").collect()}
    wrong = {k for k, v in got.items() if not v}
    assert wrong == {"timestamp_negative_start", "timestamp_nulls_end", "text_empty", "id_duplicates_utterance_id", "id_nulls_episode_id", "numeric_nan_end", "numeric_inf_duration"}
    c = first(checks.report_counts(checks.validate(df, "utterance")))
    assert c["failed"] == len(wrong) and not c["is_valid"] and c["warnings"] == 2
    assert not {r.check: r.passed for r in checks.validate(df.where("false").drop("speaker"), "utterance").collect()}["non_empty"]
    router = checks.Router({"tables": {"utterances": {"role": "base", "checks": ["timestamp_validity"]}}, "check_requirements": {"timestamp_validity": {"required_columns": ["start", "zz"]}}})
    names = {r.check for r in checks.validate(df, "utterance", router).collect()}
    assert "timestamp_negative_start" in names and "text_empty" not in names and router.runs("other", "anything") and router.role("utterances") == "base"
    assert router.fits("utterances", "timestamp_validity", ["start"]) == (False, "missing columns: zz")
    with pytest.raises(ValueError, match="role"):
        checks.Router({"tables": {"x": {}}})
    parents = spark.createDataFrame([(["a", "b"],)], "ids array<string>")
    assert [r.i for r in checks.dangling(parents, "ids", spark.createDataFrame([("a",)], "i string"), "i").collect()] == ["b"]


def test_rules(spark):
    t = rules.Thresholds.from_dict({"coverage": {"coverage_min": 80}, "junk": 1}).with_overrides(neighbor_k=3, span_length_min=None)
    assert (t.coverage_min, t.neighbor_k, t.span_length_min) == (80, 3, 20.0)
    m = spark.createDataFrame([(50.0, 99.0, None)], "span_coverage_pct double, beat_coverage_pct double, norm_corr double")
    v = rules.violations(m, rules.coverage_rules(t) + rules.bias_rules(t))
    assert [(r.rule, r.severity) for r in v.collect()] == [("coverage_min_global_spans", "error")]
    assert first(rules.status(v))["status"] == "RED" and first(rules.status(v.where("false")))["status"] == "GREEN"
    warn = rules.violations(spark.createDataFrame([(-0.5,)], "norm_corr double"), rules.bias_rules(t))
    assert first(rules.status(warn))["status"] == "AMBER"
    three = warn.unionAll(warn).unionAll(warn)
    assert (first(rules.status(three))["status"], first(rules.status(three, strict=True))["status"]) == ("AMBER", "RED")
    assert rules.length_rules("spans", t) == rules.length_rules("span", t)


def corpus(spark, n=60, d=8, seed=3):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, d))
    rows = [(f"s{k:03d}", f"E{k % 4}", f"P{k % 3}", float(10 * k), 10.0 * k + 8, f"word{k % 5} thing other{k}", [float(x) for x in v[k]]) for k in range(n)]
    return spark.createDataFrame(rows, SEG + ", embedding array<double>").repartition(5), v


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_top_k_is_exact(spark, metric):
    df, v = corpus(spark)
    got: dict = {}
    for r in vectors.top_k(df.where("id < 's010'"), df, 4, metric, id_col="id").orderBy("query_id", "rank").collect():
        got.setdefault(int(r.query_id[1:]), []).append(int(r.neighbor_id[1:]))
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for k in range(10):
        s = u @ u[k] if metric == "cosine" else v @ v[k] if metric == "ip" else -((v - v[k]) ** 2).sum(axis=1)
        s[k] = -np.inf
        assert got[k] == np.argsort(-np.round(s, 6), kind="stable")[:4].tolist()
    old = vectors.QUERY_BYTES
    vectors.QUERY_BYTES = 3 * 8 * 8
    try:
        assert vectors.top_k(df.where("id < 's010'"), df, 4, metric, id_col="id").count() == 40
    finally:
        vectors.QUERY_BYTES = old
    assert vectors.top_k(df.where("false"), df, id_col="id").count() == 0


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_top_k_in_blocks_with_ties(spark, monkeypatch, metric):
    """Blocks of any size and repeated vectors give the same k; a task returns k rows for a query, however many blocks it has."""
    r = np.random.default_rng(9)
    v = r.integers(-2, 3, (90, 3)).astype(float)
    v[20:50] = v[20]
    df = spark.createDataFrame([(int(7 * k % 90), [float(x) for x in v[k]]) for k in range(90)], "artifact_id long, embedding array<float>").repartition(1)
    by = {int(7 * k % 90): v[k] for k in range(90)}
    want = set()
    for x in range(0, 90, 3):
        s = {y: (by[x] @ by[y] if metric == "ip" else -((by[x] - by[y]) ** 2).sum() if metric == "l2" else by[x] @ by[y] / ((np.linalg.norm(by[x]) + 1e-8) * (np.linalg.norm(by[y]) + 1e-8))) for y in by if y != x}
        want |= {(x, y, k + 1) for k, y in enumerate(sorted(s, key=lambda y: (-round(s[y], 6), y))[:4])}
    for block in ((4, 7), (1024, 2048)):
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = vectors.top_k(df.where("artifact_id % 3 = 0"), df, 4, metric)
        assert {(x.query_id, x.neighbor_id, x["rank"]) for x in got.collect()} == want
    with spark_conf(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "5"):
        q = pa.array([0, 3])
        rows = vectors._pass(df, q, np.array([by[0], by[3]]), 4, metric, True, "query_id long, neighbor_id long, score double").collect()
    assert len(rows) == 8


def test_neighbour_metrics(spark):
    df, _ = corpus(spark)
    near = vectors.top_k(df, df, 5, id_col="id").persist()
    m = first(neighbours.group_leakage(near, df, "id", "episode_id", 5))
    o = first(neighbours.group_leakage(near, df, "id", "episode_id", 5, different=True))
    assert m["queries"] == 60 and m["mean_pct"] + o["mean_pct"] == pytest.approx(100, abs=0.02)
    assert 0 <= first(neighbours.adjacency_bias(near, df, "id", 5))["mean_pct"] <= 100
    t = neighbours.themes(near, df, "id")
    r = t.first()
    assert r.total_words == 15 and r.top_terms[0]["term"] == "thing" and r.top_terms[0]["count"] == 5
    assert first(neighbours.coherence(near, t))["assessment"] == "coherent" and neighbours.top_theme_terms(t, 1).first().term == "thing"
    assert set(first(neighbours.length_bias(near, df, "id"))) == {"norm_corr", "similarity_corr"}
    assert neighbours.outliers(df, "id", 3).count() == 6 and neighbours.isolation(near, 3).count() == 6
    lists = neighbours.neighbour_lists(near, df, "id", 7).collect()
    assert len(lists) == 7 and [x["rank"] for x in lists[0].neighbors] == [1, 2, 3, 4, 5]


def test_sampling(spark):
    df, _ = corpus(spark)
    a = neighbours.stratified_sample(df, 20, ["episode_id", "speaker"], "id")
    assert {r.id for r in a.collect()} == {r.id for r in neighbours.stratified_sample(df.repartition(2), 20, ["episode_id", "speaker"], "id").collect()}
    assert 12 <= a.count() <= 20 and a.select("episode_id", "speaker").distinct().count() == 12 and a.columns == df.columns
    assert neighbours.stratified_sample(df, 5, ["episode_id", "speaker"], "id").count() == 12 and neighbours.stratified_sample(df, 99, ["speaker"], "id").count() == 60
    assert neighbours.stratified_sample(df, 7, ["nope"], "id").count() == 7
    for n, want in ((1, 1), (50, 50), (500, 500), (5000, 1770)):
        p = {(r.id_a, r.id_b) for r in neighbours.random_pairs(df, n, "id").collect()}
        assert len(p) == want and all(x < y for x, y in p)
    got = first(neighbours.lexical_correlation(neighbours.random_pairs(df, 200, "id"), df, "id"))
    assert got["pairs"] == 200 and -1 <= got["spearman"] <= 1


def test_providers_and_index(spark):
    rows = spark.createDataFrame([("s1", "hello world"), ("s2", None), ("s3", "hello")], "span_id string, text string")
    model = vectors.provider("hashing", dimension=16)
    e = vectors.generate(rows, "span", model)
    got = {r.artifact_id: r for r in e.collect()}
    assert len(got["s1"].embedding) == 16 and got["s1"].artifact_type == "span" and got["s1"].model_name == "hashing-16" and sum(x * x for x in got["s1"].embedding) == pytest.approx(1, abs=1e-5)
    with pytest.raises(ValueError, match="provider"):
        vectors.provider("nope")

    class Broken:
        def encode(self, texts):
            raise OSError

    assert vectors.working(Broken(), model) is model
    with pytest.raises(OSError):
        vectors.working(Broken(), None)
    index = vectors.build_index(e.where("artifact_id = 's1'"), "cosine")
    assert [r.artifact_id for r in vectors.append_index(index, e.unionAll(e)).orderBy("artifact_id").collect()] == ["s2", "s3"]
    assert vectors.growth(index, e) == (2, 2.0, True)
    wide = spark.createDataFrame([("a", 1.0, 2.0)], "artifact_id string, embedding_0 double, embedding_1 double")
    assert vectors.with_wide_vector(wide).first().embedding == [1.0, 2.0]
    assert first(vectors.statistics(e))["dimension"] == 16
    assert vectors.clusters(e, 2).select("cluster").distinct().count() == 2
    model, points = vectors.lsh_index(e)
    assert model.approxSimilarityJoin(points, points, 3.0).count() >= 3


def test_whole_texts_are_embedded_unless_the_model_is_shorter(spark):
    texts = ["one " * 3000 + "two " * 3000, "one " * 3000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = vectors.HashingProvider(64)
    got = {x["artifact_id"]: np.array(x["embedding"], np.float32) for x in vectors.generate(rows, "doc", model).collect()}
    assert all(np.array_equal(got[k], model.encode([t])[0]) for k, t in enumerate(texts)) and not np.array_equal(got[0], got[1])
    model.max_text = vectors.LocalModelProvider.max_text
    short = {x["artifact_id"]: x["embedding"] for x in vectors.generate(rows, "doc", model).collect()}
    assert short[0] == short[1]
