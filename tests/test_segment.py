import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import intervals, roles, segment

UTT = "utterance_id string, episode_id string, start double, `end` double, speaker string, text string"
SPAN = "span_id string, episode_id string, start_time double, end_time double, duration double, speaker string, text string"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def speech(spec, episode="E"):
    """spec: speaker, start, end."""
    return [(f"u{k:03d}", episode, float(a), float(b), s, f"t{k}") for k, (s, a, b) in enumerate(spec)]


def test_spans_break_at_speakers_and_silence(spark):
    u = speech([("A", 0, 2), ("A", 2, 4), ("B", 4, 6), ("B", 6.5, 8), ("B", 8.6, 10), ("A", 10, 10.5)])
    got = sorted(rows(segment.make_spans(spark.createDataFrame(u, UTT).repartition(3))), key=lambda r: r["position"])
    assert [(r["speaker"], r["start_time"], r["end_time"], r["utterance_ids"]) for r in got] == [("A", 0, 4, ["u000", "u001"]), ("B", 4, 8, ["u002", "u003"]), ("B", 8.6, 10, ["u004"])]
    assert [r["position"] for r in got] == [0, 1, 2] and got[0]["text"] == "t0 t1"
    together = rows(segment.make_spans(spark.createDataFrame(u, UTT), segment.SpanRules(break_on_speaker_change=False, max_silence_gap=5)))
    assert len(together) == 1 and together[0]["speaker"] == "A"
    assert rows(segment.make_spans(spark.createDataFrame([], UTT))) == []
    assert rows(segment.make_spans(spark.createDataFrame([("u", " ", 0.0, 9.0, "A", "x")], UTT))) == []
    with pytest.raises(ValueError, match="lack"):
        segment.make_spans(spark.range(1))


def walk_beats(spans, max_gap, max_run):
    """A plain walk: the beat number of each span."""
    out, acc, no = [], 0.0, 1
    for k, s in enumerate(spans):
        if k:
            p = spans[k - 1]
            if s[5] != p[5] or s[2] - p[3] > max_gap:
                no, acc = no + 1, 0.0
            else:
                acc += s[4]
                if acc > max_run:
                    no, acc = no + 1, 0.0
        out.append(no)
    return out


def random_spans(seed, n, episode):
    r = random.Random(seed)
    t, out = 0.0, []
    for k in range(n):
        t += r.choice([0, 0, 0, 1, 8])
        d = r.randint(1, 90)
        out.append((f"{episode}-{k:03d}", episode, t, t + d, float(d), r.choice("AAB"), "x"))
        t += d
    return out


def test_beats_equal_a_plain_walk(spark):
    data = {f"E{k}": random_spans(k, 40 + k, f"E{k}") for k in range(6)}
    df = spark.createDataFrame([s for x in data.values() for s in x], SPAN).repartition(4)
    got = {r["span_id"]: r["beat_no"] for r in rows(segment.beat_runs(df, segment.BeatRules(use_embeddings=False)))}
    for spans in data.values():
        assert [got[s[0]] for s in spans] == walk_beats(spans, 5.0, 180.0)
    beats = rows(segment.make_beats(df, segment.BeatRules(use_embeddings=False)))
    assert sorted(i for b in beats for i in b["span_ids"]) == sorted(s[0] for x in data.values() for s in x)  # each span in one beat
    few = rows(segment.make_beats(df, segment.BeatRules(use_embeddings=False, min_spans=2, max_spans=3)))
    assert all(2 <= len(b["span_ids"]) <= 3 for b in few) and sorted(b["position"] for b in few if b["episode_id"] == "E0") == list(range(sum(b["episode_id"] == "E0" for b in few)))


def test_semantic_beats(spark):
    v = [[1.0, 0.0], [0.9, 0.1], [0.0, 1.0], None, [0.0, 1.0]]
    data = [(f"s{k}", "E", float(k), k + 1.0, 1.0, "A", "x", x) for k, x in enumerate(v)]
    df = spark.createDataFrame(data, SPAN + ", embedding array<double>")
    assert [r["beat_no"] for r in sorted(rows(segment.beat_runs(df)), key=lambda r: r["span_id"])] == [1, 1, 2, 2, 2]


def walk_sections(beats, rules):
    out, acc, no = [], 0.0, 1
    least, target, most = (60 * x for x in (rules.min_minutes, rules.target_minutes, rules.max_minutes))
    for k, b in enumerate(beats):
        if k:
            p, longer = beats[k - 1], acc + b[4]
            sem = bool(p[6] and b[6] and p[6] != b[6])
            if acc < least:
                new = False
            elif rules.prefer_time_boundaries:
                new = longer >= target
            elif longer > most:
                new = sem if rules.allow_semantic_overflow else True
            elif acc >= 0.8 * target and sem:
                new = True
            else:
                new = b[2] - p[3] > 30
            no, acc = (no + 1, 0.0) if new else (no, acc)
        acc += b[4]
        out.append(no)
    return out


@pytest.mark.parametrize("rules", [segment.SectionRules(2, 1, 3), segment.SectionRules(2, 1, 3, allow_semantic_overflow=False), segment.SectionRules(2, 1, 3, prefer_time_boundaries=True)])
def test_sections_equal_a_plain_walk(spark, rules):
    r, data, t = random.Random(5), [], 0.0
    for k in range(80):
        t += r.choice([0, 0, 0, 40])
        d = float(r.randint(5, 70))
        data.append((f"b{k:03d}", "E", t, t + d, d, "x", r.choice(["p", "p", "q", None, ""])))
        t += d
    df = spark.createDataFrame(data, "beat_id string, episode_id string, start_time double, end_time double, duration double, text string, topic_label string").repartition(3)
    got = {x["beat_id"]: x["section_no"] for x in rows(segment.section_runs(df, rules))}
    assert [got[b[0]] for b in data] == walk_sections(data, rules)
    made = rows(segment.make_sections(df, rules))
    assert sorted(i for s in made for i in s["beat_ids"]) == [b[0] for b in data]
    assert {s["title"] for s in made} == {f"Section {k + 1}" for k in range(len(made))} and all(s["synopsis"] is None for s in made)
    stats = rows(segment.section_statistics(segment.make_sections(df, rules), rules))[0]
    assert stats["count"] == len(made) and 0 <= stats["in_range_pct"] <= 100


def test_sections_with_vectors(spark):
    data = [(f"b{k}", "E", 100.0 * k, 100.0 * (k + 1), 100.0, "x") for k in range(6)]
    beats = spark.createDataFrame(data, "beat_id string, episode_id string, start_time double, end_time double, duration double, text string")
    near, far = [1.0, 0.0], [0.0, 1.0]
    emb = spark.createDataFrame([(f"b{k}", near if k < 5 else far) for k in range(6)], "artifact_id string, embedding array<double>")
    got = rows(segment.section_runs(segment.with_vectors(beats, emb, True), segment.SectionRules(5, 3, 20)))
    assert {r["beat_id"]: r["section_no"] for r in got} == {f"b{k}": 1 if k < 5 else 2 for k in range(6)}
    with pytest.raises(ValueError, match="required"):
        segment.with_vectors(beats, emb.limit(2), True)
    with pytest.raises(ValueError, match="need embeddings"):
        segment.section_runs(beats, segment.SectionRules(require_embeddings=True))


def test_roles(spark):
    c = roles.RoleConfig(("Ann",), {"Bob": "host"}, "guest")
    spans = spark.createDataFrame([(f"s{k}", "E", float(k), k + 1.0, 1.0, s, t) for k, (s, t) in enumerate([("Ann", "xxxx"), ("Bob", "yy"), (" ", "z"), ("Cy", ""), ("Ann", "w")])], SPAN)
    e = roles.enrich_spans(spans, c)
    assert {r["span_id"]: (r["speaker_role"], r["is_expert"]) for r in rows(e)} == {"s0": ("expert", True), "s1": ("host", False), "s2": ("guest", False), "s3": ("guest", False), "s4": ("expert", True)}
    beats = spark.createDataFrame([("b", ["s0", "s1", "s4", "gone"]), ("c", ["s3"])], "beat_id string, span_ids array<string>")
    got = {r["beat_id"]: r for r in rows(roles.enrich_beats(beats, e))}
    assert got["b"]["speakers_set"] == ["Ann", "Bob"] and got["b"]["expert_span_ids"] == ["s0", "s4"] and got["b"]["expert_coverage_pct"] == pytest.approx(500 / 7)
    assert got["c"]["expert_coverage_pct"] == 0 and got["c"]["expert_span_ids"] == []
    counted = rows(roles.enrich_beats(beats, e.withColumn("token_count", F.when(F.col("span_id") == "s1", 3).otherwise(1).cast("long"))))
    assert next(r for r in counted if r["beat_id"] == "b")["expert_coverage_pct"] == pytest.approx(40)
    with pytest.raises(ValueError, match="role"):
        roles.RoleConfig(default_role="king")


IV = "k string, start_time double, end_time double, id int"


def iv(spark, spec):
    return spark.createDataFrame([("E", float(a), float(b), k) for k, (a, b) in enumerate(spec)], IV)


def test_gaps_overlaps_and_union(spark):
    df = iv(spark, [(0, 10), (15, 25), (23, 30)])
    eps = spark.createDataFrame([("E", 40.0), ("F", 7.0)], "k string, total double")
    got = sorted((r["k"], r["gap_start"], r["gap_end"], r["gap_duration"]) for r in rows(intervals.gaps(df, "k", eps, "total", tie="id")))
    assert got == [("E", 10, 15, 5), ("E", 30, 40, 10), ("F", 0, 7, 7)]
    assert [(r["overlap_start"], r["overlap_end"], r["segment_count"]) for r in rows(intervals.overlaps(df, "k"))] == [(23, 25, 2)]
    assert rows(intervals.union_duration(df, "k"))[0]["union_duration"] == 25
    nested = iv(spark, [(0, 20), (2, 4), (10, 12)])
    assert len(rows(intervals.gaps(nested, "k", eps.where("k = 'E'"), "total", tie="id"))) == 2 and len(rows(intervals.gaps(nested, "k", eps.where("k = 'E'"), "total", tie="id", strict=True))) == 1


def sweep(spec):
    """The reference sweep, plainly."""
    events = sorted([(a, 0) for a, _ in spec] + [(b, 1) for _, b in spec])
    active, since, most, out = 0, None, 0, []
    for t, kind in events:
        if kind == 0:
            active += 1
            if active >= 2:
                since, most = (t, active) if since is None else (since, max(most, active))
        else:
            if active >= 2 and since is not None and t > since:
                out.append((since, t, most))
            since = None
            active -= 1
            if active >= 2:
                since, most = t, active
    return out


def test_overlaps_equal_a_plain_sweep(spark):
    r = random.Random(9)
    data = {f"E{k}": [(a := r.randint(0, 40), a + r.randint(1, 12)) for _ in range(r.randint(1, 14))] for k in range(30)}
    df = spark.createDataFrame([(e, float(a), float(b), 0) for e, x in data.items() for a, b in x], IV)
    got: dict = {}
    for x in rows(intervals.overlaps(df, "k")):
        got.setdefault(x["k"], []).append((x["overlap_start"], x["overlap_end"], x["segment_count"]))
    for e, x in data.items():
        assert sorted(got.get(e, [])) == sweep(x), x


def test_union_never_exceeds_the_span(spark):
    r = random.Random(10)
    data = [(f"E{k % 9}", float(a := r.randint(0, 99)), float(a + r.randint(0, 20)), k) for k in range(300)]
    got = {x["k"]: x["union_duration"] for x in rows(intervals.union_duration(spark.createDataFrame(data, IV), "k"))}
    for e in got:
        own = [(a, b) for k, a, b, _ in data if k == e]
        assert got[e] == sum(any(a <= t < b for a, b in own) for t in range(130))


def test_regressions_and_adjacency(spark):
    assert [(r["id"], r["overlap"]) for r in rows(intervals.regressions(iv(spark, [(0, 5), (4, 6), (6, 7)]), ["k"], tie="id"))] == [(1, 1.0)]
    c = intervals.adjacent(F.lit("E"), F.lit(0.0), F.lit(5.0), F.lit("E"), F.lit(9.0), F.lit(12.0))
    assert spark.range(1).select(c.alias("x")).first().x is True
