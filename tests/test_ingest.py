import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import ingest
from tessera.sources import transcripts


def utt(**over):
    return {"episode_id": "EP", "start": 0, "end": 1.5, "speaker": "A", "text": "Hi", **over}


def kinds(spark, tmp_path, items):
    p = tmp_path / "x.jsonl"
    p.write_text("\n".join(json.dumps(x) for x in items))
    got = ingest.with_errors(transcripts.read_jsonl(spark, str(p))).orderBy("line").collect()
    return [[e.error_type for e in r.errors] for r in got]


def test_rules(spark, tmp_path):
    bad = {k: v for k, v in utt().items() if k != "speaker"}
    cases = [
        (utt(), []), (bad, ["missing_field"]), (utt(episode_id=" "), ["invalid_episode_id"]), (utt(episode_id=5), ["invalid_episode_id"]), (utt(start=-1), ["negative_timestamp"]), (utt(start=-2, end=-1), ["negative_timestamp", "negative_timestamp"]),
        (utt(end=0), ["invalid_time_range"]), (utt(start="0"), ["invalid_timestamp"]), (utt(end=True), ["invalid_timestamp"]), (utt(start=None), ["invalid_timestamp"]), (utt(speaker=""), ["invalid_speaker"]), (utt(text=None), ["invalid_text"]), (utt(text=7), ["invalid_text"]), (utt(text=" \t"), ["empty_text"]),
        (utt(speaker=None, text=""), ["invalid_speaker", "empty_text"]), (utt(more={"a": 1}), []),
    ]
    assert kinds(spark, tmp_path, [c for c, _ in cases]) == [k for _, k in cases]
    assert kinds(spark, tmp_path, [{"text": "x"}]) == [["missing_field"] * 4]


def test_jsonl_skips_blank_and_malformed_lines(spark, tmp_path):
    p = tmp_path / "a b.jsonl"
    p.write_text(f"{json.dumps(utt(text='one'))}\n\n{{broken\n[1]\n{json.dumps(utt(text='two é'))}\r\n")
    got = transcripts.read_transcript(spark, str(p)).orderBy("line").collect()
    assert [(r.line, r.text) for r in got] == [(0, "one"), (4, "two é")] and got[0].start_literal == "0" and got[0].end_literal == "1.5"
    assert [r.text for r in transcripts.iterate(transcripts.read_transcript(spark, str(p)).orderBy("line"))] == ["one", "two é"]


@pytest.mark.parametrize(("body", "texts"), [([utt(text="a"), utt(text="b")], ["a", "b"]), ({"utterances": [utt(text="c")]}, ["c"]), (utt(text="d"), ["d"]), ([], [])])
def test_json_forms(spark, tmp_path, body, texts):
    p = tmp_path / "x.json"
    p.write_text(json.dumps(body, indent=1))
    assert [r.text for r in transcripts.read_transcript(spark, str(p)).orderBy("line").collect()] == texts


def test_malformed_json_is_an_error(spark, tmp_path):
    (tmp_path / "x.json").write_text("{broken")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        transcripts.read_json(spark, str(tmp_path / "x.json")).collect()


def test_format_detection(spark, tmp_path):
    assert transcripts.is_jsonl("a.jsonl") and not transcripts.is_jsonl("a.json") and transcripts.is_jsonl("a.txt", "{}") and not transcripts.is_jsonl("a.txt", "{")
    p = tmp_path / "x.txt"
    p.write_text(json.dumps(utt()) + "\n" + json.dumps(utt()))
    assert transcripts.read_transcript(spark, str(p)).count() == 2


def test_directory_and_episode_ids(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text(json.dumps(utt(episode_id="X")))
    (tmp_path / "two #1.jsonl").write_text(json.dumps({"text": "y"}))
    (tmp_path / "skip.txt").write_text("{}")
    got = transcripts.read_directory(spark, str(tmp_path))
    assert got.count() == 2
    assert {r.episode_id for r in transcripts.episode_ids(got).collect()} == {"X", "two #1"}


def test_normalise_orders_numbers_and_carries(spark):
    rows = spark.createDataFrame([("E", 5.0, 6.0, "B", "y", 1, "k1"), ("E", 0.0, 2.0, "A", "x", 2, "k2"), ("F", 1.0, 2.0, "A", "z", 3, "k3")], "episode_id string, start double, `end` double, speaker string, text string, line int, extra string")
    got = ingest.normalise(rows).orderBy("episode_id", "position").collect()
    assert [(r.episode_id, r.position, r.duration, r.extra) for r in got] == [("E", 0, 2.0, "k2"), ("E", 1, 1.0, "k1"), ("F", 0, 1.0, "k3")]
    assert ingest.normalise(rows.repartition(5)).orderBy("episode_id", "position").select("utterance_id").collect() == [(r.utterance_id,) for r in got]
    with pytest.raises(Exception, match="more than one episode"):
        ingest.single_episode(rows).collect()
    assert ingest.single_episode(rows.where("episode_id = 'E'")).count() == 2
    assert ingest.new_episodes(rows, rows.where("episode_id = 'E'")).select(F.col("episode_id")).distinct().collect() == [("F",)]


def test_summary(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text("\n".join(json.dumps(x) for x in [utt(), utt(speaker="", text=""), utt(end=0)]))
    r = ingest.validation_summary(ingest.with_errors(transcripts.read_jsonl(spark, str(p)))).first()
    assert (r.total, r.valid, r.invalid, r.errors) == (3, 1, 2, 3)
    empty = ingest.validation_summary(ingest.with_errors(transcripts.read_jsonl(spark, str(p)).where("false"))).first()
    assert (empty.total, empty.errors) == (0, 0)
