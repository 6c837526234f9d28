import json

from tessera.streaming import spans


def test_speech_windows_and_spans(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [("E", 0, 2, "A"), ("E", 2, 4, "A"), ("E", 4.1, 6, "B"), ("E", 9, 11, "B"), ("F", 0, 3, "A"), ("F", -1, 3, "A")]
    (folder / "a.jsonl").write_text("\n".join(json.dumps({"episode_id": e, "start": a, "end": b, "speaker": s, "text": "x"}) for e, a, b, s in rows))
    stream = spans.utterance_stream(spark, str(folder))
    q = spans.speech_windows(stream).writeStream.format("memory").queryName("windows").outputMode("complete").start()
    q.processAllAvailable()
    q.stop()
    got = sorted((r.episode_id, r.start_time, r.end_time, r.utterances) for r in spark.table("windows").collect())
    assert got == [("E", 0, 6, 3), ("E", 9, 11, 1), ("F", 0, 3, 1)]


def test_span_processor():
    import pandas as pd

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, v):
            self.value = v

        def clear(self):
            self.value = None

    class Now:
        def getCurrentProcessingTimeInMs(self):
            return 5000

    class Handle:
        timers = ()

        def listTimers(self):
            return iter(self.timers)

        def deleteTimer(self, at):
            self.timers = tuple(t for t in self.timers if t != at)

        def registerTimer(self, at):
            self.timers += (at,)

        def getValueState(self, *a):
            return State()

    p = spans.SpanProcessor(0.5, 1.0, 60)
    p.init(handle := Handle())
    rows = pd.DataFrame([(0.0, 2.0, "A", "x"), (2.0, 4.0, "A", "y"), (4.0, 4.5, "B", "z"), (9.0, 11.0, "B", "w")], columns=["start", "end", "speaker", "text"])
    got = pd.concat(list(p.handleInputRows(("E",), iter([rows.iloc[:2], rows.iloc[2:]]), Now())))
    assert got.values.tolist() == [["E", "A", 0.0, 4.0, "x y", 2]]
    more = pd.concat(list(p.handleInputRows(("E",), iter([pd.DataFrame([(20.0, 21.0, "A", "v")], columns=rows.columns)]), Now())))
    assert more.values.tolist() == [["E", "B", 9.0, 11.0, "w", 1]] and handle.timers == (65000,)
    last = pd.concat(list(p.handleExpiredTimer(("E",), Now(), None)))
    assert last.values.tolist() == [["E", "A", 20.0, 21.0, "v", 1]] and not p.open.exists()
    assert list(p.handleExpiredTimer(("E",), Now(), None)) == []
