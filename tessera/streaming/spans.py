"""Streams of utterances: validated ingestion, and spans as they close."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import ingest

RAW = "episode_id string, start double, `end` double, speaker string, text string, ingested timestamp"
SPAN = "episode_id string, speaker string, start_time double, end_time double, text string, utterances int"


def utterance_stream(spark: SparkSession, folder: str, pattern: str = "*.jsonl", max_files: int = 100) -> DataFrame:
    """Valid utterances of JSON-lines files as they arrive in a folder; `ingested` is their time of arrival where they give none."""
    rows = spark.readStream.schema(RAW).option("maxFilesPerTrigger", max_files).option("pathGlobFilter", pattern).json(folder)
    return ingest.valid_rows(ingest.with_errors(rows)).withColumn("ingested", F.coalesce("ingested", F.current_timestamp()))


def speech_windows(stream: DataFrame, gap_seconds: float = 0.5, late: str = "10 minutes") -> DataFrame:
    """Spans by the silence rule alone: session windows over event time (seconds of the episode from the epoch), per episode."""
    timed = stream.withColumn("at", F.timestamp_micros((F.col("start") * 1_000_000).cast("long"))).withColumn("long", F.col("end") - F.col("start") + gap_seconds)
    session = F.session_window("at", F.concat((F.col("long") * 1000).cast("long").cast("string"), F.lit(" milliseconds")))
    return timed.withWatermark("at", late).groupBy("episode_id", session).agg(F.min("start").alias("start_time"), F.max("end").alias("end_time"), F.count(F.lit(1)).alias("utterances"))


class SpanProcessor(StatefulProcessor):
    """The open span of each episode; a change of speaker or longer silence closes it. Rows of an episode must come in order of files.

    An episode that gets no rows for `idle_seconds` of processing time has its last span closed and its state removed."""

    def __init__(self, max_gap: float, min_duration: float, idle_seconds: float = 600.0) -> None:
        self.max_gap, self.min_duration, self.idle_ms = max_gap, min_duration, int(idle_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "speaker string, start_time double, end_time double, text string, utterances int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now, closed = self.open.get() if self.open.exists() else None, []
        for r in pd.concat(list(rows)).sort_values(["start", "end"], kind="stable").itertuples():
            if now is not None and r.speaker == now[0] and r.start - now[2] <= self.max_gap:
                now = (now[0], now[1], r.end, f"{now[3]} {r.text}", now[4] + 1)
            else:
                if now is not None:
                    closed.append(now)
                now = (r.speaker, r.start, r.end, r.text, 1)
        if now is not None:
            self.open.update(now)
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield from self._kept(key, closed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last = [self.open.get()] if self.open.exists() else []
        self.open.clear()
        yield from self._kept(key, last)

    def _kept(self, key, closed: list) -> Iterator[pd.DataFrame]:
        kept = [(key[0], *s) for s in closed if s[2] - s[1] >= self.min_duration]
        if kept:
            yield pd.DataFrame(kept, columns=["episode_id", "speaker", "start_time", "end_time", "text", "utterances"])

    def close(self) -> None:
        pass


def span_stream(stream: DataFrame, max_gap: float = 0.5, min_duration: float = 1.0, idle_seconds: float = 600.0) -> DataFrame:
    """Spans by speaker and silence, each emitted when the next one of its episode begins, the last one when the episode has been idle.

    Needs the RocksDB state store. Timers fire with the batches, so a trigger must go on after the last files."""
    return stream.groupBy("episode_id").transformWithStateInPandas(SpanProcessor(max_gap, min_duration, idle_seconds), SPAN, "Append", "ProcessingTime")
