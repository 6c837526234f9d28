"""Ordered segmentation: utterances to spans, spans to beats, beats to sections.

Runs with a pairwise rule are islands over a window of the episode. The two accumulating rules (a beat's longest run, a
section's length) reset at their own breaks, which no window frame expresses; they are folds over the episode's ordered
array of small structs (`aggregate`), in the JVM. An episode is some hundred rows; islands cut the beats' arrays further.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import identity
from ..functions.vectors import cosine


@dataclass(frozen=True)
class SpanRules:
    min_duration: float = 1.0
    max_silence_gap: float = 0.5
    break_on_speaker_change: bool = True


@dataclass(frozen=True)
class BeatRules:
    similarity_threshold: float = 0.7
    min_spans: int = 1
    max_spans: int | None = None
    use_embeddings: bool = True
    max_gap: float = 5.0
    max_run: float = 180.0


@dataclass(frozen=True)
class SectionRules:
    target_minutes: float = 8.0
    min_minutes: float = 5.0
    max_minutes: float = 12.0
    allow_semantic_overflow: bool = True
    boundary_similarity: float = 0.5
    strong_multiplier: float = 0.6
    check_multiplier: float = 1.5
    prefer_time_boundaries: bool = False
    require_embeddings: bool = False
    near_target: float = 0.8
    max_gap: float = 30.0


REQUIRED = {
    "utterance": ["utterance_id", "episode_id", "start", "end", "speaker", "text"],
    "span": ["span_id", "episode_id", "start_time", "end_time", "speaker", "text"],
    "beat": ["beat_id", "episode_id", "start_time", "end_time", "text"],
}


def grouped(df: DataFrame, kind: str) -> DataFrame:
    """df checked for its kind's columns, without rows of a blank episode."""
    if lacking := [c for c in REQUIRED[kind] if c not in df.columns]:
        raise ValueError(f"{kind} rows lack {', '.join(lacking)}")
    return df.where(F.trim("episode_id") != "")


def _order(start: str, tie: str) -> Window:
    return Window.partitionBy("episode_id").orderBy(start, tie)


def _collect(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, str]) -> DataFrame:
    """A row for each group with `rows`, its ordered array of structs, of which columns name the fields."""
    fields = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(n) for n, c in columns.items()])
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(fields)).alias("rows"))


def _field(name: str) -> Callable[[Column], Column]:
    return lambda r: r[name]


def make_spans(utterances: DataFrame, rules: SpanRules = SpanRules()) -> DataFrame:
    """Spans: runs of an episode's utterances by one speaker (unless rules say otherwise) without longer silence.

    A run breaks where the silence since the end of the row before exceeds the limit. A span ends where its last row ends.
    Spans under the least duration are dropped before positions are given. Ties in start go by utterance_id."""
    w = _order("start", "utterance_id")
    gap = F.col("start") - F.lag("end").over(w) > rules.max_silence_gap
    change = F.lag("speaker").over(w) != F.col("speaker")
    new = F.coalesce(gap | change if rules.break_on_speaker_change else gap, F.lit(True))
    runs = grouped(utterances, "utterance").withColumn("run", F.sum(new.cast("int")).over(w))
    spans = _collect(runs, ["episode_id", "run"], ["start", "utterance_id"], {"end": "end", "speaker": "speaker", "text": "text"})
    spans = spans.select(
        "episode_id", F.col("rows")[0]["speaker"].alias("speaker"), F.col("rows")[0]["start"].alias("start_time"),
        F.element_at("rows", -1)["end"].alias("end_time"), F.array_join(F.transform("rows", _field("text")), " ").alias("text"),
        F.transform("rows", _field("utterance_id")).alias("utterance_ids"), "run",
    )
    spans = spans.withColumn("duration", F.col("end_time") - F.col("start_time")).where(F.col("duration") >= rules.min_duration)
    return _numbered(spans, "run", "span").drop("run")


def _numbered(df: DataFrame, order: str, kind: str) -> DataFrame:
    """df with its ids; positions are ranks among the rows kept."""
    w = Window.partitionBy("episode_id").orderBy(order)
    df = df.withColumn("position", (F.row_number().over(w) - 1).cast("long"))
    at = (F.col("episode_id"), F.col("position"))
    made = {
        "span": lambda: identity.span_id(*at, F.col("speaker"), F.col("utterance_ids"), F.col("text")),
        "beat": lambda: identity.beat_id(*at, F.col("span_ids"), F.col("text")),
        "section": lambda: identity.section_id(*at, F.col("beat_ids"), F.col("text")),
    }[kind]()
    return df.withColumn(f"{kind}_id", made)


def with_default_roles(spans: DataFrame) -> DataFrame:
    """Role columns for spans without a role table."""
    return spans.withColumn("speaker_canonical", F.col("speaker")).withColumn("speaker_role", F.lit("other")).withColumn("is_expert", F.lit(False))


def beat_runs(spans: DataFrame, rules: BeatRules = BeatRules()) -> DataFrame:
    """spans with `beat_no` within their episode.

    With embeddings (if rules and columns allow) a beat breaks where neighbours are less alike than the threshold. Otherwise
    it breaks at a change of speaker, a long gap, or when the summed durations since the last break, that of the row which
    opens a beat not counted, exceed the limit; each break resets the sum."""
    w = _order("start_time", "span_id")
    spans = grouped(spans, "span")
    if rules.use_embeddings and "embedding" in spans.columns:
        new = F.coalesce(cosine(F.lag("embedding").over(w), F.col("embedding"), clamp=True) < rules.similarity_threshold, F.lag("span_id").over(w).isNull())
        return spans.withColumn("beat_no", F.sum(new.cast("int")).over(w).cast("long"))
    hard = F.coalesce((F.lag("speaker").over(w) != F.col("speaker")) | (F.col("start_time") - F.lag("end_time").over(w) > rules.max_gap), F.lit(True))
    marked = spans.withColumn("_run", F.sum(hard.cast("int")).over(w)).withColumn("_pos", F.row_number().over(w))
    runs = marked.groupBy("episode_id", "_run").agg(F.array_sort(F.collect_list(F.struct("_pos", "duration"))).alias("rows"))
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("no"), F.array(F.lit(0)).alias("out"))

    def step(state: Column, row: Column) -> Column:
        total = state["sum"] + row["duration"]
        over = total > rules.max_run
        no = state["no"] + over.cast("int")
        return F.struct(F.when(over, 0.0).otherwise(total).alias("sum"), no.alias("no"), F.concat(state["out"], F.array(no)).alias("out"))

    folded = F.aggregate(F.slice("rows", 2, 1 << 30), start, step, lambda s: s["out"])
    inner = runs.select("episode_id", F.explode(F.arrays_zip(F.transform("rows", _field("_pos")).alias("p"), folded.alias("o"))).alias("z"))
    inner = inner.select("episode_id", F.col("z.p").alias("_pos"), F.col("z.o").alias("_in"))
    numbered = marked.join(inner, ["episode_id", "_pos"])
    back = Window.partitionBy("episode_id").orderBy("_pos")
    new = F.coalesce((F.lag("_run").over(back) != F.col("_run")) | (F.lag("_in").over(back) != F.col("_in")), F.lit(True))
    return numbered.withColumn("beat_no", F.sum(new.cast("int")).over(back).cast("long")).drop("_run", "_pos", "_in")


def make_beats(spans: DataFrame, rules: BeatRules = BeatRules()) -> DataFrame:
    """Beats of spans: groups under the least number of spans are dropped, longer ones than the most are cut at the end."""
    groups = _collect(beat_runs(spans, rules), ["episode_id", "beat_no"], ["start_time", "span_id"], {"end": "end_time", "text": "text"})
    groups = groups.where(F.size("rows") >= rules.min_spans)
    if rules.max_spans:
        groups = groups.withColumn("rows", F.slice("rows", 1, rules.max_spans))
    beats = groups.select(
        "episode_id", "beat_no", F.col("rows")[0]["start_time"].alias("start_time"), F.element_at("rows", -1)["end"].alias("end_time"),
        F.array_join(F.transform("rows", _field("text")), " ").alias("text"), F.transform("rows", _field("span_id")).alias("span_ids"), F.lit(None).cast("string").alias("topic_label"),
    )
    return _numbered(beats.withColumn("duration", F.col("end_time") - F.col("start_time")), "beat_no", "beat").drop("beat_no")


def with_vectors(beats: DataFrame, embeddings: DataFrame, require: bool = False, least_share: float = 0.8) -> DataFrame:
    """beats with their vectors by id (null where there is none). require: fewer than least_share with one is an error."""
    vectors = embeddings.select(F.col("artifact_id").alias("_id"), "embedding")
    out = beats.drop("embedding").join(vectors, F.col("beat_id") == F.col("_id"), "left").drop("_id")
    if require:
        share = out.agg(F.avg(F.col("embedding").isNotNull().cast("int"))).first()[0]
        if share is not None and share < least_share:
            raise ValueError(f"only {share:.0%} of the beats have a vector; {least_share:.0%} are required")
    return out


def section_runs(beats: DataFrame, rules: SectionRules = SectionRules()) -> DataFrame:
    """beats with `section_no` within their episode, by one fold over the episode's beats.

    The fold sums the durations of the open section. In order: below the least length no break; by time only, a break at the
    target; beyond the most, with overflow allowed, a break only at a semantic boundary (and no further rule), else always;
    a strong boundary from check_multiplier times the least on; any boundary near the target; a long gap."""
    beats = grouped(beats, "beat")
    if rules.require_embeddings and "embedding" not in beats.columns:
        raise ValueError("sections need embeddings of their beats; give them with_vectors() or set require_embeddings to False")
    w = _order("start_time", "beat_id")
    topics = F.lit(False)
    if "topic_label" in beats.columns:
        now, was = F.col("topic_label"), F.lag("topic_label").over(w)
        topics = F.coalesce((now != "") & (was != "") & (now != was), F.lit(False))
    if "embedding" in beats.columns:
        like = cosine(F.lag("embedding").over(w), F.col("embedding"), clamp=True)
        semantic = F.when(like.isNull(), topics).otherwise(like < rules.boundary_similarity)
        strong = F.coalesce(like < rules.boundary_similarity * rules.strong_multiplier, F.lit(False))
    else:
        semantic, strong = topics, F.lit(False)
    gap = F.coalesce(F.col("start_time") - F.lag("end_time").over(w), F.lit(0.0))
    marked = beats.withColumn("_pos", F.row_number().over(w)).withColumn("_sem", semantic).withColumn("_strong", strong).withColumn("_gap", gap)
    rows = marked.groupBy("episode_id").agg(F.array_sort(F.collect_list(F.struct("_pos", "duration", "_sem", "_strong", "_gap"))).alias("rows"))
    least, target, most = (60.0 * x for x in (rules.min_minutes, rules.target_minutes, rules.max_minutes))

    def breaks(length: Column, row: Column) -> Column:
        longer = length + row["duration"]
        if rules.prefer_time_boundaries:
            return (length >= least) & (longer >= target)
        rule = F.when(length < least, False).when(longer > most, row["_sem"] if rules.allow_semantic_overflow else F.lit(True))
        rule = rule.when((length >= least * rules.check_multiplier) & row["_sem"] & row["_strong"], True)
        return rule.when((length >= target * rules.near_target) & row["_sem"], True).otherwise(row["_gap"] > rules.max_gap)

    def step(state: Column, row: Column) -> Column:
        new = (F.size(state["out"]) > 0) & breaks(state["sum"], row)
        no = state["no"] + new.cast("int")
        return F.struct(F.when(new, row["duration"]).otherwise(state["sum"] + row["duration"]).alias("sum"), no.alias("no"), F.concat(state["out"], F.array(no)).alias("out"))

    start = F.struct(F.lit(0.0).alias("sum"), F.lit(1).alias("no"), F.array().cast("array<int>").alias("out"))
    folded = F.aggregate("rows", start, step, lambda s: s["out"])
    numbers = rows.select("episode_id", F.posexplode(folded).alias("p", "section_no"))
    numbers = numbers.select("episode_id", (F.col("p") + 1).alias("_pos"), F.col("section_no").cast("long"))
    return marked.join(numbers, ["episode_id", "_pos"]).drop("_pos", "_sem", "_strong", "_gap")


def make_sections(beats: DataFrame, rules: SectionRules = SectionRules()) -> DataFrame:
    """Sections of beats, with a numbered title and no synopsis yet; durations in minutes."""
    groups = _collect(section_runs(beats, rules), ["episode_id", "section_no"], ["start_time", "beat_id"], {"end": "end_time", "text": "text"})
    out = groups.select(
        "episode_id", "section_no", F.col("rows")[0]["start_time"].alias("start_time"), F.element_at("rows", -1)["end"].alias("end_time"),
        F.array_join(F.transform("rows", _field("text")), " ").alias("text"), F.transform("rows", _field("beat_id")).alias("beat_ids"),
    )
    out = out.withColumn("duration_minutes", (F.col("end_time") - F.col("start_time")) / 60.0)
    out = _numbered(out, "section_no", "section")
    return out.withColumn("title", F.concat(F.lit("Section "), (F.col("position") + 1).cast("string"))).withColumn("synopsis", F.lit(None).cast("string")).drop("section_no")


def within_guardrail(df: DataFrame, most_seconds: float) -> DataFrame:
    """Rows no longer than that; ids stay as they are."""
    return df.where(F.col("duration") <= most_seconds)


def utterance_statistics(utterances: DataFrame) -> DataFrame:
    return utterances.agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"), F.min("start").alias("min_start"),
        F.max("end").alias("max_end"), F.array_sort(F.collect_set("speaker")).alias("speakers"),
    )


def segment_statistics(df: DataFrame, children: str) -> DataFrame:
    """Figures of spans (children utterance_ids) or beats (span_ids)."""
    extra = [F.countDistinct("speaker").alias("speakers")] if "speaker" in df.columns else []
    return df.agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("duration"), F.lit(0.0)).alias("total_duration"), F.avg("duration").alias("avg_duration"),
        F.min("duration").alias("min_duration"), F.max("duration").alias("max_duration"), F.coalesce(F.sum(F.size(children)), F.lit(0)).alias("total_children"),
        F.avg(F.size(children)).alias("avg_children"), *extra,
    )


def section_statistics(sections: DataFrame, rules: SectionRules = SectionRules()) -> DataFrame:
    inside = F.count_if(F.col("duration_minutes").between(rules.min_minutes, rules.max_minutes))
    return sections.agg(
        F.count(F.lit(1)).alias("count"), F.coalesce(F.sum("duration_minutes"), F.lit(0.0)).alias("total_minutes"), F.avg("duration_minutes").alias("avg_minutes"),
        F.min("duration_minutes").alias("min_minutes"), F.max("duration_minutes").alias("max_minutes"), inside.alias("in_range"),
        (100.0 * inside / F.count(F.lit(1))).alias("in_range_pct"), F.avg(F.size("beat_ids")).alias("avg_children"),
    )
