"""The queries over the driver's tables, and their SQL twins, one for each operator that SQL can express."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identity, text
from ..functions import vectors as vec
from ..operators import catalogs, checks, ingest, intervals, neighbours, quality, roles, rules, segment, vectors
from ..scratch import save
from . import relations
from .relations import INTERVALS, UTTERANCES, VECTORS, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rules for the short episodes that conversations make.
SPANS, BEATS = segment.SpanRules(), segment.BeatRules(use_embeddings=False, max_run=60.0)
SECTIONS = segment.SectionRules(target_minutes=2.0, min_minutes=1.0, max_minutes=3.0)
SECTIONS_BY_TIME = segment.SectionRules(target_minutes=2.0, min_minutes=1.0, max_minutes=3.0, prefer_time_boundaries=True)
EXPERTS = roles.RoleConfig(experts=("assistant",), roles={"system": "host"}, default_role="guest")


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def r(x: str, n: int = 2) -> str:
    """round() on the decimal text of a double, as Spark rounds."""
    return f"round(({x})::decimal(32,12), {n})::double"


def with_(*ctes: str) -> str:
    return "with recursive " + ",\n".join(ctes) + "\n"


# Ingestion


@query(f"{with_(UTTERANCES)} select utterance_id, episode_id, start, \"end\", speaker, duration, row_number() over (partition by episode_id order by start, utterance_id) - 1 as position, 'utt_' || substr(sha256(episode_id), 1, 12) || '_' || lpad((row_number() over (partition by episode_id order by start, utterance_id) - 1)::varchar, 6, '0') || '_' || substr(sha256('{{\"end\": ' || regexp_replace(printf('%.2f', round_even(\"end\", 2)), '0$', '') || ', \"speaker\": \"' || speaker || '\", \"start\": ' || regexp_replace(printf('%.2f', round_even(start, 2)), '0$', '') || ', \"text\": \"' || replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(9), '\\t') || '\"}}'), 1, 8) as content_id from u")
def utterance_normalize(spark, sf_dir):
    u = relations.utterances(spark, sf_dir).withColumnRenamed("utterance_id", "key")
    n = ingest.normalise(u, "key")
    return n.select(F.col("key").alias("utterance_id"), "episode_id", "start", "end", "speaker", "duration", "position", F.col("utterance_id").alias("content_id"))


DEFECTS = f"{with_(UTTERANCES)}, d as (select case when hash % 11 = 0 then '  ' else episode_id end as episode_id, case when hash % 7 = 0 then -start - 1 else start end as start, case when hash % 5 = 0 then start else \"end\" end as \"end\", case when hash % 13 = 0 then '' else speaker end as speaker, case when hash % 17 = 0 then ' ' else text end as text from (select *, length(text) as hash from u))"


def _defective(spark, sf_dir):
    u = relations.utterances(spark, sf_dir).withColumn("h", F.length("text"))
    bad = lambda k, c, v: F.when(F.col("h") % k == 0, v).otherwise(F.col(c)).alias(c)
    return u.select(bad(11, "episode_id", F.lit("  ")), bad(7, "start", -F.col("start") - 1), F.when(F.col("h") % 5 == 0, F.col("start")).otherwise(F.col("end")).alias("end"), bad(13, "speaker", F.lit("")), bad(17, "text", F.lit(" ")))


@query(f"{DEFECTS}, x as (select unnest([case when trim(episode_id) = '' then 'invalid_episode_id' end, case when start < 0 then 'negative_timestamp' end, case when \"end\" < 0 then 'negative_timestamp' end, case when \"end\" <= start then 'invalid_time_range' end, case when trim(speaker) = '' then 'invalid_speaker' end, case when trim(text) = '' then 'empty_text' end]) as error_type from d) select error_type, count(*) as errors from x where error_type is not null group by 1")
def validation_rules(spark, sf_dir):
    c = ingest.with_errors(_defective(spark, sf_dir))
    return c.select(F.explode("errors.error_type").alias("error_type")).groupBy("error_type").agg(F.count(F.lit(1)).alias("errors"))


@query(f"{DEFECTS}, x as (select (trim(episode_id) = '')::int + (start < 0)::int + (\"end\" < 0)::int + (\"end\" <= start)::int + (trim(speaker) = '')::int + (trim(text) = '')::int as e from d) select count(*) as total, count(*) filter (e = 0) as valid, count(*) filter (e > 0) as invalid, sum(e)::bigint as errors from x")
def validation_summary(spark, sf_dir):
    return ingest.validation_summary(ingest.with_errors(_defective(spark, sf_dir)))


@query(f"{with_(UTTERANCES)} select utterance_id, episode_id from u where episode_id not in (select conv_id::varchar from conversations where conv_id % 3 = 0)")
def incremental_antijoin(spark, sf_dir):
    stored = table(spark, sf_dir, "conversations").where("conv_id % 3 = 0").select(F.col("conv_id").cast("string").alias("episode_id"))
    return ingest.new_episodes(relations.utterances(spark, sf_dir), stored).select("utterance_id", "episode_id")


@query("select event_id, json_extract_string(props, '$.k') as k, length(props)::int as n from events")
def json_source(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.length("props").alias("n"))


# Segmentation

SPAN_SQL = """f as (select *, case when lag(speaker) over w is distinct from speaker or start - lag("end") over w > 0.5 then 1 else 0 end as brk from u window w as (partition by episode_id order by start, utterance_id)),
rn as (select *, sum(brk) over (partition by episode_id order by start, utterance_id rows unbounded preceding) as run from f),
s0 as (select episode_id, run, arg_min(speaker, utterance_id) as speaker, min(start) as start_time, arg_max("end", utterance_id) as end_time, string_agg(text, ' ' order by utterance_id) as text, list(utterance_id order by utterance_id) as ids from rn group by 1, 2),
s1 as (select *, end_time - start_time as duration, row_number() over (partition by episode_id order by run) - 1 as position from s0 where end_time - start_time >= 1.0),
sp as (select *, 'spn_' || substr(sha256(episode_id), 1, 12) || '_' || lpad(position::varchar, 6, '0') || '_' || substr(sha256('{"speaker": "' || speaker || '", "text_hash": "' || substr(sha256(text), 1, 16) || '", "utterance_ids": ["' || array_to_string(list_sort(ids), '", "') || '"]}'), 1, 8) as span_id from s1)"""

BEAT_SQL = """q as (select *, row_number() over w as k, coalesce(lag(speaker) over w is distinct from speaker or start_time - lag(end_time) over w > 5.0, true) as hard from sp window w as (partition by episode_id order by start_time, span_id)),
fold as (select episode_id, k, 0.0::double as acc, 1 as beat_no from q where k = 1
  union all select q.episode_id, q.k, case when q.hard or fold.acc + q.duration > 60 then 0.0 else fold.acc + q.duration end, fold.beat_no + (q.hard or fold.acc + q.duration > 60)::int from fold join q on q.episode_id = fold.episode_id and q.k = fold.k + 1),
b0 as (select q.episode_id, beat_no, min(start_time) as start_time, arg_max(end_time, q.k) as end_time, string_agg(text, ' ' order by q.k) as text, list(span_id order by q.k) as span_ids from q join fold on q.episode_id = fold.episode_id and q.k = fold.k group by 1, 2),
bt as (select *, end_time - start_time as duration, 'bet_' || substr(sha256(episode_id), 1, 12) || '_' || lpad((beat_no - 1)::varchar, 6, '0') || '_' || substr(sha256('{"span_ids": ["' || array_to_string(list_sort(span_ids), '", "') || '"], "text_hash": "' || substr(sha256(text), 1, 16) || '"}'), 1, 8) as beat_id from b0)"""


def _spans(spark, sf_dir):
    return segment.make_spans(relations.utterances(spark, sf_dir), SPANS)


def _beats(spark, sf_dir):
    return segment.make_beats(_spans(spark, sf_dir), BEATS)


@query(f"{with_(UTTERANCES, SPAN_SQL)} select span_id, episode_id, speaker, start_time, end_time, duration, md5(text) as text_md5, len(ids)::int as utterances from sp")
def spans_islands(spark, sf_dir):
    return _spans(spark, sf_dir).select("span_id", "episode_id", "speaker", "start_time", "end_time", "duration", F.md5("text").alias("text_md5"), F.size("utterance_ids").alias("utterances"))


@query(f"{with_(UTTERANCES, SPAN_SQL)} select count(*) as count, sum(duration) as total_duration, avg(duration) as avg_duration, min(duration) as min_duration, max(duration) as max_duration, sum(len(ids))::bigint as total_children, avg(len(ids)) as avg_children, count(distinct speaker) as speakers from sp")
def span_statistics(spark, sf_dir):
    return segment.segment_statistics(_spans(spark, sf_dir), "utterance_ids")


@query(f"{with_(UTTERANCES)} select count(*) as count, sum(duration) as total_duration, min(start) as min_start, max(\"end\") as max_end, array_to_string(list_sort(list(distinct speaker)), ',') as speakers from u")
def utterance_statistics(spark, sf_dir):
    return segment.utterance_statistics(relations.utterances(spark, sf_dir)).withColumn("speakers", F.array_join("speakers", ","))


@query(f"{with_(UTTERANCES, SPAN_SQL, BEAT_SQL)} select beat_id, episode_id, start_time, end_time, duration, md5(text) as text_md5, len(span_ids)::int as spans from bt")
def beats_heuristic(spark, sf_dir):
    return _beats(spark, sf_dir).select("beat_id", "episode_id", "start_time", "end_time", "duration", F.md5("text").alias("text_md5"), F.size("span_ids").alias("spans"))


@query(f"{with_(UTTERANCES, SPAN_SQL, BEAT_SQL)} select count(*) as count, sum(duration) as total_duration, avg(duration) as avg_duration, min(duration) as min_duration, max(duration) as max_duration, sum(len(span_ids))::bigint as total_children, avg(len(span_ids)) as avg_children from bt")
def beat_statistics(spark, sf_dir):
    return segment.segment_statistics(_beats(spark, sf_dir), "span_ids")


@query(f"{with_(UTTERANCES, SPAN_SQL, BEAT_SQL)} select beat_id from bt where duration <= 45")
def duration_guardrail(spark, sf_dir):
    return segment.within_guardrail(_beats(spark, sf_dir), 45.0).select("beat_id")


@query(f"""{with_(VECTORS)}, s as (select *, lag(v) over w as p, lag(artifact_id) over w as pid from e window w as (partition by speaker order by artifact_id)),
c as (select artifact_id, speaker, sum((pid is null or list_dot_product(p, v) / ((sqrt(list_dot_product(p, p)) + 1e-8) * (sqrt(list_dot_product(v, v)) + 1e-8)) < 0.7)::int) over (partition by speaker order by artifact_id rows unbounded preceding)::bigint as beat_no from s)
select speaker, beat_no, min(artifact_id) as first_id, count(*) as spans from c group by 1, 2""")
def beats_semantic(spark, sf_dir):
    v = relations.vectors(spark, sf_dir).select(F.col("artifact_id").alias("span_id"), F.col("speaker").cast("string").alias("episode_id"), F.col("speaker"), F.lit("t").alias("text"), "start_time", "end_time", "embedding")
    return segment.beat_runs(v).groupBy("speaker", "beat_no").agg(F.min("span_id").alias("first_id"), F.count(F.lit(1)).alias("spans"))


def _section_sql(rule: str) -> str:
    return with_(UTTERANCES, SPAN_SQL, BEAT_SQL, f"""z as (select *, row_number() over w as k, coalesce(substr(md5(text), 1, 1) <> substr(md5(lag(text) over w), 1, 1), false) as sem, coalesce(start_time - lag(end_time) over w, 0) as gap from bt window w as (partition by episode_id order by start_time, beat_id)),
sf as (select episode_id, k, duration as acc, 1 as section_no from z where k = 1
  union all select z.episode_id, z.k, case when {rule} then z.duration else sf.acc + z.duration end, sf.section_no + ({rule})::int from sf join z on z.episode_id = sf.episode_id and z.k = sf.k + 1)""") + "select z.episode_id, section_no::bigint as section_no, min(start_time) as start_time, arg_max(end_time, z.k) as end_time, (arg_max(end_time, z.k) - min(start_time)) / 60.0 as duration_minutes, count(*)::int as beats, 'Section ' || section_no as title from z join sf on z.episode_id = sf.episode_id and z.k = sf.k group by z.episode_id, section_no"


def _sections(spark, sf_dir, rules):
    beats = _beats(spark, sf_dir).withColumn("topic_label", F.substring(F.md5("text"), 1, 1))
    s = segment.make_sections(beats, rules)
    return s.select("episode_id", (F.col("position") + 1).alias("section_no"), "start_time", "end_time", "duration_minutes", F.size("beat_ids").alias("beats"), "title")


@query(_section_sql("case when sf.acc < 60 then false when sf.acc + z.duration > 180 then z.sem when sf.acc >= 96 and z.sem then true else z.gap > 30 end"))
def sections_fold(spark, sf_dir):
    return _sections(spark, sf_dir, SECTIONS)


@query(_section_sql("sf.acc >= 60 and sf.acc + z.duration >= 120"))
def sections_by_time(spark, sf_dir):
    return _sections(spark, sf_dir, SECTIONS_BY_TIME)


@query(f"{with_(UTTERANCES, SPAN_SQL)} select span_id, speaker as speaker_canonical, case speaker when 'system' then 'host' when 'assistant' then 'expert' else 'guest' end as speaker_role, speaker = 'assistant' as is_expert from sp")
def roles_enrichment(spark, sf_dir):
    return roles.enrich_spans(_spans(spark, sf_dir), EXPERTS).select("span_id", "speaker_canonical", "speaker_role", "is_expert")


@query(f"""{with_(UTTERANCES, SPAN_SQL, BEAT_SQL)}, x as (select beat_id, unnest(span_ids) as span_id, unnest(range(len(span_ids))) as pos from bt),
y as (select beat_id, pos, speaker, x.span_id, length(text) as c from x join sp on x.span_id = sp.span_id)
select beat_id, array_to_string(list_sort(list(distinct speaker)), ',') as speakers, count(*) filter (speaker = 'assistant')::int as expert_spans, {r("sum(c) filter (speaker = 'assistant') * 100.0 / sum(c)", 6)} as expert_pct from y group by beat_id""".replace("sum(c) filter (speaker = 'assistant')", "coalesce(sum(c) filter (speaker = 'assistant'), 0)"))
def expert_coverage(spark, sf_dir):
    spans = roles.enrich_spans(_spans(spark, sf_dir), EXPERTS)
    b = roles.enrich_beats(segment.make_beats(spans, BEATS), spans)
    return b.select("beat_id", F.array_join(F.array_sort("speakers_set"), ",").alias("speakers"), F.size("expert_span_ids").alias("expert_spans"), F.round("expert_coverage_pct", 6).alias("expert_pct"))


@query(f"{with_(UTTERANCES, SPAN_SQL)} select episode_id, count(*) as spans, min(start_time) as first_start, max(end_time) as last_end, sum(duration) as seconds, count(distinct speaker) as speakers from sp group by 1")
def episode_spans(spark, sf_dir):
    s = _spans(spark, sf_dir)
    return s.groupBy("episode_id").agg(F.count(F.lit(1)).alias("spans"), F.min("start_time").alias("first_start"), F.max("end_time").alias("last_end"), F.sum("duration").alias("seconds"), F.count_distinct("speaker").alias("speakers"))


# Interval algebra

ISLAND_SQL = """i0 as (select *, max(end_time) over (partition by episode_id order by start_time, segment_id rows between unbounded preceding and 1 preceding) as before from iv),
i1 as (select *, sum((before is null or start_time > before)::int) over (partition by episode_id order by start_time, segment_id rows unbounded preceding) as island from i0)"""


@query(f"{with_(INTERVALS, ISLAND_SQL)} select episode_id, {r('sum(len)', 3)} as covered from (select episode_id, island, max(end_time) - min(start_time) as len from i1 group by 1, 2) group by 1")
def interval_union_coverage(spark, sf_dir):
    u = intervals.union_duration(relations.intervals(spark, sf_dir), "episode_id", tie="segment_id")
    return u.select("episode_id", F.round("union_duration", 3).alias("covered"))


@query(f"""{with_(INTERVALS)}, w as (select episode_id, start_time - b as start_time, end_time - b as end_time, segment_id from (select *, min(start_time) over (partition by episode_id) - 100 as b from iv)),
t as (select episode_id, max(end_time) + 50 as total from w group by 1),
g as (select episode_id, coalesce(lag(end_time) over (partition by episode_id order by start_time, segment_id), 0) as a, start_time as b from w
  union all select t.episode_id, x.e, t.total from t join (select episode_id, arg_max(end_time, (start_time, segment_id)) as e from w group by 1) x on x.episode_id = t.episode_id)
select episode_id, {r('a', 3)} as gap_start, {r('b', 3)} as gap_end, {r('b - a')} as gap_duration from g where b > a""")
def gaps(spark, sf_dir):
    w, t = _from_zero(spark, sf_dir)
    g = intervals.gaps(w, "episode_id", t, "total", tie="segment_id")
    return g.select("episode_id", F.round("gap_start", 3).alias("gap_start"), F.round("gap_end", 3).alias("gap_end"), "gap_duration")


def _from_zero(spark, sf_dir):
    """Intervals counted from 100 seconds before an episode's first, and lengths that end 50 after its last."""
    iv = relations.intervals(spark, sf_dir)
    base = iv.groupBy("episode_id").agg((F.min("start_time") - 100).alias("b"))
    w = iv.join(base, "episode_id").select("episode_id", "segment_id", (F.col("start_time") - F.col("b")).alias("start_time"), (F.col("end_time") - F.col("b")).alias("end_time"))
    return w, w.groupBy("episode_id").agg((F.max("end_time") + 50).alias("total"))


@query(f"""{with_(INTERVALS)}, ev as (select episode_id, start_time as t, 1 as d from iv union all select episode_id, end_time, -1 from iv),
p as (select distinct episode_id, t from ev), seg as (select episode_id, t as a, lead(t) over (partition by episode_id order by t) as b from p),
act as (select episode_id, t, sum(sum(d)) over (partition by episode_id order by t) as n from ev group by 1, 2)
select seg.episode_id, {r('sum(b - a)', 1)} as overlapped from seg join act on act.episode_id = seg.episode_id and act.t = seg.a where n >= 2 and b is not null group by 1""")
def overlap_total(spark, sf_dir):
    o = intervals.overlaps(relations.intervals(spark, sf_dir), "episode_id")
    return o.groupBy("episode_id").agg(F.round(F.sum(F.col("overlap_end") - F.col("overlap_start")), 1).alias("overlapped"))


@query(f"""{with_(INTERVALS)}, ends as (select distinct episode_id, end_time as t from iv),
c as (select ends.episode_id, t, count(*) filter (start_time <= t and end_time >= t) as active from ends join iv on iv.episode_id = ends.episode_id and start_time <= t and end_time >= t group by 1, 2)
select episode_id, count(*) as pieces, max(active)::bigint as deepest from (select c.episode_id, c.t, active, (select max(t) from ends e where e.episode_id = c.episode_id and e.t < c.t) as prev from c where active >= 2) where exists (select 1 from iv where iv.episode_id = episode_id and start_time < t) group by 1""")
def overlap_pieces(spark, sf_dir):
    o = intervals.overlaps(relations.intervals(spark, sf_dir), "episode_id")
    return o.groupBy("episode_id").agg(F.count(F.lit(1)).alias("pieces"), F.max("segment_count").alias("deepest"))


@query(f"""{with_(INTERVALS)}, e as (select 'episode' as level, lag(end_time) over (partition by episode_id order by start_time, segment_id) as p, start_time from iv
union all select 'speaker', lag(end_time) over (partition by episode_id, speaker order by start_time, segment_id), start_time from iv)
select count(*) filter (level = 'episode' and p > start_time) as episode_regression_count, count(*) filter (level = 'speaker' and p > start_time) as speaker_regression_count from e""")
def monotonicity(spark, sf_dir):
    return quality.regression_counts(relations.intervals(spark, sf_dir), "segment_id")


# Catalogs


@query(f"""{with_(UTTERANCES)} select source_file, episode_id, min(start) as start_time, max("end") as end_time, count(*) as utterance_count, count(distinct speaker) as speaker_count, array_to_string(list_sort(list(distinct speaker)), ', ') as speaker_list,
max("end") - min(start) as duration, episode_id as title, null::varchar as date, {r('(max("end") - min(start)) / 60')} as duration_minutes, {r('(max("end") - min(start)) / count(*)')} as avg_utterance_duration from u group by 1, 2""")
def episode_catalog(spark, sf_dir):
    return catalogs.episode_catalog(relations.utterances(spark, sf_dir))


@query(f"{with_(UTTERANCES)} select episode_id, min(start) as start_time, max(\"end\") as end_time, count(*) as utterance_count, count(distinct speaker) as speaker_count, avg(\"end\" - start) as avg_duration from u where episode_id = '7' group by 1")
def episode_summary(spark, sf_dir):
    return catalogs.episode_summary(relations.utterances(spark, sf_dir), "7")


SPEAKER_SQL = f"""lv as (select source_file, speaker, count(distinct episode_id) as eps, count(*) as n, sum("end" - start) as t, avg("end" - start) as m, min("end" - start) as lo, max("end" - start) as hi from u group by 1, 2),
sc as (select speaker as speaker_name, sum(eps)::bigint as episode_count, sum(n)::bigint as total_utterances, sum(t) as total_duration, avg(m) as avg_m, min(lo) as min_duration, max(hi) as max_duration from lv group by 1)"""


@query(f"{with_(UTTERANCES, SPEAKER_SQL)} select speaker_name, episode_count, total_utterances, total_duration, {r('avg_m', 9)} as avg_duration, min_duration, max_duration, {r('total_duration / total_utterances', 9)} as weighted_avg_duration, {r('total_duration / 60')} as total_minutes, {r('total_duration / 3600')} as total_hours, {r('total_utterances / episode_count')} as utterance_frequency, {r('episode_count / (select count(distinct source_file) from u)', 4)} as participation from sc")
def speaker_rollup(spark, sf_dir):
    c = catalogs.speaker_catalog(relations.utterances(spark, sf_dir)).drop("episode_list")
    return c.withColumn("avg_duration", F.round("avg_duration", 9)).withColumn("weighted_avg_duration", F.round("weighted_avg_duration", 9))


@query(f"{with_(UTTERANCES, SPEAKER_SQL)} select speaker_name, total_utterances, row_number() over (order by total_utterances desc, speaker_name)::int as rank from sc qualify rank <= 2")
def speaker_rankings(spark, sf_dir):
    return catalogs.rankings(catalogs.speaker_catalog(relations.utterances(spark, sf_dir)), "total_utterances", 2).select("speaker_name", "total_utterances", "rank")


@query(f"{with_(UTTERANCES)} select speaker, count(distinct episode_id) as episodes, count(*) as utterances, sum(duration) as total_duration, avg(duration) as avg_duration, min(duration) as min_duration, max(duration) as max_duration from u where speaker = 'user' group by 1")
def speaker_summary(spark, sf_dir):
    return catalogs.speaker_summary(relations.utterances(spark, sf_dir), "user")


@query(f"{with_(UTTERANCES)}, c as (select episode_id, max(\"end\") - min(start) as duration, count(*) as n from u group by 1) select count(*) as episodes, sum(duration) as total_duration, avg(duration) as avg_duration, min(duration) as min_duration, max(duration) as max_duration, sum(n)::bigint as total_utterances, avg(n) as avg_utterances, (select count(distinct speaker) from u) as distinct_speakers from c")
def catalog_statistics(spark, sf_dir):
    return catalogs.episode_statistics(catalogs.episode_catalog(relations.utterances(spark, sf_dir)))


@query(f"{with_(UTTERANCES, SPEAKER_SQL)} select count(*) as speakers, sum(total_duration) as total_duration, avg(total_duration) as avg_duration, max(total_duration) as max_duration, sum(total_utterances)::bigint as total_utterances, arg_max(speaker_name, (total_utterances, speaker_name)) as most_active, arg_max(speaker_name, (episode_count, speaker_name)) as most_frequent from sc")
def speaker_statistics(spark, sf_dir):
    return catalogs.speaker_statistics(catalogs.speaker_catalog(relations.utterances(spark, sf_dir)))


# Quality


@query(f"""{with_(INTERVALS, ISLAND_SQL)}, t as (select episode_id, max(end_time) - min(start_time) + 1000 as total, count(*) as n, sum(end_time - start_time) as s from iv group by 1), c as (select episode_id, sum(len) as len from (select episode_id, island, max(end_time) - min(start_time) as len from i1 group by 1, 2) group by 1)
select t.episode_id, n as span_count, n as beat_count, {r('least(len / total * 100, 100)', 1)} as span_pct, {r('s / total * 100', 1)} as beat_pct from t join c on c.episode_id = t.episode_id""")
def episode_coverage(spark, sf_dir):
    iv = relations.intervals(spark, sf_dir)
    eps = iv.groupBy("episode_id").agg((F.max("end_time") - F.min("start_time") + 1000).alias("duration_seconds"))
    c = quality.episode_coverage(eps, iv, iv)
    pct = lambda x: F.round(F.col(x) / F.col("duration_seconds") * 100, 1)
    return c.select("episode_id", "span_count", "beat_count", F.least(pct("span_seconds"), F.lit(100.0)).alias("span_pct"), pct("beat_seconds").alias("beat_pct"))


@query(f"select count(d) as count, {r('min(d)')} as min, {r('max(d)')} as max, {r('avg(d)')} as mean, {r('quantile_cont(d, 0.5)')} as median, {r('quantile_cont(d, 0.05)')} as p5, {r('quantile_cont(d, 0.95)')} as p95, {r('stddev_samp(d)')} as std from (select l_quantity * l_extendedprice / 1000 as d from lineitem) where d >= 0")
def duration_stats(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select((F.col("l_quantity") * F.col("l_extendedprice") / 1000).alias("duration"))
    return quality.duration_statistics(li)


COMPLIANCE = "count(*) as total, count(*) filter (d between 20 and 120) as within, count(*) filter (d < 20) as too_short, count(*) filter (d > 120) as too_long"


@query(f"{with_(UTTERANCES, SPAN_SQL)}, c as (select {COMPLIANCE} from (select duration as d from sp)) select *, {r('within / total * 100')} as within_pct, {r('too_short / total * 100')} as too_short_pct, {r('100 - ' + r('within / total * 100') + ' - ' + r('too_short / total * 100'))} as too_long_pct from c")
def length_compliance(spark, sf_dir):
    return quality.length_compliance(_spans(spark, sf_dir), 20, 120)


@query(f"{with_(UTTERANCES, SPAN_SQL)}, b(bin, low, high) as (values (0, 0.0::double, 20.0::double), (1, 20, 40), (2, 40, 60), (3, 60, 90), (4, 90, 120), (5, 120, 180), (6, 180, null)) select bin, low, high, count(duration) as count from b left join sp on duration >= low and (high is null or duration < high) group by 1, 2, 3")
def duration_histogram(spark, sf_dir):
    return quality.duration_histogram(_spans(spark, sf_dir), "span")


@query("with m as (select min(l_quantity) as lo, max(l_quantity) as hi from lineitem), x as (select least(floor((l_quantity - lo) / ((hi - lo) / 10)), 9)::int as bin from lineitem, m) select b::int as bin, lo + b * ((hi - lo) / 10) as low, lo + (b + 1) * ((hi - lo) / 10) as high, count(bin) as count from m, range(10) t(b) left join x on x.bin = b group by 1, 2, 3".replace("from m, range(10) t(b) left join", "from m cross join range(10) t(b) left join"))
def equal_width_histogram(spark, sf_dir):
    return quality.equal_width_histogram(table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("duration")))


@query(f"with c as (select lang as speaker, count(*) as n, sum(n_chars)::double as t from documents group by 1), k as (select *, row_number() over (order by n desc, speaker) as rank, sum(n) over () as total from c) select case when rank <= 2 then rank::int end as rank, case when rank <= 2 then speaker end as speaker, count(*) as speakers, sum(n)::bigint as count, {r('sum(n) / total * 100')} as percent, {r('sum(t)')} as total_duration, {r('sum(t) / sum(n)')} as avg_duration from k group by 1, 2, total")
def speaker_distribution(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("speaker"), F.col("n_chars").cast("double").alias("duration"))
    return quality.speaker_distribution(d, 2)


@query(f"with s as (select o_custkey, o_totalprice as d, c_mktsegment as series, o_orderpriority as sp from orders left join customer on o_custkey = c_custkey), g as (select series, count(distinct o_custkey) as episodes, count(*) as segments, count(distinct sp) as speakers, sum(d) as t from s group by 1) select series, episodes, segments, speakers, {r('t', 0)} as total_duration, {r('t / segments')} as avg_duration, {r('max(segments) over () / segments')} as largest_ratio from g")
def series_balance(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("episode_id"), F.col("o_totalprice").alias("duration"), F.col("o_orderpriority").alias("speaker"))
    eps = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("episode_id"), F.col("c_mktsegment").alias("series"))
    return quality.series_balance(o, eps).withColumn("total_duration", F.round("total_duration", 0))


@query(f"{with_(INTERVALS)} select count(*) as total_segments, count(*) filter (end_time < start_time) as negative_duration_count, count(*) filter (end_time = start_time) as zero_duration_count, 0::bigint as missing_episode_id_count, 0::bigint as missing_id_count, count(*) filter (coalesce(speaker, '') = '') as missing_speaker_count, count(*) filter (trim(text) = '') as missing_text_count, count(*) filter (start_time is null or end_time is null) as missing_timestamp_count, count(*) filter (start_time < 0 or end_time < 0) as negative_timestamp_count from iv")
def integrity_counts(spark, sf_dir):
    iv = relations.intervals(spark, sf_dir)
    return quality.integrity_counts(iv.withColumn("episode_id", F.col("episode_id").cast("string")).withColumn("segment_id", F.col("segment_id").cast("string")), "segment_id")


@query(r"""with n as (select doc_id, source, lang, text, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) as x from documents) select source as episode_id, lang as dup_speaker, 0::bigint as time_bin, count(*) as count, min(doc_id) as first_id, count(*) - 1 as duplicate_count from n where length(x) >= 10 group by x, source, lang having count(*) > 1""")
def exact_duplicates(spark, sf_dir):
    return quality.exact_duplicates(relations.documents(spark, sf_dir), "segment_id").drop("text_preview").withColumn("time_bin", F.col("time_bin").cast("long"))


@query()
def near_duplicates(spark, sf_dir):
    lines = relations.utterances(spark, sf_dir).withColumnRenamed("start", "start_time")
    return quality.near_duplicates(lines, "utterance_id", 0.95)


TOKENS = r"tk as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '\s+'), lambda t: t <> '') as t, coalesce(text, '') as x from documents)"


@query(f"with {TOKENS}, c as (select len(t) as tokens, len(list_filter(t, lambda w: regexp_matches(w, '\\pL'))) as words, length(x) as characters from tk) select count(*) as total_segments, sum(tokens)::bigint as total_tokens, sum(words)::bigint as total_words, sum(characters)::bigint as total_characters, {r('avg(tokens)')} as avg_tokens, {r('avg(words)')} as avg_words, {r('avg(characters)')} as avg_characters from c")
def text_metrics(spark, sf_dir):
    return quality.text_metrics(relations.documents(spark, sf_dir), "segment_id")


def _clean_sql(cls: str) -> str:
    return rf"cw as (select doc_id, list_filter(list_transform(list_filter(regexp_split_to_array(lower(text), '\s+'), lambda t: t <> ''), lambda w: regexp_replace(w, '^[{cls}]+|[{cls}]+$', '', 'g')), lambda w: regexp_matches(w, '\pL')) as w from documents)"


DENSITY_CLASS, TERM_CLASS = r""".,!?;:()\[\]{}"''\-""", r"!-/:-@\[-`{-~"
STOP = "[" + ", ".join(f"'{w}'" for w in text.STOP_TERMS) + "]"


@query(f"with {_clean_sql(DENSITY_CLASS)}, d as (select len(w) as n, len(list_filter(w, lambda t: list_contains({STOP}, t))) as s from cw), p as (select n, s, case when n > 0 then {r('(n - s) / n', 3)} end as x from d) select sum(n)::bigint as total_words, sum(s)::bigint as stopword_count, {r('(sum(n) - sum(s)) / sum(n)', 3)} as lexical_density, {r('avg(x)', 3)} as avg_lexical_density from p")
def lexical_density(spark, sf_dir):
    return quality.lexical_density(relations.documents(spark, sf_dir), "segment_id")


@query(rf"with p as (select length(regexp_replace(text, '\s', '', 'g')) as n, length(regexp_replace(text, '[^{TERM_CLASS}]', '', 'g')) as k from documents), q as (select n, k, case when n > 0 then {r('k / n', 3)} end as x from p) select sum(n)::bigint as total_characters, sum(k)::bigint as punctuation_count, {r('sum(k) / sum(n)', 3)} as punctuation_ratio, {r('avg(x)', 3)} as avg_punctuation_ratio from q")
def punctuation_ratio(spark, sf_dir):
    return quality.punctuation_ratio(relations.documents(spark, sf_dir), "segment_id")


@query(f"with {_clean_sql(TERM_CLASS)}, x as (select unnest(list_filter(w, lambda t: not list_contains({STOP}, t))) as term from cw) select term, count(*) as count from x group by 1 order by 2 desc, 1 limit 20")
def top_unigrams(spark, sf_dir):
    return quality.top_terms(quality.unigram_counts(relations.documents(spark, sf_dir)))


@query(f"with {_clean_sql(TERM_CLASS)}, y as (select w, unnest(range(1, len(w))) as i from cw), x as (select w[i] as a, w[i + 1] as b from y) select a || ' ' || b as term, count(*) as count from x where not (list_contains({STOP}, a) and list_contains({STOP}, b)) group by 1 order by 2 desc, 1 limit 20")
def top_bigrams(spark, sf_dir):
    return quality.top_terms(quality.bigram_counts(relations.documents(spark, sf_dir)))


@query("with x as (select doc_id, n_chars from documents) select * from (select 'longest' as category, doc_id as id, n_chars::double as metric from x order by 3 desc, 2 limit 20) union all select * from (select 'shortest', doc_id, n_chars::double from x order by 3, 2 limit 20)")
def longest_shortest(spark, sf_dir):
    d = relations.documents(spark, sf_dir).withColumn("duration", F.length("text").cast("double"))
    return neighbours.outliers(d, "segment_id").drop("excerpt")


@query("select 'nation' as kind, n_nationkey::bigint as id, n_name as text, null::bigint as episode_id from nation union all select 'region', r_regionkey, r_name, null from region union all select 'supplier', s_suppkey, s_name, s_nationkey from supplier")
def union_segments(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.lit("nation").alias("kind"), F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("text"))
    g = table(spark, sf_dir, "region").select(F.lit("region").alias("kind"), F.col("r_regionkey").cast("long").alias("id"), F.col("r_name").alias("text"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("text"), F.col("s_nationkey").cast("long").alias("episode_id"))
    return n.unionByName(g).unionByName(s, allowMissingColumns=True)


# Table checks


@query(f"{with_(UTTERANCES)}, p as (select count(*) as n, count(distinct utterance_id) as d, min(length(text)) as lo from u) select 'non_empty' as check, true as passed, 'error' as severity from p union all select unnest(['required_fields', 'schema_compliance', 'timestamp_nulls_start', 'timestamp_negative_start', 'timestamp_nulls_end', 'timestamp_negative_end', 'text_nulls', 'text_empty', 'text_length', 'id_nulls_utterance_id', 'id_duplicates_utterance_id', 'id_nulls_episode_id', 'id_references_episode_id', 'numeric_nan_start', 'numeric_inf_start', 'numeric_nan_end', 'numeric_inf_end', 'numeric_nan_duration', 'numeric_inf_duration']), (select n = d from p), unnest(['error', 'error', 'error', 'error', 'error', 'error', 'error', 'warning', 'info', 'error', 'error', 'error', 'info', 'warning', 'error', 'warning', 'error', 'warning', 'error'])")
def schema_profile_checks(spark, sf_dir):
    return checks.validate(relations.utterances(spark, sf_dir), "utterance").select("check", "passed", "severity")


@query(f"{with_(UTTERANCES)} select 20::bigint as checks, 20::bigint as passed, 0::bigint as failed, 0::bigint as errors, 0::bigint as warnings, true as is_valid from (select count(*) as n from u) where n > 0")
def validation_counters(spark, sf_dir):
    return checks.report_counts(checks.validate(relations.utterances(spark, sf_dir), "utterance"))


@query("select o_custkey as customer_id from orders where o_custkey not in (select c_custkey from customer where c_custkey % 5 <> 0) group by 1")
def dangling_references(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.array("o_custkey").alias("ids"))
    c = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("customer_id"))
    return checks.dangling(o, "ids", c, "customer_id")


# Vectors

COS = "list_dot_product(a.v, b.v) / ((sqrt(list_dot_product(a.v, a.v)) + 1e-8) * (sqrt(list_dot_product(b.v, b.v)) + 1e-8))"
KNN = f"""{VECTORS}, nb as (select a.artifact_id as query_id, b.artifact_id as neighbor_id, {r(COS, 6)} as score from e a join e b on a.artifact_id <> b.artifact_id where a.artifact_id % 20 = 0),
kn as (select *, row_number() over (partition by query_id order by score desc, neighbor_id)::int as rank from nb qualify rank <= 10)"""
ON = "x as (select kn.*, a.speaker as qs, b.speaker as ns, a.episode_id as qe, b.episode_id as ne, a.start_time as q0, a.end_time as q1, b.start_time as n0, b.end_time as n1 from kn join e a on a.artifact_id = query_id join e b on b.artifact_id = neighbor_id)"


def _neighbours(spark, sf_dir):
    v = relations.vectors(spark, sf_dir)
    return vectors.top_k(v.where("artifact_id % 20 = 0"), v, 10), v


def _leakage_sql(same: str) -> str:
    return f"with {KNN}, {ON}, p as (select query_id, count(*) filter ({same}) / 10 * 100 as p from x group by 1) select count(*) as queries, {r('avg(p)')} as mean_pct, {r('quantile_cont(p, 0.5)')} as median_pct, {r('max(p)')} as max_pct from p"


@query(f"with {KNN} select query_id, neighbor_id, score, rank from kn")
def cosine_topk(spark, sf_dir):
    return _neighbours(spark, sf_dir)[0]


@query(f"with {VECTORS}, nb as (select a.artifact_id as query_id, b.artifact_id as neighbor_id, {r('list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2 * list_dot_product(a.v, b.v)', 6)} as score from e a join e b on a.artifact_id <> b.artifact_id where a.artifact_id % 20 = 0) select query_id, neighbor_id, score, row_number() over (partition by query_id order by score, neighbor_id)::int as rank from nb qualify rank <= 3")
def l2_search(spark, sf_dir):
    v = relations.vectors(spark, sf_dir)
    return vectors.top_k(v.where("artifact_id % 20 = 0"), v, 3, metric="l2")


@query(_leakage_sql("qs = ns"))
def label_leakage(spark, sf_dir):
    n, v = _neighbours(spark, sf_dir)
    return neighbours.group_leakage(n, v, "artifact_id", "speaker", 10)


@query(_leakage_sql("qe = ne"))
def episode_leakage(spark, sf_dir):
    n, v = _neighbours(spark, sf_dir)
    return neighbours.group_leakage(n, v, "artifact_id", "episode_id", 10)


@query(_leakage_sql("qs <> ns"))
def cross_label_neighbors(spark, sf_dir):
    n, v = _neighbours(spark, sf_dir)
    return neighbours.group_leakage(n, v, "artifact_id", "speaker", 10, different=True)


@query(_leakage_sql("qe = ne and (abs(n0 - q1) <= 60 or abs(q0 - n1) <= 60)"))
def adjacency_bias(spark, sf_dir):
    n, v = _neighbours(spark, sf_dir)
    return neighbours.adjacency_bias(n, v, "artifact_id", 10, 60.0)


@query(f"with {KNN}, s as (select query_id, avg(score) as s from kn group by 1) select (select case when min(n) < max(n) then {r('corr(duration, n)', 4)} end from (select duration, {r('sqrt(list_dot_product(v, v))', 6)} as n from e)) as norm_corr, {r('corr(duration, s)', 4)} as similarity_corr from s join e on artifact_id = query_id")
def length_bias_corr(spark, sf_dir):
    n, v = _neighbours(spark, sf_dir)
    return neighbours.length_bias(n, v, "artifact_id")


@query(f"with {KNN}, s as (select query_id as id, {r('avg(score)', 6)} as metric from kn group by 1) select * from (select 'isolated' as category, id, metric from s order by metric, id limit 5) union all select * from (select 'hubby', id, metric from s order by metric desc, id limit 5)")
def neighbor_outliers(spark, sf_dir):
    return neighbours.isolation(_neighbours(spark, sf_dir)[0], 5)


@query(f"with {VECTORS} select artifact_id, {r('sqrt(list_dot_product(v, v))', 6)} as norm, {r('list_avg(v)', 6)} as mean from e")
def embedding_norms(spark, sf_dir):
    s = vectors.vector_summary(relations.vectors(spark, sf_dir))
    return s.select("artifact_id", F.round("norm", 6).alias("norm"), F.round("mean", 6).alias("mean"))


@query("select 'vec' as artifact_type, count(*) as count, 64 as dimension, 'm' as model_name from embeddings")
def embedding_statistics(spark, sf_dir):
    v = relations.vectors(spark, sf_dir).select(F.lit("vec").alias("artifact_type"), "embedding", F.lit("m").alias("model_name"))
    return vectors.statistics(v)


@query("select vec_id as artifact_id from embeddings where vec_id % 4 = 0")
def index_append(spark, sf_dir):
    v = relations.vectors(spark, sf_dir)
    index = vectors.build_index(v.where("artifact_id % 4 <> 0"))
    return vectors.append_index(index, v.unionByName(v)).select("artifact_id")


#: A text's distinct words of two characters or more once stripped, stop words aside.
STRIPPED = r"""regexp_replace(w, '^[.,!?;:"()\[\]{{}}]+|[.,!?;:"()\[\]{{}}]+$', '', 'g')"""
LIKENESS_STOP = "[" + ", ".join(f"'{w}'" for w in text.STOP_LIKENESS) + "]"
WORDSET = rf"list_distinct(list_transform(list_filter(regexp_split_to_array(lower({{0}}), '\s+'), lambda w: length({STRIPPED}) >= 2 and not list_contains({LIKENESS_STOP}, w) and regexp_matches(w, '\pL')), lambda w: {STRIPPED}))"
PAIRS = f"pr as (select a.doc_id as id_a, b.doc_id as id_b, {WORDSET.format('a.text')} as x, {WORDSET.format('b.text')} as y from documents a join documents b on b.doc_id = a.doc_id + 20)"


@query(f"with {PAIRS} select id_a, id_b, {r('len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))', 9)} as jaccard, {r('2 * len(list_intersect(x, y)) / (len(x) + len(y))', 9)} as dice from pr where len(x) > 0 and len(y) > 0 union all select id_a, id_b, 0, 0 from pr where len(x) = 0 or len(y) = 0")
def lexical_similarity(spark, sf_dir):
    d = save(relations.documents(spark, sf_dir).select("segment_id", text.word_set(F.col("text")).alias("w")), "words")  # both sides read them
    a = d.select(F.col("segment_id").alias("id_a"), F.col("w").alias("x"), (F.col("segment_id") + 20).alias("id_b"))
    on = a.join(d.select(F.col("segment_id").alias("id_b"), F.col("w").alias("y")), "id_b")
    x, y = F.col("x"), F.col("y")
    return on.select("id_a", "id_b", F.round(text.set_likeness(x, y), 9).alias("jaccard"), F.round(text.set_likeness(x, y, "overlap"), 9).alias("dice"))


@query(f"with {VECTORS}, p as (select a.duration as x, {r(COS, 9)} as y from e a join e b on b.artifact_id = a.artifact_id + 1), k as (select x, y, rank() over (order by x) + (count(*) over (partition by x) - 1) / 2.0 as rx, rank() over (order by y) + (count(*) over (partition by y) - 1) / 2.0 as ry from p) select count(*) as pairs, {r('corr(x, y)', 4)} as pearson, {r('corr(rx, ry)', 4)} as spearman from k")
def spearman_corr(spark, sf_dir):
    v = relations.vectors(spark, sf_dir)
    nxt = v.select((F.col("artifact_id") - 1).alias("artifact_id"), F.col("embedding").alias("w"))
    p = v.join(nxt, "artifact_id").select(F.col("duration").alias("x"), F.round(vec.cosine(F.col("embedding"), F.col("w")), 9).alias("y"))
    k = p.withColumn("rx", neighbours.average_rank("x")).withColumn("ry", neighbours.average_rank("y"))
    return k.agg(F.count(F.lit(1)).alias("pairs"), F.round(F.corr("x", "y"), 4).alias("pearson"), F.round(F.corr("rx", "ry"), 4).alias("spearman"))


@query()
def lexical_correlation(spark, sf_dir):
    d = relations.documents(spark, sf_dir).where(F.length("text") > 0)
    v = vectors.generate(d.withColumnRenamed("segment_id", "doc_id"), "doc", vectors.HashingProvider(64)).select(F.col("artifact_id").alias("segment_id"), "embedding")
    pairs = neighbours.random_pairs(d, 500, "segment_id")
    return neighbours.lexical_correlation(pairs, d.join(v, "segment_id"), "segment_id")


@query("""with d as (select doc_id, source || '_' || lang as s from documents), c as (select s, count(*) as n from d group by 1), w as (select s, n, sum(n) over () as total, least(greatest(1, floor(100 * n / sum(n) over ())), n)::bigint as want from c),
a as (select *, want - greatest(0, least(sum(want) over () - 100 - coalesce(sum(want - 1) over (order by want desc, s rows between unbounded preceding and 1 preceding), 0), want - 1)) as take from w)
select doc_id as segment_id from (select doc_id, d.s, row_number() over (partition by d.s order by md5(doc_id::varchar || ':42'), doc_id) as k from d) x join a on a.s = x.s where k <= case when total <= 100 then n else take end""")
def stratified_sample(spark, sf_dir):
    return neighbours.stratified_sample(relations.documents(spark, sf_dir), 100, ["episode_id", "speaker"], "segment_id").select("segment_id")


@query(f"with {KNN}, tx as (select query_id, d.text from kn join documents d on d.doc_id = neighbor_id join documents q on q.doc_id = query_id), t as (select query_id, unnest(list_transform(list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda w: length(regexp_replace(w, '^[.,!?;:\"()\\[\\]{{}}]+|[.,!?;:\"()\\[\\]{{}}]+$', '', 'g')) >= 3 and not list_contains([{', '.join(repr(w) for w in text.STOP_THEMES)}], w) and regexp_matches(w, '\\pL')), lambda w: regexp_replace(w, '^[.,!?;:\"()\\[\\]{{}}]+|[.,!?;:\"()\\[\\]{{}}]+$', '', 'g'))) as term from tx), c as (select query_id, term, count(*) as n from t group by 1, 2), k as (select *, row_number() over (partition by query_id order by n desc, term) as k, sum(n) over (partition by query_id) as total, count(*) over (partition by query_id) as uniq from c) select query_id, string_agg(term, ' ' order by k) as terms, max(total)::bigint as total_words, max(uniq)::bigint as unique_words, {r('sum(n) / max(total)', 3)} as coherence from k where k <= 5 group by 1")
def neighbor_themes(spark, sf_dir):
    n, _ = _neighbours(spark, sf_dir)
    d = relations.documents(spark, sf_dir)
    t = neighbours.themes(n, d, "segment_id")
    return t.select("query_id", F.array_join("top_terms.term", " ").alias("terms"), "total_words", "unique_words", "coherence")


@query("with k as (select unnest(['the', 'und', 'les']) as keyword) select keyword, (select count(*) from documents where contains(lower(text), keyword)) as count from k")
def keyword_counts(spark, sf_dir):
    return vectors.keyword_counts(relations.documents(spark, sf_dir), ["the", "und", "les"])


@query()
def vector_clusters(spark, sf_dir):
    return vectors.clusters(relations.vectors(spark, sf_dir), 10).groupBy("cluster").agg(F.count(F.lit(1)).alias("vectors"), F.avg("duration").alias("avg_duration"))


# Rules, ids


@query(f"""{with_(UTTERANCES, SPAN_SQL)}, m as (select count(*) filter (duration between 20 and 120) / count(*) * 100 as ok from sp), i as (select count(*) filter (duration = 0) as z from sp)
select 'span_length_compliance_min' as rule, {r('ok')} as actual, 'error' as severity from m where ok < 90""")
def length_violations(spark, sf_dir):
    m = quality.length_compliance(_spans(spark, sf_dir), 20, 120)
    return rules.violations(m, rules.length_rules("span", rules.Thresholds())).select("rule", "actual", "severity")


@query(f"""{with_(UTTERANCES, SPAN_SQL)}, m as (select count(*) filter (duration between 20 and 120) / count(*) * 100 as ok from sp) select case when ok < 90 then 'RED' else 'GREEN' end as status, (ok < 90)::bigint as errors, 0::bigint as warnings from m""")
def thresholds_rag(spark, sf_dir):
    m = quality.length_compliance(_spans(spark, sf_dir), 20, 120)
    return rules.status(rules.violations(m, rules.length_rules("span", rules.Thresholds())))


@query("select doc_id, sha256(text) as sha256, md5(text) as md5 from documents")
def content_ids(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", identity.content_hash(F.col("text")).alias("sha256"), identity.content_hash(F.col("text"), "md5").alias("md5"))


@query(f"{with_(UTTERANCES, SPAN_SQL)} select count(*) filter (regexp_matches(span_id, '^spn_[^_]{{12}}_[0-9]{{6}}_[^_]{{8}}$')) as valid, 0::bigint as as_beat from sp")
def id_format(spark, sf_dir):
    return _spans(spark, sf_dir).agg(F.count_if(identity.valid_id(F.col("span_id"), "span")).alias("valid"), F.count_if(identity.valid_id(F.col("span_id"), "beat")).alias("as_beat"))
