"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue: its documents in a hashed order, and again for each further epoch. A document's virtual finish time
is the queue's cumulative size divided by the source's target. All queues are range-sorted by finish time and truncated at
the budget. Within a queue time only grows, so what is taken of a source is a prefix: one short row per source (epoch, key,
id) tells each document how often it is taken, and texts need not be moved.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, prepare, save

#: How often a source may be used; weights of the sources in order of code points.
EPOCHS, WEIGHTS = 3, (1, 2, 3)
#: Slices of a queue, by the first hex digits of the key, and of virtual time: fixed numbers, summed before they are ordered.
SLICES, TIMES = 3, 1 << 16


def size_of(text):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(doc_id):
    """The shuffle: a document's place in its queue depends on its id alone, so reruns agree."""
    return F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def targets(sizes: DataFrame) -> DataFrame:
    """sizes: source, source_size. Adds weight and target: weighted shares of all sizes, at most EPOCHS times a source's size.

    Sources are one short row each. Sorted by size over weight the capped ones come first, so running sums find the cap."""
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(everything) - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sizes.withColumn("weight", weight.cast("double")).withColumn("most", F.col("source_size").cast("double") * EPOCHS)
    all_ = Window.partitionBy()
    before = Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("total", F.sum(F.col("source_size").cast("double")).over(all_)).withColumn("weights", F.sum("weight").over(all_))
    level = (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", level).withColumn("capped", F.col("most") / F.col("weight") < F.col("level"))
    s = s.withColumn("cap_sum", F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(all_))
    s = s.withColumn("free_weight", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(all_))
    share = (F.col("total") - F.col("cap_sum")) / F.col("free_weight") * F.col("weight")
    return s.select("source", "source_size", "weight", F.when(F.col("capped"), F.col("most")).otherwise(F.coalesce(share, F.lit(0.0))).alias("target"))


def schedule(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sized documents (doc_id, source, size, key), and a row for each source: source_size, target, and the last one taken."""
    sized = save(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), order_key("doc_id").alias("key")), "sized")
    slices = sized.groupBy("source", F.substring("key", 1, SLICES).alias("slice")).agg(F.sum("size").alias("slice_size"))
    slices = save(slices.withColumn("offset", F.sum("slice_size").over(Window.partitionBy("source").orderBy("slice")) - F.col("slice_size")), "slices")
    plan = save(targets(slices.groupBy("source").agg(F.sum("slice_size").alias("source_size"))), "targets")
    per_slice = slices.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("q"), F.col("slice").alias("q_slice"), "offset", "source_size", "target")
    queue = sized.withColumn("slice", F.substring("key", 1, SLICES)).join(per_slice, F.col("source").eqNullSafe(F.col("q")) & (F.col("slice") == F.col("q_slice")))
    order = Window.partitionBy("source", "slice").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = queue.withColumn("upto", F.col("offset") + F.sum("size").over(order))
    epochs = queue.where("target > 0").withColumn("epoch", F.explode(F.expr(f"sequence(0, least({EPOCHS - 1}, cast(ceil(target / source_size) as int)))")))
    finish = (F.col("upto") + F.col("epoch") * F.col("source_size")) / F.col("target")
    timed = save(epochs.select("source", "epoch", "key", "doc_id", "size", finish.alias("finish")), "timed")
    at = F.floor(F.least(F.col("finish"), F.lit(2.0)) * TIMES)
    budget = plan.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    per_time = timed.groupBy(at.alias("at")).agg(F.sum("size").alias("words"))
    running = per_time.withColumn("upto", F.sum("words").over(Window.orderBy("at")))  # at most 2 * TIMES + 1 rows
    cut, room = running.where(F.col("upto") > budget).agg(F.min("at"), F.min_by(F.lit(budget) - F.col("upto") + F.col("words"), "at")).first()
    if cut is None:
        taken = timed
    else:
        last = Window.orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, 0)
        edge = timed.where(at == cut).withColumn("sum", F.sum("size").over(last)).where(F.col("sum") <= room)
        taken = timed.where(at < cut).unionByName(edge.select(*timed.columns))
    ends = taken.groupBy("source").agg(F.max(F.struct("epoch", "key", F.col("doc_id").isNull().alias("no_id"), "doc_id")).alias("end"))
    plan = plan.join(ends.withColumnRenamed("source", "e"), F.col("source").eqNullSafe(F.col("e")), "left").select("source", "source_size", "weight", "target", "end")
    return sized, save(plan, "plan")


def copies(key, doc_id):
    """How often a document is taken, given its source's end."""
    here = F.struct(key.alias("key"), doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"))
    end = F.struct(F.col("end.key").alias("key"), F.col("end.no_id").alias("no_id"), F.col("end.doc_id").alias("doc_id"))
    return F.when(F.col("end").isNull(), F.lit(0)).otherwise(F.col("end.epoch") + (here <= end).cast("int"))


def mix_sources(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, size, source_size, target, taken.

    Null texts and texts of white space have size 0. Null is a source of its own, after all others. No document is taken more
    than EPOCHS times; a source whose documents are all empty has target 0. The words taken are at most all words, and of a
    source they come within one document of its target, as queues are served in whole documents. Equal ids come next to
    each other in their queue and are taken alike at its end. No rows give no rows."""
    prepare(docs.sparkSession)
    sized, plan = schedule(docs)
    on = sized.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    return on.select("doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("key"), F.col("doc_id"))).cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """docs, each row as often as the mix takes it."""
    prepare(docs.sparkSession)
    _, plan = schedule(docs)
    plan = plan.select(F.col("source").alias("_s"), "end")
    on = docs.join(plan, F.col("source").eqNullSafe(F.col("_s"))).withColumn("_n", copies(order_key("doc_id"), F.col("doc_id")))
    return on.where("_n > 0").withColumn("_e", F.explode(F.expr("sequence(1, _n)"))).select(*docs.columns)


ORACLE = r"""
with d as (select doc_id, source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::bigint as size, md5(cast(doc_id as varchar)) as key from documents),
s as (select source, sum(size)::bigint as source_size, (row_number() over (order by source nulls last) - 1) % 3 + 1.0::double as w from d group by source),
c as (select *, 3.0::double * source_size as most, sum(source_size) over ()::double as total, sum(w) over () as ws from s),
l as (select *, (total - coalesce(sum(most) over o, 0)) / (ws - coalesce(sum(w) over o, 0)) as level from c window o as (order by most / w, source nulls last rows between unbounded preceding and 1 preceding)),
f as (select sum(most) filter (most / w < level) as cap, sum(w) filter (not most / w < level) as free from l),
t as (select source, source_size, case when most / w < level then most else (total - coalesce(cap, 0)) / free * w end as target from l, f),
q as (select d.*, source_size, target, sum(size) over (partition by d.source order by key, doc_id rows unbounded preceding)::bigint as upto from d join t on d.source is not distinct from t.source),
e as (select *, (upto + epoch * source_size) / target::double as finish from q, range(3) r(epoch) where target > 0 and epoch <= ceil(target / source_size)),
m as (select doc_id, size, sum(size) over (order by finish, source nulls last, epoch, key, doc_id rows unbounded preceding) as used from e),
k as (select doc_id, sum(size)::bigint as taken from m where used <= (select sum(size) from d) group by doc_id)
select q.doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken from q left join k on q.doc_id = k.doc_id
"""
