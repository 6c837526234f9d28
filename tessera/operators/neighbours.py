"""Metrics over nearest neighbours: sampling, leakage, coherence, adjacency, length bias, lexical correlation, outliers.

One sample and one neighbour table serve all of them. Samples are ordered by a hash of the id and a seed, so reruns agree."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.vectors import cosine, norm
from . import intervals
from .quality import duration_of


def hash_order(id_col: str, seed: int = 42) -> Column:
    return F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))))


def stratified_sample(segments: DataFrame, n: int, by: list[str], id_col: str, seed: int = 42) -> DataFrame:
    """About n rows, in proportion to the strata's sizes: at least one of each, at most its size.

    What exceeds n is taken from the largest allocations, none of which falls below one. All rows if n is no less."""
    by = [c for c in by if c in segments.columns]
    stratum = F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in by]) if by else F.lit("")
    rows = segments.withColumn("_s", stratum)
    sizes = rows.groupBy("_s").agg(F.count(F.lit(1)).alias("_n"))
    all_ = Window.partitionBy()
    sizes = sizes.withColumn("_all", F.sum("_n").over(all_)).withColumn("_want", F.least(F.greatest(F.lit(1), F.floor(F.lit(n) * F.col("_n") / F.col("_all"))), F.col("_n")))
    before = Window.orderBy(F.desc("_want"), "_s").rowsBetween(Window.unboundedPreceding, -1)
    spare = F.sum("_want").over(all_) - n - F.coalesce(F.sum(F.col("_want") - 1).over(before), F.lit(0))
    give = F.greatest(F.lit(0), F.least(spare, F.col("_want") - 1))
    sizes = sizes.withColumn("_take", F.when(F.col("_all") <= n, F.col("_n")).otherwise(F.col("_want") - give)).select(F.col("_s").alias("_t"), "_take")
    order = Window.partitionBy("_s").orderBy(hash_order(id_col, seed), id_col)
    return rows.withColumn("_k", F.row_number().over(order)).join(sizes, F.col("_s") == F.col("_t")).where(F.col("_k") <= F.col("_take")).drop("_s", "_t", "_k", "_take")


def random_pairs(segments: DataFrame, n: int, id_col: str, seed: int = 42) -> DataFrame:
    """n distinct unordered pairs of different rows, or all if there are fewer: id_a, id_b.

    The first rows in hash order (as many as n pairs need) are paired with the row 1, 2, ... places after them."""
    rows = segments.select(id_col).distinct()
    total = rows.count()
    n = min(n, total * (total - 1) // 2)
    top = min(total, n + 1)
    far = 1
    while sum(top - d for d in range(1, far + 1)) < n:
        far += 1
    w = Window.orderBy(hash_order(id_col, seed), id_col)
    ahead = F.array(*[F.struct(F.lit(d).alias("d"), F.lead(id_col, d).over(w).alias("b")) for d in range(1, far + 1)])
    first = rows.orderBy(hash_order(id_col, seed), id_col).limit(top).select(F.col(id_col).alias("a"), ahead.alias("ahead"))
    pairs = first.select("a", F.explode("ahead").alias("f")).where("f.b is not null")
    return pairs.orderBy("f.d", hash_order("a", seed)).limit(n).select(F.least("a", "f.b").alias("id_a"), F.greatest("a", "f.b").alias("id_b"))


def _facts(segments: DataFrame, id_col: str, columns: list[str], prefix: str) -> DataFrame:
    return segments.select(F.col(id_col).alias(f"{prefix}_id"), *[F.col(c).alias(f"{prefix}_{c}") for c in columns])


def with_facts(neighbours: DataFrame, segments: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """neighbours with columns of the query (query_*) and of the neighbour (neighbor_*)."""
    return neighbours.join(_facts(segments, id_col, columns, "query"), "query_id").join(_facts(segments, id_col, columns, "neighbor"), "neighbor_id")


def leakage(neighbours: DataFrame, same: Column, k: int) -> DataFrame:
    """Percent of each query's k neighbours for which `same` holds: queries, mean, median, max. The denominator is k."""
    per = neighbours.groupBy("query_id").agg((F.count_if(same) / F.lit(k) * 100).alias("p"))
    return per.agg(F.count(F.lit(1)).alias("queries"), F.round(F.avg("p"), 2).alias("mean_pct"), F.round(F.percentile("p", F.lit(0.5)), 2).alias("median_pct"), F.round(F.max("p"), 2).alias("max_pct"))


def group_leakage(neighbours: DataFrame, segments: DataFrame, id_col: str, column: str, k: int, different: bool = False) -> DataFrame:
    """Leakage within a column: speaker, episode; different: neighbours of another value (series)."""
    on = with_facts(neighbours, segments, id_col, [column])
    same = F.coalesce(F.col(f"query_{column}") == F.col(f"neighbor_{column}"), F.lit(False))
    return leakage(on, ~same if different else same, k)


def adjacency_bias(neighbours: DataFrame, segments: DataFrame, id_col: str, k: int, tolerance: float = 5.0) -> DataFrame:
    on = with_facts(neighbours, segments, id_col, ["episode_id", "start_time", "end_time"])
    q, n = (tuple(F.col(f"{p}_{c}") for c in ("episode_id", "start_time", "end_time")) for p in ("query", "neighbor"))
    return leakage(on, intervals.adjacent(*q, *n, tolerance), k)


def themes(neighbours: DataFrame, segments: DataFrame, id_col: str, terms: int = 5, least: int = 3) -> DataFrame:
    """Each query's most frequent terms in its neighbours' texts, and the share of all words that they make (coherence)."""
    words = with_facts(neighbours, segments, id_col, ["text"]).select("query_id", F.explode(text.theme_words(F.col("neighbor_text"), text.STOP_THEMES, least)).alias("term"))
    counts = words.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("query_id")
    ranked = counts.withColumn("all", F.sum("n").over(w)).withColumn("unique", F.count(F.lit(1)).over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("n"), "term"))).where(F.col("k") <= terms)
    return ranked.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "term", "n"))), lambda r: F.struct(r["term"].alias("term"), r["n"].alias("count"))).alias("top_terms"), F.first("all").alias("total_words"),
        F.first("unique").alias("unique_words"), F.round(F.sum("n") / F.first("all"), 3).alias("coherence"),
    )


def coherence(neighbours: DataFrame, per_query: DataFrame, high: float = 0.2) -> DataFrame:
    """Mean likeness and coherence over queries (0 for one without words), and coherent / mixed / random by the share of coherent ones."""
    sims = neighbours.groupBy("query_id").agg(F.avg("score").alias("s"), F.count(F.lit(1)).alias("n"))
    on = sims.join(per_query.select("query_id", "coherence"), "query_id", "left").na.fill(0.0, ["coherence"])
    share = F.count_if(F.col("coherence") > high) / F.count(F.lit(1))
    return on.agg(
        F.count(F.lit(1)).alias("sample_count"), F.round(F.sum(F.col("s") * F.col("n")) / F.sum("n"), 3).alias("mean_similarity"), F.round(F.avg("coherence"), 3).alias("mean_coherence"),
        F.count_if(F.col("coherence") > high).alias("coherent_count"), F.round(share, 3).alias("coherent_ratio"), F.when(share >= 0.7, "coherent").when(share >= 0.3, "mixed").otherwise("random").alias("assessment"),
    )


def top_theme_terms(per_query: DataFrame, n: int = 10) -> DataFrame:
    return per_query.select(F.explode("top_terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "term").limit(n)


def correlation(x: str, y: str) -> Column:
    """Pearson's, null where a side doesn't vary."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def length_bias(neighbours: DataFrame, segments: DataFrame, id_col: str, vec_col: str = "embedding") -> DataFrame:
    """Correlations of duration with the vector's norm (to 6 places), over all segments, and with the mean likeness to the neighbours, over queries."""
    d = segments.select(F.col(id_col).alias("query_id"), duration_of(segments).alias("d"), F.round(norm(F.col(vec_col)), 6).alias("norm"))
    one = d.agg(correlation("d", "norm").alias("norm_corr"), F.lit(1).alias("j"))
    near = neighbours.groupBy("query_id").agg(F.avg("score").alias("s")).join(d, "query_id").agg(correlation("d", "s").alias("similarity_corr"), F.lit(1).alias("j"))
    return one.join(near, "j").select(F.round("norm_corr", 4).alias("norm_corr"), F.round("similarity_corr", 4).alias("similarity_corr"))


def average_rank(c: str) -> Column:
    """Ranks with ties at their mean."""
    return F.rank().over(Window.orderBy(c)) + (F.count(F.lit(1)).over(Window.partitionBy(c)) - 1) / 2.0


def lexical_correlation(pairs: DataFrame, segments: DataFrame, id_col: str, vec_col: str = "embedding", method: str = "jaccard") -> DataFrame:
    """Pearson and Spearman correlation of word likeness and cosine over pairs (a bounded sample)."""
    side = lambda p: segments.select(F.col(id_col).alias(f"id_{p}"), F.col("text").alias(f"text_{p}"), F.col(vec_col).alias(f"v_{p}"))
    on = pairs.join(side("a"), "id_a").join(side("b"), "id_b").select(text.likeness(F.col("text_a"), F.col("text_b"), method).alias("lex"), F.round(cosine(F.col("v_a"), F.col("v_b")), 9).alias("cos"))
    ranked = on.withColumn("rl", average_rank("lex")).withColumn("rc", average_rank("cos"))
    return ranked.agg(F.count(F.lit(1)).alias("pairs"), F.round(correlation("lex", "cos"), 4).alias("pearson"), F.round(correlation("rl", "rc"), 4).alias("spearman"))


def outliers(segments: DataFrame, id_col: str, n: int = 20) -> DataFrame:
    """The n longest and n shortest segments: category, id, metric, excerpt. Ties go by id."""
    d = segments.select(F.col(id_col).alias("id"), duration_of(segments).alias("metric"), text.excerpt(F.col("text")).alias("excerpt"))
    return d.orderBy(F.desc("metric"), "id").limit(n).select(F.lit("longest").alias("category"), "*").unionByName(d.orderBy("metric", "id").limit(n).select(F.lit("shortest").alias("category"), "*"))


def isolation(neighbours: DataFrame, n: int = 20) -> DataFrame:
    """Queries with the lowest and the highest mean likeness to their neighbours: category, id, metric."""
    s = neighbours.groupBy(F.col("query_id").alias("id")).agg(F.round(F.avg("score"), 6).alias("metric"))
    return s.orderBy("metric", "id").limit(n).select(F.lit("isolated").alias("category"), "*").unionByName(s.orderBy(F.desc("metric"), "id").limit(n).select(F.lit("hubby").alias("category"), "*"))


def neighbour_lists(neighbours: DataFrame, segments: DataFrame, id_col: str, n: int = 30, seed: int = 42) -> DataFrame:
    """n queries with their neighbours in order, and whether each is of the same speaker and episode."""
    on = with_facts(neighbours, segments, id_col, ["speaker", "episode_id", "text"])
    row = F.struct("rank", "neighbor_id", "score", (F.col("query_speaker") == F.col("neighbor_speaker")).alias("same_speaker"), (F.col("query_episode_id") == F.col("neighbor_episode_id")).alias("same_episode"), text.excerpt(F.col("neighbor_text")).alias("excerpt"))
    lists = on.groupBy("query_id").agg(F.first(text.excerpt(F.col("query_text"))).alias("query_excerpt"), F.array_sort(F.collect_list(row)).alias("neighbors"))
    return lists.orderBy(hash_order("query_id", seed)).limit(n)
