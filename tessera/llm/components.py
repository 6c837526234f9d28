"""Connected components of an edge table, by alternating large-star and small-star rounds (Kiveris et al., 2014)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save


def stars(edges: DataFrame) -> bool:
    """Whether each u stands once and no v is a u: then every component is the star of its smallest node."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("ups"), F.lit(0).alias("downs")).unionByName(edges.select(F.col("v").alias("n"), F.lit(0).alias("ups"), F.lit(1).alias("downs")))
    open_ = ends.groupBy("n").agg(F.sum("ups").alias("ups"), F.max("downs").alias("downs")).where("ups > 1 or (ups > 0 and downs > 0)")
    return open_.agg(F.count(F.lit(1))).first()[0] == 0


def components(edges: DataFrame) -> DataFrame:
    """edges: u, v (long). A row for each node that is not the smallest of its component: node, root (the smallest node).

    Each round is written to the shared folder; they end as soon as all components are stars. Loops and repeated edges do no
    harm; no edges give no rows."""
    e = save(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    while not stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low.select(F.col("u").alias("k"), "m"), F.col("u") == F.col("k")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
