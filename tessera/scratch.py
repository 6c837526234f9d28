"""Tables in the shared folder that cut lineage: a lost executor loses nothing of them."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP = 16 << 20


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir, or that of setCheckpointDir.

    Where neither is set, a local run gets a temporary folder; a cluster is refused, as its executors would not share one."""
    sc = spark.sparkContext
    if named := spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir():
        return named
    if (at := getattr(sc, "_tessera_scratch", None)) is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = sc._tessera_scratch = tempfile.mkdtemp(prefix="tessera-scratch-")
        atexit.register(shutil.rmtree, at, True)
    return at


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage is cut, and a lost executor loses nothing.

    A writer holds a row group in memory, so these are small."""
    path = f"{scratch_root(df.sparkSession)}/tessera-{uuid.uuid4().hex}/{name}"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
