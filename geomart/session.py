"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "geomart") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submit command sets these."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder named by ``spark.checkpoint.dir``.

    Only in local mode, where all tasks share one machine, is a temporary folder made and set as the
    checkpoint folder if the session names none; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="geomart-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage in a way that survives lost executors, and gives the planner the
    real size of the data for its broadcast decisions.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_all(steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Materialize independent frames side by side; each is made and written in a thread of its own."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        written = {name: pool.submit(lambda n=name, f=make: materialize(f(), n)) for name, make in steps.items()}
        return {name: w.result() for name, w in written.items()}
