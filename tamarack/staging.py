"""Written intermediate tables.

Iterative jobs cut their lineage by writing a table to the shared checkpoint folder and reading
it back.  A written table survives the loss of any executor, is columnar, and gives the
optimizer true sizes, so it never broadcasts something that has grown.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# A side may carry a broadcast hint only when its row count is bounded by this number.
BROADCAST_ROW_LIMIT = 1_000_000

# Tables of this process that have not been dropped yet, by path.
_kept: dict[str, Stage] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where that is unset, one in the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"


def release(spark: SparkSession) -> None:
    """Drop every working table that is still kept.  Call it once the results built on them are consumed."""
    for stage in list(_kept.values()):
        if stage._spark is spark:
            stage.drop()


def _release_at_exit() -> None:
    for stage in list(_kept.values()):
        try:
            stage.drop()
        except Exception:  # the session may have ended already; its folder then goes with its owner
            return


atexit.register(_release_at_exit)


class Stage:
    """A DataFrame that has been written out, and can be dropped once it is superseded.

    ``sums`` are aggregates over its rows, taken while they are written; see ``self.sums``.
    """

    def __init__(self, df: DataFrame, name: str, sums: dict[str, Column] | None = None):
        spark = df.sparkSession
        self._spark = spark
        self.path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
        observed = Observation(f"{name}-{uuid.uuid4().hex}") if sums else None
        out = df.observe(observed, *[c.alias(n) for n, c in sums.items()]) if sums else df
        out.write.parquet(self.path)
        self.sums = observed.get if observed else {}
        self.df = spark.read.schema(df.schema).parquet(self.path)
        _kept[self.path] = self

    def drop(self) -> None:
        _kept.pop(self.path, None)
        sc = self._spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the checkpoint folder and return the table that was written."""
    return Stage(df, name).df


def parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread the rows of a scan over the cluster if it has too few splits to occupy it.

    Large inputs already have many splits and pass through without a shuffle.  Meant for scans only:
    asking a plan with shuffles for its partitions would run them.
    """
    cores = parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(2 * cores, *keys)


def broadcast_if_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast when the caller can prove the row bound, else leave it to the planner."""
    return F.broadcast(df) if max_rows <= BROADCAST_ROW_LIMIT else df
