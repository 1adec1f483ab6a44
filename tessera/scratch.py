"""Scratch tables in the shared folder, and running totals over range-sorted partitions."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_LOCAL: list[str] = []
_MADE: list[str] = []
#: The tables of the innermost scope of this thread.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)
#: Arrow batches of whole texts: a task holds a batch as Arrow on both sides and as Python objects.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's bound on the bytes of an Arrow batch to BATCH_BYTES; a lower one stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = "".join(c for c in spark.conf.get(name) if c.isdigit())
    if not spark.conf.get(name).endswith(("b", *"0123456789")) or int(digits or 0) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def unused(columns: list[str], *names: str) -> list[str]:
    """names, each with as many underscores before it as make it differ from all columns, whatever their case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only in local mode, where it is unset, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _LOCAL:
            _LOCAL.append("file://" + tempfile.mkdtemp(prefix="tessera-"))
        folder = _LOCAL[0]
    return folder.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and returns a read of it: lineage ends there and a lost executor
    costs no recomputation.  cleanup() removes the tables."""
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_folder(spark)}/tessera-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    _MADE.append(path)
    owned = _OWNED.get()
    if owned is not None:
        owned.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of a shuffle that a task sorts, where partitions() counts them.
TASK_ROWS = 600_000


def partitions(df: DataFrame) -> int:
    """How many partitions keep a task at TASK_ROWS rows of df, which is counted; no fewer than the session's cores.  The
    session's own number of shuffle partitions is fixed, so that tasks would grow with the table."""
    return max(-(-df.count() // TASK_ROWS), df.sparkSession.sparkContext.defaultParallelism)


def drop_scratch(df: DataFrame) -> None:
    """Deletes the scratch table that df reads; call it only when nothing lazy still depends on it."""
    paths = [p for p in _MADE if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in df.inputFiles()[:1])]
    _delete(df.sparkSession, paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        if p in _MADE:
            _MADE.remove(p)


class scratch_scope:
    """with scratch_scope(spark) as scope: the scratch tables made inside, in this thread, are deleted at its end but those
    that scope.keep(df) names, by what df reads; a scope around it owns these.  Other threads' tables are theirs."""

    def __init__(self, spark: SparkSession):
        self.spark, self.kept = spark, []

    def __enter__(self) -> scratch_scope:
        self.made: list[str] = []
        self.token = _OWNED.set(self.made)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept += df.inputFiles()[:1]
        return df

    def __exit__(self, *error) -> None:
        _OWNED.reset(self.token)
        here = [p for p in self.made if p in _MADE]
        stay = [p for p in here if any(f"/{p.rsplit('/', 1)[1]}/" in f for f in self.kept)]
        _delete(self.spark, [p for p in here if p not in stay])
        around = _OWNED.get()
        if around is not None:
            around += stay


def cleanup(spark: SparkSession) -> None:
    """Deletes every scratch table of this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/tessera-{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _MADE.clear()


def running_total(
    df: DataFrame, group: list[str], order: list[str], values: dict[str, str], name: str
) -> DataFrame:
    """df with a column for each entry of values (new name: summed column): the sum over the rows of the same group
    that come earlier in order.  Rows are range-sorted over all partitions, summed per partition, and the partitions'
    sums are themselves summed per group, so that a group of any size is spread over many tasks.  Ties in order must
    not matter to the caller.  df should be cheap to scan (sampling reads it once more)."""
    span = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_last() for c in group + order]
    ranged = df.repartitionByRange(span, *keys).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, name)
    sums = ranged.groupBy(*group, "_part").agg(*[F.sum(v).alias(f"_{k}") for k, v in values.items()])
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_part").alias("_p"),
        *[F.coalesce(F.sum(f"_{k}").over(earlier), F.lit(0)).alias(f"_{k}") for k in values],
    )
    within = (
        Window.partitionBy(*group, "_part")
        .orderBy(*[F.col(c).asc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumns({k: F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in values.items()})
    match = F.col("_part") == F.col("_p")
    for i, c in enumerate(group):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    out = local.join(sums, match, "left")
    return out.withColumns({k: F.col(k) + F.col(f"_{k}") for k in values}).drop(
        "_p", "_part", *[f"_g{i}" for i in range(len(group))], *[f"_{k}" for k in values]
    )
