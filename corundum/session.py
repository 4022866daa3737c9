"""Session set-up and the few run-time helpers that need a SparkSession."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes up to which a small side may be broadcast; beyond them joins shuffle (salted where a key is hot).
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 64 << 20
#: Rows of one key that a task may get in a join before the key is salted.
TASK_ROWS = 500_000


def local_session(name: str = "corundum", cores: int = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine. Clusters bring their own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: what the session names in spark.checkpoint.dir, or, only in local mode, an own one.

    On a cluster without the setting this raises, since a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    have = sc.getCheckpointDir()
    if have:
        return have
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="corundum-checkpoint-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """A reliable checkpoint: lineage is cut and the rows lie in the shared folder, so lost executors don't matter."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """df over as many partitions as there are cores, if it has fewer: for a table of few files before a dear function.

    Tables of many files, as on a cluster, stay as they are, without a shuffle. So does what comes out of a shuffle: its
    partitions are the engine's choice, and to count them would run it.
    """
    if df._jdf.queryExecution().executedPlan().nodeName().startswith("AdaptiveSparkPlan"):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def share_out(df: DataFrame) -> DataFrame:
    """df dealt out to all tasks, before a dear function over rows that are few bytes and would be joined into few tasks.

    Not by keys: where df is laid out by them already, the engine would leave that step out and join tasks again.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def release(df: DataFrame) -> None:
    """Deletes the checkpoint files of a materialised DataFrame that nothing reads any more; does nothing for others."""
    plan = df._jdf.queryExecution().logical()
    if plan.nodeName() != "LogicalRDD" and "LogicalRDD" not in plan.getClass().getName():
        return
    file = plan.rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether df has at most so many rows and, in its texts and arrays, about so many bytes; reads no more than one row beyond."""
    width = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif kind in ("array", "map"):
            width = width + 24 * F.greatest(F.size(F.col(f"`{f.name}`")), F.lit(0))
    n, held = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()
    return n <= rows and held <= size


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", rows: int = BROADCAST_ROWS, weight: str | None = None) -> DataFrame:
    """Join that broadcasts `small` only after measuring it; a larger one takes the salted shuffle join.

    `small` must have at most one row for each key.
    """
    if fits(small, rows):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, weight=weight)


def salted_join(big: DataFrame, small: DataFrame, on: list[str], how: str = "left", weight: str | None = None, by: list[str] | None = None, task_rows: int = TASK_ROWS) -> DataFrame:
    """Inner or left equi-join in which no key of `big` brings a task more than about `task_rows` rows.

    `weight` names a column of `small` with the rows of `big` for each key, as an aggregate of `big` has it at hand; it
    is left out of the result. Without it the rows are counted first. `small` has at most one row for each key.

    A key with more than task_rows rows gets one salt for each task_rows of them, from a hash of the row's columns `by`
    (all columns by default), and its row of `small` is repeated for each salt. The bound is raised to 1/BROADCAST_ROWS
    of all rows where that is more, so that at most BROADCAST_ROWS keys are hot, with as many salts, whatever the size of
    the tables: the list of hot keys may be broadcast. Rows with a null key match nothing and are spread by the same hash.
    """
    counted = small if weight else big.groupBy(*on).agg(F.count(F.lit(1)).alias("__weight"))
    rows = F.col(weight or "__weight")
    total = counted.agg(F.greatest(F.lit(task_rows), F.coalesce(F.sum(rows), F.lit(0)) / BROADCAST_ROWS).alias("__most"))
    hot = counted.select(*on, rows.alias("__rows")).join(F.broadcast(total), F.col("__rows") > F.col("__most"), "inner").select(*on, F.ceil(F.col("__rows") / F.col("__most")).cast("int").alias("__salts"))
    hot = F.broadcast(hot)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in by or big.columns])
    null = F.lit(False)
    for c in on:
        null = null | F.col(f"`{c}`").isNull()
    left = big.join(hot, on, "left").withColumn("__salt", F.when(null, F.pmod(row, F.lit(1 << 20)).cast("int")).otherwise(F.coalesce(F.pmod(row, F.col("__salts")).cast("int"), F.lit(0)))).drop("__salts")
    right = small.drop(weight) if weight else small
    right = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), F.coalesce("__salts", F.lit(1)) - 1))).drop("__salts")
    return left.join(right, [*on, "__salt"], how).drop("__salt")
