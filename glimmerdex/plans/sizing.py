"""Size checks and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 128 * 1024 * 1024
SALTS = 32
TEXT_PER_TASK = 4 * 1024 * 1024  # bytes in files: counted term by term, that many texts take some hundred MB of a task

BATCH_BYTES = 8 << 20


def _width(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(field.dataType, T.ArrayType):
        inner = field.dataType.elementType
        if isinstance(inner, T.StringType):
            size = F.octet_length(F.array_join(col, ",")) + F.size(col) * 8
        elif isinstance(inner, (T.NumericType, T.BooleanType)):
            size = F.size(col) * 8
        else:
            size = F.octet_length(F.to_json(F.struct(col)))
    elif isinstance(field.dataType, (T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(col)))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0)) + F.lit(8)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table, counted by the cluster."""
    widths = [_width(f) for f in df.schema.fields]
    total = sum(widths[1:], widths[0])
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(total).alias("b")).first()
    return row["n"], row["b"] or 0


def within_bounds(rows: int, size: int) -> bool:
    return rows <= MAX_BROADCAST_ROWS and size <= MAX_BROADCAST_BYTES


def is_small(df: DataFrame) -> bool:
    return within_bounds(*measure(df))


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast hint only behind a measured size; otherwise the plan shuffles."""
    return F.broadcast(df) if is_small(df) else df


def keyed_join(
    rows: DataFrame, side: DataFrame, on: list[str], spread_by: str, how: str = "inner", small: bool | None = None
) -> DataFrame:
    """Rows meet a look-up side that has few rows per key.

    Within the measured bound the side is broadcast and the rows stay where they
    are. Beyond it both are shuffled once, and adaptive execution splits the rows of a
    key that holds much of them, so it is not one task's work. Only where that is switched
    off are the rows of each key spread over salts by another column and the side
    repeated per salt.
    """
    if is_small(side) if small is None else small:
        return rows.join(F.broadcast(side), on, how)
    conf = rows.sparkSession.conf
    if all(conf.get(key) == "true" for key in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")):
        return rows.join(side, on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    repeated = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*on, "_salt"], how).drop("_salt")


def broadcast_up_to(df: DataFrame, at_most: int | None) -> DataFrame:
    """Broadcast hint for narrow rows whose greatest number follows from the plan, such as
    queries x k. Nothing is run to find out; without a known bound the plan shuffles."""
    return F.broadcast(df) if at_most is not None and at_most <= MAX_BROADCAST_ROWS // 4 else df


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only for local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="glimmerdex-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile leaves no shuffle files behind; they would stay until the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_bytes(df: DataFrame) -> int:
    """What the plan expects of a table; of one that is only scanned, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def few_splits(df: DataFrame) -> bool:
    """Whether a scan of the table has less work than the task slots could share.

    Measured by bytes, as files are split: dealing such a table out ships at most one
    split per slot, whatever the number of its files.
    """
    spark = df.sparkSession
    size = planned_bytes(df)
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return size < split * spark.sparkContext.defaultParallelism


def text_parts(df: DataFrame) -> int | None:
    """How many partitions keep a count of all terms within the memory of a task; None where adaptive execution
    makes them small enough, or where the size of the source is not known."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    parts = -(-size // TEXT_PER_TASK)
    return parts if df.sparkSession.sparkContext.defaultParallelism < parts < 1 << 20 else None


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Texts partitioned by key, in parts that grow in number and not in size."""
    parts = text_parts(df)
    return df.repartition(parts, key) if parts else df.repartition(key)


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table of few splits is dealt over all slots by key; a larger one is left where it is.

    The number of partitions is left to spark.sql.shuffle.partitions and to
    adaptive execution, which merges small ones.
    """
    return df.repartition(key) if few_splits(df) else df


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same table, its session passing texts to Python workers in batches of at most BATCH_BYTES.

    Batches are bounded by rows otherwise, or by more bytes than two workers beside a small heap can hold."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int("".join(c for c in conf.get(key) if c.isdigit()))
    if now > BATCH_BYTES:
        conf.set(key, f"{BATCH_BYTES >> 20}m")
    return df
