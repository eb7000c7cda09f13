"""Session set-up and lineage control."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_session(cpus: int | str = 8, app: str = "stratiform") -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure checkpoints have a home every executor can reach.

    A folder the session already has wins, then ``spark.checkpoint.dir``. Only a
    local master without either gets a temporary folder: on a cluster such a
    folder would vanish with its machine, so there the setting is required.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="stratiform-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is planned and written in here go as soon as it is written. Else
    they stay until the driver collects its garbage, and all steps of a job add up on disk."""
    before = spark.conf.get(RELEASE, None)
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE)
        else:
            spark.conf.set(RELEASE, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder, so loops neither grow their
    plan nor lose work when an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_released(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # planned anew: the setting counts when a plan is made


def cut_plan(df: DataFrame) -> DataFrame:
    """``df`` written as a table into the checkpoint folder and read again. For loops of many
    joins: a checkpoint hands on the planner's estimates, which multiply from round to round
    until planning takes longer than the work; a table's size is read from its files."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few driver-side rows as a table. Handed over as one Arrow table, so the planner
    knows its size and joins it by broadcast without being told to."""
    struct = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) if rows else [[] for _ in struct.fields]
    arrow = to_arrow_schema(struct)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), struct)
