"""Session defaults, shared scratch space, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import ContextVar
from pathlib import Path
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"

# A broadcast table is held by the driver and by every executor, so it has to stay well below their memory.
BROADCAST_BYTES = 64 * 1024 * 1024

# Threads of the driver that start jobs at the same time.
THREADS = 4

# Removes the shuffle files of a write as soon as it has ended; by default they stay until the driver collects garbage.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Tables spooled so far by the ``worked_off`` that runs.
_SPOOLED: ContextVar[list[str] | None] = ContextVar("spooled", default=None)

Given, Found = TypeVar("Given"), TypeVar("Found")


def build_session(app_name: str = "sluicebox", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are tuned for; ``conf`` overrides any of them."""
    settings: dict[str, object] = {
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application."""
    context = spark.sparkContext
    if getattr(context, "_sluicebox_shipped", False):
        return
    package = Path(__file__).resolve().parent
    bundle = Path(tempfile.mkdtemp(prefix="sluicebox-")) / "sluicebox.zip"
    with zipfile.ZipFile(bundle, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    context._sluicebox_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only in local mode, where driver and executors share one disk.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="sluicebox-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten there."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, work: Callable[[Given], Found], given: Sequence[Given]) -> list[Found]:
    """``work`` on each of ``given`` in threads that start their jobs in this session; the first error is raised."""
    with ThreadPoolExecutor(THREADS) as pool:
        return [run.result() for run in [pool.submit(inheritable_thread_target(spark)(work), each) for each in given]]


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage at a reliable checkpoint, so a lost executor re-reads files only."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spool(df: DataFrame, by: str | None = None) -> DataFrame:
    """As ``settle`` for larger results: a columnar table in the shared folder, so readers can prune columns.

    With ``by`` the table has one folder per value, and a reader that filters on it opens no other.
    """
    path = scratch_path(df.sparkSession, "spool")
    if (spooled := _SPOOLED.get()) is not None:
        spooled.append(path)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def worked_off(spark: SparkSession, work: Callable[[], DataFrame]) -> DataFrame:
    """``spool(work())``; what ``work`` spools in this thread is removed then, the shuffles of its tables when each is written."""
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    paths: list[str] = []
    outer = _SPOOLED.set(paths)
    try:
        made = work()
        _SPOOLED.reset(outer)
        outer = None
        return spool(made)
    finally:
        if outer:
            _SPOOLED.reset(outer)
        if before is None:
            spark.conf.unset(CLEANUP_CONF)
        else:
            spark.conf.set(CLEANUP_CONF, before)
        _remove(spark, paths)


def _remove(spark: SparkSession, paths: Sequence[str]) -> None:
    context = spark.sparkContext
    for path in map(context._jvm.org.apache.hadoop.fs.Path, paths):
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """``df``, a scan of few large files, dealt out so that all cores work on what follows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of text of ``df``. Runs a job: settle ``df`` first."""
    per_row = F.lit(16)
    for name in df.columns:
        per_row = per_row + F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0))
    total = F.coalesce(F.sum(per_row.cast("long")), F.lit(0))
    found = df.agg(F.count("*").alias("rows"), total.alias("bytes")).first()
    return found["rows"], found["bytes"]


def may_broadcast(n_bytes: int) -> bool:
    return n_bytes <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame, spooled: bool = False) -> DataFrame:
    """Settle ``df`` and mark it for broadcast only if its measured size stays under ``BROADCAST_BYTES``.

    A table that was ``spooled`` is not written again. Beyond the limit the join is an ordinary shuffle join, where adaptive execution splits skewed partitions.
    """
    settled = df if spooled else settle(df)
    return F.broadcast(settled) if may_broadcast(measure(settled)[1]) else settled
