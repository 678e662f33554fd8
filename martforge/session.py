"""Spark session settings and the shared work folder.

The engine never keeps data on the driver. Anything it has to write between
steps (fixture files, raw history, snapshots, stream checkpoints) goes below
one shared folder: the one the cluster names in ``spark.checkpoint.dir``.
Only a local session without that setting gets a private folder, so tests and
laptop runs work without configuration.
"""

from __future__ import annotations

import functools
import os
import re
import tempfile
import threading
import uuid
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import SparkSession

# Settings the engine relies on. ANSI mode makes the strict casts raise (the
# reference's CAST fails a load on bad input); AQE re-plans joins with real
# sizes, merges small shuffle partitions and splits skewed ones.
ENGINE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key's partition even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "martforge",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine settings.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``spark.sql.shuffle.partitions`` to the data (about 128-256 MB per
    partition after compression) and let AQE coalesce.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.ui.enabled", "false")
            builder = builder.config("spark.ui.showConsoleProgress", "false")
            builder = builder.config("spark.driver.memory", os.environ.get("MARTFORGE_DRIVER_MEMORY", "16g"))
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to a session someone else built."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset and the master is local (tests,
    single-machine runs) a private folder is created and registered as the
    checkpoint directory; on a cluster an unset value is an error, because a
    machine-local folder is not visible to the executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    path = tempfile.mkdtemp(prefix="martforge-shared-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def work_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder below the shared folder (never reused between runs)."""
    return "/".join([shared_dir(spark), "martforge", *parts, uuid.uuid4().hex])


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Session settings for the jobs that run inside; the caller's values come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# What a task of a load or a mart refresh reads at most. The defaults (128 MB of text, 64 MB of compressed
# shuffle) are several times as large as rows in a sort, which then spills more the larger the table is.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
PARTITION_FILE_BYTES = 4 << 20  # of Parquet input, for each shuffle partition (AQE merges small ones)

_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
_scopes: WeakKeyDictionary[SparkSession, dict] = WeakKeyDictionary()
_scopes_lock = threading.Lock()


def byte_size(value: str) -> int:
    """The bytes that a size setting names ('16m', '64MB', '134217728b')."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)b?\s*", value.lower()).groups()
    return int(number) * _UNITS[unit]


@contextmanager
def bounded_tasks(spark: SparkSession):
    """Small tasks, whatever the size of the tables, for the jobs that run inside.

    Scopes may nest and run side by side in threads of one session: the
    caller's values come back when the last one ends. Smaller values stay.
    """
    with _scopes_lock:
        scope = _scopes.setdefault(spark, {"open": 0})
        if not scope["open"]:
            scope["before"] = {key: spark.conf.get(key, None) for key in (*TASK_BYTES, SHUFFLE_PARTITIONS)}
            for key, most in TASK_BYTES.items():
                if byte_size(spark.conf.get(key)) > most:
                    spark.conf.set(key, str(most))
        scope["open"] += 1
    try:
        yield
    finally:
        with _scopes_lock:
            scope["open"] -= 1
            if not scope["open"]:
                for key, value in scope["before"].items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def in_bounded_tasks(fn):
    """``fn``, whose first argument is the session, run in ``bounded_tasks``."""
    @functools.wraps(fn)
    def run(spark: SparkSession, *args, **kwargs):
        with bounded_tasks(spark):
            return fn(spark, *args, **kwargs)

    return run


# A write into partition folders sorts by them first, unless a task may hold a few of its files open.
OPEN_FILES = {"spark.sql.maxConcurrentOutputFileWriters": "4"}
_writers: WeakKeyDictionary[SparkSession, dict] = WeakKeyDictionary()


@contextmanager
def unsorted_folders(spark: SparkSession):
    """Writes that run inside keep the order of their rows where a task writes into few partition folders.

    Scopes may run side by side, as those of ``bounded_tasks``.
    """
    with _scopes_lock:
        scope = _writers.setdefault(spark, {"open": 0})
        if not scope["open"]:
            scope["before"] = {key: spark.conf.get(key, None) for key in OPEN_FILES}
            for key, value in OPEN_FILES.items():
                spark.conf.set(key, value)
        scope["open"] += 1
    try:
        yield
    finally:
        with _scopes_lock:
            scope["open"] -= 1
            if not scope["open"]:
                for key, value in scope["before"].items():
                    spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def shuffle_partitions_for(spark: SparkSession, file_bytes: int) -> None:
    """Inside ``bounded_tasks``: enough shuffle partitions for Parquet files of so many bytes; never fewer than before."""
    with _scopes_lock:
        wanted = -(-file_bytes // PARTITION_FILE_BYTES)
        if wanted > int(spark.conf.get(SHUFFLE_PARTITIONS)):
            spark.conf.set(SHUFFLE_PARTITIONS, str(wanted))
