"""Session settings the library relies on, and its scratch folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Calendar arithmetic is written for UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Jobs that run side by side.
SIDE_BY_SIDE = 6

# Folders made for sessions that name none, by application; scratch folders in use, likewise.
_own_folders: dict[str, str] = {}
_run_dirs: dict[str, list[str]] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def build_session(app_name: str = "tallyboard", master: str | None = None, **options: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **options}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    A session that names none gets a temporary folder, but only where driver and
    executors are one process; elsewhere other machines would not see its files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="tallyboard-")
    return _own_folders[context.applicationId]


def new_run_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses.

    The end of the enclosing ``scratch_scope`` deletes it; without one, ``remove_run_dirs`` does.
    """
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _scope.get()
    (_run_dirs.setdefault(spark.sparkContext.applicationId, []) if scope is None else scope).append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Scratch folders made inside are deleted at the end, also after an error; no frame that reads them may be used later."""
    paths: list[str] = []
    token = _scope.set(paths)
    try:
        yield
    finally:
        _scope.reset(token)
        for path in paths:
            remove_path(spark, path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` in the shared folder, so that it is computed once whatever reads it."""
    path = new_run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(spark: SparkSession, steps: Sequence[Callable[[], object]]) -> None:
    """Run writes that need nothing of each other, so that the short stages of one do not leave cores idle; all have ended when this raises."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    for step in running:
        step.result()


def remove_run_dirs(spark: SparkSession) -> int:
    """Delete this application's scratch folders, once no frame that reads them is needed. Returns their number."""
    paths = _run_dirs.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
