"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def build_session(app: str = "gridloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution, skew handling and a fixed UTC zone.

    Nothing here depends on the size of the cluster: shuffle partitions are left to the
    caller (or to adaptive coalescing of a generous number on a cluster).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster.

    In a local session without one, a folder of our own that is removed at the end. On a cluster a folder
    of one machine would lose what the others write, so there the setting is required.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="gridloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


#: The folder of the innermost open scope of this thread of work.
_SCOPE: ContextVar[str | None] = ContextVar("scope", default=None)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder, or in the open `scratch` scope, that no other run uses."""
    return f"{_SCOPE.get() or f'{shared_folder(spark)}/gridloom'}/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ours on whatever file system it is; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scope for the intermediate tables of a run: they lie in one folder, which is removed at the end, also after an error.

    A DataFrame made inside may read such tables, so what it gives must be written or collected before the scope closes:

        with scratch(spark):
            dispatch(...).write.parquet(result)

    Scopes may stand inside each other; each removes its own folder only. What is to stay, such as datasets
    that are built once, does not lie in a scope.
    """
    folder = f"{_SCOPE.get() or f'{shared_folder(spark)}/gridloom'}/scope-{uuid.uuid4().hex}"
    token = _SCOPE.set(folder)
    try:
        yield folder
    finally:
        _SCOPE.reset(token)
        remove_folder(spark, folder)


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, for a repartition ahead of an expanding join.

    Adaptive execution merges small partitions by their bytes before the join, which would leave a
    join that multiplies rows to few tasks; a repartition with a number is left as it is.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
