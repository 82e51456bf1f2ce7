"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.session.timeZone": "UTC",
}


_own_dirs: dict[str, str] = {}
_staged: dict[str, list[str]] = {}


def get_spark(app_name: str, master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session.

    ``master`` stays unset on a cluster, where spark-submit names it. The number of shuffle
    partitions is left to the cluster's own setting, which AQE then coalesces.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own, removed at the end.
    """
    configured = spark.conf.get(SHARED_DIR_KEY, None) or spark.sparkContext.getConf().get(SHARED_DIR_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR_KEY} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="shopfloor-")
        atexit.register(shutil.rmtree, _own_dirs[app], ignore_errors=True)
    return _own_dirs[app]


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder; Spark creates it on the first write."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several branches: the lineage behind it runs once, and a lost
    executor re-reads files instead of recomputing. Frames read it lazily, so it stays until the
    scope around it ends (``staging``) or until ``drop_staged``.
    """
    path = work_folder(df.sparkSession, label)
    _staged.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(hadoop).delete(place, True)


def staged_of(df: DataFrame) -> set[str]:
    """The staged folders that ``df`` reads."""
    paths = _staged.get(df.sparkSession.sparkContext.applicationId, [])
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()} if paths else set()
    return {p for p in paths if any(f.endswith(p.rsplit("/", 1)[1]) or f"/{p.rsplit('/', 1)[1]}/" in f for f in folders)}


def drop_staged(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete all that ``stage`` has written in this application so far, or just ``paths``; frames that read it are void after that."""
    known = _staged.get(spark.sparkContext.applicationId, [])
    gone = list(known) if paths is None else [p for p in paths if p in known]
    _staged[spark.sparkContext.applicationId] = [p for p in known if p not in set(gone)]
    _delete(spark, gone)
    return len(gone)


class Staging:
    """What has been staged since a scope began."""

    def __init__(self, spark: SparkSession):
        self._spark, self._before = spark, set(_staged.get(spark.sparkContext.applicationId, []))
        self._kept: set[str] = set()

    @property
    def paths(self) -> list[str]:
        return [p for p in _staged.get(self._spark.sparkContext.applicationId, []) if p not in self._before]

    def result(self, df: DataFrame, label: str = "result") -> DataFrame:
        """``df``, staged so that it outlives the scope."""
        kept = stage(df, label)
        self._kept.add(self.paths[-1])
        return kept

    def end(self) -> None:
        drop_staged(self._spark, [p for p in self.paths if p not in self._kept])


@contextmanager
def staging(spark: SparkSession) -> Iterator[Staging]:
    """A scope: at its end all that was staged inside goes, but for what ``result`` has written.

    Frames that read other tables staged inside are void after that, so what leaves the scope is either
    written by then or passed through ``result``. A scope that fails cleans up as well.
    """
    scope = Staging(spark)
    try:
        yield scope
    finally:
        scope.end()
