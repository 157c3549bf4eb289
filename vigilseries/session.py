"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from vigilseries.shipping import ship

#: Parquet looks at the size of a page after 100 rows at first, which large rows fill with a hundred megabytes and more.
PAGE_CHECK = {"parquet.page.size.row.check.min": "1"}
_written: list[str] = []
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Row windows cost more time than their bytes suggest: let small shuffles keep all cores busy.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A Python task holds a batch on both sides, more than once: rows may be whole texts. Buffers outside the heap double as they fill.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # HotSpot leaves methods above 8,000 bytecodes uncompiled; wide feature rows would run interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app: str = "vigilseries", **settings) -> SparkSession:
    """Session with the settings the operators rely on; keyword settings win."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**_SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Smaller batches for Python tasks in a session made elsewhere, unless it sets their size itself."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, _SETTINGS[key])


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. A folder of our own is
    made only in local mode, where every task sees the same disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="vigilseries-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    _written.append(f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}")
    return _written[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediates this process has written; call when their results are stored."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def write_once(df: DataFrame, path: str, mode: str = "errorifexists", rows_a_file: int = 0) -> None:
    """Write ``df`` and drop the shuffle files of the write, which else stay until the driver collects its garbage."""
    with setting(df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.mode(mode).options(**PAGE_CHECK).option("maxRecordsPerFile", rows_a_file).parquet(path)


def materialize(df: DataFrame, label: str = "stage", rows_a_file: int = 0) -> DataFrame:
    """Write ``df`` once to shared Parquet and read it back.

    Cuts the lineage so that a lost executor never recomputes an unstable
    assignment, and lets every reader prune columns. ``rows_a_file`` bounds the
    rows of a file (0: no bound).
    """
    path = scratch_path(df.sparkSession, label)
    write_once(df, path, rows_a_file=rows_a_file)
    return df.sparkSession.read.schema(df.schema).parquet(path)
