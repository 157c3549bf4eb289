"""Written intermediates of one operator run, deleted as soon as they are not needed."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigilseries.session import PAGE_CHECK, scratch_path


def store(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back; the path is kept for ``drop``."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**PAGE_CHECK).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.stored_at = path
    return back


def unused(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that ``df`` does not have, made from the given ones."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def drop(*frames: DataFrame) -> None:
    """Delete what ``store`` wrote for these frames."""
    for df in frames:
        path = getattr(df, "stored_at", None)
        if path:
            jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
