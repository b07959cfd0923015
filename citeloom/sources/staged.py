"""Stage tables between steps, and re-reading of staged CSV."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.text import restore_breaks


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    own = tempfile.mkdtemp(prefix="citeloom-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


#: Folder of the run that owns the stages made in this thread, if one does.
_owner: ContextVar[str | None] = ContextVar("stage_owner", default=None)


def new_stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the owning run's folder, or below the shared one; never reused."""
    return f"{_owner.get() or shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def owned_stages(spark: SparkSession, name: str) -> Iterator[str]:
    """Stages made inside the block lie in one folder that goes when the block ends.

    For runs that write their result inside the block: a table returned from it
    must not read a stage. What an attempt of the same name left behind when its
    driver was lost goes first, so two runs must not share a name at a time.
    """
    folder = f"{shared_folder(spark)}/{name}"
    _remove(spark, folder)
    before = _owner.set(folder)
    try:
        yield folder
    finally:
        _owner.reset(before)
        _remove(spark, folder)


def write_stage(df: DataFrame, path: str) -> DataFrame:
    """Write a Parquet stage and return the table read back from it.

    The lineage is cut there: later steps prune columns from the stage and a
    lost executor re-reads it instead of parsing the source again. Stages are
    most of what a run writes, so they are packed well.
    """
    df.write.mode("overwrite").parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_staged_csv(
    spark: SparkSession,
    path: str,
    columns: list[str],
    array_columns: tuple[str, ...] = (),
    line_breaks: str = "keep",
) -> DataFrame:
    """Read a staged CSV; the named list columns become arrays again.

    Values may hold line breaks, so a file is read by one task, unless it was
    written with ``line_breaks="escape"`` and is read so: then files are split.
    """
    rows = spark.read.csv(
        path,
        schema=", ".join(f"`{c}` string" for c in columns),
        header=True,
        quote='"',
        escape='"',
        multiLine=line_breaks == "keep",
        nullValue="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    value = (lambda c: restore_breaks(F.col(c))) if line_breaks == "escape" else F.col
    return rows.select(
        *(
            F.from_json(value(c), "array<string>").alias(c) if c in array_columns else value(c).alias(c)
            for c in columns
        )
    )
