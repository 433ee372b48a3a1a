"""Helpers shared by the operators: shared storage, size-checked broadcasts, batches.

Of the session's settings only the rows of an Arrow batch are set, to one value, and only where unset.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts name it.
ASCII_SPACE = r"\x20\x09-\x0D"
#: Rows up to which the small side of a join may be broadcast (8 to 40 bytes a row).
BROADCAST_ROWS = 250_000
#: Texts that a Python worker unpacks at a time: rows and bytes, at most (a longer text goes alone).
SLICE_ROWS, SLICE_BYTES = 500, 4 << 20

BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a temporary folder stands in for it if all of Spark runs in one process
    (tests); on a cluster, whose executors would not see it, this raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="talus-")
        _own[spark.sparkContext.applicationId] = path
    return path.rstrip("/")


def publish(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: what follows reads files that outlive any executor.
    The files go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a published ``df`` that nothing reads any more."""
    spark = df.sparkSession
    files = {f.rpartition("/")[0] for f in df.inputFiles()}
    for path in files:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay within ``limit``; else ``df``."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= limit else df


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def batches(spark: SparkSession, rows: int = SLICE_ROWS) -> None:
    """Few rows in an Arrow batch, so that Spark holds few long texts at a time; a session that
    names a number of its own keeps it."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, str(rows))


def column(b: pa.RecordBatch, path: str) -> pa.Array:
    """A column, or a field of one (``row.text``)."""
    name, _, of = path.partition(".")
    return b.column(name).field(of) if of else b.column(name)


def sliced(parts: Iterator[pa.RecordBatch], path: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of ``parts`` in slices of at most SLICE_ROWS rows and, but for a single longer
    text, SLICE_BYTES of the column ``path``: what a worker holds unpacked is bounded by bytes, not by rows."""
    for b in parts:
        ends = np.cumsum(pc.fill_null(pc.binary_length(column(b, path)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at, n = 0, b.num_rows
        while at < n:
            before = int(ends[at - 1]) if at else 0
            to = int(np.searchsorted(ends, before + SLICE_BYTES, side="right"))
            to = min(n, at + SLICE_ROWS, max(to, at + 1))
            yield b.slice(at, to - at)
            at = to


def power_of_two(n: int) -> int:
    return 1 << max(0, int(n) - 1).bit_length()


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` in one, so that names of an operator's own never clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def unpacked(df: DataFrame, columns: list[str], row: str = "row", **new: Column) -> DataFrame:
    """The packed columns again, those in ``new`` with a new value."""
    return df.select(*[(new[c] if c in new else F.col(f"{row}.`{c}`")).alias(c) for c in columns])


def numbered(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``, packed) and ``rid`` (the row's number), written once: what
    finds rows and what drops them read the same file, so that no number depends on how a scan is split."""
    return publish(docs.select(packed(docs).alias("row"), F.monotonically_increasing_id().alias("rid")), "numbered")


def without_rows(rows: DataFrame, columns: list[str], gone: DataFrame) -> DataFrame:
    """The columns of numbered ``rows`` without the rows whose number is in ``gone`` (rid)."""
    gone = small(publish(gone.select(F.col("rid").alias("gone")), "dropped"))
    return unpacked(rows.join(gone, F.col("rid") == F.col("gone"), "left_anti"), columns)
