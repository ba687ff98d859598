"""Shared pieces of the training-data operators: tables, scratch tables, words, Arrow batches."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from greenlane.session import ensure_checkpoint_dir

#: Words are maximal runs of code points other than these (space, tab, LF, VT, FF, CR).
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a test directory."""
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send the package to the Python workers (once) where the driver found it by other means than its folder or PYTHONPATH."""
    import greenlane

    root = os.path.dirname(os.path.dirname(os.path.abspath(greenlane.__file__)))
    known = {os.path.abspath(p) for p in [os.getcwd(), *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))]}
    if root in known or (app := spark.sparkContext.applicationId) in _SHIPPED:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="greenlane-py-"), "greenlane.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "greenlane")):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the session's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet (with the writer's ``options``) in the shared folder and read it back (cuts the lineage)."""
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.options(**options or {}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the scratch files of a table made by ``written`` that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a one-element transform)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z only; other letters stay. ``lower`` is used where a text is plain ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def word_array(text: Column) -> Column:
    """Words of a text (null and blank texts: no words)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def slices(batch: pa.RecordBatch, rows: int, bytes_: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with at most ``rows`` rows and, unless of one row, about ``bytes_`` bytes."""
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        while n > 1 and batch.slice(at, n).nbytes > bytes_:
            n = (n + 1) // 2
        yield batch.slice(at, n)
        at += n


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema, rows: int = 512, bytes_: int = 4 << 20) -> DataFrame:
    """``mapInArrow`` with batches cut small, so that long texts stay within a worker's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, rows, bytes_):
                yield fn(part)

    return df.mapInArrow(run, schema)


def train_rows(doc_id: Column, remainder: int) -> Column:
    """True where crc32(doc_id as text) mod 5 differs from ``remainder`` (a null id counts as text '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 != remainder
