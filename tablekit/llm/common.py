"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.session import ensure_checkpoint_dir, scratch_path

#: Stands for a null doc_id where ids are ordered: after every real id.
LAST_ID = (1 << 63) - 1


def cut(df: DataFrame) -> DataFrame:
    """Materialise once, reliably, in the cluster's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut``, as a compressed table in the shared folder: smaller for
    wide rows, and later reads take only the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch, rows: int = 512):
    """Parts of a record batch, so that a task's Python objects stay few."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def sliced(batches, rows: int = 256):
    """All record batches in parts of at most ``rows`` rows."""
    for b in batches:
        yield from slices(b, rows)


def strings(column, rows: int = 256):
    """A column's values, made Python strings a few at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


def freed(task):
    """``task`` for ``mapInArrow``; when it ends, its worker, which lives on
    for later tasks, gives the memory it no longer uses back to the system."""
    def run(batches):
        try:
            yield from task(batches)
        finally:
            import pyarrow as pa
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # other C libraries have none
                pass
    return run


def bucket_of(doc_id: str, n: int):
    """crc32 of the id as text, modulo n (null ids: remainder of "")."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, d, th, text): the id, its order value (nulls last), a hash of
    the text that tells rows with one id apart, and the text.  Any other
    column, whatever its name, is left behind."""
    return df.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID)).alias("d"),
        F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("\u0000"))).alias("th"),
        F.col(f"`{text_col}`").alias("text"))


def repeated(df: DataFrame, n: str, name: str, block: int = 4096) -> DataFrame:
    """Every row ``n`` times, numbered from 0 in ``name``; copies are dealt
    out in blocks, so that one row with very many is no single task's."""
    starts = df.withColumn(name, F.explode(F.expr(f"sequence(0L, {n} - 1, {block}L)")))
    return starts.repartition(*df.columns, name).withColumn(
        name, F.explode(F.expr(f"sequence({name}, least({n}, {name} + {block}) - 1)")))


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
