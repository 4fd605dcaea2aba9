"""Batch sources (S1-S8): CSV, URL lists, parquet globs with schema drift,
labelled folder trees, whole-file JSON documents.

All readers are lazy ``spark.read`` calls; schemas are given explicitly
wherever the caller knows them, so no inference pass runs over big inputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.functions.text import strip_ws


# ---------------------------------------------------------------- S1
def scan_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             infer: bool = False) -> DataFrame:
    """CSV with a header line.

    With ``schema`` the columns are typed on read (the scalable form); with
    ``infer=True`` Spark samples the data to guess types (pandas-like);
    otherwise every column is a string, as a plain Spark read gives.
    """
    r = spark.read.option("header", True)
    if schema is not None:
        return r.schema(schema).csv(path)
    if infer:
        r = r.option("inferSchema", True)
    return r.csv(path)


# ---------------------------------------------------------------- S2
def scan_url_list(spark: SparkSession, path: str) -> DataFrame:
    """Header-less CSV of URLs: first field of rows starting with ``http``.

    The prefix test runs on the raw field, before stripping white space, so a
    line with a leading blank is dropped; kept values are stripped of all
    surrounding white space.  Result column: ``url``.
    """
    raw = (spark.read.option("header", False)
           .option("ignoreLeadingWhiteSpace", False)
           .option("ignoreTrailingWhiteSpace", False)
           .schema("_c0 string").csv(path))
    return (raw.filter(F.col("_c0").startswith("http"))
               .select(strip_ws(F.col("_c0")).alias("url")))


# ---------------------------------------------------------------- S3 / S4
def schema_normalize(df: DataFrame, schema: T.StructType,
                     case_insensitive: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema``: cast known columns (bad values become
    NULL), add missing ones as typed NULL, drop the rest.  NaN in floating
    columns becomes NULL so that later filters agree with pandas semantics.
    """
    present = {}
    for c in df.columns:
        present[c.lower() if case_insensitive else c] = c
    cols = []
    for f in schema.fields:
        src = present.get(f.name.lower() if case_insensitive else f.name)
        if src is None:
            e = F.lit(None).cast(f.dataType)
        else:
            e = F.col(f"`{src}`").try_cast(f.dataType)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                e = F.nanvl(e, F.lit(None).cast(f.dataType))
        cols.append(e.alias(f.name))
    return df.select(*cols)


def scan_parquet_glob(spark: SparkSession, paths: str | list[str],
                      schema: T.StructType | None = None) -> DataFrame:
    """Read many parquet files as one table.

    With ``schema`` it is imposed on read: one scan, one plan for any number
    of files, missing columns come back NULL, integer columns written as int
    in some files and long in others are widened by the reader, and column
    names resolve without regard to case.  This is the form to use at scale.
    """
    if isinstance(paths, str):
        paths = [paths]
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(*paths)
    if schema is not None:
        df = schema_normalize(df, schema)
    return df


def union_normalized(frames: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Normalise each input on its own (types drift between files), then bag
    union by name (U1).  For inputs whose drift the reader cannot absorb, e.g.
    a column that is text in some files and numbers in others."""
    parts = [schema_normalize(f, schema) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), parts)


def scan_parquet_files(spark: SparkSession, files: list[str],
                       schema: T.StructType) -> DataFrame:
    """Per-file read + normalise + union, in sorted file order (S3 + S4 + U1)."""
    return union_normalized([spark.read.parquet(p) for p in sorted(files)], schema)


# ---------------------------------------------------------------- S5
IMAGE_SUFFIX = r"(?i)\.(jpg|jpeg)$"


def scan_labelled_tree(spark: SparkSession, root: str, suffix_regex: str = IMAGE_SUFFIX,
                       with_content: bool = False) -> DataFrame:
    """Files two levels under ``root``: label = parent folder name.

    Uses the ``binaryFile`` source; ``content`` is only read when asked for,
    so a listing never pulls file bytes.  Plain files directly under ``root``
    are skipped.  Columns: filepath, label, file_name, length (+ content).
    """
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", True)
          .load(root))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _re_escape(root.rstrip("/")) + "/", "")
    parts = F.split(rel, "/")
    cols = [F.col("path").alias("filepath"),
            F.element_at(parts, -2).alias("label"),
            F.element_at(parts, -1).alias("file_name"),
            F.col("length")]
    if with_content:
        cols.append(F.col("content"))
    return (df.filter(F.size(F.split(rel, "/")) == 2)
              .select(*cols)
              .filter(F.col("file_name").rlike(suffix_regex)))


def _re_escape(s: str) -> str:
    import re
    return re.escape(s)


# ---------------------------------------------------------------- S6 / S7
def scan_json_documents(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Whole-file JSON documents (an object, or an array of records) with a
    given schema; an array root gives one row per record."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


TENSOR_SCHEMA = "inputs array<array<array<array<double>>>>"


def parse_tensor(col: Column, depth: int = 4) -> Column:
    """JSON text holding ``{"inputs": [[[...]]]}`` to nested double arrays."""
    t = "double"
    for _ in range(depth):
        t = f"array<{t}>"
    return F.from_json(col, f"inputs {t}").getField("inputs")


# ---------------------------------------------------------------- S8
def scan_parquet_dir(spark: SparkSession, path: str) -> DataFrame:
    """Recursive parquet read of an output folder; raises when it holds no
    parquet file (Spark's own path / schema error)."""
    return (spark.read.option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").parquet(path))
