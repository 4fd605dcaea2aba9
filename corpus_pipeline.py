"""The corpus pipeline: five stages over ``documents``, each written as
Parquet and read again before the next.

Stages 1 to 4 return the columns of ``documents``; the last returns the
encoded corpus.  Each stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import LAST_ID, texts
from tablekit.llm.decontam import decontaminate
from tablekit.llm.queries import piece_model
from tablekit.llm.sentencepiece import encode
from tablekit.llm.simhash import simhash_groups
from tablekit.llm.substring import substring_dedup
from tablekit.llm.toxicity import fit_toxicity, labelled, score_toxicity
from tablekit.registry import table
from tablekit.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _keyed(docs: DataFrame) -> DataFrame:
    """The table's columns with the row key (d, th) of the operators."""
    d = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("d")
    th = F.xxhash64(F.coalesce("text", F.lit("\u0000"))).alias("th")
    return docs.select(*COLUMNS, d, th)


def _by_key(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Join on the row key; ``rows`` must hold a key once."""
    rows = rows.withColumnsRenamed({"d": "rd", "th": "rth"})
    return _keyed(docs).join(rows, (F.col("d") == F.col("rd")) & (F.col("th") == F.col("rth")), how)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go.  Learned from all labelled documents; null
    and empty texts stay."""
    docs = docs.select(*COLUMNS)
    model = fit_toxicity(labelled(docs, table(spark, sf_dir, "labels")))
    # the text decides, so rows are told apart by id and text
    thin = texts(docs).select(F.struct("doc_id", "d", "th").alias("doc_id"), "text")
    bad = (score_toxicity(thin, model).filter("predicted = 1")
           .select("doc_id.d", "doc_id.th").distinct())
    return _by_key(docs, bad, "left_anti").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the smallest id's.  Rows equal
    in id and text count as one."""
    keep = (simhash_groups(docs, shingle=3, max_bits=2)
            .filter("d = keep_d and th = keep_th").select("d", "th").distinct())
    return (_by_key(docs, keep, "left_semi").dropDuplicates(["d", "th"]).select(*COLUMNS))


def substring_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out of all but their first document; a
    document of which nothing is left goes, others keep their columns (n_chars
    counts the new text).  Untouched texts stay byte for byte."""
    cut = substring_dedup(docs, min_words=13).filter("n_removed > 0").select("d", "th", "kept").distinct()
    rows = _by_key(docs, cut, "left").filter("kept is null or kept != ''")
    return rows.select(
        "doc_id", F.coalesce("kept", "text").alias("text"), "lang", "source",
        F.when(F.col("kept").isNotNull(), F.length("kept").cast("long")).otherwise(F.col("n_chars"))
        .alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    bad = (decontaminate(docs, table(spark, sf_dir, "benchmark"), size=10)
           .filter("n_hit > 0").select("d", "th").distinct())
    return _by_key(docs, bad, "left_anti").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids, round_trip): the encoded corpus, checked by
    decoding it again."""
    return encode(docs, piece_model()).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substring_duplicates),
    ("decontamination", decontamination),
    ("sentencepiece", tokens),
]

#: Model fits and tokenisation have no SQL form.  Tests hold the near-duplicate,
#: substring and decontamination stages against brute force, and the ids of
#: the last against their exact round trip.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
