"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Bag union by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def concat_results(frames: dict[str, DataFrame], tag: str = "model") -> DataFrame:
    """U2 + P12: union of per-source results, each tagged with its name."""
    return union_by_name([f.withColumn(tag, F.lit(name)) for name, f in frames.items()])


def label_universe(df: DataFrame, truth: str, pred: str, name: str = "label") -> DataFrame:
    """Distinct labels seen in truth or prediction."""
    return (df.select(F.col(truth).alias(name))
              .union(df.select(F.col(pred).alias(name))).distinct())


def strict_diff(a: DataFrame, b: DataFrame, side: str = "side") -> DataFrame:
    """Rows of ``a`` not in ``b`` and of ``b`` not in ``a`` (multiset
    difference, so duplicates count), tagged with their side.

    One signed count per distinct row: each side is read once and copies are
    pre-summed before the one shuffle."""
    cols = a.columns
    both = a.withColumn("_n", F.lit(1)).unionByName(b.select(*cols).withColumn("_n", F.lit(-1)))
    net = both.groupBy(*[F.col(f"`{c}`") for c in cols]).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    copies = F.sequence(F.lit(1).cast("long"), F.abs("_n"))
    return net.select(F.when(F.col("_n") > 0, "only_a").otherwise("only_b").alias(side),
                      *[F.col(f"`{c}`") for c in cols], F.explode(copies).alias("_i")).drop("_i")
