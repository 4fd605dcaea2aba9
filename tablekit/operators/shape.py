"""Projections, renames and row filters.

Every function is a narrow transformation (no shuffle); Catalyst pushes the
filters and the column lists into the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# ---------------------------------------------------------------- P1 / P2
def drop_if_present(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def keep_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep ``cols`` in list order, ignoring names that are absent."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in cols if c in have])


# ---------------------------------------------------------------- P3 / P4
def rename_ci(df: DataFrame, canonical: list[str]) -> DataFrame:
    """Rename any case variant of a canonical name to the canonical name.

    When two variants of one name coexist (only possible with
    ``spark.sql.caseSensitive=true``) they are merged with ``coalesce``, first
    present variant first.
    """
    want = {c.lower(): c for c in canonical}
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(want.get(c.lower(), c), []).append(c)
    cols = []
    for name, variants in groups.items():
        if len(variants) == 1:
            cols.append(F.col(f"`{variants[0]}`").alias(name))
        else:
            cols.append(F.coalesce(*[F.col(f"`{v}`") for v in variants]).alias(name))
    return df.select(*cols)


def prefix_rename(df: DataFrame, prefix: str, mapping: dict[str, str] | None = None,
                  keep: list[str] | None = None) -> DataFrame:
    """Rename lookup columns before a join: explicit ``mapping`` wins, else
    ``prefix`` + name for every column not in ``keep``."""
    keep = set(keep or [])
    ren = {}
    for c in df.columns:
        if mapping and c in mapping:
            ren[c] = mapping[c]
        elif c not in keep and prefix:
            ren[c] = prefix + c
    return df.withColumnsRenamed(ren)


# ---------------------------------------------------------------- P5
def align_features(df: DataFrame, model_cols: list[str], fill=0,
                   strict: bool = False) -> tuple[DataFrame, list[str]]:
    """Select ``model_cols`` in model order; absent ones become ``fill``;
    extra columns are dropped.  Returns (frame, list of filled columns) so the
    caller sees silent zero features; ``strict`` raises instead."""
    have = set(df.columns)
    missing = [c for c in model_cols if c not in have]
    if strict and missing:
        raise ValueError(f"columns missing for the model: {missing}")
    cols = [F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in model_cols]
    return df.select(*cols), missing


# ---------------------------------------------------------------- P6 / P7
def numeric_columns(df: DataFrame, exclude: list[str] | None = None) -> list[str]:
    ex = set(exclude or [])
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in ex]


def numeric_map(df: DataFrame, fn, exclude: list[str] | None = None) -> DataFrame:
    """Apply ``fn(Column) -> Column`` to every numeric column but ``exclude``."""
    return df.withColumns({c: fn(F.col(f"`{c}`")) for c in numeric_columns(df, exclude)})


def noise(seed: int, key: Column, salt: str, sd: float) -> Column:
    """Gaussian N(0, sd) from an md5 of (seed, salt, key) by Box-Muller:
    the same value for a row in any partition layout, and in any engine that
    has md5."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), key.cast("string")))
    u1 = (F.conv(F.substring(h, 1, 12), 16, 10).cast("double") + 1.0) / F.lit(2.0 ** 48 + 1.0)
    u2 = F.conv(F.substring(h, 13, 12), 16, 10).cast("double") / F.lit(2.0 ** 48)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * 3.141592653589793) * u2) * sd


def drift_inject(df: DataFrame, key: str, shift: dict[str, float] | None = None,
                 scale: dict[str, float] | None = None, sd: float = 0.05, seed: int = 0,
                 exclude: list[str] | None = None) -> DataFrame:
    """Perturb a table: add ``shift`` per column, multiply by ``scale`` per
    column, then add Gaussian noise of ``sd`` to every numeric column except
    ``exclude`` (put the target and, if wanted, label codes there).  Noise is
    keyed by (seed, column, row key), so it does not depend on the layout."""
    out = df
    if shift:
        out = out.withColumns({c: F.col(c) + v for c, v in shift.items()})
    if scale:
        out = out.withColumns({c: F.col(c) * v for c, v in scale.items()})
    if sd:
        cols = numeric_columns(out, [key, *(exclude or [])])
        out = out.withColumns({c: F.col(c) + noise(seed, F.col(key), c, sd) for c in cols})
    return out


# ---------------------------------------------------------------- P8
def feature_target_split(df: DataFrame, target: str) -> tuple[list[str], str]:
    return [c for c in df.columns if c != target], target


# ---------------------------------------------------------------- P9 / P12
def fill_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def tag_source(df: DataFrame, name: str, value: str) -> DataFrame:
    return df.withColumn(name, F.lit(value))


# ---------------------------------------------------------------- F1-F3
def dropna_subset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``cols``."""
    return df.dropna(subset=cols)


def positive_filter(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows where every column is > 0; NaN does not pass (pandas rule)."""
    cond = F.lit(True)
    for c in cols:
        x = F.col(c)
        cond = cond & (x > 0)
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(x)
    return df.filter(cond)


def not_null_filter(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


# ---------------------------------------------------------------- F4
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png")


def extension_filter(df: DataFrame, col: str, extensions=IMAGE_EXTENSIONS,
                     skip_prefix: str = "__MACOSX") -> DataFrame:
    low = F.lower(F.col(col))
    ok = F.lit(False)
    for e in extensions:
        ok = ok | low.endswith(e)
    return df.filter(ok & ~F.col(col).startswith(skip_prefix))


# ---------------------------------------------------------------- F5
def validate_nonempty(df: DataFrame, col: str, strict: bool = True,
                      default: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Split into (valid, quarantine).  ``strict``: white-space-only text is
    empty too (three endpoints); otherwise only '' and NULL are rejected (the
    entity endpoint).  Quarantine rows carry a ``reason``."""
    x = F.col(col)
    empty = x.isNull() | (x == "")
    if strict:
        empty = empty | (F.regexp_replace(x, r"\s", "") == "")
    reason = F.when(x.isNull(), "missing").otherwise("empty")
    tagged = df.withColumn("_bad", empty)
    valid = tagged.filter(~F.col("_bad")).drop("_bad")
    bad = tagged.filter(F.col("_bad")).drop("_bad").withColumn("reason", reason)
    return valid, bad


# ---------------------------------------------------------------- F6
def expectations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One pass: per rule the number of breaking rows and a verdict.

    ``rules`` maps a rule name to a condition that must hold; a NULL result
    counts as a break.  Output: rule, failed, passed (bool).
    """
    aggs = [F.count_if(~F.coalesce(cond, F.lit(False))).alias(name)
            for name, cond in rules.items()]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in rules)
    return (wide.selectExpr(f"stack({len(rules)}, {stack}) as (rule, failed)")
                .withColumn("passed", F.col("failed") == 0))


# ---------------------------------------------------------------- F7 / F8
def status_filter(df: DataFrame, value: str = "success", col: str = "status") -> DataFrame:
    return df.filter(F.col(col) == value)


def time_range_filter(df: DataFrame, ts: str, ref, seconds: int) -> DataFrame:
    """Samples in [ref - seconds, ref]; ``ref`` is a parameter (a literal
    timestamp or column), never the wall clock, so results repeat."""
    r = F.lit(ref) if not isinstance(ref, Column) else ref
    return df.filter((F.col(ts) >= r - F.make_dt_interval(secs=F.lit(seconds)))
                     & (F.col(ts) <= r))


# ---------------------------------------------------------------- F9
def threshold_rule(df: DataFrame, rules: DataFrame, metric: str = "metric",
                   value: str = "value") -> DataFrame:
    """Samples that break their metric's rule.

    ``rules``: (metric, rule, op, limit) with op in > >= < <= == !=; broadcast
    to the samples while its checked size allows.  NULL never fires.
    """
    from tablekit.operators.joins import bounded_broadcast
    j = df.join(bounded_broadcast(rules), on=metric, how="inner")
    v, lim, op = F.col(value), F.col("limit"), F.col("op")
    fires = (F.when(op == ">", v > lim).when(op == ">=", v >= lim)
             .when(op == "<", v < lim).when(op == "<=", v <= lim)
             .when(op == "==", v == lim).when(op == "!=", v != lim))
    return j.filter(F.coalesce(fires, F.lit(False)))


# ---------------------------------------------------------------- F10
def label_match(df: DataFrame, labels_col: str = "labels", **eq: str) -> DataFrame:
    """Series whose label map has every given key = value."""
    cond = F.lit(True)
    for k, v in eq.items():
        cond = cond & (F.try_element_at(F.col(labels_col), F.lit(k)) == v)
    return df.filter(cond)
