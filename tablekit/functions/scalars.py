"""Numeric, time and status column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- X1 / X23
def duration_seconds(start: Column | str, end: Column | str) -> Column:
    """Wall-clock seconds from start to end (works on zoned and zone-free
    timestamps; no round trip through the session zone)."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(1e6)


def duration_hours(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / F.lit(3.6e9)


# ---------------------------------------------------------------- X2
def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den when both are > 0 (and not NaN), else NULL."""
    n, d = _c(num), _c(den)
    ok = (n > 0) & (d > 0) & ~F.isnan(n) & ~F.isnan(d)
    return F.when(ok, n / d)


# ---------------------------------------------------------------- X3
def round_digits(c: Column | str, digits: int = 4) -> Column:
    """Round like pandas / numpy: scale by 10^digits, round half to even,
    scale back.  Plain IEEE arithmetic, so every engine gives the same bits
    (Spark's ``round`` goes through the JVM's decimal text of the double, whose
    digits on ties depend on the JDK)."""
    f = float(10 ** digits)
    return F.bround(_c(c) * f, 0) / f


# ---------------------------------------------------------------- X17
def value_map(c: Column | str, mapping: dict, default=None) -> Column:
    """Look a value up in a small fixed map (e.g. 0 -> DOWN, 1 -> UP)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    out = F.try_element_at(m, _c(c))
    return out if default is None else F.coalesce(out, F.lit(default))


# ---------------------------------------------------------------- X18
def threshold_band(c: Column | str, steps: list[tuple[float, str]]) -> Column:
    """Band name of the highest step whose lower bound (inclusive) is <= value.

    ``steps`` = [(lower bound, name)], e.g. [(0, 'green'), (70, 'yellow'),
    (85, 'red')]; values under the first bound get the first name, NULL stays
    NULL.
    """
    x = _c(c)
    ordered = sorted(steps, key=lambda s: s[0], reverse=True)
    out = None
    for bound, name in ordered[:-1]:
        out = F.when(x >= bound, name) if out is None else out.when(x >= bound, name)
    last = ordered[-1][1]
    if out is None:
        return F.when(x.isNotNull(), F.lit(last))
    return out.when(x.isNotNull(), F.lit(last))


# ---------------------------------------------------------------- X21
def iso_time(ts: Column | None = None) -> Column:
    """ISO-8601 text of a timestamp (default: now, fixed per query)."""
    t = F.current_timestamp() if ts is None else ts
    return F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


# ---------------------------------------------------------------- X22 / P10
def coerce_numeric(c: Column | str, to: str = "double") -> Column:
    """Text to number, bad text to NULL (``errors='coerce'``)."""
    return _c(c).try_cast(to)


def with_status(value: Column, raw: Column, what: str = "value") -> list[Column]:
    """value, status ('success' / 'failed') and error text columns for a
    conversion that may fail."""
    failed = value.isNull() & raw.isNotNull()
    return [value.alias(what),
            F.when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
            F.when(failed, F.concat(F.lit("cannot parse: "), raw)).alias("error")]
