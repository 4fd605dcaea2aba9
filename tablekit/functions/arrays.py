"""Array column functions (X13-X16, T3), all higher-order SQL functions.

Fixed values below follow the image convention of the source: mean 0.1307,
sd 0.3081 on a 0..255 grey scale, inversion when the mean is above 127.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Normalisation constants.
NORM_MEAN = 0.1307
NORM_SD = 0.3081
PIXEL_MAX = 255.0
INVERT_ABOVE = 127.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def array_mean(a: Column) -> Column:
    return F.try_divide(array_sum(a), F.size(a))


# ---------------------------------------------------------------- T3
def argmax(a: Column | str) -> Column:
    """0-based index of the first largest element."""
    a = _c(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


# ---------------------------------------------------------------- X13
def class_logits(a: Column | str, classes: int) -> Column:
    """``classes`` scores from a whole array: class j sums the values at
    positions j, j + classes, j + 2 classes, ... (0 where it has none)."""
    a = _c(a)
    return F.transform(F.sequence(F.lit(0), F.lit(classes - 1)), lambda j: array_sum(
        F.filter(a, lambda x, i: i % classes == j)))


def softmax(a: Column | str) -> Column:
    """exp(x - max) / sum(exp(x - max))."""
    a = _c(a)
    m = F.array_max(a).cast("double")
    ex = F.transform(a, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / s)


def softmax_confidence(a: Column | str) -> Column:
    """struct(predicted, confidence): argmax of the logits and its softmax
    probability, 1 / sum(exp(x - max))."""
    a = _c(a)
    m = F.array_max(a).cast("double")
    s = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - m))
    return F.struct(argmax(a).alias("predicted"), (F.lit(1.0) / s).alias("confidence"))


# ---------------------------------------------------------------- X14
def normalize_array(a: Column | str) -> Column:
    """Grey values 0..255: invert when the mean is above 127, scale to 0..1,
    then standardise with the fixed mean and sd."""
    a = _c(a)
    inv = array_mean(a) > INVERT_ABOVE
    return F.transform(a, lambda x: (
        (F.when(inv, F.lit(PIXEL_MAX) - x.cast("double")).otherwise(x.cast("double"))
         / PIXEL_MAX) - NORM_MEAN) / NORM_SD)


# ---------------------------------------------------------------- X16
def denormalize_clip(a: Column | str) -> Column:
    """Back to 0..255 grey values, clipped, as integers (truncation, like a
    cast to an unsigned byte)."""
    a = _c(a)
    return F.transform(a, lambda x: F.greatest(F.least(
        (x.cast("double") * NORM_SD + NORM_MEAN) * PIXEL_MAX, F.lit(PIXEL_MAX)), F.lit(0.0))
        .cast("int"))


# ---------------------------------------------------------------- X15
def reshape_array(a: Column | str, rows: int, cols: int) -> Column:
    """Flat array of rows*cols to an array of ``rows`` arrays of ``cols``;
    NULL when the length differs, so no value is cut or made up."""
    a = _c(a)
    return F.when(~bad_shape(a, rows * cols), F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)), lambda i: F.slice(a, i * cols + 1, cols)))


def bad_shape(a: Column | str, size: int) -> Column:
    """True when the array is missing or not of the expected length."""
    a = _c(a)
    return a.isNull() | (F.size(a) != size)
