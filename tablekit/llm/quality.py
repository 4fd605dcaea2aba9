"""Quality rules: a table of thresholds compiled into one Spark projection.

Everything is an expression of the text column; there is no shuffle, no user
function and no second pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the contract: spaces between words, symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

#: Frequent short words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for was on are as with be by this from or an have not he they "
    "de la le et les des en un une du que qui est pour dans par sur au plus ne se il elle "
    "der die und das den von zu mit ist im ein eine nicht auch sich dem für auf "
    "el los las y del se por con no su para al lo como más pero").split()


@dataclass(frozen=True)
class Rule:
    """A document fails where ``low <= measure <= high`` does not hold."""

    measure: str
    low: float | None = None
    high: float | None = None


#: The threshold table (ratios of 0..1 unless a mean).
RULES = (
    Rule("mean_word_length", 2.0, 12.0),
    Rule("symbol_ratio", high=0.1),
    Rule("shout_ratio", high=0.1),
    Rule("stop_word_ratio", low=0.03),
    Rule("dup_line_ratio", high=0.5),
    Rule("short_line_ratio", high=0.9),
    Rule("letter_word_ratio", low=0.7),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def split_words(text: Column) -> Column:
    """Words between the contract's spaces; none for a blank text."""
    bare = F.trim(text, F.lit(SPACES))
    return F.when(bare != "", F.split(bare, "[ \\x09-\\x0D]+")).otherwise(
        F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows found twice or more (first included).

    The windows are sorted with their places, so equal windows lie side by
    side; only the two neighbours are compared and the sum over the sorted
    places of min(3, distance to the next) is the covered length."""
    later = lambda k: F.slice(words, F.lit(k), F.greatest(F.size(words), F.lit(1)))
    windows = F.array_compact(F.zip_with(
        F.zip_with(words, later(2), lambda a, b: F.concat(a, F.lit(" "), b)),
        later(3), lambda ab, c: F.concat(ab, F.lit(" "), c)))
    none = F.array(F.lit(None).cast("struct<w:string,i:int>"))

    def covered(placed: Column) -> Column:
        beside = F.arrays_zip(
            placed.alias("x"), F.concat(none, placed).alias("before"),
            F.slice(F.concat(placed, none), F.lit(2), F.size(placed)).alias("after"))
        same = F.filter(beside, lambda r: (r["x"]["w"] == r["before"]["w"])
                        | (r["x"]["w"] == r["after"]["w"]))
        return F.aggregate(
            F.array_sort(F.transform(same, lambda r: r["x"]["i"])),
            F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"),
                                    p.alias("last")))["n"]

    def count(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(w)) < F.size(w), _let(placed, covered)).otherwise(F.lit(0))
    return _let(windows, count)


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (doc_id, counts and ratios of ``RULES``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    base = src.select(
        "doc_id", split_words(text).alias("words"), lines.alias("lines"),
        F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))).alias("n_bangs"))
    base = base.select("*", F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                       F.size("words").alias("n"), F.size("lines").alias("n_lines"),
                       (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup"))
    stop = [*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)]
    n, n_lines = F.col("n"), F.col("n_lines")
    return base.select(
        "doc_id", n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("n_dup").cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        _ratio(F.col("word_chars"), n).alias("mean_word_length"),
        _ratio(F.col("n_symbols"), n).alias("symbol_ratio"),
        _ratio(F.col("n_bangs"), n).alias("shout_ratio"),
        _ratio(F.size(F.filter("words", lambda w: w.isin(stop))), n).alias("stop_word_ratio"),
        _ratio(F.col("n_dup"), n_lines).alias("dup_line_ratio"),
        _ratio(F.size(F.filter("lines", lambda x: F.length(x) < 25)), n_lines).alias("short_line_ratio"),
        _ratio(F.size(F.filter("words", lambda w: w.rlike("\\p{L}"))), n).alias("letter_word_ratio"))


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, min_words: int = 50,
            max_repeat: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures plus (base_failed, failed, kept).

    ``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat`` of the words repeated.  ``failed`` names the rules of the
    table that do not hold.  Null and empty texts have no words and fail the
    base.  One row per input row; other columns are left behind.
    """
    m = measures(docs, id_col, text_col)
    out = []
    for r in rules:
        ok = F.lit(True)
        if r.low is not None:
            ok = ok & (F.col(r.measure) >= r.low)
        if r.high is not None:
            ok = ok & (F.col(r.measure) <= r.high)
        out.append(F.when(~ok, F.lit(r.measure)))
    base = ((F.col("n_words") < min_words)
            | (100 * F.col("n_repeat_words") > round(100 * max_repeat) * F.col("n_words")))
    failed = F.array_compact(F.array(*out)) if out else F.array().cast("array<string>")
    return (m.withColumn("base_failed", base).withColumn("failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)))
