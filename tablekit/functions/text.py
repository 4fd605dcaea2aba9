"""Text and link column functions (X4-X12, X19, X20), all JVM-side expressions.

Repeated groups with alternatives are possessive throughout: the regex engine
then runs them as loops, while a group that may give characters back is one
stack frame a repetition and ends the JVM on long input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's str.split() / str.strip() treat as
# white space, as one regex class (same syntax in Java regex and RE2).
WS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


# ---------------------------------------------------------------- X6
def strip_ws(c: Column | str) -> Column:
    """Strip all surrounding white space (``str.strip()``); Spark's ``trim``
    only cuts blanks."""
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")


def starts_with(c: Column | str, prefix: str) -> Column:
    return _c(c).startswith(prefix)


# ---------------------------------------------------------------- X5 / F4
def case_fold_suffix(c: Column | str, suffixes: tuple[str, ...]) -> Column:
    """lower(c) ends with one of ``suffixes``."""
    low = F.lower(_c(c))
    out = F.lit(False)
    for s in suffixes:
        out = out | low.endswith(s.lower())
    return out


# ---------------------------------------------------------------- X7 / G24
def tokenize_ws(c: Column | str) -> Column:
    """Tokens of ``str.split()``: runs of white space separate, no empties."""
    return F.filter(F.split(_c(c), WS + "+"), lambda t: t != "")


NON_WS_RUN = "[^" + WS[1:-1] + "]+"


def word_count(c: Column | str) -> Column:
    """len(str.split()): the number of non-white-space runs, counted by the
    regex engine without building the token array."""
    return F.regexp_count(_c(c), F.lit(NON_WS_RUN)).cast("int")


# ---------------------------------------------------------------- X4 / X12
def url_to_file_name(c: Column | str, folder: str) -> Column:
    """Drop ``https://``, then ``http://``, wherever they stand (an archive's
    URL holds a second one), turn ``/`` into ``_``, put in ``folder`` with
    .html."""
    bare = F.replace(F.replace(_c(c), F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))
    name = F.translate(bare, "/", "_")
    return F.concat(F.lit(folder.rstrip("/") + "/"), name, F.lit(".html"))


def base_name(c: Column | str) -> Column:
    return F.element_at(F.split(_c(c), "/"), -1)


def parent_name(c: Column | str) -> Column:
    return F.element_at(F.split(_c(c), "/"), -2)


def derive_path(base: str, label: Column | str, path: Column | str) -> Column:
    """``base/label/<file name of path>``."""
    return F.concat_ws("/", F.lit(base.rstrip("/")), _c(label), base_name(path))


# ---------------------------------------------------------------- X8
def percent_encode(c: Column | str) -> Column:
    """Encode text as a URL query value like Python's ``quote`` (UTF-8, blank
    to %20, ``/`` and ``~`` kept, ``*`` encoded)."""
    e = F.url_encode(_c(c))
    for a, b in (("+", "%20"), ("%2F", "/"), ("%7E", "~"), ("*", "%2A")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


# ---------------------------------------------------------------- X9
def base64_text(c: Column | str) -> Column:
    """UTF-8 bytes of text as one-line base64 text, whatever the session's
    ``spark.sql.chunkBase64String.enabled`` (chunked output has line breaks,
    which are not part of the encoding and are removed)."""
    return F.regexp_replace(F.base64(F.encode(_c(c), "UTF-8")), r"[\r\n]", "")


# ---------------------------------------------------------------- X10 / X11
def join_list(c: Column | str, sep: str = ",") -> Column:
    return F.array_join(_c(c), sep)


# One attribute: a name, and perhaps a quoted or bare value.  A quote that is
# never closed runs to the end of the page, as in a browser.
_VALUE = r"""(?:"[^"]*+(?:"|\z)|'[^']*+(?:'|\z)|[^\s>"'][^\s>]*+|(?=[\s>]|\z))"""
_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+" + _VALUE + ")?+"
_TAG_BODY = r"(?:[\s/]++|" + _ATTRIBUTE + ")*+"
_TAG_REST = _TAG_BODY + r"(?:>|\z)"


def tag_pattern(tag: str) -> str:
    """Regex that walks a page in one pass, each match starting where the last
    one ended or later; group 2 is a whole ``tag`` start tag, empty for what
    else is stepped over (comments, script and style blocks, other tags, and
    one that the page's end cuts off)."""
    return (r"(?is)<!--(?:-?+>|.*?(?:-->|\z))"
            r"|<(script|style)(?=[\s/>]|\z)" + _TAG_REST + r"(?:.*?</\1(?=[\s/>])[^>]*+>?+|.*+\z)"
            r"|(<" + tag + r"(?=[\s/>])" + _TAG_BODY + ">)"
            r"|<[a-z][^\s/>]*+" + _TAG_REST + r"|<[!?/][^>]*+>?+")


def extract_links(html: Column | str, tag: str = "img", attr: str = "src") -> Column:
    """All non-empty ``attr`` values of ``tag`` elements, in page order.

    The page is read like a parser reads it: comments, script and style bodies
    hold no tags, a ``>`` inside quotes ends none, ``data-src`` is not ``src``,
    and of a repeated attribute the last counts.  Linear in the page's length.
    ``&lt; &gt; &quot; &#39; &apos; &amp;`` are decoded.  Null pages give null.
    """
    tags = F.filter(F.regexp_extract_all(_c(html), F.lit(tag_pattern(tag)), 2), lambda t: t != "")
    last = r"(?is)^(?:" + attr + r")\s*+(?:=\s*+(?:\"([^\"]*+)\"?+|'([^']*+)'?+|([^\s>]*+)))?+"

    def value(t):
        names = F.filter(F.regexp_extract_all(F.substring(t, len(tag) + 2, 1 << 30), F.lit(_ATTRIBUTE), F.lit(0)),
                         lambda a: a.rlike(r"(?i)^" + attr + r"(?:[\s=]|\z)"))
        got = F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit(""))
        return F.concat(*(F.regexp_extract(got, last, k) for k in (1, 2, 3)))
    return F.filter(F.transform(tags, lambda t: _decoded(value(t))), lambda v: v != "")


def _decoded(v: Column) -> Column:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        v = F.replace(v, F.lit(a), F.lit(b))
    return v


# ---------------------------------------------------------------- X19
# Entity rules, in priority order (first alternative wins).  An
# address starts where a run of its characters does or the last entity ended,
# and has at most 128 labels (DNS allows 127).
ENTITY_RULES = [
    ("EMAIL", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@"
              r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,126}\.[A-Za-z]{2,}"),
    ("MONEY", r"[$€£][0-9]+(?:[.,][0-9]+)?"),
    ("DATE", r"[0-9]{4}-[0-9]{2}-[0-9]{2}"),
    ("NUMBER", r"[0-9]+(?:\.[0-9]+)?"),
    ("PROPER", r"[A-Z][a-z]++(?: [A-Z][a-z]++)++"),
]
ENTITY_PATTERN = "|".join(f"({p})" for _, p in ENTITY_RULES)
_LABELS = [name for name, _ in ENTITY_RULES]
_BLOCK = 256


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_total(values: Column) -> Column:
    """For each number of an array the sum of those before it: within blocks
    of ``_BLOCK``, and over the blocks' totals."""
    def add(part):
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def before(part, i):
        return add(F.slice(part, 1, i))

    def within(block, start):
        return _let(block, lambda x: F.transform(x, lambda _, i: start + before(x, i)))

    def joined(blocks):
        return _let(F.transform(blocks, add), lambda t: F.flatten(F.transform(
            blocks, lambda block, k: within(block, before(t, k)))))
    n = F.greatest(F.size(values), F.lit(1))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / _BLOCK).cast("int")),
                         lambda k: F.slice(values, k * _BLOCK + 1, _BLOCK))
    return _let(blocks, joined)


def _label(text: Column) -> Column:
    """The rule that matched: their matches differ in these characters."""
    return (F.when(text.contains("@"), "EMAIL").when(text.rlike("^[$€£]"), "MONEY")
            .when(text.contains("-"), "DATE").when(text.rlike("^[0-9]"), "NUMBER").otherwise("PROPER"))


def entities(c: Column | str) -> Column:
    """Array of struct(text, label, start, end) by pattern rules; ``start`` is
    0-based, ``end`` exclusive (code points).  An entity starts after all text
    between entities and all entities before it, so the offsets are running
    totals over the text split at the entities.  Null text gives null."""
    found = F.regexp_extract_all(_c(c), F.lit(ENTITY_PATTERN), F.lit(0))
    gaps = F.transform(F.split(_c(c), ENTITY_PATTERN), F.length)

    def built(x):
        size = F.transform(x["found"], F.length)
        # gap 0, entity 0, gap 1, entity 1, ...: totals before each entity
        steps = F.transform(size, lambda n, i: F.get(x["gaps"], i + 1) + n)
        return _let(running_total(steps), lambda at: F.transform(x["found"], lambda t, i: F.struct(
            t.alias("text"), _label(t).alias("label"), (F.get(x["gaps"], F.lit(0)) + F.get(at, i)).alias("start"),
            (F.get(x["gaps"], F.lit(0)) + F.get(at, i) + F.length(t)).alias("end"))))
    return F.when(_c(c).isNotNull(), _let(F.struct(found.alias("found"), gaps.alias("gaps")), built))


def entity_count_by_rule(c: Column | str, label: str) -> Column:
    """Count of matches of one rule inside the combined scan."""
    idx = _LABELS.index(label) + 1
    return F.size(F.filter(F.regexp_extract_all(_c(c), F.lit(ENTITY_PATTERN), idx),
                           lambda v: v != ""))


# ---------------------------------------------------------------- X20
def status_subject(status: Column | str, name: Column | str) -> Column:
    """``[STATUS] name``."""
    return F.concat(F.lit("["), F.upper(_c(status)), F.lit("] "), _c(name))
