"""URL filters: host and path rules, and mined association rules beyond them.

Fixed rules decide the URLs they fit (longest wins).  Their verdicts label
those URLs, and FP-growth mines the token combinations of the labelled URLs
for association rules whose consequent is a verdict, pruned by support and by
confidence over all URLs, with and without a label.  Two exact reductions keep
long repeated URLs from having 2**n itemsets.  Tokens that occur in the same
URLs are one item, named by the smallest.  A token that is surely one verdict
by itself is a rule, and no longer rule can hold it, so it is not mined again.  URLs without a fixed rule are matched through an inverted index:
each mined rule hangs on its rarest token, a URL's tokens look up candidates,
and a candidate fires if the URL has all of its tokens.  The surest rule
gives the verdict.  DataFrame functions and Spark's FP-growth throughout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, repeated

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
DEFAULT = "allow"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: Fixed values of the contract.
RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Empty for null and for text without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def fixed_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> tuple[Column, Column]:
    """(rule name, verdict) of the longest rule that fits, else nulls."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first, so that longer rules are tested before
    for r in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = (((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path))
        name = F.when(fits, F.lit(r.name)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels and endings, path words and file
    ending, query keys, fragment.  Numbers in paths carry no token."""
    url = F.coalesce(url, F.lit(""))
    tag = lambda kind, arr: F.transform(F.filter(arr, lambda x: x != ""),
                                        lambda x: F.concat(F.lit(kind), x))
    words = F.filter(F.split(F.lower(path), r"[/._\-]+"), lambda x: ~x.rlike("^[0-9]*$"))
    labels = F.split(host, r"\.")
    ending = F.array(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1))
    keys = F.transform(
        F.split(F.regexp_extract(url, r"(?s)\?([^#]*)", 1), "&"),
        lambda kv: F.regexp_extract(kv, r"(?s)^([^=]*)", 1))
    scheme = F.array(F.regexp_extract(F.lower(url), r"(?s)^([a-z][a-z0-9+.\-]*)://", 1))
    fragment = F.array(F.regexp_extract(url, r"(?s)#(.*)$", 1))
    return F.array_distinct(F.concat(
        tag("scheme:", scheme), tag("host:", labels), tag("site:", ending),
        tag("path:", words), tag("key:", keys), tag("frag:", fragment)))


def told_apart(sets: DataFrame) -> DataFrame:
    """Distinct ``sets`` (tokens) -> (tokens, items): the tokens that no
    smaller token stands for.  Tokens that occur in the same sets have equal
    counts and equal sums and exclusive-ors of the sets' hashes (128 bits)."""
    at = sets.select("tokens", F.explode("tokens").alias("token"),
                     F.xxhash64("tokens").alias("h"), F.xxhash64(F.lit(1), F.reverse("tokens")).alias("g"))
    mark = (at.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(20,0)")).alias("s"),
                                    F.bit_xor("g").alias("x")))
    names = mark.groupBy("n", "s", "x").agg(F.min("token").alias("name")).select("name")
    return (at.join(names, F.col("token") == F.col("name")).groupBy("tokens")
            .agg(F.sort_array(F.collect_list("token")).alias("items")))


def mine_rules(pages: DataFrame, min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pages`` (tokens, verdict or null) -> (rule_id, tokens, verdict,
    confidence, support, size).  Support is a share of the labelled rows.
    Confidence is over all rows: one without a verdict that holds the tokens
    counts against the rule, since the labels alone are what the fixed rules
    chose.  A rule goes if a shorter one with a subset of its tokens says the
    same at least as surely."""
    mark = "verdict:"
    # each distinct token set once, with its copies by verdict (a labelled row
    # has a host and so a token)
    sets = cut(pages.filter(F.size("tokens") > 0).groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("copies")))
    sets = cut(sets.join(told_apart(sets.select("tokens").distinct()).withColumnRenamed("tokens", "all"),
                         F.col("tokens") == F.col("all"))
               .select(F.col("items").alias("tokens"), "verdict", "copies"))
    n = sets.filter("verdict is not null").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    sure = (sets.select(F.explode("tokens").alias("token"), "verdict", "copies").groupBy("token")
            .agg(F.sum("copies").alias("hits"), F.min("verdict").alias("verdict"),
                 F.max("verdict").alias("other"), F.count_if(F.col("verdict").isNull()).alias("open"))
            .filter((F.col("open") == 0) & (F.col("other") == F.col("verdict"))
                    & (F.col("hits") >= F.lit(min_support * n))))
    sure = cut(sure.select("token", "verdict", "hits"))
    # what is left of a basket once its sure tokens are gone
    gone = (sets.select(F.col("tokens").alias("all"), F.explode("tokens").alias("token")).distinct()
            .join(sure.select("token"), "token").groupBy("all").agg(F.collect_set("token").alias("gone")))
    left = (sets.filter("verdict is not null").join(gone, F.col("tokens") == F.col("all"), "left")
            .select(F.array_append(F.array_except("tokens", F.coalesce("gone", F.array().cast("array<string>"))),
                                   F.concat(F.lit(mark), "verdict")).alias("items"), "copies"))
    baskets = cut(repeated(left, "copies", "copy").select("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    # sure over all rows implies sure over the labelled ones, so none is missed
    likely = (model.associationRules
              .filter(F.col("consequent")[0].startswith(mark))
              .select(F.sort_array("antecedent").alias("tokens"),
                      F.substring(F.col("consequent")[0], len(mark) + 1, 1 << 20).alias("verdict"),
                      F.round(F.col("support") * n).alias("hits"), "confidence")
              .withColumn("rows", F.round(F.col("hits") / F.col("confidence")))
              .unionByName(sure.select(F.array("token").alias("tokens"), "verdict",
                                       F.col("hits").cast("double").alias("hits"), F.lit(1.0).alias("confidence"),
                                       F.col("hits").cast("double").alias("rows")))
              .withColumn("support", F.round(F.col("hits") / F.lit(float(max(n, 1))), 9))
              .withColumn("size", F.size("tokens"))
              .withColumn("rule_id", F.xxhash64("tokens", "verdict")))
    likely = cut(likely)
    found = cut(likely.join(_unlabelled_uses(likely, sets), "rule_id", "left")
                .withColumn("confidence", F.col("hits") / (F.col("rows") + F.coalesce("unlabelled", F.lit(0))))
                .filter(F.col("confidence") >= min_confidence)
                .select("rule_id", "tokens", "verdict", F.round("confidence", 9).alias("confidence"),
                        "support", "size"))
    # one token less each time: the dropped-token sets that exist as rules
    sub = found.select(F.col("tokens").alias("less"), F.col("verdict").alias("says"),
                       F.col("confidence").alias("sure"))
    beaten = (found.filter("size > 1")
              .select("tokens", "verdict", "confidence", F.explode("tokens").alias("drop"))
              .withColumn("less", F.array_remove("tokens", F.col("drop")))
              .join(sub, "less").filter((F.col("says") == F.col("verdict"))
                                        & (F.col("sure") >= F.col("confidence")))
              .select("tokens", "verdict").distinct())
    return found.join(beaten, ["tokens", "verdict"], "left_anti")


def _unlabelled_uses(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """(rule_id, unlabelled): rows without a verdict that hold the rule's
    tokens.  Each distinct token set is matched once, with its copies."""
    sets = cut(sets.filter("verdict is null").groupBy("tokens").agg(F.sum("copies").alias("copies")))
    index = rule_index(rules, sets)
    return (sets.select("tokens", "copies", F.explode("tokens").alias("at")).join(index, "at")
            .filter(F.size(F.array_except("needs", "tokens")) == 0)
            .groupBy("rule_id").agg(F.sum("copies").alias("unlabelled")))


def rule_index(rules: DataFrame, sets: DataFrame) -> DataFrame:
    """Rules by the token that is rarest in ``sets``: (at, rule_id, needs,
    says, confidence, support, size)."""
    uses = (sets.select(F.explode("tokens").alias("token"))
            .groupBy("token").agg(F.count(F.lit(1)).alias("uses")))
    rare = (rules.select("rule_id", F.explode("tokens").alias("token")).join(uses, "token", "left")
            .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), "token"))
                                    .alias("r")))
    return cut(rules.join(rare, "rule_id")
               .select(F.col("r.token").alias("at"), "rule_id", F.col("tokens").alias("needs"),
                       F.col("verdict").alias("says"), "confidence", "support", "size"))


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, id_col: str = "page_id",
               url_col: str = "url", min_support: float = MIN_SUPPORT,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per input row: (page_id, host, path, rule, verdict, mined,
    confidence).

    ``mined`` lists the tokens of the association rule that decided, null
    where a fixed rule did or none fired (then the verdict is DEFAULT).  Ties
    go to the rule with more support, then fewer tokens, then the smallest
    tokens.  Null urls and urls without ``://`` have empty host and path and
    no tokens.  Repeated rows are judged alike; other columns are left behind.
    """
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    host, path = host_and_path(F.col("url"))
    parsed = src.select("page_id", "url", host.alias("host"), path.alias("path"))
    name, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page_id", "url", "host", "path", name.alias("rule"), verdict.alias("verdict"))
    tokens = url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens")
    # each distinct token set is matched once; copies of a url share it
    open_sets = (parsed.filter("verdict is null").select(tokens)
                 .withColumn("key", F.xxhash64("tokens")).groupBy("key", "tokens").agg(F.count(F.lit(1))))
    index = rule_index(mine_rules(parsed.select(tokens, "verdict"), min_support, min_confidence), open_sets)
    fired = (open_sets.select("key", "tokens", F.explode("tokens").alias("at")).join(index, "at")
             .filter(F.size(F.array_except("needs", "tokens")) == 0)
             .groupBy("key", "tokens")
             .agg(F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"),
                                 "size", "needs", "says")).alias("best")))
    fired = cut(fired.select(F.col("key").alias("fkey"), F.col("tokens").alias("ftokens"), "best"))
    decided = parsed.filter("verdict is not null").select(
        "page_id", "host", "path", "rule", "verdict", F.lit(None).cast("array<string>").alias("mined"),
        F.lit(None).cast("double").alias("confidence"))
    rest = (parsed.filter("verdict is null").select("page_id", "host", "path", "rule", tokens)
            .withColumn("key", F.xxhash64("tokens")))
    mined = (rest.join(fired, (F.col("key") == F.col("fkey")) & (F.col("tokens") == F.col("ftokens")), "left")
             .select("page_id", "host", "path", "rule",
                     F.coalesce("best.says", F.lit(DEFAULT)).alias("verdict"),
                     F.col("best.needs").alias("mined"), (-F.col("best.c")).alias("confidence")))
    return decided.unionByName(mined)
