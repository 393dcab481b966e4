"""URL filter: fixed host and path rules first, mined token combinations for the rest.

Only DataFrame functions and Spark's own FP-growth are used.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import settle

_CLASS = "class:block"


@dataclass(frozen=True)
class Rule:
    """Holds for ``host``, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str


def _behind_scheme(url: Column) -> Column:
    rest = F.expr("substring(__url, instr(__url, '://') + 3)")
    return F.when(F.contains(url, F.lit("://")), rest).otherwise("")


def parse(pages: DataFrame, url: str) -> DataFrame:
    """``pages`` with ``__host``, ``__path`` and ``__query``; all empty without ``://``."""
    rows = pages.withColumn("__url", F.coalesce(F.col(url), F.lit("")))
    rest = rows.withColumn("__rest", _behind_scheme(F.col("__url")))
    host = F.regexp_extract("__rest", "^[^/?#]*", 0)
    return rest.select(
        *[F.col(f"`{c}`") for c in pages.columns],
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase).alias("__host"),
        F.regexp_extract("__rest", "^[^/?#]*([^?#]*)", 1).alias("__path"),
        F.regexp_extract("__rest", "^[^?#]*[?]([^#]*)", 1).alias("__query"),
    )


def _fits(rule: Rule) -> Column:
    host = (F.col("__host") == rule.host) | F.col("__host").endswith("." + rule.host)
    return host & F.col("__path").startswith(rule.path)


def by_rule(rules: Sequence[Rule], value) -> Column:
    """``value(rule)`` of the longest rule that fits, NULL if none does."""
    longest = sorted(rules, key=lambda r: -len(r.host + r.path))
    return F.coalesce(*[F.when(_fits(r), F.lit(value(r))) for r in longest], F.lit(None).cast("string"))


def _tokens() -> Column:
    """Distinct tokens of a URL: the site, host labels, path segments and query keys.

    Digits are replaced, so that pages with numbers in their names share tokens.
    """
    def named(kind: str, parts: Column) -> Column:
        full = F.filter(parts, lambda p: p != "")
        return F.transform(full, lambda p: F.concat(F.lit(kind), F.regexp_replace(p, "[0-9]+", "#")))

    keys = F.transform(F.split("__query", "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_sort(
        F.array_distinct(
            F.concat(
                named("site:", F.array("__host")),
                named("host:", F.split("__host", "[.]")),
                named("path:", F.split("__path", "/")),
                named("query:", keys),
            )
        )
    )


def mine(
    labelled: DataFrame, min_support: float, min_confidence: float, min_count: int
) -> tuple[DataFrame, DataFrame]:
    """Rules ``antecedent``, ``support``, ``confidence`` and ``anchor`` for blocking.

    ``labelled`` has ``__tokens`` and ``bad``. A rule says that URLs with all tokens of its
    antecedent are bad; it is kept if its support and confidence reach the limits and the
    antecedent occurs ``min_count`` times. ``anchor`` is the antecedent's rarest token.

    All tokens take part that are frequent enough among bad URLs; others are in no rule.
    Tokens that occur in just the same labelled URLs are one item, since rules with any of
    them hold equally; its rules fit URLs with any of them. So supports and
    confidences are those of the whole sets of tokens.

    A token that is a rule by itself blocks whatever else stands with it, so combinations with
    it decide nothing more: these rules come from the counts of single tokens, and only the
    others are combined. That leaves few tokens of a spam URL with many keys. Where no token of
    a URL is a rule alone, its n frequent items can still make 2^n combinations.
    """
    spark = labelled.sparkSession
    schema = "antecedent array<string>, support double, confidence double, anchor string"
    labelled = settle(labelled.select("__tokens", "bad"), "labelled")
    n, bad_n = labelled.agg(F.count("*"), F.count_if("bad")).first()
    if n < min_count:
        return spark.createDataFrame([], schema), spark.createDataFrame([], "token string, item string")
    floor = max(min_support, min_count / n)
    sets = labelled.groupBy("__tokens", "bad").agg(F.count("*").alias("times"))
    tokens = sets.select("bad", "times", F.xxhash64("__tokens", "bad").alias("set"), F.explode("__tokens").alias("token"))
    # Two 64-bit sums over the sets that have a token tell whether tokens have the same ones.
    common = (
        tokens.groupBy("token").agg(
            F.sum("times").alias("n"),
            F.sum(F.when(F.col("bad"), F.col("times"))).alias("bad_n"),
            F.bit_xor("set").alias("one"), F.bit_xor(F.xxhash64(F.lit("two"), "set")).alias("two"),
        )
        .filter(F.col("bad_n") >= F.lit(floor * n * (1 - 1e-9)))
        .withColumn("item", F.min("token").over(Window.partitionBy("n", "bad_n", "one", "two")))
    )
    share = F.col("bad_n") / F.col("n")
    alone = (share >= min_confidence) & (share > bad_n / n)
    common = settle(
        common.select("token", "n", "item", (F.col("bad_n") / n).alias("support"), share.alias("confidence"), alone.alias("alone")),
        "tokens",
    )
    single = common.filter("alone").select(
        F.array("item").alias("antecedent"), "support", "confidence", F.col("item").alias("anchor")
    ).distinct()
    rest = common.filter("not alone").select("token", "item")
    kept = (
        sets.select("__tokens", "bad", "times", F.explode("__tokens").alias("token")).join(rest, "token")
        .groupBy("__tokens", "bad", "times").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    # URLs without such a token count in the shares too.
    kept = sets.join(kept.select("__tokens", "bad", "items"), ["__tokens", "bad"], "left").withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))
    )
    marked = F.when(F.col("bad"), F.array_append("items", F.lit(_CLASS))).otherwise(F.col("items"))
    copies = F.explode(F.array_repeat(F.lit(1), F.col("times").cast("int")))
    items = kept.select(marked.alias("items"), copies).select("items")
    # FP-growth reads its input several times and takes supports as shares of it.
    model = FPGrowth(itemsCol="items", minSupport=floor, minConfidence=min_confidence).fit(settle(items, "items"))
    rules = model.associationRules.filter(
        (F.col("consequent")[0] == _CLASS) & (F.col("lift") > 1)
    ).select("antecedent", "support", "confidence")
    rarest = (
        rules.select("*", F.explode("antecedent").alias("token")).join(common.select("token", "n"), "token")
        .groupBy("antecedent", "support", "confidence").agg(F.min_by("token", F.struct("n", "token")).alias("anchor"))
    )
    return settle(single.unionByName(rarest), "rules"), common.select("token", "item")


def match(sets: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The best rule of every set of tokens that has one, by an inverted index on anchors.

    A set meets a rule only if it has the rule's rarest item; then the other items are
    looked up in the set. ``items`` names the item of each token.
    """
    named = (
        sets.select("__tokens", F.explode("__tokens").alias("token")).join(items, "token")
        .groupBy("__tokens").agg(F.collect_set("item").alias("held"))
    )
    met = named.select("__tokens", "held", F.explode("held").alias("anchor")).join(rules, "anchor")
    whole = met.filter(F.size(F.array_except("antecedent", "held")) == 0)
    best = F.max(F.struct("confidence", "support", F.array_sort("antecedent").alias("antecedent")))
    return whole.groupBy("__tokens").agg(best.alias("best"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    key: str = "page_id",
    url: str = "url",
    min_support: float = 0.001,
    min_confidence: float = 0.5,
    min_count: int = 20,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``mined`` and ``confidence`` of every page.

    ``labels`` has ``key`` and a boolean ``bad``. The longest fixed rule that fits decides;
    a URL without one is blocked if a mined rule fits, and allowed otherwise. ``mined`` has
    the tokens of the most confident mined rule, the first of those that always occur together;
    it is NULL if none fits.

    A NULL URL or one without ``://`` has an empty host and path, no tokens, and is allowed.
    Repeated pages are judged alike and count as often as they occur in mining; a key with
    several labels is bad if one of them says so. Rows without a key are judged and teach
    nothing. Without labels nothing is mined; an empty table gives an empty result.
    """
    parsed = parse(pages.select(F.col(key).alias("__page"), F.col(url).alias("__raw")), "__raw").select(
        "__page", "__host", "__path", _tokens().alias("__tokens")
    )
    known = labels.filter("bad is not null").groupBy(key).agg(F.max("bad").alias("bad"))
    labelled = parsed.join(known.withColumnRenamed(key, "__page"), "__page")
    mined, items = mine(labelled, min_support, min_confidence, min_count)
    sets = parsed.select("__tokens").distinct()
    found = settle(match(sets, mined, items), "matches")
    judged = parsed.join(found, "__tokens", "left")
    fits = F.col("best").isNotNull()
    return judged.select(
        F.col("__page").alias(key),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        by_rule(rules, lambda r: r.host + r.path).alias("rule"),
        F.coalesce(
            by_rule(rules, lambda r: r.verdict), F.when(fits, "block").otherwise("allow")
        ).alias("verdict"),
        F.array_join("best.antecedent", " ").alias("mined"),
        F.col("best.confidence").alias("confidence"),
    )
