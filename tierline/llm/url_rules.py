"""URL filters by association rules.

Labelled pages are transactions of URL tokens and their label; FP-growth
mines frequent token combinations, and rules with the consequent "block" are
kept if they reach the support and the confidence asked for and no part of
them does.  Single tokens that do are settled before combinations are mined,
without them.  Rules are indexed by their rarest token: a URL meets only the
rules of its own tokens and is blocked if it holds all tokens of one.

Fixed (host, path) rules come first: a rule fits its host and all subdomains
if the URL's path starts with the rule's; the longest that fits decides.

Edge cases: a null URL or one without ``://`` has an empty host and path, no
tokens, fits no rule and is allowed.  Labels that are null count as good; of
several labels of a page the worst counts.  Without labels nothing is mined.
All tokens of a URL count, however long it is.  Only the columns named are
looked at, and inside they have names of their own.  Equal rows give equal
rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.llm.common import ascii_lower
from tierline.sources.sinks import stage_table

# The rules of the query's contract, as (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
BLOCK = "label=block"
#: Share of the labelled pages that a rule's tokens and label must be on
#: together, and share of those with its tokens that must have its label.
SUPPORT = 0.001
CONFIDENCE = 0.6


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for judged, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(judged)).otherwise(verdict)
    return name, verdict


def all_tokens(url: Column) -> Column:
    """Distinct tokens of a URL: its host, all words of the host's labels but
    the top one, all directories of the path, the file's kind and all names in
    the query; no directories with numbers."""
    url = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kind = F.lower(F.regexp_extract(path, r"\.([A-Za-z]{1,5})$", 1))
    labels = F.split(host, r"\.")
    words = F.flatten(F.transform(F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(0))), lambda s: F.split(s, "-")))
    folders = F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0)))
    named = lambda prefix, values: F.transform(values, lambda v: F.concat(F.lit(prefix), v))
    parts = F.concat(
        named("host=", F.array(host)),
        named("word=", F.filter(words, lambda s: ~s.isin("", "www"))),
        named("dir=", F.filter(folders, lambda s: ~s.rlike("[0-9]"))),
        named("kind=", F.filter(F.array(kind), lambda s: s != "")),
        named("query=", F.filter(F.transform(F.split(query, "&"), lambda q: F.split(q, "=")[0]), lambda s: s != "")),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(parts))


RULE_SCHEMA = "rule_tokens array<string>, members array<array<string>>, rarest array<string>, confidence double, support double"


def mine(
    urls: DataFrame,
    labels: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
) -> DataFrame:
    """``urls`` (id, url), ``labels`` (id, bad) -> minimal rules (rule_tokens,
    members, rarest, confidence, support): combinations that reach both
    bounds, and no part of which does.  A URL that holds a combination holds
    its parts, so the others would block nothing more.

    ``members`` has, for each of ``rule_tokens``, the tokens that stand for it,
    one of which a URL must have: tokens on exactly the same labelled pages
    are one item, named by the first.  ``rarest`` are those of the rarest.
    """
    spark = urls.sparkSession
    worst = labels.where("id is not null").groupBy("id").agg(F.max(F.coalesce("bad", F.lit(False))).alias("bad"))
    baskets = urls.join(worst, "id").select(all_tokens(F.col("url")).alias("own"), "bad").where(F.size("own") > 0)
    baskets = stage_table(baskets.withColumn("basket", F.expr("uuid()")), "baskets")
    if not baskets.where("bad").take(1):
        return spark.createDataFrame([], RULE_SCHEMA)
    total = baskets.count()
    # Tokens on the same baskets by two sums of hashes; those on too few
    # blocked ones are in no rule.
    digest = lambda seed: F.sum(F.xxhash64("basket", F.lit(seed)).cast("decimal(38,0)"))
    single = (
        baskets.select("basket", "bad", F.explode("own").alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("freq"), F.count_if("bad").alias("blocked"), digest(1).alias("d1"), digest(2).alias("d2"))
        .where(F.col("blocked") >= support * total)
    )
    same = Window.partitionBy("freq", "blocked", "d1", "d2")
    single = stage_table(single.select("token", "freq", "blocked", F.min("token").over(same).alias("item")), "tokens")

    # One token is enough: these are rules, one per token, and no other rule
    # needs them, so they take no part in the mining of combinations.  Without
    # them, common tokens of bad pages do not multiply.
    does = F.col("blocked") >= confidence * F.col("freq")
    alone = F.array("token")
    rules = single.where(does).select(
        alone.alias("rule_tokens"),
        F.array(alone).alias("members"),
        alone.alias("rarest"),
        (F.col("blocked") / F.col("freq")).alias("confidence"),
        (F.col("blocked") / total).alias("support"),
    )
    others = single.where(~does)
    items = (
        baskets.select("basket", "bad", F.explode("own").alias("token"))
        .join(others.where("token = item").select("token"), "token")
        .groupBy("basket", "bad")
        .agg(F.collect_list("token").alias("own"))
    )
    marked = F.when(F.col("bad"), F.array_append("own", F.lit(BLOCK))).otherwise(F.col("own"))
    items = stage_table(items.select(marked.alias("items")), "items")
    mined = items.count()
    if not mined:
        return stage_table(rules, "rules")
    # The share is of all labelled pages, those without an item included.
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support * total / mined), minConfidence=confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0] == BLOCK).select(
        F.array_sort("antecedent").alias("rule_tokens"), "confidence", (F.col("support") * mined / total).alias("support")
    )
    kept = _minimal(stage_table(found, "rules"))
    members = others.groupBy("item").agg(F.sort_array(F.collect_list("token")).alias("members"), F.min("freq").alias("freq"))
    combined = (
        kept.select("rule_tokens", "confidence", "support", F.explode("rule_tokens").alias("item"))
        .join(members, "item")
        .groupBy("rule_tokens", "confidence", "support")
        .agg(F.sort_array(F.collect_list(F.struct("item", "members"))).alias("m"), F.min(F.struct("freq", "members"))["members"].alias("rarest"))
        .select("rule_tokens", F.col("m")["members"].alias("members"), "rarest", "confidence", "support")
    )
    return stage_table(rules.unionByName(combined), "rules")


def _minimal(found: DataFrame) -> DataFrame:
    """Rules no proper part of which is a rule: sizes are settled in turn, each
    against the smaller ones left, which are looked up by their first token."""
    sizes = sorted(r[0] for r in found.select(F.size("rule_tokens")).distinct().collect())
    kept = found.where(F.lit(False))
    for size in sizes:
        now = found.where(F.size("rule_tokens") == size)
        if size > sizes[0]:
            parts = kept.select(F.col("rule_tokens").alias("part"), F.col("rule_tokens")[0].alias("token"))
            needless = (
                now.select("rule_tokens", F.explode("rule_tokens").alias("token"))
                .join(parts, "token")
                .where(F.size(F.array_except("part", "rule_tokens")) == 0)
                .select("rule_tokens")
                .distinct()
            )
            now = now.join(needless, "rule_tokens", "left_anti")
        kept = stage_table(kept.unionByName(now), "minimal")
    return kept


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    fixed: Sequence[tuple[str, str, str]] = RULES,
) -> DataFrame:
    """(id_col, host, path, rule, verdict, mined) for every row; ``mined``
    tells whether a mined rule fits the URL."""
    own = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    # Rules without members stand for their tokens alone.
    alone = F.transform("rule_tokens", lambda t: F.array(t))
    index = rules.select((F.col("members") if "members" in rules.columns else alone).alias("members"), F.col("rarest"))
    if index.schema["rarest"].dataType.typeName() == "string":
        index = index.withColumn("rarest", F.array("rarest"))
    matched = (
        own.select("url")
        .where("url is not null")
        .distinct()
        .withColumn("own", all_tokens(F.col("url")))
        .select("url", "own", F.explode("own").alias("token"))
        .join(index.select("members", F.explode("rarest").alias("token")), "token")
        .where(F.forall("members", lambda m: F.arrays_overlap(m, F.col("own"))))
        .select(F.col("url").alias("matched"))
        .distinct()
    )
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), fixed)
    mined = F.col("matched").isNotNull()
    return (
        own.join(matched, F.col("url") == F.col("matched"), "left")
        .select("id", host.alias("host"), path.alias("path"), mined.alias("mined"))
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(verdict, F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            "mined",
        )
    )
