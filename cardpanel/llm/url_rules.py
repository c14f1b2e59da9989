"""URL filtering by given rules and mined association rules (DataFrame and SQL functions only).

Given rules (host, path, verdict) decide the URLs they fit; the longest wins.
Their verdicts label those URLs, Spark's FP-growth mines combinations of URL
tokens that go with a verdict, and the mined rules that pass the support and
confidence thresholds decide the other URLs.  Matching goes through an inverted
index: a rule is listed under its rarest token, URLs meet it through that token,
and the rule holds if all its tokens occur.  The rule of highest confidence, then
support, then smallest tokens wins; a URL that no rule fits gets ``DEFAULT``.

A URL has at most nine tokens, each in a slot of its own (scheme, three host
suffixes, first host label, two path segments, extension, query key), so a URL
supports at most 511 combinations and the number of frequent ones is at most
511 / support whatever the input: the mined rules are small enough to broadcast.
Runs of digits in a token read as ``#``.

Defined results: null URLs and URLs without ``://`` have empty host and path, no
tokens, no rule and the default verdict; repeated rows keep their rows; without
labelled URLs nothing is mined and the default holds; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored

# The given rules (verdict, host, path).
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
SUPPORT, CONFIDENCE, DEFAULT = 0.005, 0.6, "allow"
_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: str) -> Column:
    return F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substr(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))


def host_of(url: str = "url") -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UP, _LOW)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def longest_rule(rules: list[tuple[str, str, str]] = RULES) -> Column:
    """struct(verdict, rule) of the longest given rule that fits host and path, else null."""
    out = F.lit(None)
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(host + path).alias("rule"))).otherwise(out)
    return out


def tokens(url: str = "url") -> Column:
    """The URL's tokens, sorted: slot and value, runs of digits as ``#``."""
    label, segment = F.split(F.col("host"), r"\."), F.split(F.col("path"), "/")
    n = F.size(label)

    def of(slot: str, value: Column) -> Column:
        value = F.regexp_replace(value, "[0-9]+", "#")
        return F.when(F.length(value) > 0, F.concat(F.lit(slot + "="), value))

    def suffix(k: int) -> Column:
        return F.when(n >= k, F.concat_ws(".", F.slice(label, n - k + 1, k)))

    last = F.element_at(segment, -1)
    parts = [
        of("scheme", F.translate(F.regexp_extract(F.col(url), r"^([^:/?#]*)://", 1), _UP, _LOW)),
        *[of(f"host{k}", suffix(k)) for k in (1, 2, 3)],
        of("label", F.element_at(label, 1)),
        of("path1", F.get(segment, F.lit(1))),
        of("path2", F.get(segment, F.lit(2))),
        of("ext", F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1)),
        of("query", F.regexp_extract(F.col(url), r"\?([^=&#]+)", 1)),
    ]
    return F.when(F.col("host") != "", F.array_sort(F.array_distinct(F.array_compact(F.array(*parts))))).otherwise(
        F.array().cast("array<string>"))


def mined_rules(urls: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE) -> DataFrame:
    """tokens, verdict, confidence, support of the association rules in labelled
    ``urls`` (tokens, verdict) that pass both thresholds."""
    labelled = urls.filter("verdict is not null and size(tokens) > 0")
    if labelled.isEmpty():
        return urls.sparkSession.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    baskets = labelled.select(F.array_append("tokens", F.concat(F.lit("verdict="), "verdict")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    verdict = F.col("consequent")[0]
    return model.associationRules.filter(verdict.startswith("verdict=")).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(verdict, 9, 1000).alias("verdict"), "confidence", "support")


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The verdict of the best rule for each distinct token set that has one (tokens, verdict)."""
    # index: each rule under the token that the fewest rules share
    listed = rules.select(F.col("tokens").alias("needs"), "verdict", "confidence", "support", F.explode("tokens").alias("token"))
    common = listed.groupBy("token").agg(F.count("*").alias("n"))
    index = listed.join(F.broadcast(common), "token").groupBy("needs", "verdict", "confidence", "support").agg(
        F.min(F.struct("n", "token")).alias("_k")).select("needs", "verdict", "confidence", "support", F.col("_k.token").alias("token"))
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(F.broadcast(index), "token")
    met = met.filter(F.size(F.array_except("needs", "tokens")) == 0)
    return met.groupBy("tokens").agg(F.min(F.struct(-F.col("confidence"), -F.col("support"), "needs", "verdict")).alias("_b")).select(
        "tokens", F.col("_b.verdict").alias("mined"))


def judged(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, support: float = SUPPORT,
           confidence: float = CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict."""
    urls = pages.select("page_id", "url").withColumns({"host": F.coalesce(host_of(), F.lit("")), "path": F.coalesce(path_of(), F.lit(""))})
    urls = urls.withColumn("_r", longest_rule(rules)).withColumn("tokens", tokens())
    urls = stored(urls.select("page_id", "host", "path", F.col("_r.rule").alias("rule"), F.col("_r.verdict").alias("verdict"), "tokens"), "urls")
    found = mined_rules(urls, support, confidence)
    mined = matched(urls.filter("verdict is null").select("tokens").distinct(), found)
    return urls.join(mined, "tokens", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", "mined", F.lit(default)).alias("verdict"))
