"""URL filtering by listed and by mined association rules (operator 9).

Every step is a DataFrame expression or Spark's own FP-growth.  A url is split
into host and path.  Listed rules are held in a map from rule host to its
rules; a url looks up the suffixes of its host, keeps the rules whose path
begins its own and takes the longest.

FP-growth mines, from labelled urls (those that a listed rule decides, by its
verdict, and a given table of further urls with verdicts), the
combinations of url tokens (host suffixes, path segments, query keys) that go
with a verdict; association rules are pruned by support, by confidence, and
where a part of the same tokens says the same as surely.  An inverted index
from token to rule finds the mined rules of each distinct set of tokens: a rule
fires when all its tokens are met.  The surest one gives the verdict of a url
without listed rule; without any, the default is given.

Defined results: a null url or one without ``://`` has an empty host and path,
fits no rule and gets the method's verdict; rows alike are judged alike; a null
id is kept; with no labelled url, or an empty table, no rule is mined; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm import common

#: (rule, verdict); a rule is a host and a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
MIN_SUPPORT, MIN_CONFIDENCE = 0.01, 0.8
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _query_keys(url: Column) -> Column:
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    return F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    parts = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(parts)),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest listed rule that fits, as struct(length, rule, verdict), or null."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for rule, verdict in rules:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append((slash + rest, rule, verdict))
    if not by_host:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    kind = F.struct
    entries = []
    for name, listed in by_host.items():
        entries += [F.lit(name), F.array(*[kind(F.lit(p).alias("path"), F.lit(r).alias("rule"),
                                                F.lit(v).alias("verdict")) for p, r, v in listed])]
    known = F.create_map(*entries)
    found = F.flatten(F.filter(F.transform(suffixes(host), lambda s: F.try_element_at(known, s)),
                               lambda x: x.isNotNull()))
    fits = F.filter(found, lambda x: F.startswith(path, x["path"]))
    return F.array_max(F.transform(fits, lambda x: kind(F.length(x["rule"]).alias("length"),
                                                        x["rule"].alias("rule"), x["verdict"].alias("verdict"))))


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a url: host suffixes, path segments and query keys; numbers are one token."""
    hosts = F.transform(suffixes(host), lambda s: F.concat(F.lit("host:"), s))
    parts = F.transform(F.split(path, "/"), lambda s: F.concat(F.lit("path:"), F.regexp_replace(s, r"\d+", "0")))
    return F.array_sort(F.array_distinct(F.filter(
        F.concat(hosts, parts, _query_keys(url)), lambda t: ~t.isin("host:", "path:", "query:"))))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT,
         min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``labelled(tokens, verdict)`` to rules (antecedent, verdict, confidence, support)."""
    items = F.concat("tokens", F.array(F.concat(F.lit("verdict:"), F.col("verdict"))))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(
        labelled.select(items.alias("items")))
    mined = common.stored(
        model.associationRules.filter(F.startswith(F.col("consequent")[0], F.lit("verdict:")))
        .select(F.array_sort("antecedent").alias("antecedent"),
                F.substring(F.col("consequent")[0], 9, 1000).alias("verdict"), "confidence", "support"),
        "url-rules")
    # A rule goes if a shorter one within it is as sure of the same verdict.
    short = mined.select(F.col("antecedent").alias("part"), F.col("verdict").alias("same"),
                         F.col("confidence").alias("sure"), F.col("antecedent")[0].alias("first"))
    long = mined.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("first"))
    spare = (long.join(short, "first").filter((F.col("verdict") == F.col("same"))
                                              & (F.size("part") < F.size("antecedent"))
                                              & (F.size(F.array_except("part", "antecedent")) == 0)
                                              & (F.col("sure") >= F.col("confidence")))
             .select("antecedent", "verdict").distinct())
    return common.stored(mined.join(spare, ["antecedent", "verdict"], "left_anti"), "url-pruned")


def judge(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct token sets to (tokens, mined verdict) through an inverted index."""
    numbered = rules.withColumn("n", F.size("antecedent")).withColumn(
        "rank", F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "antecedent", "verdict"))
    index = numbered.select("n", "rank", F.explode("antecedent").alias("token"))
    met = (sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
           .groupBy("tokens", "rank", "n").agg(F.count(F.lit(1)).alias("met")).filter("met = n"))
    return met.groupBy("tokens").agg(F.min("rank").alias("best")).select("tokens", F.col("best.verdict").alias("mined"))


def _parts(urls: DataFrame) -> DataFrame:
    rows = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    return rows.withColumn("tokens", tokens(F.col("url"), F.col("host"), F.col("path")))


def filter_urls(pages: DataFrame, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
                rules: Sequence[tuple[str, str]] = RULES, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.  ``labelled`` has
    the columns url and verdict (block or allow); of its rows those count that
    no listed rule fits, since the rule's verdict is the label of such a url."""
    rows = _parts(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")))
    rows = rows.withColumn("listed", fitting_rule(F.col("host"), F.col("path"), rules))
    rows = common.stored(rows.select("page_id", "host", "path", "tokens", F.col("listed.rule").alias("rule"),
                                     F.col("listed.verdict").alias("verdict")), "url-rows")
    known = rows.filter("rule is not null").select("tokens", "verdict")
    if labelled is not None:
        further = _parts(labelled.select(F.col("url").cast("string").alias("url"), "verdict"))
        known = known.unionByName(further.filter(fitting_rule(F.col("host"), F.col("path"), rules).isNull())
                                  .select("tokens", "verdict"))
    known = common.stored(known.filter("verdict is not null"), "url-labelled")
    if known.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    mined = judge(rows.filter("rule is null").select("tokens").distinct(), mine(known, min_support, min_confidence))
    return (rows.join(common.stored(mined, "url-judged"), "tokens", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", "mined", F.lit(default)).alias("verdict")))
