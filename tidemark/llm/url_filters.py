"""Operator 9: URL filters by association rules, with DataFrame operations only.

Hand-written rules decide first. For the rest, URLs of labelled pages become sets of tokens, FP-growth mines the
combinations that come with a bad label, and those of enough support and confidence become block rules. They are
matched by an inverted index: each rule is filed under its rarest token, URLs look up their tokens there, and
only then is the whole combination compared.

Defined results: a null URL, or one without ``://``, has an empty host and path, no tokens and no rule: allowed.
Repeated rows each keep their row and count as often as they occur. Without labels nothing is mined. An empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

#: (host, path, verdict)
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)
MIN_SUPPORT = 0.002
#: A combination seen on fewer labelled pages than this is chance.
MIN_PAGES = 10
MIN_CONFIDENCE = 0.8
BAD = "label=bad"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, null if none does."""
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for h, p, v in rules]
    return F.array_max(F.array_compact(F.array(*fits))) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """The URL as a set: scheme, host and each of its parents, path segments with and without their place, extension, parameters with and without their value."""
    labels = F.split(host, r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    segments = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), lambda s: F.regexp_replace(s, "[0-9]+", "0"))
    placed = F.transform(segments, lambda s, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), s))
    folders = F.concat(placed, F.transform(segments, lambda s: F.concat(F.lit("path="), s)))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    parameters = F.filter(F.split(query, "&"), lambda s: s != "")
    names = F.concat(F.transform(parameters, lambda s: F.concat(F.lit("query="), F.substring_index(s, "=", 1))), F.transform(parameters, lambda s: F.concat(F.lit("query="), s)))
    end = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)
    ends = F.when(end == "", F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("end="), F.lower(end))))
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(scheme, parents, folders, ends, names)))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """tokens, anchor, confidence, support of the rules mined from ``labelled`` (tokens, bad); and token, class.

    Tokens of the same labelled pages are one class, named by the least of them, and rules are combinations of classes.
    Any choice of a token from each class of a rule would be a rule of the same pages, so nothing is lost, and combinations
    don't multiply with the segments of a path that always come together.
    """
    spark = labelled.sparkSession
    rows = labelled.filter("size(tokens) > 0 OR bad").select(F.monotonically_increasing_id().alias("id"), "tokens", F.coalesce("bad", F.lit(False)).alias("bad"))
    rows = common.cut(rows, "transactions")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "tokens array<string>, anchor string, confidence double, support double"), spark.createDataFrame([], "token string, class string")
    least = min(1.0, max(min_support, min_pages / n))
    each = rows.select("id", F.explode("tokens").alias("token"))
    where = each.groupBy("token").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).filter(F.col("n") >= least * n * (1 - 1e-9))
    named = where.groupBy("n", "x", "y").agg(F.min("token").alias("class"))
    classes = common.cut(where.join(named, ["n", "x", "y"]).select("token", "class"), "token-classes")
    of_row = each.join(classes, "token").groupBy("id").agg(F.collect_set("class").alias("items"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    rows = common.cut(rows.join(of_row, "id", "left").select(F.when(F.col("bad"), F.array_append(items, F.lit(BAD))).otherwise(items).alias("items")), "classed")
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(rows)
    rules = model.associationRules.filter((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    alone = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    filed = rules.withColumn("token", F.explode("tokens")).join(alone, "token").groupBy("tokens", "confidence", "support")
    rules = common.cut(filed.agg(F.min(F.struct("freq", "token")).alias("least")).select("tokens", F.col("least.token").alias("anchor"), "confidence", "support"), "url-rules")
    return rules, classes


def matched(urls: DataFrame, rules: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct ``url`` of ``urls`` (url, tokens) that some rule matches, by an inverted index; a class is met by any token of it."""
    wanted = rules.select(F.explode("tokens").alias("class")).distinct()
    looked = urls.select("url", F.explode("tokens").alias("token")).join(classes.join(wanted, "class", "left_semi"), "token")
    looked = looked.groupBy("url").agg(F.collect_set("class").alias("tokens")).withColumn("anchor", F.explode("tokens"))
    found = looked.join(rules.select("anchor", F.col("tokens").alias("wanted")), "anchor")
    return found.filter(F.size(F.array_except("wanted", "tokens")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", label_key: str = "doc_id", rules=RULES, **mining) -> DataFrame:
    """One row per page: ``key``, host, path, rule, verdict. ``labels`` has ``label_key`` and toxic (1: bad)."""
    url = F.col("url")
    rows = pages.select(F.col(key).alias("key"), url, host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).withColumn("tokens", tokens_of(F.col("url"), F.col("host"), F.col("path")))
    bad = labels.filter(F.col("toxic").isNotNull()).groupBy(F.col(label_key).alias("key")).agg((F.max("toxic") > 0).alias("bad"))
    mined, classes = mine(rows.join(bad, "key").select("tokens", "bad"), **mining)
    hits = matched(rows.filter("fit IS NULL AND url IS NOT NULL").select("url", "tokens").distinct(), mined, classes).select(F.col("url").alias("hit"))
    out = rows.join(hits, F.col("url") == F.col("hit"), "left")
    verdict = F.coalesce("fit.verdict", F.when(F.col("hit").isNotNull(), "block").otherwise("allow"))
    return out.select(F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "pages"), common.table(spark, sf_dir, "labels"))
