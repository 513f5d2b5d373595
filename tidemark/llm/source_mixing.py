"""Operator 8: mixing sources to target weights by hierarchical budgets, with DataFrame operations only.

The tree is domain, language, source. A budget of tokens flows down by the weights of siblings. A node takes no
more than its leaves can give, MAX_EPOCHS times what they hold; what it can't take goes to its siblings, by their
weights, and only what none of them can take stays with their parent, whose own share was bounded in the same way.
Each leaf then gives the prefix of a seeded sequence: all its documents in one seeded order, then all again in
another, until the next would exceed its budget.

The prefix needs no global sort: tokens are summed by slices of the order, the slice in which a leaf's budget
ends is found from the sums, digit by digit of the slices' names, and only that slice is summed row by row; what is left is
one cut-off for each leaf. So however many documents a leaf has, no window holds more than 16 sums of it, or the rows of one
slice in 4096. The budgets are found in the same way, from sums over slices of siblings, so a parent may have any number of
children: a window holds some hundred sums, or the ratios within one slice, 0.02 % wide.

Defined results: null texts hold no tokens; a null language or source is the leaf ``none``. Rows of equal keys are
tied: all or none of them are taken. A leaf without tokens has no budget, and gives nothing. An empty table gives
an empty result. Budgets are whole tokens, rounded down. Extra columns are ignored by :func:`mix` and passed
through by :func:`mixed`, which replaces clashing ones (domain, n_tokens, epoch).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

LEVELS = ("domain", "lang", "source")
#: Weights by level and name; a name that isn't listed has weight 1.
WEIGHTS = {"domain": {"domain0": 3, "domain1": 2}, "lang": {"en": 3, "de": 2, "fr": 2}, "source": {}}
BUDGET_PERCENT = 50
#: Slices of siblings by the ratio of what they can take to their weight, for each doubling of it, coarse and fine.
FINENESS = (16, 4096)
#: Hexadecimal digits that name a slice of a leaf's order.
DIGITS = 3
MAX_EPOCHS = 2
SEED = "mix-1"


def domain_of(source: Column) -> Column:
    """The domain of a source: its number modulo 4, as sources here have no domain of their own."""
    number = F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int")
    return F.when(number.isNull(), "other").otherwise(F.concat(F.lit("domain"), (number % 4).cast("string")))


def order_key(key: Column, epoch: Column, seed: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def counted(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(key).alias("key"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("n_tokens"))
    return rows.withColumn("domain", domain_of(F.col("source"))).fillna("none", ["lang", "source"])


def _weight(level: str, weights: dict) -> Column:
    out = F.lit(1)
    for name, w in sorted(weights.get(level, {}).items()):
        out = F.when(F.col(level) == name, F.lit(w)).otherwise(out)
    return out.cast("bigint")


def _levels(nodes: DataFrame, above: list[str]) -> DataFrame:
    """``above``, level, before, behind: where the water stands among the siblings of each parent.

    ``nodes`` has ``above``, budget, cap, w and ratio (cap / w). Those of a ratio under ``level`` take all they can, ``before``
    in sum; the others, ``behind`` by the sum of their weights, share the rest. Parents whose children all take all they can are left out.
    The level is found from sums over slices of the ratio, each step within the slice that the last one found.
    """
    at = nodes.groupBy(*above).agg(F.sum("w").alias("behind")).withColumn("before", F.lit(0).cast("bigint"))
    parts = [F.floor(F.log2("ratio") * n) for n in FINENESS] + [F.col("ratio")]
    along = Window.partitionBy(*above).orderBy("part")
    wide = lambda c: F.col(c).cast("decimal(19,0)")  # noqa: E731 - tokens times weights pass 64 bits
    for outer, part in zip([None, *parts], parts, strict=False):
        inside = nodes.join(at, above)
        if outer is not None:
            inside = inside.filter(outer == F.col("level"))
        sums = inside.groupBy(*above, "budget", "before", "behind", part.alias("part")).agg(F.sum("cap").alias("c"), F.sum("w").alias("v"), F.max(F.struct("ratio", "cap", "w")).alias("top"))
        sums = sums.withColumn("until", F.col("before") + F.sum("c").over(along)).withColumn("later", F.col("behind") - F.sum("v").over(along))
        # A slice takes all it can if the last of it does, the one of the largest ratio.
        sums = sums.withColumn("left", F.col("budget") - F.col("until") + F.col("top.cap")).withColumn("sharers", F.col("later") + F.col("top.w"))
        full = wide("top.cap") * wide("sharers") <= wide("left") * wide("top.w")
        end = F.struct("part", (F.col("until") - F.col("c")).alias("before"), (F.col("later") + F.col("v")).alias("behind"))
        at = sums.groupBy(*above).agg(F.min(F.when(~full, end)).alias("end")).filter("end IS NOT NULL").select(*above, F.col("end.part").alias("level"), "end.before", "end.behind")
    return at


def leaf_budgets(leaves: DataFrame, weights: dict = WEIGHTS, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """LEVELS, available, budget of ``leaves`` (LEVELS, available); one row for each leaf."""
    spread = leaves.agg(F.coalesce(F.sum("available"), F.lit(0)).alias("all"))
    given = F.broadcast(spread.select(F.lit("all").alias("tree"), F.expr(f"all div 100 * {budget_percent} + all % 100 * {budget_percent} div 100").alias("budget")))
    above = ["tree"]
    for level in LEVELS:
        names = [*above, level]
        nodes = leaves.withColumn("tree", F.lit("all")).groupBy(*names).agg((F.sum("available") * max_epochs).alias("cap")).filter("cap > 0").withColumn("w", _weight(level, weights))
        nodes = common.cut(nodes.join(given, above).withColumn("ratio", F.col("cap") / F.col("w")), "nodes")
        share = F.when(F.col("level").isNull() | (F.col("ratio") < F.col("level")), F.col("cap")).otherwise(F.expr("(budget - before) * w div behind"))
        given = nodes.join(_levels(nodes, above), above, "left").select(*names, share.alias("budget"))
        above = names
    return leaves.join(given, list(LEVELS)).select(*LEVELS, "available", "budget")


def cut_offs(rows: DataFrame, budgets: DataFrame, seed: str = SEED) -> DataFrame:
    """LEVELS, epochs (whole ones), until (the last order key taken of the next one, null if none)."""
    # Written, so that its size is known where it is joined; a leaf's rows are then dealt out by slice, however many.
    plan = common.cut(budgets.withColumn("epochs", F.expr("budget div available")).withColumn("rest", F.expr("budget % available")), "budgets")
    keyed = rows.join(plan, list(LEVELS)).select(*LEVELS, "epochs", "rest", "n_tokens", order_key(F.col("key"), F.col("epochs"), seed).alias("place"))
    keyed = keyed.withColumn("slice", F.substring("place", 1, DIGITS)).repartition(*LEVELS, "slice")
    slices = common.cut(keyed.groupBy(*LEVELS, "slice").agg(F.sum("n_tokens").alias("n"), F.max("place").alias("last")), "slices")
    at = plan.select(*LEVELS, "rest", F.lit("").alias("in"), F.lit(0).cast("bigint").alias("from"))
    wholes = []
    along = Window.partitionBy(*LEVELS).orderBy("part")
    for digits in range(1, DIGITS + 1):
        part = F.substring("slice", 1, digits).alias("part")
        sums = slices.join(at, list(LEVELS)).filter(F.startswith("slice", F.col("in"))).groupBy(*LEVELS, "rest", "from", part).agg(F.sum("n").alias("n"), F.max("last").alias("last"))
        sums = common.cut(sums.withColumn("until", F.col("from") + F.sum("n").over(along)).withColumn("from", F.col("until") - F.col("n")), "sums")
        wholes.append(sums.filter(F.col("until") <= F.col("rest")).groupBy(*LEVELS).agg(F.max("last").alias("last")))
        at = sums.filter((F.col("until") > F.col("rest")) & (F.col("from") <= F.col("rest"))).select(*LEVELS, "rest", F.col("part").alias("in"), "from")
    ends = at.select(*LEVELS, F.col("in").alias("slice"), "from")
    inside = keyed.join(ends, [*LEVELS, "slice"])
    within = Window.partitionBy(*LEVELS, "slice").orderBy("place")
    # Rows of one place are summed together: the frame is by range.
    inside = inside.withColumn("sum", F.col("from") + F.sum("n_tokens").over(within.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    part = inside.filter(F.col("sum") <= F.col("rest")).groupBy(*LEVELS).agg(F.max("place").alias("last"))
    last = reduce(DataFrame.unionAll, wholes, part).groupBy(*LEVELS).agg(F.max("last").alias("until"))
    return common.cut(plan.join(last, list(LEVELS), "left").select(*LEVELS, "epochs", "until"), "cut-offs")


def _taken(rows: DataFrame, offs: DataFrame, seed: str) -> DataFrame:
    """``rows`` (key, LEVELS and more) once for each epoch that takes them."""
    out = rows.join(offs, list(LEVELS))
    extra = F.coalesce(order_key(F.col("key"), F.col("epochs"), seed) <= F.col("until"), F.lit(False)).cast("int")
    out = out.withColumn("times", (F.col("epochs") + extra).cast("int")).filter("times > 0")
    return out.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).drop("times", "epochs", "until")


def mix(docs: DataFrame, key: str = "doc_id", weights: dict = WEIGHTS, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document and epoch taken: ``key``, domain, lang, source, n_tokens, epoch."""
    rows = common.cut(counted(docs, key), "counted")
    leaves = common.cut(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), "leaves").filter("available > 0")
    offs = cut_offs(rows, leaf_budgets(leaves, weights, budget_percent, max_epochs), seed)
    return _taken(rows, offs, seed).select(F.col("key").alias(key), *LEVELS, "n_tokens", "epoch")


def mixed(docs: DataFrame, key: str = "doc_id", weights: dict = WEIGHTS, budget_percent: int = BUDGET_PERCENT, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """``docs`` as mixed: each row once for each epoch that takes it, with n_tokens, domain and epoch added."""
    rows = common.cut(counted(docs, key), "counted")
    leaves = common.cut(rows.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("available")), "leaves").filter("available > 0")
    offs = cut_offs(rows, leaf_budgets(leaves, weights, budget_percent, max_epochs), seed)
    names = [c for c in docs.columns if c not in ("domain", "n_tokens", "epoch")]
    source, lang = F.col("source").cast("string"), F.col("lang").cast("string")
    whole = docs.select(F.struct(*names).alias("row"), F.col(key).alias("key"), source.alias("source"), lang.alias("lang"), n_words(F.col("text")).alias("n_tokens"))
    whole = whole.withColumn("domain", domain_of(F.col("source"))).fillna("none", ["lang", "source"])
    return _taken(whole, offs, seed).select("row.*", "domain", "n_tokens", "epoch")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents"))


def _oracle() -> str:
    def weight(level: str) -> str:
        cases = "".join(f" WHEN {level} = '{n}' THEN {w}" for n, w in WEIGHTS[level].items())
        return f"CASE{cases} ELSE 1 END" if cases else "1"

    parts = [
        r"""rows AS (SELECT doc_id, coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
        coalesce('domain' || CAST(CAST(nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '') AS BIGINT) % 4 AS VARCHAR), 'other') AS domain,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n_tokens FROM documents)""",
        "leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS available FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0)",
        f"given0 AS (SELECT (coalesce(sum(available), 0) * {BUDGET_PERCENT} // 100)::BIGINT AS budget FROM leaves)",
    ]
    for d, level in enumerate(LEVELS):
        names, above = ", ".join(LEVELS[: d + 1]), ", ".join(LEVELS[:d])
        by = f"PARTITION BY {above} " if above else ""
        join = f"JOIN given{d} USING ({above})" if above else f"CROSS JOIN given{d}"
        parts += [
            f"nodes{d} AS (SELECT *, {weight(level)} AS w FROM (SELECT {names}, sum(available)::BIGINT * {MAX_EPOCHS} AS cap FROM leaves GROUP BY ALL) {join})",
            f"ranked{d} AS (SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS behind, row_number() OVER o AS pos FROM nodes{d} WINDOW o AS ({by}ORDER BY cap / w, {level}))",
            f"rated{d} AS (SELECT *, min(CASE WHEN cap * behind > (budget - before) * w THEN pos END) OVER ({by}) AS first FROM ranked{d})",
            f"rates{d} AS (SELECT *, min(CASE WHEN pos = first THEN before END) OVER ({by}) AS rb, min(CASE WHEN pos = first THEN behind END) OVER ({by}) AS rw FROM rated{d})",
            f"given{d + 1} AS (SELECT {names}, (CASE WHEN first IS NULL OR pos < first THEN cap ELSE (budget - rb) * w // rw END)::BIGINT AS budget FROM rates{d})",
        ]
    parts += [
        "plan AS (SELECT domain, lang, source, budget // available AS epochs, budget % available AS rest FROM leaves JOIN given3 USING (domain, lang, source))",
        f"keyed AS (SELECT rows.*, epochs, rest, md5('{SEED}|' || CAST(epochs AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS place FROM rows JOIN plan USING (domain, lang, source))",
        "summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM keyed)",
    ]
    return "WITH " + ",\n".join(parts) + "\nSELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(0, CAST(epochs AS BIGINT) + CASE WHEN s <= rest THEN 1 ELSE 0 END)) AS INTEGER) AS epoch FROM summed"


ORACLE_SQL = _oracle()
