"""Mixing sources to target weights by hierarchical budgeting.

The corpus is a tree: domain, language, source.  The token budget goes down the tree in proportion to
integer weights.  A child that cannot use its share (all its tokens, times the epochs allowed) gives
the rest to its siblings in proportion to their weights; only what all siblings together cannot use
stays with the parent's own siblings.  A leaf then reads its documents in seeded epochs: every epoch
is an order of its own, whole epochs come first, and of the last one a token-prefix is taken, up to
and including the document that reaches the leaf's budget.

Tokens are estimated as a quarter of the UTF-8 bytes, rounded up.  Fractions of a token are rounded
down at each node.

Defined results: a null text has no tokens; null domains, languages and sources are leaves of their
own, called "?"; a weight of 0 takes nothing; rows that repeat an id take the same place in the order,
shorter first; an empty table gives an empty result; other columns are passed through.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, whole_row

LEAF = ["_domain", "_lang", "_source"]
DEFAULT_WEIGHT = 1


def token_estimate(text: Column) -> Column:
    return F.coalesce(F.ceil(F.octet_length(text) / F.lit(4.0)).cast("long"), F.lit(0).cast("long"))


def numbered_domain(source: Column, domains: int = 4) -> Column:
    """A domain for sources that end in a number."""
    number = F.nullif(F.regexp_extract(source, r"(\d{1,9})$", 1), F.lit("")).cast("long")
    return F.when(number.isNull(), "other").otherwise(F.concat(F.lit("domain"), (number % domains).cast("string")))


def _weight(column: str, weights: dict) -> Column:
    out = F.lit(DEFAULT_WEIGHT)
    for name, weight in sorted(weights.items()):
        out = F.when(F.col(column) == name, F.lit(int(weight))).otherwise(out)
    return out.cast("long")


def _share_out(children: DataFrame, parents: list, key: str, budget: Column) -> DataFrame:
    """Adds ``alloc``: the parent's budget over its children by weight ``w``, none above its ``cap``."""
    children = children.filter("w > 0").withColumn("_b", budget)
    order = [F.col("cap") / F.col("w"), F.col(key)]
    base = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    before = base.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    onward = base.orderBy(*order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    big = "decimal(38,0)"
    full = (F.col("cap").cast(big) * F.sum("w").over(onward)
            <= (F.col("_b") - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast(big) * F.col("w"))
    children = children.withColumn("_full", full)
    left = F.col("_b") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(base), F.lit(0))
    weight = F.sum(F.when(~F.col("_full"), F.col("w"))).over(base)
    share = F.floor((left.cast(big) * F.col("w")) / weight).cast("long")
    return children.withColumn("alloc", F.when(F.col("_full"), F.col("cap")).otherwise(
        F.least(F.col("cap"), share))).drop("_full", "_b")


def leaf_budgets(leaves: DataFrame, budget_share: float, epochs: int, domain_weights, lang_weights,
                 source_weights) -> DataFrame:
    """``leaves`` (with ``tokens``) plus ``quota``, the tokens to take from each."""
    leaves = leaves.withColumn("cap", F.col("tokens") * epochs)
    langs = leaves.groupBy("_domain", "_lang").agg(F.sum("cap").alias("cap"))
    domains = langs.groupBy("_domain").agg(F.sum("cap").alias("cap"))
    # A budget above what the epochs can give is cut by the capacities themselves.
    per_mille = round(budget_share * 1000)
    total = F.floor(F.sum("cap").over(Window.partitionBy(F.lit(0))) / epochs * per_mille / 1000).cast("long")
    domains = _share_out(domains.withColumn("w", _weight("_domain", domain_weights)), [], "_domain", total)
    langs = langs.withColumn("w", _weight("_lang", lang_weights)).join(
        domains.select("_domain", F.col("alloc").alias("up")), "_domain")
    langs = _share_out(langs, ["_domain"], "_lang", F.col("up"))
    leaves = leaves.withColumn("w", _weight("_source", source_weights)).join(
        langs.select("_domain", "_lang", F.col("alloc").alias("up")), ["_domain", "_lang"])
    leaves = _share_out(leaves, ["_domain", "_lang"], "_source", F.col("up"))
    return leaves.select(*LEAF, "tokens", F.col("alloc").alias("quota"))


def _take(rows: DataFrame, quotas: DataFrame, seed: int) -> DataFrame:
    """The rows (leaf, _tokens, _key and any others) that the quotas select, with ``_epoch``."""
    slim = rows.select(*LEAF, "_tokens", "_key")
    # Written first: Spark then knows their size and broadcasts them only if they are small.
    quotas = stored(quotas.filter("quota > 0").select(
        *LEAF, F.expr("quota div tokens").cast("int").alias("_whole"),
        F.expr("quota % tokens").alias("_rest")), "mix-quotas")

    def placed(frame):  # place of a document in the order of the epoch that is cut
        place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_whole").cast("string"), F.col("_key")))
        return frame.join(quotas, LEAF).filter("_rest > 0").withColumn("_place", place)

    # The prefix ends in one of 256 bins of the order, and there in one of 4,096; only that one is
    # sorted by document.
    run = Window.partitionBy(*LEAF).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    ends = None
    for digits in (2, 3):
        at = placed(slim)
        if ends is None:
            at = at.withColumn("_end", F.lit("")).withColumn("_before", F.lit(0).cast("long"))
        else:
            at = at.join(ends, LEAF).filter(F.col("_place").startswith(F.col("_end")))
        size = F.length("_end") + digits
        bins = at.groupBy(*LEAF, "_rest", "_before", F.substr("_place", F.lit(1), size).alias("_bin")).agg(
            F.sum("_tokens").alias("t"))
        bins = bins.withColumn("_before", F.col("_before") + F.coalesce(F.sum("t").over(run), F.lit(0)))
        ends = stored(bins.filter(F.col("_before") < F.col("_rest")).groupBy(*LEAF).agg(
            F.max("_bin").alias("_end"), F.max("_before").alias("_before")), "mix-ends")

    whole = rows.join(quotas.filter("_whole > 0"), LEAF).withColumn(
        "_epoch", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)))
    cut = placed(rows).join(ends, LEAF).withColumn("_bin", F.substring("_place", 1, 5))
    inner = cut.filter(F.col("_bin") < F.col("_end"))
    last = Window.partitionBy(*LEAF).orderBy("_place", "_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = (cut.filter(F.col("_bin") == F.col("_end"))
            .withColumn("_at", F.col("_before") + F.coalesce(F.sum("_tokens").over(last), F.lit(0)))
            .filter(F.col("_at") < F.col("_rest")))
    columns = [*rows.columns, "_epoch"]
    whole, inner, edge = (x.select(*columns) for x in (
        whole, inner.withColumn("_epoch", F.col("_whole")), edge.withColumn("_epoch", F.col("_whole"))))
    return whole.unionAll(inner).unionAll(edge)


def mixed(docs: DataFrame, domain: Column, budget_share: float = 0.6, epochs: int = 2, seed: int = 17,
          domain_weights=None, lang_weights=None, source_weights=None, doc_id="doc_id", text="text",
          lang="lang", source="source") -> DataFrame:
    """``row`` (all columns of a selected document), ``mix_domain``, ``mix_epoch``, ``mix_tokens``.

    ``budget_share`` is the token budget as a share of all tokens.
    """
    unknown = lambda c: F.coalesce(c.cast("string"), F.lit("?"))
    rows = docs.select(whole_row(docs), unknown(domain).alias("_domain"), unknown(F.col(lang)).alias("_lang"),
                       unknown(F.col(source)).alias("_source"), token_estimate(F.col(text)).alias("_tokens"),
                       F.coalesce(F.col(doc_id).cast("string"), F.lit("?")).alias("_key"))
    quotas = leaf_budgets(rows.groupBy(*LEAF).agg(F.sum("_tokens").alias("tokens")), budget_share, epochs,
                          domain_weights or {}, lang_weights or {}, source_weights or {})
    return _take(rows, quotas, seed).select("row", F.col("_domain").alias("mix_domain"),
                                            F.col("_epoch").alias("mix_epoch"), F.col("_tokens").alias("mix_tokens"))
