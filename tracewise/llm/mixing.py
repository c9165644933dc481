"""Mixing sources to target weights through a tree of domains, languages and sources.

A node's capacity is what its leaves can give. Budgets go down from the root: among siblings in proportion to their
weights, none beyond its capacity, and what a sibling cannot give goes to its other siblings. Because a node's own
capacity is the sum below it, a shortage leaves a family only when all of it is exhausted. Each leaf then gives whole
epochs and the prefix of one more, in an order seeded by the epoch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DIGITS = 3  #: hex digits of the order key that name a slice of a leaf; running sums stay within a slice
WIDE = "decimal(38,0)"


def _split(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """nodes: parent columns, name, weight, cap, parent's budget; adds the node's own budget (whole tokens).

    Ordered by cap / weight, a node is full if what is left for it and those after it would give it its cap or more.
    """
    w = Window.partitionBy(*parent).orderBy("ratio", name)
    at = nodes.withColumn("ratio", F.col("cap").cast("double") / F.col("weight").cast("double"))
    at = at.withColumn("c", F.sum("cap").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("cap")).withColumn(
        "v", F.sum("weight").over(w.rowsBetween(0, Window.unboundedFollowing))
    )
    full = (F.col("cap").cast(WIDE) * F.col("v")) <= (F.col("parent_budget") - F.col("c")).cast(WIDE) * F.col("weight")
    at = at.withColumn("full", full)
    p = Window.partitionBy(*parent)
    at = at.withColumn("c", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(p), F.lit(0).cast("long"))).withColumn(
        "v", F.sum(F.when(~F.col("full"), F.col("weight"))).over(p)
    )
    share = F.expr("cast((cast(parent_budget - c as decimal(38,0)) * weight) div v as bigint)")
    return at.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(F.greatest(share, F.lit(0).cast("long")))).drop("ratio", "c", "v", "full")


def budgets(leaves: DataFrame, total: int, weights: list[DataFrame | None], levels: list[str], max_epochs: int) -> DataFrame:
    """leaves: the level columns and tokens. weights[i]: (levels[i], weight) whole numbers from 0, or None: all 1; names that
    it lacks, and null weights, weigh 1; of a name that it has twice the larger weight counts. What weighs 0 gets nothing,
    nor does anything below it, and its share goes to the others; a negative weight fails the job. Returns leaves with
    `budget`; budgets are rounded down to whole tokens."""
    root, one = "cast(0 as int)", F.lit(1).cast("long")
    at = leaves.withColumn("cap", F.col("tokens") * max_epochs).withColumn("root", F.expr(root))
    for i, (level, known) in enumerate(zip(levels, weights, strict=True)):
        weight = one
        if known is not None:
            given = known.groupBy(F.col(level).alias("name")).agg(F.max(F.col("weight").cast("long")).alias("given"))
            at = at.join(given, F.col(level).eqNullSafe(F.col("name")), "left").drop("name")
            weight = F.coalesce("given", one)
        weight = F.when(weight < 0, F.raise_error(F.lit("weights may not be negative"))).otherwise(weight)
        at = at.withColumn(f"_w{i}", weight).drop("given")
        # What weighs nothing has nothing to give, to its parents neither; then its weight is no matter.
        at = at.withColumn("cap", F.when(F.col(f"_w{i}") == 0, 0).otherwise(F.col("cap"))).withColumn(f"_w{i}", F.greatest(f"_w{i}", one))
    top = at.groupBy("root").agg(F.sum("cap").alias("cap")).select("root", F.least(F.col("cap"), F.lit(int(total))).alias("parent_budget"))
    path: list[str] = ["root"]
    for i, level in enumerate(levels):
        nodes = at.groupBy(*path, level).agg(F.sum("cap").alias("cap"), F.max(f"_w{i}").alias("weight"))
        on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in path]
        nodes = nodes.alias("l").join(top.alias("r"), on).select("l.*", "parent_budget")
        path = [*path, level]
        top = _split(nodes, path[:-1], level).select(*path, F.col("budget").alias("parent_budget"))
    on = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in levels]
    return leaves.alias("l").join(top.alias("r"), on).select("l.*", F.col("parent_budget").alias("budget"))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Hex text by which an epoch orders a leaf's documents; ties go to the smaller id."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), doc_id.cast("string")).cast("binary"))


def _mix(docs: DataFrame, total: int, weights: list[DataFrame | None], levels: list[str], tokens: str, seed: int = 0, max_epochs: int = 1, doc_id: str = "doc_id") -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), *levels, F.col(tokens).cast("long").alias("tokens")).where("tokens > 0")
    leaves = rows.groupBy(*levels).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, total, weights, levels, max_epochs).select(
        *(F.col(x).alias(f"leaf_{x}") for x in levels), "budget", F.expr("budget div tokens").alias("whole"), F.expr("budget % tokens").alias("rest")
    )
    on = [F.col(x).eqNullSafe(F.col(f"leaf_{x}")) for x in levels]
    # Leaves are as many as there are sources, not documents; Spark broadcasts them only below its own size limit.
    rows = rows.join(plan, on).drop(*(f"leaf_{x}" for x in levels))
    whole = rows.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole") - 1)))
    part = rows.where("rest > 0").withColumn("epoch", F.col("whole"))
    part = part.withColumn("key", order_key(seed, F.col("epoch"), F.col("doc_id"))).withColumn("slice", F.substring("key", 1, DIGITS))
    sums = part.groupBy(*levels, "slice").agg(F.sum("tokens").alias("sum"))
    w = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.select(*(F.col(x).alias(f"leaf_{x}") for x in levels), F.col("slice").alias("s"), (F.sum("sum").over(w) - F.col("sum")).alias("before"))
    part = part.join(sums, [*on, F.col("slice") == F.col("s")]).where("before < rest")
    w = Window.partitionBy(*levels, "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    part = part.withColumn("before", F.col("before") + F.sum("tokens").over(w) - F.col("tokens")).where("before < rest")
    names = ["doc_id", *levels, "tokens", "epoch", "budget"]
    return whole.select(*names).unionByName(part.select(*names))


def mix(docs: DataFrame, total: int, weights: list[DataFrame | None], levels: list[str], tokens: str, seed: int = 0, max_epochs: int = 1, doc_id: str = "doc_id") -> DataFrame:
    """Rows (doc_id, the levels, tokens, epoch, budget of the leaf): epochs from 0.

    A leaf gives epochs below budget div tokens whole; of the next it gives documents in seeded order while the tokens
    before them are fewer than what is left, so by less than one document more than its budget. Documents of null or
    no tokens are never chosen. Null level values are a name of their own. An empty table gives an empty result. Repeated
    rows, ids or both, are documents of their own; null ids take part. Levels may have any name but those of the results.
    Running sums are made within slices of a leaf by the first digits of the order key and added to the sums of the
    slices before, so that no task orders a whole leaf.
    """
    own = [f"_level{i}" for i in range(len(levels))]
    rows = docs.select(F.col(doc_id).alias("doc_id"), *(F.col(x).alias(o) for x, o in zip(levels, own, strict=True)), F.col(tokens).alias("tokens"))
    given = [w if w is None else w.toDF(o, "weight") for w, o in zip(weights, own, strict=True)]
    out = _mix(rows, total, given, own, "tokens", seed, max_epochs)
    return out.select("doc_id", *(F.col(o).alias(x) for x, o in zip(levels, own, strict=True)), "tokens", "epoch", "budget")
