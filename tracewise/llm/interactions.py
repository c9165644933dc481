"""How filters interact: what each of them removes in every order in which they can be applied.

Each document has a mask of the filters that it fails, so a part of the corpus is at most 2^n cells of equal masks. A cell
folds over all orders of the filters with higher-order functions into one weighted struct for each step of each order, and
the structs of a part's cells are summed element by element. Orders are literals; no document meets an order.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.shared import materialise

WORD = r"[^\x20\x09-\x0D]+"
LEAST_WORDS, DISTINCT_PERCENT, UPPER_PERCENT, SYMBOLS = 200, 50, 2, "[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> dict[str, Column]:
    """Whether a whole text fails the filters A to D; a null text is empty. A: too few words; B: too few distinct ones;
    C: too many capitals A to Z; D: holds a symbol."""
    text = F.coalesce(text, F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < LEAST_WORDS, "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > UPPER_PERCENT * F.char_length(text), "D": text.rlike(SYMBOLS),
    }


def failure_masks(docs: DataFrame, labels: DataFrame, part: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(part, mask, n, good, toxic): the documents of a part that fail the filters of the mask's bits (A is 1, B is 2, ...,
    E is 16), and how many of them have a label of quality 1, and of toxic 1.

    E fails where a smaller id has the identical text, in any part; rows of one id do not make each other fail, nor do
    rows with a null id, which are counted like all others. A null part is the empty one. Labels of an id that has several
    count if any of them says so. Texts are compared by SHA-256 and leave the scan as a digest.
    """
    fails = text_failures(F.col(text_col))
    mask = reduce(lambda a, b: a + b, (F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails.values())))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"), mask.alias("mask"),
    )
    # Repeated rows are one row with a count from here on, copies are one candidate a task for the smallest id.
    rows = materialise(rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n")), "failures")
    first = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    label = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("is_good"), F.max(F.col("toxic") == 1).alias("is_toxic"))
    rows = rows.join(first, ["doc_id", "digest"], "left").join(label, "doc_id", "left")
    copied = F.when(F.col("doc_id").isNotNull() & F.col("is_first").isNull(), 1 << len(fails)).otherwise(0)
    some = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return rows.groupBy("part", (F.col("mask") + copied).alias("mask")).agg(F.sum("n").alias("n"), some("is_good").alias("good"), some("is_toxic").alias("toxic"))


def interactions(cells: DataFrame, filters: str = "ABCDE") -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley) of every part and order, step by step, zeros included.

    cells: part, mask, n, good, toxic, at most one row for each part and mask; the bits of mask are filters, in order.
    kept: after the step; removed: at it; redundant: fail its filter, but were removed before; unique_fails: fail no other;
    good_lost, toxic_lost: removed here; shapley: removed by the step's filter, summed over all orders. No cells give no
    rows. Rows grow with the factorial of the filters: at most six.
    """
    if not 1 <= len(filters) <= 6 or len(set(filters)) < len(filters):
        raise ValueError("filters: one to six different letters")
    orders = ["".join(o) for o in permutations(filters)]
    bit = {f: 1 << i for i, f in enumerate(filters)}
    bits = F.array(*(F.array(*(F.lit(bit[f]) for f in o)) for o in orders))
    long = lambda c: c.cast("long")

    def step(cell: Column, removed_by: Column, own: Column) -> Column:
        fails, gone = cell["mask"].bitwiseAND(own) != 0, cell["mask"].bitwiseAND(removed_by) != 0
        here = fails & ~gone
        values = (~fails & ~gone, here, fails & gone, cell["mask"] == own, here, here)
        of = ("n", "n", "n", "n", "good", "toxic")
        return F.struct(own.alias("own"), *(long(F.when(v, cell[w]).otherwise(0)).alias(c) for c, v, w in zip(COUNTS, values, of, strict=True)))

    def fold(cell: Column) -> Column:
        """The steps of all orders, one after the other."""
        none = F.slice(F.array(step(cell, F.lit(0), F.lit(1))), 1, 0)
        of_order = lambda order: F.aggregate(
            order, F.struct(F.lit(0).alias("bits"), none.alias("steps")),
            lambda at, own: F.struct(at["bits"].bitwiseOR(own).alias("bits"), F.concat(at["steps"], F.array(step(cell, at["bits"], own))).alias("steps")),
            lambda at: at["steps"],
        )
        return F.flatten(F.transform(bits, of_order))

    # Cells are few and dear: a stated number of partitions keeps them from meeting in one task.
    cells = cells.select("part", F.col("mask").cast("int").alias("mask"), "n", "good", "toxic")
    cells = cells.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), "part", "mask")
    folded = cells.select("part", F.posexplode(fold(F.struct("mask", "n", "good", "toxic"))).alias("at", "step"))
    merged = folded.groupBy("part", "at", F.col("step.own").alias("own")).agg(*(F.sum(f"step.{c}").alias(c) for c in COUNTS))
    return merged.select(
        "part", F.element_at(F.array(*map(F.lit, orders)), (F.expr(f"at div {len(filters)}") + 1).cast("int")).alias("filter_order"),
        (F.col("at") % len(filters) + 1).cast("int").alias("step"), *COUNTS, F.sum("removed").over(Window.partitionBy("part", "own")).alias("shapley"),
    )
