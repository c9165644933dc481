"""Search of passages by BM25: an inverted index in blocks of like impact with upper bounds, and MaxScore pruning.

A posting's impact (what its term adds to a score) is known when the index is built, so postings are filed by its level and
each block knows its largest one. A batch of queries first scores a few documents of the best blocks, whose k-th best score
is a threshold for each query. Terms that cannot reach it together are not essential: documents with no other terms are
never met, nor are blocks whose bound leaves their documents below the threshold.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.sources.scratch import materialise

K1, B = 1.2, 0.75  #: of BM25
LEVELS = 64  #: of impact, within a term
SLICE = 65_536  #: postings of a term in a slice; common terms have many slices, so that their blocks are many
LEADING, FIRST = 8, 16  #: terms of a query, and postings of each, whose documents give the threshold
SLACK = 2e-6  #: below a threshold within which nothing is pruned, as scores are rounded to 6 digits


@dataclass(frozen=True)
class Index:
    """postings: term, level, slice, doc, w; blocks: term, level, slice, bound, n."""

    postings: DataFrame
    blocks: DataFrame


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def asked_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term), each term of a query once."""
    return queries.select("query_id", F.explode(F.array_distinct(terms_of(F.col("query_text")))).alias("term"))


def build_index(corpus: DataFrame, key: str, text: str, vocabulary: DataFrame | None = None) -> Index:
    """The index of corpus, over the terms of vocabulary (term) if one is given; numbers and lengths are of all documents.

    A null text has no terms but counts as a document. Postings are written once; the most frequent term is spread over
    slices by document.
    """
    docs = corpus.select(F.col(key).alias("doc"), terms_of(F.coalesce(F.col(text), F.lit(""))).alias("terms")).withColumn("length", F.size("terms").cast("double"))
    stats = docs.agg(F.count("*").cast("double").alias("docs"), F.avg("length").alias("mean"))
    found = docs.select("doc", "length", F.explode("terms").alias("term"))
    found = found if vocabulary is None else found.join(vocabulary.select("term").distinct(), "term", "left_semi")
    counts = materialise(found.groupBy("term", "doc").agg(F.count("*").cast("double").alias("tf"), F.max("length").alias("length")), "term-counts")
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    idf = F.ln(1 + (F.col("docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    postings = counts.join(df, "term").crossJoin(F.broadcast(stats)).select(
        "term", F.floor(part * (LEVELS / (K1 + 1))).cast("int").alias("level"),
        F.pmod(F.xxhash64("doc"), F.ceil(F.col("df") / SLICE)).cast("int").alias("slice"), "doc", (idf * part).alias("w"),
    )
    postings = materialise(postings, "postings")
    return Index(postings, materialise(postings.groupBy("term", "level", "slice").agg(F.max("w").alias("bound"), F.count("*").alias("n")), "blocks"))


def _weights(pairs: DataFrame, terms: DataFrame, index: Index) -> DataFrame:
    """(query_id, doc, score): the sum over the given terms of each query, for pairs that hold any of them."""
    wanted = pairs.select("query_id", "doc").join(terms.select("query_id", "term"), "query_id")
    return wanted.join(index.postings.select("term", "doc", "w"), ["term", "doc"]).groupBy("query_id", "doc").agg(F.sum("w").alias("score"))


def thresholds(terms: DataFrame, index: Index, k: int) -> DataFrame:
    """(query_id, least): a score that k documents reach; queries for which k documents were not met are left out.

    terms: query_id, term, top. The documents are those of the best FIRST postings of the LEADING terms of each query.
    """
    leading = terms.withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("top"), "term"))).where(F.col("n") <= LEADING).select("query_id", "term")
    before = F.sum("n").over(Window.partitionBy("term").orderBy(F.desc("level"), "slice")) - F.col("n")
    best = index.blocks.join(leading.select("term").distinct(), "term", "left_semi").withColumn("before", before).where(F.col("before") < FIRST)
    best = index.postings.join(best.select("term", "level", "slice"), ["term", "level", "slice"], "left_semi")
    best = best.withColumn("n", F.row_number().over(Window.partitionBy("term").orderBy(F.desc("w"), "doc"))).where(F.col("n") <= FIRST)
    met = leading.join(best.select("term", "doc"), "term").select("query_id", "doc").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"))
    return _weights(met, terms, index).withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query_id", F.col("score").alias("least"))


def survivors(terms: DataFrame, index: Index) -> tuple[DataFrame, DataFrame]:
    """(query_id, doc, partial) of the documents that may be among the best, with the sum of their essential terms, and
    (query_id, term) of the other terms, which are still to be added.

    terms: query_id, term, top, least. Whatever is dropped is surely below `least`.
    """
    up_to = Window.partitionBy("query_id").orderBy("top", "term")
    terms = terms.withColumns({"sum_to": F.sum("top").over(up_to), "all": F.sum("top").over(Window.partitionBy("query_id"))})
    needed = F.col("least") - SLACK
    terms = terms.withColumn("is_essential", F.col("sum_to") >= needed)
    others = F.sum(F.when(~F.col("is_essential"), F.col("top")).otherwise(0.0)).over(Window.partitionBy("query_id"))
    terms = materialise(terms.withColumn("others", others), "query-terms")
    open_ = F.col("all") - F.col("top") >= needed  # by how much an essential posting must reach is known for its block
    chosen = terms.where("is_essential").join(index.blocks.select("term", "level", "slice", "bound"), "term")
    chosen = chosen.where(open_ | (F.col("bound") + F.col("all") - F.col("top") >= needed)).select("query_id", "term", "level", "slice", "all", "top", "others", "least")
    met = chosen.join(index.postings, ["term", "level", "slice"]).where(F.col("w") + F.col("all") - F.col("top") >= needed)
    met = met.groupBy("query_id", "doc").agg(F.sum("w").alias("partial"), F.first("others").alias("others"), F.first("least").alias("least"))
    return materialise(met.where(F.col("partial") + F.col("others") >= needed).select("query_id", "doc", "partial"), "survivors"), terms.where("not is_essential").select("query_id", "term")


def bounded_terms(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """(query_id, term, top, least) of the terms that the index has: the largest impact of each, and the query's threshold."""
    tops = index.blocks.groupBy("term").agg(F.max("bound").alias("top"))
    terms = materialise(asked_terms(queries).join(tops, "term"), "asked")
    return terms.join(thresholds(terms, index, k), "query_id", "left").withColumn("least", F.coalesce("least", F.lit(0.0)))


def search(queries: DataFrame, index: Index, k: int = 5) -> DataFrame:
    """(query_id, rank, doc, score) of the k best documents for each query (query_id, query_text); ties go to the smaller
    doc. Documents without a term of the query are no result; a query without known terms has none."""
    found, rest = survivors(bounded_terms(queries, index, k), index)
    more = _weights(found, rest, index)
    total = found.join(more, ["query_id", "doc"], "left").select("query_id", "doc", F.round(F.col("partial") + F.coalesce("score", F.lit(0.0)), 6).alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc")
    return total.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= k).select("query_id", "rank", "doc", "score")


def search_passages(queries: DataFrame, corpus: DataFrame, k: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(query_id, rank, key, score): search over an index of the terms that the queries ask for. Of the rest of the corpus
    only the lengths are read."""
    index = build_index(corpus, key, text, asked_terms(queries).select("term"))
    return search(queries, index, k).withColumnRenamed("doc", key)
