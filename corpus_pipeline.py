"""Corpus preparation in five stages; each reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.llm import language, minhash, mixing, pieces, quality
from tracewise.llm.queries import DOMAIN_WEIGHTS, LANG_WEIGHTS, SEED, domain, fold, model_path, n_words, read, weights
from tracewise.llm.shared import materialise, may_hold, small_batches, without

LEAST_SCORE = 0.3  #: mean marginal of the language from which a document stays; low, as few words say little
SHARE = 0.8  #: of the tokens that reach the mix


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language of LEAST_SCORE stay; lang becomes the predicted one. Rows stay where they
    are, repeated ones and those without an id too."""
    small_batches(spark)
    model = language.train(docs.where(fold("doc_id", 4) != 2))
    found = docs.select(F.struct(*docs.columns).alias("row"), language.labeller(model).alias("found"))
    found = found.where((F.col("found.lang_pred") != "und") & (F.col("found.score") >= LEAST_SCORE))
    return found.select(*(F.col("found.lang_pred").alias(c) if c == "lang" else F.col("row")[c].alias(c) for c in docs.columns))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of quality 1 stay."""
    model = quality.train(docs.where(fold("doc_id", 5) != 0), read(spark, sf_dir, "labels"))
    return docs.where(quality.scorer(model) >= quality.SCORE_AT_THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates stays; of its repeated rows with equal words, one."""
    found = materialise(minhash.near_duplicates(docs), "near")
    docs = without(docs, found.where("not kept"), "doc_id")
    repeated = materialise(found.where("kept").groupBy("doc_id").count().where("count > 1"), "repeated")
    if repeated.isEmpty():
        return docs
    maybe, clear = may_hold(docs, repeated, "doc_id")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.trim(F.regexp_replace(F.translate("text", upper, upper.lower()), r"[\x09-\x0D ]+", " "))
    return clear.unionByName(maybe.withColumn("_words", F.sha2(words, 256)).dropDuplicates(["doc_id", "_words"]).drop("_words"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A share of the tokens by the weights of domains, languages and sources; no document twice."""
    rows = docs.select("doc_id", "lang", "source", domain().alias("domain"), n_words().alias("tokens"))
    rows = materialise(rows, "sizes")
    total = rows.agg(F.sum("tokens")).first()[0] or 0
    given = [weights(spark, DOMAIN_WEIGHTS, "domain"), weights(spark, LANG_WEIGHTS, "lang"), None]
    chosen = mixing.mix(rows, int(total * SHARE), given, ["domain", "lang", "source"], "tokens", SEED, 1)
    return without(docs, rows.join(chosen, "doc_id", "left_anti"), "doc_id")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and a digest of the text that they decode to."""
    out = pieces.encode_texts(docs, model_path())
    return out.select("doc_id", "n_tokens", "ids", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", identify_language),
    ("quality classifier", classify_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("SentencePiece", encode),
]
#: Learned models and approximate candidates are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
