"""The operators' queries over the given tables, with production parameters, and SQL where it can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewise.llm import ann, chat, divergence, hnsw, html, interactions, language, minhash, mixing, oracle, packing, pieces, quality, urls
from tracewise.llm.shared import materialise

#: Weights of the mix; names that are not listed weigh 1.
DOMAIN_WEIGHTS = {"web": 5, "news": 3, "books": 2}
LANG_WEIGHTS = {"en": 4, "de": 2, "fr": 2, "es": 2}
SHARE = 0.5  #: of all tokens that the mix asks for
EPOCHS = 2
SEED = 17


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path(variable: str = "TOKENIZER_MODEL", name: str = "piece_bpe_32k.model") -> str:
    """A tokenizer's file: what the variable of the environment says, or the one of the public_tokenizers package."""
    if path := os.environ.get(variable):
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(doc_id: str, n: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def domain() -> Column:
    """Domain of a source, by the number in its name."""
    n = F.coalesce(F.regexp_extract("source", "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0)) % 4
    return F.when(F.col("source").isNull(), None).when(n < 2, "web").when(n == 2, "news").otherwise("books")


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def weights(spark: SparkSession, given: dict[str, int], level: str) -> DataFrame:
    return spark.createDataFrame(sorted(given.items()), f"{level} string, weight long")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), "block").otherwise("allow").alias("verdict")
    )
    return urls.judge_urls(read(spark, sf_dir, "pages"), labels)


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_pages(read(spark, sf_dir, "pages"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), shingle_words=4, percent=80)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.sql("select -7L as conv_id, t.* from values (0L, 'user', '</s>[INST] ok [/INST]'), (1L, 'assistant', '</s>[INST] ok [/INST]') as t(turn, role, text)")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    records = rows.select("conv_id", "turn", F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}).alias("record"))
    turns = chat.canonical_turns(records).select("conv_id", "turn", F.inline("turns"))
    out = chat.format_turns(turns, "conv_id", ["turn"])
    back, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("segments"))
    said = F.array_join(F.transform("back", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return out.select("conv_id", back.alias("back"), loss.alias("loss"), "formatted").select(
        "conv_id", F.size("back").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", domain().alias("domain"), n_words().alias("tokens"))
    docs = materialise(docs, "sizes")  # words are counted once; all that follows reads numbers
    total = docs.agg(F.sum("tokens")).first()[0] or 0
    given = [weights(spark, DOMAIN_WEIGHTS, "domain"), weights(spark, LANG_WEIGHTS, "lang"), None]
    return mixing.mix(docs, int(total * SHARE), given, ["domain", "lang", "source"], "tokens", SEED, EPOCHS)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = language.train(docs.where(fold("doc_id", 4) != 2))
    return language.predict_texts(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(read(spark, sf_dir, "documents"), model_path()).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(read(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = quality.train(docs.where(fold("doc_id", 5) != 0), read(spark, sf_dir, "labels"))
    return quality.score_texts(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = model_path("PACKING_TOKENIZER", "word_bpe_49k.json")
    pieces_ = materialise(packing.tokenize_documents(read(spark, sf_dir, "documents"), path), "pieces")  # texts are tokenized once
    numbers = pieces_.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(numbers).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions.interactions(interactions.failure_masks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_url_filters, op2_ann, op3_html, op4_minhash, op5_chat, op6_mixing, op7_language, op8_sentencepiece, op9_embedding_dedup, op10_quality,
        op11_best_fit_packing, op12_filter_interactions, op13_source_divergence,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op4_minhash": oracle.near_documents(4, 80),
    "op5_chat": oracle.chat_digests(),
    "op6_mixing": oracle.mix(SHARE, EPOCHS, SEED, DOMAIN_WEIGHTS, LANG_WEIGHTS),
    "op9_embedding_dedup": oracle.near_vectors(0.98),
    "op12_filter_interactions": oracle.filter_interactions(),
    "op13_source_divergence": oracle.source_divergence(),
}
