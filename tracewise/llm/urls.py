"""URL filters: given rules by host and path, and association rules mined from labelled URLs.

Spark's FP-growth mines combinations of URL tokens that come with a label, from all frequent tokens of all labelled URLs.
Rules are pruned by support, confidence and lift, and filed in an inverted index under their rarest token; a URL looks up its
tokens there and keeps the rules whose tokens it all has.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import materialise

SUPPORT, LEAST_ROWS, CONFIDENCE = 0.004, 12, 0.65
LIFT = 1.1  #: by which a rule's confidence has to exceed the share of its verdict; else it says what is known without it
BROADCAST_RULES, BROADCAST_CHARS = 50_000, 8_000_000  #: rules or tokens of at most this number and length are broadcast
LABEL = "label="

GIVEN = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column, host: Column, path: Column) -> Column:
    """The host and each of its labels, the shape of each path segment by its place (digits as 0), extension, the name of
    each query parameter, query, fragment and scheme. The whole URL is read."""
    shape = lambda s: F.regexp_replace(s, "[0-9]+", "0")
    some = lambda parts: F.filter(parts, lambda x: x != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    found = F.concat(
        F.array(F.concat(F.lit("host="), host)),
        F.transform(some(F.split(host, r"\.")), lambda x: F.concat(F.lit("label:"), x)),
        F.transform(some(F.split(path, "/")), lambda x, i: F.concat(F.lit("path"), i.cast("string"), F.lit("="), shape(x))),
        F.transform(some(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))), lambda x: F.concat(F.lit("query:"), shape(x))),
        F.array(
            F.concat(F.lit("ext="), F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)),
            F.when(url.contains("?"), "query"), F.when(url.contains("#"), "fragment"),
            F.concat(F.lit("scheme="), F.substring_index(url, "://", 1)),
        ),
    )
    return F.array_sort(F.array_distinct(F.filter(found, lambda x: x.isNotNull() & ~x.isin("host=", "ext="))))


def _small(rows: DataFrame, text: Column) -> bool:
    """Whether rows may be broadcast, by their number and that of their characters."""
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.char_length(text)), F.lit(0))).first()
    return n <= BROADCAST_RULES and chars <= BROADCAST_CHARS


def filed(rules: DataFrame) -> DataFrame:
    """rules, each with `token`, that of its needs which the fewest rules share."""
    each = rules.select("needs", F.explode("needs").alias("token")).distinct()
    spread = each.groupBy("token").agg(F.count("*").alias("spread"))
    under = each.join(spread, "token").groupBy("needs").agg(F.min_by("token", F.struct("spread", "token")).alias("token"))
    index = materialise(rules.join(under, "needs"), "index")
    return F.broadcast(index) if _small(index, F.concat_ws(" ", "needs")) else index


def meeting(rows: DataFrame, index: DataFrame) -> DataFrame:
    """rows (tokens and others) with the columns of each rule of the index all of whose needs are among their tokens."""
    return rows.select("*", F.explode("tokens").alias("token")).join(index, "token").where(F.size(F.array_except("needs", "tokens")) == 0).drop("token")


def frequent_items(token: DataFrame, least: float) -> DataFrame:
    """(item, tokens) of the tokens in `least` rows or more; token: row (distinct numbers), token, each once a row.

    Tokens that the very same rows hold, such as the parts of one host, are one item, named by the first of them: a
    combination with two of them says what it says with one. Sets of rows are compared by their sizes and 128 bits.
    """
    of = token.groupBy("token").agg(F.count("*").alias("rows"), F.expr("bit_xor(xxhash64(row))").alias("x"), F.expr("bit_xor(xxhash64(row, 'y'))").alias("y"))
    same = of.where(F.col("rows") >= least).groupBy("rows", "x", "y").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return same.select(F.element_at("tokens", 1).alias("item"), "tokens")


def mine_rules(labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, least_rows: int = LEAST_ROWS, lift: float = LIFT) -> DataFrame:
    """(needs array<string>, verdict, confidence, support) from rows of tokens and verdict (block or allow).

    A rule holds in `support` of the rows and in `least_rows` at least, is as sure as `confidence` and surer than the share
    of its verdict by `lift`. Of two rules for one verdict of which one needs all that the other needs, only the shorter
    is kept unless the longer is surer. All combinations of all frequent tokens are candidates, and all rows are counted;
    no combination is lost by its length or its tokens' number. No rows give no rules.
    """
    spark = labelled.sparkSession
    rows = labelled.where("verdict is not null").select(F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), "verdict")
    rows = materialise(rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "labelled-urls")  # as counting costs more than reading
    sizes = {r["verdict"]: r["count"] for r in rows.groupBy("verdict").count().collect()}
    n = sum(sizes.values())
    if not n:
        return spark.createDataFrame([], "needs array<string>, verdict string, confidence double, support double")
    least = max(support * n, least_rows)
    token = rows.select("row", "verdict", F.explode("tokens").alias("token"))
    items = materialise(frequent_items(token, least), "items")
    item_of = items.select("item", F.explode("tokens").alias("token"))
    # As many as a URL has tokens, divided by the support, at most.
    if _small(item_of, F.col("token")):
        item_of = F.broadcast(item_of)
    baskets = token.join(item_of, "token").groupBy("row", "verdict").agg(F.concat(F.collect_set("item"), F.array(F.concat(F.lit(LABEL), "verdict"))).alias("items"))
    baskets = materialise(baskets.select("items"), "baskets")
    if not (held := baskets.count()):
        return spark.createDataFrame([], "needs array<string>, verdict string, confidence double, support double")
    # Half a row less, as FP-growth rounds the product of share and rows up.
    sets = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / held)).fit(baskets).freqItemsets
    is_label = lambda x: x.startswith(LABEL)
    needs = F.array_sort(F.filter("items", lambda x: ~is_label(x)))
    verdict = F.substring(F.get(F.filter("items", is_label), 0), len(LABEL) + 1, 1 << 30)
    sets = materialise(sets.select(needs.alias("needs"), verdict.alias("verdict"), F.col("freq").alias("rows")).where(F.size("needs") > 0), "frequent-sets")
    # What holds with a label often enough does so without it, so both counts are there.
    rules = sets.where("verdict is not null").join(sets.where("verdict is null").select("needs", F.col("rows").alias("all")), "needs")
    of_all = F.create_map(*[F.lit(x) for v, m in sizes.items() for x in (v, m / n)])
    rules = rules.select("needs", "verdict", (F.col("rows") / F.col("all")).alias("confidence"), (F.col("rows") / n).alias("support"))
    rules = materialise(rules.where((F.col("confidence") >= confidence) & (F.col("confidence") >= lift * of_all[F.col("verdict")])), "rules")
    longer = rules.where(F.size("needs") > 1).select(F.col("needs").alias("tokens"), F.col("verdict").alias("v"), F.col("confidence").alias("c"))
    idle = meeting(longer, filed(rules)).where((F.col("verdict") == F.col("v")) & (F.size("needs") < F.size("tokens")) & (F.col("confidence") >= F.col("c")))
    idle = idle.select(F.col("tokens").alias("needs"), "verdict").distinct()
    return _of_tokens(rules.join(idle, ["needs", "verdict"], "left_anti"), items)


def _of_tokens(rules: DataFrame, items: DataFrame) -> DataFrame:
    """rules of items as rules of tokens: one for each choice of a token of each item."""
    each = rules.select("needs", F.explode("needs").alias("item")).distinct().join(items, "item")
    choices = each.groupBy("needs").agg(F.collect_list("tokens").alias("choices"))
    none = F.array(F.array().cast("array<string>"))
    chosen = F.aggregate("choices", none, lambda have, more: F.flatten(F.transform(have, lambda h: F.transform(more, lambda t: F.concat(h, F.array(t))))))
    by_needs = choices.select("needs", F.explode(chosen).alias("chosen"))
    return rules.join(by_needs, "needs").select(F.array_sort("chosen").alias("needs"), "verdict", "confidence", "support")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """urls (url, tokens; each url once) -> (url, mined verdict, confidence) of the best rule that each meets: the surest,
    then the best supported, then the one with more tokens, then the first by its tokens."""
    rank = F.struct("confidence", "support", F.size("needs").alias("size"), F.concat_ws(" ", "needs").alias("by"))
    return meeting(urls.select("url", "tokens"), filed(rules)).groupBy("url").agg(F.max_by("verdict", rank).alias("mined"), F.max("confidence").alias("confidence"))


def given_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """struct<verdict,rule> of the longest rule that fits, or null: host equal or a subdomain, path with that prefix."""
    best = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        hit = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))
        best = F.when(hit, value) if best is None else best.when(hit, value)
    return best


def judge_urls(pages: DataFrame, labels: DataFrame, given: tuple[tuple[str, str, str], ...] = GIVEN, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) for every row of pages (page_id, url).

    labels: page_id and verdict (block or allow), of any number of pages; all of them are mined. verdict: the given
    rule's, else the best mined rule's, else `default`. Null urls and such without :// have an empty host and path and
    no mined rule. Repeated rows give repeated results; null ids stay; a page labelled twice counts twice. URLs of any
    length are read whole. Empty pages give an empty result; empty labels no mined rule. Other columns are not read.
    """
    url = F.col("url")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    # URLs are judged once each, so that a common one costs a row.
    urls = rows.where("url like '%://%'").select("url").distinct().withColumn("host", host_of(url)).withColumn("path", path_of(url))
    urls = urls.withColumn("tokens", tokens(url, F.col("host"), F.col("path"))).select("url", "tokens")
    # A stated number of partitions, so that few bytes do not meet in one task; matching costs more than reading.
    urls = materialise(urls.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")), "url"), "urls")
    taught = rows.where("url like '%://%'").join(labels.select("page_id", "verdict"), "page_id")
    taught = taught.select(tokens(url, host_of(url), path_of(url)).alias("tokens"), "verdict")
    mined = match_rules(urls, mine_rules(taught))
    out = rows.join(mined, "url", "left").withColumn("host", host_of(url)).withColumn("path", path_of(url))
    out = out.withColumn("given", given_rule(F.col("host"), F.col("path"), given))
    return out.select(
        "page_id", "host", "path", F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "mined", F.lit(default)).alias("verdict"), "mined", "confidence",
    )
