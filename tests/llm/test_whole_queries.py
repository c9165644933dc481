"""Whole results of queries that SQL cannot express, and of the pipeline's stages, against plain versions of them."""

import hashlib
import zlib
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_text_operators import exact_components
from tracewise.llm import html, language, mixing, quality
from tracewise.llm.queries import QUERIES, SEED, domain, model_path, n_words, weights
from tracewise.llm.shared import BATCH_BYTES, small_batches

SF = "/root/testdata/sf0.001"


def table(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def brute_spans(length, surge, window):
    """Line by line: the sum of the window that starts there; runs of lines with sums; surges decide."""
    n = len(length)
    sums = [sum(length[i : i + window]) for i in range(n)]
    keep, run = [False] * n, []
    for i in range(n + 1):
        if i < n and sums[i] > 0:
            run.append(i)
            continue
        heavy = [j for j in run if length[j]]
        if run and max(sums[j] for j in run) >= surge and heavy:
            for j in range(heavy[0], heavy[-1] + 1):
                keep[j] = True
        run = []
    return keep


def test_spans_equal_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        length = rng.integers(0, 80, rng.integers(0, 30))
        length = np.where(rng.random(len(length)) < 0.6, 0, length).astype(float)
        for surge in (1, 60):
            assert html.spans(length, surge, 3).tolist() == brute_spans(length.tolist(), surge, 3)


def test_pages_without_article_tags_give_the_same_text():
    """The method alone, with no element that marks the article, finds what it finds with it."""
    pages = pd.read_parquet("/root/testdata/sf0.01/pages.parquet").html
    bare = pages.str.replace("<article>", "<div>").str.replace("</article>", "</div>")
    assert all(html.main_text(a) == html.main_text(b) for a, b in zip(pages, bare))


def test_line_blocks_decide(monkeypatch):
    menu = "".join(f"<li><a href=/{i}>Entry number {i}</a></li>" for i in range(6))
    page = f"<article><h1><a href=/>Title</a></h1><p>The text says a thing.</p><p>And <a href=x>another</a> one.</p><ul>{menu}</ul></article>"
    plain = f"<div>{menu}</div><p>{'The text says a thing or two. ' * 4}</p><div>{menu}</div>"
    assert html.main_text(page) == "Title\nThe text says a thing.\nAnd another one."
    assert html.main_text(plain) == ("The text says a thing or two. " * 4).strip()
    assert html.main_text("<p>Short.</p>") == "Short."
    monkeypatch.setattr(html, "spans", lambda length, *_: np.ones(len(length), bool))
    assert "Entry number 3" in html.main_text(page) and "Entry number 3" in html.main_text(plain)


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article><p class="ad">Buy<p>Real text.</article>', "Real text."), ('<article><ul><li class="promo">Buy<li>One<li>Two</ul></article>', "One\nTwo"),
        ('<div><div class="ad">Buy <b>this</div><p>Text of the page.</p></div>', "Text of the page."), ('<article><span class="ad">Buy</span> Text.</article>', "Text."),
        ('<article><div><p class="ad">Buy</div>Rest.</article>', "Rest."), ('<article><table><tr><td class="ad">Buy<td>Cell<tr><td>Next</table></article>', "Cell\nNext"),
        ('<article><div class="ad"><div>Buy</div> more</div>Text.</article>', "Text."), ('<article><dl><dt class="promo">Buy<dd>Said</dl></article>', "Said"),
    ],
)
def test_dropped_elements_end_where_html_ends_them(page, text):
    assert html.main_text(page) == text


class PlainReader(HTMLParser):
    """Blocks of the article with the standard library's parser: (text, characters outside links)."""

    def __init__(self, page):
        super().__init__()
        self.found, self.parts, self.inside, self.skip, self.linked = [], [], False, 0, 0
        self.feed(page or "")
        self.close()
        self.end()

    def end(self):
        text = " ".join("".join(t for t, _ in self.parts).split())
        if text and self.inside:
            self.found.append((text, len("".join(t for t, linked in self.parts if not linked).split())))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.end()
        self.inside |= tag == "article"
        self.skip += tag in ("script", "style")
        self.linked += tag == "a"

    def handle_endtag(self, tag):
        if tag not in ("a", "b", "i", "em", "strong", "span"):
            self.end()
        self.inside &= tag != "article"
        self.skip -= tag in ("script", "style")
        self.linked -= tag == "a"

    def handle_data(self, data):
        if not self.skip:
            self.parts.append((data, self.linked))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op3_query(spark, sf):
    """Every page, against another parser; lines of the article are cut at window sums of nothing, as brute_spans does."""
    folder = f"/root/testdata/{sf}"
    got, pages = QUERIES["op3_html"](spark, folder).toPandas(), pd.read_parquet(f"{folder}/pages.parquet")
    want = {}
    for r in pages.itertuples():
        found = PlainReader(r.html).found
        keep = brute_spans([plain for _, plain in found], 1, 3)
        want[r.page_id] = r.url, "\n".join(t for (t, _), k in zip(found, keep, strict=True) if k)
    assert len(got) == len(pages) and all((r.url, r.text) == want[r.page_id] and r.n_chars == len(r.text) for r in got.itertuples())


_MENU = "".join(f"<li><a href=/{i}>Entry number {i}</a></li>" for i in range(6))
_SAID = "The text says a thing or two. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        # Links: a lone linked paragraph is text, an unclosed link ends with its line, a list of links is the article if there is no more.
        ("<article><p><a href=x>See the full report.</a></p><p>Text.</p><p><a href=y>More</a></p></article>", "See the full report.\nText.\nMore"),
        ("<article><p>One <a href=x>y</p><p>The rest of it.</p><p>More.</p><p>And more.</p></article>", "One y\nThe rest of it.\nMore.\nAnd more."),
        ("<article>One <a href=x>y<p>The rest.<p>And <a href=z>more</a>.</article>", "One y\nThe rest.\nAnd more."),
        ("<article><p>One <a href=x>y</p></a><p>Two.</article>", "One y\nTwo."),
        ("<article><ul><li><a href=1>a</a><li><a href=2>b</a><li><a href=3>c</a></ul></article>", "a\nb\nc"),
        # Names: with words of their own they are the text's.
        ('<article><p class="search-tips">Tips.</p><div class="notice-board">Board.</div><p id="comments-on-budget">Budget.</p></article>', "Tips.\nBoard.\nBudget."),
        ('<article><div class="ad-box">Buy</div><p>Text.</p><div class="related-posts">More</div><section id="comments-area2">Nice!</section></article>', "Text."),
        ('<div class="search-box">Find</div><p class="header-note">Noted.</p>', "Noted."),
    ],
)
def test_links_and_names(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div>{_MENU}</div><p>{_SAID}</p><div>{_MENU}</div>", _SAID.strip()), (f"<p>{_SAID}</p><p>Short.</p><ul>{_MENU}</ul><p>Imprint.</p>", f"{_SAID.strip()}\nShort."),
        (f"<p>Top</p><ul>{_MENU}</ul><p>{_SAID}</p><p><a href=x>Linked</a></p><p>{_SAID}</p>", f"{_SAID.strip()}\nLinked\n{_SAID.strip()}"),
        (f"<article><p>One.</p><ul>{_MENU}</ul><p>Two.</p></article>", "One.\nTwo."),
    ],
)
def test_windows_decide_where_no_name_does(monkeypatch, page, text):
    assert html.main_text(page) == text
    monkeypatch.setattr(html, "spans", lambda length, *_: np.ones(len(length), bool))
    assert "Entry number 3" in html.main_text(page)


def test_op8_query_equals_the_library(spark):
    sp, docs = sentencepiece.SentencePieceProcessor(model_file=model_path()), table("documents")
    want = {}
    for r in docs.itertuples():
        ids = sp.encode(r.text or "")
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        want[r.doc_id] = (len(ids), digest(",".join(map(str, ids))), digest(sp.decode(ids) if ids else ""))
    got = QUERIES["op8_sentencepiece"](spark, SF).toPandas()
    assert len(got) == len(docs) and {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.itertuples()} == want


def folded(ids, n):
    return np.array([zlib.crc32(str(i).encode()) % n for i in ids])


def test_op7_query_equals_one_text_at_a_time(spark):
    docs = table("documents")
    got = QUERIES["op7_language"](spark, SF).toPandas().set_index("doc_id")
    taught = docs[(folded(docs.doc_id, 4) != 2) & docs.lang.notna() & docs.text.notna()].sort_values("doc_id")
    assert taught.lang.value_counts().max() < language.TRAIN_DOCS
    model = language.fit(taught.text.tolist(), taught.lang.tolist())
    for r in docs.itertuples():
        lang, score = model.predict([r.text])
        assert got.lang_pred[r.doc_id] == lang[0] and abs(got.score[r.doc_id] - score[0]) < 1e-3 and got.held_out[r.doc_id] == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_op10_query_equals_one_text_at_a_time(spark):
    docs, labels = table("documents"), table("labels").dropna(subset=["quality"])
    got = QUERIES["op10_quality"](spark, SF).toPandas().set_index("doc_id")
    taught = docs[folded(docs.doc_id, 5) != 0].merge(labels[["doc_id", "quality"]], on="doc_id").sort_values("doc_id")
    model = quality.fit(np.array([quality.features(t) for t in taught.text]), taught.quality.to_numpy(), weight=np.ones(len(taught)))
    for r in docs.itertuples():
        score = model.score(quality.features(r.text)[None])[0]
        assert abs(got.score[r.doc_id] - score) < 1e-6 and got.predicted[r.doc_id] == int(got.score[r.doc_id] >= 0.3)


def test_the_lower_of_several_labels_counts(spark):
    docs = spark.createDataFrame([(i, ("good text here " if i % 2 else "$$$ !!! ") * 5, "x") for i in range(40)], "doc_id long, text string, quality string")
    labels = [(i, i % 2) for i in range(40)] + [(1, 0), (3, 0), (None, 1)]
    once = spark.createDataFrame([(i, 0 if i in (1, 3) else i % 2) for i in range(40)], "doc_id long, quality int")
    many = spark.createDataFrame(labels, "doc_id long, quality int")
    a, b = quality.train(docs, many), quality.train(docs, once)
    assert np.allclose(a.w, b.w) and a.offset == b.offset


def test_pipeline_equals_plain_stages(spark):
    """Each stage's rows against a plain version over what its predecessor kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.toPandas()

    taught = rows[(folded(rows.doc_id, 4) != 2) & rows.lang.notna() & rows.text.notna()].sort_values("doc_id")
    model = language.fit(taught.text.tolist(), taught.lang.tolist())
    langs, scores = model.predict(rows.text.tolist())
    keep = [x != "und" and s >= corpus_pipeline.LEAST_SCORE for x, s in zip(langs, scores)]
    want = {i: x for i, x, k in zip(rows.doc_id, langs, keep) if k}
    docs = corpus_pipeline.identify_language(spark, docs, SF)
    assert docs._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1  # each text is labelled once
    docs = docs.persist()
    assert {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()} == want

    rows, labels = docs.toPandas(), table("labels").dropna(subset=["quality"])
    taught = rows[folded(rows.doc_id, 5) != 0].merge(labels[["doc_id", "quality"]], on="doc_id").sort_values("doc_id")
    ranker = quality.fit(np.array([quality.features(t) for t in taught.text]), taught.quality.to_numpy(), weight=np.ones(len(taught)))
    score = ranker.score(np.array([quality.features(t) for t in rows.text]))
    docs = corpus_pipeline.classify_quality(spark, docs, SF).persist()
    assert {r[0] for r in docs.select("doc_id").collect()} == set(rows.doc_id[score >= quality.SCORE_AT_THRESHOLD])

    rows = docs.toPandas()
    component = exact_components(dict(zip(rows.doc_id, rows.text)), 5, 80)
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, SF).persist()
    assert {r[0] for r in docs.select("doc_id").collect()} == {i for i, (_, c) in component.items() if c == i}

    rows = docs.select("doc_id", "lang", "source", domain().alias("domain"), n_words().alias("tokens")).toPandas()
    total = int(rows.tokens.sum() * corpus_pipeline.SHARE)
    leaves = spark.createDataFrame(rows.groupby(["domain", "lang", "source"], as_index=False).tokens.sum())
    given = [weights(spark, w, c) for w, c in ((corpus_pipeline.DOMAIN_WEIGHTS, "domain"), (corpus_pipeline.LANG_WEIGHTS, "lang"))]
    budget = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(leaves, total, [*given, None], ["domain", "lang", "source"], 1).collect()}
    chosen = set()
    for leaf, part in rows.groupby(["domain", "lang", "source"]):
        before, whole = 0, budget[leaf] >= part.tokens.sum()
        for i, n in sorted(zip(part.doc_id, part.tokens), key=lambda x: (hashlib.md5(f"{SEED}|0|{x[0]}".encode()).hexdigest(), x[0])):
            if n and (whole or before < budget[leaf]):
                chosen.add(i)
            before += n
    docs = corpus_pipeline.mix_sources(spark, docs, SF).persist()
    assert {r[0] for r in docs.select("doc_id").collect()} == chosen

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rows = docs.toPandas()
    got = {r["doc_id"]: list(r["ids"]) for r in corpus_pipeline.encode(spark, docs, SF).collect()}
    assert got == {r.doc_id: sp.encode(r.text) for r in rows.itertuples()}


def test_pipeline_of_an_empty_table_and_repeated_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    empty, twice = docs.limit(0), docs.unionByName(docs)
    ids = None
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0, name
        twice = stage(spark, twice, SF).persist()
        found = [r[0] for r in twice.select("doc_id").collect()]
        ids = set(found)
        if name in ("language ID", "quality classifier"):
            assert len(found) == 2 * len(ids)
        else:
            assert len(found) == len(ids) > 0, name


def test_arrow_batches_are_bounded_by_bytes(spark):
    docs = spark.range(0, 40, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 1 << 20).alias("text"))
    small_batches(spark)
    sizes = docs.mapInPandas(lambda batches: (pd.DataFrame({"n": [b.text.str.len().sum()]}) for b in batches), "n long").toPandas().n
    assert sizes.sum() == 40 << 20 and sizes.max() <= BATCH_BYTES + (1 << 20)
