"""Min-max hashing, SentencePiece, language, quality and HTML against brute force, round trips and held-out rows."""

import hashlib
import zlib

import numpy as np
import pandas as pd
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tracewise.llm import html, language, minhash, pieces, quality
from tracewise.llm.queries import QUERIES, model_path
from tracewise.llm.shared import connected_components

SF = "/root/testdata/sf0.01"
DOC = "doc_id long, text string"


def table(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def exact_components(texts, size, percent):
    """id -> (set size, smallest id reachable)."""
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    p, q = sorted((top(a), top(b)))
                    root[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vocabulary = np.array([f"w{i}" for i in range(400)])
    texts, n = {}, 0
    for _ in range(12):  # groups whose members lie on both sides of the threshold
        base = rng.choice(vocabulary, 120)
        for _ in range(rng.integers(1, 14)):
            own = base.copy()
            own[rng.random(120) < rng.random() * 0.09] = "other"
            texts[n] = " ".join(own)
            n += 1
    texts |= {1000: None, 1001: "", 1002: " \t\n", 1003: "One two", 1004: "one  TWO", 1005: "one", 1006: "É a b c", 1007: "é a b c", 1008: "a\u00a0b c d e", 1009: "a b c d e", 1010: "x " * 30_000, 1011: "X " * 30_001}
    for size in (4, 5):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), DOC), size).collect()}
        assert got == exact_components(texts, size, 80)


def test_blocks_of_a_large_bucket_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    rng = np.random.default_rng(2)
    base = np.array([f"w{i}" for i in range(100)])
    texts = {}
    for i in range(40):
        own = base.copy()
        own[rng.integers(0, 100, 2)] = f"x{i}"
        texts[i] = " ".join(own)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(spark.createDataFrame(list(texts.items()), DOC), 4).collect()}
    assert got == exact_components(texts, 4, 80)


def test_near_duplicates_of_odd_tables(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    clash = spark.createDataFrame([(1, "a b c d e f", "x", 1), (2, "a b c d e f", "y", 2), (None, "a b", "z", 3)], "doc_id long, text string, bucket string, bands int")
    got = {r["doc_id"]: r for r in minhash.near_duplicates(clash).collect()}
    assert (got[2]["component_id"], got[2]["kept"], got[1]["kept"]) == (1, False, True)
    assert got[None]["component_id"] is None and got[None]["kept"] is None


def test_repeated_rows_do_not_hide_a_bucket(spark, monkeypatch):
    base = [f"w{i}" for i in range(100)]
    texts = {i: " ".join([*base[: 20 * n + 9], "other", *base[20 * n + 10 :]]) for n, i in enumerate((1, 2, 3, 9))}
    who = {int(minhash.shingles(minhash.words(t), 5).sum()): i for i, t in texts.items()}
    assert len(who) == 4
    count = minhash.BANDS

    def two_buckets(found):
        i = who[int(found.sum())]
        keys = np.arange(count, dtype=np.uint64) + np.uint64(1000 * i)
        keys[0], keys[1] = 1 if i != 3 else keys[0], 2 if i != 2 else keys[1]
        return keys

    monkeypatch.setattr(minhash, "band_keys", two_buckets)
    docs = spark.createDataFrame(list(texts.items()), DOC)
    got = minhash.near_duplicates(docs.unionByName(docs)).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(i, 1) for i in (1, 1, 2, 2, 3, 3, 9, 9)]


def test_one_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "A b c d  e f"), (3, "x y"), (4, "")], DOC)
    for table_ in (docs, docs.unionByName(docs).unionByName(spark.createDataFrame([(3, "X  y")], DOC))):
        got = corpus_pipeline.drop_near_duplicates(spark, table_, "").collect()
        assert sorted(r["doc_id"] for r in got) == [1, 3, 4]


def test_query_equals_brute_force(spark):
    got = QUERIES["op4_minhash"](spark, "/root/testdata/sf0.001").toPandas()
    d = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    want = exact_components(dict(zip(d.doc_id, d.text)), 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_components_of_long_paths(spark):
    path = [(i, i + 1) for i in range(0, 60)] + [(100, 99), (7, 7)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {99: 99, 100: 99}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


LIBRARY = sentencepiece.SentencePieceProcessor(model_file=model_path())
TABLE = pieces.ChunkTable(model_path(), limit=5000)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab c▁\n\t.é漢😀\u00a0\x00<s>12"), max_size=40) | st.text(max_size=30))
def test_pieces_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    assert TABLE.encode(text) == LIBRARY.encode(text)


def test_encode_texts(spark):
    texts = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "a ▁b"), (6, "word " * 30_000), (7, "x" * 20_000), (6, "again"), (None, "no id")]
    got = pieces.encode_texts(spark.createDataFrame([(*t, "z") for t in texts], "doc_id long, text string, ids string"), model_path()).collect()
    want = sorted((str(i), LIBRARY.encode(t or ""), LIBRARY.decode(LIBRARY.encode(t or "")) if t else "") for i, t in texts)
    assert sorted((str(r["doc_id"]), list(r["ids"]), r["decoded"]) for r in got) == want
    assert all(r["ids_sha256"] == hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() for r in got)
    assert pieces.encode_texts(spark.createDataFrame([], DOC), model_path()).count() == 0


def test_models_with_crossing_pieces_are_refused():
    assert pieces.separable(["▁▁a", "b", "▁"]) and not pieces.separable(["a▁b"]) and not pieces.separable(["a▁"])


def folded(ids, n):
    return np.array([zlib.crc32(str(i).encode()) % n for i in ids])


def test_language_held_out(spark):
    d, got = table("documents"), QUERIES["op7_language"](spark, SF).toPandas()
    assert len(got) == len(d)
    both = d.merge(got, on="doc_id")
    assert (both.held_out == (folded(both.doc_id, 4) == 2)).all()
    held = both[both.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.98 and both.score.between(0, 1).all()


def test_language_marks_switches_and_odd_texts(spark):
    d = table("documents").query("lang in ('en', 'de')")
    model = language.fit(d.text.head(150).tolist(), d.lang.head(150).tolist())
    langs, score = model.predict([None, "", "123 ---", "the of and the with", "der die und das ist", "漢字"])
    assert langs[:3] == ["und"] * 3 and (score[:3] == 0).all() and langs[3:5] == ["en", "de"] and langs[5] in ("en", "de")
    mixed = "the of and with that this " * 5 + "der die und das ist nicht " * 5
    text, p = model.words([mixed])
    best = p.argmax(axis=1)
    assert (best[:25] == 1).all() and (best[-25:] == 0).all()
    empty = spark.createDataFrame([], DOC)
    assert language.predict_texts(empty, model).count() == 0
    none = language.train(spark.createDataFrame([(1, "x", None)], "doc_id long, text string, lang string"))
    assert none.predict(["abc"])[0] == ["und"]


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    k, n = 3, 60
    emission, trans = rng.normal(size=(n, k)).astype(np.float32), rng.normal(size=(k, k)).astype(np.float32)
    text = np.repeat([0, 1, 2], [1, 2, 57])
    got, pairs = language.marginals(emission, text, trans, expect=True)
    want, expected = [], np.zeros((k, k))
    for t in range(3):
        e, m = np.exp(emission[text == t].astype(float)), np.exp(trans.astype(float))
        alpha, beta = [np.ones(k) @ m * e[0]], [np.ones(k)]
        for i in range(1, len(e)):
            alpha.append(alpha[-1] @ m * e[i])
            beta.append(m @ (e[-i] * beta[-1]))
        beta = beta[::-1]
        z = alpha[-1].sum()
        want += [a * b / z for a, b in zip(alpha, beta)]
        for i in range(1, len(e)):
            expected += alpha[i - 1][:, None] * m * (e[i] * beta[i])[None] / z
    assert np.allclose(got, want, atol=1e-4) and np.allclose(pairs, expected, atol=1e-2)


def test_quality_held_out(spark):
    labels, got = table("labels"), QUERIES["op10_quality"](spark, SF).toPandas()
    both = labels.merge(got, on="doc_id")
    assert len(got) == 1000 and (both.held_out == (folded(both.doc_id, 5) == 0)).all()
    held = both[both.held_out]
    assert (held.quality == held.predicted).mean() > 0.95 and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()


def test_quality_of_odd_texts(spark):
    assert quality.features(None).shape == quality.features("x " * 100_000).shape == (quality.N_FEATURES,)
    assert np.isfinite(quality.features("\n \n")).all()
    flat = quality.fit(np.ones((3, quality.N_FEATURES)), np.array([1, 1, 1]))
    rows = spark.createDataFrame([(1, None), (1, None), (2, "")], DOC)
    assert [r["score"] for r in quality.score_texts(rows, flat).collect()] == [0.5] * 3
    empty = quality.train(rows.limit(0), spark.createDataFrame([], "doc_id long, quality int"))
    assert quality.score_texts(rows, empty).count() == 3


def test_quality_threshold_does_not_depend_on_the_sample(spark):
    rng = np.random.default_rng(3)
    bad = np.arange(4000) % 10 == 0
    upper = np.clip(rng.normal(np.where(bad, 14, 20), 6), 1, 39).astype(int)
    docs = spark.createDataFrame([(i, "A" * int(k) + "b" * (40 - int(k))) for i, k in enumerate(upper)], DOC)
    labels = spark.createDataFrame([(i, int(not b)) for i, b in enumerate(bad)], "doc_id long, quality int")
    for rows in (300, 10_000):
        scored = quality.score_texts(docs, quality.train(docs, labels, rows))
        assert 0.05 < scored.where("predicted = 0").count() / 4000 < 0.16
    at = quality.N_FEATURES - 4
    assert quality.features("x " * 20_000)[at] != quality.features("x " * 20_000 + "y" * 500)[at]


PAGE = """<html><head><title>T</title><script>x('</p>')</script></head><body><header>Site</header><nav><ul><li><a href=/a>A long menu entry here</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site and so on and so on, for a very long time.</div><article><h1>Head &amp; line</h1><p>First  par<b>agraph</b>
 with &lt;tags&gt; &#233;.<p>No.<br>Second<div class="ad-box ad">Buy this now, all of you</div><form><input> Search here</form><p>Last one.</p></article>
<aside>Related stories that are long enough to be taken for text by their length alone.</aside><div id="comments"><p>I liked the article a lot, thank you for it.</p></div><footer>&copy; me</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == "Head & line\nFirst paragraph with <tags> é.\nNo.\nSecond\nLast one."
    assert html.main_text(None) == html.main_text("") == html.main_text("<!-- open") == html.main_text("<script>x") == ""
    wrapped = '<body class="no-sidebar"><div class="page with-sidebar menu"><article><div class="entry-header"><h1>H</h1></div><p>Text.</p><p hidden>No</p><p style="display: none">No</p></article></div></body>'
    assert html.main_text(wrapped) == "H\nText."
    body = "<div>" + "A sentence of some length that says a thing or two. " * 3 + "</div>"
    plain = f"<ul><li><a href=x>Home</a></li><li><a href=y>About</a></li></ul>{body}<div>Short.</div>{body}<div><a href=z>Next page of this</a></div>"
    got = html.main_text(plain).split("\n")
    assert len(got) == 3 and got[1] == "Short."


def test_extract_pages(spark):
    rows = spark.createDataFrame([(1, "u", PAGE, 1), (1, "u", PAGE, 2), (None, None, None, 3), (2, "v", "<p>" * 50_000, 4), (3, "w", "<article>" + "<p>word</p>" * 20_000, 5)], "page_id long, url string, html string, text int")
    got = html.extract_pages(rows).collect()
    assert len(got) == 5 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert next(r for r in got if r["page_id"] == 3)["text"].count("\n") == 19_999
    assert html.extract_pages(rows.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["nav", "footer", "aside", "form"])
def test_articles_of_the_pages_come_whole(spark, name):
    pages = table("pages")
    for page in pages.html.head(60):
        text = html.main_text(page)
        assert f"<{name}" not in text and "track(" not in text
        article = page[page.index("<article>") : page.index("</article>")]
        last = article.rsplit("<p>", 1)[-1].split("<")[0]
        assert "&" in last or text.endswith(" ".join(last.split()))
