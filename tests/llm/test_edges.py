"""Odd tables of the text operators, and the quality classifier against independent versions of its parts."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewise.llm import chat, language, pieces, quality
from tracewise.llm.queries import model_path

#: Names that the operators use inside, with values of other types.
NAMES = "key ids n_tokens decoded weight score x predicted lang_pred found row verdict tokens n_chars".split()


def clashes(df, **more):
    return df.withColumns({c: F.lit(f"not a {c}") for c in NAMES} | more)


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["the and of that this is the house", "der die und das ist nicht ein Haus", None, "", "123 456", "the of and", "the of and", "x" * 30_000]
    return spark.createDataFrame([(None if i == 1 else i, t, "de" if i == 1 else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")


def same_rows(a, b):
    assert a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_language_of_odd_tables(spark, docs):
    taught = [(i, ("the of and that " if i % 2 else "der die und nicht ") * 9, "en" if i % 2 else "de") for i in range(20)]
    model = language.train(clashes(spark.createDataFrame(taught, "doc_id long, text string, lang string")))
    got = language.predict_texts(clashes(docs), model)
    same_rows(got, language.predict_texts(docs, model))
    rows = got.collect()
    assert len(rows) == 8 and [r["lang_pred"] for r in rows if r["doc_id"] is None] == ["de"]
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (2, 3, 4)} == {"und"} and all(0 <= r["score"] <= 1 for r in rows)
    assert language.predict_texts(docs.limit(0), model).count() == 0
    untaught = language.train(docs.limit(0))
    assert {r["lang_pred"] for r in language.predict_texts(docs, untaught).collect()} == {"und"}


def test_pieces_of_odd_tables(docs):
    got = pieces.encode_texts(clashes(docs), model_path())
    same_rows(got, pieces.encode_texts(docs, model_path()))
    by_id = {r["doc_id"]: r for r in got.collect()}
    assert by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 0 and by_id[2]["decoded"] == "" and by_id[None]["decoded"].startswith("der die")
    assert pieces.encode_texts(docs.limit(0), model_path()).count() == 0


def test_quality_of_clashing_names(spark, docs):
    taught = spark.createDataFrame([(i, ("a good and long text " if i % 2 else "$$ !! %% ") * 5, "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    plain = quality.train(taught, labels)
    model = quality.train(clashes(taught), clashes(labels, text=F.lit("no text")))
    assert np.allclose(model.w, plain.w) and model.offset == plain.offset
    got = quality.score_texts(clashes(docs), model)
    same_rows(got, quality.score_texts(docs, plain))
    assert got.count() == 8 and got.where("score is null").count() == 0


def test_turns_without_an_order(spark):
    """Rows of one place, and rows without one, come in the order of their roles and texts; those without come first."""
    rows = [(1, 2, "user", "b"), (1, None, "user", "z"), (1, 2, "assistant", "c"), (1, None, "user", None), (2, 0, None, None)]
    out = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", ["turn"])
    back = {r["conv_id"]: [(t["role"], t["text"]) for t in r["back"]] for r in out.select("conv_id", chat.read_turns(F.col("formatted")).alias("back")).collect()}
    assert back[1] == [("user", ""), ("user", "z"), ("assistant", "c"), ("user", "b")] and back[2] == [("", "")]


def plain_features(text):
    """Counted character by character and word by word."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(quality.N_FEATURES)
    count, n = Counter(raw), len(raw)
    kinds = Counter()
    for b in raw:
        c = chr(b)
        kinds[1 if "a" <= c <= "z" else 2 if "A" <= c <= "Z" else 3 if "0" <= c <= "9" else 4 if c in ",." else 5 if 33 <= b < 127 else 6 if c in " \t\r" else 7 if c == "\n" else 8 if b >= 128 else 0] += 1
    out = [kinds[k] / n for k in range(9)] + [(count[b] / n) ** 0.5 for b in range(33, 127)]
    words = raw.lower().split()
    if not words:
        return np.array(out + [0] * 10)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)] or words
    distinct = [len(set(x)) / len(x) for x in (words, threes, lines)]
    m = len(words)
    out += [np.log1p(m) / 10, *distinct, np.log1p(m / len(lines)), n / m / 10, np.log1p(max(map(len, words))) / 10, min(1, 20 / m), np.log1p(count[10]) / 10, 1]
    return np.array(out)


def test_features_equal_plain_counts():
    import pandas as pd

    texts = [*pd.read_parquet("/root/testdata/sf0.001/documents.parquet").text, None, "", " ", "\n\n", "A,b.\tC\r\n9 é", "a", "a b", "\x00\x7f"]
    for t in texts:
        assert np.allclose(quality.features(t), plain_features(t), rtol=1e-12, atol=1e-12)


def test_fit_is_the_minimum_of_the_pairs_loss():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0.4, 1, (150, 6)), rng.normal(-0.4, 1, (60, 6))])
    y = np.array([1] * 150 + [0] * 60)
    model = quality.fit(x, y, ridge=0.01)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    z = np.clip((x - mean) / scale, -8, 8)
    assert np.allclose(model.mean, mean) and np.allclose(model.scale, scale)
    # All pairs stand for the drawn ones here; gradient descent for the Newton steps.
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, 6)
    w = np.zeros(6)
    for _ in range(4000):
        w -= 0.2 * (-(d / (1 + np.exp(d @ w))[:, None]).mean(axis=0) + 0.01 * w)
    assert np.abs(w - model.w).max() < 0.08 and np.corrcoef(z @ w, z @ model.w)[0, 1] > 0.999
    assert abs((model.score(x) < 0.3).mean() - 60 / 210) <= 1 / 210
    doubled = quality.fit(x, y, ridge=0.01, weight=np.where(y == 1, 2.0, 1.0))
    below = (doubled.score(x) < 0.3).astype(float)
    assert abs((below * np.where(y == 1, 2, 1)).sum() / 360 - 60 / 360) <= 2 / 360
