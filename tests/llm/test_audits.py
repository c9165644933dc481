"""Packing, and the audits of filters and sources: against plain versions, the library and SQL on odd tables."""

import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from tests.compare import same
from tracewise.llm import divergence, interactions, packing
from tracewise.llm.queries import ORACLE_SQL, QUERIES, model_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n int, sequence_id string, term string, part string, mask string"


@pytest.fixture(scope="module")
def path():
    return model_path("PACKING_TOKENIZER", "word_bpe_49k.json")


def one_by_one(items, size):
    """Sequences made one after the other, every pair of unpacked pieces tried."""
    left, out = sorted(items, reverse=True), []
    while left:
        own, rest = [], []
        for x in left:
            (own if sum(own) + x <= size else rest).append(x)
        small, best = own[-1], None
        room = size - sum(own) + small
        if room > small:
            for i, a in enumerate(rest):
                for b in rest[i + 1 :]:
                    if small < a + b <= room and (best is None or (a + b, a) > best):
                        best, pair = (a + b, a), (a, b)
        if best:
            own = own[:-1] + list(pair)
            rest.append(small)
            for x in pair:
                rest.remove(x)
        left = sorted(rest, reverse=True)
        out.append(sorted(own, reverse=True))
    return sorted(out)


def test_patterns_equal_sequences_made_one_by_one():
    rng = random.Random(5)
    for _ in range(300):
        size = rng.choice([10, 37, 100])
        items = [rng.randint(1, size if rng.random() < 0.7 else max(1, size // 5)) for _ in range(rng.randint(0, 60))]
        counts = np.bincount(np.array(items, int), minlength=size + 1)
        got = [sum(([x] * n for x, n in own), []) for times, own in packing.patterns(counts) for _ in range(times)]
        assert sorted(got) == one_by_one(items, size)


def test_two_pieces_take_the_place_of_the_smallest():
    counts = np.bincount([60, 30, 25, 14], minlength=101)
    assert packing.patterns(counts) == [(1, [(60, 1), (25, 1), (14, 1)]), (1, [(30, 1)])]


def test_parts_equal_the_library(path):
    file = open(path, encoding="utf-8").read()
    plain, table, rng = Tokenizer.from_str(file), packing.PartTable(file, limit=20_000), random.Random(2)
    assert table.separable
    odd = [*"abcXYZ   ''\"-.,!0129\t\n\r\x85\xa0\x1c\x00éÉß×÷µªº²¼½ÿÞ", "'s", "'LL", "'re", "İ", "é", "中", "文", " ", "Σ", "ſ", "́", "<|endoftext|>", "　", "ﬁ", "K"]
    for k in range(4000):
        text = "".join(rng.choice(odd) for _ in range(rng.randint(0, 25)))
        text = text.encode("latin-1", "ignore").decode("latin-1") if k % 3 == 0 else text
        assert np.frombuffer(table.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert sum(map(len, table.values())) < 20_000


def test_blocks_of_a_long_text_lose_nothing(path, monkeypatch):
    file = open(path, encoding="utf-8").read()
    text = "Don't stop, naïve ones! " * 40 + "x" * 300 + " 中文 end"
    whole = packing.PartTable(file).encode(text)
    monkeypatch.setattr(packing, "BLOCK", 7)
    assert packing.PartTable(file).encode(text) == whole


def packed_well(out, size=4096):
    for _, own in out.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= size


def test_packing_query_against_the_library(spark, path):
    plain = Tokenizer.from_file(path)
    want = []
    for doc, text in pd.read_parquet(f"{SF}/documents.parquet")[["doc_id", "text"]].itertuples(index=False):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            piece = ids[at : at + 4096]
            want.append((doc, k, at, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())))
    out = QUERIES["op11_best_fit_packing"](spark, SF).toPandas()
    assert sorted(out[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    packed_well(out)
    counts = np.bincount(out.length, minlength=4097)
    assert out.sequence_id.nunique() == sum(times for times, _ in packing.patterns(counts)) <= -(-out.length.sum() // 4096) * 1.02 + 1


def test_packing_of_odd_tables(spark, path):
    rows = [(1, "a b " * 4000, "x"), (2, None, "y"), (None, "", "z"), (3, "same", "s"), (3, "same", "s"), (4, "w" * 50_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, task string")
    pieces = packing.tokenize_documents(docs, path, size=512)
    assert pieces.count() > 20 and pieces.where("length > 512").isEmpty()
    odd = pieces.selectExpr("*", "'c' as sequence_id", "'r' as row", "7 as rank", "'t' as task").repartition(5)
    out = packing.pack(odd, 512)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids", "row", "rank", "task", "sequence_id", "offset"]
    got = out.toPandas()
    packed_well(got, 512)
    assert len(got) == pieces.count() and sorted(got.length) == sorted(pieces.toPandas().length)
    whole = packing.sequences(out).toPandas().set_index("sequence_id")
    for seq, at, n, ids in got[["sequence_id", "offset", "length", "ids"]].itertuples(index=False):
        assert whole.ids[seq][4 * at : 4 * (at + n)] == ids and at in whole.starts[seq]
    assert packing.pack(packing.tokenize_documents(docs.limit(0), path)).count() == 0
    for bad in (0, 513, None):
        with pytest.raises(Exception, match="lengths have to be"):
            packing.pack(spark.createDataFrame([(1, bad)], "a int, length long"), 512).collect()


def odd_documents():
    words = " ".join(f"w{i}" for i in range(250))
    long = "Ünendlich" + "lang" * 30
    texts = [
        None, "", " \t\n", "Aa bb $", words, words, words + " #", "A" * 50 + " b", "only only only only", long, f"{long} {long} term", f"x {long.lower()}", "a-b_c 1d2 É é ÉTÉ été", "A-B_C été",
        "sixteenletterwrd sixteenletterwrds eightlet ninelette", "sixteenletterwrd sixteenletterwrds eightlet ninelette", "SIXTEENLETTERWRD sixteenletterwrds eightlet ninelette", "\x0bone\x1ctwo",
    ]
    langs, sources = ["en", None, "", "de"], ["s1", None, "", "s2", "s3"]
    rows = [(i if i % 7 else None, t, langs[i % 4] if i > 6 else "en", sources[i % 5], i, "c", "c", "c", "c") for i, t in enumerate(texts * 2)]
    return rows + [rows[4], rows[4]]


@pytest.mark.parametrize("rows", [odd_documents(), odd_documents()[:3], []], ids=["odd", "without kept terms", "empty"])
def test_audits_of_odd_tables_equal_sql(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (5, 1, 1), (None, 1, 1), (4, None, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    for name, df in (("documents", docs), ("labels", labels)):
        con.register(name, df.toPandas() if df.count() else pd.DataFrame({c: pd.Series(dtype="int64" if c in ("doc_id", "n") else "str") for c in df.columns}))
    same(interactions.interactions(interactions.failure_masks(docs, labels)).toPandas(), con.execute(ORACLE_SQL["op12_filter_interactions"]).df())
    same(divergence.divergences(docs).toPandas(), con.execute(ORACLE_SQL["op13_source_divergence"]).df())


def test_interactions_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 3, 2, 2, 1), ("q", 2, 1, 0, 1)], "part string, mask int, n long, good long, toxic long")
    out = interactions.interactions(cells, "XY").toPandas().sort_values(["part", "filter_order", "step"])
    assert out[out.part == "p"].drop(columns="part").values.tolist() == [
        ["XY", 1, 5, 2, 0, 0, 2, 1, 2], ["XY", 2, 5, 0, 2, 0, 0, 0, 2], ["YX", 1, 5, 2, 0, 0, 2, 1, 2], ["YX", 2, 5, 0, 2, 0, 0, 0, 2],
    ]
    assert len(out) == 8 and interactions.interactions(cells.limit(0)).count() == 0
    with pytest.raises(ValueError):
        interactions.interactions(cells, "ABCDEFG")


def test_runs_of_texts_count_alike(spark, monkeypatch):
    """However texts are cut into runs and batches, terms are counted alike; terms never go on into the next text."""
    docs = spark.createDataFrame(odd_documents() * 2, DOCS)
    whole = divergence.term_counts(docs, 1).toPandas()
    monkeypatch.setattr(divergence, "CHUNK", 1)
    monkeypatch.setattr(divergence, "PAIRS", 1)
    parts = divergence.term_counts(docs.repartition(7), 1).toPandas()
    same(whole, parts)
    same(divergence.divergences(docs.repartition(7)).toPandas(), divergence.divergences(docs.coalesce(1)).toPandas())


def test_radix_order_is_stable():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 2**63, 500, dtype=np.uint64) // 7 * 7 % 11, rng.integers(0, 5, 500, dtype=np.uint64) << np.uint64(40)
    assert divergence.radix_order([a, b]).tolist() == np.lexsort([b, a]).tolist()


def test_shares_are_exact_beyond_long_products(spark):
    n, of = 9 * 10**12, 10**13
    got = spark.createDataFrame([(n, of, 7), (3, 10, 2), (0, 0, 0)], "n long, of long, terms long").select(divergence._share("n", "of", "terms")).toPandas().iloc[:, 0]
    assert got[0] == 1 + 10**9 * (n + 1) // (of + 7) and got[1] == 1 + 4 * 10**9 // 12 and pd.isna(got[2])
