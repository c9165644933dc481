"""The walk of JSON by levels against the plain one, text by text."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tracewise.functions.variants import canonical_nodes, flattened, with_canonical_hash
from tracewise.plans.queries import QUERIES


def made(rng, depth):
    kind = rng.choice("sntb" if depth == 0 else "sntboaoa")
    if kind in "oa":
        inner = [made(rng, depth - 1) for _ in range(rng.randint(0, 4))]
        return inner if kind == "a" else {rng.choice(["a", "b.c", "é", "x y", "0", ""]) + str(i): v for i, v in enumerate(inner)}
    return {"s": rng.choice(["", "x", 'q"\\\n', "中文"]), "n": rng.randint(-5, 10**12), "t": None, "b": rng.random() < 0.5}[kind]


def test_nodes_by_levels_equal_plain_ones(spark):
    rng = random.Random(8)
    texts = [json.dumps(made(rng, 4), ensure_ascii=rng.random() < 0.5) for _ in range(60)] + ["{}", "[]", "null", "3", '""']
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    got = {}
    for r in flattened(rows, "i", "t").collect():
        got.setdefault(r["i"], []).append([r["path"], r["type"], r["value"]])
    want = {r["i"]: r["n"] for r in rows.select("i", canonical_nodes(F.col("t")).alias("n")).collect()}
    assert {i: sorted(n, key=str) for i, n in got.items()} == {i: sorted(map(list, n), key=str) for i, n in want.items()}


def test_identities_of_odd_texts(spark):
    deep = "[" * 12 + "]" * 12
    cases = [
        '{"a": [1, {}], "b": 1.50}', ' {"b":1.5,"a":[1,{}]}', '{"a": [1, []], "b": 1.5}', '{"a": [{}, 1], "b": 1.5}', "{}", "[]", deep, f"[{deep}]",
        None, "", "{", '{"a": 1, "a": 2}', "[" * 5000 + "]" * 5000,
    ]
    rows = spark.createDataFrame(list(enumerate(cases)) * 2, "i int, t string")
    found = with_canonical_hash(rows, "t", "h").collect()
    assert len(found) == 26
    h = {r["i"]: r["h"] for r in found}
    assert h[0] == h[1] and len({h[i] for i in range(1, 8)}) == 7 and all(h[i] is None for i in range(8, 13))
    assert with_canonical_hash(rows.limit(0), "t", "h").count() == 0


@pytest.mark.parametrize("name", ["config_hash", "current_config"])
def test_identities_run_no_python(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
