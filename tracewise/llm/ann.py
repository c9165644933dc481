"""Approximate nearest neighbours by adaptive dimension scan in inverted lists.

Vectors are dealt to the nearest of sampled k-means centres. A query probes the lists of its nearest centres. There,
vectors are rotated at random and read in blocks of columns. After a random rotation the share of a squared distance that
lies in t of d columns is distributed as Beta(t/2, (d-t)/2); so a candidate is abandoned once what has been read of its
distance is more than a vector at the distance of the k-th best would show but for one case in 1/ALPHA. Survivors get
exact distances.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, materialise
from tracewise.llm.vectors import matrix, usable

SAMPLE = 16_384  #: vectors, at most about, that the centres are fitted on
LISTS = 1024  #: most centres; lists may grow beyond any size, as they are scanned in blocks
BLOCK = 1024  #: vectors of a list that go to one task together and are scanned in step
TASK = 1 << 16  #: vectors of a task, about, if there are more than the session's shuffle partitions make
QUERIES, QUERY_BYTES = 16_384, 64 << 20  #: queries of a round, about, at most; they are sent to all tasks
COLUMNS = 8  #: columns read between tests
ALPHA = 0.002  #: probability that a test abandons a vector as near as the k-th best
PAIRS = 1 << 15  #: of a query and a candidate that are scanned in step


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = nearest(x, centres, 1)[:, 0]
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest centres of each row, nearest first."""
    out = []
    for at in range(0, len(x), 1024):
        d = (centres**2).sum(axis=1) - 2 * x[at : at + 1024] @ centres.T
        out.append(np.argsort(d, axis=1, kind="stable")[:, :n] if n > 1 else d.argmin(axis=1)[:, None])
    return np.concatenate(out) if out else np.empty((0, n), np.int64)


def shares(dim: int) -> list[tuple[int, int, float]]:
    """(first column, end, share of the squared distance up to the end that is not exceeded but with probability ALPHA):
    quantiles of the Beta distributions, from sums over a grid. The last block leaves room for rounding only."""
    out, x = [], np.arange(1, 20_000) / 20_000
    for at in range(0, dim, COLUMNS):
        end = min(dim, at + COLUMNS)
        share = 1 + 1e-9
        if end < dim:
            density = (end / 2 - 1) * np.log(x) + ((dim - end) / 2 - 1) * np.log1p(-x)
            below = np.cumsum(np.exp(density - density.max()))
            share = float(x[np.searchsorted(below, (1 - ALPHA) * below[-1])])
        out.append((at, end, share))
    return out


def scan(q: np.ndarray, own: np.ndarray, bound: np.ndarray, ids: np.ndarray, x: np.ndarray, turned: np.ndarray, turned_q: np.ndarray, k: int, tests: list[tuple[int, int, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query's row, id, distance) of the k best of one block for each query, by row, distance and id, never a query's own
    id; and the number of components read before exact distances. bound: a squared distance that each query's k-th
    nearest is known not to exceed; without one (infinite) nothing is abandoned for that query."""
    i, j = np.nonzero(own[:, None] != ids[None, :])
    part, read = np.zeros(len(i)), 0
    for at, end, share in tests:
        read += len(i) * (end - at)
        part += ((turned[j, at:end] - turned_q[i, at:end]) ** 2).sum(axis=1)
        keep = part <= bound[i] * share + 1e-12
        i, j, part = i[keep], j[keep], part[keep]
    d = np.sqrt(((x[j] - q[i]) ** 2).sum(axis=1))
    order = np.lexsort((ids[j], d, i))
    i, j, d = i[order], j[order], d[order]
    first = np.searchsorted(i, i)  # where the rows of the same query begin
    best = np.arange(len(i)) - first < k
    return i[best], ids[j[best]], d[best], read


def best(i: np.ndarray, found: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k nearest ids of each query's row i, each id once; sorted by row, distance and id."""
    order = np.lexsort((d, found, i))
    i, found, d = i[order], found[order], d[order]
    first = np.ones(len(i), bool)
    first[1:] = (i[1:] != i[:-1]) | (found[1:] != found[:-1])
    i, found, d = i[first], found[first], d[first]
    order = np.lexsort((found, d, i))
    i, found, d = i[order], found[order], d[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], found[keep], d[keep]


def _scanned(k: int, tests: list[tuple[int, int, float]], own: np.ndarray, q: np.ndarray, limits: np.ndarray, probes: np.ndarray):
    """Vectors that come sorted by list -> (query_id, vec_id, score) of the k nearest that a task has for each query. probes:
    for each query, which lists it looks into. What a task has found already bounds what follows."""

    @give_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, bound = rotation(q.shape[1]), limits.copy()
        turned_q = q @ turn
        held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        for b in batches:
            if not len(b):
                continue
            lists, ids, x = b["list"].to_numpy(), b["vec_id"].to_numpy(), matrix(b["embedding"])
            turned, new = x @ turn, [held]
            starts = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
            for at, end in zip(starts, [*starts[1:], len(lists)], strict=True):
                asking = np.flatnonzero(probes[:, lists[at]])
                for low in range(at, end, BLOCK):
                    part = slice(low, min(end, low + BLOCK))
                    step = max(1, PAIRS // (part.stop - low))
                    for begin in range(0, len(asking), step):
                        a = asking[begin : begin + step]
                        i, found, d, _ = scan(q[a], own[a], bound[a], ids[part], x[part], turned[part], turned_q[a], k, tests)
                        new.append((a[i], found, d))
            held = best(*(np.concatenate(c) for c in zip(*new, strict=True)), k)
            last = np.flatnonzero(np.arange(len(held[0])) - np.searchsorted(held[0], held[0]) == k - 1)
            bound[held[0][last]] = np.minimum(bound[held[0][last]], held[2][last] ** 2 * (1 + 1e-9))
        yield pd.DataFrame({"query_id": own[held[0]], "vec_id": held[1], "score": held[2]})

    return run


def search(vectors: DataFrame, is_query: Column, k: int = 10, share: float = 0.6, least: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found of every query row among all other rows.

    vectors: vec_id, embedding; other columns, whatever their names, are only read by is_query. Score: Euclidean distance
    of the given vectors in double precision; ties go to the smaller id. A query probes `share` of the lists, `least` of
    them at least, and more until they hold more than k vectors. Vectors that are null, empty, zero or hold null or
    non-finite components take no part; null ids neither. Vectors of different lengths have no distance: each length is a
    search of its own. A repeated row counts once. Of an id with several vectors the first in array order asks, and the
    nearest one is found; it is never found for its own id. An empty table, or one without usable vectors, gives an empty
    result.

    Each vector is shuffled once, to others of its list. Queries go to the vectors in rounds of a bounded size, and each
    task returns the k best that it has for each query.
    """
    base = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", is_query.alias("is_query")).where(
        F.col("vec_id").isNotNull() & usable(F.col("embedding"))
    )
    lengths = sorted(map(tuple, base.groupBy(F.size("embedding").alias("dim")).count().collect()))
    found = [_search(base.where(F.size("embedding") == dim), dim, n, k, share, least) for dim, n in lengths]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(base: DataFrame, dim: int, n: int, k: int, share: float, least: int) -> DataFrame:
    """(query_id, vec_id, score) of what the n vectors of one length hold for the queries among them."""
    hashed = F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1_000_000))
    sample = base.where(hashed < max(1, int(min(1.0, SAMPLE / n) * 1_000_000))).orderBy("vec_id").select("vec_id", "embedding").toPandas()
    if not len(sample):
        sample = base.limit(1).select("vec_id", "embedding").toPandas()
    fitted, fitted_ids = matrix(sample["embedding"]), sample["vec_id"].to_numpy()
    centres = k_means(fitted, int(min(LISTS, max(1, round(np.sqrt(n))))))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(list=nearest(matrix(b["embedding"]), centres, 1)[:, 0] if len(b) else [])[["vec_id", "embedding", "is_query", "list", "row"]]

    numbered = base.withColumn("row", F.monotonically_increasing_id())
    listed = materialise(numbered.mapInPandas(dealt, "vec_id long, embedding array<float>, is_query boolean, list int, row long"), "lists")
    # One row for each list, so at most LISTS.
    counts = {r["list"]: r["count"] for r in listed.groupBy("list").count().collect()}
    size = np.array([counts.get(i, 0) for i in range(len(centres))])
    probes = max(least, int(np.ceil(share * len(centres))))
    # The k nearest sampled vectors are results themselves, so their distances bound every scan.
    squares, single = (fitted**2).sum(axis=1), fitted.astype(np.float32)

    def of_sample(own: int, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, distances) of the k nearest vectors of the sample, of as many ids."""
        d = squares - 2 * (single @ q.astype(np.float32))
        at = np.argpartition(d, min(len(d), 8 * k) - 1)[: 8 * k]
        at = at[fitted_ids[at] != own]
        d = np.sqrt(((fitted[at] - q) ** 2).sum(axis=1))
        _, found, d = best(np.zeros(len(at), np.int64), fitted_ids[at], d, k)
        return found, d

    def prepared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            q = matrix(b["embedding"])
            order = nearest(q, centres, len(centres)) if len(b) else np.empty((0, len(centres)), int)
            need = (np.cumsum(size[order], axis=1) <= k).sum(axis=1) + 1
            into = np.zeros((len(b), len(centres)), bool)
            for i, m in enumerate(need):
                into[i, order[i, : max(probes, m)]] = True
            near = [of_sample(i, x) for i, x in zip(b["vec_id"].tolist(), q, strict=True)]
            yield b.assign(
                bound=[float(d[k - 1] ** 2 * (1 + 1e-9)) if len(d) == k else float("inf") for _, d in near], probes=[np.packbits(x).tobytes() for x in into],
                near=[i.tolist() for i, _ in near], far=[d.tolist() for _, d in near],
            )[["vec_id", "embedding", "bound", "probes", "near", "far"]]

    # A stated number of partitions, so that few bytes do not meet in one task; each query's work is large.
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = listed.where("is_query").select("vec_id", "embedding").repartition(tasks, "vec_id").groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = materialise(asked.mapInPandas(prepared, "vec_id long, embedding array<float>, bound double, probes binary, near array<long>, far array<double>"), "asked")
    rounds = -(-asked.count() // max(1, min(QUERIES, QUERY_BYTES // (16 * dim + len(centres)))))
    block = F.col("row") % (F.expr(f"element_at(array({','.join(str(max(1, -(-int(x) // BLOCK))) for x in size)}), list + 1)"))
    blocks = materialise(listed.repartition(max(tasks, n // TASK), "list", block).sortWithinPartitions("list").select("vec_id", "embedding", "list"), "blocks")
    results = [asked.select(F.col("vec_id").alias("query_id"), F.inline(F.arrays_zip(F.col("near").alias("vec_id"), F.col("far").alias("score"))))]
    for r in range(rounds):
        own = asked.where(F.pmod(F.xxhash64("vec_id", F.lit("round")), F.lit(rounds)) == r).select("vec_id", "embedding", "bound", "probes").toPandas()
        into = np.array([np.unpackbits(np.frombuffer(p, np.uint8), count=len(centres)) for p in own["probes"]], bool).reshape(len(own), len(centres))
        run = _scanned(k, shares(dim), own["vec_id"].to_numpy(), matrix(own["embedding"]).reshape(len(own), dim), own["bound"].to_numpy(), into)
        results.append(materialise(blocks.mapInPandas(run, "query_id long, vec_id long, score double"), "found"))
    return reduce(DataFrame.unionByName, results)
