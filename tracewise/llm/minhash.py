"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle space gives two signature values, the smallest and the largest; each of both agrees
between two sets with the probability of their Jaccard similarity. So half the hash evaluations fill all bands.
Documents that agree in a band are candidates, and candidates are confirmed on their full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import connected_components, give_back, materialise, may_hold, small_batches

ROWS = 6  #: signature values in a band
BANDS = 52  #: a pair at 0.8 misses all of them with probability (1 - 0.8**6)**52 = 1.4e-7
HOT = 10_000  #: texts, at most, whose copies are so many that their classes are broadcast
BLOCK = 1024  #: documents of a bucket compared at once; larger buckets are compared block by block

_PERMS = ROWS * BANDS // 2
_RNG = np.random.default_rng(20240501)
_MUL = _RNG.integers(1, 2**32, _PERMS, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 2**32, _PERMS, dtype=np.uint32)
_WORD_MUL = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MUL = _RNG.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; split at space and 0x09-0x0D only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingles(found: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of `size` words; of the whole sequence if it is shorter."""
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    k = min(n, size)
    total = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        total += _mix(h[i : n - k + 1 + i] ^ _WORD_MUL[i])
        total *= _WORD_MUL[i]
    return np.unique(_mix(total))


def band_keys(found: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys of the min-max signature."""
    x = (found >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(_PERMS, 2**32 - 1, np.uint32), np.zeros(_PERMS, np.uint32)
    for at in range(0, len(x), 4096):
        h = x[None, at : at + 4096] * _MUL[:, None] + _ADD[:, None]
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    values = np.concatenate([low, high]).astype(np.uint64).reshape(BANDS, ROWS)
    return _mix((_mix(values + np.uint64(1)) * _BAND_MUL).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _signed(size: int):
    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, copies, sizes, keys, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = words(text)
                own = shingles(found, size)
                ids.append(doc)
                sizes.append(len(own))
                copies.append(xxhash.xxh3_128_digest(b" ".join(found)) if found else None)
                if found:
                    keys.append(band_keys(own).view(np.int64))
                ends.append(ends[-1] + (BANDS if found else 0))
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(copies, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                ["doc_id", "copy", "n_shingles", "bands"],
            )

    return run


def linked_forest(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of all links 100 * intersection >= percent * union among these sets."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    inter = np.zeros((m, m), np.float32)
    if m == 2:
        inter[0, 1] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        owner = np.repeat(np.arange(m), sizes)
        _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = count > 1
        column, owner = (np.cumsum(shared) - 1)[column[k := shared[column]]], owner[k]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for at in range(0, int(shared.sum()), 4096):
            lo, hi = np.searchsorted(column, (at, at + 4096))
            dense = np.zeros((m, 4096), np.float32)
            dense[owner[lo:hi], column[lo:hi] - at] = 1
            inter += dense @ dense.T
    both = np.rint(inter).astype(np.int64)
    hit = np.argwhere(np.triu(100 * both >= percent * (sizes[:, None] + sizes[None, :] - both), 1))
    root = list(range(m))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in hit.tolist():
        p, q = top(i), top(j)
        if p != q:
            root[p] = q
            out.append((ids[i], ids[j]))
    return out


def _confirmed(size: int, percent: int):
    """Rows come sorted by (bucket, i, j); a group ends where these change. Repeated rows of a group are compared once."""

    @give_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, sets, seen = None, [], [], set()
        for batch in batches:
            out = []
            for *now, doc, text in zip(*(batch[c].tolist() for c in ("bucket", "i", "j", "doc_id", "text")), strict=True):
                if now != key:
                    out += linked_forest(ids, sets, percent) if len(ids) > 1 else []
                    key, ids, sets, seen = now, [], [], set()
                row = doc, xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))
                if row in seen:
                    continue
                seen.add(row)
                ids.append(doc)
                sets.append(shingles(words(text), size))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")
        if len(ids) > 1:
            yield pd.DataFrame(linked_forest(ids, sets, percent), columns=["a", "b"], dtype="int64")

    return run


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs.

    Linked: 100 * intersection >= percent * union of the sets of distinct shingles. A text of fewer words is one
    shingle; a null, empty or blank text has none and links with nothing. Equal word sequences are one class before any
    comparison, so copies cost a row each. Rows of one id are one node, so all of them are kept or none; rows with a null
    id get null component and kept. Other columns of docs are not read. An empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = materialise(
        texts.mapInArrow(_signed(shingle_words), "doc_id long, copy binary, n_shingles long, bands array<long>"), "minmax"
    )
    of_copies = signed.where("copy is not null and doc_id is not null").groupBy("copy").agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows"))
    of_copies = materialise(of_copies, "copies")
    reps = of_copies.select(F.col("rep").alias("doc_id"))
    entries = materialise(
        signed.select("doc_id", "bands").join(reps, "doc_id", "left_semi").select("doc_id", F.explode("bands").alias("bucket")).distinct(),
        "entries",
    )
    # Buckets with the same members are compared once.
    buckets = (
        entries.groupBy("bucket")
        .agg(F.count("*").alias("m"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.expr("bit_xor(xxhash64(doc_id))").alias("x"))
        .where("m > 1").groupBy("m", "lo", "hi", "x").agg(F.min("bucket").alias("bucket"))
        .select("bucket", F.ceil(F.col("m") / BLOCK).alias("blocks"))
    )
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks"))
    members = (
        entries.join(buckets, "bucket")
        .select("doc_id", "bucket", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        .select("doc_id", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    members = materialise(members, "members")
    needed, _ = may_hold(texts, members, "doc_id")
    near = (
        needed.join(members, "doc_id")
        .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
        .mapInPandas(_confirmed(shingle_words, percent), "a long, b long")
    )
    component = connected_components(near)
    classes = of_copies.join(component, F.col("rep") == F.col("node"), "left").select(
        "copy", "rows", F.coalesce("component", "rep").alias("component_id")
    )
    own = signed.select("doc_id", "copy", "n_shingles")
    # Texts with a share of the rows of 1/HOT or more are at most HOT; their rows stay where they are.
    frequent = materialise(classes.where(F.col("rows") >= max(2, -(-signed.count() // HOT))), "frequent").drop("rows")
    rest = own.join(F.broadcast(frequent.select("copy")), "copy", "left_anti").join(classes.drop("rows"), "copy", "left")
    every = own.join(F.broadcast(frequent), "copy").unionByName(rest)
    return (
        every.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
