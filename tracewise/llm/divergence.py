"""How far the sources of a language diverge from each other, and by which terms.

Tasks count terms with numpy by length: a term of up to 8 bytes is one 64-bit word, one of up to 16 bytes two; they are
sorted by radix and counted by runs. Longer terms are sorted as bytes in a bucket for each length. What is counted leaves a
task as one row for each term and group of a run of texts; Spark sums the rows, and the divergences follow from sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, materialise, small_batches

LEAST_DOCS = 3  #: documents of a language that a kept term is in
SCALE = 1_000_000_000  #: of the smoothed share of a term
RANKS = 200  #: terms of a group that are told
CHUNK = 16 << 20  #: bytes of texts counted at once, or one text
PAIRS = 1 << 21  #: pairs of sources in memory before their sums leave a task

#: Byte -> itself, A-Z lower-cased, or 0 for what is no part of a term. Bytes from 0x80 on belong to letters of UTF-8.
_TERM = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


def _words(x: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first 8 bytes from each start as a number whose order is that of the bytes, zero beyond the length."""
    raw = np.lib.stride_tricks.sliding_window_view(x, 8)[start].view(">u8").ravel().astype(np.uint64)
    drop = (64 - 8 * np.clip(length, 1, 8)).astype(np.uint64)
    return np.where(length > 0, raw >> drop << drop, np.uint64(0))


def radix_order(keys: list[np.ndarray]) -> np.ndarray:
    """Stable order by several columns of unsigned numbers, the last one first; 16 bits at a time, which numpy sorts by
    radix, and only those that differ."""
    order = np.arange(len(keys[0]), dtype=np.int64)
    for key in reversed(keys):
        for shift in range(0, key.dtype.itemsize * 8, 16):
            digit = (key >> key.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _runs(keys: list[np.ndarray], group: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, ...]:
    """(index of a first one, group, occurrences, rows) of each run of equal keys and group; all are sorted by these."""
    changed = np.ones(len(row), bool)
    changed[1:] = group[1:] != group[:-1]
    for k in keys:
        changed[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(changed)
    in_rows = changed.copy()
    in_rows[1:] |= row[1:] != row[:-1]
    return first, group[first], np.diff(np.append(first, len(row))), np.add.reduceat(in_rows, first, dtype=np.int64) if len(first) else first


def count_terms(data: np.ndarray, ends: np.ndarray, group: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group, occurrences, texts) of UTF-8 texts that lie one after the other in data; ends: where each text begins,
    and the end; group: a number for each text. A term may come in one of several results, never in two."""
    x = np.concatenate([_TERM[data], np.zeros(16, np.uint8)])
    inside = x != 0
    begin, stop = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    stop[:-1] &= ~inside[1:]
    edge = ends[(ends > 0) & (ends < len(data))]
    begin[edge] = inside[edge]  # a term does not go on from text to text
    stop[edge - 1] = inside[edge - 1]
    start = np.flatnonzero(begin)
    length = np.flatnonzero(stop) + 1 - start
    row = (np.searchsorted(ends, start, "right") - 1).astype(np.uint32)
    order = radix_order([group.astype(np.uint32)[row]])
    start, length, row = start[order], length[order], row[order]
    of = group.astype(np.uint32)[row]
    for words, which in ((1, length <= 8), (2, (length > 8) & (length <= 16))):
        if not which.any():
            continue
        s, n, r, g = start[which], length[which], row[which], of[which]
        keys = [_words(x, s + 8 * i, n - 8 * i) for i in range(words)]
        order = radix_order(keys)
        keys, r, g = [k[order] for k in keys], r[order], g[order]
        first, group_of, times, texts = _runs(keys, g, r)
        raw = np.stack([k[first] for k in keys], axis=1).astype(">u8").view(np.uint8).reshape(len(first), -1)
        yield _strings(raw), group_of, times, texts
    for n in np.unique(length[length > 16]):
        which = length == n
        s, r, g = start[which], row[which], of[which]
        raw = np.lib.stride_tricks.sliding_window_view(x, n)[s]
        order = np.argsort(raw.view(f"S{n}").ravel(), kind="stable")
        raw, r, g = raw[order], r[order], g[order]
        first, group_of, times, texts = _runs([raw.view(f"S{n}").ravel()], g, r)
        yield _strings(raw[first]), group_of, times, texts


def _strings(raw: np.ndarray) -> pa.Array:
    """Rows of bytes, zeros at their ends left out, as strings."""
    used = raw != 0
    offsets = np.concatenate([[0], np.cumsum(used.sum(axis=1))])
    return pa.LargeStringArray.from_buffers(len(raw), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw[used].tobytes())).cast(pa.string())


@give_back
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    names = ["lang", "source", "term", "n", "docs"]

    def counted() -> Iterator[pa.RecordBatch]:
        data = np.concatenate([d for d, _, _ in held])
        sizes = np.concatenate([np.diff(e) for _, e, _ in held])
        lang, source = (pa.array(x, pa.string()) for x in zip(*groups, strict=True))
        for terms, group, n, docs in count_terms(data, np.concatenate([[0], np.cumsum(sizes)]), np.concatenate([g for _, _, g in held])):
            at = pa.array(group)
            yield pa.RecordBatch.from_arrays([lang.take(at), source.take(at), terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], names)

    size = 0
    for batch in batches:
        text = batch.column(2).cast(pa.large_string())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        group = [groups.setdefault(k, len(groups)) for k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        held.append((data, ends - ends[0], np.array(group, np.int64)))
        size += len(data)
        if size >= CHUNK:
            yield from counted()
            held, size = [], 0
    if size:
        yield from counted()


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, total) of the terms that `least_docs` rows of a language hold or more: occurrences in the
    source, and in the language. Terms: runs of letters A-Z, lower-cased, a-z and characters beyond ASCII.

    Null texts, languages and sources are empty ones. Whole texts are read; repeated rows count each.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    found = rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long")
    # One exchange by term and language serves the sums of the sources and those of the language; terms first, as they
    # tell rows apart when sorted.
    found = found.repartition("term", "lang").groupBy("term", "lang", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    all_ = Window.partitionBy("term", "lang")
    found = found.withColumns({"total": F.sum("n").over(all_), "in_docs": F.sum("docs").over(all_)})
    return found.where(F.col("in_docs") >= least_docs).select("lang", "source", "term", "n", "total")


def _share(n: str, of: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (of + terms)), exactly: by decimals where the product needs them; null without terms."""
    below = f"nullif({of} + {terms}, 0)"
    exact = f"cast({SCALE} as decimal(10,0)) * cast({n} + 1 as decimal(19,0)) div cast({below} as decimal(19,0))"
    return F.expr(f"1 + if({n} < {2**63 // SCALE - 1}, {SCALE} * ({n} + 1) div {below}, {exact})")


def _gain(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by term and language -> for pairs of sources of a language that share terms, what their shared terms
    change in the sum that would be without any: (lang, source, item, value)."""
    held: list[tuple[np.ndarray, ...]] = []
    pairs, number, names = 0, {}, []

    def sums() -> Iterator[pa.RecordBatch]:
        s, t, v = (np.concatenate(c) for c in zip(*held, strict=True))
        keys, inverse = np.unique(s * len(names) + t, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, inverse, v)
        of = lambda at, i: pa.array([names[k][i] for k in at.tolist()], pa.string())
        a, b = np.divmod(keys, len(names))
        yield pa.RecordBatch.from_arrays([of(a, 0), of(a, 1), of(b, 1), pa.array(total)], ["lang", "source", "item", "value"])

    last = None  # the rows of a term that may go on in the next batch
    for batch in _with_end(batches):
        rows = last if batch is None else pa.Table.from_batches([batch] if last is None else [*last.to_batches(), batch])
        if batch is not None:
            same = pc.and_(pc.equal(rows["lang"], rows["lang"][-1]), pc.equal(rows["term"], rows["term"][-1])).to_numpy()
            cut = 0 if same.all() else len(rows) - int(np.argmin(same[::-1]))
            rows, last = rows.slice(0, cut), rows.slice(cut)
        if not rows:
            continue
        coded = [rows[c].combine_chunks().dictionary_encode() for c in ("lang", "source", "term")]
        lang, source, term = (c.indices.to_numpy().astype(np.int64) for c in coded)
        of = lang * (len(coded[1].dictionary) + 1) + source
        _, first, inverse = np.unique(of, return_index=True, return_inverse=True)
        known = []
        for k in zip(*(rows[c].take(pa.array(first)).to_pylist() for c in ("lang", "source")), strict=True):
            if k not in number:
                number[k] = len(names)
                names.append(k)
            known.append(number[k])
        own, p, p0 = np.array(known)[inverse], rows["p"].to_numpy(), rows["p0"].to_numpy()
        run = np.cumsum(np.concatenate([[True], (lang[1:] != lang[:-1]) | (term[1:] != term[:-1])]))
        for d in range(1, int(np.bincount(run).max())):
            i = np.flatnonzero(run[d:] == run[:-d])
            for a, b in ((i, i + d), (i + d, i)):
                held.append((own[a], own[b], _gain(p[a], p[b]) - _gain(p[a], p0[b]) - _gain(p0[a], p[b]) + _gain(p0[a], p0[b])))
                pairs += len(i)
            if pairs >= PAIRS:
                yield from sums()
                held, pairs = [], 0
    if held:
        yield from sums()


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def divergences(docs: DataFrame, ranks: int = RANKS, least_docs: int = LEAST_DOCS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group (lang, source) of docs.

    A group gives each kept term p = 1 + floor(SCALE * (n + 1) / (N + V)), where V terms are kept in the language and N is
    the sum of n over them; a language does so too. f = floor((p - q)^2 / q). Part `pair`: item is each other source of
    the language, q its p, value the sum of f over all kept terms, 0 without any. Part `term`: the terms with n > 0 and
    p > q, q the language's p, value f, the first `ranks`. rank is from 1 by value descending and item ascending by bytes.

    For most terms and sources n is 0, so a pair's sum is that of two constants but for the terms that either source has:
    those are summed by distinct n, and only terms that both have are met pair by pair, inside tasks, as sums.
    Numbers are whole; sums beyond 2^63 fail. Null texts, languages and sources are empty ones; an empty table gives no rows.
    """
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source")))).distinct()
    counts = materialise(term_counts(docs, least_docs, text_col, lang_col, source_col), "term-counts")
    by_source = counts.groupBy("lang", "source").agg(F.sum("n").alias("of"), F.count("*").alias("own_terms"))
    by_lang = counts.groupBy("lang", "term").agg(F.first("total").alias("total")).groupBy("lang").agg(F.sum("total").alias("of_lang"), F.count("*").alias("terms"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    stats = groups.join(by_source, ["lang", "source"], "left").join(by_lang, "lang", "left")
    stats = stats.select("lang", "source", *map(zero, ("of", "own_terms", "of_lang", "terms")))
    stats = materialise(stats.withColumn("p0", _share("0L", "of", "terms")), "groups")
    rows = counts.join(stats, ["lang", "source"]).withColumn("p", _share("n", "of", "terms"))

    q = _share("total", "of_lang", "terms")
    more = rows.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)

    # A group's terms by their share, against what each group of the language gives a term that it lacks.
    bases = stats.groupBy("lang").agg(F.collect_list(F.struct("source", "p0")).alias("others"))
    shares = rows.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("held")).join(bases, "lang")
    other = shares.select("lang", "source", "p", "p0", "held", F.explode("others").alias("o")).where("o.source <> source")
    gain = lambda p, q: f"cast(held as decimal(18,0)) * (({p} - {q}) * ({p} - {q}) div {q})"
    has, lacks = other.select("lang", "source", F.col("o.source").alias("item"), F.expr(gain("p", "o.p0")).alias("value")), other.select(
        "lang", F.col("o.source").alias("source"), F.col("source").alias("item"), F.expr(gain("o.p0", "p")).alias("value")
    )
    both = rows.select("lang", "term", "source", "p", "p0").repartition("term", "lang").sortWithinPartitions("term", "lang")
    both = both.mapInArrow(_shared, "lang string, source string, item string, value long")
    a, b = stats.select("lang", "source", "terms", "own_terms", "p0"), stats.select("lang", *(F.col(c).alias(f"other_{c}") for c in ("source", "own_terms", "p0")))
    none = a.join(b, "lang").where("source <> other_source").select(
        "lang", "source", F.col("other_source").alias("item"),
        F.expr("coalesce(cast(terms - own_terms - other_own_terms as decimal(18,0)) * ((p0 - other_p0) * (p0 - other_p0) div other_p0), 0)").alias("value"),
    )
    wide = lambda df: df.withColumn("value", F.col("value").cast("decimal(38,0)"))
    pairs = wide(none).unionByName(wide(has)).unionByName(wide(lacks)).unionByName(wide(both))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return pairs.unionByName(more)
