"""Language identification by a linear-chain conditional random field over words.

Each word's label depends on its affixes, its character n-grams and a lexicon of words frequent in training, and on the
label before it by learned transitions, so code-switched texts are labelled word by word. Marginals come from
forward-backward; a text's language is the one with the largest mean marginal. Chains of any length are cut into chunks
of fixed length whose products of transition matrices are joined, so that numpy works across a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewise.llm.quality import sample_labelled
from tracewise.llm.shared import give_back, slices, small_batches

TRAIN_DOCS = 200  #: expected number of labelled texts of each language, at most, that the fit uses
LEXICON = 4000  #: words in the lexicon
STEPS = 16
CHUNK = 24
SLICE = 200_000  #: characters labelled at once, or one text

_LETTER = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))  # lower-case letters and beyond ASCII
_B2, _B3 = 1 << 16, 1 << 17
_AFFIX = 1 << 17
_POW = np.array([pow(1099511628211, i, 1 << 64) for i in range(4096)], np.uint64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Words:
    """Words of a batch: bytes of all of them, where each starts and ends, and the text each belongs to."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray

    @staticmethod
    def of(texts: list[str]) -> Words:
        raw = [t.lower().encode("utf-8", "surrogatepass").translate(_LETTER) for t in texts]
        buf = np.frombuffer(b"   " + b"   ".join(raw) + b"   ", np.uint8)
        space = buf == 32
        start = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        end = np.flatnonzero(~space[:-1] & space[1:]) + 1
        ends = np.cumsum([len(r) + 3 for r in raw]) if raw else np.empty(0, np.int64)
        return Words(buf, start, end, np.searchsorted(ends, start - 3, side="right"))

    def ids(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        length = self.end - self.start
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        letters = self.buf[np.repeat(self.start, length) + at].astype(np.uint64) + np.uint64(1)
        return np.add.reduceat(letters * _POW[at & 4095], np.cumsum(length) - length) * np.uint64(0x9E3779B97F4A7C15)

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bigrams and trigrams of each word with the space on either side, and where each word's begin."""
        length = self.end - self.start + 1
        begin = np.cumsum(length) - length
        at = np.repeat(self.start - 1, length) + np.arange(length.sum()) - np.repeat(begin, length)
        a, b, c = (self.buf[at + i].astype(np.int32) for i in range(3))
        return a * 256 + b, ((a * 256 + b) * 40503 ^ c * 2654435) & (_B3 - 1), begin

    def affixes(self) -> np.ndarray:
        """(words, 6): hashes of the first and last one to three bytes; the space stands in for missing ones."""
        cols = []
        for sign, edge in ((1, self.start), (-1, self.end - 1)):
            h = np.full(len(edge), 17 if sign == 1 else 91, np.int64)
            inside = np.ones(len(edge), bool)
            for i in range(3):
                byte = self.buf[edge + sign * i].astype(np.int64)
                inside &= byte != 32
                h = (h * 257 + np.where(inside, byte, 0) + i) * 31
                cols.append((h ^ (h >> 9)) % _AFFIX)
        return np.stack(cols, axis=1)


def marginals(emission: np.ndarray, text: np.ndarray, trans: np.ndarray, expect: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """(words, labels) posterior of each word; and the expected counts of label pairs. text: sorted text number of each
    word. trans: (labels, labels) log weights."""
    n, k = emission.shape
    if not n:
        return np.empty((0, k), np.float32), np.zeros((k, k)) if expect else None
    t = np.exp(trans - trans.max()).astype(np.float32)
    e = np.exp(emission - emission.max(axis=1, keepdims=True)).astype(np.float32) + np.float32(1e-12)
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    size = np.diff(np.r_[first, n])
    chunks = -(-size // CHUNK)
    base = np.cumsum(chunks) - chunks  # first chunk of each text
    m = int(chunks.sum())
    pos = np.arange(n) - np.repeat(first, size)
    row, col = np.repeat(base, size) + pos // CHUNK, pos % CHUNK
    a = np.ones((CHUNK, m, k), np.float32)
    a[col, row] = e
    live = np.zeros((CHUNK, m), bool)
    live[col, row] = True

    norm = lambda x, ax: x / x.sum(axis=ax, keepdims=True)
    product = np.broadcast_to(np.eye(k, dtype=np.float32), (m, k, k)).copy()
    for i in range(CHUNK):
        on = live[i]
        if i == 0 or on.all():
            product = norm((product.reshape(m * k, k) @ t).reshape(m, k, k) * a[i][:, None, :], (1, 2))
        else:
            product[on] = norm((product[on].reshape(-1, k) @ t).reshape(-1, k, k) * a[i][on][:, None, :], (1, 2))
    enter, leave = np.full((m, k), 1 / k, np.float32), np.full((m, k), 1 / k, np.float32)
    order = np.argsort(-chunks, kind="stable")
    many = chunks[order]
    for j in range(1, int(many[0])):
        r = base[order[: np.searchsorted(-many, -j, side="left")]] + j
        enter[r] = norm(np.einsum("nk,nkl->nl", enter[r - 1], product[r - 1]), 1)
    last = base + chunks - 1
    for j in range(1, int(many[0])):
        r = last[order[: np.searchsorted(-many, -j, side="left")]] - j
        leave[r] = norm(np.einsum("nkl,nl->nk", product[r + 1], leave[r + 1]), 1)
    alpha = np.empty((CHUNK, m, k), np.float32)
    at = enter
    for i in range(CHUNK):
        at = np.where(live[i][:, None], norm((at @ t) * a[i], 1), at)
        alpha[i] = at
    out = np.empty((CHUNK, m, k), np.float32)
    pairs = np.zeros((k, k))
    beta = leave
    for i in range(CHUNK - 1, -1, -1):
        out[i] = norm(alpha[i] * beta, 1)
        back = a[i] * beta
        if expect:
            prev = alpha[i - 1] if i else enter
            joint = prev[:, :, None] * t[None] * back[:, None, :]
            on = live[i].copy()
            if i == 0:
                on[base] = False
            joint = joint[on]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(joint) else 0
        beta = np.where(live[i][:, None], norm(back @ t.T, 1), beta)
    return out[col, row], pairs if expect else None


@dataclass(frozen=True)
class Crf:
    langs: tuple[str, ...]
    lexicon: np.ndarray  # sorted word hashes
    w: dict[str, np.ndarray]
    trans: np.ndarray

    def indexes(self, words: Words) -> dict[str, np.ndarray]:
        ids = words.ids()
        at = np.searchsorted(self.lexicon, ids)
        at[at == len(self.lexicon)] = 0
        known = self.lexicon[at] == ids if len(self.lexicon) else np.zeros(len(ids), bool)
        two, three, begin = words.grams()
        return {"lex": np.where(known, at + 1, 0), "two": two, "three": three, "begin": begin, "affix": words.affixes()}

    def emission(self, ix: dict[str, np.ndarray]) -> np.ndarray:
        if not len(ix["begin"]):
            return np.empty((0, len(self.langs)), np.float32)
        out = np.add.reduceat(self.w["two"][ix["two"]] + self.w["three"][ix["three"]], ix["begin"], axis=0)
        for i in range(6):
            out += self.w["affix"][ix["affix"][:, i]]
        return out + self.w["lex"][ix["lex"]]

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text number, marginals) of every word."""
        found = Words.of(texts)
        return found.text, marginals(self.emission(self.indexes(found)), found.text, self.trans)[0]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and mean marginal of each text; `und` and 0 where there is no letter."""
        letters = np.array([has_letter(t) for t in texts], bool)
        text, p = self.words([t or "" for t in texts])
        k = max(1, len(self.langs))
        total = np.stack([np.bincount(text, weights=p[:, i], minlength=len(texts)) for i in range(p.shape[1])], axis=1) if self.langs else np.zeros((len(texts), 1))
        # Letters may all stand outside words as they are cut here; such texts get the flat distribution.
        total = np.where(total.sum(axis=1, keepdims=True) > 0, total, 1 / k)
        share = total / total.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        ok = letters & bool(self.langs)
        return [self.langs[b] if o else "und" for b, o in zip(best, ok, strict=True)], np.where(ok, share.max(axis=1), 0.0)


def fit(texts: list[str], langs: list[str], steps: int = STEPS, ridge: float = 1e-6) -> Crf:
    """Adam on the conditional log-likelihood of the words' labels; every word of a text has the text's label."""
    names = tuple(sorted(set(langs)))
    k = len(names)
    if not k:
        return Crf((), np.empty(0, np.uint64), {n: np.zeros((d, 1), np.float32) for n, d in (("two", _B2), ("three", _B3), ("affix", _AFFIX), ("lex", 1))}, np.zeros((1, 1), np.float32))
    words = Words.of(texts)
    found, count = np.unique(words.ids(), return_counts=True)
    lexicon = np.sort(found[np.argsort(-count, kind="stable")[:LEXICON]])
    w = {n: np.zeros((d, k), np.float32) for n, d in (("two", _B2), ("three", _B3), ("affix", _AFFIX), ("lex", len(lexicon) + 1))}
    model = Crf(names, lexicon, w, np.zeros((k, k), np.float32))
    ix = model.indexes(words)
    label = np.array([names.index(x) for x in langs])[words.text]
    n = len(label)
    if not n:
        return model
    truth = np.eye(k, dtype=np.float32)[label]
    same = words.text[1:] == words.text[:-1]
    seen = np.bincount(label[:-1][same] * k + label[1:][same], minlength=k * k).reshape(k, k)
    length = np.diff(np.r_[ix["begin"], len(ix["two"])])
    owner = np.repeat(np.arange(n), length)
    weights = {**w, "trans": model.trans}
    first, second = ({x: np.zeros_like(v) for x, v in weights.items()} for _ in range(2))
    for step in range(1, steps + 1):
        p, pairs = marginals(model.emission(ix), words.text, model.trans, expect=True)
        delta = (truth - p) / n
        g = {}
        for name, index, d in (("two", ix["two"], delta[owner]), ("three", ix["three"], delta[owner]), ("lex", ix["lex"], delta)):
            g[name] = np.stack([np.bincount(index, weights=d[:, i], minlength=len(w[name])) for i in range(k)], axis=1)
        g["affix"] = sum(np.stack([np.bincount(ix["affix"][:, j], weights=delta[:, i], minlength=_AFFIX) for i in range(k)], axis=1) for j in range(6))
        g["trans"] = (seen - pairs) / n
        for name, v in weights.items():
            d = g[name].astype(np.float32) - ridge * v
            first[name] += 0.1 * (d - first[name])
            second[name] += 0.05 * (d * d - second[name])
            v += 0.1 * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.95**step)) + 1e-7)
    return model


def train(docs: DataFrame, rows: int = TRAIN_DOCS) -> Crf:
    """docs: doc_id, text, lang; which rows may teach is the caller's choice. Null languages and texts are left out.
    A bounded sample of whole texts reaches the driver."""
    known = docs.where("lang is not null and text is not null and doc_id is not null").select("doc_id", "lang", "text")
    found = sample_labelled(known, "lang", rows).orderBy("doc_id").collect()
    return fit([r["text"] for r in found], [r["lang"] for r in found])


def _in_parts(model: Crf, texts: list[str | None], size: int = SLICE) -> tuple[list[str], np.ndarray]:
    """Predictions, `size` characters at a time and one text at least, so that memory stays bounded."""
    langs, scores = [], [np.empty(0)]
    for at, end in slices(texts, size):
        got, p = model.predict(texts[at:end])
        langs += got
        scores.append(p)
    return langs, np.concatenate(scores)


def _labelled(model: Crf):
    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = _in_parts(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def predict_texts(docs: DataFrame, model: Crf) -> DataFrame:
    """(doc_id, lang_pred, score) for every row: the language of the whole text and its mean marginal; `und` and 0 where
    the text is null or has no letter. Repeated rows give repeated results; other columns are not read."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _labelled(model), "doc_id long, lang_pred string, score double"
    )


def labeller(model: Crf, text: str = "text") -> Column:
    """struct<lang_pred,score> as a column, for filters that keep whole rows where they are. Declared nondeterministic, as
    Spark would otherwise push a filter on it below the projection and label each text twice."""

    @give_back
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            langs, scores = _in_parts(model, t.tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        return run(texts)

    return label.asNondeterministic()(F.col(text))
