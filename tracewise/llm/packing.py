"""Best-two-fit packing of tokenized documents into sequences of a fixed size.

A sequence is filled greedily, the longest documents first; then its smallest document is replaced with two unpacked ones
that fit the widened gap more tightly. Lengths are whole numbers up to the size of a sequence, so a corpus of any size is
a histogram of that many counts: the plan is made on counts, all sequences of one pattern at once, and tasks look up the
places of their own documents by length and rank.
"""

from __future__ import annotations

import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, kept, materialise, small_batches

SIZE = 4096  #: tokens of a sequence
END = 1  #: id after each document
BLOCK = 200_000  #: characters of a text that are split at once, up to the next space
_RANKS = 1 << 45  #: more pieces of one length than this are not expected

_LETTERS, _NUMBERS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾", " \t-\r\x85\xa0"
_PARTS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}{_SPACES}]+")
_WORDS, _SPACE = re.compile("[^ \t-\r]+"), re.compile("[ \t-\r]")
#: Fixed values, those of a tokenizer file that PartTable can take apart: normalizers, pre-tokenizers and their pattern.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_names() -> dict[int, str]:
    """Latin-1 character -> names of its UTF-8 bytes in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {c: "".join(names[b] for b in chr(c).encode()) for c in range(256)}


class PartTable(dict):
    """Part of a text -> its ids as 32-bit numbers, each part encoded by the library when it is first met.

    Parts are what the tokenizer itself splits a lower-cased text of Latin-1 characters into; a word of other characters
    is one part, as nothing crosses a space. Holds two generations of `limit` bytes each: what was not met while the
    younger one filled up is forgotten.
    """

    OVERHEAD = 220

    def __init__(self, file: str, limit: int = 40_000_000) -> None:
        from tokenizers import Tokenizer

        said = json.loads(file)
        self.tokenizer = Tokenizer.from_str(file)
        self.model, self.limit, self.size, self.older = self.tokenizer.model, limit, 0, {}
        self.specials = tuple(t["content"] for t in said["added_tokens"])
        pre = (said.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        kinds = [n["type"] for n in (said.get("normalizer") or {}).get("normalizers", [])]
        self.separable = kinds == _NORMALIZERS and pre[0].get("pattern") == {"Regex": _PATTERN} and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        self.names = _byte_names()

    def __missing__(self, part: str) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            if part.isascii() or all(ord(c) < 256 for c in part):
                found = [t.id for t in self.model.tokenize(part.translate(self.names))]
            else:
                found = self.tokenizer.encode(part, add_special_tokens=False).ids
            ids = np.array(found, "<u4").tobytes()
        self.size += self.OVERHEAD + len(part) + len(ids)
        if self.size > self.limit:
            self.older, self.size = dict(self), 0
            self.clear()
        self[part] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of the library's encode(text, add_special_tokens=False), as little-endian unsigned 32-bit numbers."""
        if not self.separable or any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        out, at = [], 0
        while at < len(text):
            gap = _SPACE.search(text, at + BLOCK)
            end = gap.start() if gap else len(text)
            block = text[at:end]
            try:
                block.encode("latin-1")
                out += map(self.__getitem__, _PARTS.findall(block.lower()))
            except UnicodeEncodeError:
                for word in _WORDS.findall(block):
                    latin = word.isascii() or all(ord(c) < 256 for c in word)
                    out += map(self.__getitem__, _PARTS.findall(word.lower()) if latin else [word])
            at = end
        return b"".join(out)


def _tokenized(file: str, size: int, end: int):
    of_file, last = hashlib.sha256(file.encode()).hexdigest(), np.array([end], "<u4").tobytes()

    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(f"parts_{of_file}", lambda: PartTable(file))
        for batch in batches:
            row, piece, start, ids = [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                found = table.encode(text or "") + last
                for k, at in enumerate(range(0, len(found), 4 * size)):
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    ids.append(found[at : at + 4 * size])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                ["key", "piece", "start", "length", "ids"],
            )

    return run


def tokenize_documents(docs: DataFrame, tokenizer_path: str, size: int = SIZE, end: int = END, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece int, start, length, ids binary) of the pieces of every row of docs, in no order.

    A document is the ids of its whole text, no special tokens added, and then `end`; longer ones than `size` are cut into
    pieces of that many tokens, the last of which may be shorter. ids: little-endian unsigned 32-bit numbers. A null or
    empty text is `end` alone. Repeated rows give repeated pieces; null ids stay; the id keeps its name and type. Other
    columns are not read. An empty table gives no pieces.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        file = f.read()
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
        .mapInArrow(_tokenized(file, size, end), f"key {kind}, piece int, start long, length long, ids binary").withColumnRenamed("key", id_col)
    )


def patterns(counts: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, how many in a sequence), longest first]) of the sequences into which counts[length] pieces go.

    Each is filled greedily, then its smallest piece gives way to the two unpacked ones that leave the smallest gap, if that
    is smaller than before; of equal pairs the one with the longer piece. A sequence is made as often as its pieces last,
    which is what making it one by one gives. Patterns are bounded by the lengths, whatever the counts.
    """
    size = len(counts) - 1
    left = counts.astype(np.int64).copy()
    have = np.flatnonzero(left).tolist()

    def longest(x: int) -> int:
        """The longest length with pieces left that is not longer; 0 for none."""
        i = bisect_right(have, x)
        return have[i - 1] if i else 0

    out = []
    while top := longest(size):
        used, gap, at = {}, size, top
        while at:
            used[at] = min(int(left[at]), gap // at)
            gap -= used[at] * at
            at = longest(min(gap, at - 1))
        need, smallest = dict(used), min(used)
        if gap and (pair := _tighter(left, used, smallest, gap)):
            used[smallest] -= 1
            for x in pair:
                need[x], used[x] = need.get(x, 0) + 1, used.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in need.items())
        used = {x: n for x, n in used.items() if n}
        for x, n in used.items():
            left[x] -= n * times
            if not left[x]:
                del have[bisect_left(have, x)]
        out.append((times, sorted(used.items(), reverse=True)))
    return out


def _tighter(left: np.ndarray, used: dict[int, int], smallest: int, gap: int) -> tuple[int, int] | None:
    """The two unpacked lengths, the longer first, with the largest sum that fits in gap + smallest and exceeds smallest."""
    room = gap + smallest
    free = left[: room + 1].copy()
    for x, n in used.items():
        if x <= room:
            free[x] -= n
    have = np.flatnonzero(free > 0)
    if not len(have):
        return None
    other = np.searchsorted(have, room - have, "right") - 1
    alone = (other >= 0) & (have[other] == have) & (free[have] < 2)
    other -= alone
    total = np.where(other >= 0, have + have[other], 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(have[best]), int(have[other[best]])) if total[best] > smallest else None


def places(plan: list[tuple[int, list[tuple[int, int]]]]) -> tuple[np.ndarray, ...]:
    """The plan as sorted keys (length and first rank) with the number of sequences, the first sequence and the first
    offset of each: ranks of a length go over the sequences of a pattern, then to the next place in them."""
    rows, ranks, first = [], {}, 0
    for times, pieces in plan:
        at = 0
        for length, n in pieces:
            rows.append((length * _RANKS + ranks.get(length, 0), times, first, at))
            ranks[length] = ranks.get(length, 0) + times * n
            at += length * n
        first += times
    return tuple(np.array(sorted(rows), np.int64).reshape(-1, 4).T)


def _ranked(size: int):
    """Adds the task and the rank of a row among those of its length in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            length = batch.column(1).to_numpy(zero_copy_only=False)
            if len(length) and not (1 <= length.min() and length.max() <= size):  # false for nulls, too
                raise ValueError(f"lengths have to be from 1 to {size}")
            length = length.astype(np.int64)
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.searchsorted(sorted_, sorted_) + before[sorted_]
            before += np.bincount(length, minlength=size + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(length), task, np.int32)), pa.array(rank)], ["row", "length", "task", "rank"])

    return run


def _placed(plan: tuple[np.ndarray, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times, first, at = plan
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            own = length * _RANKS + rank
            entry = np.searchsorted(keys, own, "right") - 1
            place, sequence = np.divmod(own - keys[entry], times[entry])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(first[entry] + sequence), pa.array(at[entry] + place * length)], ["row", "sequence_id", "offset"]
            )

    return run


def pack(pieces: DataFrame, size: int = SIZE, length_col: str = "length") -> DataFrame:
    """pieces with sequence_id (from 0) and offset (place in the sequence, gapless from 0), by best-two-fit.

    Lengths are whole numbers from 1 to size; others, and nulls, fail the job. Every row is placed once, repeated ones too.
    Columns named sequence_id or offset are replaced; all others, of any name, are carried along. What reaches the driver
    is a count for each length. No pieces give no rows.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = pieces.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"), F.col(f"`{length_col}`").cast("long").alias("length"))
    kind = rows.schema["row"].dataType.simpleString()
    rows = materialise(rows.mapInArrow(_ranked(size), f"row {kind}, length long, task int, rank long"), "ranked-pieces")
    held = materialise(rows.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths-by-task")
    counts = np.zeros(size + 1, np.int64)
    for length, n in held.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    before = held.select("task", "length", F.expr("sum(n) over (partition by length order by task) - n").alias("before"))
    ranked = rows.join(before, ["task", "length"]).select("row", "length", (F.col("before") + F.col("rank")).alias("rank"))
    out = ranked.mapInArrow(_placed(places(patterns(counts))), f"row {kind}, sequence_id long, offset long")
    return out.select(*(F.col("row")[c].alias(c) for c in names), "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids binary, starts array<long>) of packed pieces with their ids: the tokens of each sequence in
    order, and where its pieces start. A sequence holds as many tokens as were asked for at most, so groups are bounded."""
    of = F.array_sort(F.collect_list(F.struct("offset", "length", "ids")))
    out = placed.groupBy("sequence_id").agg(of.alias("of"))
    ids = F.unhex(F.array_join(F.transform("of", lambda p: F.hex(p.ids)), ""))
    return out.select("sequence_id", F.aggregate("of", F.lit(0).cast("long"), lambda n, p: n + p["length"]).alias("length"), ids.alias("ids"), F.transform("of", lambda p: p.offset).alias("starts"))
