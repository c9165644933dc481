"""SentencePiece encoding and decoding with a table of distinct chunks.

No piece of the model may hold a white-space marker after another character, so no piece crosses the start of a marked
word. Each worker process keeps a table of the marked words it has met, over all its tasks, segments each of them once
with the library and joins the ids back by position. A table for the whole corpus would shuffle every word of it, more
than the input itself.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewise.llm.shared import give_back, kept, slices, small_batches

MARK = "▁"
SLICE = 200_000  #: characters of texts encoded at once, or one text
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


def separable(pieces: list[str]) -> bool:
    """Whether no piece crosses the start of a marked word."""
    return all(MARK not in p.lstrip(MARK) for p in pieces)


class ChunkTable:
    """Marked word -> (ids as text, ids as 32-bit numbers); emptied before it holds more than `limit` bytes, counting
    OVERHEAD for a word, apart from the words of one slice of texts."""

    OVERHEAD = 250

    def __init__(self, model: str | bytes, limit: int = 16_000_000) -> None:
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor()
        self.sp.Load(model_proto=model) if isinstance(model, bytes) else self.sp.Load(model)
        self.limit, self.known, self.size = limit, {}, 0
        if not separable([self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]):
            raise ValueError("pieces of this model cross white-space markers")
        if "".join(self.sp.encode(" ﬁ  a ", out_type=str)) != f"{MARK * 2}ﬁ{MARK * 2}a{MARK}":
            raise ValueError("this model's normaliser changes texts; chunks of the raw text would not be its own")

    @staticmethod
    def chunks(text: str | None) -> list[str]:
        """Marked words in order; the first has the marker that the library puts before every text."""
        return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, found: set[str]) -> None:
        if self.size > self.limit:
            self.known, self.size = {}, 0
        new = [c for c in found if c not in self.known]
        # The library puts the first marker itself; it gives nothing for an empty text, so a lone marker is looked up.
        for chunk, ids in zip(new, self.sp.encode([c[1:] for c in new], num_threads=1) if new else (), strict=True):
            ids = ids or [self.sp.piece_to_id(MARK)]
            self.known[chunk] = entry = (",".join(map(str, ids)), np.array(ids, np.int32).tobytes())
            self.size += self.OVERHEAD + len(chunk) + len(entry[0]) + len(entry[1])

    def encode(self, text: str | None) -> list[int]:
        parts = self.chunks(text)
        self.learn(set(parts))
        return np.frombuffer(b"".join([self.known[c][1] for c in parts]), np.int32).tolist()


def _encoded(model: bytes, size: int = SLICE):
    of_model = hashlib.sha256(model).hexdigest()

    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = kept(f"table_{of_model}", lambda: ChunkTable(model))
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, end in slices(texts, size):
                split = [table.chunks(t) for t in texts[at:end]]
                table.learn({c for s in split for c in s})
                known, counts, raw, decoded, digests = table.known, [], [], [], []
                for s in split:
                    raw.append(b"".join([known[c][1] for c in s]))
                    counts.append(len(raw[-1]) // 4)
                    digests.append(hashlib.sha256(",".join([known[c][0] for c in s]).encode()).hexdigest())
                    decoded.append(table.sp.decode(np.frombuffer(raw[-1], np.int32).tolist()) if s else "")
                ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(raw), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(counts, pa.int64()), ids, pa.array(decoded, pa.string()), pa.array(digests)],
                    ["key", "n_tokens", "ids", "decoded", "ids_sha256"],
                )

    return run


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids array<int>, decoded, ids_sha256) for every row of docs, in no order.

    ids are those of the sentencepiece library for the whole text, without begin or end ids; decoded is its decode(ids).
    A null or empty text has no ids and decodes to an empty text. Repeated rows give repeated results; null ids stay.
    Other columns are not read; the id keeps its name and type. Raises ValueError for a model whose pieces cross markers.
    """
    with open(model_path, "rb") as f:
        model = f.read()
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
        .mapInArrow(_encoded(model), f"key {kind}, n_tokens long, ids array<int>, decoded string, ids_sha256 string")
        .withColumnRenamed("key", id_col)
    )
