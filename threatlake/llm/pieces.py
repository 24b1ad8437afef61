"""Encoding with a SentencePiece model by a table of distinct chunks.

The model's pieces never have a whitespace marker after another character, so no merge
crosses from a word to the next marker. A text is cut where a run of markers begins, each
distinct chunk is segmented once in a task by the library, and the chunks' ids are
joined in the order of their places. A model with such pieces, or one whose normaliser
changes the text, is refused (``ValueError``): its texts must be encoded whole.

Defined cases: a null text is encoded as an empty one; a text of markers alone is one chunk; equal
rows get equal results; an empty table gives an empty result. A task's table starts anew when it
holds ``TABLE`` chunks, which changes no result, only how often a chunk is segmented.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import free_name, release, slices

MARK = "▁"
#: A chunk, its markers written as spaces.
CHUNK = re.compile(" +[^ ]*")
TABLE = 150_000


def load(path: str):
    """The processor of a model file, after checking that chunks are independent."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError("pieces of this model cross whitespace markers")
    probe = "ﬁ ①  Å\tx "  # a normaliser would change it
    if model.decode(model.encode(probe)) != probe:
        raise ValueError("this model's normaliser changes texts")
    return model


class Places(dict):
    """Distinct chunks in the order of their coming; ``new`` are those without ids as yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = place = len(self)
        self.new.append(chunk)
        return place


class Encoder:
    """A model with its table of distinct chunks, for one task."""

    def __init__(self, path: str, table: int = TABLE):
        self.model, self.limit = load(path), table
        self.begin, self.end = self.model.bos_id(), self.model.eos_id()
        letter = self.model.encode("x")
        self.lone_mark = self.model.encode("x ")[len(letter) :]
        self._clear()

    def _clear(self) -> None:
        self.places = Places()
        self.ids = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _learn(self) -> None:
        """Segment the new chunks; the library puts the first marker of a chunk before it."""
        new, self.places.new = self.places.new, []
        if not new:
            return
        coded = self.model.encode(new, num_threads=1)
        if "" in new:
            coded[new.index("")] = self.lone_mark
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter(itertools.chain.from_iterable(coded), np.uint32, int(sizes.sum()))
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])

    def _chunks(self, text: str) -> np.ndarray:
        """Places of a text's chunks; a chunk is written without its first marker."""
        text = text.replace(MARK, " ")
        words = text.split(" ")
        if "" in words:
            words = [c[1:] for c in CHUNK.findall(" " + text)] if text else []
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, begin and end included."""
        if len(self.places) > self.limit:
            self._clear()
        cut = [self._chunks(t) for t in texts]
        self._learn()
        out = []
        for which in cut:
            first, size = self.starts[which], self.starts[which + 1] - self.starts[which]
            ids = np.empty(int(size.sum()) + 2, np.uint32)
            ids[0], ids[-1] = self.begin, self.end
            ids[1:-1] = self.ids[np.arange(len(ids) - 2) + np.repeat(first - (np.cumsum(size) - size), size)]
            out.append(ids)
        return out


def _append(batch: pa.RecordBatch, name: str, made: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])


Batches = Iterator[pa.RecordBatch]


def _encoding(model: str, into: str, table: int, slice_rows: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        encoder = Encoder(model, table)
        for whole in batches:
            for batch in slices(whole, slice_rows):
                texts = [t.as_py() or "" for t in batch.column(batch.schema.get_field_index("text"))]
                ids = [i.astype("<u4").tobytes() for i in encoder.encode(texts)]
                yield _append(batch, into, pa.array(ids, pa.binary()))
        del encoder
        release()

    return run


def _decoding(model: str, ids: str, into: str, slice_rows: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        library = load(model)
        for whole in batches:
            for batch in slices(whole, slice_rows):
                held = [b.as_py() for b in batch.column(batch.schema.get_field_index(ids))]
                texts = [None if b is None else library.decode(np.frombuffer(b, "<u4").tolist()) for b in held]
                yield _append(batch, into, pa.array(texts, pa.string()))
        release()

    return run


def encoded(docs: DataFrame, model: str, into: str | None = None, table: int = TABLE, slice_rows: int = 512) -> DataFrame:
    """``docs`` with a binary column of ids, little-endian unsigned 32-bit integers."""
    name = into or free_name(docs, "ids")
    load(model)
    return docs.mapInArrow(_encoding(model, name, table, slice_rows), T.StructType([*docs.schema.fields, T.StructField(name, T.BinaryType())]))


def decoded(rows: DataFrame, model: str, ids: str = "ids", into: str | None = None, slice_rows: int = 512) -> DataFrame:
    """``rows`` with the text of a binary column of ids; null ids give null."""
    name = into or free_name(rows, "decoded")
    return rows.mapInArrow(_decoding(model, ids, name, slice_rows), T.StructType([*rows.schema.fields, T.StructField(name, T.StringType())]))


def encoded_and_back(docs: DataFrame, model: str, ids: str = "ids", back: str = "decoded", table: int = TABLE, slice_rows: int = 512) -> DataFrame:
    """``decoded(encoded(docs))`` in one Python worker a task.

    One operator behind the other has two workers a task, and Spark holds a whole batch of texts and ids for the second; here
    ``slice_rows`` rows go from the one to the other.
    """
    load(model)
    encode, decode = _encoding(model, ids, table, slice_rows), _decoding(model, ids, back, slice_rows)
    fields = [*docs.schema.fields, T.StructField(ids, T.BinaryType()), T.StructField(back, T.StringType())]
    return docs.mapInArrow(lambda batches: decode(encode(batches)), T.StructType(fields))
