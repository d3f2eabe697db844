"""Operator 1: sum-of-squares online packing of documents into fixed windows.

Each scan task packs its own rows as they come, with a level array N(h) of the
partially filled windows at fill level h. An item of s ids goes to the level whose
choice minimises the sum of N(h)**2 afterwards (ties: the fullest). Documents of a
window or more give full windows first; their rest is the item. When the rows end,
the windows still open are poured into each other by cutting pieces, so a task
leaves one window with padding at most (fill levels at a power of two need none
and stay). There is no shuffle; a task that runs again gives the same rows.

Nulls: a null text is an empty document (its end id alone); a null doc_id is kept.
Repeated rows are packed each on its own. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, released, text_buffer

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: sequence_id = task << TASK_SHIFT | number in the task
TASK_SHIFT = 36


class LevelPacker:
    """Online packing of items below ``window`` ids; yields windows when they close."""

    def __init__(self, window: int) -> None:
        self.window = window
        #: twice N(h); the ends are set so that one difference gives every case's cost
        self.twice = np.zeros(window + 1, np.int64)
        self.twice[0], self.twice[window] = 1, -1
        self.at: list[list[list]] = [[] for _ in range(window + 1)]

    def place(self, size: int, item: object) -> list | None:
        here = self.twice[: self.window + 1 - size]
        cost = np.where(here > 0, self.twice[size:] - here, np.iinfo(np.int64).max)
        level = len(cost) - 1 - int(np.argmin(cost[::-1]))
        if level:
            self.twice[level] -= 2
            held = self.at[level].pop()
        else:
            held = []
        held.append(item)
        if level + size == self.window:
            return held
        self.twice[level + size] += 2
        self.at[level + size].append(held)
        return None

    def drain(self) -> Iterator[list]:
        """The open windows; an item is (key, start, length), cut where a window is full."""
        left = [(h, held) for h in range(self.window - 1, 0, -1) for held in self.at[h]]
        keep = [(h, held) for h, held in left if h & (h - 1) == 0]
        yield from (held for _, held in keep)
        left = [(h, held) for h, held in left if h & (h - 1)]
        i, j = 0, len(left) - 1
        while i < j:
            level, held = left[i]
            other_level, other = left[j]
            while level < self.window and other:
                key, start, length = other.pop()
                take = min(length, self.window - level)
                held.append((key, start, take))
                if take < length:
                    other.append((key, start + take, length - take))
                level += take
                other_level -= take
            left[i], left[j] = (level, held), (other_level, other)
            if level == self.window:
                yield held
                i += 1
            if not other:
                j -= 1
        if i == j and left[i][1]:
            yield left[i][1]


def pack(docs: DataFrame, tokenizer: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document with their token ids (little-endian 32-bit) and places.

    tokenizer: path of a word-level BPE file of the ``tokenizers`` library; it must
    exist on the executors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .wordbpe import WordBpe

        global _BPE
        if _BPE is None or _BPE[0] != tokenizer:
            _BPE = (tokenizer, WordBpe(tokenizer))
        bpe = _BPE[1]
        task = TaskContext.get().partitionId() << TASK_SHIFT
        packer, held_ids, made, rows = LevelPacker(window), {}, 0, []

        def emit(pieces: list) -> None:
            nonlocal made
            at = 0
            for key, start, length in pieces:
                doc, ids = held_ids[key][:2]
                part = ids[start : start + length]
                rows.append((doc, start, length, part.tobytes(), len(ids), task | made, at))
                at += length
                held_ids[key][2] -= length
                if not held_ids[key][2]:
                    del held_ids[key]
            made += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

        key = 0
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            raw, offsets = text_buffer(batch.column(1))
            for a, b in chunks(offsets):
                part = offsets[a : b + 1]
                for doc, ids in zip(doc_ids[a:b], bpe.rows(raw[part[0] : part[-1]], part - part[0]), strict=True):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    held_ids[key] = [doc, ids, len(ids)]
                    full = len(ids) // window * window
                    for start in range(0, full, window):
                        emit([(key, start, window)])
                    if full < len(ids):
                        done = packer.place(len(ids) - full, (key, full, len(ids) - full))
                        if done:
                            emit(done)
                    key += 1
                if len(rows) >= 2000:
                    yield flush()
        for pieces in packer.drain():
            emit(pieces)
            if len(rows) >= 2000:
                yield flush()
        yield flush()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(released(run), SCHEMA)


_BPE = None
