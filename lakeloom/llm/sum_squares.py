"""Packing documents into windows by the sum-of-squares rule.

Each task packs the rows it reads, online: a document's ids fill whole windows first, and what
is left over goes to the fill level that leaves the smallest sum of squared counts of partially
filled windows, counts being kept in one array by level. Windows still open when the task's rows
end are laid end to end and cut again: full windows, then one short sequence per power of two,
which needs no padding. Open windows are all a task holds, so memory does not grow with its rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeloom.llm.shared import col, task_names
from lakeloom.llm.tokens import blocks, with_end, word_ids

#: sequences of one task; its number is above them in sequence_id
PER_TASK = 40


class Packer:
    """One task's windows. A piece is (document, start in it, ids, ids of the document)."""

    def __init__(self, width: int):
        self.width = width
        self.counts = np.zeros(width, dtype=np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(width)]
        self.sequences = 0

    def _emit(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, len(ids), zlib.crc32(ids.tobytes()), total, self.sequences, offset
            offset += len(ids)
        self.sequences += 1

    def level_for(self, size: int) -> int:
        """The fill level (0 opens a window) whose choice leaves the smallest sum of squares."""
        room = self.width - size
        levels = np.concatenate([[0], 1 + np.flatnonzero(self.counts[1 : room + 1])])
        after = np.append(self.counts, 0)[levels + size]
        gain = np.where(levels + size < self.width, 2 * after + 1, 0) - np.where(
            levels > 0, 2 * self.counts[levels] - 1, 0
        )
        best = np.flatnonzero(gain == gain.min())[-1]  # ties to the fullest window
        return int(levels[best])

    def add(self, doc, ids: np.ndarray) -> Iterator[tuple]:
        total, full = len(ids), len(ids) // self.width * self.width
        for start in range(0, full, self.width):
            yield from self._emit([(doc, start, ids[start : start + self.width], total)])
        size = total - full
        if not size:
            return
        level = self.level_for(size)
        window = []
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
        window.append((doc, full, ids[full:].copy(), total))
        if level + size == self.width:
            yield from self._emit(window)
        else:
            self.open[level + size].append(window)
            self.counts[level + size] += 1

    def close(self) -> Iterator[tuple]:
        pieces = [p for level in reversed(self.open) for window in level for p in window]
        left = sum(len(p[2]) for p in pieces)
        while left:
            room = self.width if left >= self.width else 1 << (left.bit_length() - 1)
            left -= room
            window = []
            while room:
                doc, start, ids, total = pieces[0]
                taken = min(room, len(ids))
                window.append((doc, start, ids[:taken], total))
                room -= taken
                if taken == len(ids):
                    pieces.pop(0)
                else:
                    pieces[0] = (doc, start + taken, ids[taken:], total)
            yield from self._emit(window)


def pack(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 2048,
    end_id: int = 1,
) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``end_id`` closes each document, so a null or empty text is the one piece of its end id.
    Pieces of a document do not overlap and leave nothing out; offsets in a sequence have no
    gaps; a sequence holds ``width`` ids or a power of two. Rows that repeat a doc_id, or lack
    one, are documents of their own. Rows are packed where they are read, without a shuffle, and
    a repeated task gives the same pieces. An empty table gives none.
    """
    kept = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = word_ids(tokenizer), task_names()[0]
        packer = Packer(width)
        key = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(names)
            columns[5] = [task << PER_TASK | s for s in columns[5]]
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], key)] + [pa.array(c, pa.int64()) for c in columns[1:]], names=names
            )

        for batch in batches:
            key = batch.schema.field(0).type
            for block in blocks(batch, "text"):
                ids, bounds = with_end(*known.of(block.column(1)), end_id)
                rows = []
                for i, doc in enumerate(block.column(0).to_pylist()):
                    rows.extend(packer.add(doc, ids[bounds[i] : bounds[i + 1]]))
                yield batch_of(rows)
        rows = list(packer.close())
        if rows:
            yield batch_of(rows)

    return kept.mapInArrow(
        packed,
        f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
