"""Sum-of-squares online packing of token sequences into windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rideframe.llm.encoding import append_id, encoder
from rideframe.llm.support import binary_array, reach_workers, text_slices

#: Open windows that a packer holds at most.
MAX_OPEN = 4096
#: doc, position in the document, length, tokens of the document, ids.
Piece = tuple[object, int, int, int, np.ndarray]
SEQUENCES_PER_TASK = 1 << 32
#: Text encoded at a time. Encoding takes some twenty times as much for a moment, in every worker.
ENCODED_BYTES = 1 << 22

PIECE_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)


class SumOfSquaresPacker:
    """Places pieces one by one into the open window that keeps the fill levels most even.

    ``levels[h]`` counts open windows with ``h`` tokens. A piece of ``s`` tokens goes to the
    level ``h`` (or to a new window) that minimises the sum of the squared counts afterwards;
    the fullest such level wins a tie. Full windows leave at once. With more than ``max_open``
    open windows the fullest one is filled up from the emptiest one and leaves, which may cut a
    piece. ``flush`` does so until no window is left, so one window at most, the last, stays partly filled.
    """

    def __init__(self, window: int, first_id: int = 0, max_open: int = MAX_OPEN):
        self.window, self.next_id, self.max_open = window, first_id, max_open
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = {}
        self.n_open = 0
        self.closed: list[tuple[int, int, Piece]] = []

    def _close(self, pieces: list[Piece]) -> None:
        offset = 0
        for piece in pieces:
            self.closed.append((self.next_id, offset, piece))
            offset += piece[2]
        self.next_id += 1

    def _best_level(self, size: int) -> int:
        """Change of the sum of squares for each level that has room, level 0 being a new window."""
        room = self.window - size
        change = 1 - 2 * self.levels[: room + 1]
        change[0] = 0
        change[:room] += 2 * self.levels[size : self.window] + 1  # a full window counts no more
        change[1:][self.levels[1 : room + 1] == 0] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def add(self, piece: Piece) -> None:
        size = piece[2]
        level = self._best_level(size) if size < self.window else 0
        pieces: list[Piece] = []
        if level:
            pieces = self._take(level)
        pieces.append(piece)
        if level + size == self.window:
            self._close(pieces)
            return
        self.open.setdefault(level + size, []).append(pieces)
        self.levels[level + size] += 1
        self.n_open += 1
        if self.n_open > self.max_open:
            self._fill_fullest()

    def _take(self, level: int) -> list[Piece]:
        self.levels[level] -= 1
        self.n_open -= 1
        return self.open[level].pop()

    def _fill_fullest(self) -> None:
        used = np.flatnonzero(self.levels)
        full, giving = self._take(int(used[-1])), self._take(int(used[np.flatnonzero(self.levels[used])[0]]))
        room = self.window - int(used[-1])
        while room and giving:
            doc, start, length, total, ids = giving.pop()
            taken = min(room, length)
            full.append((doc, start + length - taken, taken, total, ids[length - taken :]))
            if taken < length:
                giving.append((doc, start, length - taken, total, ids[: length - taken]))
            room -= taken
        for pieces in (full, giving):
            level = sum(p[2] for p in pieces)
            if level == self.window:
                self._close(pieces)
            elif level:
                self.open.setdefault(level, []).append(pieces)
                self.levels[level] += 1
                self.n_open += 1

    def add_document(self, doc, ids: np.ndarray) -> None:
        """Whole windows first, then the rest by the rule above.

        The rest is copied: it may wait long, and a view of it would hold all ids around it.
        """
        for start in range(0, len(ids), self.window):
            part = ids[start : start + self.window]
            if len(part) < self.window:
                part = part.copy()
            self.add((doc, start, len(part), len(ids), part))

    def flush(self) -> None:
        while self.n_open > 1:
            self._fill_fullest()
        if self.n_open:
            self._close(self._take(int(np.flatnonzero(self.levels)[0])))

    def take(self) -> list[tuple[int, int, Piece]]:
        done, self.closed = self.closed, []
        return done


def _rows(placed: list[tuple[int, int, Piece]]) -> pa.RecordBatch:
    pieces = [p for _, _, p in placed]
    ends = np.concatenate([[0], np.cumsum([p[2] for p in pieces])]) * 4
    ids = np.concatenate([p[4] for p in pieces]).astype("<u4")
    columns = [pa.array([p[i] for p in pieces], pa.int64()) for i in (0, 1, 2)]
    columns += [binary_array(ids, ends), pa.array([p[3] for p in pieces], pa.int64())]
    columns += [pa.array([row[i] for row in placed], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, schema=PIECE_SCHEMA)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, id_column: str = "doc_id", text_column: str = "text", max_open: int = MAX_OPEN) -> DataFrame:
    """Pack the token ids of all documents into windows of ``window`` tokens.

    Returns one row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit),
    doc_tokens, sequence_id, offset. Every id of a document, and ``end_id`` after it, lies in
    exactly one piece. Each task packs its own part of the input online, without a shuffle,
    holds at most ``max_open`` open windows and leaves at most one window partly filled. A sequence id
    is the number of the task times 2^32 plus a count. A null or empty text is its end id
    alone; a null id stays null, repeated rows are packed each, further columns are ignored,
    an empty table gives no rows.
    """
    reach_workers(docs.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path)
        packer = SumOfSquaresPacker(window, TaskContext.get().partitionId() * SEQUENCES_PER_TASK, max_open)
        for part in text_slices(batches, "text", ENCODED_BYTES):
            ids, ends = append_id(*encode.encode(part.column("text")), end_id)
            for row, doc in enumerate(part.column("doc_id").to_pylist()):
                packer.add_document(doc, ids[ends[row] : ends[row + 1]])
            if packer.closed:
                yield _rows(packer.take())
        packer.flush()
        if packer.closed:
            yield _rows(packer.take())
        encode.forget()

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(pack, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
