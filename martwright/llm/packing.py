"""Packing of token sequences into windows: best fit, longest first.

A document's ids (its tokens and one end id) are cut into full windows and a
rest. Full windows stand alone. Rests are placed longest first, each into the
open window with the least room that still holds it; a segment tree over the
remaining room finds it. Each task packs the rests of its own input, at most
``RESTS`` at a time, so no shuffle is needed and padding is less than one window
for each such group plus what no rest can fill.

Null text counts as empty: one end id. Repeated rows are packed each for itself.
An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, picked, sliced
from martwright.llm.tokenizing import PIECES_HELD, tokenizer

WINDOW = 2048
RESTS = 1 << 17


class OpenWindows:
    """Windows by remaining room, with a tree of counts above them."""

    def __init__(self, window: int) -> None:
        self.leaves = 1 << window.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the window with the least room of at least ``need``: (window, room)."""
        node = need + self.leaves
        if not self.counts[node]:
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.windows[room].pop(), room

    def _add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.counts[node] += change
            node >>= 1


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Window and offset of each length (1 to ``window``), and the number of windows."""
    into, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    windows, used = OpenWindows(window), 0
    for k in np.argsort(-np.asarray(lengths), kind="stable").tolist():
        length = int(lengths[k])
        place = windows.tightest(length)
        if place is None:
            place, used = (used, window), used + 1
        into[k], offset[k] = place[0], window - place[1]
        if place[1] > length:
            windows.put(place[0], place[1] - length)
    return into, offset, used


NUMBERS = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW,
    id_column: str = "doc_id", text_column: str = "text", with_ids: bool = True,
    pieces_held: int = PIECES_HELD,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``ids`` are little-endian unsigned 32-bit integers, left out unless asked for.
    ``pieces_held`` bounds what a worker remembers of texts: time against memory,
    never the result.
    """
    source = picked(docs, doc_id=id_column, text=text_column)
    names = ["doc_id", *NUMBERS, *(["ids"] if with_ids else [])]
    end = np.uint32(end_id).tobytes()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, doc_type = tokenizer(tokenizer_path, pieces_held), None
        next_window = TaskContext.get().partitionId() << 40
        rests: list[tuple] = []

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(columns[0], doc_type), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if with_ids:
                arrays.append(pa.array(columns[7], pa.binary()))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def placed() -> Iterator[pa.RecordBatch]:
            nonlocal next_window
            into, offset, used = best_fit_decreasing(np.array([r[2] for r in rests], np.int64), window)
            rows = [(*r[:5], next_window + w, o, *r[7:]) for r, w, o in zip(rests, into.tolist(), offset.tolist(), strict=True)]
            for k in range(0, len(rows), 10_000):
                yield out(rows[k : k + 10_000])
            next_window += used
            rests.clear()

        for batch, texts in sliced(batches):
            doc_type, full = batch.schema.field("doc_id").type, []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    row = (doc, start, length, zlib.crc32(piece), total, 0, 0, *((piece,) if with_ids else ()))
                    if length < window:
                        rests.append(row)
                    else:
                        full.append((*row[:5], next_window, *row[6:]))
                        next_window += 1
            if full:
                yield out(full)
            if len(rests) >= RESTS:
                yield from placed()
        if rests:
            yield from placed()

    doc_type = source.schema["doc_id"].dataType.simpleString()
    types = ", ".join([f"doc_id {doc_type}", *(f"{n} long" for n in NUMBERS), *(["ids binary"] if with_ids else [])])
    return mapped(source, packed, types)


def sequences(pieces: DataFrame) -> DataFrame:
    """The windows themselves: sequence_id, its documents in order, and its ids (at most a window's)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    grouped = pieces.groupBy("sequence_id").agg(parts.alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda whole, piece: F.concat(whole, piece["ids"]))
    return grouped.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), joined.alias("ids"))
