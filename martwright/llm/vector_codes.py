"""Vector codes: product quantization with codebooks trained in whole numbers.

A component x becomes floor(256 x), so all arithmetic is exact. Vectors are cut
into ``parts`` equal parts. A part's codebook starts as that part of the
``entries`` vectors with the smallest ids; each round assigns every part to the
nearest entry and replaces each entry by the floor of its parts' mean; entries
without parts stay. Sums are added up by key over all tasks; only codebooks,
whose size is fixed, reach the driver.

The nearest entry is found by memoised grid cells (``Cells``): a part's coarse
cell is hashed, and for each cell met the entries are cached that can be nearest
to a point of its box: those whose least distance to the box is no more than the
least of all entries' greatest distances. Only they are evaluated, exactly. Cells
are told apart by their coordinates too, so a shared hash costs time, not
correctness; a full cache is emptied.

Rows are dropped whose vector is null or empty or holds a null or non-finite
component. Ties go to the lower index. Ids that are null come last, rows of one
id are ordered by their vectors, and repeated rows count as often as they occur.
With fewer kept rows than ``entries`` there are as many entries as rows. An empty
table gives an empty result. Vectors of unequal length, of a length that the parts
don't divide, or with components of 2^15 and beyond (sums might pass 64 bits)
raise a ValueError.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, matched, mixed, picked, ragged, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
LARGEST = 1 << 23
# Cells along the codebook's extent in a component, and cells of a part that are cached at a time.
ACROSS = 8
CACHED = 1 << 15


class Cells:
    """Nearest entries of one part's codebook ((entries, width) of int64)."""

    def __init__(self, codebook: np.ndarray) -> None:
        self.codebook = codebook
        extent = int((codebook.max(axis=0) - codebook.min(axis=0)).max(initial=0))
        self.shift = max(0, (extent // ACROSS).bit_length())
        self._empty()

    def _empty(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # sorted, with the cell each stands for
        self.cell = np.zeros(0, np.int64)
        self.box = np.zeros((0, self.codebook.shape[1]), np.int64)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.open = np.zeros(0, np.int64)

    def _candidates(self, box: np.ndarray) -> np.ndarray:
        """(cells, entries): whether an entry may be nearest to a point of the cell's box."""
        low = (box << self.shift)[:, None, :]
        high = low + (1 << self.shift) - 1
        least = np.maximum(np.maximum(low - self.codebook, self.codebook - high), 0)
        most = np.maximum(np.abs(self.codebook - low), np.abs(self.codebook - high))
        return (least**2).sum(axis=2) <= (most**2).sum(axis=2).min(axis=1)[:, None]

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell by hash, and whether there is one."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.cell[at], self.hashes[at] == hashes

    def _add(self, hashes: np.ndarray, box: np.ndarray) -> None:
        if len(self.box) + len(box) > CACHED:
            self._empty()
        line, entry = np.nonzero(self._candidates(box))
        lengths = np.bincount(line, minlength=len(box))
        self.starts = np.r_[self.starts, len(self.open) + np.cumsum(lengths) - lengths]
        self.lengths, self.open = np.r_[self.lengths, lengths], np.r_[self.open, entry]
        new = np.arange(len(self.box), len(self.box) + len(box))
        self.box = np.concatenate([self.box, box])
        order = np.argsort(both := np.r_[self.hashes, hashes], kind="stable")
        self.hashes, self.cell = both[order], np.r_[self.cell, new][order]

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each point, the lower of equals, and the squared distance."""
        box = points >> self.shift
        hashes = np.zeros(len(points), np.uint64)
        for k in range(box.shape[1]):
            hashes = mixed(hashes + box[:, k].view(np.uint64) * np.uint64(2 * k + 3))
        first = np.unique(hashes, return_index=True)[1]
        missing = first[~self._known(hashes[first])[1]]
        for k in range(0, len(missing), 4096):
            self._add(hashes[missing[k : k + 4096]], box[missing[k : k + 4096]])
        cell, known = self._known(hashes)
        known[known] = (self.box[cell[known]] == box[known]).all(axis=1)
        index, distance = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
        for ours, all_ in ((np.flatnonzero(known), False), (np.flatnonzero(~known), True)):
            for k in range(0, len(ours), 1 << 14):
                at = ours[k : k + (1 << 14)]
                index[at], distance[at] = self._exact(points[at], None if all_ else cell[at])
        return index, distance

    def _exact(self, points: np.ndarray, cell: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        if cell is None:
            lengths = np.full(len(points), len(self.codebook))
            starts, point = ragged(lengths)
            entry = np.tile(np.arange(len(self.codebook)), len(points))
        else:
            starts, point = ragged(lengths := self.lengths[cell])
            entry = self.open[np.arange(len(point)) - starts[point] + self.starts[cell][point]]
        distance = ((points[point] - self.codebook[entry]) ** 2).sum(axis=1)
        least = np.minimum.reduceat(distance, starts)
        ties = np.flatnonzero(distance == np.repeat(least, lengths))
        return entry[ties[np.unique(point[ties], return_index=True)[1]]], least


Codebooks = np.ndarray  # (parts, entries, width) of int64


def assigned(vectors: np.ndarray, cells: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    """(n, parts) indexes and squared distances of (n, length) vectors."""
    width = vectors.shape[1] // len(cells)
    found = [c.nearest(vectors[:, p * width : (p + 1) * width]) for p, c in enumerate(cells)]
    return np.stack([index for index, _ in found], axis=1), np.stack([distance for _, distance in found], axis=1)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that are kept, with components floor(256 x)."""
    for batch in batches:
        vectors = batch.column("vector")
        vectors = vectors.cast(pa.list_(pa.float64()))
        flat = vectors.flatten()
        lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        starts, line = ragged(lengths)
        values = flat.to_numpy(zero_copy_only=False)  # null is nan here
        poor = np.bincount(line, weights=~np.isfinite(values), minlength=len(lengths))
        kept = (lengths > 0) & (poor == 0)
        values = np.floor(values[kept[line]] * SCALE)
        if (np.abs(values) >= LARGEST).any():
            raise ValueError(f"a component lies beyond {LARGEST // SCALE}")
        ends = pa.array(np.r_[0, np.cumsum(lengths[kept])], pa.int32())
        whole = pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32)))
        rest = batch.drop_columns(["vector"]).filter(pa.array(kept))
        yield pa.RecordBatch.from_arrays([*rest.columns, whole], names=[*rest.schema.names, "whole"])


def _matrix(batch: pa.RecordBatch, length: int) -> np.ndarray:
    whole = batch.column("whole")
    if len(whole) and (np.diff(whole.offsets.to_numpy()) != length).any():
        raise ValueError("vectors of unequal length")
    return whole.flatten().to_numpy().astype(np.int64).reshape(-1, length)


def _summed(codebooks: Codebooks) -> Callable:
    parts, entries, width = codebooks.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sums of each entry's parts in this task, and their number."""
        cells = [Cells(c) for c in codebooks]
        total, n = np.zeros((parts * entries, width), np.int64), np.zeros(parts * entries, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch, parts * width)
            index, _ = assigned(vectors, cells)
            entry = (index + np.arange(parts) * entries).ravel()
            n += np.bincount(entry, minlength=parts * entries)
            order = np.argsort(entry, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(entry[order]) > 0])
            total[entry[order][heads]] += np.add.reduceat(vectors.reshape(-1, width)[order], heads)
        used = np.flatnonzero(n)
        slot = (used[:, None] * width + np.arange(width)).ravel()
        columns = [pa.array(slot), pa.array(total[used].ravel()), pa.array(np.repeat(n[used], width))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "total", "n"])

    return sums


def _coded(codebooks: Codebooks) -> Callable:
    parts, _, width = codebooks.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = [Cells(c) for c in codebooks]
        for batch in batches:
            if not batch.num_rows:
                continue
            index, distance = assigned(_matrix(batch, parts * width), cells)
            codes = [row.tobytes() for row in index.astype(np.uint8)]
            rest = batch.drop_columns(["whole"])
            columns = [*rest.columns, pa.array(codes, pa.binary()), pa.array(distance.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest.schema.names, "codes", "error"])

    return code


def train(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of written vectors (id, whole); None if there are none."""
    if not 0 < entries <= 256:
        raise ValueError("codes are bytes: 1 to 256 entries")
    first = [r.whole for r in whole.orderBy(F.col("id").asc_nulls_last(), "whole").limit(entries).collect()]
    if not first:
        return None
    if len({len(v) for v in first}) > 1 or len(first[0]) % parts:
        raise ValueError(f"vectors must have one length that {parts} divides")
    codebooks = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = mapped(whole.select("whole"), _summed(codebooks), "slot long, total long, n long")
        exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        flat = codebooks.reshape(-1)
        for row in sums.groupBy("slot").agg(exact, F.sum("n").alias("n")).collect():  # at most one a component
            flat[row.slot] = int(row.total) // row.n
    return codebooks


def codebooks_digest(codebooks: Codebooks) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error and codebooks_sha256 of every row kept."""
    rows = picked(vectors, id=id_column, label=label_column, vector=vector_column)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    named = f"id {types['id']}, label {types['label']}"
    whole = written(mapped(rows, _whole, f"{named}, whole array<int>"), "whole-vectors")
    codebooks = train(whole, parts, entries, rounds)
    if codebooks is None:
        codebooks = np.zeros((parts, 1, 1), np.int64)
    coded = written(mapped(whole, _coded(codebooks), f"{named}, codes binary, error long"), "codes")
    # Null labels are a group of their own.
    keyed = coded.select(
        "id", "codes", "error", F.col("label").isNull().alias("none"),
        F.coalesce(F.col("label"), F.lit(0).cast(types["label"])).alias("label"),
    )
    keys = ["none", "label"]
    groups = written(keyed.groupBy(*keys).agg(F.sum("error").alias("label_error"), F.count("error").alias("n")), "label-errors")
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return matched(keyed, groups, keys, "n", total).select(
        F.col("id").alias("vec_id"), F.lower(F.hex("codes")).alias("code"), "error", "label_error",
        F.lit(codebooks_digest(codebooks)).alias("codebooks_sha256"),
    )
