"""Exact dedup with a cuckoo-filter index over digests.

Texts are equal when identical after lower-casing A-Z. A text's key is the
SHA-256 of that form. Keys live in ``CuckooIndex``: a table of 16-bit
fingerprints, four to a bucket, each pointing at the stored key; a hit counts
only if the stored key is the same, and a table that overflows is rebuilt
larger from the stored keys. Indexes are kept per partition of the key space.

Each task first folds its own rows through an index, so that a text with any
number of copies sends one row per task to the shuffle; a second index per key
partition then merges these. Groups with a large share of all rows are joined
back by broadcast (their number is bounded by the share), the rest by key.

Null text counts as empty. A null doc_id is below all others. Rows that repeat
text and doc_id count as rows of the group; one of them, the last written,
stays. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, mixed, numbered, partitions_for, picked, sliced, without, written

SLOTS = 4
KEYS_PER_PARTITION = 1_000_000
# A group with more than this share of the rows is joined by broadcast; there are fewer than 1 / share.
HOT_SHARE = 0.001
ADDED, REMOVED = 0, 1


class CuckooIndex:
    """Set of 32-byte keys with insertion, lookup and deletion in batches.

    Keys are given as an (n, 4) array of unsigned 64-bit words. ``find`` gives
    a row number per key, or -1; row numbers stay valid until ``remove``.
    """

    MAX_ROUNDS = 64

    def __init__(self, capacity: int = 4096) -> None:
        self.keys = np.empty((max(capacity, 16), 4), np.uint64)
        self.live = np.zeros(len(self.keys), bool)
        self.used = 0
        self._table(capacity)

    def __len__(self) -> int:
        return int(np.count_nonzero(self.live[: self.used]))

    def _table(self, capacity: int) -> None:
        buckets = 1 << max(4, int(capacity / (SLOTS * 0.8))).bit_length()
        self.mask = np.uint64(buckets - 1)
        self.prints = np.zeros((buckets, SLOTS), np.uint16)
        self.rows = np.full((buckets, SLOTS), -1, np.int64)

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        prints = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = keys[:, 0] & self.mask
        return prints, first.astype(np.int64), self._other(first, prints)

    def _other(self, bucket: np.ndarray, prints: np.ndarray) -> np.ndarray:
        return (bucket.astype(np.uint64) ^ (mixed(prints) & self.mask)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        found = np.full(len(keys), -1, np.int64)
        for bucket in (first, second):
            for slot in range(SLOTS):
                hit = np.flatnonzero((self.prints[bucket, slot] == prints) & (found < 0))
                rows = self.rows[bucket[hit], slot]
                same = (self.keys[rows] == keys[hit]).all(axis=1)
                found[hit[same]] = rows[same]
        return found

    def insert(self, keys: np.ndarray) -> np.ndarray:
        """Row numbers of the keys, new ones added; the keys must be distinct."""
        rows = self.find(keys)
        new = np.flatnonzero(rows < 0)
        rows[new] = np.arange(self.used, self.used + len(new))
        end = self.used + len(new)
        if end > len(self.keys):
            self.keys = np.resize(self.keys, (max(end, 2 * len(self.keys)), 4))
            self.live = np.concatenate([self.live, np.zeros(len(self.keys) - len(self.live), bool)])
        self.keys[self.used : end] = keys[new]
        self.live[self.used : end] = True
        self.used = end
        if end > 0.85 * self.prints.size or not self._place(rows[new]):
            self._rebuild(2 * max(end, self.prints.size))
        return rows

    def remove(self, keys: np.ndarray) -> np.ndarray:
        """Delete live keys; gives which of the (distinct) keys were there."""
        found = self.find(keys)
        prints, first, second = self._places(keys)
        for bucket in (first, second):
            for slot in range(SLOTS):
                hit = (found >= 0) & (self.rows[bucket, slot] == found)
                self.prints[bucket[hit], slot] = 0
                self.rows[bucket[hit], slot] = -1
        self.live[found[found >= 0]] = False
        return found >= 0

    def _place(self, rows: np.ndarray) -> bool:
        """Give each row a slot, moving others to their second bucket; False on overflow."""
        prints, bucket, second = self._places(self.keys[rows])
        for turn in range(self.MAX_ROUNDS):
            for side in range(2 * SLOTS):
                if not len(rows):
                    return True
                at, slot = (bucket if side < SLOTS else second), side % SLOTS
                free = np.flatnonzero(self.prints[at, slot] == 0)
                _, one = np.unique(at[free], return_index=True)
                chosen = free[one]
                self.prints[at[chosen], slot] = prints[chosen]
                self.rows[at[chosen], slot] = rows[chosen]
                left = np.ones(len(rows), bool)
                left[chosen] = False
                rows, prints, bucket, second = rows[left], prints[left], bucket[left], second[left]
            if not len(rows):
                return True
            # All full: put one row into each bucket; what it drives out goes on to its other bucket.
            slot = turn % SLOTS
            where, one = np.unique(bucket, return_index=True)
            out_rows, out_prints = self.rows[where, slot], self.prints[where, slot]
            self.rows[where, slot], self.prints[where, slot] = rows[one], prints[one]
            rows[one], prints[one] = out_rows, out_prints
            bucket[one], second[one] = self._other(where, out_prints), where
        return False

    def _rebuild(self, capacity: int) -> None:
        while True:
            self._table(capacity)
            if self._place(np.flatnonzero(self.live[: self.used])):
                return
            capacity *= 2


class _Groups:
    """An index with, per key, the row that stays and the number of rows."""

    def __init__(self) -> None:
        self.index = CuckooIndex()
        self.keep = np.empty((0, 2), np.int64)  # doc_id (lowest for null), row number
        self.size = np.empty(0, np.int64)

    def add(self, keys: np.ndarray, doc: np.ndarray, row: np.ndarray, size: np.ndarray) -> None:
        order = np.lexsort((row, doc, keys[:, 3], keys[:, 2], keys[:, 1], keys[:, 0]))
        keys, doc, row, size = keys[order], doc[order], row[order], size[order]
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
        last = np.r_[starts[1:], len(keys)] - 1
        at = self.index.insert(keys[starts])
        grown = self.index.used - len(self.size)
        if grown:
            self.keep = np.concatenate([self.keep, np.full((grown, 2), np.iinfo(np.int64).min)])
            self.size = np.concatenate([self.size, np.zeros(grown, np.int64)])
        best, here = np.stack([doc[last], row[last]], axis=1), self.keep[at]
        higher = (best[:, 0] > here[:, 0]) | ((best[:, 0] == here[:, 0]) & (best[:, 1] > here[:, 1]))
        self.keep[at[higher]] = best[higher]
        self.size[at] += np.add.reduceat(size, starts)

    def remove(self, keys: np.ndarray) -> None:
        self.index.remove(np.unique(keys, axis=0))

    def batches(self) -> Iterator[pa.RecordBatch]:
        live = np.flatnonzero(self.index.live[: self.index.used])
        for at in np.array_split(live, len(live) // 100_000 + 1):
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [_binary(self.index.keys[at]), pa.array(self.keep[at, 0]), pa.array(self.keep[at, 1]), pa.array(self.size[at])],
                    names=["digest", "doc", "row", "size"],
                )


GROUPS = "digest binary, doc long, row long, size long"


def _binary(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in keys], pa.binary())


def _keys(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4).copy()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in sliced(batches):
        digests = pa.array([hashlib.sha256(t.lower()).digest() for t in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), digests], names=["doc_id", "row", "digest"])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map side: one row per digest of the task; flushed when the index is full."""
    groups = _Groups()
    for batch in batches:
        if batch.num_rows:
            doc = batch.column("doc").to_numpy(zero_copy_only=False)
            groups.add(_keys(batch.column("digest")), doc, batch.column("row").to_numpy(), np.ones(len(doc), np.int64))
        if groups.index.used >= KEYS_PER_PARTITION:
            yield from groups.batches()
            groups = _Groups()
    yield from groups.batches()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce side: rows come with those to add first, then those to remove."""
    groups = _Groups()
    for batch in batches:
        kind = batch.column("kind").to_numpy()
        for value in (ADDED, REMOVED):
            part = batch.filter(pa.array(kind == value))
            if not part.num_rows:
                continue
            keys = _keys(part.column("digest"))
            if value == ADDED:
                groups.add(keys, part.column("doc").to_numpy(), part.column("row").to_numpy(), part.column("size").to_numpy())
            else:
                groups.remove(keys)
    yield from groups.batches()


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row_column: str | None = None) -> DataFrame:
    """(doc_id, row, digest) of every document, written once; ``row`` tells repeated rows apart."""
    if row_column:
        rows = picked(docs, doc_id=id_column, text=text_column, row=row_column)
    else:
        rows = picked(docs, doc_id=id_column, text=text_column).withColumn("row", F.monotonically_increasing_id())
    hashed = mapped(rows.select(F.col("doc_id").cast("long"), "row", "text"), _hashed, "doc_id long, row long, digest binary")
    return written(hashed, "digests")


def live_digests(added: DataFrame, removed: DataFrame | None = None, rows: int | None = None) -> DataFrame:
    """Groups of equal digests: digest, doc and row of the one that stays, size.

    ``added`` is (doc_id, row, digest) as ``digests`` gives it, or groups that
    an earlier call gave; ``removed`` holds digests to delete after that.
    """
    if "size" not in added.columns:
        lowest = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
        added = mapped(added.select("digest", lowest.alias("doc"), "row"), _folded, GROUPS)
    changes = added.withColumn("kind", F.lit(ADDED))
    if removed is not None:
        zero = F.lit(0).cast("long")
        changes = changes.unionByName(
            removed.select("digest", zero.alias("doc"), zero.alias("row"), zero.alias("size"), F.lit(REMOVED).alias("kind"))
        )
    parts = partitions_for(added, rows or 0, KEYS_PER_PARTITION)
    dealt = changes.repartition(parts, "digest")
    if removed is not None:
        dealt = dealt.sortWithinPartitions("kind")
    return mapped(dealt, _merged, GROUPS)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, row."""
    return verdicts(digests(docs, id_column, text_column))


def verdicts(hashed: DataFrame) -> DataFrame:
    """``exact_dedup`` of documents whose digests are written already."""
    rows = hashed.count()
    groups = written(live_digests(hashed, rows=rows).where("size > 1"), "digest-groups")
    groups = groups.select("digest", F.col("doc").alias("keep_doc"), F.col("row").alias("keep_row"), "size")
    limit = max(1000, int(HOT_SHARE * rows))
    hot = hashed.join(F.broadcast(groups.where(F.col("size") >= limit)), "digest", "left")
    rest = hot.where("size IS NULL").drop("keep_doc", "keep_row", "size").join(groups.where(F.col("size") < limit), "digest", "left")
    joined = hot.where("size IS NOT NULL").unionByName(rest)
    keep = F.when(F.col("size").isNull(), F.col("doc_id")).when(F.col("keep_doc") > -(2**63), F.col("keep_doc"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("size").isNull() | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each group of equal texts: the one ``exact_dedup`` keeps."""
    rows, row = numbered(docs, "numbered")
    judged = verdicts(digests(rows, id_column, text_column, row))
    return without(rows, row, judged.where("NOT kept").select("row"))
