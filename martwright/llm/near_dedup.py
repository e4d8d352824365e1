"""Near-duplicates by MinHash with tensored banding, confirmed on full shingle sets.

Documents whose sets of five-word shingles have a Jaccard similarity of at least
``percent`` (85 unless given) are linked; linked documents form components.
``side`` small hash collections A and as many B are computed for each set,
``HALF`` minhashes each; a table's key is a pair (A_i, B_j), so side * side tables
need only 2 * side * HALF minhashes. Two sets of similarity s share no table with
a chance of about 2 (1 - s^HALF)^side. ``Limit`` takes the least side that keeps
this within ``MISSED`` at the limit: 9 at 0.85 (2e-5; 1e-7 at 0.92), 12 at 0.80 (1e-5).

1. Documents with equal sets form a class; only one member goes on.
2. In each table, those with a key are paired with its first member; each class
   is held against the one it meets most often. Confirmed links give components.
3. In each table, members of different components are paired, unless their
   minhashes rule a link out (fewer than ``least_equal`` of them equal, a chance
   within ``RULED_OUT`` for a link) or their sizes do. Members of one component need no test.
   From keys with more than ``CROWD`` members those go first whose own shingles,
   which no other member of such a key has, already rule out any link there. The
   others are dealt by their collections A, ``side`` rows a member instead of one a
   table: all that share a table with them share one of these. They are first
   paired, twice, with the ``NEAREST`` of other components, so
   that few components are left when all pairs of different ones are tested, and
   ``WIDE`` more minhashes rule out more of those.
   Collections with more than ``BLOCK`` members are dealt out as pairs of blocks.
   These last pairs never leave a key's task: it first names the members that have
   one to test, and then, with their full sets, tests them and gives those links that
   join members not joined by links before (fewer than it has members).
4. Confirmed links of all rounds give the components.

A text without words, null included, has the empty set and no links. One with
fewer than five words has its whole sequence as its only shingle. Repeated rows
are in one class. A null id is reported as null; a component's id is its
smallest id that isn't null. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import (
    BROADCAST_ROWS, mapped, mixed, numbered, partitions_for, picked, ragged, sliced, without, written,
)

WORDS = 5
PERCENT = 85
HALF = 2
MISSED = 2e-5
RULED_OUT = 1e-6
BLOCK = 20_000
CROWD = 32
NEAREST = 3
WIDE = 512
MOST_HASHES = 512
KEYS_AT_A_TIME = 1 << 19
ROWS_PER_PARTITION = 1_000_000
NO_ID = -(2**63)

_RNG = np.random.default_rng(10)
WORD_ODDS = _RNG.integers(1, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIERS = _RNG.integers(1, 2**63, MOST_HASHES + WIDE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADDED = _RNG.integers(0, 2**63, MOST_HASHES + WIDE, dtype=np.uint64)


def _least_equal(hashes: int, percent: int) -> int:
    """What all but ``RULED_OUT`` of the pairs at the limit reach, of so many minhashes whose low bytes are compared."""
    s, below = percent / 100 + (1 - percent / 100) / 256, 0.0
    for k in range(hashes + 1):
        below += comb(hashes, k) * s**k * (1 - s) ** (hashes - k)
        if below > RULED_OUT:
            return k
    return hashes


@dataclass(frozen=True)
class Limit:
    """The similarity from which on sets are linked, and what follows from it."""

    percent: int = PERCENT

    def __post_init__(self) -> None:
        if not 0 < self.percent <= 100 or self.hashes > MOST_HASHES:
            raise ValueError(f"no tables for a similarity of {self.percent} percent")

    @cached_property
    def side(self) -> int:
        side, one = 1, 1 - (self.percent / 100) ** HALF
        while 2 * one**side > MISSED:
            side += 1
        return side

    @property
    def hashes(self) -> int:
        return 2 * self.side * HALF

    @cached_property
    def least_equal(self) -> int:
        return _least_equal(self.hashes, self.percent)

    @cached_property
    def least_wide(self) -> int:
        return _least_equal(WIDE, self.percent)


USUAL = Limit()
SIDE, HASHES, LEAST_EQUAL, LEAST_WIDE = USUAL.side, USUAL.hashes, USUAL.least_equal, USUAL.least_wide


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes."""
    sets, digest = [], xxhash.xxh3_64_intdigest
    for text in texts:
        words = text.lower().split()
        hashes = np.fromiter(map(digest, words), np.uint64, len(words))
        if len(hashes) >= WORDS:
            n = len(hashes) - WORDS + 1
            keys = hashes[:n] * WORD_ODDS[0]
            for k in range(1, WORDS):
                keys += hashes[k : k + n] * WORD_ODDS[k]
            sets.append(np.unique(mixed(keys)))
        elif len(hashes):
            whole = np.uint64(digest(b"\n".join(words), len(words)))
            sets.append(np.array([whole], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minhashes(sets: list[np.ndarray], first: int = 0, last: int = HASHES) -> np.ndarray:
    """(hashes, n) minima of 32 bits; sets must not be empty."""
    starts, _ = ragged(np.array([len(s) for s in sets]))
    flat = np.concatenate(sets)
    out = np.empty((last - first, len(sets)), np.uint64)
    for k in range(first, last):
        out[k - first] = np.minimum.reduceat((flat * MULTIPLIERS[k] + ADDED[k]) >> np.uint64(32), starts)
    return out


def _low_bytes(low: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray((low & np.uint64(0xFF)).astype(np.uint8).T)


def table_key(a: np.ndarray, b: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Key of a pair of collections; tables have keys of their own."""
    both = mixed(a) + mixed(b + np.uint64(1)) * np.uint64(3)
    return mixed(both + table.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def table_keys(halves: np.ndarray) -> np.ndarray:
    """(n, side * side) keys from (n, 2 * side) collections."""
    halves, side = halves.astype(np.uint64), halves.shape[1] // 2
    table = np.arange(side * side)
    return table_key(halves[:, table // side], halves[:, side + table % side], table[None, :])


def first_common_key(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Of pairs that share a table, the key of the first one; so a pair is tested once."""
    same, side = one == two, one.shape[1] // 2
    i, j, at = same[:, :side].argmax(axis=1), same[:, side:].argmax(axis=1), np.arange(len(one))
    return table_key(one[at, i].astype(np.uint64), one[at, side + j].astype(np.uint64), i * side + j)


def first_shared(one: np.ndarray, two: np.ndarray, collection: int) -> np.ndarray:
    """Of pairs, whether this is the first collection A that both have."""
    same = one[:, : one.shape[1] // 2] == two[:, : one.shape[1] // 2]
    return same[:, collection] & (same.argmax(axis=1) == collection)


SKETCHES = "doc_id {}, row long, n long, digest binary, halves array<long>, signature binary"


def _sketched(limit: Limit):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            sets = shingle_sets(texts)
            full = [k for k, s in enumerate(sets) if len(s)]
            halves, signatures = [None] * len(sets), [None] * len(sets)
            if full:
                low = minhashes([sets[k] for k in full], 0, limit.hashes)
                pairs = mixed(low[0::2] << np.uint64(32) | low[1::2]).view(np.int64).T
                bytes_ = _low_bytes(low)
                for place, k in enumerate(full):
                    halves[k], signatures[k] = pairs[place].tolist(), bytes_[place].tobytes()
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            columns = [batch.column("doc_id"), batch.column("row"), pa.array([len(s) for s in sets], pa.int64())]
            columns += [pa.array(digests, pa.binary()), pa.array(halves, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row", "n", "digest", "halves", "signature"])

    return sketch


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        halves = batch.column("halves").flatten().to_numpy().reshape(batch.num_rows, -1)
        reps, step = batch.column("rep").to_numpy(), max(1, KEYS_AT_A_TIME // (halves.shape[1] // 2) ** 2)
        for k in range(0, len(reps), step):
            keys = table_keys(halves[k : k + step]).view(np.int64)
            rows = np.repeat(reps[k : k + step], keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(rows)], names=["key", "rep"])


def _starred(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key and rep: all but each key's first, with that first one."""
    last_key, last_hub = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, reps = batch.column("key").to_numpy(), batch.column("rep").to_numpy()
        heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        hubs = reps[heads].copy()
        if keys[0] == last_key:
            hubs[0] = last_hub
        last_key, last_hub = keys[-1], hubs[-1]
        hub = np.repeat(hubs, np.diff(np.r_[heads, len(keys)]))
        others = np.flatnonzero(reps != hub)
        if len(others):
            yield pa.RecordBatch.from_arrays([pa.array(a[others]) for a in (keys, hub, reps)], names=["key", "hub", "rep"])


def _sizes_allow(one: np.ndarray, two: np.ndarray, limit: Limit) -> np.ndarray:
    return 100 * np.minimum(one, two) >= limit.percent * np.maximum(one, two)


def possible_pairs(group: Group, limit: Limit = USUAL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of different components that sizes and minhashes don't rule out, and that no earlier table has."""
    component, size, signature = group.component, group.size, group.signature
    for a in _chunks(len(size), limit):
        rest = np.arange(a[0] + 1, len(size))
        open_ = (component[a][:, None] != component[rest][None, :]) & _sizes_allow(size[a][:, None], size[rest][None, :], limit)
        left, right = np.nonzero(open_ & (rest[None, :] > a[:, None]))
        for k in range(0, len(left), 1 << 19):
            x, y = a[left[k : k + (1 << 19)]], rest[right[k : k + (1 << 19)]]
            same = (signature[x] == signature[y]).sum(axis=1) >= limit.least_equal
            x, y = x[same], y[same]
            own = _tested_here(group, x, y)
            x, y = x[own], y[own]
            if group.wide is not None:
                same = np.concatenate([
                    (group.wide[x[k : k + 4096]] == group.wide[y[k : k + 4096]]).sum(axis=1) >= limit.least_wide
                    for k in range(0, max(1, len(x)), 4096)
                ])
                x, y = x[same], y[same]
            yield x, y


def _tested_here(group: Group, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of pairs, those that share a table and whose first common key, or collection A, is the group's."""
    one, two = group.halves[x], group.halves[y]
    if group.collection is None:
        return first_common_key(one, two) == group.key
    side = one.shape[1] // 2
    return first_shared(one, two, group.collection) & (one[:, side:] == two[:, side:]).any(axis=1)


def nearest_pairs(group: Group, limit: Limit = USUAL) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of pairs of different components, each member's with the ``NEAREST`` whose minhashes agree most."""
    component, size, signature = group.component, group.size, group.signature
    for a in _chunks(len(size), limit):
        same = (signature[a][:, None, :] == signature[None, :, :]).sum(axis=2).astype(np.int16)
        open_ = (component[a][:, None] != component[None, :]) & _sizes_allow(size[a][:, None], size[None, :], limit)
        same[~open_] = 0
        order = np.argsort(-same, axis=1, kind="stable")[:, :NEAREST]
        far = np.take_along_axis(same, order, 1) < limit.least_equal
        x, y = np.repeat(a, order.shape[1])[~far.ravel()], order.ravel()[~far.ravel()]
        if group.collection is not None:
            first = first_shared(group.halves[x], group.halves[y], group.collection)
            x, y = x[first], y[first]
        yield x, y


def _chunks(n: int, limit: Limit) -> Iterator[np.ndarray]:
    """Rows to compare with all at a time: as many as fit in 64 MB."""
    step = max(1, min(128, (64 << 20) // max(1, n * limit.hashes)))
    for start in range(0, n, step):
        yield np.arange(start, min(start + step, n))


@dataclass(frozen=True)
class Group:
    """Members of a key, or of a collection A (its number given) or a pair of its blocks.

    ``wide`` is None unless all have a wide signature.
    """

    key: np.uint64
    rep: np.ndarray
    component: np.ndarray
    size: np.ndarray
    signature: np.ndarray
    halves: np.ndarray
    wide: np.ndarray | None
    collection: int | None = None


def _group(parts: list[pa.RecordBatch], limit: Limit) -> Group:
    rows = pa.Table.from_batches(parts)
    number = lambda name: rows.column(name).to_numpy()
    bytes_ = lambda name, width: np.frombuffer(b"".join(rows.column(name).to_pylist()), np.uint8).reshape(-1, width)
    halves = rows.column("halves").combine_chunks().flatten().to_numpy().reshape(-1, 2 * limit.side)
    wide = None if rows.column("wide").null_count else bytes_("wide", WIDE)
    key = number("key")[:1].astype(np.int64).view(np.uint64)[0]
    return Group(key, number("rep"), number("component"), number("n"), bytes_("signature", limit.hashes), halves, wide, rows.column("collection")[0].as_py())


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The rows of each group, of rows sorted by group; a group has at most two blocks."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("group").to_numpy()
        heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(group)], strict=True):
            if held and last != group[a]:
                yield held
                held = []
            last = group[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield held


def _nearest(limit: Limit):
    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each member's nearest ones: at most ``NEAREST`` pairs a member, each pair once."""
        for held in _groups(batches):
            group = _group(held, limit)
            found = [np.stack([group.rep[x], group.rep[y]]) for x, y in nearest_pairs(group, limit)]
            pairs = np.concatenate(found, axis=1)
            if pairs.size:
                pairs = np.unique(np.sort(pairs, axis=0), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return nearest


def _involved(limit: Limit):
    """Of each group the members that are in a pair to test, as they came."""

    def involved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _groups(batches):
            group = _group(held, limit)
            marked = np.zeros(len(group.rep), bool)
            for x, y in possible_pairs(group, limit):
                marked[x] = marked[y] = True
            if marked.any():
                yield from pa.Table.from_batches(held).filter(pa.array(marked)).to_batches()

    return involved


def _joined(limit: Limit):
    """Of each group links between members that its links before don't join, on full sets."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _groups(batches):
            group = _group(held, limit)
            sets = [np.frombuffer(s, np.uint64) for batch in held for s in batch.column("shingles").to_pylist()]
            # Members of a component count as joined from the start.
            _, first, place = np.unique(group.component, return_index=True, return_inverse=True)
            root, links = first[place], []
            for x, y in possible_pairs(group, limit):
                for i, j in zip(x.tolist(), y.tolist(), strict=True):
                    if root[i] != root[j] and linked(sets[i], sets[j], limit):
                        links.append(sorted((int(group.rep[i]), int(group.rep[j]))))
                        root[root == root[j]] = root[i]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in zip(*links, strict=True)], names=["a", "b"])

    return join


def linked(one: np.ndarray, two: np.ndarray, limit: Limit = USUAL) -> bool:
    both = np.sort(np.concatenate([one, two]))
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= limit.percent * (len(both) - common)


def _confirmed(limit: Limit):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                keep.append(linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), limit))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return confirm


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of those documents that are what was asked for."""
    for batch, texts in sliced(batches):
        sets = shingle_sets(texts)
        same = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, batch.column("digest").to_pylist(), strict=True)]
        rows = pa.RecordBatch.from_arrays([batch.column("rep"), pa.array([s.tobytes() for s in sets], pa.binary())], names=["rep", "shingles"])
        yield rows.filter(pa.array(same, pa.bool_()))


class _Corpus:
    """Texts by id, the classes with a member's id each, and whether some ids repeat."""

    def __init__(self, source: DataFrame, classes: DataFrame, repeats: bool, limit: Limit) -> None:
        self.source, self.classes, self.repeats, self.limit = source, classes, repeats, limit

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """(rep, shingles) of the classes in ``wanted`` (rep), computed anew from the texts."""
        members = self.classes.join(wanted, "rep").select("rep", "digest", F.col("member").alias("id"))
        members = written(members, "wanted-sets")
        if members.count() <= BROADCAST_ROWS:
            members = F.broadcast(members)
        texts = self.source.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text").join(members, "id").select("rep", "digest", "text")
        found = mapped(texts, _full_sets, "rep long, shingles binary")
        return written(found.dropDuplicates(["rep"]) if self.repeats else found, "full-sets")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the written pairs (a, b) that are links, on full sets."""
        sets = self.full_sets(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct())
        left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
        right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
        return mapped(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), _confirmed(self.limit), "a long, b long")

    def crowd(self, reps: DataFrame) -> DataFrame:
        """(rep, wide signature) of those of ``reps`` that may be linked with another of them.

        Of a set's shingles, those that no other of the sets has bound its
        similarity to any of them: it is at most the share of the others.
        """
        sets = self.full_sets(reps)
        spread = mapped(sets, _spread, "shingle long, rep long")
        own = spread.groupBy("shingle").agg(F.count("rep").alias("sets"), F.min("rep").alias("rep")).where("sets = 1")
        counts = own.groupBy("rep").agg(F.count("shingle").alias("own"))
        joined = counts.join(self.classes.select("rep", "n"), "rep")
        alone = joined.where(f"100 * (n - own) < {self.limit.percent} * n").select("rep")
        return written(mapped(sets.join(alone, "rep", "left_anti"), _widened, "rep long, wide binary"), "crowd")


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in sliced(batches, "shingles"):
        low = minhashes([np.frombuffer(r, np.uint64) for r in raw], MOST_HASHES, MOST_HASHES + WIDE)
        wide = pa.array([row.tobytes() for row in _low_bytes(low)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("rep"), wide], names=["rep", "wide"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rep, raw in zip(batch.column("rep").to_pylist(), batch.column("shingles").to_pylist(), strict=True):
            shingles = np.frombuffer(raw, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shingles), pa.array(np.full(len(shingles), rep))], names=["shingle", "rep"])


def components(edges: DataFrame) -> DataFrame:
    """(rep, component): the smallest node that each node with an edge can reach."""
    both = written(edges.union(edges.select("b", "a")).distinct().toDF("u", "v"), "edges")
    labels = written(both.groupBy(F.col("u").alias("rep")).agg(F.least(F.min("v"), F.first("u")).alias("component")), "labels")
    while True:
        offered = both.join(labels, both.u == labels.rep).groupBy("v").agg(F.min("component").alias("offer"))
        met = labels.join(offered, labels.rep == offered.v, "left").select(
            "rep", F.col("component").alias("old"), F.least("component", "offer").alias("new")
        )
        # Then each takes the label that its label has: paths halve with every round.
        jump = labels.select(F.col("rep").alias("new"), F.col("component").alias("jump"))
        after = met.join(jump, "new", "left").select("rep", "old", F.least("new", "jump").alias("component"))
        after = written(after, "labels")
        changed = after.where("component < old").limit(1).count()
        labels = after.select("rep", "component")
        if not changed:
            return labels


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", row_column: str | None = None, percent: int = PERCENT
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id is component_id), row and component of every document.

    ``component`` tells groups apart; it is null for a document that is alone.
    """
    limit = Limit(percent)
    source = picked(docs, doc_id=id_column, text=text_column, **({"row": row_column} if row_column else {}))
    source = source.withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = source if row_column else source.withColumn("row", F.monotonically_increasing_id())
    sketches = written(mapped(rows, _sketched(limit), SKETCHES.format("long")), "sketches")
    classes = sketches.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("rep"), F.min(F.coalesce("doc_id", F.lit(NO_ID))).alias("member"), F.min("doc_id").alias("least_id"),
        F.count("row").alias("size"), F.first("n").alias("n"), F.first("halves").alias("halves"), F.first("signature").alias("signature"),
    )
    classes = written(classes, "classes")
    repeats = sketches.groupBy("doc_id").count().where("count > 1").limit(1).count() > 0
    corpus = _Corpus(source, classes, repeats, limit)
    keyed = mapped(classes.select("rep", "halves"), _keyed, "key long, rep long")
    parts = partitions_for(classes, classes.count() * limit.side**2, ROWS_PER_PARTITION)
    dealt = keyed.repartition(parts, "key").sortWithinPartitions("key", "rep")
    stars = written(mapped(dealt, _starred, "key long, hub long, rep long"), "stars")

    met = stars.groupBy("hub", "rep").agg(F.count("key").alias("times"))
    best = met.groupBy("rep").agg(F.max(F.struct("times", (-F.col("hub")).alias("hub"))).alias("best"))
    first = written(best.select((-F.col("best.hub")).alias("a"), F.col("rep").alias("b")), "first-pairs")
    links = written(corpus.confirmed(first), "first-links")
    labels = components(links)

    members = written(stars.select("key", "rep").union(stars.select("key", "hub").distinct()), "members")
    tested, crowd = first, None
    for nearest in (True, True, False):
        labelled = members.join(labels, "rep", "left").select("key", "rep", F.coalesce("component", "rep").alias("component"))
        mixed_keys = labelled.groupBy("key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.count("rep").alias("members")
        ).where("low < high").select("key", "members")
        rows = written(labelled.join(mixed_keys, "key"), "mixed-rows")
        crowded = rows.where(F.col("members") > CROWD).select("rep", "component").distinct()
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("wide", "binary"), ("collection", "int"))]
        dealt = rows.where(F.col("members") <= CROWD).select("rep", "key", "component", *none, F.col("key").alias("group"))
        if crowded.limit(1).count():
            if crowd is None:
                crowd = corpus.crowd(crowded.select("rep"))
            shared = _by_collection(crowded, crowd, classes, limit)
            dealt = shared if nearest else dealt.unionByName(shared)
        elif nearest:
            continue
        sketched = dealt.join(classes.select("rep", "n", "signature", "halves"), "rep")
        dealt = sketched.repartition(parts, "group").sortWithinPartitions("group")
        if nearest:
            near = mapped(dealt, _nearest(limit), "a long, b long").distinct()
            pairs = written(near.join(tested, ["a", "b"], "left_anti"), "pairs")
            tested, more = tested.union(pairs), written(corpus.confirmed(pairs), "links")
        else:
            involved = written(mapped(dealt, _involved(limit), dealt.schema), "involved")
            sets = corpus.full_sets(involved.select("rep").distinct())
            grouped = involved.join(sets, "rep").repartition(parts, "group").sortWithinPartitions("group")
            more = written(mapped(grouped, _joined(limit), "a long, b long").distinct(), "links")
        if more.limit(1).count():
            links = links.union(more)
            labels = components(links)

    joined = classes.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    ids = joined.groupBy("component").agg(F.min("least_id").alias("component_id"), F.sum("size").alias("members"))
    grouped = joined.join(ids.where("members > 1"), "component").select("digest", "component", "component_id")
    out = sketches.select("doc_id", "row", "n", "digest").join(grouped, "digest", "left")
    component = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), "row", "component",
    )


def _by_collection(crowded: DataFrame, crowd: DataFrame, classes: DataFrame, limit: Limit) -> DataFrame:
    """Rows of those of ``crowded`` (rep, component) that are in the crowd: one for each collection A that
    members of different components share. A group is a collection, or a pair of blocks of a large one."""
    halves = classes.select("rep", F.slice("halves", 1, limit.side).alias("halves"))
    members = crowded.join(crowd.select("rep"), "rep").join(halves, "rep")
    each = members.select("rep", "component", F.posexplode("halves").alias("collection", "half"))
    each = written(each.select("rep", "component", "collection", F.xxhash64("collection", "half").alias("key")), "collections")
    met = each.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count("rep").alias("members")
    ).where("low < high").select("key", "members")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = each.join(met, "key").select("rep", "key", "component", "collection", own.alias("own"), other)
    group = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.join(crowd, "rep").select("rep", "key", "component", "wide", "collection", group.alias("group"))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id, the first of equals."""
    rows, row = numbered(docs, "numbered")
    found = near_duplicates(rows, id_column, text_column, row, percent).where("component IS NOT NULL")
    found = written(found.select("component", "doc_id", "row"), "in-components")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    stay = found.groupBy("component").agg(F.min(order).getField("row").alias("stays"))
    dropped = found.join(stay, "component").where("row != stays").select("row")
    return without(rows, row, dropped)
