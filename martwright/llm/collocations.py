"""Phrase collocations by set-oriented mining: relations of occurrences, joined and counted.

Texts are lower-cased (A-Z), cut at ``[.,;:!?`` and 0A-0D``]`` into pieces, and
pieces at spaces and tabs into words. The relation of level k holds, for each
place of a text, the phrase of k words that starts there, sorted by text and
place; it is persisted with one line a text (``slots``; 0 where nothing starts),
so a piece never leaves its task. From one level to the next:

1. the relation is merge-joined with itself on the text and the adjacent place:
   phrases ``left`` and ``right`` that overlap in all but their ends make one
   that is a word longer (a piece's end leaves a gap, so none reaches over it);
2. the pairs are counted by group, pre-aggregated in each task;
3. groups with ``least`` occurrences or more are frequent, and the joined
   relation, semi-joined with them, is the next level's. A longer phrase can be
   frequent only if both its parts are, so words are filtered alike first.

Everything is per language: a word's key is a 64-bit hash of language and word, a
longer phrase's of its two parts. Keys are checked to be one to one, words over
the whole vocabulary and phrases over the frequent ones; else another seed is taken.
Phrases are counted by their two keys, so no count rests on a hash of both.

A null text has no words; a null language counts as ``und``; ids are not read, and
repeated rows count as often as they occur. Of equal scores the cut after fewer
words counts; phrases of equal rank order are told apart by their bytes, so there
are no ties in a language. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import held, mapped, matched, mixed, picked, ragged, shared_path, sliced, written

LEAST = 10
LONGEST = 3
FIRST = 2000
COVERED_PERCENT = 50
UNKNOWN = "und"
# The characters that end a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
# A byte that UTF-8 never has stands for each of them.
END = b"\xff"
TO_END = bytes.maketrans(ENDS, END * len(ENDS))
# Words, and pairs, that a task counts before it hands the counts on, and slots it joins at a time.
WORDS_AT_A_TIME = 120_000
PAIRS_AT_A_TIME = 300_000
SLOTS_AT_A_TIME = 250_000
SLOT, WORD = 0, 1

TOKENS = "kind int, row long, slots array<long>, word long, lang string, text string, n long"


class _Words(dict):
    """Numbers of the words of one language, given as they are met; 0 is the end of a piece."""

    def __init__(self, lang: bytes, seed: int, found: list) -> None:
        super().__init__({END: 0})
        self.prefix, self.seed, self.found = len(lang).to_bytes(4, "little") + lang, seed, found

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.found)
        self.found.append((xxhash.xxh3_64_intdigest(self.prefix + word, self.seed), self.prefix[4:], word))
        return number


def _tokenized(seed: int) -> Callable:
    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A line of slots for each text, and the counts of the words met (flushed now and then)."""
        found, langs, counts = [(0, b"", b"")], {}, np.zeros(1, np.int64)
        for batch, texts in sliced(batches):
            numbers, lengths = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
                words = langs.get(lang)
                if words is None:
                    words = langs[lang] = _Words(lang.encode(), seed, found)
                tokens = text.lower().translate(TO_END).replace(END, b" \xff ").split()
                numbers.append(np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens)))
                lengths.append(len(tokens))
            flat = np.concatenate(numbers)
            keys = np.fromiter((f[0] for f in found), np.uint64, len(found)).view(np.int64)
            counts = np.concatenate([counts, np.zeros(len(found) - len(counts), np.int64)])
            counts += np.bincount(flat, minlength=len(found))
            slots = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(keys[flat]))
            yield _rows(SLOT, row=batch.column("row"), slots=slots)
            if len(found) > WORDS_AT_A_TIME:
                yield _vocabulary(found, counts)
                found, langs, counts = found[:1], {}, np.zeros(1, np.int64)
        if len(found) > 1:
            yield _vocabulary(found, counts)

    return tokenize


def _vocabulary(found: list, counts: np.ndarray) -> pa.RecordBatch:
    keys = np.fromiter((f[0] for f in found[1:]), np.uint64, len(found) - 1).view(np.int64)
    lang, text = (pa.array([f[k].decode() for f in found[1:]]) for k in (1, 2))
    return _rows(WORD, word=pa.array(keys), lang=lang, text=text, n=pa.array(counts[1:]))


def _rows(kind: int, **columns: pa.Array) -> pa.RecordBatch:
    size = len(next(iter(columns.values())))
    types = dict(
        kind=pa.int32(), row=pa.int64(), slots=pa.list_(pa.int64()), word=pa.int64(), lang=pa.string(), text=pa.string(), n=pa.int64()
    )
    columns["kind"] = pa.array(np.full(size, kind, np.int32))
    return pa.RecordBatch.from_arrays([columns.get(k, pa.nulls(size, t)) for k, t in types.items()], names=list(types))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of whole lines with at most about ``SLOTS_AT_A_TIME`` slots."""
    for batch in batches:
        ends, start = batch.column("slots").offsets.to_numpy(), 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + SLOTS_AT_A_TIME, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


def _joined(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The merge join of a batch of the relation with itself: line and place of each pair, and its two keys."""
    lengths = np.diff(batch.column("slots").offsets.to_numpy())
    flat = batch.column("slots").flatten().to_numpy()
    starts, line = ragged(lengths)
    at = np.flatnonzero((line[1:] == line[:-1]) & (flat[1:] != 0) & (flat[:-1] != 0))
    return line[at], at - starts[line[at]], flat[at], flat[at + 1]


def _hashed(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    return mixed(mixed(left.view(np.uint64) + np.uint64(seed)) + right.view(np.uint64))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, place, left, right) of all pairs."""
    for batch in _cut(batches):
        line, place, left, right = _joined(batch)
        row = batch.column("row").to_numpy()[line]
        columns = [row, place.astype(np.int32), left, right]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "place", "left", "right"])


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(left, right, n), counted over some of the task's pairs at a time."""
    parts, size = [], 0
    for batch in _cut(batches):
        parts.append(_joined(batch)[2:])
        size += len(parts[-1][0])
        if size >= PAIRS_AT_A_TIME:
            yield _counted(parts)
            parts, size = [], 0
    if size:
        yield _counted(parts)


def _counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    left, right = (np.concatenate(side) for side in zip(*parts, strict=True))
    # Sorted by a hash: should two pairs share one, a pair gets several lines, which are summed later.
    order = np.argsort(_hashed(left, right, 0))
    left, right = left[order], right[order]
    heads = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    columns = [left[heads], right[heads], np.diff(np.r_[heads, len(left)])]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["left", "right", "n"])


class _Lookup:
    """Keys of frequent pairs, held by a task. A pair is found by a hash that no other of them has, and compared."""

    def __init__(self, groups: pa.Table) -> None:
        left, right, key = (groups.column(c).to_numpy() for c in ("left", "right", "key"))
        for self.seed in count():
            hashes = _hashed(left, right, self.seed)
            order = np.argsort(hashes)
            self.hashes, self.left, self.right, self.key = hashes[order], left[order], right[order], key[order]
            if not (self.hashes[1:] == self.hashes[:-1]).any():
                break

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pairs' keys; 0 for those that aren't frequent."""
        if not len(self.key):
            return np.zeros(len(left), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, _hashed(left, right, self.seed)), len(self.key) - 1)
        return np.where((self.left[at] == left) & (self.right[at] == right), self.key[at], 0)


def _found(lookup: _Lookup) -> Callable:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            line, place, left, right = _joined(batch)
            starts, _ = ragged(lengths := np.diff(batch.column("slots").offsets.to_numpy()))
            slots = np.zeros(int(lengths.sum()), np.int64)
            slots[starts[line] + place] = lookup.find(left, right)
            yield _relation(batch.column("row"), lengths, slots)

    return find


def _only(words: np.ndarray) -> Callable:
    """The relation of words without those not in ``words`` (sorted)."""

    def only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cut(batches):
            slots = batch.column("slots").flatten().to_numpy().copy()
            at = np.minimum(np.searchsorted(words, slots), len(words) - 1)
            slots[words[at] != slots] = 0
            yield _relation(batch.column("row"), np.diff(batch.column("slots").offsets.to_numpy()), slots)

    return only


def _relation(row: pa.Array, lengths: np.ndarray, slots: np.ndarray) -> pa.RecordBatch:
    lines = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lengths)], pa.int32()), pa.array(slots))
    return pa.RecordBatch.from_arrays([row, lines], names=["row", "slots"])


def _clustered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row, place, key) sorted by text and place as one line of slots a text."""
    last, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        row, place, key = (batch.column(c).to_numpy() for c in ("row", "place", "key"))
        heads = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        lines = []
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(row)], strict=True):
            if parts and row[a] != last:
                lines.append((last, parts))
                parts = []
            last = int(row[a])
            parts.append((place[a:b], key[a:b]))
        if lines:
            yield _lines(lines)
    if parts:
        yield _lines([(last, parts)])


def _lines(lines: list[tuple[int, list]]) -> pa.RecordBatch:
    slots = []
    for _, parts in lines:
        slots.append(np.zeros(int(parts[-1][0][-1]) + 1, np.int64))
        for place, key in parts:
            slots[-1][place] = key
    return _relation(pa.array([row for row, _ in lines], pa.int64()), np.array([len(s) for s in slots]), np.concatenate(slots))


RELATION = "row long, slots array<long>"


def _semi_joined(relation: DataFrame, groups: DataFrame, size: int) -> DataFrame:
    """The next level's relation: pairs, or single words, of ``relation`` that are in ``groups``, written.

    Groups are held by every task if their count allows it (``held``); else the
    occurrences are dealt by their keys, and then back by text.
    """
    pairs = "left" in groups.columns
    if held(groups):
        found = groups.toArrow()
        step = _found(_Lookup(found)) if pairs else _only(np.sort(np.r_[0, found.column("key").to_numpy()]))
        return written(mapped(relation, step, RELATION), "occurrences", "zstd")
    if pairs:
        rows, keys = mapped(relation, _pairs, "row long, place int, left long, right long"), ["left", "right"]
    else:
        rows, keys = relation.select("row", F.posexplode("slots").alias("place", "key")), ["key"]
    met = matched(rows, groups, keys, "a", size).select("row", "place", "key")
    dealt = met.repartition("row").sortWithinPartitions("row", "place")
    return written(mapped(dealt, _clustered, RELATION), "occurrences", "zstd")


class _Level:
    """Phrases of one length: the relation of their occurrences, and the frequent ones.

    ``groups`` has key, lang, phrase, a, and ``heads`` and ``tails``: how often the
    phrase's first 1, 2, ... and last 1, 2, ... words occur. ``size`` is the
    number of occurrences.
    """

    def __init__(self, relation: DataFrame | None, groups: DataFrame, size: int) -> None:
        self.relation, self.groups, self.size = relation, groups, size


def _one_to_one(groups: DataFrame) -> bool:
    return groups.groupBy("key").count().where("count > 1 OR key = 0").limit(1).count() == 0


def first_level(docs: DataFrame, lang_column: str, text_column: str, least: int) -> tuple[_Level, DataFrame]:
    """Words, and how many each language has (lang, n)."""
    source = picked(docs, lang=lang_column, text=text_column).select(
        F.monotonically_increasing_id().alias("row"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text"
    )
    for seed in count():
        path = shared_path(docs.sparkSession, "occurrences")
        mapped(source, _tokenized(seed), TOKENS).write.partitionBy("kind").option("compression", "zstd").parquet(path)
        tokens = docs.sparkSession.read.schema(TOKENS).parquet(path)
        words = tokens.where(F.col("kind") == WORD).groupBy("word", "lang", "text").agg(F.sum("n").alias("a"))
        words = written(words.select(F.col("word").alias("key"), "lang", F.col("text").alias("phrase"), "a"), "words")
        if _one_to_one(words):
            break
    totals = written(words.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    none = F.array().cast("array<long>")
    frequent = written(words.where(F.col("a") >= least).select("*", none.alias("heads"), none.alias("tails")), "frequent")
    size = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slots = tokens.where(F.col("kind") == SLOT).select("row", "slots")
    return _Level(_semi_joined(slots, frequent.select("key", "a"), size), frequent, size), totals


def next_level(level: _Level, least: int, last: bool) -> _Level:
    """Phrases one word longer; their relation only if there is a level after them."""
    counted = mapped(level.relation, _pair_counts, "left long, right long, n long").groupBy("left", "right").agg(F.sum("n").alias("a"))
    counted = written(counted.where(F.col("a") >= least), "counted")
    for seed in count():
        keyed = counted.select(F.xxhash64("left", "right", F.lit(seed)).alias("key"), "left", "right", "a")
        if _one_to_one(keyed):
            break
    side = level.groups.select("key", "lang", "phrase", F.col("a").alias("part"), "heads", "tails")
    left = side.select(F.col("key").alias("left"), "lang", F.col("phrase").alias("start"), F.array_append("heads", F.col("part")).alias("heads"))
    end = F.substring_index("phrase", " ", -1)
    right = side.select(F.col("key").alias("right"), end.alias("end"), F.array_append("tails", F.col("part")).alias("tails"))
    groups = keyed.join(left, "left").join(right, "right").select(
        "key", "left", "right", "lang", F.concat_ws(" ", "start", "end").alias("phrase"), "a", "heads", "tails"
    )
    groups = written(groups, "frequent")
    if last:
        return _Level(None, groups, 0)
    relation = _semi_joined(level.relation, groups.select("left", "right", "key", "a"), level.size)
    return _Level(relation, groups, groups.agg(F.coalesce(F.sum("a"), F.lit(0))).first()[0])


def _scored(groups: DataFrame) -> DataFrame:
    """Groups with l, r and score of their lowest cut. Products are decimals of up to 38 digits."""
    words = F.size("heads") + 1
    groups = groups.withColumn("cuts", F.sequence(F.lit(1), words - 1))
    cut = F.expr(
        """array_min(transform(cuts, k -> named_struct(
             'score', (cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0)))
                      div (cast(heads[k - 1] as decimal(15,0)) * cast(tails[size(cuts) - k] as decimal(15,0))),
             'k', k, 'l', heads[k - 1], 'r', tails[size(cuts) - k])))"""
    )
    return groups.withColumn("cut", cut).select("key", "lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def _uncovered(groups: DataFrame, longer: DataFrame, percent: int) -> DataFrame:
    """Groups that lie in no longer one with so much of their occurrences.

    What lies in a longer phrase lies in one that is a word longer, which is as frequent or more.
    """
    parts = longer.select(F.col("left").alias("key"), "a").union(longer.select("right", "a"))
    most = parts.groupBy("key").agg(F.max("a").alias("most"))
    free = F.col("most").isNull() | (100 * F.col("most") < percent * F.col("a"))
    return groups.join(most, "key", "left").where(free).drop("most")


def collocations(
    docs: DataFrame, lang_column: str = "lang", text_column: str = "text", least: int = LEAST, longest: int = LONGEST,
    first: int = FIRST, covered_percent: int = COVERED_PERCENT,
) -> DataFrame:
    """Each language's ``first`` phrases: lang, rank, phrase, a, l, r, n, score.

    Phrases have 2 to ``longest`` words and ``least`` occurrences (a) or more. Score is
    1000000 a a / (l r), rounded down, at the cut where it is least: l occurrences
    of the words before the cut, r of those after. A phrase that lies in a longer
    one with ``covered_percent`` of its occurrences or more is dropped.
    """
    level, totals = first_level(docs, lang_column, text_column, least)
    found = []
    for words in range(2, longest + 1):
        longer = next_level(level, least, words == longest)
        if words > 2:
            found.append(_uncovered(level.groups, longer.groups, covered_percent))
        level = longer
    found.append(level.groups)
    kept = reduce(DataFrame.unionByName, map(_scored, found))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
