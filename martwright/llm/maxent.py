"""Language-model scoring with a hashed maximum-entropy model.

The next token's output bucket is predicted in two softmaxes: its class, then
its bucket within the class. Features are the hashed n-grams and skips before
it. The commonest words (``OWN_BUCKETS``) have buckets of their own, all others
share hashed ones; within a bucket a token has the smoothed share of its count,
one share being kept for unknown words, so the whole is a distribution.

    P(w | before) = P(class | before) P(bucket | class, before) (c(w) + 1) / (N_b + V_b + 1)

Training is one update by the gradient over all training text. Before it every
context has the shares of the counts, so the gradient of a feature row and an
outcome is how often they were seen together less the row's occurrences times
the outcome's share. Tasks count, Spark sums the counts by row, and each row
steps by the log of seen over expected (``PRIOR`` occurrences at the plain share
added to both), divided by the features that fire together. Counts are whole
numbers, so the weights are the same however the input is split.

Feature rows follow the training tokens: the power of two from four times their
square root on, ``CLASS_ROWS`` at least. Every task holds the weights, 384 bytes
a class row, so there are ``MOST_ROWS`` at most (400 MB, reached at 70 billion
tokens); beyond that more features share a row. Words above a count that at most
``HEAD_WORDS`` words reach are held by every task; the others' counts are joined
by key.

Tokens are words of the text with A-Z lower-cased, and one end. Null text counts
as empty: one end. A null id counts as the empty text when documents are held
out. Repeated rows are learned from and scored each for itself; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, mixed, picked, ragged, sliced, written

END = b"\n"  # no word holds a line end
HEAD_WORDS = 200_000
COUNTED_WORDS = 500_000
CLASSES = 32
IN_CLASS = 32
BUCKETS = CLASSES * IN_CLASS
OWN_BUCKETS = BUCKETS // 2
CLASS_ROWS = 1 << 14
MOST_ROWS = 1 << 20
ROWS_A_BUCKET_ROW = 16  # class rows for each bucket row, which has one for each class
BUCKET_ROWS = CLASS_ROWS // ROWS_A_BUCKET_ROW
CLASS_KINDS, BUCKET_KINDS = 4, 2
PRIOR = 20.0
STEP_TOKENS = 1 << 14
SLOT_ROWS = 512
COUNTED_TOKENS = 1 << 31  # a task's counts are 32 bits wide
ORIGIN = np.uint32(0x5BD1E995)  # stands for the words before the first


def tokens_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    words = [t.lower().split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words)) + 1
    flat: list[bytes] = []
    for ws in words:
        flat += ws
        flat.append(END)
    return flat, counts


def held_out(id_column: Column) -> Column:
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


@dataclass
class Weights:
    """Class rows (features, classes), bucket rows (features, classes, buckets), and their biases."""

    classes: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    buckets: np.ndarray = field(default_factory=lambda: np.zeros((BUCKET_ROWS, CLASSES, IN_CLASS), np.float32))
    class_bias: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES, np.float32))
    bucket_bias: np.ndarray = field(default_factory=lambda: np.zeros((CLASSES, IN_CLASS), np.float32))


@dataclass(frozen=True)
class Lexicon:
    """Counts and buckets: of the commonest words by name, of all by bucket."""

    head: dict[bytes, int]
    own: dict[bytes, int]
    total: int
    distinct: int
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray

    def bucket_of(self, words: list[bytes], hashes: np.ndarray) -> np.ndarray:
        shared = OWN_BUCKETS + hashes.astype(np.int64) % (BUCKETS - OWN_BUCKETS)
        own = np.fromiter(map(self.own.get, words, repeat(-1)), np.int64, len(words))
        # Neighbouring ranks go to different classes.
        spread = np.where(own >= 0, own, shared)
        return (spread % CLASSES) * IN_CLASS + spread // CLASSES


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for _, texts in sliced(batches):
        counts.update(tokens_of(texts)[0])
        if len(counts) > COUNTED_WORDS:
            yield rows()
            counts.clear()
    if counts:
        yield rows()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) of all tokens, written once."""
    counted = mapped(texts.select("text"), _counted, "word binary, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def lexicon(counts: DataFrame) -> tuple[Lexicon, int]:
    """The lexicon, and the count from which on words are in its head."""
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = counts.groupBy(level.alias("level")).agg(F.count("n").alias("words"), F.min("n").alias("least")).orderBy(F.desc("level"))
    held, least = 0, 1 << 62
    for row in levels.collect():  # 16 for each doubling of the count
        held += row.words
        if held > HEAD_WORDS:
            break
        least = row.least
    head = {bytes(r.word): r.n for r in counts.where(F.col("n") >= least).collect()}  # at most HEAD_WORDS
    commonest = sorted(head, key=lambda w: (-head[w], w))[:OWN_BUCKETS]
    own = {w: k for k, w in enumerate(commonest)}
    shared = (F.crc32("word") % (BUCKETS - OWN_BUCKETS)).cast("int")
    sums = counts.groupBy(shared.alias("b")).agg(F.sum("n").alias("n"), F.count("n").alias("v")).collect()
    tokens, words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sums:
        tokens[OWN_BUCKETS + row.b], words[OWN_BUCKETS + row.b] = row.n, row.v
    for word, k in own.items():  # out of the shared buckets, into their own
        b = OWN_BUCKETS + zlib.crc32(word) % (BUCKETS - OWN_BUCKETS)
        tokens[b] -= head[word]
        words[b] -= 1
        tokens[k], words[k] = head[word], 1
    spread = np.arange(BUCKETS)
    place = (spread % CLASSES) * IN_CLASS + spread // CLASSES
    by_bucket = np.zeros((2, BUCKETS))
    by_bucket[0, place], by_bucket[1, place] = tokens, words
    total, distinct = sum(r.n for r in sums), sum(r.v for r in sums)
    return Lexicon(head, own, total, distinct, by_bucket[0], by_bucket[1]), least


def first_weights(words: Lexicon) -> Weights:
    """Biases of the share of each class and bucket; no feature counts yet."""
    mass = (words.bucket_tokens + words.bucket_words + 1).reshape(CLASSES, IN_CLASS)
    return Weights(
        class_bias=np.log(mass.sum(axis=1)).astype(np.float32),
        bucket_bias=np.log(mass / mass.sum(axis=1, keepdims=True)).astype(np.float32),
    )


def rows_for(tokens: int) -> int:
    """Class rows for so many training tokens."""
    wanted = 4 * math.isqrt(max(0, tokens))
    return min(MOST_ROWS, max(CLASS_ROWS, 1 << (wanted - 1).bit_length() if wanted else 0))


def features(hashes: np.ndarray, counts: np.ndarray, held: int = CLASS_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Of ``held`` class rows, those of each token: four for the class (n-grams and skips), two for the bucket."""
    starts, row = ragged(counts)
    place = np.arange(len(hashes)) - starts[row]
    before = []
    for back in (1, 2, 3):
        shifted = np.r_[np.zeros(min(back, len(hashes)), np.uint32), hashes[:-back]][: len(hashes)]
        before.append(np.where(place >= back, shifted, ORIGIN + np.uint32(back)).astype(np.uint64))
    one, two, three = before
    kinds = [one, one << np.uint64(32) | two, two + np.uint64(1 << 40), three + np.uint64(1 << 41)]
    class_rows = np.stack([mixed(k) & np.uint64(held - 1) for k in kinds]).astype(np.int64)
    bucket_rows = np.stack([mixed(k + np.uint64(1 << 50)) & np.uint64(held // ROWS_A_BUCKET_ROW - 1) for k in (one, two)]).astype(np.int64)
    return class_rows, bucket_rows


def _scores(weights: Weights, class_rows, bucket_rows, classes) -> tuple[np.ndarray, np.ndarray]:
    class_scores = weights.class_bias + weights.classes[class_rows[0]]
    for rows in class_rows[1:]:
        class_scores += weights.classes[rows]
    in_class = weights.bucket_bias[classes]
    for rows in bucket_rows:
        in_class += weights.buckets[rows, classes]
    return class_scores, in_class


def log_shares(weights: Weights, class_rows, bucket_rows, buckets) -> np.ndarray:
    """Natural log of P(class) P(bucket | class) of each token."""
    classes, inner, at = buckets // IN_CLASS, buckets % IN_CLASS, np.arange(len(buckets))
    class_scores, in_class = _scores(weights, class_rows, bucket_rows, classes)
    total = np.zeros(len(buckets))
    for scores, chosen in ((class_scores, classes), (in_class, inner)):
        scores -= scores.max(axis=1, keepdims=True)
        total += scores[at, chosen] - np.log(np.exp(scores).sum(axis=1))
    return total


def seen_together(hashes: np.ndarray, counts: np.ndarray, buckets: np.ndarray, held: int, into: np.ndarray) -> None:
    """Adds to ``into``, a line of ``CLASSES`` columns for each feature row, where rows and outcomes meet.

    Class rows come first, against classes; then the bucket rows, one a class, against buckets.
    """
    classes, inner = buckets // IN_CLASS, buckets % IN_CLASS
    class_rows, bucket_rows = features(hashes, counts, held)
    cells = into.reshape(-1)
    for rows in class_rows:
        np.add.at(cells, rows * CLASSES + classes, 1)
    for rows in bucket_rows:
        np.add.at(cells, (held + rows * CLASSES + classes) * IN_CLASS + inner, 1)


def updated(first: int, seen: np.ndarray, weights: Weights, held: int) -> np.ndarray:
    """Weights of the feature rows from ``first`` on, whose meetings with all outcomes are ``seen``."""
    rows = first + np.arange(len(seen))
    class_shares = np.exp(weights.class_bias.astype(np.float64))
    inner_shares = np.exp(weights.bucket_bias.astype(np.float64))
    of_class = (rows < held)[:, None]
    shares = np.where(of_class, class_shares / class_shares.sum(), inner_shares[(rows - held) % CLASSES])
    gradient = seen - seen.sum(axis=1, keepdims=True) * shares
    expected = (seen.sum(axis=1, keepdims=True) + PRIOR) * shares
    return (np.log1p(gradient / expected) / np.where(of_class, CLASS_KINDS, BUCKET_KINDS)).astype(np.float32)


SLOTS = "slot long, seen binary"


def _gathered(words: Broadcast, held: int):
    lines = held + held // ROWS_A_BUCKET_ROW * CLASSES

    def rows(seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        for first in range(0, lines, SLOT_ROWS):
            part = seen[first : first + SLOT_ROWS]
            if part.any():
                packed = zlib.compress(part.tobytes(), 1)
                yield pa.RecordBatch.from_arrays([pa.array([first // SLOT_ROWS]), pa.array([packed])], names=["slot", "seen"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, tokens = np.zeros((lines, CLASSES), np.uint32), 0
        for _, texts in sliced(batches):
            flat, counts = tokens_of(texts)
            hashes = np.fromiter(map(zlib.crc32, flat), np.uint32, len(flat))
            seen_together(hashes, counts, words.value.bucket_of(flat, hashes), held, seen)
            tokens += len(flat)
            if tokens > COUNTED_TOKENS // CLASS_KINDS:
                yield from rows(seen)
                seen[:], tokens = 0, 0
        yield from rows(seen)

    return gather


def _stepped(weights: Weights, held: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """New weights of the slots of a partition; their counts are summed row by row as they come."""
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                seen = np.frombuffer(zlib.decompress(packed), np.uint32)
                if slot in sums:
                    sums[slot] += seen
                else:
                    sums[slot] = seen.astype(np.int64)
        for slot, seen in sums.items():
            new = updated(slot * SLOT_ROWS, seen.reshape(-1, CLASSES), weights, held)
            yield pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([new.tobytes()])], names=["slot", "seen"])

    return step


def train(texts: DataFrame, words: Lexicon) -> Weights:
    """The weights after one update by the gradient over all ``texts``."""
    held, start = rows_for(words.total), first_weights(words)
    counted = mapped(texts.select("text"), _gathered(texts.sparkSession.sparkContext.broadcast(words), held), SLOTS)
    lines = np.zeros((held + held // ROWS_A_BUCKET_ROW * CLASSES, CLASSES), np.float32)
    # At most the weights' own size, whatever the input.
    for slot, new in mapped(counted.repartition("slot"), _stepped(start, held), SLOTS).toLocalIterator():
        part = np.frombuffer(new, np.float32).reshape(-1, CLASSES)
        lines[slot * SLOT_ROWS : slot * SLOT_ROWS + len(part)] = part
    return Weights(lines[:held], lines[held:].reshape(-1, CLASSES, IN_CLASS), start.class_bias, start.bucket_bias)


SCORED = "row long, doc_id {}, held_out boolean, n_tokens long, known long, counts double, shares double, tail array<binary>"


def _scored(words: Broadcast, weights: Broadcast):
    names = [c.split()[0] for c in SCORED.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = words.value
        spread = np.log10(lex.bucket_tokens + lex.bucket_words + 1)
        for batch, texts in sliced(batches):
            flat, counts = tokens_of(texts)
            hashes = np.fromiter(map(zlib.crc32, flat), np.uint32, len(flat))
            buckets = lex.bucket_of(flat, hashes)
            class_rows, bucket_rows = features(hashes, counts, len(weights.value.classes))
            shares = np.empty(len(flat))
            for k in range(0, len(flat), STEP_TOKENS):
                part = slice(k, k + STEP_TOKENS)
                shares[part] = log_shares(weights.value, class_rows[:, part], bucket_rows[:, part], buckets[part])
            head = np.fromiter(map(lex.head.get, flat, repeat(0)), np.int64, len(flat))
            _, row = ragged(counts)
            per_text = lambda values: np.bincount(row, weights=values, minlength=len(counts))
            rare = np.flatnonzero(head == 0)
            tail = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(rare, np.r_[0, np.cumsum(counts)]).astype(np.int32)),
                pa.array([flat[k] for k in rare.tolist()], pa.binary()),
            )
            columns = [batch.column("row"), batch.column("doc_id"), batch.column("held_out"), pa.array(counts)]
            columns += [pa.array(per_text(head > 0).astype(np.int64)), pa.array(per_text(np.log10(head + 1.0)))]
            columns += [pa.array(per_text(shares / np.log(10) - spread[buckets])), tail]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return score


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    The model learns from the documents that aren't held out.
    """
    source = picked(docs, doc_id=id_column, text=text_column).withColumn("held_out", held_out(F.col("doc_id")))
    learned = source.where("NOT held_out")
    counts = word_counts(learned)
    words, least = lexicon(counts)
    weights = train(learned, words)
    context = docs.sparkSession.sparkContext
    rows = source.withColumn("row", F.monotonically_increasing_id())
    kind = source.schema["doc_id"].dataType.simpleString()
    scored = mapped(rows, _scored(context.broadcast(words), context.broadcast(weights)), SCORED.format(kind))
    scored = written(scored, "scored", "zstd")
    rare = scored.select("row", F.explode("tail").alias("word")).join(counts.where(F.col("n") < least), "word")
    found = rare.groupBy("row").agg(F.count("n").alias("k"), F.sum(F.log10(F.col("n") + 1.0)).alias("s"))
    joined = scored.drop("tail").join(found, "row", "left")
    known = F.col("known") + F.coalesce("k", F.lit(0))
    sums = F.col("counts") + F.coalesce("s", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", known.alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (sums - F.col("n_tokens") * float(np.log10(words.total + words.distinct + 1))).alias("base_score"),
        (sums + F.col("shares")).alias("score"),
    )
