"""Quality rules: counts per text, and a likelihood ratio against trusted text.

The method compares two multinomials over hashed word n-grams (one and two
words): one of trusted target documents, one of the whole corpus. A document's
score is the mean log ratio of its n-grams; it is kept if the score reaches the
threshold. Corpus counts cover every document, target counts and threshold every
labelled one: one half of the trusted ones gives the target counts; the rest,
with those labelled poor, the threshold with the least loss, where losing a good
document counts ``GOOD_LOSS`` times keeping a poor one. The same tables give the
same verdicts.

Words are runs of bytes other than space and 09-0D. A text without words (null
and empty included) has n_words 0, so it fails the base rules. Without labelled
trusted documents nothing is rejected by the method. An empty table gives an
empty result; repeated rows are judged alike; a document labelled twice counts
as trusted only if all its labels say so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import held, mapped, mixed, picked, ragged, sliced, written

BUCKETS = 1 << 16
SMOOTHING = 0.5
GOOD_LOSS = 10
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
# The characters that count as symbols, and white space.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts end to end, and each text's number of words."""
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for ws in words for w in ws), np.uint64, int(counts.sum())), counts


def repeated_words(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the words that lie in a three-word window found twice or more in it."""
    total = np.zeros(len(counts), np.int64)
    if len(hashes) < 3:
        return total
    _, row = ragged(counts)
    inside = np.flatnonzero(row[2:] == row[:-2])
    keys = mixed(row.astype(np.uint64))[inside]
    for k, odd in enumerate(ODD):
        keys += hashes[inside + k] * odd
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[inside[again] + k] = True
    np.add.at(total, row[covered], 1)
    return total


def grams(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the one- and two-word n-grams, and the text each belongs to."""
    _, row = ragged(counts)
    pairs = np.flatnonzero(row[1:] == row[:-1])
    two = mixed(hashes[pairs] * ODD[0] + hashes[pairs + 1] * ODD[1])
    buckets = np.concatenate([hashes, two]) & np.uint64(BUCKETS - 1)
    return buckets.astype(np.int64), np.concatenate([row, row[pairs]])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    corpus, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch, texts in sliced(batches):
        buckets, row = grams(*word_hashes([t.lower() for t in texts]))
        corpus += np.bincount(buckets, minlength=BUCKETS)
        wanted = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        target += np.bincount(buckets[wanted[row]], minlength=BUCKETS)
    seen = np.flatnonzero(corpus)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(corpus[seen]), pa.array(target[seen])], names=["bucket", "corpus", "target"])


def gram_counts(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """N-gram counts of all texts, and of those in ``target``; at most ``BUCKETS`` rows reach the driver."""
    counted = mapped(texts.select("text", "target"), _counted, "bucket long, corpus long, target long")
    corpus, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counted.groupBy("bucket").agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target")).collect():
        corpus[row.bucket], target[row.bucket] = row.corpus, row.target
    return corpus, target


@dataclass(frozen=True)
class QualityModel:
    ratios: np.ndarray
    threshold: float

    def scores(self, hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        buckets, row = grams(hashes, counts)
        sums = np.bincount(row, weights=self.ratios[buckets], minlength=len(counts))
        return sums / np.maximum(1, np.bincount(row, minlength=len(counts)))


def log_ratios(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    shares = [np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS)) for c in (target, corpus)]
    return shares[0] - shares[1]


def least_loss(good: np.ndarray, poor: np.ndarray) -> float:
    """The threshold of least loss halfway between two scores, or below all; the lowest of equals."""
    if not len(good):
        return float("-inf")
    scores = np.unique(np.concatenate([good, poor]))
    cuts = np.r_[-np.inf, (scores[1:] + scores[:-1]) / 2]
    lost = np.searchsorted(np.sort(good), cuts)
    caught = np.searchsorted(np.sort(poor), cuts)
    return float(cuts[np.argmin(GOOD_LOSS * lost - caught)])


def least_loss_of(scores: DataFrame) -> float:
    """``least_loss`` over any number of rows (good, score).

    Distinct scores are sorted by ranges and summed up within them; one line a
    range, at most spark.sql.shuffle.partitions, reaches the driver.
    """
    change = F.when(F.col("good"), GOOD_LOSS).otherwise(-1)
    found = scores.groupBy("score").agg(F.sum(change).alias("change"), F.count_if("good").alias("good"))
    ranges = written(found.orderBy("score").withColumn("range", F.spark_partition_id()), "scores")
    upwards = Window.partitionBy("range").orderBy("score")
    cuts = ranges.withColumns({"loss": F.sum("change").over(upwards), "next": F.lead("score").over(upwards)})
    inner = F.min(F.when(F.col("next").isNotNull(), F.struct("loss", "score", "next"))).alias("inner")
    lines = cuts.groupBy("range").agg(
        inner, F.sum("change").alias("change"), F.sum("good").alias("good"),
        F.min("score").alias("first"), F.max("score").alias("last"),
    ).orderBy("range").collect()
    best, cut, before = 0, float("-inf"), 0
    if not sum(line.good for line in lines):
        return cut
    for line, after in zip(lines, [*lines[1:], None], strict=True):
        # Cuts between two scores of the range, then the one between its last and the next range's first.
        if line.inner and before + line.inner.loss < best:
            best, cut = before + line.inner.loss, (line.inner.score + line.inner.next) / 2
        before += line.change
        if after and before < best:
            best, cut = before, (line["last"] + after["first"]) / 2
    return cut


def _scored(model: QualityModel) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            scores = model.scores(*word_hashes([t.lower() for t in texts]))
            yield pa.RecordBatch.from_arrays([batch.column("good"), pa.array(scores)], names=["good", "score"])

    return score


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> QualityModel:
    """Model from all documents and all labels (doc_id, quality 0 or 1), which some of them have."""
    texts = picked(docs, doc_id=id_column, text=text_column)
    known = written(
        picked(labels, doc_id="doc_id", quality="quality")
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .select("doc_id", (F.col("quality") > 0).alias("good"), (F.xxhash64(F.col("doc_id"), F.lit(1)) % 2 == 0).alias("fits")),
        "labels",
    )
    small = held(known)
    labelled = texts.join(F.broadcast(known) if small else known, "doc_id", "left")
    if not small:
        labelled = written(labelled, "labelled")
    corpus, target = gram_counts(labelled.select("text", F.expr("coalesce(good AND fits, false)").alias("target")))
    ratios = log_ratios(target, corpus)
    model = QualityModel(ratios, float("-inf"))
    others = labelled.where("NOT good OR NOT fits").select("good", "text")
    return QualityModel(ratios, least_loss_of(mapped(others, _scored(model), "good boolean, score double")))


def measures(texts: list[bytes], model: QualityModel) -> dict[str, np.ndarray]:
    lowered = [t.lower() for t in texts]
    hashes, counts = word_hashes(texts)
    low_hashes, _ = word_hashes(lowered)
    lines = [[line for line in t.split(b"\n") if line.strip()] for t in texts]
    repeated = repeated_words(hashes, counts)
    base_failed = (counts < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * counts)
    scores = model.scores(low_hashes, counts)
    whole = lambda values: np.fromiter(values, np.int64, len(texts))
    return {
        "n_words": counts,
        "word_chars": whole(len(t.translate(None, SPACES).decode()) for t in texts),
        "n_symbols": whole(len(t) - len(t.translate(None, SYMBOLS)) for t in texts),
        "n_dup_lines": whole(len(x) - len(set(x)) for x in lines),
        "n_repeat_words": repeated,
        "base_failed": base_failed,
        "kept": ~base_failed & (scores >= model.threshold),
        "score": scores,
    }


MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, score double"
)


def judge(docs: DataFrame, model: QualityModel, text_column: str = "text", carried: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carried`` columns of every document and its measures."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches, "_text"):
            found = measures(texts, model)
            kept = batch.drop_columns(["_text"]) if batch.num_columns > 1 else batch.select([])
            yield pa.RecordBatch.from_arrays([*kept.columns, *map(pa.array, found.values())], names=[*kept.schema.names, *found])

    source = picked(docs, **{c: c for c in carried}, _text=text_column)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != "_text")
    return mapped(source, judged, f"{types}, {MEASURES}" if types else MEASURES)


def keep_good(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches, text_column):
            yield batch.filter(pa.array(measures(texts, model)["kept"]))

    return mapped(docs, kept, docs.schema)
