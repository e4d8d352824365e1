"""Quality by nearest-neighbour voting among latent-semantic vectors of labelled texts.

A text's terms are its hashed byte trigrams (A-Z lower-cased) and its shape: four
measures (words equal to the one before, distinct words, word length, symbols), each
in one of 16 bins. Term weights are log(1 + count) times the inverse document
frequency over *all* documents; trigrams and shape are scaled to length 1 each,
the latter times ``SHAPE``. The latent space has ``DIMENSIONS`` axes: the leading
right singular vectors of the weights of a sample of labelled texts, found by
subspace iteration. At most ``LABELLED`` labels are used, those that come first by a hash of
the id; the sums over them are made in a fixed order, so a model is repeatable.

The sample's vectors (``LABELLED`` times ``DIMENSIONS`` numbers) go to every task,
which takes the cosine products of every text with all of them, block by block.
The ``NEIGHBOURS`` most similar vote, those as similar as the last of them too, each
with its similarity to the power of ``SHARPNESS``. A score is the share of votes
for label 1.

Null counts as empty. A text without terms, as an empty one, or unlike all the
sample gets the sample's share of label 1; without labels every score is 0.5. A
document labelled twice counts as good only if all its labels say so; null labels
are left out. Rows that repeat are scored alike, and each is in the sample if
one is. An empty table gives an empty result. Other columns are never read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, picked, sliced, written

LABELLED = 8_000
DIMENSIONS = 48
ROUNDS = 3
NEIGHBOURS = 15
SHARPNESS = 8
SHAPE = 1.0
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
BINS, MEASURES = 16, 4
TERMS = BUCKETS + BINS * MEASURES
# The sample's matrix is handled in so many groups of rows, and texts in blocks of so many.
GROUPS = 8
BLOCK = 64
# Bytes that are no symbols: letters, white space, full stop and comma, and all beyond ASCII.
PLAIN = b"abcdefghijklmnopqrstuvwxyz \t\n\r.," + bytes(range(128, 256))


def shape(text: bytes) -> list[int]:
    """Terms that say what a lower-cased text looks like, one a measure."""
    words = text.split()
    if not words:
        return []
    n = len(words)
    measures = (
        sum(map(eq, words, words[1:])) / n,
        len(set(words)) / n,
        len(b"".join(words)) / n / 10,
        len(text.translate(None, PLAIN)) / len(text),
    )
    return [BUCKETS + BINS * k + min(BINS - 1, int(BINS * m**0.5)) for k, m in enumerate(measures)]


def term_counts(texts: list[bytes]) -> np.ndarray:
    """(texts, TERMS) counts."""
    lowered = [t.lower() for t in texts]
    flat = np.frombuffer(b"".join(lowered), np.uint8).astype(np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    inside = np.flatnonzero(row[2:] == row[:-2])
    codes = (flat[:-2] | flat[1:-1] << np.uint32(8) | flat[2:] << np.uint32(16))[inside] if len(inside) else flat[:0]
    buckets = (codes * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    counts = np.bincount(row[inside] * TERMS + buckets, minlength=len(texts) * TERMS).reshape(-1, TERMS)
    for k, text in enumerate(lowered):
        counts[k, shape(text)] = 1
    return counts


def weights(counts: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """(texts, TERMS) weights: both kinds of terms scaled to their lengths."""
    out = np.zeros(counts.shape, np.float32)
    line, term = np.nonzero(counts)
    out[line, term] = np.log1p(counts[line, term]) * inverse[term]
    for kind, length in ((slice(0, BUCKETS), 1.0), (slice(BUCKETS, TERMS), SHAPE)):
        norm = np.linalg.norm(out[:, kind], axis=1, keepdims=True)
        out[:, kind] *= length / np.where(norm > 0, norm, 1)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Blocks of rows with their term counts."""
    for batch, texts in sliced(batches):
        for k in range(0, len(texts), BLOCK):
            yield batch.slice(k, BLOCK), term_counts(texts[k : k + BLOCK])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(TERMS + 1, np.int64)  # the last is the number of texts
    for _, counts in _blocks(batches):
        n[:TERMS] += np.count_nonzero(counts, axis=0)
        n[TERMS] += len(counts)
    seen = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(n[seen])], names=["term", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """log((1 + texts) / (1 + texts with the term)) over all texts; ``TERMS`` sums reach the driver."""
    n = np.zeros(TERMS + 1)
    for row in mapped(texts.select("text"), _frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        n[row.term] = row.n
    return np.log((1 + n[TERMS]) / (1 + n[:TERMS])).astype(np.float32)


def _sample_rows(inverse: np.ndarray) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The labelled texts' weights, term by term where they are not zero."""
        for batch, counts in _blocks(batches):
            values = weights(counts, inverse)
            line, term = np.nonzero(values)
            ends = pa.array(np.searchsorted(line, np.arange(len(values) + 1)), pa.int32())
            terms = pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32)))
            weight = pa.ListArray.from_arrays(ends, pa.array(values[line, term]))
            rest = batch.drop_columns(["text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, terms, weight], names=[*rest.schema.names, "terms", "weights"])

    return rows


def _dense(rows: pa.Table) -> Iterator[np.ndarray]:
    """The rows' weights, a block at a time, in the order of their ids."""
    rows = rows.sort_by([("doc_id", "ascending"), ("row", "ascending")])
    terms, values = rows.column("terms").combine_chunks(), rows.column("weights").combine_chunks()
    for k in range(0, len(rows), BLOCK):
        part = terms.slice(k, BLOCK)
        lengths = np.diff(part.offsets.to_numpy())
        out = np.zeros((len(part), TERMS), np.float32)
        out[np.repeat(np.arange(len(part)), lengths), part.flatten().to_numpy()] = values.slice(k, BLOCK).flatten().to_numpy()
        yield out


def _product(axes: np.ndarray) -> Callable:
    def product(key: tuple, rows: pa.Table) -> pa.Table:
        out = np.zeros(axes.shape, np.float32)
        for block in _dense(rows):
            out += block.T @ (block @ axes)
        return pa.table({"group": pa.array([key[0].as_py()], pa.int32()), "product": [out.tobytes()]})

    return product


def _axes(sample: DataFrame) -> np.ndarray:
    """(TERMS, DIMENSIONS) leading right singular vectors of the sample's weights.

    Each round multiplies the axes with the matrix and its transpose, group by
    group, adds the groups' products up in order, and makes the axes orthonormal.
    """
    axes = np.random.default_rng(11).normal(size=(TERMS, DIMENSIONS)).astype(np.float32)
    for _ in range(ROUNDS):
        found = sample.groupBy("group").applyInArrow(_product(axes), "group int, product binary").collect()  # GROUPS rows
        total = np.zeros(axes.shape)
        for row in sorted(found, key=lambda r: r.group):
            total += np.frombuffer(row.product, np.float32).reshape(axes.shape)
        axes = np.linalg.qr(total)[0].astype(np.float32)
    return axes


def unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norm > 0, norm, 1)


@dataclass(frozen=True)
class Neighbours:
    """Inverse frequencies, axes, and the labelled texts' vectors with their labels."""

    inverse: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    good: np.ndarray

    @property
    def prior(self) -> float:
        return float(self.good.mean()) if len(self.good) else 0.5

    def vote(self, vectors: np.ndarray) -> np.ndarray:
        """Scores of latent vectors of length 1 or 0."""
        if not len(self.good):
            return np.full(len(vectors), self.prior)
        cosines = vectors @ self.vectors.T
        last = max(0, len(self.good) - NEIGHBOURS)
        least = np.partition(cosines, last, axis=1)[:, last : last + 1]
        votes = np.where(cosines >= least, np.maximum(cosines, 0), 0).astype(np.float64) ** SHARPNESS
        total = votes.sum(axis=1)
        shares = np.minimum(votes @ self.good / np.where(total > 0, total, 1), 1)
        return np.where(total > 0, shares, self.prior)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        return self.vote(unit(weights(counts, self.inverse) @ self.axes))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Neighbours:
    """Model from all documents and labels (doc_id, quality 0 or 1) of some."""
    texts = picked(docs, doc_id=id_column, text=text_column)
    inverse = inverse_frequencies(texts)
    chosen = (
        picked(labels, doc_id="doc_id", quality="quality")
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
        .select("doc_id", (F.col("quality") > 0).alias("good"))
    )
    found = texts.join(F.broadcast(chosen), "doc_id").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row"), "good",
        F.pmod(F.xxhash64("doc_id"), F.lit(GROUPS)).cast("int").alias("group"), "text",
    )
    columns = "doc_id long, row long, good boolean, group int, terms array<int>, weights array<float>"
    sample = written(mapped(found, _sample_rows(inverse), columns), "labelled-terms")
    axes = _axes(sample)

    def vectors(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("doc_id", "ascending"), ("row", "ascending")])
        found = [unit(block @ axes).astype(np.float32).tobytes() for block in _dense(rows)]
        good = np.array(rows.column("good").to_pylist(), np.uint8).tobytes()
        return pa.table({"group": pa.array([key[0].as_py()], pa.int32()), "vectors": [b"".join(found)], "good": [good]})

    latent = sample.groupBy("group").applyInArrow(vectors, "group int, vectors binary, good binary").collect()
    latent = sorted(latent, key=lambda r: r.group)
    join = lambda name, kind: np.frombuffer(b"".join(r[name] for r in latent), kind)
    return Neighbours(inverse, axes, join("vectors", np.float32).reshape(-1, DIMENSIONS), join("good", np.uint8).astype(np.float64))


def score(docs: DataFrame, model: Neighbours, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of every document."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts in _blocks(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(counts))], names=["doc_id", "score"])

    rows = picked(docs, doc_id=id_column, text=text_column)
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = mapped(rows, scored, f"doc_id {kind}, score double")
    return found.select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
