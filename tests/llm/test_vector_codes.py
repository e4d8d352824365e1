from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from martwright.llm import common, vector_codes
from martwright.llm.vector_codes import Cells

SCHEMA = "vec_id long, embedding array<float>, label int, id long, codes string, error long, whole string, vector int, none string, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, "w", 3, "x", 4) for r in rows], SCHEMA).repartition(3)


def rows(n, length=32, seed=1, near=False):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=(n, length)) if not near else np.round(rng.normal(size=(n, length)) * 2) / 256
    return [(k, values[k].astype(np.float32).tolist(), int(rng.integers(0, 4)) if k % 5 else None) for k in range(n)]


def brute(source, parts=16, entries=64, rounds=2):
    kept = [(i, [int(np.floor(256 * float(x))) for x in v], la) for i, v, la in source if v and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    v = np.array([k[1] for k in kept], np.int64).reshape(len(kept), parts, -1)
    books = v[:entries].transpose(1, 0, 2).copy()
    for step in range(rounds + 1):
        distance = ((v[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        index = distance.argmin(axis=2)
        if step < rounds:
            for p in range(parts):
                for e in range(books.shape[1]):
                    mine = v[index[:, p] == e, p]
                    if len(mine):
                        books[p, e] = [int(s) // len(mine) for s in mine.sum(axis=0)]
    error = distance.min(axis=2).sum(axis=1)
    sums = Counter()
    for (_, _, label), e in zip(kept, error, strict=True):
        sums[label] += int(e)
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel().tolist()).encode()).hexdigest()
    return [(k[0], "".join(f"{i:02x}" for i in index[j]), int(error[j]), sums[k[2]], digest) for j, k in enumerate(kept)]


def same(spark, source, **options):
    result = vector_codes.vector_codes(table(spark, source), **options)
    assert result.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in result.collect()), key=repr) == sorted(brute(source, **options), key=repr)


def test_against_brute_force(spark):
    same(spark, rows(700))


def test_ties_and_repeated_rows(spark):
    source = rows(300, near=True)
    same(spark, source + source[:100] + [(None, source[0][1], 2), (None, source[1][1], None)])


def test_rows_that_are_dropped(spark):
    bad = [(1000, None, 1), (1001, [], 1), (1002, [float("nan")] + [0.0] * 31, 1), (1003, [float("inf")] * 32, 2), (1004, [None] + [0.0] * 31, None),
           (-1, [None] * 32, 1), (None, None, None)]
    same(spark, rows(100) + bad)
    assert vector_codes.vector_codes(table(spark, bad)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_rows_than_entries(spark, n):
    same(spark, rows(n))


def test_other_shapes(spark):
    same(spark, rows(200, length=12), parts=4, entries=7, rounds=3)
    same(spark, rows(60, length=16), rounds=0)


def test_labels_beyond_what_is_broadcast(spark, monkeypatch):
    monkeypatch.setattr(common, "HELD_GROUPS", 3)
    same(spark, [(i, v, i if i % 3 else 7) for i, v, _ in rows(200)])


def test_lengths_and_sizes_that_are_refused(spark):
    with pytest.raises(ValueError, match="one length"):
        vector_codes.vector_codes(table(spark, rows(3, length=17)))
    with pytest.raises(Exception, match="unequal length"):
        vector_codes.vector_codes(table(spark, rows(70) + [(900, [1.0] * 16, 1)])).collect()
    with pytest.raises(Exception, match="lies beyond"):
        vector_codes.vector_codes(table(spark, [(1, [1e30] * 32, 1)])).collect()


@pytest.mark.parametrize(("spread", "width"), [(1, 3), (40, 4), (5000, 4), (3, 70)])
def test_cells_give_the_nearest_entry(spread, width, monkeypatch):
    monkeypatch.setattr(vector_codes, "CACHED", 50)
    rng = np.random.default_rng(spread)
    book = rng.integers(-spread, spread + 1, (64, width))
    points = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (2000, width)), book, book[:1] + 10**6])
    cells = Cells(book)
    for part in (points, points[::-1]):
        index, distance = cells.nearest(part)
        exact = ((part[:, None] - book) ** 2).sum(axis=2)
        assert (index == exact.argmin(axis=1)).all()
        assert (distance == exact.min(axis=1)).all()


def test_cells_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(vector_codes, "mixed", lambda values: np.zeros(len(values), np.uint64))
    rng = np.random.default_rng(3)
    book, points = rng.integers(-90, 90, (20, 4)), rng.integers(-90, 90, (500, 4))
    index, _ = Cells(book).nearest(points)
    assert (index == ((points[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_cells_leave_entries_out():
    rng = np.random.default_rng(4)
    cells = Cells(rng.integers(-90, 90, (64, 4)))
    cells.nearest(rng.integers(-90, 90, (2000, 4)))
    assert cells.lengths.mean() < 40
