from __future__ import annotations

import itertools
import random
import re

import corpora
import numpy as np
import pytest

from martwright.llm import near_dedup
from martwright.llm.near_dedup import components, keep_one, near_duplicates, possible_pairs, table_keys

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def expected(rows) -> list[tuple]:
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in itertools.combinations(range(len(rows)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            parent[root(b)] = root(a)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((doc, len(sets[k]), least, doc == least))
    return sorted(out, key=repr)


def edited(text: str, share: float, rng: random.Random) -> str:
    words = text.split()
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = corpora.words(rng.randrange(10**9), 1)
    return " ".join(words)


def test_against_brute_force(odd, rows):
    found = near_duplicates(odd).select("doc_id", "n_shingles", "component_id", "kept")
    assert rows(found) == expected(corpora.odd_rows())


def test_families_and_shared_passages(spark, rows):
    rng = random.Random(3)
    texts, passage = [], corpora.words(99, 60)
    for family in range(12):
        base = corpora.words(500 + family, 200)
        texts += [base, base] + [edited(base, share, rng) for share in (0.005, 0.01, 0.015, 0.02, 0.03, 0.1)]
        texts.append(edited(texts[-3], 0.01, rng))  # a copy of a copy
    texts += [f"{passage} {corpora.words(900 + k, 30)}" for k in range(40)]
    source = list(enumerate(texts))
    rng.shuffle(source)
    found = near_duplicates(corpora.documents(spark, source).repartition(4)).select("doc_id", "n_shingles", "component_id", "kept")
    assert rows(found) == expected(source)


@pytest.mark.parametrize("crowd", [3, 1000])
def test_links_that_miss_the_first_member(spark, rows, monkeypatch, crowd):
    """Sets that share tables but not links with a table's first member still find each other."""
    rng = random.Random(8)
    core = corpora.words(1, 150)
    texts = []
    for k in range(10):  # ten pairs; across pairs the similarity is below the limit
        one = f"{core} {corpora.words(100 + k, 60)}"
        texts += [one, edited(one, 0.005, rng)]
    source = list(enumerate(texts))
    monkeypatch.setattr(near_dedup, "BLOCK", 4)  # and blocks are split
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    found = near_duplicates(corpora.documents(spark, source)).select("doc_id", "n_shingles", "component_id", "kept")
    assert rows(found) == expected(source)


def test_crowded_members_are_dealt_by_collection(spark, rows, monkeypatch):
    """A row a collection for each member, not one a table; a nearest pair is named by one collection's task."""
    rng = random.Random(6)
    core = corpora.words(1, 150)
    texts = []
    for k in range(20):
        one = f"{core} {corpora.words(100 + k, 20)}"
        texts += [one, edited(one, 0.005, rng)]
    dealt, mapped = {}, near_dedup.mapped

    def counted(df, function, schema):
        out = mapped(df, function, schema)
        dealt.setdefault(function.__name__, []).append((df.count(), out.count()))
        return out

    monkeypatch.setattr(near_dedup, "CROWD", 3)
    monkeypatch.setattr(near_dedup, "mapped", counted)
    found = near_duplicates(corpora.documents(spark, list(enumerate(texts)))).select("doc_id", "n_shingles", "component_id", "kept")
    assert rows(found) == expected(list(enumerate(texts)))
    assert all(0 < read <= near_dedup.SIDE * len(texts) and made <= near_dedup.NEAREST * len(texts) for read, made in dealt["nearest"])


@pytest.mark.parametrize("number", [0, 3])
def test_possible_pairs_of_a_collection(number):
    rng = np.random.default_rng(5)
    n, side = 200, near_dedup.SIDE
    component, size = rng.integers(0, 40, n), rng.integers(50, 80, n)
    signature = rng.integers(0, 2, (n, near_dedup.HASHES)).astype(np.uint8)
    halves = rng.integers(0, 4, (n, 2 * side))
    halves[:, number] = 7
    halves[: n // 2, side:] = np.arange(n // 2 * side).reshape(-1, side) + 100  # these share no table with any other
    group = near_dedup.Group(np.uint64(1), np.arange(n), component, size, signature, halves, None, number)
    found = [(int(a), int(b)) for x, y in possible_pairs(group) for a, b in zip(x, y, strict=True)]
    brute = set()
    for a, b in itertools.combinations(range(n), 2):
        same = halves[a] == halves[b]
        sizes = 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b])
        equal = (signature[a] == signature[b]).sum() >= near_dedup.LEAST_EQUAL
        if component[a] != component[b] and sizes and equal and same[side:].any() and not same[:number].any():
            brute.add((a, b))
    assert brute and sorted(found) == sorted(brute)


def test_possible_pairs_against_all_pairs():
    rng = np.random.default_rng(2)
    n = 300
    component, size = rng.integers(0, 40, n), rng.integers(50, 80, n)
    signature = rng.integers(0, 2, (n, near_dedup.HASHES)).astype(np.uint8)
    halves = rng.integers(0, 3, (n, 2 * near_dedup.SIDE))
    halves[:, [2, near_dedup.SIDE + 4]] = 7  # all share the table of these two collections
    key = table_keys(halves[:1])[0, 2 * near_dedup.SIDE + 4]
    group = near_dedup.Group(key, np.arange(n), component, size, signature, halves, None)
    found = {(int(a), int(b)) for x, y in possible_pairs(group) for a, b in zip(x, y, strict=True)}
    brute = set()
    for a, b in itertools.combinations(range(n), 2):
        common = [k for k, (p, q) in enumerate(zip(table_keys(halves[[a]])[0], table_keys(halves[[b]])[0], strict=True)) if p == q]
        sizes = 100 * min(size[a], size[b]) >= 85 * max(size[a], size[b])
        equal = (signature[a] == signature[b]).sum() >= near_dedup.LEAST_EQUAL
        if component[a] != component[b] and sizes and equal and common[0] == 2 * near_dedup.SIDE + 4:
            brute.add((a, b))
    assert brute
    assert found == brute
    nearest = {(int(a), int(b)) for x, y in near_dedup.nearest_pairs(group) for a, b in zip(x, y, strict=True)}
    assert max(sum(a == k for a, _ in nearest) for k in range(n)) == near_dedup.NEAREST


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(k, k + 1) for k in range(50)], [(0, k) for k in range(1, 40)] + [(77, 90), (90, 77)]])
def test_components(spark, edges):
    frame = spark.createDataFrame(edges, "a long, b long")
    label = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert {(r.rep, r.component) for r in components(frame).collect()} == set(label.items())


def test_keep_one(odd):
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {None, 1, 2, 3, 4, 7, *range(9, 15), 16}
    assert kept.where("doc_id = 4").count() == 1  # of rows that repeat, one stays


def test_empty(none):
    assert near_duplicates(none).count() == 0
    assert keep_one(none).count() == 0


def test_limits():
    usual, lower = near_dedup.Limit(85), near_dedup.Limit(80)
    assert (usual.side, usual.least_equal, usual.least_wide) == (9, 19, 395)
    assert 2 * (1 - 0.8**2) ** lower.side <= 2e-5
    assert lower.least_equal / lower.hashes < usual.least_equal / usual.hashes and lower.least_wide < usual.least_wide
    with pytest.raises(ValueError):
        near_dedup.Limit(5)


def between_the_limits() -> tuple[str, str]:
    base = corpora.words(77, 120).split()
    other = " ".join(base[:108]) + " " + corpora.words(78, 12)
    share = len(shingles(" ".join(base)) & shingles(other)) / len(shingles(" ".join(base)) | shingles(other))
    assert 0.80 <= share < 0.85
    return " ".join(base), other


def test_a_lower_limit_links_more(spark, rows):
    source = [*enumerate(between_the_limits()), (2, corpora.words(5, 90))]
    docs = corpora.documents(spark, source)
    at = lambda percent: {r.doc_id for r in keep_one(docs, percent=percent).collect()}
    assert at(85) == {0, 1, 2}
    assert at(80) == {0, 2}


@pytest.mark.parametrize("crowd", [3, 1000])
def test_lower_limit_against_all_pairs(spark, rows, monkeypatch, crowd):
    rng = random.Random(4)
    texts, core = [], corpora.words(1, 150)
    for family in range(12):
        base = corpora.words(700 + family, 200)
        texts += [base] + [edited(base, share, rng) for share in (0.01, 0.015, 0.02, 0.0225, 0.025, 0.03)]
    for k in range(10):  # across pairs the similarity is 0.65
        one = f"{core} {corpora.words(100 + k, 40)}"
        texts += [one, edited(one, 0.02, rng)]
    source = list(enumerate(texts))
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    found = near_duplicates(corpora.documents(spark, source), percent=80).select("doc_id", "n_shingles", "component_id", "kept")
    assert rows(found) == expected_at(source, 80)


def expected_at(rows, percent: int) -> list[tuple]:
    sets = [shingles(t) for _, t in rows]
    near = [[k for k, o in enumerate(sets) if 100 * len(s & o) >= percent * len(s | o)] for s in sets]
    least = list(range(len(rows)))
    for _ in rows:
        least = [min(least[j] for j in near[k]) for k in range(len(rows))]
    return sorted([(rows[k][0], len(sets[k]), rows[least[k]][0], least[k] == k) for k in range(len(rows))], key=repr)


def test_the_stage_links_from_80_percent(spark):
    import corpus_pipeline

    docs = corpora.documents(spark, list(enumerate(between_the_limits())))
    assert [r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()] == [0]
