from __future__ import annotations

import re
from collections import Counter

import corpora
import pytest

from martwright.llm import collocations, common

SCHEMA = "lang string, text string, key long, row long, slots string, word long, phrase string, n long, a long"


def documents(spark, pairs):
    return spark.createDataFrame([(lang, text, 1, 2, "s", 3, "p", 4, 5) for lang, text in pairs], SCHEMA).repartition(3)


def brute(pairs, least=3, longest=3, first=2000, percent=50):
    found = Counter()
    for lang, text in pairs:
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            ws = re.findall("[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                found.update((lang or "und", tuple(ws[i : i + k])) for i in range(len(ws) - k + 1))
    out = []
    candidates = {c: a for c, a in found.items() if len(c[1]) > 1 and a >= least}
    for (lang, p), a in candidates.items():
        inside = lambda q, p=p: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        if any(la == lang and len(q) > len(p) and 100 * b >= percent * a and inside(q) for (la, q), b in candidates.items()):
            continue
        cuts = [(found[lang, p[:k]], found[lang, p[k:]], k) for k in range(1, len(p))]
        score, _, left, right = min((1000000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
        n = sum(b for (la, q), b in found.items() if la == lang and len(q) == 1)
        out.append((lang, " ".join(p), a, left, right, n, score))
    ranked, place = [], Counter()
    for row in sorted(out, key=lambda r: (r[0], -r[6], -r[2], r[1].encode())):
        place[row[0]] += 1
        if place[row[0]] <= first:
            ranked.append((row[0], place[row[0]], *row[1:]))
    return ranked


ODD = [
    (None, None), ("en", None), (None, "a b a b. a b"), ("und", "a b, A b a B\ta b"), ("en", ""), ("en", " \t\n .,;"),
    ("en", "New York city, new york CITY; new york city new york"), ("de", "new york new york"), ("x", "é è é è é è é è ́é"),
    ("en", "tick tick tick tick tick tick"), ("y", "a\x0bb a　b a　b a　b a　b z"), ("de", corpora.words(5, 3000)),
    ("en", corpora.words(6, 400) + ". " + corpora.words(6, 400)), ("en", corpora.words(2, 40_000)), ("en", "w" * 100_000),
] + [("en", corpora.words(7, 60))] * 4 + [("k", "one\0two three")] * 5


@pytest.fixture(params=["held", "dealt"])
def way(request, monkeypatch):
    """Both ways of the semi-join: with groups held by the tasks, and with most of them dealt by key."""
    if request.param == "dealt":
        monkeypatch.setattr(common, "HELD_GROUPS", 6)


def test_against_brute_force(spark, way):
    result = collocations.collocations(documents(spark, ODD), least=3)
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert result.columns == list(columns)
    found = sorted(tuple(r) for r in result.select(*columns).collect())
    assert found == sorted(brute(ODD))


@pytest.mark.parametrize(("longest", "percent"), [(2, 50), (4, 80), (5, 30)])
def test_other_lengths(spark, longest, percent):
    docs = [("en", corpora.words(k % 3, 40) + ", " + corpora.words(9, 12)) for k in range(9)]
    result = collocations.collocations(documents(spark, docs), least=4, longest=longest, first=7, covered_percent=percent)
    assert sorted(tuple(r) for r in result.collect()) == sorted(brute(docs, 4, longest, 7, percent))


def test_products_beyond_64_bits(spark):
    n = 3_000_000_000
    groups = spark.createDataFrame([(1, "x", "a b", n, [n], [n]), (2, "x", "a c", n - 1, [n], [n])],
                                   "key long, lang string, phrase string, a long, heads array<long>, tails array<long>")
    assert [r.score for r in collocations._scored(groups).orderBy("key").collect()] == [10**6, 10**6 * (n - 1) ** 2 // n**2]


def test_keys_that_are_not_one_to_one_take_another_seed(spark, monkeypatch):
    words, unique, seeds = collocations._tokenized, collocations._one_to_one, []
    monkeypatch.setattr(collocations, "_tokenized", lambda seed: seeds.append(seed) or words(seed))
    monkeypatch.setattr(collocations, "_one_to_one", lambda groups: len(seeds) > 1 and unique(groups))
    docs = [("en", "a b c a b c a b")] * 3
    assert sorted(tuple(r) for r in collocations.collocations(documents(spark, docs), least=3).collect()) == sorted(brute(docs))
    assert seeds == [0, 1]
    for keys, good in (([1, 2], True), ([1, 1], False), ([0], False)):
        assert unique(spark.createDataFrame([(k,) for k in keys], "key long")) == good


def test_slices_hold_whole_lines(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(collocations, "SLOTS_AT_A_TIME", 4)
    lines = [[], [1], [2, 3, 4], [5] * 9, [], [6], [7, 8], [9, 9, 9]]
    batch = pa.RecordBatch.from_pydict({"row": list(range(8)), "slots": pa.array(lines, pa.list_(pa.int64()))})
    parts = list(collocations._cut([batch, batch.slice(0, 0), batch.slice(2, 3)]))
    assert [x for p in parts for x in p.column("slots").to_pylist()] == lines + lines[2:5]
    assert all(p.num_rows == 1 or sum(map(len, p.column("slots").to_pylist())) <= 4 for p in parts)


def test_pairs_that_share_a_hash_are_told_apart(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(collocations, "_hashed", lambda left, right, seed: (left + right * seed).view(np.uint64))
    groups = pa.table({"left": [1, 1, 2], "right": [5, 6, 5], "key": [7, 8, 9]})
    lookup = collocations._Lookup(groups)
    assert lookup.find(np.array([1, 1, 2, 2, 3]), np.array([5, 6, 5, 6, 5])).tolist() == [7, 8, 9, 0, 0]
    counted = collocations._counted([(np.array([1, 2, 1]), np.array([5, 5, 6])), (np.array([1]), np.array([5]))]).to_pydict()
    sums = Counter()
    for left, right, n in zip(counted["left"], counted["right"], counted["n"], strict=True):
        sums[left, right] += n
    assert sums == {(1, 5): 2, (2, 5): 1, (1, 6): 1}


def test_empty_and_wordless_tables(spark, way):
    for rows in ([], [(None, None)], [("en", " . ")]):
        empty = spark.createDataFrame([(lang, t, 1, 2, "s", 3, "p", 4, 5) for lang, t in rows], SCHEMA)
        assert collocations.collocations(empty).collect() == []
