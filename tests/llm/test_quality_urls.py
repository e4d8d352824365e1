from __future__ import annotations

import re
from collections import Counter

import corpora
import numpy as np

from martwright.llm import quality, urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    found = WORD.findall(text)
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = Counter(zip(found, found[1:], found[2:], strict=False))
    inside = {k + j for k in range(len(found) - 2) if windows[tuple(found[k : k + 3])] > 1 for j in range(3)}
    failed = len(found) < 50 or 100 * len(inside) > 50 * len(found)
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), repeated_lines, len(inside), failed


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def test_measures_against_brute_force(spark, odd, rows):
    extra = corpora.documents(spark, [(20, "a b c a b c a b " * 30), (21, "x y\nx y\n#$% |<> &&\nx y")])
    result = quality.judge(odd.union(extra), quality.fit(odd, labels(spark)))
    source = [*corpora.odd_rows(), (20, "a b c a b c a b " * 30), (21, "x y\nx y\n#$% |<> &&\nx y")]
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows(result, *columns) == sorted(((i, *counted(t)) for i, t in source), key=repr)
    # Without labels the method rejects nothing.
    assert result.where("NOT base_failed AND NOT kept").count() == 0


def test_ratio_tells_junk_from_prose(spark):
    junk = lambda k: " ".join(f"{w}%%%" for w in corpora.words(k, 80).split())
    docs = [(k, corpora.words(1000 + k, 80) if k % 4 else junk(k)) for k in range(400)]
    known = [(k, int(k % 4 > 0), 0) for k in range(0, 400) if k % 10 < 6]
    frame = corpora.documents(spark, docs)
    model = quality.fit(frame, labels(spark, known))
    verdicts = {r.doc_id: r.kept for r in quality.judge(frame, model).collect()}
    unlabelled = [k for k in range(400) if k % 10 >= 6]
    assert np.mean([verdicts[k] == (k % 4 > 0) for k in unlabelled]) > 0.95
    kept = quality.keep_good(frame, model)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in verdicts.items() if v}
    assert quality.fit(frame, labels(spark, known)).threshold == model.threshold


def test_scores_are_mean_log_ratios(spark):
    docs = [(1, "the cat sat"), (2, "the dog sat"), (3, "zig zag")]
    model = quality.QualityModel(np.random.default_rng(0).normal(size=quality.BUCKETS), 0.0)
    hashes, counts = quality.word_hashes([t.encode() for _, t in docs])
    buckets, row = quality.grams(hashes, counts)
    expected = [np.mean(model.ratios[buckets[row == k]]) for k in range(3)]
    assert np.allclose(model.scores(hashes, counts), expected)


def test_least_loss():
    assert quality.least_loss(np.array([]), np.array([1.0])) == float("-inf")
    assert quality.least_loss(np.array([1.0, 2.0]), np.array([-1.0, 0.0])) == 0.5
    assert quality.least_loss(np.array([0.0, 2.0]), np.array([1.0])) == float("-inf")


def test_least_loss_of_any_number_of_scores(spark):
    rng = np.random.default_rng(3)
    for rounded, shift in ((1, 0.0), (3, 0.5), (9, 2.0)):
        good = rng.random(600) < 0.7
        scores = np.round(rng.normal(size=600) + shift * good, rounded)
        rows = [(bool(g), float(s)) for g, s in zip(good, scores, strict=True)]
        frame = spark.createDataFrame(rows, "good boolean, score double")
        assert quality.least_loss_of(frame) == quality.least_loss(scores[good], scores[~good])
        assert quality.least_loss_of(frame.where("NOT good")) == float("-inf")


def test_every_labelled_text_counts(spark):
    """More labels than the 20,000 that were sampled before."""
    docs = spark.range(30_000).selectExpr("id AS doc_id", "concat('w', id) AS text")
    known = spark.range(30_000).selectExpr("id AS doc_id", "1 AS quality")
    model = quality.fit(docs, known)
    used = spark.range(30_000).where("xxhash64(id, 1) % 2 = 0").selectExpr("concat('w', id) AS text").collect()
    hashes, counts = quality.word_hashes([row.text.encode() for row in used])
    target = np.bincount(quality.grams(hashes, counts)[0], minlength=quality.BUCKETS)
    hashes, counts = quality.word_hashes([f"w{k}".encode() for k in range(30_000)])
    corpus = np.bincount(quality.grams(hashes, counts)[0], minlength=quality.BUCKETS)
    assert np.allclose(model.ratios, quality.log_ratios(target, corpus))


def test_labels_beyond_a_broadcast(spark, monkeypatch):
    docs = [(k, corpora.words(k, 60)) for k in range(60)]
    known = [(k, int(k % 3 > 0), 0) for k in range(0, 60, 2)]
    frame = corpora.documents(spark, docs)
    small = quality.fit(frame, labels(spark, known))
    monkeypatch.setattr(quality, "held", lambda _: False)
    large = quality.fit(frame, labels(spark, known))
    assert large.threshold == small.threshold and np.array_equal(large.ratios, small.ratios)


def test_empty(spark, none):
    model = quality.fit(none, labels(spark))
    assert quality.judge(none, model).count() == 0
    assert quality.keep_good(none, model).count() == 0


RULES = [urls.Rule("allow", "com/"), urls.Rule("block", "example.com/en/"), urls.Rule("allow", "www.example.com/en/"), urls.Rule("block", "net/es/")]
URLS = [
    (1, "http://A.Example.COM/en/1?x=/fr/#y", "a.example.com", "/en/1", "example.com/en/"),
    (2, "https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/"),
    (3, "x://notexample.com/en/2", "notexample.com", "/en/2", "com/"),
    (4, "http://example.com", "example.com", "", None),
    (5, "http://b.net/es/#f", "b.net", "/es/", "net/es/"),
    (6, "b.net/es/", "", "", None),
    (7, None, "", "", None),
    (8, "http://a?b://c/d", "a", "", None),
    (9, "http://dotcom/", "dotcom", "/", None),
    (10, "://#", "", "", None),
    (10, "http://é.com/ü\n?q", "é.com", "/ü\n", "com/"),
]


def test_rules(spark, rows):
    pages = spark.createDataFrame([(i, u, "h") for i, u, *_ in URLS], "page_id long, url string, host string")
    result = urls.ruled(pages, RULES)
    assert rows(result, "page_id", "host", "path", "rule") == sorted(((i, h, p, r) for i, _, h, p, r in URLS), key=repr)
    known = result.where("rule IS NOT NULL").select("host", "path", result.rule_verdict.alias("verdict"))
    judged = urls.judge(result, urls.fit(known))
    assert judged.count() == len(URLS)
    by_name = {r.name: r.verdict for r in RULES}
    assert all(r.verdict == by_name[r.rule] for r in judged.collect() if r.rule)


def test_model_on_held_out_urls():
    rng = np.random.default_rng(1)
    hosts = [f"{corpora.words(k, 1)}.{'bad' if k % 2 else 'good'}.org" for k in range(600)]
    paths = [f"/{rng.integers(1000)}/x" for _ in hosts]
    block = np.arange(600) % 2 == 1
    model = urls.train(hosts[:400], paths[:400], block[:400])
    assert (model.block(hosts[400:], paths[400:]) == block[400:]).mean() > 0.97


def test_no_labels_and_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    parts = urls.ruled(pages, RULES)
    none = parts.where("false").selectExpr("host", "path", "'x' AS verdict")
    assert [r.verdict for r in urls.judge(parts, urls.fit(none)).collect()] == ["allow"]
    assert urls.judge(parts.where("false"), urls.fit(none)).count() == 0
