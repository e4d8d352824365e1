from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import corpora
import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import maxent, pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def plain_spans(text: str) -> list[tuple]:
    found = [(m.start(), "email", m.end()) for m in re.finditer(EMAIL, text)]
    for m in re.finditer(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append((m.start(), "ip", m.end()))
    for m in re.finditer(r"[0-9](?:[ -]?[0-9])+", text):
        digits = [int(c) for c in m.group() if c.isdigit()]
        total = sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), "card", m.end()))
    for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[1])))


def personal(n: int) -> list[str]:
    rng = np.random.default_rng(n)
    digit = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    out = []
    for k in range(n):
        card = digit(15)
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        pool = [
            f"a.b{digit(2)}@mail{digit(1)}.example.com", f"+1 ({digit(3)}) 555-{digit(4)}", card,
            ".".join(str(v) for v in rng.integers(0, 300, 4)), digit(16), "@", "x@y", "a@b@c.de", "a@b.c@d.e", "+", "1.2.3.4.5.6.7.8", "+1-2", "0000.1.1.1",
        ]
        chosen = rng.choice(len(pool), 3)
        out.append("é".join([corpora.words(k, 12), *(f" {pool[c]} " for c in chosen), corpora.words(k + 1, 5)]))
    return out


def test_base_spans_against_plain_patterns():
    for text in [*personal(300), *(t or "" for _, t in corpora.odd_rows()), "a@b.c@d.e", "@@a@b.c", "+" * 50 + "1", "1" * 5000]:
        assert pii.base_spans(text) == plain_spans(text), text


def test_gradients():
    rng = np.random.default_rng(0)
    model = pii.new_tagger(rng)
    codes, tags = rng.integers(0, pii.CLASSES, (6, 4)), rng.integers(0, 3, (6, 4))
    _, slopes = pii.loss_and_slopes(model, codes, tags)
    for weights, slope in zip(model.arrays(), slopes, strict=True):
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in weights.shape)
            kept, losses = weights[at], []
            for step in (1e-5, -1e-5):
                weights[at] = kept + step
                losses.append(pii.loss_and_slopes(model, codes, tags)[0])
            weights[at] = kept
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-5, abs=1e-6)


def test_decoder_takes_the_best_path():
    rng = np.random.default_rng(1)
    model = pii.new_tagger(rng)
    model.moves[:] = rng.normal(size=(3, 3))
    codes = rng.integers(0, pii.CLASSES, (5, 3))
    found = pii.Decoder(model).tags(codes.astype(np.uint8))
    paths = np.stack(np.meshgrid(*[range(3)] * 5, indexing="ij"), -1).reshape(-1, 5)
    for column in range(3):
        losses = [pii.loss_and_slopes(model, codes[:, [column]], p[:, None])[0] for p in paths]
        assert (paths[int(np.argmin(losses))] == found[:, column]).all()


@pytest.fixture(scope="module")
def decoder():
    windows, tags = pii.labelled_windows(personal(250))
    return pii.Decoder(pii.train(windows, tags))


def test_tagger_on_held_out_texts(decoder):
    texts = [f"{corpora.words(k, 60)} {v} {corpora.words(k + 1, 60)}" for k, v in enumerate(
        ["jo.k12@mail3.example.com", "+1 (415) 555-0100", "98.12.44.7", "4111111111111111"] * 10)]
    hits = 0
    for text, tags in zip(texts, pii.tag_texts(decoder, texts), strict=True):
        (start, _, end), = pii.base_spans(text)
        hits += tags[start:end].astype(bool).mean() > 0.8
    assert hits >= 32
    clean = [corpora.words(k, 200) for k in range(50)]
    assert not any(pii.tagged_spans(t, g, []) for t, g in zip(clean, pii.tag_texts(decoder, clean), strict=True))


def test_added_spans_touch_no_base_span_and_base_spans_stay(decoder):
    texts = personal(100)
    for text, (base, all_) in zip(texts, pii.spans_of(texts, decoder), strict=True):
        assert base == plain_spans(text)
        assert set(base) <= set(all_)
        assert all(e <= a or b <= s for s, _, e in set(all_) - set(base) for a, _, b in base)


def test_windows_are_reconciled(decoder):
    """A text of several windows is tagged as its middle parts are alone."""
    value = "jo.k12@mail3.example.com"
    for lead in (pii.WINDOW - pii.OVERLAP // 2 - 10, pii.WINDOW - 5, 3 * pii.WINDOW):
        text = corpora.words(7, 400)[:lead] + f" {value} " + corpora.words(8, 300)
        start = text.index(value)
        tags, = pii.tag_texts(decoder, [text])
        assert len(tags) == len(text)
        assert tags[start : start + len(value)].astype(bool).mean() > 0.7


def test_find_and_mask(odd, decoder, rows):
    result = pii.find(odd, decoder)
    expected = []
    for doc, text in corpora.odd_rows():
        base = plain_spans(text or "")
        shown = ",".join(f"{k}:{a}:{b}" for a, k, b in base)
        expected.append((doc, *(sum(k == kind for _, k, _ in base) for kind in pii.KINDS), hashlib.sha256(shown.encode()).hexdigest()))
    assert rows(result, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(expected, key=repr)
    hidden = pii.mask(odd, decoder, length_column="n")
    assert hidden.schema == odd.schema
    by_id = {r.doc_id: r for r in hidden.where("doc_id > 8").collect()}
    assert by_id[16].text.startswith("mail me at [EMAIL] or [PHONE], [IP] and [CARD].")
    assert by_id[16].n == len(by_id[16].text)
    assert by_id[14].text == corpora.words(3, 300)
    assert hidden.where("doc_id = 1").collect()[0].text is None


def test_nothing_personal(none, spark):
    assert pii.fit(none) is None
    assert pii.find(none, None).count() == 0
    docs = corpora.documents(spark, [(1, "clean text")])
    assert pii.fit(docs) is None
    assert pii.find(docs, None).collect()[0].spans == ""


def test_sample_holds_spans_whatever_else_the_texts_hold(spark):
    """Many numbers, few data: e-mails without digits, short addresses, and long texts."""
    years = [(k, f"{corpora.words(k, 20)} in {1900 + k % 100} order {100000 + k}") for k in range(900)]
    mails = [(1000 + k, f"{corpora.words(k, 20)} jo.doe@mail.example.org {corpora.words(k + 1, 5)}") for k in range(6)]
    addresses = [(2000 + k, f"{corpora.words(k, 20)} 10.0.0.{k} {corpora.words(k + 1, 5)}") for k in range(6)]
    long_ = [(3000, corpora.words(1, 5000) + " +1 (415) 555-0100 " + corpora.words(2, 5))]
    assert len(long_[0][1]) > 20000
    docs = corpora.documents(spark, [*years, *mails, *addresses, *long_]).withColumn("o", F.col("doc_id"))
    chosen = pii.sampled(docs)
    assert {i for i, _ in [*mails, *addresses, *long_]} <= chosen
    assert len(chosen) == 13 + pii.NUMBERED
    assert pii.fit(docs.where("doc_id < 900 OR doc_id = 3000")) is not None


def test_windows_tag_neighbours_and_bound_long_texts():
    text = "write to jo@mail.example.org or to ann@mail.example.org in 2019"
    windows, tags = pii.labelled_windows([text] * 20)
    assert len(windows) >= 60
    codes = pii.coded("@")[0]
    for window, tag in zip(windows, tags, strict=True):
        assert tag[window == codes].all()
    several = [t for t in tags if (t == pii.BEGIN).sum() == 2]
    assert several
    windows, _ = pii.labelled_windows(["jo@mail.example.org " * 5000])
    assert len(windows) <= 2 * pii.OF_A_KIND + 1


@pytest.mark.parametrize("value, kind", [
    ("0044 20 7946 0958", "phone"), ("4155550100", "phone"), ("(415) 555-0100", "phone"), ("123456", None), ("1234567890123456", None),
    ("10 . 0 . 0 . 1", "ip"), ("300 . 0 . 0 . 1", None), ("4111.1111.1111.1111", "card"), ("jo @ mail.example.org", "email"),
])
def test_tagged_stretches(value, kind):
    text = f"call {value} now"
    tags = np.zeros(len(text), np.uint8)
    tags[5 : 5 + len(value)] = pii.INSIDE
    assert pii.tagged_spans(text, tags, []) == ([(5, kind, 5 + len(value))] if kind else [])


def test_base_spans_are_cut_out_of_a_tagged_stretch():
    text = "415-555-0100 jo@mail.example.org 4155550101"
    base = pii.base_spans(text)
    assert [text[a:b] for a, _, b in base] == ["jo@mail.example.org"]
    added = pii.tagged_spans(text, np.full(len(text), pii.INSIDE, np.uint8), base)
    assert [(k, text[a:b]) for a, k, b in added] == [("phone", "415-555-0100"), ("phone", "4155550101")]
    nested = [(2, "card", 20), (4, "phone", 8)]
    assert list(pii._remainders(0, 30, nested)) == [(0, 2), (20, 30)]


def valued(n: int, seed: int) -> list[tuple]:
    """(kind, text before, value, text after): each kind of datum n times, and other numbers without a kind."""
    rng = np.random.default_rng(seed)
    digit = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    out = []
    for k in range(1000 * seed, 1000 * seed + n):
        card = digit(15)
        card += next(c for c in "0123456789" if pii.luhn(card + c))
        email = f"{corpora.words(k, 1)}.{corpora.words(k + 9, 1)}{digit(2)}@mail{digit(1)}.example.com"
        ip = ".".join(str(v) for v in rng.integers(0, 256, 4))
        values = [("email", email), ("ip", ip), ("card", card), ("phone", f"+1 ({digit(3)}) 555-{digit(4)}")]
        values += [(None, f"in {1900 + k % 100}"), (None, f"order {1 + k % 9}{digit(6)}"), (None, f"{digit(2)}.{digit(2)} of {digit(3)},000")]
        out += [(kind, corpora.words(3 * k, 20) + " ", v, " " + corpora.words(3 * k + 1, 20)) for kind, v in values]
    return out


def recall_and_false_spans() -> tuple[dict[str, int], int, int]:
    """Of 100 held-out rewritten spans a kind, those found whole; spans elsewhere; spans in 300 texts with other numbers."""
    model = pii.Decoder(pii.train(*pii.labelled_windows(["".join(r[1:]) for r in valued(100, 5)])))
    rng, rows = np.random.default_rng(1), valued(100, 77)
    rows = [(kind, b, pii.rewritten(v, kind, rng) if kind else v, a) for kind, b, v, a in rows]
    found, hits, beside, other = pii.spans_of([b + v + a for _, b, v, a in rows], model), dict.fromkeys(pii.KINDS, 0), 0, 0
    for (kind, before, value, _), (_, spans) in zip(rows, found, strict=True):
        start, end = len(before), len(before) + len(value)
        if kind is None:
            other += len(spans)
            continue
        hits[kind] += (start, kind, end) in spans
        beside += sum(b <= start or a >= end for a, _, b in spans)
    return hits, beside, other


def test_rewritten_spans_of_each_kind_are_found():
    hits, beside, other = recall_and_false_spans()
    assert min(hits.values()) >= 90
    assert beside + other <= 6


def held(doc) -> bool:
    return zlib.crc32(b"" if doc is None else str(doc).encode()) % 7 == 2


def tokens(text) -> list[bytes]:
    return [*(text or "").encode().lower().split(), b"\n"]


def base_of(rows):
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc, text in rows:
        score = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens(text))
        out.append((doc, held(doc), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, score))
    return out


@pytest.mark.parametrize("head", [maxent.HEAD_WORDS, 5])
def test_base_scores_against_brute_force(spark, odd, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD_WORDS", head)  # with a small head most counts are joined by key
    found = sorted(maxent.score(odd).collect(), key=lambda r: (repr(r.doc_id), r.n_tokens, r.base_score))
    brute = sorted(base_of(corpora.odd_rows()), key=lambda r: (repr(r[0]), r[2], r[5]))
    assert [tuple(r)[:5] for r in found] == [b[:5] for b in brute]
    assert [r.base_score for r in found] == pytest.approx([b[5] for b in brute])


def sequence_corpus(n: int) -> list[tuple]:
    """Two languages: the words before tell which words can follow."""
    rng = np.random.default_rng(0)
    tongues = [[corpora.words(7000 + 300 * s + k, 1) + str(s) for k in range(150)] for s in range(2)]
    return [(k, " ".join(tongues[k % 2][min(149, int(j))] for j in rng.zipf(1.4, 60) - 1)) for k in range(n)]


def test_model_beats_the_counts_on_held_out_texts(spark):
    docs = sequence_corpus(900)
    found = [r for r in maxent.score(corpora.documents(spark, docs).repartition(2)).collect() if r.held_out]
    assert len(found) > 80
    gain = sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found)
    assert gain > 0.05


def test_shares_are_a_distribution():
    rng = np.random.default_rng(3)
    weights = maxent.Weights(*(rng.normal(size=a.shape).astype(np.float32) for a in vars(maxent.Weights()).values()))
    class_rows = np.repeat(rng.integers(0, maxent.CLASS_ROWS, (4, 1)), maxent.BUCKETS, axis=1)
    bucket_rows = np.repeat(rng.integers(0, maxent.BUCKET_ROWS, (2, 1)), maxent.BUCKETS, axis=1)
    shares = maxent.log_shares(weights, class_rows, bucket_rows, np.arange(maxent.BUCKETS))
    assert np.exp(shares).sum() == pytest.approx(1, abs=1e-4)


def test_update_by_the_gradient_lowers_the_loss():
    rng = np.random.default_rng(6)
    hashes, counts = rng.integers(0, 50, 4000).astype(np.uint32), np.full(40, 100)
    class_rows, bucket_rows = maxent.features(hashes, counts)
    buckets = (class_rows[0] * 31) % maxent.BUCKETS  # the word before decides
    weights = maxent.Weights(bucket_bias=np.full((maxent.CLASSES, maxent.IN_CLASS), -math.log(maxent.IN_CLASS), np.float32))
    before = maxent.log_shares(weights, class_rows, bucket_rows, buckets).mean()
    held = maxent.CLASS_ROWS
    seen = np.zeros((held + maxent.BUCKET_ROWS * maxent.CLASSES, maxent.CLASSES), np.uint32)
    maxent.seen_together(hashes, counts, buckets, held, seen)
    assert seen.sum() == 4000 * (maxent.CLASS_KINDS + maxent.BUCKET_KINDS)
    new = maxent.updated(0, seen, weights, held)
    weights = maxent.Weights(new[:held], new[held:].reshape(-1, maxent.CLASSES, maxent.IN_CLASS), weights.class_bias, weights.bucket_bias)
    assert maxent.log_shares(weights, class_rows, bucket_rows, buckets).mean() > before + 1


def gain_of(scored) -> float:
    found = [r for r in scored.collect() if r.held_out]
    return sum(r.score - r.base_score for r in found) / sum(r.n_tokens for r in found)


def test_scores_do_not_depend_on_partitions(spark):
    docs = corpora.documents(spark, sequence_corpus(300) + corpora.odd_rows()[2:])
    few, many = (sorted((r.doc_id, r.n_tokens, r.score) for r in maxent.score(docs.repartition(n)).collect()) for n in (2, 20))
    assert [r[:2] for r in few] == [r[:2] for r in many]
    assert [r[2] for r in few] == pytest.approx([r[2] for r in many], rel=1e-9)


def test_gain_and_rows_grow_with_the_corpus(spark):
    assert [maxent.rows_for(n) for n in (0, 1 << 20, 1 << 28, 1 << 50)] == [1 << 14, 1 << 14, 1 << 16, maxent.MOST_ROWS]
    small, large = (gain_of(maxent.score(corpora.documents(spark, sequence_corpus(n)))) for n in (300, 3000))
    assert large > small + 0.05


def test_empty_corpus(none):
    assert maxent.score(none).count() == 0


def test_long_digit_runs_are_linear_and_equal_the_patterns():
    import random
    import time

    zeros = "0" * 5000 + ".0.0.0"
    assert pii.base_spans(zeros) == [(0, "ip", len(zeros))]
    started = time.monotonic()
    for text in ("7" * 1_000_000, "1." * 300_000, "0" * 1_000_000 + ".1.2", "+1" + "(" * 500_000, "a@" * 200_000):
        pii.base_spans(text)
    assert time.monotonic() - started < 30
    rng = random.Random(3)
    for _ in range(3000):
        text = "".join(rng.choice("0012.59.. a") for _ in range(rng.randint(0, 40)))
        plain = [(m.start(), "ip", m.end()) for m in pii.IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s for s in pii.base_spans(text) if s[1] == "ip"] == plain


def test_operator_stands_long_digit_runs(spark):
    texts = ["0" * 5000 + ".0.0.0", "7" * 300_000, "5." * 20_000]
    docs = corpora.documents(spark, list(enumerate(texts)))
    found = {r.doc_id: r for r in pii.find(docs, pii.fit(docs)).collect()}
    assert [found[k].n_ip for k in range(3)] == [1, 0, 5000]
