"""Personal data: exact base patterns, and a character tagger beside them.

Base spans (e-mail, IP address, card and phone number) are found by rule. The
tagger is a character-level bidirectional LSTM with CRF transitions over the
tags outside, begin and inside. It is trained here, in numpy, on labelled spans:
windows around the base spans of a bounded sample of documents (``LABELLED``)
that hold one, by the rules themselves, each kind in turn; plus windows around
other numbers and places of theirs, and of ``NUMBERED`` documents that hold
numbers but no span. From texts of any length, up to ``OF_A_KIND`` spans of each
kind are taken. A part of the spans is written in other ways that the rules miss
but that mean the same. A whole text is cut into overlapping windows;
windows of a batch are tagged side by side, and each character takes its tag
from the window in which it lies furthest from an edge. Base spans are cut out
of a tagged stretch; what remains is added if it holds an at sign, or passes the
checks of a number of its kind: four parts of an address, checksum of a card, or
7 to 15 digits of a phone number, grouped or not.

Positions are in code points, ends exclusive. Null text counts as empty: no
spans. Repeated rows are searched each for itself; an empty table gives an empty
result. If the sample holds no span, the tagger adds none.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import mapped, picked, sliced, written

KINDS = ("email", "ip", "card", "phone")
LABELLED = 400
NUMBERED = 100
OF_A_KIND = 8
HIDDEN = 8
WINDOW = 256
OVERLAP = 48
TRAINED_WINDOW = 64
STEPS = 600
BATCH = 64
RATE = 0.02
SEED = 9
MIN_DIGITS, MAX_DIGITS = 7, 15
OUTSIDE, BEGIN, INSIDE = 0, 1, 2

LOCAL = re.compile(r"[A-Za-z0-9._%+-]*\Z")
# The base patterns of the contract.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")
# What addresses are found in: a run of numbers joined by dots, taken whole, so that no digit is tried twice.
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
SPACED_IP = re.compile(r"[0-9]+(\s*\.\s*[0-9]+){3}")
LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, str, int]  # start, kind, end


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from left to right; only the characters around an at sign can be one."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARACTERS:
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
            free = match.end()
        at = text.find("@", max(at + 1, free))


def _addresses(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``IP``, parts at most 255: of a run of numbers the first four, then the next four."""
    for run in NUMBERS.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts, start = run.group().split("."), run.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in four):
                yield start, end
            start = end + 1


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    if "@" in text:
        found += [(a, "email", b) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        found += [(a, "ip", b) for a, b in _addresses(text)]
        for m in CARD.finditer(text):
            digits = NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), "card", m.end()))
        for m in PHONE.finditer(text):
            if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15:
                found.append((m.start(), "phone", m.end()))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[1])))


def shown(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def character_codes() -> np.ndarray:
    """Class of each code point up to 255; all above share one. Letters of a case share a class."""
    codes = np.full(257, 1, np.uint8)
    for k in range(256):
        c = chr(k)
        if c.isdigit() and k < 128:
            codes[k] = 2
        elif c.isspace():
            codes[k] = 3
        elif c.isalpha():
            codes[k] = 4 if c.islower() else 5
    for k, c in enumerate("@.+-()_%:/,#=\"'|*$&!"):
        codes[ord(c)] = 6 + k
    codes[256] = 4
    return codes


CODES = character_codes()
CLASSES = int(CODES.max()) + 1


def coded(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return CODES[np.minimum(points, 256)]


@dataclass
class Tagger:
    """Weights: per direction input rows (classes, 4H), recurrent (H, 4H); emissions (2H, 3); transitions (3, 3)."""

    inputs: np.ndarray
    recurrent: np.ndarray
    out: np.ndarray
    bias: np.ndarray
    moves: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.out, self.bias, self.moves]


def new_tagger(rng: np.random.Generator) -> Tagger:
    inputs = rng.normal(0, 0.5, (2, CLASSES, 4 * HIDDEN))
    inputs[:, :, HIDDEN : 2 * HIDDEN] += 1.0  # remember at first
    recurrent = rng.normal(0, 0.4, (2, HIDDEN, 4 * HIDDEN))
    return Tagger(inputs, recurrent, rng.normal(0, 0.5, (2 * HIDDEN, 3)), np.zeros(3), np.zeros((3, 3)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(codes: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) of one direction, and what the backward pass needs. ``codes`` is (T, B)."""
    n = codes.shape[1]
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    states, kept = np.zeros((len(codes), n, HIDDEN)), []
    for t in range(len(codes)):
        gates = inputs[codes[t]] + h @ recurrent
        i, f, o = (_sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(gates[:, 3 * HIDDEN :])
        before, h_before = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        states[t] = h
        kept.append((i, f, o, g, before, squashed, h_before))
    return states, kept


def _run_back(codes, recurrent, kept, slope, inputs_slope, recurrent_slope) -> None:
    """Adds this direction's gradients, given those of its hidden states."""
    dh, dc = np.zeros(slope.shape[1:]), np.zeros(slope.shape[1:])
    fed = np.empty((*codes.shape, recurrent.shape[1]))
    for t in range(len(codes) - 1, -1, -1):
        i, f, o, g, before, squashed, h_before = kept[t]
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - squashed**2)
        gates = np.concatenate(
            [dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1
        )
        fed[t] = gates
        recurrent_slope += h_before.T @ gates
        dh, dc = gates @ recurrent.T, dc * f
    of_class = np.arange(CLASSES)[:, None] == codes.ravel()
    inputs_slope += of_class.astype(np.float64) @ fed.reshape(-1, fed.shape[2])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def loss_and_slopes(model: Tagger, codes: np.ndarray, tags: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tags (T, B) under the CRF, and its gradients."""
    steps, n = codes.shape
    forward, kept = _run(codes, model.inputs[0], model.recurrent[0])
    backward, kept_back = _run(codes[::-1], model.inputs[1], model.recurrent[1])
    hidden = np.concatenate([forward, backward[::-1]], axis=2)
    scores = hidden @ model.out + model.bias
    alpha, beta = np.zeros_like(scores), np.zeros_like(scores)
    alpha[0] = scores[0]
    for t in range(1, steps):
        alpha[t] = scores[t] + _log_sum(alpha[t - 1][:, :, None] + model.moves, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(model.moves + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _log_sum(alpha[-1], 1)
    columns = np.arange(n)
    path = sum(scores[t, columns, tags[t]] for t in range(steps))
    path = path + sum(model.moves[tags[t - 1], tags[t]] for t in range(1, steps))
    slope = np.exp(alpha + beta - total[None, :, None])
    for t in range(steps):
        slope[t, columns, tags[t]] -= 1
    slope /= n
    moves = np.zeros((3, 3))
    for t in range(1, steps):
        joint = alpha[t - 1][:, :, None] + model.moves + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
        moves += np.exp(joint).sum(axis=0)
        np.add.at(moves, (tags[t - 1], tags[t]), -1)
    back = slope @ model.out.T
    inputs, recurrent = np.zeros_like(model.inputs), np.zeros_like(model.recurrent)
    _run_back(codes, model.recurrent[0], kept, back[:, :, :HIDDEN], inputs[0], recurrent[0])
    _run_back(codes[::-1], model.recurrent[1], kept_back, back[::-1, :, HIDDEN:], inputs[1], recurrent[1])
    out = np.einsum("tbh,tbk->hk", hidden, slope)
    return float((total - path).mean()), [inputs, recurrent, out, slope.sum(axis=(0, 1)), moves / n]


def train(windows: np.ndarray, tags: np.ndarray) -> Tagger:
    """Adam over random batches of (N, T) labelled windows; the same windows give the same model."""
    rng = np.random.default_rng(SEED)
    model = new_tagger(rng)
    first, second = [np.zeros_like(a) for a in model.arrays()], [np.zeros_like(a) for a in model.arrays()]
    for step in range(1, STEPS + 1):
        chosen = rng.integers(0, len(windows), BATCH)
        _, slopes = loss_and_slopes(model, windows[chosen].T, tags[chosen].T)
        norm = np.sqrt(sum(float((s**2).sum()) for s in slopes))
        for weights, slope, m, v in zip(model.arrays(), slopes, first, second, strict=True):
            slope = slope * min(1.0, 5.0 / max(norm, 1e-9))
            m += 0.1 * (slope - m)
            v += 0.01 * (slope**2 - v)
            weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def rewritten(value: str, kind: str, rng: np.random.Generator) -> str:
    """The same datum in a way that the rules don't take."""
    if kind == "email":
        return value.replace("@", " @ ")
    if kind == "phone":
        digits = NO_DIGIT.sub("", value)[-10:]
        return f"({digits[:3]}) {digits[3:6]}-{digits[6:]}" if rng.random() < 0.5 else f"{digits[:3]}-{digits[3:6]}-{digits[6:]}"
    if kind == "card":
        digits = NO_DIGIT.sub("", value)
        return ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return value.replace(".", " . ")


def _regions(spans: list[Span]) -> list[tuple[int, str | None, int]]:
    """Stretches that spans cover; the kind is None where spans overlap."""
    out: list[tuple[int, str | None, int]] = []
    for start, kind, end in spans:
        if out and start < out[-1][2]:
            out[-1] = (out[-1][0], None, max(end, out[-1][2]))
        else:
            out.append((start, kind, end))
    return out


def windows_of(text: str, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, tags) of windows around the text's spans, some of them rewritten, and around other places."""
    spans = base_spans(text)
    regions = _regions(spans)
    chosen = []
    for kind in (*KINDS, None):
        own = [r for r in regions if r[1] == kind]
        chosen += [own[k] for k in sorted(rng.permutation(len(own))[:OF_A_KIND].tolist())]
    starts = np.array([a for a, _, _ in regions], np.int64)
    numbers = np.array([m.start() for m in re.finditer("[0-9]+", text)], np.int64)
    if len(numbers) and len(regions):
        last = np.searchsorted(starts, numbers, side="right") - 1
        numbers = numbers[(last < 0) | (numbers >= np.array([b for _, _, b in regions])[last])]
    for k in range(1 + len(chosen)):
        at = int(rng.integers(0, len(text) + 1))
        if len(numbers) and k % 2 == 0:
            at = int(numbers[rng.integers(0, len(numbers))])
        if not any(a < at < b for a, _, b in regions):
            chosen.append((at, None, at))
    for start, kind, end in chosen:
        value = text[start:end]
        if kind and rng.random() < 0.4:
            value = rewritten(value, kind, rng)
        room = int(rng.integers(4, max(5, TRAINED_WINDOW - len(value) - 3)))
        before = text[max(0, start - room) : start].rjust(room)
        after = text[end : end + TRAINED_WINDOW].ljust(TRAINED_WINDOW)
        tags = np.zeros(TRAINED_WINDOW, np.int64)
        first = max(0, int(np.searchsorted(starts, start - room, side="right")) - 1)
        for a, _, b in regions[first:]:  # the span itself and its neighbours
            if a >= end + TRAINED_WINDOW:
                break
            moved = len(value) - (end - start)
            low = room + a - start + (moved if a >= end and a > start else 0)
            high = room + b - start + (moved if b >= end and b > start else 0)
            if high > 0:
                tags[max(0, low) : high] = INSIDE
                if 0 <= low < TRAINED_WINDOW:
                    tags[low] = BEGIN
        yield coded((before + value + after)[:TRAINED_WINDOW]), tags


def labelled_windows(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the texts with their tags."""
    rng = np.random.default_rng(SEED)
    found = [pair for text in texts for pair in windows_of(text, rng)]
    windows, tags = [w for w, _ in found], [t for _, t in found]
    return np.array(windows, np.uint8).reshape(-1, TRAINED_WINDOW), np.array(tags, np.int64).reshape(-1, TRAINED_WINDOW)


class Decoder:
    """The tagger's weights laid out for tagging: single precision, gates scaled for one tanh."""

    def __init__(self, model: Tagger) -> None:
        scale = np.ones(4 * HIDDEN)
        scale[: 3 * HIDDEN] = 0.5
        self.inputs = (model.inputs * scale).astype(np.float32)
        self.recurrent = (model.recurrent * scale).astype(np.float32)
        self.out, self.bias = model.out.astype(np.float32), model.bias.astype(np.float32)
        self.moves = model.moves.astype(np.float32)

    def _states(self, codes: np.ndarray, side: int) -> np.ndarray:
        """Emission scores (T, 3, B) of one direction; arrays are (features, B) so that all work runs along B."""
        inputs = np.ascontiguousarray(self.inputs[side].T)
        recurrent = np.ascontiguousarray(self.recurrent[side].T)
        out = np.ascontiguousarray(self.out[side * HIDDEN : (side + 1) * HIDDEN].T)
        n = codes.shape[1]
        h, c = np.zeros((HIDDEN, n), np.float32), np.zeros((HIDDEN, n), np.float32)
        scores = np.empty((len(codes), 3, n), np.float32)
        gates, fed = np.empty((4 * HIDDEN, n), np.float32), np.empty((4 * HIDDEN, n), np.float32)
        half = np.float32(0.5)
        for t in range(len(codes)) if side == 0 else range(len(codes) - 1, -1, -1):
            np.matmul(recurrent, h, out=gates)
            np.take(inputs, codes[t], axis=1, out=fed, mode="clip")
            gates += fed
            np.tanh(gates, out=gates)
            soft = gates[: 3 * HIDDEN]
            soft *= half
            soft += half
            c *= gates[HIDDEN : 2 * HIDDEN]
            c += gates[:HIDDEN] * gates[3 * HIDDEN :]
            np.tanh(c, out=h)
            h *= gates[2 * HIDDEN : 3 * HIDDEN]
            np.matmul(out, h, out=scores[t])
        return scores

    def tags(self, codes: np.ndarray) -> np.ndarray:
        """Best tags (T, B) of the windows ``codes`` (T, B)."""
        scores = self._states(codes, 0)
        scores += self._states(codes, 1)
        scores += self.bias[:, None]
        steps, n = codes.shape
        back = np.empty((steps, 3, n), np.uint8)
        best = scores[0]
        for t in range(1, steps):
            new = np.empty_like(best)
            for tag in range(3):
                a, b, c = (best[k] + self.moves[k, tag] for k in range(3))
                top = np.maximum(a, b)
                from_ = (b > a).view(np.uint8).copy()
                from_[c > top] = 2
                np.maximum(top, c, out=top)
                back[t, tag] = from_
                new[tag] = top + scores[t, tag]
            best = new
        tags = np.empty((steps, n), np.uint8)
        tags[-1] = best.argmax(axis=0)
        columns = np.arange(n)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][tags[t], columns]
        return tags


def tag_texts(decoder: Decoder, texts: list[str], batch: int = 2048) -> list[np.ndarray]:
    """A tag per character of each text, reconciled over its windows."""
    codes = [coded(t) for t in texts]
    stride = WINDOW - OVERLAP
    counts = np.array([0 if not len(c) else 1 + max(0, -(-(len(c) - WINDOW) // stride)) for c in codes], np.int64)
    room = np.where(counts > 0, (counts - 1) * stride + WINDOW, 0)
    base = np.cumsum(room) - room
    flat = np.full(int(room.sum()), CODES[32], np.uint8)
    for c, b in zip(codes, base.tolist(), strict=True):
        flat[b : b + len(c)] = c
    starts = np.concatenate([b + stride * np.arange(n) for b, n in zip(base.tolist(), counts.tolist(), strict=True)] or [np.zeros(0, np.int64)])
    first = np.concatenate([np.arange(n) == 0 for n in counts.tolist()] or [np.zeros(0, bool)])
    tags = np.zeros(len(flat), np.uint8)
    reach = np.arange(WINDOW)
    for k in range(0, len(starts), batch):
        at = starts[k : k + batch].astype(np.int64)[None, :] + reach[:, None]
        found = decoder.tags(np.ascontiguousarray(flat[at]))
        # A character takes its tag from the window in which it lies further from an edge:
        # the later window of two is read from the middle of the overlap on.
        own = first[k : k + batch][None, :] | (reach[:, None] >= OVERLAP // 2)
        tags[at[own]] = found[own]
    return [tags[b : b + len(c)] for c, b in zip(codes, base.tolist(), strict=True)]


def _kind(value: str) -> str | None:
    """What a tagged stretch is, if it can be: numbers must pass the checks that their kind has."""
    if "@" in value.strip("@"):
        return "email"
    groups = re.findall("[0-9]+", value)
    digits = "".join(groups)
    if len(groups) == 4 and SPACED_IP.fullmatch(value) and all(len(g) <= 3 and int(g) <= 255 for g in groups):
        return "ip"
    if 2 * len(digits) < len(value):
        return None
    if 12 <= len(digits) <= 19 and luhn(digits):
        return "card"
    return "phone" if MIN_DIGITS <= len(digits) <= MAX_DIGITS else None


def _remainders(start: int, end: int, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """What is left of a stretch once the base spans, sorted by start, are cut out."""
    for a, _, b in taken:
        if a >= end:
            break
        if b > start:
            if a > start:
                yield start, a
            start = b
    yield start, end


def tagged_spans(text: str, tags: np.ndarray, taken: list[Span]) -> list[Span]:
    """Tagged spans that look like a datum, outside the base spans."""
    found = []
    inside = np.flatnonzero(tags)
    if not len(inside):
        return []
    heads = inside[np.r_[True, (np.diff(inside) > 1) | (tags[inside[1:]] == BEGIN)]]
    for k, head in enumerate(heads.tolist()):
        limit = int(heads[k + 1]) if k + 1 < len(heads) else len(text)
        tail = head + 1
        while tail < limit and tags[tail]:
            tail += 1
        for start, end in _remainders(head, tail, taken):
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while end > start and not text[end - 1].isalnum():
                end -= 1
            kind = _kind(text[start:end])
            if kind:
                found.append((start, kind, end))
    return found


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(o, place) of each kind of base span that a text holds; the last place is of texts with numbers only."""
    for batch, raw in sliced(batches):
        orders, places = [], []
        for o, t in zip(batch.column("o").to_pylist(), raw, strict=True):
            held = {KINDS.index(kind) for _, kind, _ in base_spans(t.decode())}
            if not held and re.search(rb"[0-9]{3}", t):
                held = {len(KINDS)}
            orders += [o] * len(held)
            places += sorted(held)
        yield pa.RecordBatch.from_arrays([pa.array(orders, pa.int64()), pa.array(places, pa.int64())], names=["o", "place"])


def _windowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, raw in sliced(batches):
        for o, t in zip(batch.column("o").to_pylist(), raw, strict=True):
            found = list(windows_of(t.decode(), np.random.default_rng([SEED, o & (2**63 - 1)])))
            codes = b"".join(c.tobytes() for c, _ in found)
            tags = b"".join(g.astype(np.uint8).tobytes() for _, g in found)
            yield pa.RecordBatch.from_arrays([pa.array([o]), pa.array([codes]), pa.array([tags])], names=["o", "codes", "tags"])


def sampled(texts: DataFrame) -> set[int]:
    """Orders of the documents to learn from: in hash order, each kind of span in turn, and some with numbers only."""
    held = written(mapped(texts.select("o", "text"), _held, "o long, place long"), "held-kinds")
    first = [
        [r.o for r in held.where(F.col("place") == place).select("o").distinct().orderBy("o").limit(most).collect()]
        for place, most in enumerate([LABELLED] * len(KINDS) + [NUMBERED])
    ]
    chosen: dict[int, None] = {}
    for turn in zip_longest(*first[:-1]):
        for o in turn:
            if o is not None and len(chosen) < LABELLED:
                chosen[o] = None
    return {*chosen, *first[-1]} if chosen else set()


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> Decoder | None:
    """A tagger from at most ``LABELLED`` documents that hold a base span, and ``NUMBERED`` with other numbers."""
    texts = picked(docs, doc_id=id_column, text=text_column)
    texts = texts.withColumn("o", F.xxhash64(F.col("doc_id").cast("string"), "text"))
    chosen = sampled(texts)
    if not chosen:
        return None
    sample = texts.where(F.col("o").isin(*chosen)).select("o", "text").dropDuplicates(["o"])
    # Windows alone leave the tasks, a bounded number of each text.
    rows = sorted(mapped(sample, _windowed, "o long, codes binary, tags binary").collect(), key=lambda r: r.o)
    windows = np.frombuffer(b"".join(r.codes for r in rows), np.uint8).reshape(-1, TRAINED_WINDOW)
    tags = np.frombuffer(b"".join(r.tags for r in rows), np.uint8).reshape(-1, TRAINED_WINDOW)
    return Decoder(train(windows, tags.astype(np.int64)))


def spans_of(texts: list[str], decoder: Decoder | None) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if decoder is None:
        return [(b, b) for b in base]
    tags = tag_texts(decoder, texts)
    order = lambda s: (s[0], KINDS.index(s[1]))
    return [(b, sorted([*b, *tagged_spans(t, g, b)], key=order)) for t, g, b in zip(texts, tags, base, strict=True)]


def find(docs: DataFrame, decoder: Decoder | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, counts of base spans by kind, the digest of the base spans, and all spans, of every document."""
    source = picked(docs, doc_id=id_column, text=text_column)
    names = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in sliced(batches):
            found = spans_of([t.decode() for t in raw], decoder)
            counts = [[sum(k == kind for _, k, _ in base) for base, _ in found] for kind in KINDS]
            digests = [hashlib.sha256(shown(base).encode()).hexdigest() for base, _ in found]
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests), pa.array([shown(s) for _, s in found], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return mapped(source, searched, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {FOUND}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping ones, the first."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        elif end > at:
            at = end
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, decoder: Decoder | None, text_column: str = "text", length_column: str | None = None) -> DataFrame:
    """``docs`` with every span masked, and ``length_column``, if given, set to the new number of code points."""

    def hidden(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw in sliced(batches, text_column):
            texts = [t.decode() for t in raw]
            clean = [masked(t, spans) for t, (_, spans) in zip(texts, spans_of(texts, decoder), strict=True)]
            present = batch.column(text_column).is_valid().to_pylist()
            new = {text_column: [c if p else None for c, p in zip(clean, present, strict=True)]}
            if length_column:
                new[length_column] = [len(c) if p else None for c, p in zip(clean, present, strict=True)]
            columns = [pa.array(new[f.name], f.type) if f.name in new else batch.column(f.name) for f in batch.schema]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return mapped(docs, hidden, docs.schema)
