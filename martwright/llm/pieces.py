"""Encoding to and decoding from the pieces of a public BPE piece model.

A batch's distinct stretches of text (a run of spaces and what follows it; no
piece reaches over its end) are laid end to end and indexed by a suffix array.
Every piece of the vocabulary is looked up in it by binary search; its range
gives all its occurrences, the edges. Edges are sorted by position and relaxed:
in each round every stretch takes, of the edges that join two of its present
symbols, the one of best score (the leftmost of equals). What no piece covers
falls back to bytes. Ids of stretches already seen come from a bounded
dictionary.

Null text counts as empty (no ids). Repeated rows are encoded each for itself;
an empty table gives an empty result. Decoding gives the text back, except for
what the model can't tell: it takes bytes that are no UTF-8 as U+FFFD.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martwright.llm.common import mapped, picked, ragged, sliced

STRETCHES_HELD = 300_000
INDEX_BYTES = 2 << 20
LONG = 256  # symbols; longer stretches are relaxed one by one, with a heap
SPACE = "▁".encode()
STRETCH = re.compile(rb"(?:%s)*(?:(?!%s)[\x00-\xff])*" % (SPACE, SPACE))


class PieceModel:
    """Pieces, scores and byte ids of a model file; only BPE models without normalisation rules."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, kinds = model.normalizer_spec, type(model.pieces[0])
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("only BPE models without normalisation are supported")
        self.dummy = SPACE if norm.add_dummy_prefix else b""
        self.unknown = model.trainer_spec.unk_id
        self.bytes = np.full(256, self.unknown, np.int64)
        self.shown = [p.piece.encode() for p in model.pieces]
        pieces = []
        for k, p in enumerate(model.pieces):
            if p.type == kinds.BYTE:
                value = int(p.piece[1:-1], 16)
                self.bytes[value], self.shown[k] = k, bytes([value])
            elif p.type == kinds.NORMAL:
                pieces.append((p.piece.encode(), k, p.score))
            elif p.type in (kinds.USER_DEFINED, kinds.UNUSED):
                raise ValueError("user-defined and unused pieces are not supported")
            else:
                self.shown[k] = b""
        if any(re.search(rb"(?!%s)[\x00-\x7f\xc0-\xff][\x80-\xbf]*%s" % (SPACE, SPACE), p) for p, _, _ in pieces):
            raise ValueError("a piece reaches over a space")
        pieces.sort()
        self.ids = np.array([k for _, k, _ in pieces])
        self.scores = np.array([s for _, _, s in pieces])
        self.sizes = np.array([len(p) for p, _, _ in pieces])
        self.words = -(-int(self.sizes.max()) // 8)
        padded = b"".join(p.ljust(8 * self.words, b"\0") for p, _, _ in pieces)
        filled = b"".join((b"\xff" * len(p)).ljust(8 * self.words, b"\0") for p, _, _ in pieces)
        as_words = lambda raw: np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, self.words)
        self.keys, self.masks = as_words(padded), as_words(filled)
        self.held: dict[bytes, bytes] = {}

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers."""
        cut = [STRETCH.findall(self.dummy + t.replace(b" ", SPACE))[:-1] if t else [] for t in texts]
        seen = set(chain.from_iterable(cut))
        new = sorted(s for s in seen if s not in self.held)
        if len(self.held) + len(new) > STRETCHES_HELD:
            self.held = {s: self.held[s] for s in seen if s in self.held}
        start = held = 0
        for k, stretch in enumerate(new):
            held += len(stretch) + 1
            if held > INDEX_BYTES or k == len(new) - 1:
                part = new[start : k + 1]
                self.held.update(zip(part, self._encoded(part), strict=True))
                start, held = k + 1, 0
        ids = self.held.__getitem__
        return [b"".join(map(ids, c)) for c in cut]

    def decode(self, ids: np.ndarray) -> bytes:
        shown = self.shown
        text = b"".join([shown[i] for i in ids.tolist()]).replace(SPACE, b" ")
        return text[1:] if self.dummy and text[:1] == b" " else text

    def suffixes(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in order of what follows them (as far as the longest piece), and 8 bytes from each as a number."""
        n, reach = len(text), 8 * self.words
        wide = np.r_[text, np.zeros(reach + 8, np.uint8)].astype(np.uint64)
        eight = np.zeros(n + reach, np.uint64)
        for k in range(8):
            eight |= wide[k : k + n + reach] << np.uint64(56 - 8 * k)
        known, rank = 8, _ranks(eight[:n])
        while known < reach and rank.max() < n - 1:
            after = np.r_[rank[known:] + 1, np.zeros(min(known, n), np.int64)][:n]
            rank = _ranks(rank.astype(np.uint64) << np.uint64(32) | after.astype(np.uint64))
            known *= 2
        return np.argsort(rank, kind="stable"), eight

    def ranges(self, order: np.ndarray, eight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's occurrences begin and end in the suffix array, by binary search."""
        found = []
        for past in (False, True):
            low, high = np.zeros(len(self.ids), np.int64), np.full(len(self.ids), len(order))
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                at, undecided = order[middle], np.ones(len(open_), bool)
                before = np.zeros(len(open_), bool)
                for w in range(self.words):
                    value = eight[at + 8 * w] & self.masks[open_, w]
                    before |= undecided & (value < self.keys[open_, w])
                    undecided &= value == self.keys[open_, w]
                    if not undecided.any():
                        break
                before |= undecided & past
                low[open_[before]] = middle[before] + 1
                high[open_[~before]] = middle[~before]
            found.append(low)
        return found[0], found[1]

    def _encoded(self, stretches: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches))
        text = np.frombuffer(b"\0".join([*stretches, b""]), np.uint8)  # no piece holds a zero byte
        starts, owner = ragged(sizes + 1)
        order, eight = self.suffixes(text)
        first, last = self.ranges(order, eight)
        counts = last - first
        base, piece = ragged(counts)
        position = order[first[piece] + np.arange(len(piece)) - base[piece]]
        ordered = np.argsort(position, kind="stable")
        position, piece = position[ordered], piece[ordered]
        symbol = (text & 0xC0) != 0x80  # a symbol begins here
        self._relax(symbol, owner, position, position + self.sizes[piece], piece, starts, sizes)
        return self._ids(text, symbol, owner, position, piece, starts, sizes)

    def _relax(self, symbol, owner, begin, end, piece, starts, sizes) -> None:
        """Joins symbols (in place): afterwards ``symbol`` marks where the final ones begin."""
        total = np.r_[0, np.cumsum(symbol)]
        spans = total[starts + sizes] - total[starts]
        for k in np.flatnonzero(spans > LONG).tolist():
            a, b = np.searchsorted(begin, [starts[k], starts[k] + sizes[k]])
            _relax_long(symbol, begin[a:b], end[a:b], self.scores[piece[a:b]], int(starts[k]), int(starts[k] + sizes[k]))
        live = np.flatnonzero((spans <= LONG)[owner[begin]])
        begin, end, score = begin[live], end[live], self.scores[piece[live]]
        while len(begin):
            total = np.r_[0, np.cumsum(symbol)]
            joined = total[end] - total[begin]
            possible = symbol[begin] & symbol[end] & (joined > 1)
            begin, end, score, joined = begin[possible], end[possible], score[possible], joined[possible]
            ready = np.flatnonzero(joined == 2)
            if not len(ready):
                return
            mine = owner[begin[ready]]
            groups = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
            best = np.repeat(np.maximum.reduceat(score[ready], groups), np.diff(np.r_[groups, len(ready)]))
            tops = ready[score[ready] == best]
            one = np.r_[True, np.diff(owner[begin[tops]]) != 0]
            chosen = tops[one]
            inner = np.searchsorted(total, total[begin[chosen]] + 2) - 1  # where its second symbol begins
            symbol[inner] = False
            going = np.zeros(len(starts), bool)
            going[mine] = True
            keep = going[owner[begin]]
            begin, end, score = begin[keep], end[keep], score[keep]

    def _ids(self, text, symbol, owner, position, piece, starts, sizes) -> list[bytes]:
        heads = np.flatnonzero(symbol)
        tails = np.r_[heads[1:], len(text)]
        ids = np.full(len(text), -1, np.int64)
        after = np.full(len(text) + 1, -1, np.int64)
        after[heads] = tails
        whole = after[position] == position + self.sizes[piece]
        ids[position[whole]] = self.ids[piece[whole]]
        bare = np.flatnonzero(symbol & (ids < 0))
        width = after[bare] - bare
        base, row = ragged(width)
        loose = bare[row] + np.arange(len(row)) - base[row]
        ids[loose] = self.bytes[text[loose]]
        inside = np.ones(len(text), bool)
        inside[starts + sizes] = False
        chosen = np.flatnonzero(inside & (ids >= 0))
        raw = ids[chosen].astype(np.uint32).tobytes()
        ends = np.searchsorted(chosen, starts + sizes).tolist()
        begins = np.searchsorted(chosen, starts).tolist()
        return [raw[4 * a : 4 * b] for a, b in zip(begins, ends, strict=True)]


def _ranks(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.cumsum(np.r_[0, ranked[1:] != ranked[:-1]])
    return rank


def _relax_long(symbol, begin, end, score, start: int, stop: int) -> None:
    """One long stretch: the same order of joins, from a heap of the edges at hand."""
    edges = {(b, e): s for b, e, s in zip(begin.tolist(), end.tolist(), score.tolist(), strict=True)}
    heads = (start + np.flatnonzero(symbol[start:stop])).tolist()
    following = dict(zip(heads, [*heads[1:], stop], strict=True))
    previous = dict(zip([*heads[1:], stop], heads, strict=True))
    heap: list[tuple] = []

    def offer(a: int | None) -> None:
        if a is None or (middle := following[a]) == stop:
            return
        if (a, following[middle]) in edges:
            heapq.heappush(heap, (-edges[a, following[middle]], a, middle, following[middle]))

    for head in heads:
        offer(head)
    while heap:
        _, a, middle, b = heapq.heappop(heap)
        if following.get(a) != middle or following.get(middle) != b:
            continue
        symbol[middle] = False
        del following[middle]
        following[a], previous[b] = b, a
        offer(a)
        offer(previous.get(a))


_LOADED: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def encode_pieces(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every document."""
    source = picked(docs, doc_id=id_column, text=text_column)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            ids = pa.array(piece_model(model_path).encode(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return mapped(source, encoded, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text that the ids stand for."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, ids in sliced(batches, "ids"):
            model = piece_model(model_path)
            texts = [model.decode(np.frombuffer(raw, np.uint32)).decode(errors="replace") for raw in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return mapped(encoded.select("doc_id", "ids"), decoded, f"doc_id {kind}, text string")


def piece_digests(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids_crc32, and whether decoding the ids gives the text back."""
    import zlib

    source = picked(docs, doc_id=id_column, text=text_column)
    names = ["doc_id", "n_bytes", "n_tokens", "ids_crc32", "round_trip"]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in sliced(batches):
            model = piece_model(model_path)
            ids = model.encode(texts)
            same = [model.decode(np.frombuffer(raw, np.uint32)) == t for raw, t in zip(ids, texts, strict=True)]
            columns = ([len(t) for t in texts], [len(i) // 4 for i in ids], [zlib.crc32(i) for i in ids])
            arrays = [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), pa.array(same)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    kind = source.schema["doc_id"].dataType.simpleString()
    return mapped(source, digested, f"doc_id {kind}, n_bytes long, n_tokens long, ids_crc32 long, round_trip boolean")
