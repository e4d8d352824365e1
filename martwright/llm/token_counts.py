"""Token counts by rank-synchronous merging of arrays.

The pre-tokens of a batch are one ragged array of symbols. In every round each
pre-token applies its lowest-ranked pair, all of them at once; those without a
pair are done, and their symbols are counted. Only distinct pre-tokens are
merged, and counts of pieces already seen come from a bounded dictionary.

Null text counts as empty (no tokens). A special token's string inside a text is
one token, as the tokenizer takes it by default. Repeated rows are counted each
for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from martwright.llm.common import mapped, picked, ragged, sliced
from martwright.llm.tokenizing import BYTE_SPLIT, byte_characters, cut_at_spaces, piece_text

COUNTS_HELD = 400_000
LIMIT = 1024
NO_PAIR = np.iinfo(np.int32).max


class RankMerger:
    """The merges of a byte-level vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec["pre_tokenizer"]
        if before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level vocabulary")
        vocabulary = spec["model"]["vocab"]
        self.bytes = np.array([vocabulary[c] for _, c in sorted(byte_characters().items())], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.specials = [a["content"] for a in spec["added_tokens"]]
        self.split = regex.compile(BYTE_SPLIT).findall
        self.cut_specials = regex.compile("|".join(map(regex.escape, self.specials))).split if self.specials else None
        self.held: dict[bytes, int] = {}
        self.parts: dict[str, int] = {}

    def merged_lengths(self, pretokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        left = lengths.copy()
        _, row = ragged(lengths)
        symbols = self.bytes[np.frombuffer(b"".join(pretokens), np.uint8)]
        while len(symbols) > 1:
            pair = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            rank = np.where((self.keys[at] == pair) & (row[:-1] == row[1:]), self.ranks[at], NO_PAIR)
            begins = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            lowest = np.minimum.reduceat(np.r_[rank, NO_PAIR], begins)
            lowest = np.repeat(lowest, np.diff(np.r_[begins, len(row)]))
            hits = np.flatnonzero((rank == lowest[:-1]) & (rank < NO_PAIR))
            if not len(hits):
                break
            # Overlapping hits of one pair (a run of one symbol): every other one, from the left.
            run = np.r_[True, np.diff(hits) > 1]
            hits = hits[(hits - np.maximum.accumulate(np.where(run, hits, 0))) % 2 == 0]
            symbols[hits] = self.merged[rank[hits]]
            np.subtract.at(left, row[hits], 1)
            keep = lowest < NO_PAIR  # the others are done
            keep[hits + 1] = False
            symbols, row = symbols[keep], row[keep]
        return left

    def counts(self, texts: list[bytes]) -> list[int]:
        cut = [self._cut(t) for t in texts]
        seen = set(chain.from_iterable(c for c in cut if isinstance(c, list)))
        new = [p for p in seen if p not in self.held]
        if len(self.held) + len(new) > COUNTS_HELD:
            self.held = {p: self.held[p] for p in seen if p in self.held}
        if len(self.parts) > COUNTS_HELD:
            self.parts = {}
        split = {p: self.split(piece_text(p)) for p in new}
        whole = {k: self._segments(t.decode()) for k, (t, c) in enumerate(zip(texts, cut, strict=True)) if c is None}
        wanted = set(chain.from_iterable(split.values())).union(chain.from_iterable(parts for parts, _ in whole.values()))
        fresh = [p for p in wanted if p not in self.parts]
        if fresh:
            self.parts.update(zip(fresh, self.merged_lengths([p.encode() for p in fresh]).tolist(), strict=True))
        part, held = self.parts.__getitem__, self.held.__getitem__
        self.held.update((p, sum(map(part, parts))) for p, parts in split.items())
        return [
            sum(map(held, c)) if c is not None else sum(map(part, whole[k][0])) + whole[k][1]
            for k, c in enumerate(cut)
        ]

    def _cut(self, text: bytes) -> list[bytes] | None:
        """Pieces that are split alike alone and in the text; None if that isn't sure."""
        return None if any(s.encode() in text for s in self.specials) else cut_at_spaces(text)

    def _segments(self, text: str) -> tuple[list[str], int]:
        segments = self.cut_specials(text) if self.cut_specials else [text]
        return [p for s in segments for p in self.split(s)], len(segments) - 1


_LOADED: dict[str, RankMerger] = {}


def count_tokens(
    docs: DataFrame, vocabulary_path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every document."""
    source = picked(docs, doc_id=id_column, text=text_column)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary_path not in _LOADED:
            _LOADED[vocabulary_path] = RankMerger(vocabulary_path)
        for batch, texts in sliced(batches):
            n = np.array(_LOADED[vocabulary_path].counts(texts), np.int64)
            sizes = np.fromiter(map(len, texts), np.int64, len(texts))
            columns = [batch.column("doc_id"), *map(pa.array, (sizes, n, n > limit))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = source.schema["doc_id"].dataType.simpleString()
    return mapped(source, counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
