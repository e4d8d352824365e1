"""Token ids of whole texts by a public tokenizer, each distinct piece of text encoded once per worker.

Texts are cut where the tokenizer itself always cuts, so that every piece can be
encoded alone; ids of pieces already seen come from a bounded dictionary. A
Latin-1 piece not yet seen is split by the tokenizer's own pattern and its parts
go to the tokenizer's merge model; any other piece goes to the tokenizer. Texts
for which the cut isn't sure, those with a special token's string, and texts for
tokenizers of other kinds go to it whole.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from operator import attrgetter

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

PIECES_HELD = 350_000
# Where a cut before a space or line end isn't sure: white space on both sides of it, or a space at the end.
_SPACE = rb"[\t-\r\x1c- ]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
UNSURE = re.compile(rb" (?:%s|\Z)|(?:%s)\n" % (_SPACE, _SPACE))
# A quick look first: without two ASCII spaces in a row and these bytes, only a space at the end is unsure.
_FLAT = bytes.maketrans(b"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f", b" " * 9)
_WIDE = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
# The split patterns of the two kinds of tokenizer; the second matches no white space.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Keys that the first pattern splits in one way: a line end, Latin-1 letters, ASCII marks but the apostrophe.
PLAIN = re.compile(rb"(\n?)((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:-@\[-`{-~]*)").fullmatch
TOKEN_ID = attrgetter("id")


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself if it shows, else the next from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


def cut_at_spaces(text: bytes) -> list[bytes] | None:
    """Keys of pieces that a byte-level tokenizer splits alike alone and in the text; None if that isn't sure.

    A cut is before each space and each line end. The key has no leading space;
    the first piece, which has none in the text either, has one in its key.
    """
    if not text:
        return []
    doubtful = b"  " in text.translate(_FLAT) or text[-1:] == b" " or any(w in text for w in _WIDE)
    if doubtful and UNSURE.search(text):
        return None
    pieces = text.replace(b"\n", b" \n").split(b" ")
    pieces[0] = b" " + pieces[0]
    return pieces


def piece_text(key: bytes) -> str:
    if key[:1] == b" ":
        return key[1:].decode()
    return key.decode() if key[:1] == b"\n" else " " + key.decode()


class Held(dict):
    """Ids of pieces or parts; what is not held comes from the generation before, or is encoded."""

    def __init__(self, older: dict, encode: Callable) -> None:
        super().__init__()
        self.older, self.encode = older, encode

    def __missing__(self, piece: bytes | str) -> bytes:
        ids = dict.get(self.older, piece)
        self[piece] = ids = self.encode(piece) if ids is None else ids
        return ids

    def next(self) -> Held:
        """An empty generation after this one; the one before this is let go."""
        self.older = {}
        return Held(self, self.encode)


class PieceTokenizer:
    """Ids as little-endian unsigned 32-bit integers, in bytes."""

    def __init__(self, path: str, most_held: int = PIECES_HELD) -> None:
        from tokenizers import Tokenizer

        self.most_held = most_held
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.kind = _kind(spec)
        self.specials = [a["content"].encode() for a in spec.get("added_tokens", [])]
        if self.kind != "whole":
            self.split = regex.compile(WORD_SPLIT if self.kind == "words" else BYTE_SPLIT).findall
            self.model = self.tokenizer.model
            self.characters = byte_characters()
        self.held = Held({}, self._encode_piece)
        self.parts = Held({}, self._part)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        out = []
        for text in texts:
            pieces = self._cut(text)
            if pieces is None:
                out.append(self._whole(text))
                continue
            if len(self.held) > self.most_held:
                self.held = self.held.next()
            if len(self.parts) > self.most_held:
                self.parts = self.parts.next()
            out.append(b"".join(map(self.held.__getitem__, pieces)))
        return out

    def _cut(self, text: bytes) -> list[bytes] | None:
        """Keys of the pieces; None where the text must stay whole."""
        if self.kind == "whole" or any(s in text for s in self.specials):
            return None
        return text.split() if self.kind == "words" else cut_at_spaces(text)

    def _encode_piece(self, piece: bytes) -> bytes:
        plain = PLAIN(piece) if self.kind == "spaces" else None
        if plain:
            line, word, marks = plain.groups()
            ids = self.parts["\n"] + self.parts[word.decode()] if line else self.parts[" " + word.decode()]
            return ids + self.parts[marks.decode()] if marks else ids
        text = piece.decode() if self.kind == "words" else piece_text(piece)
        if not text.isascii() and max(text) > "\xff":
            return self._whole(text.encode())
        parts = self.split(text.lower() if self.kind == "words" else text)
        return b"".join(map(self.parts.__getitem__, parts))

    def _part(self, part: str) -> bytes:
        if part.isascii() and part.isprintable():  # only the space is shown as something else
            text = part.replace(" ", self.characters[32])
        else:
            text = "".join(map(self.characters.__getitem__, part.encode()))
        return array("I", map(TOKEN_ID, self.model.tokenize(text))).tobytes()

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32).tobytes()


def _kind(spec: dict) -> str:
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
        return "spaces"
    first = (before.get("pretokenizers") or [{}])[0]
    steps = [n.get("type") for n in (normal or {}).get("normalizers", [])]
    by_word = first.get("type") == "Split" and first.get("pattern") == {"Regex": WORD_SPLIT} and first.get("invert")
    if by_word and first.get("behavior") == "Removed" and set(steps) <= {"NFC", "Replace", "Lowercase"}:
        return "words"
    return "whole"


_LOADED: dict[str, PieceTokenizer] = {}


def tokenizer(path: str, most_held: int = PIECES_HELD) -> PieceTokenizer:
    """The worker's own, loaded once; it remembers as many pieces as its last user allows."""
    if path not in _LOADED:
        _LOADED[path] = PieceTokenizer(path, most_held)
    _LOADED[path].most_held = most_held
    return _LOADED[path]
