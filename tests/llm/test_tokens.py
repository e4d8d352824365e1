from __future__ import annotations

import random
import zlib

import corpora
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from martwright.llm import packing, pieces, token_counts, token_files
from martwright.llm.tokenizing import PieceTokenizer

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def strange(n: int) -> list[str]:
    rng = random.Random(n)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\u00a0", "\u3000", "\u2009", "a", "Word", "'s", "don't", "12", "½", "é", "é", "日本", "🙂", "ß", "İ", "ſ", "…",
             "|", "%%%", "<|endoftext|>", "<s>", "\x1c", "\x00", "x.", "y,\nZ", "ª", "\x85"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_give_the_ids_of_whole_texts(path):
    texts = [*strange(400), *(t or "" for _, t in corpora.odd_rows())]
    library, own = Tokenizer.from_file(path), PieceTokenizer(path)
    for found, text in zip(own.encode([t.encode() for t in texts]), texts, strict=True):
        assert np.frombuffer(found, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_plain_pieces_are_not_split_by_the_pattern():
    text = "Eauenê ciónillar,\nÜber thanstti,*** {x} ×y ÷z it's don't"
    library, own = Tokenizer.from_file(BYTES), PieceTokenizer(BYTES)
    split, searched = own.split, []
    own.split = lambda piece: searched.append(piece) or split(piece)
    found = own.encode([text.encode()])[0]
    assert np.frombuffer(found, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids
    assert {" it's", " don't", " ×y", " ÷z"} <= set(searched)
    assert not {" ciónillar,", "\nÜber", " thanstti,***"} & set(searched)


def test_token_counts_against_the_library(odd, rows):
    library = Tokenizer.from_file(BYTES)
    size = lambda t: len(library.encode(t or "", add_special_tokens=False).ids)
    merger = token_counts.RankMerger(BYTES)
    texts = strange(400)
    assert merger.counts([t.encode() for t in texts]) == [size(t) for t in texts]
    expected = sorted(((i, len((t or "").encode()), size(t), size(t) > 1024) for i, t in corpora.odd_rows()), key=repr)
    assert rows(token_counts.count_tokens(odd, BYTES)) == expected


def test_piece_encoding_against_the_library(odd, spark):
    import sentencepiece

    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.PieceModel(PIECES)
    texts = [*strange(300), "▁▁ x▁y", "   many      spaces  ", "ha" * 900, "日本語テキスト" * 100]
    for found, text in zip(model.encode([t.encode() for t in texts]), texts, strict=True):
        assert np.frombuffer(found, np.uint32).tolist() == library.encode(text), repr(text)
    encoded = pieces.encode_pieces(odd, PIECES)
    decoded = {(r.doc_id, r.text) for r in pieces.decode_pieces(encoded, PIECES).collect()}
    assert decoded == {(i, t or "") for i, t in corpora.odd_rows()}
    assert pieces.piece_digests(odd, PIECES).where("NOT round_trip").count() == 0


def test_suffix_ranges_against_search():
    model = pieces.PieceModel(PIECES)
    text = np.frombuffer("▁the▁there▁other▁" .encode() * 3, np.uint8)
    order, eight = model.suffixes(text)
    first, last = model.ranges(order, eight)
    raw = text.tobytes()
    for piece, a, b in list(zip(model.ids.tolist(), first.tolist(), last.tolist(), strict=True)):
        shown = model.shown[piece]
        if b > a or shown in raw:
            assert sorted(order[a:b]) == [k for k in range(len(raw)) if raw.startswith(shown, k)]


@pytest.mark.parametrize("sizes", [[1], [5, 0, 64, 65], [3000, 40_000, 2]])
def test_coding_round_trip(sizes):
    rng = np.random.default_rng(len(sizes))
    blocks = [np.minimum(rng.zipf(1.3, n), 49_999).astype(np.uint32) for n in sizes if n]
    counts = np.bincount(np.concatenate(blocks), minlength=50_000)
    table = token_files.quantized(counts)
    assert table.frequency.sum() == 1 << token_files.SCALE
    assert ((table.frequency > 0) == (counts > 0)).all()
    rows = [
        {"payload": p, "states": s, "checkpoints": c, "lanes": token_files.LANES, "every": token_files.EVERY, "n_tokens": len(b)}
        for b, (p, s, c) in zip(blocks, token_files.encode_blocks(blocks, table), strict=True)
    ]
    for block, found in zip(blocks, token_files.decode_blocks(rows, table), strict=True):
        assert (block == found).all()
    if sizes[-1] == 2:
        assert any(r["checkpoints"] for r in rows)


def test_one_symbol_only():
    block = np.full(1000, 7, np.uint32)
    table = token_files.quantized(np.bincount(block))
    (payload, states, marks), = token_files.encode_blocks([block], table)
    row = {"payload": payload, "states": states, "checkpoints": marks, "lanes": token_files.LANES, "every": token_files.EVERY, "n_tokens": 1000}
    assert not payload
    assert (token_files.decode_blocks([row], table)[0] == 7).all()


def ids_of(path: str, text: str | None, end: int) -> np.ndarray:
    return np.array([*Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids, end], np.uint32)


def test_token_files(odd, spark, tmp_path):
    path = token_files.write_token_files(odd, BYTES, 0, str(tmp_path / "tokens"))
    found = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    source = sorted(corpora.odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in found] == [i for i, _ in source]
    at = 0
    for row in found:
        assert row.start == at
        assert row.n_tokens == len(row.ids) // 4
        assert row.ids_crc32 == zlib.crc32(row.ids)
        at += row.n_tokens
    expected = sorted((repr(i), ids_of(BYTES, t, 0).tobytes()) for i, t in source)
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in found) == expected


def test_damaged_block_is_noticed(odd, spark, tmp_path):
    path = token_files.write_token_files(odd.where("doc_id IN (14, 15)"), BYTES, 0, str(tmp_path / "tokens"))
    block = spark.read.parquet(f"{path}/blocks").collect()[0].asDict()
    payload = bytearray(block["payload"])
    payload[len(payload) // 2] ^= 1
    block["payload"] = bytes(payload)
    with pytest.raises((ValueError, IndexError)):
        token_files._documents([block], token_files.read_table(spark, path), ["doc_id"])


def test_every_flipped_bit_of_a_block_is_noticed():
    rng = np.random.default_rng(5)
    ids = [rng.integers(0, 50, n).astype(np.uint32) for n in (1, 40, token_files.LANES * (token_files.EVERY * 2 + 3) + 5)]
    table = token_files.quantized(np.bincount(np.concatenate(ids), minlength=50))
    whole = [
        {"first": 7, "payload": p, "states": s, "checkpoints": c, "n_tokens": len(i), "lanes": token_files.LANES, "every": token_files.EVERY}
        for i, (p, s, c) in zip(ids, token_files.encode_blocks(ids, table), strict=True)
    ]
    assert all((a == b).all() for a, b in zip(token_files.decode_blocks(whole, table), ids, strict=True))
    for part in ("payload", "states", "checkpoints"):
        size = len(whole[2][part])
        for bit in sorted(set(rng.integers(0, 8 * size, 150).tolist()) | {0, 8 * size - 1}):
            damaged = bytearray(whole[2][part])
            damaged[bit // 8] ^= 1 << bit % 8
            with pytest.raises((ValueError, IndexError, OverflowError)):
                token_files.decode_blocks([whole[0], whole[2] | {part: bytes(damaged)}, whole[1]], table)


def test_best_fit_against_a_plain_search():
    rng = np.random.default_rng(4)
    for window in (16, 100, 2048):
        lengths = rng.integers(1, window + 1, 500)
        into, offset, used = packing.best_fit_decreasing(lengths, window)
        rooms: list[int] = []
        for k in np.argsort(-lengths, kind="stable"):
            fits = [r for r in rooms if r >= lengths[k]]
            if fits:
                rooms[rooms.index(min(fits))] -= lengths[k]
            else:
                rooms.append(window - lengths[k])
        assert used == len(rooms)
        assert sorted(window - np.bincount(into, weights=lengths)) == sorted(rooms)
        for w in range(used):
            mine = sorted(zip(offset[into == w], lengths[into == w], strict=True))
            assert all(a + n == b for (a, n), (b, _) in zip(mine, mine[1:], strict=False))
            assert mine[0][0] == 0


def test_packing(odd):
    pieces_ = packing.pack(odd, WORDS, 1, window=64)
    rows = pieces_.collect()
    by_window: dict[int, list] = {}
    for row in rows:
        by_window.setdefault(row.sequence_id, []).append(row)
    for mine in by_window.values():
        at = 0
        for row in sorted(mine, key=lambda r: r.offset):
            assert row.offset == at
            at += row.length
        assert at <= 64
    joined = sorted(bytes(r.ids) for r in packing.sequences(pieces_).collect())
    assert joined == sorted(b"".join(bytes(r.ids) for r in sorted(m, key=lambda r: r.offset)) for m in by_window.values())
    total = sum(len(ids_of(WORDS, t, 1)) for _, t in corpora.odd_rows())
    assert sum(r.length for r in rows) == total
    for doc in (11, 14, 16, None):
        texts = [t for i, t in corpora.odd_rows() if i == doc]
        mine = sorted((r for r in rows if r.doc_id == doc), key=lambda r: (r.doc_tokens, r.start))
        whole = b"".join(ids_of(WORDS, t, 1).tobytes() for t in sorted(texts, key=lambda t: len(ids_of(WORDS, t, 1))))
        assert b"".join(bytes(r.ids) for r in mine) == whole
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and r.length == len(r.ids) // 4 for r in mine)


def test_empty(none, spark, tmp_path):
    assert token_counts.count_tokens(none, BYTES).count() == 0
    assert pieces.piece_digests(none, PIECES).count() == 0
    assert packing.pack(none, WORDS, 1).count() == 0
    path = token_files.write_token_files(none, BYTES, 0, str(tmp_path / "tokens"))
    assert token_files.read_token_files(spark, path).count() == 0
