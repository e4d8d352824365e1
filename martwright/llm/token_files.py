"""Token ids in entropy-coded files: a static range asymmetric numeral system.

Format, version 1. A folder holds ``tables`` (symbol, frequency; the frequencies
add up to 2^SCALE and are shared by all blocks) and ``blocks``, one row per
block of whole documents, in ascending document order: ``first`` (ids before the
block), ``doc_ids`` and ``doc_tokens`` of its documents, ``n_tokens``, ``lanes``,
``payload`` (32-bit words), ``states`` (one 64-bit state a lane), ``checkpoints``
(every ``every`` steps the lanes' states and the number of words not yet read)
and ``ids_crc32``. All numbers are little-endian. A block is coded by itself:
id k belongs to lane k mod lanes, step k div lanes. Decoding may begin at any
checkpoint, so segments of all blocks are decoded side by side; then each block
is held against its checksum.

Both are Parquet, so they are committed whole, and read and written through
whatever store Spark uses. Null text counts as empty: one end id. Null ids come
first. Repeated rows are written each for itself, rows with equal ids in order
of their tokens. An empty table gives empty files and an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.llm.common import mapped, partitions_for, picked, shared_path, sliced
from martwright.llm.tokenizing import tokenizer

VERSION = 1
SCALE = 20
LOW = np.uint64(1 << 32)
WORD = np.uint64(32)
LANES = 64
BLOCK_TOKENS = 1 << 16
EVERY = 256
BATCH_TOKENS = 1 << 21
DOCS_A_PART = 16_384
# Twice the packing operator's number: the worker holds little else here.
PIECES_HELD = 700_000
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Table:
    """Frequencies by symbol; they add up to 2^SCALE."""

    frequency: np.ndarray

    @property
    def below(self) -> np.ndarray:
        return np.cumsum(self.frequency) - self.frequency

    @property
    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))


def quantized(counts: np.ndarray) -> Table:
    """At least 1 for every symbol seen; what rounding leaves is taken from or given to the commonest."""
    counts, total = np.asarray(counts, np.int64), 1 << SCALE
    seen = np.flatnonzero(counts)
    if len(seen) > total:
        raise ValueError(f"{len(seen)} symbols don't fit in 2^{SCALE}")
    frequency = np.zeros(len(counts), np.int64)
    if len(seen):
        frequency[seen] = np.maximum(1, counts[seen] * total // counts.sum())
        order = seen[np.lexsort((seen, -counts[seen]))]
        surplus = int(frequency.sum()) - total
        if surplus < 0:
            frequency[order[0]] -= surplus
        while surplus > 0:
            for symbol in order:
                taken = min(surplus, max(0, int(frequency[symbol]) // 2), int(frequency[symbol]) - 1)
                frequency[symbol] -= taken
                surplus -= taken
                if not surplus:
                    break
    return Table(frequency.astype(np.uint64))


def encode_blocks(blocks: list[np.ndarray], table: Table) -> list[tuple[bytes, bytes, bytes]]:
    """(payload, states, checkpoints) of each block; all are coded side by side."""
    sizes = np.array([len(b) for b in blocks], np.int64)
    steps = int(-(-sizes.max() // LANES))
    # After a block's end stands a symbol that has the whole range: coding it changes no state.
    unit, shift = np.uint64(1 << SCALE), np.uint64(64 - SCALE)
    frequencies, below = np.append(table.frequency, unit), np.append(table.below, np.uint64(0))
    gaps = unit - frequencies
    ids = np.full((len(blocks), steps * LANES), len(frequencies) - 1, np.int32)
    for k, block in enumerate(blocks):
        ids[k, : len(block)] = block
    ids = np.ascontiguousarray(ids.reshape(len(blocks), steps, LANES).swapaxes(0, 1))
    state = np.full((len(blocks), LANES), LOW, np.uint64)
    words, owners = [], []
    emitted = np.zeros(len(blocks), np.int64)
    marks: list[list[tuple[int, bytes]]] = [[] for _ in blocks]
    for step in range(steps - 1, -1, -1):
        symbols = ids[step]
        frequency = frequencies[symbols]
        full = (state >> shift) >= frequency
        owner, lane = np.nonzero(full)
        if len(owner):
            over = state[owner, lane]
            words.append(over.astype(np.uint32))
            owners.append(owner)
            emitted += np.bincount(owner, minlength=len(blocks))
            state[owner, lane] = over >> WORD
        state += (state // frequency) * gaps[symbols] + below[symbols]
        if step and step % EVERY == 0:
            for k in np.flatnonzero(sizes > step * LANES):
                marks[k].append((int(emitted[k]), state[k].tobytes()))
    flat = np.concatenate(words) if words else np.zeros(0, np.uint32)
    owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
    flat = flat[np.argsort(owner, kind="stable")]
    ends = np.cumsum(emitted)
    return [
        (
            flat[end - n : end].tobytes(),
            state[k].tobytes(),
            b"".join(np.int64(at).tobytes() + raw for at, raw in reversed(marks[k])),
        )
        for k, (n, end) in enumerate(zip(emitted.tolist(), ends.tolist(), strict=True))
    ]


def decode_blocks(blocks: list[dict], table: Table) -> list[np.ndarray]:
    """Ids of each block; every segment between checkpoints is decoded side by side.

    Each must end in the states and at the word where the next one begins, and a
    block's last one in the states that coding began with, or the block is damaged.
    """
    streams = [np.frombuffer(b["payload"], np.uint32) for b in blocks]
    bases = np.cumsum([0, *map(len, streams)])
    flat = np.concatenate([*streams, np.zeros(1, np.uint32)]).astype(np.uint64)
    lanes, every = blocks[0]["lanes"], blocks[0]["every"]
    owner, begin, at, states = [], [], [], []
    for k, block in enumerate(blocks):
        size = 8 + 8 * lanes
        cuts = [block["checkpoints"][i : i + size] for i in range(0, len(block["checkpoints"]), size)]
        starts = [(len(streams[k]), block["states"])] + [(int(np.frombuffer(c[:8], np.int64)[0]), c[8:]) for c in cuts]
        for segment, (words, raw) in enumerate(starts):
            owner.append(k)
            begin.append(segment * every)
            at.append(bases[k] + words)
            states.append(np.frombuffer(raw, np.uint64))
    owner, begin, at = np.array(owner), np.array(begin), np.array(at)
    sizes = np.array([b["n_tokens"] for b in blocks])
    state, below, symbols = np.stack(states), table.below, table.symbols
    low_bits, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    out = [np.zeros(-(-n // lanes) * lanes, np.uint32) for n in sizes.tolist()]
    steps = np.minimum(every, -(-sizes[owner] // lanes) - begin)
    decoded = np.zeros((int(steps.max()), len(owner), lanes), np.uint32)
    lane = np.arange(lanes)
    first_states, first_words = state.copy(), at.copy()
    end_states, end_words = np.empty_like(state), np.empty_like(at)
    left = np.minimum(sizes[owner] - begin * lanes, steps * lanes)  # symbols of each segment
    for step in range(len(decoded)):
        ending = np.flatnonzero(steps == step + 1)
        before = state[ending]
        slot = state & low_bits
        symbol = symbols[slot.astype(np.int64)]
        decoded[step] = symbol
        state >>= shift
        state *= table.frequency[symbol]
        state += slot - below[symbol]
        # Past its end a segment decodes on without meaning, but reads nothing more.
        segment, which = np.nonzero((state < LOW) & (step * lanes + lane[None, :] < left[:, None]))
        taken = np.bincount(segment, minlength=len(owner))
        at -= taken
        place = at[segment] + np.arange(len(segment)) - (np.cumsum(taken) - taken)[segment]
        state[segment, which] = (state[segment, which] << WORD) | flat[place]
        if len(ending):
            # What stands after a block's end has changed no state.
            inside = step * lanes + lane[None, :] < left[ending][:, None]
            end_states[ending], end_words[ending] = np.where(inside, state[ending], before), at[ending]
    last = np.append(owner[1:] != owner[:-1], True)
    wanted_states = np.where(last[:, None], LOW, np.roll(first_states, -1, axis=0))
    wanted_words = np.where(last, bases[owner], np.roll(first_words, -1))
    damaged = (end_states != wanted_states).any(axis=1) | (end_words != wanted_words)
    if damaged.any():
        raise ValueError(f"block at {blocks[owner[damaged.argmax()]]['first']} is damaged")
    for k in range(len(owner)):
        part = decoded[: steps[k], k].ravel()
        out[owner[k]][begin[k] * lanes : begin[k] * lanes + len(part)] = part
    return [o[:n] for o, n in zip(out, sizes.tolist(), strict=True)]


BLOCKS = (
    "version int, first long, doc_ids array<long>, doc_tokens array<long>, n_tokens long, lanes int, every int, "
    "payload binary, states binary, checkpoints binary, ids_crc32 long"
)
BLOCK_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
ORDERED = "part int, doc_id long, before long, n_tokens long, ids binary"


def _stored(raw: bytes) -> bytes:
    """Ids in 16 bits where they fit, after a byte that tells the width."""
    ids = np.frombuffer(raw, np.uint32)
    return b"\x02" + ids.astype(np.uint16).tobytes() if len(ids) and ids.max() < 1 << 16 else b"\x04" + raw


def _ids(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[1:], np.uint16 if raw[0] == 2 else np.uint32)


def _tokenized(path: str, end_id: int, bounds: np.ndarray):
    end = np.uint32(end_id).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path, PIECES_HELD)
        for batch, texts in sliced(batches):
            doc = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, doc, side="right").astype(np.int32)
            ids = pa.array([_stored(x + end) for x in encoder.encode(texts)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(part), batch.column("doc_id"), ids], names=["part", "doc_id", "ids"])

    return encode


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each document's number of ids, and the ids before it in its part."""
    part, before = None, 0
    for batch in batches:
        starts, sizes = [], []
        for p, raw in zip(batch.column("part").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if p != part:
                part, before = p, 0
            sizes.append((len(raw) - 1) // raw[0])
            starts.append(before)
            before += sizes[-1]
        columns = [batch.column("part"), batch.column("doc_id"), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), batch.column("ids")]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "before", "n_tokens", "ids"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(0, np.int64)
    for batch in batches:
        if batch.num_rows:
            new = np.bincount(np.concatenate([_ids(r) for r in batch.column("ids").to_pylist()]))
            if len(new) > len(counts):
                counts, new = new, counts
            counts[: len(new)] += new
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["symbol", "n"])


def _coded(table: Table):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        block: tuple | None = None
        follows = -1

        def rows() -> pa.RecordBatch:
            ids = [np.concatenate(b[3]).astype(np.uint32) for b in waiting]
            coded = encode_blocks(ids, table)
            columns = zip(*(
                (VERSION, b[0], b[1], b[2], len(i), LANES, EVERY, *c, zlib.crc32(i.tobytes()))
                for b, i, c in zip(waiting, ids, coded, strict=True)
            ), strict=True)
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=BLOCK_NAMES)

        for batch in batches:
            for doc, first, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "first", "ids")), strict=True):
                ids = _ids(raw)
                size = sum(block[2]) if block else 0
                if block and (first != follows or size + len(ids) > BLOCK_TOKENS):
                    waiting.append(block)
                    block = None
                    if sum(sum(b[2]) for b in waiting) >= BATCH_TOKENS:
                        yield rows()
                block = block or (first, [], [], [])
                block[1].append(doc)
                block[2].append(len(ids))
                block[3].append(ids)
                follows = first + len(ids)
        if block:
            waiting.append(block)
        if waiting:
            yield rows()

    return code


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> str:
    """Tokenize every text, append ``end_id``, and write the folder ``path``."""
    spark = docs.sparkSession
    source = picked(docs, doc_id=id_column, text=text_column).withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = partitions_for(source, source.count(), DOCS_A_PART)
    shares = [k / parts for k in range(1, parts)]
    found = source.select("doc_id").na.drop().approxQuantile("doc_id", shares, 0.25 / parts) if shares else []
    bounds = np.unique(np.array(found, np.float64).astype(np.int64))
    coded = mapped(source, _tokenized(tokenizer_path, end_id, bounds), "part int, doc_id long, ids binary")
    dealt = coded.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id", "ids")
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")  # its shuffle files go once the ordered ids are written
    staged = shared_path(spark, "ordered-ids")
    try:
        mapped(dealt, _numbered, ORDERED).write.option("compression", "zstd").parquet(staged)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    ordered = spark.read.schema(ORDERED).parquet(staged)
    counts = mapped(ordered.select("ids"), _counted, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    totals = np.zeros(max((r.symbol for r in counts), default=0) + 1, np.int64)
    for row in counts:  # at most one for each token of the vocabulary
        totals[row.symbol] = row.n
    table = quantized(totals)
    seen = np.flatnonzero(table.frequency)
    rows = [(int(s), int(table.frequency[s])) for s in seen]
    spark.createDataFrame(rows, "symbol long, frequency long").coalesce(1).write.parquet(f"{path}/tables")
    # One row for each part of DOCS_A_PART documents.
    starts = ordered.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("base")
    )
    placed = ordered.join(F.broadcast(starts), "part").select("doc_id", (F.col("base") + F.col("before")).alias("first"), "ids")
    mapped(placed, _coded(table), BLOCKS).write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    return path


def read_table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/tables").collect()
    frequency = np.zeros(max((r.symbol for r in rows), default=0) + 1, np.uint64)
    for row in rows:
        frequency[row.symbol] = row.frequency
    return Table(frequency)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32, and its ids (32-bit) if asked for."""
    table = read_table(spark, path)
    names = ["doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, group, held = batch.to_pylist(), [], 0
            for row in rows:
                if row["version"] != VERSION:
                    raise ValueError(f"format version {row['version']}")
                group.append(row)
                held += row["n_tokens"]
                if held >= BATCH_TOKENS or row is rows[-1]:
                    yield _documents(group, table, names)
                    group, held = [], 0

    types = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return mapped(blocks, read, types)


def _documents(blocks: list[dict], table: Table, names: list[str]) -> pa.RecordBatch:
    rows = []
    for block, ids in zip(blocks, decode_blocks(blocks, table), strict=True):
        if zlib.crc32(ids.tobytes()) != block["ids_crc32"]:
            raise ValueError(f"block at {block['first']} doesn't match its checksum")
        at = 0
        for doc, n in zip(block["doc_ids"], block["doc_tokens"], strict=True):
            raw = ids[at : at + n].tobytes()
            rows.append((doc, block["first"] + at, n, zlib.crc32(raw), raw))
            at += n
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)][: len(names)], names=names)
