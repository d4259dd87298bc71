"""Packing of token rows into sequences: vector bin packing by the dot-product heuristic.

An example has three demands: tokens, one segment, and loss-bearing tokens. A sequence has a limit
on each. Sequences are filled one after another: of the examples that still fit in every limit,
the one with the largest dot product of (demand, room left), both as shares of the limits, goes
next. Examples of equal demand are interchangeable, so the choice is over the distinct demands that
are left, as one NumPy product. Demands longer than a sequence are cut beforehand into whole
sequences and a rest; a gap of at least ``least_cut`` tokens that no example fits is filled with
the front of one, the remainder staying in the pool. The last sequence of a pool, which nothing is
left to fill, is cut at powers of two, lengths that need no padding.

Packing is local to a bounded pool: each task packs its own rows, ``pool_tokens`` at a time, where
they lie. Nothing is shuffled, no task sees more than its input split, and a lost task is run again
with the same result. ``sequence_id`` is the partition's number and a running number in it.

Defined results: a null text counts as empty and has the closing id alone; rows with equal or null
``doc_id`` are packed one by one like any others; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.llm.tokens import fast_tokenizer


@dataclass(frozen=True)
class PackingLimits:
    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048
    least_cut: int = 8
    pool_tokens: int = 2_000_000
    end_id: int = 1


def cut_long(lengths: np.ndarray, losses: np.ndarray, limits: PackingLimits) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (example, start) such that none exceeds a limit by itself.

    ``losses`` counts the loss-bearing tokens of each example, which are its last ones.
    """
    most = min(limits.tokens, limits.loss_tokens)
    n = -(-lengths // most)
    example = np.repeat(np.arange(len(lengths)), n)
    start = (np.arange(len(example)) - np.repeat(np.cumsum(n) - n, n)) * most
    return example, start


def pack_pool(lengths: np.ndarray, losses: np.ndarray, limits: PackingLimits) -> list[list[tuple[int, int, int]]]:
    """Sequences as lists of (example, start, length); each token of each example lies in exactly one."""
    limit = np.array([limits.tokens, limits.segments, limits.loss_tokens], float)
    most = min(limits.tokens, limits.loss_tokens)
    sequences: list[list[tuple[int, int, int]]] = []
    pool: dict[tuple[int, int], list[tuple[int, int]]] = {}

    def put(example: int, start: int, length: int) -> None:
        # The loss-bearing tokens are the example's last ones; a piece has those that lie in it.
        unmasked = int(lengths[example] - losses[example])
        loss = min(length, max(0, start + length - unmasked))
        pool.setdefault((length, loss), []).append((example, start))

    for example, start in zip(*cut_long(lengths, losses, limits), strict=True):
        example, start = int(example), int(start)
        put(example, start, min(most, int(lengths[example]) - start))

    kinds = np.array(sorted(pool, reverse=True), np.int64).reshape(-1, 2)
    left = np.array([len(pool[tuple(k)]) for k in kinds.tolist()])
    while left.sum():
        keep = left > 0
        kinds, left = kinds[keep], left[keep]
        shares = np.column_stack([kinds[:, 0] / limit[0], np.full(len(kinds), 1 / limit[1]), kinds[:, 1] / limit[2]])
        room = np.array([limits.tokens, limits.segments, limits.loss_tokens])
        sequence: list[tuple[int, int, int]] = []
        while True:
            fits = (left > 0) & (kinds[:, 0] <= room[0]) & (kinds[:, 1] <= room[2])
            if room[1] and fits.any():
                best = int(np.argmax(np.where(fits, shares @ (room / limit), -1.0)))
                length, loss = kinds[best].tolist()
                example, start = pool[length, loss].pop()
                left[best] -= 1
                sequence.append((example, start, length))
                room = room - (length, 1, loss)
                continue
            # The front of a longer example closes the gap.
            gap = int(min(room[0], room[2]))
            longer = np.flatnonzero((left > 0) & (kinds[:, 0] > gap))
            if room[1] and gap >= limits.least_cut and len(longer):
                length, loss = kinds[longer[-1]].tolist()
                example, start = pool[length, loss].pop()
                left[longer[-1]] -= 1
                sequence.append((example, start, gap))
                rest = (length - gap, min(length - gap, loss))
                pool.setdefault(rest, []).append((example, start + gap))
                same = np.flatnonzero((kinds[:, 0] == rest[0]) & (kinds[:, 1] == rest[1]))
                if len(same):
                    left[same[0]] += 1
                else:
                    kinds, left = np.vstack([kinds, rest]), np.append(left, 1)
            break
        sequences.append(sequence)
    if sequences:
        sequences[-1:] = cut_at_powers(sequences[-1])
    return sequences


def cut_at_powers(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The same pieces as sequences whose lengths are powers of two, longest first."""
    total = sum(length for _, _, length in sequence)
    out, pieces = [], list(sequence)
    for size in (1 << b for b in reversed(range(total.bit_length())) if total >> b & 1):
        out.append([])
        while size:
            example, start, length = pieces.pop(0)
            used = min(size, length)
            out[-1].append((example, start, used))
            if used < length:
                pieces.insert(0, (example, start + used, length - used))
            size -= used
    return out


PIECES = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(
    docs: DataFrame, tokenizer_path: str, limits: PackingLimits = PackingLimits(), loss_from: Callable | None = None
) -> DataFrame:
    """One row per piece of each document. ``loss_from(text, ids)``: number of leading masked ids (0 if absent)."""
    schema = docs.select("doc_id").schema
    for field in PIECES.split(", "):
        name, kind = field.split()
        schema = schema.add(name, kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = fast_tokenizer(tokenizer_path)
        next_id = TaskContext.get().partitionId() << 40
        ids: list[np.ndarray] = []
        losses: list[int] = []
        keys: list[pa.Array] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal next_id, held
            lengths = np.array([len(x) for x in ids], np.int64)
            packed = pack_pool(lengths, np.array(losses, np.int64), limits)
            rows = [
                (example, start, length, next_id + number, offset)
                for number, sequence in enumerate(packed)
                for (example, start, length), offset in zip(
                    sequence, np.cumsum([0] + [x[2] for x in sequence[:-1]]).tolist(), strict=True
                )
            ]
            next_id += len(packed)
            example, start, length, number, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            crc = [zlib.crc32(ids[e][s : s + n]) for e, s, n in zip(example.tolist(), start.tolist(), length.tolist(), strict=True)]
            doc = pa.concat_arrays(keys).take(pa.array(example))
            arrays = [doc, *map(pa.array, (start, length, np.array(crc, np.int64), lengths[example], number, offset))]
            ids.clear(), losses.clear(), keys.clear()
            held = 0
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py() or ""
                tokens = np.append(encode(text), limits.end_id).astype("<u4")
                ids.append(tokens)
                losses.append(len(tokens) - (loss_from(text, tokens) if loss_from else 0))
                keys.append(batch.column(0).slice(i, 1))
                held += len(tokens)
                if held >= limits.pool_tokens:
                    yield flush()
        if ids:
            yield flush()

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(pack, schema)
