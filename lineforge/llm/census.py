"""Corpus-wide counts of fingerprints, given back to the batch that each came from.

Rows are packed once into batches of some megabytes, each a compressed row of one written table. A first
pass reduces every batch to its distinct fingerprints and sends them, dealt by their high bits, to
the parts of the fingerprint range; a part adds up and answers each batch with one byte per fingerprint
that the batch sent, in the order in which it sent them. A second pass meets the batch with its
answers, makes the same fingerprints again and reads their bytes off by position.

Shuffled are some six bytes per distinct fingerprint of a batch one way, one byte back, and the compressed
batches. A fingerprint of any frequency is sent once per batch, so no key is hot. A part holds the
fingerprints of about ``PART_BYTES`` of text.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.llm.tables import written
from lineforge.llm.text import row_slices, utf8
from lineforge.storage import shuffle_tasks

# Text per batch and per part of the fingerprint range; larger ones suit larger corpora.
BATCH_BYTES = 4 << 20
PART_BYTES = 16 << 20

# The part under which a batch itself travels, before all its answers.
_BATCH = -1

Fingerprints = Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]


def squeeze(raw: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(raw)


def expand(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _bytes_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(expand(raw), np.uint8)


def pack_batches(df: DataFrame, text: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(batch, size, payload) of all rows, written; ``size`` in bytes of the column ``text``."""
    place = df.columns.index(text)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0

        def emit() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            table = pa.Table.from_batches(held)
            with pa.ipc.new_stream(sink, table.schema) as out:
                out.write_table(table)
            payload = squeeze(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([size]), pa.array([payload], pa.binary())], names=["batch", "size", "payload"]
            )

        for batch in batches:
            offsets = utf8(batch.column(place))[1]
            for first, last in row_slices(offsets, batch_bytes):
                more = int(offsets[last] - offsets[first])
                if held and size + more > batch_bytes:
                    yield emit()
                    number, held, size = number + 1, [], 0
                held.append(batch.slice(first, last - first))
                size += more
        if held:
            yield emit()

    return written(df.mapInArrow(pack, "batch long, size long, payload binary"), "batches")


def _unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(expand(payload)).read_all()


def _encode(h: np.ndarray, counts: np.ndarray) -> bytes:
    """Ascending fingerprints as differences, and counts, both byte plane by byte plane."""
    planes = np.diff(h, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    tail = counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T
    return squeeze(planes.tobytes() + tail.tobytes())


def _decode(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = _bytes_of(blob).reshape(12, -1)
    h = np.cumsum(np.ascontiguousarray(planes[:8].T).view(np.uint64).ravel(), dtype=np.uint64)
    return h, np.ascontiguousarray(planes[8:].T).view(np.uint32).ravel()


def _part_bounds(parts: int) -> np.ndarray:
    """First fingerprint of every part but the first."""
    return np.array([(p << 64) // parts for p in range(1, parts)], np.uint64)


def with_counts(
    batches: DataFrame,
    fingerprints: Fingerprints,
    code: Callable[[np.ndarray], np.ndarray],
    use: Callable[[pa.Table, np.ndarray, np.ndarray], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """``use(rows, fingerprints, codes)`` of every batch.

    ``fingerprints`` gives a batch's distinct fingerprints, ascending, and their counts in it;
    ``code`` turns corpus-wide counts into bytes. Runs the jobs of the first pass when called.
    """
    spark = batches.sparkSession
    total = batches.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = shuffle_tasks(spark)
    parts = max(tasks, math.ceil(total / PART_BYTES))
    answered = "batch long, part int, payload binary"

    def send(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _part_bounds(parts)
        for chunk in chunks:
            for batch, payload in zip(chunk.column(0).to_pylist(), chunk.column(1), strict=True):
                h, counts = fingerprints(_unpack(payload.as_py()))
                cut = [0, *np.searchsorted(h, bounds), len(h)]
                own = [p for p in range(parts) if cut[p] < cut[p + 1]]
                blobs = [_encode(h[cut[p] : cut[p + 1]], counts[cut[p] : cut[p + 1]]) for p in own]
                if own:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([batch] * len(own), pa.int64()), pa.array(own, pa.int32()), pa.array(blobs, pa.binary())],
                        names=["batch", "part", "payload"],
                    )

    def answer_part(part: int, ids: list[int], blobs: list[bytes]) -> pa.RecordBatch:
        sent = [_decode(b) for b in blobs]
        h = np.concatenate([x[0] for x in sent])
        order = np.argsort(h, kind="stable")
        new = np.ones(len(h), bool)
        new[1:] = h[order][1:] != h[order][:-1]
        totals = np.add.reduceat(np.concatenate([x[1] for x in sent]).astype(np.int64)[order], np.flatnonzero(new))
        codes = np.empty(len(h), np.uint8)
        codes[order] = code(totals)[np.cumsum(new) - 1]
        cut = np.cumsum([0, *(len(x[0]) for x in sent)])
        answers = [squeeze(codes[cut[i] : cut[i + 1]].tobytes()) for i in range(len(ids))]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([part] * len(ids), pa.int32()), pa.array(answers, pa.binary())],
            names=["batch", "part", "payload"],
        )

    def answer(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _runs(chunks, "part"):
            yield answer_part(part, [r[0] for r in rows], [r[2] for r in rows])

    def meet(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _runs(chunks, "batch"):
            if rows[0][1] != _BATCH:
                raise ValueError(f"answers without their batch {batch}")
            table = _unpack(rows[0][2])
            h, _ = fingerprints(table)
            codes = np.concatenate([np.zeros(0, np.uint8), *(_bytes_of(r[2]) for r in rows[1:])])
            if len(codes) != len(h):
                raise ValueError(f"batch {batch} has {len(h)} fingerprints and {len(codes)} answers")
            yield use(table, h, codes)

    sent = batches.select("batch", "payload").mapInArrow(send, answered)
    dealt = sent.repartition(min(parts, 4 * tasks), "part").sortWithinPartitions("part", "batch")
    answers = written(dealt.mapInArrow(answer, answered), "answers")
    both = batches.select("batch", F.lit(_BATCH).alias("part"), "payload").unionByName(answers)
    return both.repartition(tasks, "batch").sortWithinPartitions("batch", "part").mapInArrow(meet, schema)


def _runs(chunks: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple[int, int, bytes]]]]:
    """Rows (batch, part, payload) in runs of equal ``key``, as they come."""
    at, held = None, []
    for chunk in chunks:
        for row in zip(chunk.column(0).to_pylist(), chunk.column(1).to_pylist(), chunk.column(2), strict=True):
            now = row[0] if key == "batch" else row[1]
            if held and now != at:
                yield at, held
                held = []
            at = now
            held.append((row[0], row[1], row[2].as_py()))
    if held:
        yield at, held
