"""Line deduplication by an edit-distance join on segments.

Two lines with at most ``edits`` edits between them: cut the shorter one into ``edits + 1`` segments, and
one segment is untouched, so the other line holds it, shifted by no more than the edits around it allow.
So each line is indexed by its own segments and probes, for every length it may be matched with,
the few substrings that a segment could have become (the multi-match-aware choice of places). Index
and probe rows that agree in length, segment number and content meet in a bucket; candidates are
verified by edit distance in a band of ``2 * edits + 1`` diagonals, a word of bits per pair, many
pairs at a time. Connected lines are a class. The first occurrence of a class (by doc_id, then line
number) stays in its text, all others are removed.

Exact repeats are a class whatever their length, from ``exact_from`` characters on (``EVERY_LINE``: all
that are not empty); they need no keys, only the hash. Links by edits are between lines of at least
``least_chars`` characters: two edits make another line of a short one ("Part 1", "Part 23").

Scale: rows are batch-distinct lines times a dozen keys of three numbers; one shuffle sorts them and
keys of a single line vanish there. A line that occurs in a third of all documents is one node. All pairs
of a bucket are compared, since the links of each line are counted; two lines whose bitmaps of
neighbouring characters differ in more places than the edits could change are no candidates, so their texts
never meet. Links are joined between distinct lines, with counts of their occurrences. Lines are numbered by a
64-bit hash of their whole content, and are equal if a second one agrees as well; two lines under one number are
never taken for each other. Their texts are fetched only for buckets.

Defined results: a line ends at ``\\n`` or at the end of its text; a null text stays null and has no
lines; an empty text is one empty line; null ids come last; rows equal in id and text are one
document and are treated alike; extra columns are kept unless they have a result's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.llm.graph import all_links, components, differing_bits
from lineforge.llm.minhash import shared_buckets
from lineforge.llm.tables import if_small, written
from lineforge.llm.text import PIECE, SpanHasher, mix, parity_sketch, row_slices, signed


@dataclass(frozen=True)
class LineSettings:
    """Edits and the least characters of lines that edits link; the least of lines whose exact repeats go."""

    edits: int = 2
    least_chars: int = 30
    exact_from: int = 30


# What the query and the pipeline use: exact repeats of every line that is not empty.
EVERY_LINE = LineSettings(exact_from=1)


_hasher = SpanHasher()

# What sets a line's second hash apart from its first.
_SECOND = 0x5851F42D


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def segment(length: np.ndarray, number: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of a segment; the last ones are longer by one where it doesn't divide."""
    base, more = length // parts, length % parts
    start = number * base + np.maximum(0, number - (parts - more))
    return start, base + (number >= parts - more)


def segment_keys(units: np.ndarray, offsets: np.ndarray, s: LineSettings) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(line, key, kind): keys under which each line is indexed (kind 1) or probes (kind 0)."""
    parts, begin, length = s.edits + 1, offsets[:-1], np.diff(offsets)
    sums = _hasher.sums(units)
    for shorter in range(parts):
        other = length - shorter
        for number in range(parts):
            start, size = segment(other, number, parts)
            low = np.maximum.reduce([start * 0, start - number, start + shorter - (s.edits - number)])
            high = np.minimum.reduce([length - size, start + number, start + shorter + (s.edits - number)])
            for shift in range(-number, number + 1):
                place = start + shift
                fits = np.flatnonzero((place >= low) & (place <= high) & (other >= s.least_chars))
                if not len(fits):
                    continue
                first = (begin + place)[fits]
                h = _hasher.spans(sums, first, first + size[fits])
                key = mix(h ^ mix((other[fits] * parts + number).astype(np.uint64)))
                yield fits, key, int(not shorter and not shift)


def line_keys(lines: DataFrame, s: LineSettings) -> DataFrame:
    """(bucket, node, center) of the distinct lines (node, line) of each batch."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, one = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_index=True)
            units, offsets = code_points(batch.column(1).take(pa.array(one)).to_pylist())
            for first, last in row_slices(offsets, PIECE // 2):
                places = offsets[first : last + 1] - offsets[first]
                piece = units[offsets[first] : offsets[last]]
                found = list(segment_keys(piece, places, s))
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(np.concatenate([key for _, key, _ in found])),
                        pa.array(np.concatenate([node[first:last][line] for line, _, _ in found])),
                        pa.array(np.concatenate([np.full(len(line), kind, np.int32) for line, _, kind in found])),
                    ],
                    names=["bucket", "node", "center"],
                )

    return lines.select("node", "line").mapInArrow(keys, "bucket long, node long, center int")


# Words of a line's bitmap.
SKETCH = 4


def pair_elements(units: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, element): neighbouring characters, the k-th occurrence of the same two as its own element."""
    line = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    inside = line[1:] == line[:-1]
    line, pair = line[1:][inside], mix((units[:-1].astype(np.uint64) << np.uint64(32)) | units[1:])[inside]
    order = np.lexsort((pair, line))
    line, pair = line[order], pair[order]
    fresh = np.ones(len(line), bool)
    fresh[1:] = (line[1:] != line[:-1]) | (pair[1:] != pair[:-1])
    first = np.flatnonzero(fresh)
    again = np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line))))
    return line, mix(pair + again.astype(np.uint64))


def with_sketch(texts: DataFrame) -> DataFrame:
    """(node, sketch) of (node, line)."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            line, element = pair_elements(*code_points(batch.column(1).to_pylist()))
            bitmap = parity_sketch(line, element, batch.num_rows, SKETCH)
            yield pa.RecordBatch.from_arrays([batch.column(0), bitmap], names=["node", "sketch"])

    return texts.select("node", "line").mapInArrow(sketch, "node long, sketch array<long>")


def within_edits(left: list[str], right: list[str], edits: int) -> np.ndarray:
    """Which pairs have at most ``edits`` edits: bit-parallel over a band of diagonals."""
    out = np.zeros(len(left), bool)
    short = [a if len(a) <= len(b) else b for a, b in zip(left, right, strict=True)]
    long = [b if len(a) <= len(b) else a for a, b in zip(left, right, strict=True)]
    n, m = (np.array([len(t) for t in side], np.int64) for side in (short, long))
    # Texts no longer than the band are compared with padding that matches nothing and costs nothing.
    order = np.flatnonzero(m - n <= edits)
    order = order[np.argsort(m[order], kind="stable")]
    at = 0
    while at < len(order):
        count = max(1, min(1024, (1 << 22) // (int(m[order[min(at + 1023, len(order) - 1)]]) + 1)))
        rows = order[at : at + count]
        out[rows] = _band([short[r] for r in rows], [long[r] for r in rows], edits) <= edits
        at += count
    return out


def _band(short: list[str], long: list[str], edits: int) -> np.ndarray:
    """Edit distances where they are at most ``edits``; larger values elsewhere."""
    pad = edits + 1  # a common prefix on both sides: shorter texts than the band need no special case
    n = np.array([len(t) for t in short]) + pad
    m = np.array([len(t) for t in long]) + pad
    width, word = 2 * edits + 1, np.uint64
    full = word((1 << width) - 1)
    one = word(1)
    pattern = np.full((len(short), int(m.max()) + width), 0xFFFFFFFF, np.uint32)
    text = np.full((len(short), int(m.max())), 0xFFFFFFFE, np.uint32)
    for i, (a, b) in enumerate(zip(short, long, strict=True)):
        pattern[i, edits : edits + pad] = text[i, :pad] = 0xFFFFFFFD
        pattern[i, edits + pad : edits + n[i]] = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
        text[i, pad : m[i]] = np.frombuffer(b.encode("utf-32-le", "surrogatepass"), np.uint32)
    # Bit k of column j stands for row j + k - edits. The distance is followed along the lowest
    # diagonal down to the last row, then along that row.
    vp = np.full(len(short), ((1 << (edits + 1)) - 1) << edits, word)
    vn = np.zeros(len(short), word)
    distance = np.full(len(short), edits, np.int64)
    for j in range(text.shape[1]):
        equal = np.zeros(len(short), word)
        for k in range(width):
            equal |= (pattern[:, j + k] == text[:, j]).astype(word) << word(k)
        d0 = ((((equal & vp) + vp) ^ vp) | equal | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        down = j < n - edits
        row = np.clip(2 * edits - 1 - (j - (n - edits)), 0, width).astype(word)
        step = ((hp >> row) & one).astype(np.int64) - ((hn >> row) & one).astype(np.int64)
        step = np.where(down, 1 - ((d0 >> word(2 * edits)) & one).astype(np.int64), step)
        distance += np.where(j < m, step, 0)
        vp = (hn | ~((d0 >> one) | hp)) & full
        vn = (d0 >> one) & hp
    return distance


def close_lines(pairs: DataFrame, texts: DataFrame, edits: int) -> DataFrame:
    """The pairs (a, b) whose lines are within ``edits``."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = within_edits(batch.column(2).to_pylist(), batch.column(3).to_pylist(), edits)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(near)) for i in (0, 1)], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))


def line_classes(docs: DataFrame, s: LineSettings = LineSettings()) -> DataFrame:
    """(doc_id, text_hash, line_no, class, links, stays) of each line that others share a class with. Runs jobs.

    ``links``: the other occurrences of the line and of those within the edits.
    """
    lines = (
        _keyed(docs)
        .select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
        .where(F.length("line") >= min(s.exact_from, s.least_chars))
        .withColumns({"node": F.xxhash64("line"), "check": F.xxhash64(F.lit(_SECOND), "line")})
    )
    every, lines = lines, lines.where(F.length("line") >= s.least_chars)
    members = written(shared_buckets(line_keys(lines, s)), "buckets")
    # Only buckets that some line is indexed in hold candidates.
    indexed = members.groupBy("bucket").agg(F.max("center").alias("some")).where("some = 1").select("bucket")
    members = written(members.join(indexed, "bucket", "left_semi"), "members")
    nodes = written(members.select("node").distinct(), "nodes")
    texts = lines.select("node", "check", "line").join(if_small(nodes, 24), "node", "left_semi").dropDuplicates(["node"])
    texts = written(texts, "texts")
    members = members.join(with_sketch(texts), "node").select(
        "bucket", "node", (F.col("center") == 1).alias("center"), F.lit(0).alias("weight"), "sketch"
    )
    links = all_links(
        written(members, "members"),
        lambda pairs: close_lines(pairs, texts.select("node", "line"), s.edits),
        # Necessary: an edit takes away at most two pairs of neighbours and adds at most two.
        lambda x, y: differing_bits(x("sketch"), y("sketch"), SKETCH) <= 4 * s.edits,
    )
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash", "line_no")
    places = written(every.select("doc_id", "text_hash", "line_no", "node", "check"), "places")
    # One row per distinct line: its occurrences, and those of the lines linked with it.
    line = ["node", "check"]
    distinct = places.groupBy(*line).agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    if links is None:
        distinct = written(distinct.where("copies > 1"), "distinct")
        shared = distinct.select(*line, F.col("node").alias("class"), "first", (F.col("copies") - 1).alias("links"))
    else:
        # Links are those of the line that was compared, not of another one under the same number.
        roots = components(links).toDF("node", "class").join(texts.select(*line), "node")
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("node", "other")
        distinct = distinct.join(written(roots.withColumn("linked", F.lit(True)), "roots"), line, "left")
        distinct = distinct.where("copies > 1 or linked").withColumns(
            {"class": F.coalesce("class", "node"), "apart": F.when(F.col("linked"), 0).otherwise(F.col("check"))}
        )
        distinct = written(distinct, "distinct")
        linked = distinct.where("linked")
        others = both.join(linked.select(F.col("node").alias("other"), "copies"), "other")
        others = others.groupBy("node").agg(F.sum("copies").alias("others")).withColumn("linked", F.lit(True))
        classes = distinct.groupBy("class", "apart").agg(F.min("first").alias("first"))
        shared = distinct.drop("first").join(others, ["node", "linked"], "left").join(classes, ["class", "apart"])
        shared = shared.select(*line, "class", "first", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links"))
    # Written, so that the join can split a line that is a large share of all lines.
    return places.join(written(shared, "shared"), line).select(
        "doc_id", "text_hash", "line_no", "class", "links", (place == F.col("first")).alias("stays")
    )


def drop_repeated_lines(docs: DataFrame, s: LineSettings = LineSettings()) -> DataFrame:
    """``docs`` with ``text`` without repeated lines, and columns of what was done. Runs jobs.

    ``n_lines``; ``n_removed``; ``classes``: the classes of its lines that others share, in order;
    ``n_links``: over its lines, the other occurrences that are equal or within the edits. In a class that is
    a chain these are fewer than the class has.
    """
    removed = (
        line_classes(docs, s)
        .groupBy(F.col("doc_id").alias("__key_id"), F.col("text_hash").alias("__key_hash"))
        .agg(
            F.collect_set(F.when(~F.col("stays"), F.col("line_no"))).alias("__gone"),
            F.sum("links").alias("__links"),
            F.array_distinct(F.transform(F.array_sort(F.collect_set(F.struct("line_no", "class"))), lambda x: x["class"])).alias("__shared"),
        )
    )
    marked = docs.withColumn("text", F.col("text").cast("string"))
    same = F.col("doc_id").eqNullSafe(F.col("__key_id")) & (F.xxhash64("text") == F.col("__key_hash"))
    marked = marked.join(written(removed, "removed"), same, "left").select(*[marked[c] for c in docs.columns], "__gone", "__links", "__shared")
    added = T.StructType.fromDDL("n_lines long, n_removed long, n_links long, classes array<long>").fields
    # An input column of one of these names gives way to the new one.
    new = {f.name for f in added}
    others = [f for f in marked.schema.fields[: len(docs.columns)] if f.name.lower() not in new]
    marked = marked.select(*[f.name for f in others], "__gone", "__links", "__shared")
    schema = T.StructType([*others, *added])
    at = [f.name for f in others].index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *kept, gone, links, shared = batch.columns
            texts, counts, cuts = kept[at].to_pylist(), [], []
            for i, (text, drop) in enumerate(zip(texts, gone.to_pylist(), strict=True)):
                lines = [] if text is None else text.split("\n")
                counts.append(len(lines))
                cuts.append(len(drop or ()))
                if drop:
                    out = set(drop)
                    texts[i] = "\n".join(line for k, line in enumerate(lines) if k not in out)
            kept[at] = pa.array(texts, pa.string())
            numbers = [pa.array(counts, pa.int64()), pa.array(cuts, pa.int64()), links.fill_null(0)]
            classes = pa.array([c or [] for c in shared.to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*kept, *numbers, classes], names=schema.names)

    return marked.mapInArrow(cut, schema)
