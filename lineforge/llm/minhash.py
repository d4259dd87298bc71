"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

A document's set holds the hashes of all its runs of ``width`` words. A band is usually ``rows``
minima; here two small collections A and B of half bands (``rows / 2`` minima each) are drawn, and
table (i, j) has the key (A_i, B_j). So ``halves`` squared tables need only 2 * ``halves`` half
bands: the number of minima to compute is about the square root of what separate tables would
need. Two sets meet in some table exactly if they agree in at least one half band of each side, and
``halves`` is chosen from the threshold so that a pair right at it is missed with at most
``miss`` probability (pairs above it far less).

Only half bands are shuffled, 2 * ``halves`` short rows per set: a half band that no other set has can't be
part of a shared key, so the keys of tables are formed from what is left, and most sets have nothing left.
Documents with equal sets are one node from the start, by a name of 128 bits. The tables' buckets go to
``graph.connect``; a pair whose sets' parity bitmaps differ in more places than similar sets could is no
candidate, and it is a link only if the full sets pass the integer test ``100 * both >= percent * either``.

Scale: sets are hashed in NumPy from Arrow buffers where they are read, once for names and half bands, which
are written, and again for one document of each node in a bucket. Shingles have 64 bits.

Defined results: only A-Z are folded; words are runs of anything but the six white-space characters;
a text with fewer words than ``width`` is one shingle; null or blank texts have no shingles and are
linked with nothing; the ``component_id`` is the smallest ``doc_id`` connected, null ids last; rows
that share an id are judged by their own texts; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.llm.graph import connect, differing_bits
from lineforge.llm.shingles import set_name, shingle_sets
from lineforge.llm.tables import if_small, written
from lineforge.llm.text import mix, parity_sketch, signed


@dataclass(frozen=True)
class NearSettings:
    """Words per shingle and the least similarity in percent; half bands and the odds of a miss."""

    width: int = 5
    percent: int = 80
    half_rows: int = 2
    miss: float = 1e-4

    @property
    def halves(self) -> int:
        agree = (self.percent / 100) ** self.half_rows
        return max(2, math.ceil(math.log(self.miss / 2) / math.log(1 - agree)))


def _names(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Names of 128 bits as two longs, (sets, 2); zeros for the empty set."""
    raw = b"".join(set_name(h[a:b]) or bytes(16) for a, b in zip(bounds[:-1], bounds[1:], strict=True))
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _minima(h: np.ndarray, bounds: np.ndarray, settings: NearSettings, side: int) -> np.ndarray:
    """Half bands of one side, (sets, halves), of sets that are not empty."""
    random = np.random.default_rng([side, settings.halves])
    out = np.empty((len(bounds) - 1, settings.halves), np.uint64)
    for i in range(settings.halves):
        band = np.full(len(bounds) - 1, np.uint64(2 * i + side + 1))
        for _ in range(settings.half_rows):
            factor = random.integers(1, 1 << 63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            shift = random.integers(0, 1 << 63, dtype=np.uint64)
            band = mix(band ^ np.minimum.reduceat(h * factor + shift, bounds[:-1]))
        out[:, i] = band
    return out


def describe(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """Every column but ``text``, with the size and name of the text's set and its half bands, A before B."""
    others = docs.drop("text")
    added = T.StructType.fromDDL("n_shingles long, hi long, lo long, bands array<long>").fields
    schema = T.StructType([*others.schema.fields, *added])
    ordered = docs.select(*others.columns, F.col("text").cast("string"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = 2 * settings.halves
        for batch in batches:
            for first, last, h, bounds in shingle_sets(batch.column(batch.num_columns - 1), settings.width):
                names, some = _names(h, bounds), np.flatnonzero(np.diff(bounds))
                # Empty sets take no place in ``h``, so the bounds of the others follow each other.
                own = np.append(bounds[some], bounds[-1])
                bands = np.hstack([_minima(h, own, settings, side) for side in (0, 1)]) if len(some) else np.zeros((0, wide), np.uint64)
                ends = np.zeros(last - first + 1, np.int32)
                ends[some + 1] = wide
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(first, last - first) for c in batch.columns[:-1]),
                        pa.array(np.diff(bounds)),
                        pa.array(names[:, 0]),
                        pa.array(names[:, 1]),
                        pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), signed(bands.ravel())),
                    ],
                    names=schema.names,
                )

    return ordered.mapInArrow(name, schema)


def shared_tables(described: DataFrame, settings: NearSettings) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, hi, lo) that may be in a table with others, and (bucket, node) of the tables. Runs jobs.

    The lowest byte of a bucket counts j - i, 0 the diagonal.
    """
    n = settings.halves
    bands = described.where("n_shingles > 0").select("hi", "lo", F.posexplode("bands").alias("i", "band"))
    several = bands.groupBy("i", "band").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("hi", "lo")])
    several = written(several.where("min_hi <> max_hi or min_lo <> max_lo").select("i", "band"), "shared-bands")
    alive = bands.join(several, ["i", "band"], "left_semi").groupBy("hi", "lo").agg(F.collect_set(F.struct("i", "band")).alias("bands"))
    side = lambda first: F.filter("bands", lambda x: (x["i"] >= first) & (x["i"] < first + n))
    alive = alive.withColumns({"a": side(0), "b": side(n)}).where("size(a) > 0 and size(b) > 0").drop("bands")
    nodes = written(alive.withColumn("node", F.monotonically_increasing_id()), "nodes")


    def key(x: Column, y: Column) -> Column:
        shift = F.least(F.pmod(y["i"] - x["i"], F.lit(n)), F.lit(255))
        return F.xxhash64(x["i"], x["band"], y["i"], y["band"]).bitwiseAND(F.lit(~255)).bitwiseOR(shift.cast("long"))

    keys = F.flatten(F.transform("a", lambda x: F.transform("b", lambda y: key(x, y))))
    members = nodes.select("node", F.explode(keys).alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    members = written(members.join(shared, "bucket", "left_semi").select("bucket", "node").distinct(), "buckets")
    return nodes.select("node", "hi", "lo"), members


def shared_buckets(keys: DataFrame) -> DataFrame:
    """The rows (bucket, node, ...) of buckets with more than one node, each once. One shuffle.

    Rows arrive sorted by all columns, so a bucket is known to be shared at its second node and is
    passed on from there; held back are only the different rows of its first node.
    """
    names = keys.columns
    dealt = keys.repartition("bucket").sortWithinPartitions(*names)

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, gone = [np.zeros(0, np.int64) for _ in names], False
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [
                np.concatenate([h.astype(c.dtype), c])
                for h, c in zip(held, (c.to_numpy(zero_copy_only=False) for c in batch.columns), strict=True)
            ]
            bucket, node = columns[:2]
            same = bucket[1:] == bucket[:-1]
            again = np.concatenate([[False], np.logical_and.reduce([c[1:] == c[:-1] for c in columns])])
            run = np.concatenate([[0], np.cumsum(~same)])
            many = np.zeros(run[-1] + 1, bool)
            many[run[1:][same & (node[1:] != node[:-1])]] = True
            # What was held of a run that already went out went with it.
            many[0] |= gone
            out = many[run] & ~again
            if gone:
                out[0] = False
            gone = bool(many[-1])
            keep = np.flatnonzero((run == run[-1]) & ~again)
            keep = np.array([len(run) - 1]) if gone else keep
            held = [c[keep] for c in columns]
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[out]) for c in columns], names=names)

    return dealt.mapInArrow(shared, keys.schema)


# Words of a set's bitmap.
SKETCH = 8


def full_sets(docs: DataFrame, settings: NearSettings) -> DataFrame:
    """(hi, lo, size, shingles, sketch) of each row that has any."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, h, bounds in shingle_sets(batch.column(0), settings.width):
                size, names = np.diff(bounds), _names(h, bounds)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), signed(h))
                sketch = parity_sketch(np.repeat(np.arange(last - first), size), h, last - first, SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[:, 0]), pa.array(names[:, 1]), pa.array(size), lists, sketch],
                    names=["hi", "lo", "size", "shingles", "sketch"],
                )

    schema = "hi long, lo long, size long, shingles array<long>, sketch array<long>"
    return docs.select(F.col("text").cast("string")).mapInArrow(sets, schema).where("size > 0")


def _similar(both: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * both >= percent * (a + b - both)


def mark_near_copies(docs: DataFrame, settings: NearSettings = NearSettings()) -> DataFrame:
    """Per document doc_id, text_hash, n_shingles, component_id, kept. Runs jobs."""
    texts = docs.select("doc_id", F.xxhash64(F.col("text").cast("string")).alias("text_hash"), "text")
    described = written(describe(texts, settings), "described")
    nodes, members = shared_tables(described, settings)
    named = described.select("doc_id", "text_hash", "n_shingles", "hi", "lo")
    # Full sets again, of one document for each node that shares a bucket. The more buckets a node
    # shares, the more central it is.
    weights = written(members.groupBy("node").agg((-F.count("*")).alias("weight")).join(nodes, "node"), "weights")
    one = named.where("n_shingles > 0").groupBy("hi", "lo").agg(F.min(F.struct("doc_id", "text_hash")).alias("key"))
    one = one.join(weights.select("hi", "lo"), ["hi", "lo"], "left_semi")
    keys = written(one.select(F.col("key.doc_id").alias("one_id"), F.col("key.text_hash").alias("one_hash")), "representatives")
    chosen = F.col("doc_id").eqNullSafe(F.col("one_id")) & (F.col("text_hash") == F.col("one_hash"))
    sets = full_sets(texts.join(if_small(keys, 64), chosen, "left_semi"), settings)
    sets = written(sets.join(weights, ["hi", "lo"]).drop("hi", "lo").dropDuplicates(["node"]), "sets")
    members = members.join(sets.select("node", "weight", "size", "sketch"), "node").withColumn("center", F.lit(True))
    members = written(members, "members")

    def possible(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        # Sets of sizes a and b that are similar enough differ in at most this share of a + b elements.
        total, percent = x("size") + y("size"), settings.percent
        apart = differing_bits(x("sketch"), y("sketch"), SKETCH)
        return ((100 + percent) * apart <= (100 - percent) * total) & (
            100 * F.least(x("size"), y("size")) >= percent * F.greatest(x("size"), y("size"))
        )

    def verified(pairs: DataFrame) -> DataFrame:
        own = sets.select("node", "shingles")
        near = pairs.join(own.toDF("a", "set_a"), "a").join(own.toDF("b", "set_b"), "b")
        both = F.size(F.array_intersect("set_a", "set_b"))
        return near.where(_similar(both, F.size("set_a"), F.size("set_b"), settings.percent)).select("a", "b")

    roots, _ = connect(members, verified, possible, first=F.col("bucket").bitwiseAND(F.lit(255)) == 0)
    if roots is None:
        placed = named.withColumns({"root_hi": F.col("hi"), "root_lo": F.col("lo")})
    else:
        place = nodes.toDF("root", "root_hi", "root_lo")
        moved = written(roots.join(nodes, "node").join(place, "root").drop("node", "root"), "moved")
        placed = named.join(moved, ["hi", "lo"], "left")
        placed = placed.withColumns({f"root_{c}": F.coalesce(f"root_{c}", c) for c in ("hi", "lo")})
    root = ["root_hi", "root_lo"]
    placed = placed.withColumns({c: F.when(F.col("n_shingles") > 0, F.col(c)) for c in root})
    groups = placed.where("root_hi is not null").groupBy(*root).agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    # Written, so that the join can split a group that holds a large share of all rows.
    groups = written(groups.where("n > 1"), "groups")
    component = F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return placed.join(groups, root, "left").select(
        "doc_id",
        "text_hash",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def drop_near_copies(docs: DataFrame, settings: NearSettings = NearSettings()) -> DataFrame:
    """``docs`` without the documents that another one of their group stands for. Runs jobs.

    Rows that are equal in id and text are one document here and stay or go together.
    """
    gone = mark_near_copies(docs, settings).where("not kept").select(F.col("doc_id").alias("__gone_id"), F.col("text_hash").alias("__gone_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__gone_id")) & (F.xxhash64(F.col("text").cast("string")) == F.col("__gone_hash"))
    return docs.join(if_small(written(gone.distinct(), "gone"), 64), same, "left_anti")
