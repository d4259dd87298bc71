"""Similarity join on word n-grams by adaptive prefixes with several required matches.

Two sets are linked if ``100 * both >= percent * either``. All shingles have one global order, rare
ones first. A set of n shingles that needs an overlap of t has, for every length l, a prefix of its first
n - t + l shingles, and two linked sets share at least l shingles of their prefixes of length l. A
longer prefix looks up more shingles and leaves fewer candidates, so every set chooses its own l: it
adds up how often the shingles of a prefix occur, which estimates the candidates met, charges
each lookup 1 and each candidate that reaches l matches (at most the l-th part of what is met) the cost
of comparing two sets, and takes the cheapest l. A pair of sets with lengths l and m is compared only
if their prefixes share min(l, m) shingles, which no linked pair fails.

The order comes from ``census``: exact counts of all batches, as a byte on a logarithmic scale, ties by the
shingle. A shingle of a single set can't be shared, so a set whose prefix holds only such has no
partner and is done. The others, their prefix shingles as buckets, go to ``graph.connect``, which
finds who is connected without testing all pairs of a group. Candidates pass the bounds on sizes, places
and parity bitmaps first, then the required matches, then the full sets.

Equal sets are one node under a name of 128 bits. Shingles are fingerprints of 64 bits.

Defined results: only A-Z are folded; words are runs of anything but the six white-space characters;
a text of fewer words than ``width`` is one shingle; null or blank texts have no shingles and are
linked with nothing; ``component_id`` is the smallest ``doc_id`` connected, null ids last; rows that
share an id are judged by their own texts; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineforge.llm.census import pack_batches, with_counts
from lineforge.llm.graph import connect, differing_bits
from lineforge.llm.shingles import set_name, shingle_sets
from lineforge.llm.tables import written
from lineforge.llm.text import parity_sketch


@dataclass(frozen=True)
class JoinSettings:
    """Words per shingle and the least similarity in percent; the longest prefix extension tried.

    A comparison of two sets costs as much as one lookup per ``shingles_per_lookup`` shingles.
    """

    width: int = 5
    percent: int = 80
    most_matches: int = 8
    shingles_per_lookup: int = 16


# Words of a set's bitmap, and steps of the logarithmic scale of counts per doubling.
SKETCH = 8
STEPS = 5


def frequency_code(counts: np.ndarray) -> np.ndarray:
    """0 for a shingle of one set, else at least 1 and ascending with the count."""
    return np.minimum(np.round(np.log2(counts) * STEPS), 255).astype(np.uint8)


def choose_matches(codes: np.ndarray, n: int, least: int, s: JoinSettings) -> tuple[int, int]:
    """Required matches l and prefix length of a set, from the codes of its shared shingles in order.

    ``n`` is the size of the set, ``least`` the overlap that it needs.
    """
    alone = n - len(codes)
    met = np.cumsum(np.exp2(codes.astype(float) / STEPS) - 1)
    best = (np.inf, 1, 0)
    for matches in range(1, min(least, s.most_matches) + 1):
        length = n - least + matches
        shared = min(length - alone, len(codes))
        if shared <= 0:
            return matches, 0
        cost = met[shared - 1] * (1 + (1 + n / s.shingles_per_lookup) / matches)
        best = min(best, (cost, matches, shared))
    return best[1], best[2]


def _batch_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, list[bytes], np.ndarray]:
    """Shingles of all texts, row offsets, names, and which rows are the first with their set."""
    parts, sizes = [], []
    for _, _, h, bounds in shingle_sets(texts, width):
        parts.append(h)
        sizes.append(np.diff(bounds))
    h = np.concatenate([np.zeros(0, np.uint64), *parts])
    bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))]).astype(np.int64)
    names = [set_name(h[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    first, seen = np.zeros(len(names), bool), {b""}
    for i, name in enumerate(names):
        if name not in seen:
            seen.add(name)
            first[i] = True
    return h, bounds, names, first


PLACED = """doc_id {id}, n_shingles long, node binary, matches int, prefix array<long>, places array<int>,
    shingles array<long>, sketch array<long>"""


def place_documents(docs: DataFrame, s: JoinSettings) -> DataFrame:
    """Every document with its set's size and name; the first of its set in a batch with the prefix too.

    ``prefix`` holds the shared shingles of the chosen prefix, ``places`` their positions in the order;
    both are null where the prefix holds no shared shingle.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    batches = pack_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), "text")

    def fingerprints(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        h, bounds, _, first = _batch_sets(table["text"], s.width)
        return np.unique(h[np.repeat(first, np.diff(bounds))], return_counts=True)

    def use(table: pa.Table, known: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        h, bounds, names, first = _batch_sets(table["text"], s.width)
        size = np.diff(bounds)
        matches = np.zeros(len(size), np.int32)
        prefix, places, sets, chosen = [], [], [], []
        for i in np.flatnonzero(first):
            own = h[bounds[i] : bounds[i + 1]]
            code = codes[np.searchsorted(known, own)]
            n, least = len(own), -(-s.percent * len(own) // 100)
            shared = np.flatnonzero(code)
            if n - len(shared) >= n - least + 1:
                continue
            order = shared[np.lexsort((own[shared], code[shared]))]
            matches[i], length = choose_matches(code[order], n, least, s)
            if length:
                chosen.append(i)
                prefix.append(own[order[:length]])
                places.append((n - len(shared) + np.arange(length)).astype(np.int32))
                sets.append(own)
        chosen = np.array(chosen, np.int64)
        lengths, sizes = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        lengths[chosen], sizes[chosen] = [len(x) for x in prefix], [len(x) for x in sets]
        absent = np.ones(len(size), bool)
        absent[chosen] = False
        mask = pa.array(absent)

        def lists(parts: list[np.ndarray], size: np.ndarray, kind: type) -> pa.Array:
            flat = np.concatenate([np.zeros(0, kind), *parts])
            flat = pa.array(flat.view(np.int64) if kind is np.uint64 else flat)
            offsets = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            return pa.ListArray.from_arrays(offsets, flat, mask=mask)

        rows = np.repeat(np.arange(len(chosen)), sizes[chosen])
        sketch = parity_sketch(rows, np.concatenate([np.zeros(0, np.uint64), *sets]), len(chosen), SKETCH).flatten()
        ends = pa.array(np.concatenate([[0], np.cumsum(np.where(absent, 0, SKETCH))]).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [
                table["doc_id"].combine_chunks(),
                pa.array(size),
                pa.array([name or None for name in names], pa.binary()),
                pa.array(matches),
                lists(prefix, lengths, np.uint64),
                lists(places, lengths, np.int32),
                lists(sets, sizes, np.uint64),
                pa.ListArray.from_arrays(ends, sketch, mask=mask),
            ],
            names=["doc_id", "n_shingles", "node", "matches", "prefix", "places", "shingles", "sketch"],
        )

    return with_counts(batches, fingerprints, frequency_code, use, PLACED.format(id=kind))


def link_sets(sets: DataFrame, s: JoinSettings) -> DataFrame | None:
    """(id, root) of all connected sets of the written (id, size, matches, prefix, places, shingles, sketch)."""
    pieces = F.arrays_zip(F.col("prefix").alias("bucket"), F.col("places").alias("place"))
    members = sets.select(
        F.col("id").alias("node"), "size", "sketch", (-F.size("prefix")).alias("weight"), F.inline(pieces).alias("bucket", "place")
    )
    shared = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = written(members.join(shared, "bucket").withColumn("center", F.lit(True)), "members")
    percent = s.percent

    def possible(x: Callable[[str], Column], y: Callable[[str], Column]) -> Column:
        a, b = x("size"), y("size")
        # Sets that are similar enough differ in at most this share of a + b shingles.
        close = (100 + percent) * differing_bits(x("sketch"), y("sketch"), SKETCH) <= (100 - percent) * (a + b)
        # At the first shingle that both share, only what follows in the order can be shared as well.
        left = F.least(a - x("place"), b - y("place"))
        return close & (100 * F.least(a, b) >= percent * F.greatest(a, b)) & ((100 + percent) * left >= percent * (a + b))

    def verified(pairs: DataFrame) -> DataFrame:
        own = sets.select("id", "matches", "prefix")
        met = pairs.join(own.toDF("a", "l_a", "p_a"), "a").join(own.toDF("b", "l_b", "p_b"), "b")
        enough = F.size(F.array_intersect("p_a", "p_b")) >= F.least("l_a", "l_b")
        full = sets.select("id", "shingles")
        near = met.where(enough).select("a", "b").join(full.toDF("a", "set_a"), "a").join(full.toDF("b", "set_b"), "b")
        both = F.size(F.array_intersect("set_a", "set_b"))
        return near.where(100 * both >= percent * (F.size("set_a") + F.size("set_b") - both)).select("a", "b")

    roots, _ = connect(members, verified, possible)
    return None if roots is None else roots.select(F.col("node").alias("id"), "root")


def similar_documents(docs: DataFrame, s: JoinSettings = JoinSettings()) -> DataFrame:
    """Per document doc_id, n_shingles, component_id. Runs jobs."""
    placed = written(place_documents(docs, s), "placed")
    sets = placed.where("prefix is not null").select("node", F.col("n_shingles").alias("size"), "matches", "prefix", "places", "shingles", "sketch")
    sets = written(sets.dropDuplicates(["node"]).withColumn("id", F.monotonically_increasing_id()), "sets")
    roots = link_sets(sets, s)
    rows = placed.select("doc_id", "n_shingles", "node")
    if roots is None:
        rows = rows.withColumn("class", F.col("node"))
    else:
        names = sets.select("id", "node")
        named = roots.join(names, "id").join(names.select(F.col("id").alias("root"), F.col("node").alias("class")), "root")
        rows = rows.join(written(named.select("node", "class"), "classes"), "node", "left")
        rows = rows.withColumn("class", F.coalesce("class", "node"))
    rows = written(rows, "rows")
    groups = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    # Written, so that the join can split a group that holds a large share of all rows.
    groups = written(groups.where("n > 1"), "groups")
    return rows.join(groups, "class", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    )
