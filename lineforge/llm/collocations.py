"""Collocations of words from streams of n-gram counts in prefix and in suffix order.

A phrase that occurs ``least`` times consists of parts that occur as often, so an occurrence of an n-gram
needs counting only if both its parts of one word less are frequent. ``census`` counts the fingerprints
of all shorter n-grams and tells every batch which of its own are frequent; that drops most of a corpus
and loses no candidate, since a shared fingerprint can only raise a count. What is left is counted exactly,
by its text: each batch adds up its own phrases and sends them, compressed and dealt by the hash of the
whole phrase, to where they are added up.

The counts, a small part of the corpus, are then two streams: one in prefix order (a phrase's first words)
and one in suffix order (its last words). Every cut of a candidate meets the count of its first part in
the one and of its rest in the other, and longer candidates meet their first and last words in them for
the extension counts. All of these are merge joins of sorted streams; no table of the vocabulary is
held, and a stream with a very frequent word is a stream of its different phrases, whose sorted run
the merge can split.

Scores are exact: ``floor(10^6 * a * a / (l * r))`` in decimals of 38 digits, enough for counts up to 10^16.

Defined results: only A-Z are folded; null texts are empty; a null language is ``und``, joined with
texts so marked; languages without a candidate give no row; repeated rows count as often as they occur;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lineforge.llm.census import expand, pack_batches, squeeze, with_counts
from lineforge.llm.shingles import LOWER, word_hashes
from lineforge.llm.tables import written
from lineforge.llm.text import mix, runs, utf8
from lineforge.storage import shuffle_tasks

# Bytes that end a piece of text, and those that part its words.
BREAKS = np.zeros(256, bool)
BREAKS[[*b".,;:!?", *range(10, 14)]] = True
BLANKS = np.zeros(256, bool)
BLANKS[[9, 32]] = True

NO_LANGUAGE = "und"
_ODD = np.uint64(0x9FB21C651E98DF25)


@dataclass(frozen=True)
class PhraseSettings:
    """Longest phrase, least occurrences, rows per language; a phrase is part of a longer one that
    has ``absorb`` percent of its occurrences."""

    words: int = 3
    least: int = 10
    top: int = 2000
    absorb: int = 50


class _Words:
    """The words of a batch: spans of folded bytes, language, and how far n-grams reach."""

    def __init__(self, table: pa.Table) -> None:
        raw, offsets = utf8(table["text"])
        self.data = LOWER[raw]
        self.starts, self.ends = runs(~(BREAKS | BLANKS)[self.data], offsets)
        row = np.searchsorted(offsets, self.starts, "right") - 1
        langs = table["lang"].combine_chunks().fill_null(NO_LANGUAGE).dictionary_encode()
        self.languages = langs.dictionary
        self.lang = langs.indices.to_numpy()[row].astype(np.int64) if len(row) else np.zeros(0, np.int64)
        # Words of one piece have seen as many breaks before them.
        piece = np.concatenate([[0], np.cumsum(BREAKS[self.data])])[self.starts]
        self.joined = np.zeros(len(row), bool)
        self.joined[1:] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])

    def heads(self, order: int) -> np.ndarray:
        """First words of all n-grams of that order."""
        n = len(self.starts) - order + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        ok = np.ones(n, bool)
        for k in range(1, order):
            ok &= self.joined[k : k + n]
        return np.flatnonzero(ok)

    def fingerprints(self, most: int) -> list[np.ndarray]:
        """Per order up to ``most``, the fingerprint of the n-gram at each of its heads."""
        seeds = [blake2b(x.encode(), digest_size=8).digest() for x in self.languages.to_pylist()]
        seed = np.frombuffer(b"".join(seeds), np.uint64)
        words = word_hashes(self.data, self.starts, self.ends)
        h, out = mix(words ^ seed[self.lang]) if len(words) else words, []
        for order in range(1, most + 1):
            if order > 1:
                h = mix(h[:-1] * _ODD ^ words[order - 1 :])
            out.append(h[self.heads(order)])
        return out


def _distinct(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *parts]), return_counts=True)


def _texts(words: _Words, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Codes of the words at ``places``, equal for equal words, and the words by code."""
    size = words.ends[places] - words.starts[places]
    offsets = np.concatenate([[0], np.cumsum(size)])
    index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - words.starts[places], size)
    taken = pa.LargeStringArray.from_buffers(len(places), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(words.data[index]))
    coded = taken.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _counted(words: _Words, heads: np.ndarray, order: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Language code, text and number of the different n-grams at ``heads``."""
    near = heads[:, None] + np.arange(order)
    used, where = np.unique(near, return_inverse=True)
    code, known = _texts(words, used)
    code = code[where.reshape(near.shape)]
    key = words.lang[heads]
    for k in range(order):
        key = np.unique(key * max(len(known), 1) + code[:, k], return_inverse=True)[1]
    _, one, n = np.unique(key, return_index=True, return_counts=True)
    parts = [known.take(pa.array(code[one, k])) for k in range(order)]
    text = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string())) if order > 1 else parts[0]
    return words.lang[heads[one]], text, n


GRAMS = "lang string, order int, phrase string, n long"

# Groups of phrases per language, each cut to the best rows before the final ranking.
RANKED_APART = 64


def _pack(langs: pa.Array, lang: np.ndarray, text: pa.Array, n: np.ndarray) -> bytes:
    """Counted phrases as one compressed blob: language codes, counts, lengths, letters."""
    data, offsets = utf8(text)
    planes = lambda x: x.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    names = pa.array([langs.to_pylist()], pa.list_(pa.string()))
    parts = [planes(lang), planes(n), planes(np.diff(offsets)), data.tobytes()]
    row = pa.RecordBatch.from_arrays([names, *(pa.array([x], pa.large_binary()) for x in parts)], names=["langs", "lang", "n", "size", "data"])
    return squeeze(row.serialize().to_pybytes(), 3)


_PACKED = pa.schema([("langs", pa.list_(pa.string()))] + [(name, pa.large_binary()) for name in ("lang", "n", "size", "data")])


def _unpack(blob: bytes) -> pa.Table:
    row = pa.ipc.read_record_batch(pa.py_buffer(expand(blob)), _PACKED)
    raw = [np.frombuffer(row.column(i)[0].as_buffer(), np.uint8) for i in range(1, 5)]
    lang, n, size = (np.ascontiguousarray(x.reshape(4, -1).T).view(np.uint32).ravel() for x in raw[:3])
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    text = pa.LargeStringArray.from_buffers(len(n), pa.py_buffer(offsets), pa.py_buffer(raw[3]))
    return pa.table({"lang": row.column(0)[0].values.take(pa.array(lang)), "phrase": text, "n": n.astype(np.int64)})


def count_phrases(docs: DataFrame, s: PhraseSettings) -> DataFrame:
    """(lang, order, phrase, n): exact counts of all frequent phrases; order 0 has all words of a language."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    batches = pack_batches(docs.select(lang, F.col("text").cast("string").alias("text")), "text")
    tasks = shuffle_tasks(docs.sparkSession)
    parts = 4 * tasks

    def fingerprints(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return _distinct(_Words(table).fingerprints(s.words - 1))

    def often(totals: np.ndarray) -> np.ndarray:
        return (totals >= s.least).astype(np.uint8)

    def use(table: pa.Table, known: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
        words = _Words(table)
        n_langs = len(words.languages)
        blank = pa.array([""] * n_langs, pa.large_string())
        found = [(np.arange(n_langs), blank, np.bincount(words.lang, minlength=n_langs))]
        shorter, frequent = words.fingerprints(s.words - 1), None
        for order in range(1, s.words + 1):
            heads = words.heads(order)
            if order < s.words:
                heads = heads[codes[np.searchsorted(known, shorter[order - 1])] == 1]
            else:
                heads = heads[frequent[heads] & frequent[heads + 1]]
            frequent = np.zeros(len(words.starts) + 1, bool)
            frequent[heads] = True
            found.append(_counted(words, heads, order))
        lang = np.concatenate([x[0] for x in found])
        text = pa.concat_arrays([x[1].cast(pa.large_string()) for x in found])
        n = np.concatenate([x[2] for x in found])
        # Every phrase goes to a part of its own hash, whatever its words.
        data, offsets = utf8(text)
        part = ((word_hashes(data, offsets[:-1], offsets[1:]) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        text = text.take(pa.array(order))
        own, first = np.unique(part[order], return_index=True)
        last = np.append(first[1:], len(order))
        blobs = [_pack(words.languages, lang[order[i:j]], text.slice(i, j - i), n[order[i:j]]) for i, j in zip(first, last, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(own), pa.array(blobs, pa.binary())], names=["part", "payload"])

    def add_up(part: int, blobs: list[bytes]) -> pa.RecordBatch:
        total = pa.concat_tables([_unpack(b) for b in blobs]).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        order = pc.if_else(
            pc.equal(total["phrase"], ""), 0, pc.add(pc.count_substring(total["phrase"], " "), 1)
        ).cast(pa.int32())
        total = pa.table({"lang": total["lang"].cast(pa.string()), "order": order, "phrase": total["phrase"].cast(pa.string()), "n": total["n_sum"]})
        kept = total.filter(pc.or_(pc.equal(total["order"], 0), pc.greater_equal(total["n"], s.least)))
        return kept.combine_chunks().to_batches()[0] if kept.num_rows else pa.RecordBatch.from_pylist([], kept.schema)

    def gather(chunks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for chunk in chunks:
            for part, blob in zip(chunk.column(0).to_pylist(), chunk.column(1), strict=True):
                if held and part != at:
                    yield add_up(at, held)
                    held = []
                at = part
                held.append(blob.as_py())
        if held:
            yield add_up(at, held)

    local = with_counts(batches, fingerprints, often, use, "part int, payload binary")
    return local.repartition(tasks, "part").sortWithinPartitions("part").mapInArrow(gather, GRAMS)


def _merge(left: DataFrame, stream: DataFrame, how: str = "inner") -> DataFrame:
    return left.join(stream.hint("merge"), ["lang", "phrase"], how)


def _score(a: Column, left: Column, right: Column) -> Column:
    whole = [F.col(c).cast("decimal(38,0)") for c in ("a", "l", "r")]
    top = F.lit(1_000_000).cast("decimal(38,0)") * whole[0] * whole[0]
    return F.call_function("div", top, whole[1] * whole[2])


def collocations(docs: DataFrame, s: PhraseSettings = PhraseSettings()) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases. Runs jobs."""
    grams = written(count_phrases(docs, s), "phrases")
    stream = grams.where("order > 0").select("lang", "phrase", F.col("n").alias("f"))
    candidates = grams.where("order > 1").select("lang", "phrase", "order", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    joined = lambda start, size: F.array_join(F.slice("w", start, size), " ")

    # Every cut after the first k words: the first part's count in prefix order, the rest's in suffix order.
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("order") - 1)))
    cuts = cuts.select("lang", F.col("phrase").alias("whole"), "a", "k", joined(F.lit(1), F.col("k")).alias("phrase"), joined(F.col("k") + 1, F.col("order") - F.col("k")).alias("rest"))
    first = _merge(cuts, stream).select("lang", "whole", "a", "k", F.col("f").alias("l"), F.col("rest").alias("phrase"))
    both = _merge(first, stream).select("lang", F.col("whole").alias("phrase"), "a", "k", "l", F.col("f").alias("r"))
    scored = both.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))

    # Extension counts: the most frequent longer candidate by one word, after a phrase or before it.
    longer = candidates.where("order > 2")
    ends = F.array(joined(F.lit(1), F.col("order") - 1), joined(F.lit(2), F.col("order") - 1))
    longer = longer.select("lang", "a", F.explode(ends).alias("phrase")).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = _merge(lowest, longer, "left").where(F.coalesce(100 * F.col("longer") < s.absorb * F.col("a"), F.lit(True)))

    totals = grams.where("order = 0").select("lang", F.col("n").cast("long").alias("n"))
    # The best of each group first, so that the last ranking of a language reads a bounded number of rows.
    best = [F.desc("cut.score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("group", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_APART)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*best))).where(F.col("rank") <= s.top)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= s.top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score")
    )
