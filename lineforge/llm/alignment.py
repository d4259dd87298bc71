"""Alignment of two tokenizers by bytes, and corpus counts of their linked token pairs.

Tokenizer A is a byte-level vocabulary in JSON, B a piece model with byte fallback. Both cut the bytes of
space + text; where both end a token, a group ends, and the two tokens that end there are linked. A group
of one A token and one B token has the same bytes on both sides, so a vocabulary-long array, A id to the B
id of the same bytes, already names the pair: such groups are counted in vectors as long as A's
vocabulary. Only the other groups' links are counted as pairs, added up per task before their shuffle.

Of two tokens that end together, the shorter one's bytes end the longer one. So the pairs that can
be linked at all follow from the vocabularies, no more than the letters in both, and every link is
stored as one int: an A id for a group that the array names, else a number of such a pair. Counts of all
pairs are therefore bounded by the vocabularies and may be broadcast, whatever the corpus. Texts are
encoded once; their links are written, compressed, and read twice, to be counted and to be looked up.

Defined results: special tokens' strings are ordinary text; null or empty texts, and texts that the
tokens of A or B do not spell, have no tokens: zeros and an empty digest; a text of any length is aligned
as a whole; repeated rows count as often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineforge.llm.tables import written
from lineforge.llm.text import row_slices
from lineforge.llm.tokens import byte_symbols, fast_tokenizer

# Texts are encoded in runs of about so many letters.
RUN = 1 << 20

# Digits of an id, and the mark after it.
_WIDTH = 8


class _Side:
    """A vocabulary: the bytes of its tokens, their lengths, their ids as digits."""

    def __init__(self, tokens: list[bytes]) -> None:
        self.tokens = tokens
        self.size = np.array([len(t) for t in tokens], np.int64)
        digits = [str(i).encode() for i in range(len(tokens))]
        self.n_digits = np.array([len(d) for d in digits], np.int64)
        self.digits = np.frombuffer(b"".join(d.ljust(_WIDTH, b"\0") for d in digits), np.uint8).reshape(-1, _WIDTH)

    def spells(self, ids: np.ndarray, raw: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids.tolist())) == raw


class Alignment:
    """Both vocabularies, the identity array, and the pairs that can end together."""

    def __init__(self, path_a: str, path_b: str) -> None:
        with open(path_a, encoding="utf-8") as file:
            model = json.load(file)
        symbols = byte_symbols()
        entries = dict(model["model"]["vocab"]) | {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        added = {t["content"] for t in model.get("added_tokens", [])}
        tokens = [b""] * (max(entries.values()) + 1)
        for token, i in entries.items():
            tokens[i] = token.encode() if token in added else bytes(symbols[c] for c in token)
        self.a = _Side(tokens)
        self.encode_a = fast_tokenizer(path_a, True)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.b = _Side([self._piece(i) for i in range(self.pieces.get_piece_size())])
        by_bytes: dict[bytes, list[int]] = {}
        for i, token in enumerate(self.b.tokens):
            by_bytes.setdefault(token, []).append(i)
        # The same bytes may also stand as a byte fallback; a piece proper is the usual one.
        same = [by_bytes.get(token, [-1]) if token else [-1] for token in self.a.tokens]
        self.identity = np.array([ids[-1] for ids in same], np.int64)
        pairs = set()
        for i, token in enumerate(self.a.tokens):
            for k in range(len(token)):
                pairs.update((i, j) for j in by_bytes.get(token[k:], ()))
        by_a: dict[bytes, list[int]] = {}
        for i, token in enumerate(self.a.tokens):
            by_a.setdefault(token, []).append(i)
        for j, token in enumerate(self.b.tokens):
            for k in range(len(token)):
                pairs.update((i, j) for i in by_a.get(token[k:], ()))
        n_b = len(self.b.tokens)
        self.pairs = np.array(sorted(i * n_b + j for i, j in pairs), np.int64)
        # What a link's number stands for, A ids first.
        self.pair_a = np.concatenate([np.arange(len(self.a.tokens)), self.pairs // n_b])
        self.pair_b = np.concatenate([self.identity, self.pairs % n_b])

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, text: str, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of A and B, and the places of the last A and B token of each group; None if a side spells another text."""
        raw = f" {text}".encode()
        a = self.encode_a(f" {text}").astype(np.int64)
        if not self.a.spells(a, raw) or not self.b.spells(b, raw):
            return None
        ends_a, ends_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[at] == ends_a)
        return a, b, last_a, at[last_a]

    def links(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> np.ndarray:
        """One number per group: the A id if the identity array names its pair, else that of the pair."""
        single = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1)
        x, y = a[last_a], b[last_b]
        named = single & (self.identity[x] == y)
        pair = np.searchsorted(self.pairs, x * len(self.b.tokens) + y) + len(self.a.tokens)
        return np.where(named, x, pair).astype(np.int32)

    def digest(self, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray) -> str:
        """Of ``a1,a2|b1;a3|b2,b3``: ids in order, groups parted by semicolons."""
        n_a, n_b = len(a), len(b)
        out = np.empty((n_a + n_b, _WIDTH), np.uint8)
        size = np.empty(n_a + n_b, np.int64)
        mark = np.full(n_a + n_b, ord(","), np.uint8)
        # A token comes after the B tokens of all groups before its own, a B token after the A tokens of its group too.
        group_a = np.searchsorted(last_a, np.arange(n_a))
        group_b = np.searchsorted(last_b, np.arange(n_b))
        to_a = np.arange(n_a) + np.concatenate([[0], last_b + 1])[group_a]
        to_b = np.arange(n_b) + last_a[group_b] + 1
        out[to_a], out[to_b] = self.a.digits[a], self.b.digits[b]
        size[to_a], size[to_b] = self.a.n_digits[a], self.b.n_digits[b]
        mark[to_a[last_a]], mark[to_b[last_b]] = ord("|"), ord(";")
        out[np.arange(n_a + n_b), size] = mark
        used = np.arange(_WIDTH) <= size[:, None]
        return sha256(out[used][:-1].tobytes()).hexdigest()


@lru_cache
def alignment(path_a: str, path_b: str) -> Alignment:
    """One per worker process."""
    return Alignment(path_a, path_b)


ALIGNED = "doc_id {id}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document the sizes and digest of its groups, and its links, compressed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, squeeze = alignment(path_a, path_b), zstandard.ZstdCompressor(level=1).compress
        nothing = (0, 0, 0, "", b"")
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            offsets = np.cumsum([0, *map(len, texts)])
            for first, last in row_slices(offsets, RUN):
                rows = []
                for text, b in zip(texts[first:last], both.pieces.encode(texts[first:last], num_threads=1), strict=True):
                    found = both.align(text, np.array(b, np.int64)) if text else None
                    if found is None:
                        rows.append(nothing)
                        continue
                    links = both.links(*found)
                    rows.append((len(found[0]), len(b), len(links), both.digest(*found), squeeze(links.tobytes())))
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        *(pa.array(c, pa.int64()) for c in columns[:3]),
                        pa.array(columns[3], pa.string()),
                        pa.array(columns[4], pa.binary()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"],
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(encode, ALIGNED.format(id=kind))


def _links_of(column: pa.Array) -> list[np.ndarray]:
    expand = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(expand(x.as_py()), np.int32) if len(x.as_py()) else np.zeros(0, np.int32) for x in column]


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each pair; at most one row per possible pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = alignment(path_a, path_b)
        totals = np.zeros(len(both.pair_a), np.int64)
        for batch in batches:
            for links in _links_of(batch.column(0)):
                np.add.at(totals, links, 1)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays(
            [pa.array(both.pair_a[seen]), pa.array(both.pair_b[seen]), pa.array(totals[seen])], names=["a", "b", "n"]
        )

    local = aligned.select("links").mapInArrow(count, "a long, b long, n long")
    return local.groupBy("a", "b").agg(F.sum("n").alias("n"))


def score_alignment(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per document doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. Runs jobs."""
    spark = docs.sparkSession
    aligned = written(align_documents(docs, path_a, path_b), "aligned")
    counted = pair_counts(aligned, path_a, path_b).toArrow()
    shared = spark.sparkContext.broadcast([counted[c].to_numpy() for c in ("a", "b", "n")])
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = alignment(path_a, path_b)
        a, b, n = shared.value
        n_b = len(both.b.tokens)
        most = np.zeros(n_b, np.int64)
        np.maximum.at(most, b, n)
        # By the number that a link is stored as; the pair of an A id is the same as that pair's own number.
        known = dict(zip((a * n_b + b).tolist(), n.tolist(), strict=True))
        total = np.array([known.get(p, 0) for p in (both.pair_a * n_b + both.pair_b).tolist()], np.int64)
        best = (total == most[both.pair_b]).astype(np.int64)
        for batch in batches:
            links = _links_of(batch.column(5))
            n_links, sums, bests = ([f(x) for x in links] for f in (len, lambda x: total[x].sum(), lambda x: best[x].sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:4],
                    *(pa.array(np.array(c, np.int64)) for c in (n_links, bests, sums)),
                    batch.column(4),
                ],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )

    return aligned.mapInArrow(look_up, schema)
