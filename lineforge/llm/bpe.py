"""Byte-level BPE by longest matches and backtracking, without running the merges of each text.

Bytes are mapped to Latin-1 characters, so that ``pyahocorasick`` can hold the vocabulary as an
automaton of strings. A word's encoding is the one sequence of tokens in which every two neighbours
are *compatible*: merging the bytes of both yields exactly those two tokens. So the encoder walks
forward with the longest token at each place, checks it against its left neighbour, falls back to
the next shorter token, and steps back where none fits; places that proved dead are remembered,
which keeps the walk linear. Compatibility of a pair is computed once by real merges of those few
bytes and memoised. Words that are whole tokens are those tokens, as in the merging original.

Words repeat, so each worker process keeps the ids of up to ``KEPT_WORDS`` of them; the store is
emptied when full, which costs time but never changes a result. The automaton and the stores belong
to a process, not to a task, and depend on the vocabulary file alone.

Defined results: a null text counts as empty and has no ids; the empty text decodes to no bytes;
equal rows and null or repeated ``doc_id`` are encoded row by row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineforge.llm.tokens import PATTERN, read_ranks

KEPT_WORDS = 600_000
KEPT_PAIRS = 2_000_000
# Longer words are encoded but not kept.
KEPT_LENGTH = 64


class BytePairCoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.split = regex.compile(pattern).findall
        self._pairs: dict[tuple[int, int], bool] = {}
        self._words: dict[str, tuple[int, ...]] = {}
        # Only tokens that merges can produce may stand next to others.
        made = [(token, rank) for token, rank in ranks.items() if self.merge(token) == [rank]]
        self._automaton = ahocorasick.Automaton()
        for token, rank in made:
            self._automaton.add_word(token.decode("latin-1"), (len(token), rank))
        self._automaton.make_automaton()

    def merge(self, raw: bytes) -> list[int]:
        """The defining procedure: always merge the adjacent pair of lowest rank, leftmost first."""
        get, never = self.ranks.get, 1 << 62
        parts = [raw[i : i + 1] for i in range(len(raw))]
        pairs = [get(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (rank := min(pairs)) != never:
            at = pairs.index(rank)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = get(parts[at - 1] + parts[at], never)
            if at < len(pairs):
                pairs[at] = get(parts[at] + parts[at + 1], never)
        return [self.ranks[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        found = self._pairs.get((left, right))
        if found is None:
            if len(self._pairs) >= KEPT_PAIRS:
                self._pairs.clear()
            found = self.merge(self.tokens[left] + self.tokens[right]) == [left, right]
            self._pairs[left, right] = found
        return found

    def word(self, word: str) -> tuple[int, ...]:
        raw = word.encode("utf-8", "surrogatepass")
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        text = raw.decode("latin-1")
        # Per start, the tokens there; the automaton reports by end, so shorter ones come first.
        at: list[list[tuple[int, int]]] = [[] for _ in text]
        for end, match in self._automaton.iter(text):
            at[end + 1 - match[0]].append(match)
        ids: list[int] = []
        tried: list[int] = []  # per chosen token, how many at its start are left untried
        dead = bytearray(len(text) + 1)
        place, left = 0, len(at[0])
        while place < len(text):
            chosen = None
            while left:
                left -= 1
                length, rank = at[place][left]
                if not dead[place + length] and (not ids or self.compatible(ids[-1], rank)):
                    chosen = (length, rank)
                    break
            if chosen:
                ids.append(chosen[1])
                tried.append(left)
                place += chosen[0]
                left = len(at[place]) if place < len(text) else 0
            else:
                # A place is dead for every left neighbour: the prefix before it has one encoding.
                dead[place] = 1
                place -= len(self.tokens[ids.pop()])
                left = tried.pop()
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        words, out = self._words, []
        for word in self.split(text):
            ids = words.get(word)
            if ids is None:
                ids = self.word(word)
                if len(word) <= KEPT_LENGTH:
                    if len(words) >= KEPT_WORDS:
                        words.clear()
                    words[word] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache
def coder(path: str) -> BytePairCoder:
    return BytePairCoder(read_ranks(path))


def encode_documents(docs: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (the token ids of the whole text)."""
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        lambda batches: (
            pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([coder(ranks_path).encode(t or "") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))],
                names=["doc_id", "ids"],
            )
            for batch in batches
        ),
        docs.select("doc_id").schema.add("ids", T.ArrayType(T.IntegerType())),
    )


def round_trip(docs: DataFrame, ranks_path: str) -> DataFrame:
    """Encode every text, decode the ids: their number, a digest of them, a digest of the bytes.

    Ids are digested where they are made, row by row, so no column of ids is ever built.
    """
    schema = docs.select("doc_id").schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path)
        for batch in batches:
            count, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = own.encode(text.as_py() or "")
                count.append(len(ids))
                coded.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(own.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(count, pa.int64()), pa.array(coded), pa.array(decoded)], names=schema.names
            )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(digest, schema)
