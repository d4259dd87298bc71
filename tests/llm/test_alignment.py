"""Tokenizer alignment against a plain program over the same libraries."""

from __future__ import annotations

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from lineforge.llm import alignment
from lineforge.llm.tokens import byte_symbols, fast_tokenizer

PATHS = tuple(public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, links binary, n_a long, a long, b long, n long"


def program(texts):
    """Per text the tokens of both sides as (id, end), groups and links; then counts over all."""
    slow = Tokenizer.from_file(PATHS[0])
    slow.encode_special_tokens = True
    vocab, symbols = json.load(open(PATHS[0], encoding="utf-8"))["model"]["vocab"], byte_symbols()
    bytes_a = {i: bytes(symbols[c] for c in t) for t, i in vocab.items() if t != "<|endoftext|>"}
    pieces = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])

    def bytes_b(i):
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    rows = []
    for text in texts:
        raw = f" {text}".encode()
        a = slow.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if not text or b"".join(bytes_a[i] for i in a) != raw or b"".join(map(bytes_b, b)) != raw:
            rows.append((0, 0, [], []))
            continue
        ends_a = np.cumsum([len(bytes_a[i]) for i in a]).tolist()
        ends_b = np.cumsum([len(bytes_b(i)) for i in b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        rows.append((len(a), len(b), groups, links))
    counts = Counter(link for r in rows for link in r[3])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [
        (
            n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in rows
    ]


def rows_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", "s", 1, b"x", 7, 7, 7, 7) for i, t in zip(ids, texts, strict=True)], DOCS)


def awkward_texts():
    rng = random.Random(3)
    parts = ["the ", "  ", "\n\n", "don't", "naïve", "日本語", "\U0001f600", "\x00", "<s>", "</s>", "<|endoftext|>", "▁", "<0x41>", "�", "a" * 40, "\t", "ẞß", "1234567", "\x85", " ", "Zürich"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(120)]
    return [None, "", " ", "  x", "tie", "tie", "the cat sat on the mat", *texts, "word and other words " * 20_000]


def test_alignment_of_awkward_texts(spark):
    texts = awkward_texts()
    got = alignment.score_alignment(rows_of(spark, texts).repartition(3), *PATHS)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    found = {r.doc_id: tuple(r)[1:] for r in got.collect()}
    assert [found[i] for i in range(len(texts))] == program(texts)


def test_alignment_of_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    found = {r.doc_id: tuple(r)[1:] for r in alignment.score_alignment(docs, *PATHS).collect()}
    assert [found[r.doc_id] for r in rows] == program([r.text for r in rows])


def test_repeated_and_null_ids_and_nothing(spark):
    docs = rows_of(spark, ["one text", "one text", "another"], [1, 1, None])
    got = sorted((tuple(r) for r in alignment.score_alignment(docs, *PATHS).collect()), key=repr)
    want = program(["one text", "one text", "another"])
    assert got == sorted([(1, *want[0]), (1, *want[1]), (None, *want[2])], key=repr)
    assert alignment.score_alignment(docs.limit(0), *PATHS).isEmpty()


def test_identity_array_and_bounded_pairs():
    both = alignment.alignment(*PATHS)
    named = np.flatnonzero(both.identity >= 0)
    assert len(named) > 10_000
    assert all(both.a.tokens[i] == both.b.tokens[both.identity[i]] for i in named)
    # Whatever can end together: one side's bytes end the other's.
    letters = sum(map(len, both.a.tokens)) + sum(map(len, both.b.tokens))
    assert len(both.pairs) <= 2 * letters
    for i in random.Random(1).sample(range(len(both.pairs)), 2000):
        a, b = divmod(int(both.pairs[i]), len(both.b.tokens))
        x, y = both.a.tokens[a], both.b.tokens[b]
        assert x.endswith(y) or y.endswith(x)


@pytest.mark.parametrize("special_as_text", [False, True])
def test_fast_tokenizer_is_the_slow_one(special_as_text):
    """Over all characters of the fast ranges, alone and between others, and on special strings."""
    slow = Tokenizer.from_file(PATHS[0])
    slow.encode_special_tokens = special_as_text
    fast = fast_tokenizer(PATHS[0], special_as_text)
    ranges = [*range(0x250), *range(0x2000, 0x2070)]
    texts = [f(chr(c)) for c in ranges for f in (str, lambda x: f"a{x}b", lambda x: f" {x} {x}1", lambda x: f"\n{x}{x} .")]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "", "日本 x", "don't won't'S"]
    for text in texts:
        assert fast(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)
