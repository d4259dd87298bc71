"""Linked documents against all pairs of plain sets."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from lineforge.llm import minhash, ngram_join
from lineforge.llm.ngram_join import JoinSettings, choose_matches, frequency_code
from lineforge.llm.shingles import word_hashes

DOCS = "doc_id long, text string, lang string, n_shingles long, node binary, bucket long, size long, class string, id long, root long"


def rows_of(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", 1, b"x", 2, 3, "c", 4, 5) for i, t in zip(ids, texts, strict=True)], DOCS)


def plain_sets(texts, width):
    sets = []
    for text in texts:
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", folded)
        n = max(1, len(words) - width + 1) if words else 0
        sets.append({tuple(words[i : i + width]) for i in range(n)})
    return sets


def all_pairs(texts, width, percent):
    """(size, component) by place of the text."""
    sets = plain_sets(texts, width)
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def near_copies(seed, n_words, n):
    """Groups of texts with few edits on a small vocabulary, shared passages, short texts and copies."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(n_words)}"
    passage = [word() for _ in range(40)]
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rng.choice([3, 8, 25, 60, 120]))]
        if rng.random() < 0.4:
            base += passage
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return [None, "", " \n", "one", "ONE", "one two", "One\ttwo", *texts, " ".join(passage), "Ä b c", "ä b c"]


@pytest.mark.parametrize(
    ("settings", "n_words"),
    [
        (JoinSettings(width=3, percent=90), 400),
        (JoinSettings(), 60),
        # Dear comparisons, so that prefixes grow and several matches are asked for.
        (JoinSettings(width=2, percent=70, shingles_per_lookup=1), 25),
        (JoinSettings(width=1, percent=60, most_matches=20, shingles_per_lookup=1), 200),
    ],
)
def test_components_are_those_of_all_pairs(spark, settings, n_words):
    texts = near_copies(settings.percent, n_words, 90)
    got = ngram_join.similar_documents(rows_of(spark, texts).repartition(5), settings)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()}
    want = all_pairs(texts, settings.width, settings.percent)
    assert [found[i] for i in range(len(texts))] == want
    assert len({c for _, c in want}) < len(texts) - 20


def test_long_texts_and_one_word_apart(spark):
    words = [f"n{i}" for i in range(30_000)]
    other = words[:]
    other[::400] = ["x"] * len(other[::400])
    far = words[:]
    far[::20] = ["y"] * len(far[::20])
    texts = [" ".join(x) for x in (words, other, far)]
    got = {r.doc_id: r.component_id for r in ngram_join.similar_documents(rows_of(spark, texts), JoinSettings(3, 90)).collect()}
    assert got == {i: c for i, (_, c) in enumerate(all_pairs(texts, 3, 90))}


def test_ids_and_empty_tables(spark):
    texts = ["a b c d", "a b c d", "a b c d", "", None, "z"]
    rows = rows_of(spark, texts, [7, None, 7, 3, None, 9])
    got = sorted((tuple(r) for r in ngram_join.similar_documents(rows, JoinSettings(3, 90)).collect()), key=repr)
    assert got == sorted([(7, 2, 7), (None, 2, 7), (7, 2, 7), (3, 0, 3), (None, 0, None), (9, 1, 9)], key=repr)
    assert ngram_join.similar_documents(rows.limit(0)).isEmpty()


def test_a_longer_prefix_asks_for_as_many_matches():
    """Whatever length each set chooses, linked sets share the smaller number of matches in their prefixes."""
    rng = np.random.default_rng(5)
    s = JoinSettings(width=1, percent=70, most_matches=12, shingles_per_lookup=1)
    counts = rng.zipf(1.3, 400).clip(1, 5000) + 1
    codes = frequency_code(counts)
    chosen = set()
    for _ in range(400):
        a = rng.choice(400, rng.integers(5, 90), replace=False)
        b = np.union1d(rng.choice(a, len(a) - rng.integers(0, max(1, len(a) // 8)), replace=False), rng.choice(400, rng.integers(0, 4)))
        both = len(np.intersect1d(a, b))
        if 100 * both < s.percent * (len(a) + len(b) - both):
            continue
        prefixes = []
        for x in (a, b):
            order = x[np.lexsort((x, codes[x]))]
            matches, length = choose_matches(codes[order], len(x), -(-s.percent * len(x) // 100), s)
            prefixes.append((matches, set(order[:length].tolist())))
            chosen.add(matches)
        (l, x), (m, y) = prefixes
        assert len(x & y) >= min(l, m)
    assert len(chosen) > 2


def test_regular_words_have_different_hashes():
    """Words on which polynomial hashes modulo 2^64 agree."""
    one, two = b"a", b"b"
    for _ in range(10):
        one, two = one + two, two + one
    data = np.frombuffer(one + two + b"a" * 64 + b"a" * 65, np.uint8)
    ends = np.cumsum([1024, 1024, 64, 65])
    assert len(set(word_hashes(data, ends - [1024, 1024, 64, 65], ends).tolist())) == 4


def test_regular_words_are_not_linked(spark):
    one, two = "a", "b"
    for _ in range(10):
        one, two = one + two, two + one
    rows = rows_of(spark, [one, two])
    assert {r.component_id for r in ngram_join.similar_documents(rows, JoinSettings(3, 90)).collect()} == {0, 1}
    assert {r.component_id for r in minhash.mark_near_copies(rows).collect()} == {0, 1}
