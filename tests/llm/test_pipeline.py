"""The whole pipeline, and its classifier, against plain programs on a small table."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lineforge.llm import quality
from lineforge.llm.quality import QualitySettings
from lineforge.llm.secrets import RULES
from lineforge.llm.text import PIECE

MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


# --- features by hand -----------------------------------------------------------------------


def mix(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & MASK
    return x ^ (x >> 31)


def word_hash(word):
    total = sum((b + 1) * pow(BASE, i, 1 << 64) for i, b in enumerate(word))
    return mix((total + len(word)) & MASK)


def features(text, buckets):
    """Counts of hashed n-grams and the number of tokens, token by token."""
    tokens = re.findall(rb"[0-9A-Za-z\x80-\xff]+|[^\x00-\x20\x7f0-9A-Za-z\x80-\xff]+", (text or "").encode())
    words, shapes = [], []
    for token in tokens:
        word = word_hash(bytes(b + 32 if 65 <= b <= 90 else b for b in token))
        capitals, small = sum(65 <= b <= 90 for b in token), sum(97 <= b <= 122 or b >= 128 for b in token)
        if not re.match(rb"[0-9A-Za-z\x80-\xff]", token):
            shape = word | 8
        elif not capitals and not small:
            shape = 1
        elif not capitals:
            shape = 2
        elif not small:
            shape = 3
        else:
            shape = 4 if 65 <= token[0] <= 90 and capitals == 1 else 5
        if words and words[-1] == word:
            shape = (shape + (1 << 40)) & MASK
        words.append(word)
        shapes.append(shape)
    counts = Counter()
    for seed, (parts, n) in enumerate([(words, 1), (words, 2), (shapes, 1), (shapes, 2), (shapes, 3)]):
        for i in range(len(parts) - n + 1):
            h = 0xA0761D6478BD642F + 0x1000193 * seed
            for part in parts[i : i + n]:
                h = mix(h ^ part)
            counts[h & (buckets - 1)] += 1
    return counts, len(tokens)


def awkward_texts(n, seed):
    rng = random.Random(seed)
    parts = ["Word", "word", "WORD", "wOrd", "42", "4x", "naïve", "日本", "!!", "...", "-", " ", " ", " ", "\n", "\t", "\x7f", "\x00", "the the"]
    return [None, "", " \n", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 80))) for _ in range(n))]


def test_both_forms_of_the_features_are_those_by_hand(spark):
    s = QualitySettings()
    texts = awkward_texts(80, 1)
    rng = np.random.default_rng(4)
    weights = rng.normal(size=s.buckets + 1)
    wanted = [features(t, s.buckets) for t in texts]
    for (index, value), (counts, total) in zip(quality.sparse_rows(pa.array(texts), s), wanted, strict=True):
        assert index.tolist() == sorted(counts)
        assert np.allclose(value, [counts[b] * s.scale / max(total, 1) for b in sorted(counts)], rtol=1e-12)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, weights, s).collect()}
    for i, (counts, total) in enumerate(wanted):
        dot = weights[-1] + sum(weights[b] * c for b, c in counts.items()) * s.scale / max(total, 1)
        assert abs(scores[i] - quality.sigmoid(dot)) < 1e-9


def test_very_long_text_is_the_sum_of_its_tokens():
    """Beyond a piece, n-grams that cross a cut are the only ones a text may miss."""
    text = "alpha beta Gamma 7 . " * (3 * PIECE // 21)
    s = QualitySettings(buckets=1 << 12)
    ((index, value),) = quality.sparse_rows(pa.array([text]), s)
    counts, total = features("alpha beta Gamma 7 . " * 50, s.buckets)
    assert set(index.tolist()) == set(counts)
    assert abs(value.sum() - 5 * s.scale) < 0.01


def test_training_is_ftrl_row_by_row():
    s = QualitySettings(buckets=1 << 10, epochs=3)
    texts = [t or "x" for t in awkward_texts(40, 2)]
    labels = np.random.default_rng(5).integers(0, 2, len(texts)).astype(float)
    rows = quality.sparse_rows(pa.array(texts), s)
    z, n = Counter(), Counter()

    def weight(i):
        if abs(z[i]) <= s.l1:
            return 0.0
        return -(z[i] - np.sign(z[i]) * s.l1) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for r in order.permutation(len(rows)):
            counts, total = features(texts[r], s.buckets)
            x = {b: c * s.scale / max(total, 1) for b, c in counts.items()} | {s.buckets: 1.0}
            w = {i: weight(i) for i in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
            for i, v in x.items():
                g = (p - labels[r]) * v
                z[i] += g - ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / s.alpha * w[i]
                n[i] += g * g
    trained = quality.train_ftrl(rows, labels, s)
    assert np.allclose(trained, [weight(i) for i in range(s.buckets + 1)], atol=1e-9)
    assert np.count_nonzero(trained) > 100


# --- all stages by hand ---------------------------------------------------------------------


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def classes(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def without_repeated_lines(rows):
    known = sorted({line for _, t in rows for line in (t or "").split("\n") if line})
    near = ((i, j) for (i, a), (j, b) in combinations(enumerate(known), 2) if min(len(a), len(b)) >= 30 and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2)
    of = dict(zip(known, classes(len(known), near), strict=True))
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            if not line or of[line] not in seen:
                kept.append(line)
            if line:
                seen.add(of[line])
        out.append((i, None if text is None else "\n".join(kept)))
    return out


def without_near_copies(rows):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    linked = [(i, j) for i, j in combinations(range(len(rows)), 2) if (both := len(sets[i] & sets[j])) and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both)]
    root = classes(len(rows), linked)
    return [row for i, row in enumerate(rows) if root[i] == i]


def without_secrets(text):
    spans = sorted((m.start(), m.end()) for r in RULES for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least)
    out, at = [], 0
    for start, stop in spans:
        if start >= at:
            out += [text[at:start], "[secret]"]
        at = max(at, stop)
    return None if text is None else "".join(out) + text[at:]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Prose, junk, near and exact copies, shared and slightly changed lines, secrets, awkward rows."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def sentence():
        words = [rng.choice(vocabulary) for _ in range(rng.randint(6, 14))]
        return " ".join(words).capitalize() + "."

    shared = [sentence() for _ in range(6)]
    texts, labels = [], []
    for k in range(150):
        if k % 3 == 0:
            texts.append(" ".join(rng.choice(["!!!", "$$$", "CLICK", "999", "BUY", "#", ">>>"]) for _ in range(rng.randint(10, 60))))
            labels.append(0)
            continue
        lines = [sentence() for _ in range(rng.randint(1, 9))]
        if rng.random() < 0.5:
            line = list(rng.choice(shared))
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                line[rng.randrange(len(line))] = rng.choice("xyz")
            lines.insert(rng.randrange(len(lines) + 1), "".join(line))
        if rng.random() < 0.2:
            lines.append(f"The password=hunter{k}00 is known, and so is AKIA{'Q' * 18}.")
        if rng.random() < 0.2:
            lines.append("All rights reserved.")
        text = "\n".join(lines)
        if rng.random() < 0.25 and k > 20:
            # As one line, which no other line is near to.
            words = texts[k - 1 - (k % 3 == 1)].split()
            words[rng.randrange(len(words))] = "altered"
            text = " ".join(words)
        texts.append(text)
        labels.append(1)
    texts += [None, "", "\n\n", "naïve Zürich 日本語 <|endoftext|> prose with a few more words to read in it.", texts[1], texts[1]]
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
    marked = [(i, q, 0) for i, q in enumerate(labels)]
    spark.createDataFrame(marked, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_run_is_the_plain_pipeline(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    weights = quality.fit_quality(quality.training_rows(docs, labels))
    s = QualitySettings()
    rows = []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        counts, total = features(r.text, s.buckets)
        dot = weights[-1] + sum(weights[b] * c for b, c in counts.items()) * s.scale / max(total, 1)
        if quality.sigmoid(dot) >= s.threshold:
            rows.append((r.doc_id, r.text))
    assert 60 < len(rows) < 120
    lines = without_repeated_lines(rows)
    assert lines != rows
    near = without_near_copies(lines)
    assert len(near) < len(lines)
    clean = [(i, without_secrets(t)) for i, t in near]
    assert clean != near

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*plain.encode(t or "", add_special_tokens=False).ids, 1] for i, t in clean}
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in pieces} == set(ids)
    sequences = {}
    for i, own in ids.items():
        at = 0
        for r in sorted((r for r in pieces if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(own))
            assert r.ids_crc32 == zlib.crc32(np.array(own[at : at + r.length], "<u4").tobytes())
            at += r.length
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert at == len(own)
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
        # Padded to 2,048, except at a power of two.
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 0.05 * sum(map(len, ids.values()))


def test_stage_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality classifier", "line dedup", "near-duplicates", "secret scan", "packing"]
