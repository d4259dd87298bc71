"""Collocations against a plain program with Python's integers."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lineforge.llm import collocations
from lineforge.llm.collocations import PhraseSettings

DOCS = "doc_id long, text string, lang string, phrase string, n long, f long, rank long, w string"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, lang, "p", 1, 2, 3, "w") for i, (t, lang) in enumerate(rows)], DOCS)


def program(rows, s):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, s.words + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = [p for p, a in f.items() if len(p) > 1 and a >= s.least]
        inside = defaultdict(int)
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], f[p])
        kept = []
        for p in candidates:
            a = f[p]
            if p in inside and 100 * inside[p] >= s.absorb * a:
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def awkward_rows():
    rng = random.Random(8)
    words = ["a", "B", "b", "new", "New", "york", "city", "é", "É", "x\x0by", "o'clock", "日本", "語", "\x1f", "w" * 70, "w" * 71]
    joints = [" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "!"]
    rows = []
    for _ in range(250):
        text = "".join(rng.choice(words[: rng.choice([3, 16])]) + rng.choice(joints) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    rows += [(None, "en"), ("", None), (" . , ", "fr"), ("alone", "xx"), ("to be or not " * 9000, "en")]
    return rows + rows[:20]


@pytest.mark.parametrize(
    "s",
    [PhraseSettings(), PhraseSettings(least=2, top=7), PhraseSettings(words=2, least=1), PhraseSettings(words=5, least=4, absorb=90)],
)
def test_phrases_are_those_of_the_program(spark, s):
    rows = awkward_rows()
    got = collocations.collocations(rows_of(spark, rows).repartition(4), s)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == program(rows, s)


def test_documents(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    assert sorted(map(tuple, collocations.collocations(docs).collect())) == program(rows, PhraseSettings())


def test_nothing(spark):
    assert collocations.collocations(rows_of(spark, [("x", "en")]).limit(0)).isEmpty()
    assert collocations.collocations(rows_of(spark, [(None, None), (".", "en")])).isEmpty()


def test_scores_beyond_64_bits(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(300):
        left, right = (int(x) for x in rng.integers(10**13, 10**15, 2))
        rows.append((int(rng.integers(1, min(left, right))), left, right))
    df = spark.createDataFrame(rows, "a long, l long, r long")
    scored = df.withColumn("score", collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()
    assert all(r.score == 10**6 * r.a * r.a // (r.l * r.r) for r in scored)
