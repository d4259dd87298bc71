"""Spans and masks of texts with very many matches, against plain programs."""

from __future__ import annotations

import random
import re
import time

from pyspark.sql import functions as F

from lineforge.llm import secrets
from lineforge.llm.secrets import RULES, running

DOCS = "doc_id long, text string, spans string, size int, row int"


def spans_of(text):
    found = []
    for number, rule in enumerate(RULES):
        pattern = re.compile(rule.pattern)
        found += [(m.start(), number, m.end()) for m in pattern.finditer(text) if len(m[rule.group]) >= rule.least]
    return sorted(found)


def mask_of(text, mark):
    out, at = [], 0
    for start, _, stop in spans_of(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join(out) + text[at:]


def awkward_texts():
    rng = random.Random(6)
    parts = [
        "password=hunter22", "Token: 'abcdef123'", "secret=ab", "AKIA" + "Z9" * 9, "0123456789abcdef" * 2, "ghp_" + "a1" * 20,
        "token=" + "deadbeef" * 4, "é", "日本 ", "\U0001f600", " ", "\n", "api_key=AKIA" + "Q" * 20, "-----BEGIN RSA PRIVATE KEY-----", "x",
    ]
    return [None, "", *("".join(rng.choice(parts) for _ in range(rng.randint(1, 60))) for _ in range(150))]


def test_spans_and_masks(spark):
    texts = awkward_texts()
    docs = spark.createDataFrame([(i, t, "s", 1, 2) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: [(s.start, s.kind, s.stop) for s in r.spans] for r in secrets.find_secrets(docs).collect()}
    assert found == {i: spans_of(t or "") for i, t in enumerate(texts)}
    clean = {r.doc_id: r.text for r in secrets.masked(docs.drop("spans"), "<é>").collect()}
    assert clean == {i: None if t is None else mask_of(t, "<é>") for i, t in enumerate(texts)}


def test_running_values(spark):
    rng = random.Random(2)
    lists = [[], [5], *([rng.randrange(50) for _ in range(n)] for n in (2, 3, 4, 15, 16, 17, 400))]
    df = spark.createDataFrame([(x,) for x in lists], "v array<long>")
    sums = df.select(running(F.col("v"), lambda a, b: a + b).alias("s"), running(F.col("v"), F.greatest).alias("m"), "v")
    for r in sums.collect():
        assert r.s == [sum(r.v[:i]) for i in range(len(r.v))]
        assert r.m == [max([0, *r.v[:i]]) for i in range(len(r.v))]


def test_very_many_matches_in_one_text(spark):
    text = "".join(f"password=hunter{i} naïve " for i in range(40_000))
    docs = spark.createDataFrame([(0, text, "s", 1, 2)], DOCS).drop("spans")
    start = time.perf_counter()
    assert secrets.masked(docs).first().text == "[secret] naïve " * 40_000
    assert time.perf_counter() - start < 60
