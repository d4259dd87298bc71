"""Secret scans by a trigram index, in DataFrame functions only.

From each rule's pattern a Boolean trigram query is derived (``trigrams``). The inverted index holds
the postings (trigram, document) of every trigram that some query asks for, over whole texts. The
postings of a clause are intersected by gathering, per document, which trigrams name it; documents
that satisfy any clause are the rule's candidates, and only on those its pattern is run. A rule
whose query may be empty, like bare runs of hex digits, scans all documents.

Where matches begin and end follows from the texts between them: ``split`` gives the gaps,
``regexp_extract_all`` the matches, and their lengths add up. Offsets are code points; spans also have
those of bytes, by which texts are cut for masking.

A document is known by its id and a hash of its text, so rows that share an id are told apart; rows
equal in both are alike in everything and are reported one by one.

Scale: postings are a few small numbers per document. Texts move once, to meet their candidate
marks, and not even that if the marks are few enough for Spark to broadcast. Keys are single documents,
so no key is hot; repeated rows can be split by adaptive execution, since the marks are a written table.

Defined results: a null text counts as empty and has no spans; null or repeated ids are kept row by
row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineforge.llm.tables import written
from lineforge.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first, whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# Fixed values. Runs of hex digits are asked for at full length, which finds the same maximal runs.
BASE_RULES = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id, text_hash): which of ``grams`` (by number) each whole text holds."""
    low = docs.select("doc_id", "text_hash", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select("doc_id", "text_hash", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame | None, set[str]]:
    """Per document a flag for each rule that it may match; and the kinds that scan everything."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    everywhere = {kind for kind, query in queries.items() if not all(query)}
    queries = {kind: query for kind, query in queries.items() if kind not in everywhere}
    if not queries:
        return None, everywhere
    grams = sorted({g for query in queries.values() for clause in query for g in clause})
    index = postings(docs, grams)
    # The intersection: a clause holds where all its trigrams have the document in their postings.
    # Postings of a document are gathered as bits, 60 trigrams to a word.
    number = {g: i for i, g in enumerate(grams)}
    words = range(-(-len(grams) // 60))
    bit = F.expr("shiftleft(1L, gram % 60)")
    seen = index.groupBy("doc_id", "text_hash").agg(
        *[F.coalesce(F.bit_or(F.when(F.expr(f"gram div 60 = {w}"), bit)), F.lit(0)).alias(f"w{w}") for w in words]
    )

    def holds(clause: frozenset[str]) -> Column:
        masks = {w: sum(1 << number[g] % 60 for g in clause if number[g] // 60 == w) for w in words}
        out = F.lit(True)
        for w, mask in masks.items():
            if mask:
                out &= F.col(f"w{w}").bitwiseAND(F.lit(mask).cast("long")) == F.lit(mask).cast("long")
        return out

    flags = []
    for kind, query in queries.items():
        flags.append(reduce(or_, map(holds, query)).alias(f"may_{kind}"))
    marked = seen.select("doc_id", "text_hash", *flags)
    return marked.where(reduce(or_, [F.col(f"may_{kind}") for kind in queries])), everywhere


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each of an array's longs what ``add`` makes of 0 and all longs before it.

    An array can only grow by being copied, so it is made of about as many pieces as each has
    elements: the work follows the power 1.5 of the size, not the square.
    """
    zero, none = F.lit(0).cast("long"), F.array().cast("array<long>")

    def inside(piece: Column, first: Column) -> Column:
        step = lambda acc, x: F.struct(add(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))
        return F.aggregate(piece, F.struct(first.alias("at"), none.alias("out")), step, lambda acc: acc["out"])

    def of(array: Column, n: Column) -> Column:
        places = F.sequence(F.lit(0), n - 1)
        pieces = F.transform(places, lambda i: F.slice(array, i * n + 1, n))
        firsts = lambda totals: F.transform(places, lambda i: F.aggregate(F.slice(totals, 1, i), zero, lambda a, b: add(a, b)))
        return _let(
            pieces,
            lambda p: _let(
                F.transform(p, lambda x: F.aggregate(x, zero, lambda a, b: add(a, b))), lambda t: F.flatten(F.zip_with(p, firsts(t), inside))
            ),
        )

    return _let(values, lambda v: _let(F.greatest(F.ceil(F.sqrt(F.size(v))), F.lit(1)).cast("int"), lambda n: of(v, n)))


def rule_spans(text: Column, rule: Rule, number: int) -> Column:
    """Spans of the rule's matches in ``text``."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"),
        found.alias("found"),
        (F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found).alias("secret"),
    )
    long = lambda n: F.coalesce(n, F.lit(0)).cast("long")
    sizes = F.transform(
        parts,
        lambda x: F.struct(
            long(F.length(x["gap"])).alias("gap"),
            long(F.length(x["found"])).alias("found"),
            long(F.octet_length(x["gap"])).alias("gap_bytes"),
            long(F.octet_length(x["found"])).alias("found_bytes"),
            F.coalesce(F.length(x["secret"]) >= rule.least, F.lit(False)).alias("counts"),
        ),
    )

    def spans(sizes: Column) -> Column:
        add = lambda a, b: a + b
        at = running(F.transform(sizes, lambda x: x["gap"] + x["found"]), add).alias("at")
        byte = running(F.transform(sizes, lambda x: x["gap_bytes"] + x["found_bytes"]), add).alias("byte")
        placed = F.filter(F.arrays_zip(sizes.alias("size"), at, byte), lambda x: x["size"]["counts"])
        return F.transform(placed, lambda x: span(x["at"] + x["size"]["gap"], x["byte"] + x["size"]["gap_bytes"], x["size"]))

    def span(start: Column, byte: Column, size: Column) -> Column:
        return F.struct(
            start.cast("int").alias("start"),
            F.lit(number).alias("kind"),
            (start + size["found"]).cast("int").alias("stop"),
            byte.alias("start_byte"),
            (byte + size["found_bytes"]).alias("stop_byte"),
        )

    return _let(sizes, spans)


# A match by places of characters, and by those of bytes.
SPANS = "array<struct<start:int,kind:int,stop:int,start_byte:bigint,stop_byte:bigint>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with a column ``spans`` (in place of any of that name): all matches by start, then by rule. Runs a job for the index."""
    plain = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # The input's row is kept as a whole, so that none of its names can clash.
    keyed = docs.select("doc_id", plain.alias("text"), F.struct("*").alias("row")).withColumn("text_hash", F.xxhash64("text"))
    found, everywhere = candidates(keyed, rules)
    if found is not None:
        marks = written(found, "candidates").withColumnsRenamed({"doc_id": "mark_id", "text_hash": "mark_hash"})
        same = F.col("doc_id").eqNullSafe(F.col("mark_id")) & (F.col("text_hash") == F.col("mark_hash"))
        keyed = keyed.join(marks, same, "left")
    none = F.array().cast(SPANS)
    spans = []
    for number, rule in enumerate(rules):
        may = F.col("text").rlike(rule.pattern) if rule.kind in everywhere else F.coalesce(f"may_{rule.kind}", F.lit(False))
        spans.append(F.when(may, rule_spans(F.col("text"), rule, number)).otherwise(none))
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "spans"]
    return keyed.select(*kept, F.array_sort(F.concat(*spans)).alias("spans"))


def as_text(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["stop"])), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts, a digest of the base rules' spans, and all spans, per document."""
    found = find_secrets(docs.select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(BASE_RULES)],
        F.sha2(as_text(base).cast("binary"), 256).alias("base_sha256"),
        as_text(F.col("spans")).alias("spans"),
    )


def masked(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``text``, overlaps merged, replaced by ``mark``; null stays null."""
    found = find_secrets(docs)
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")

    def cut(raw: Column, spans: Column) -> Column:
        """The text between spans, cut by bytes, which needs no walk from its start."""
        # How far all spans before one reach: it is marked unless it begins before that.
        reach = running(F.transform(spans, lambda s: s["stop_byte"]), F.greatest)
        piece = lambda s, at: F.concat(F.substring(raw, (at + 1).cast("int"), (s["start_byte"] - at).cast("int")).cast("string"), F.lit(mark))
        kept = F.zip_with(spans, reach, lambda s, at: F.when(s["start_byte"] >= at, piece(s, at)).otherwise(""))
        end = F.array_max(F.transform(spans, lambda s: s["stop_byte"]))
        rest = F.substring(raw, (end + 1).cast("int"), F.octet_length(raw)).cast("string")
        return F.concat(F.array_join(kept, ""), rest)

    clean = _let(raw, lambda r: _let(F.col("spans"), lambda s: cut(r, s)))
    clean = F.when(F.size("spans") > 0, clean).otherwise(F.col("text"))
    return found.select(*[clean.alias("text") if c == "text" else F.col(c) for c in found.columns if c != "spans"])
