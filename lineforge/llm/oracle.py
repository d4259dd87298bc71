"""SQL of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

OP1_SQL = """
WITH plain AS (
    SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), originals AS (
    SELECT html, max(page_id) AS original FROM plain WHERE payload_bytes >= 1000 GROUP BY html
)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN original <> page_id THEN original END AS refers_to
FROM plain LEFT JOIN originals USING (html)
"""

OP9_SQL = r"""
WITH plain AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
), groups AS (
    SELECT text, min(doc_id) AS first_id, count(*) AS n FROM plain GROUP BY text
), kept AS (
    SELECT doc_id, CASE WHEN n = 1 THEN doc_id ELSE first_id END AS keep_id, n, text FROM plain JOIN groups USING (text)
)
SELECT doc_id, keep_id, n AS group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256 FROM kept
"""

OP10_SQL = """
WITH vectors AS (
    SELECT vec_id, embedding FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), parts AS (
    SELECT vec_id, unnest(range(len(embedding))) AS d, unnest([floor(64 * x::DOUBLE)::HUGEINT for x in embedding]) AS v FROM vectors
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sum(q.v * c.v) AS score
    FROM parts q JOIN parts c ON q.d = c.d AND q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0 GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score::BIGINT AS score FROM ranked WHERE rank <= 20
"""


def linked_documents(width: int, percent: int, columns: str) -> str:
    """Documents whose shingle sets are similar, their components closed step by step."""
    return rf"""
WITH RECURSIVE words AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT r, unnest(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < {width} THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + {width - 1}], ' ') for i in range(1, len(w) - {width - 2})] END) AS s
    FROM words
), sizes AS (
    SELECT r, count(*) AS n FROM shingles GROUP BY r
), shared AS (
    SELECT x.r AS a, y.r AS b, count(*) AS n_both FROM shingles x JOIN shingles y ON x.s = y.s AND x.r <> y.r GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes p ON p.r = a JOIN sizes q ON q.r = b WHERE 100 * n_both >= {percent} * (p.n + q.n - n_both)
), reached AS (
    SELECT r, r AS t FROM words
    UNION
    SELECT reached.r, links.b FROM reached JOIN links ON links.a = reached.t
), placed AS (
    SELECT r, words.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least_id AS component_id
    FROM words LEFT JOIN sizes USING (r)
    JOIN (SELECT reached.r, min(other.doc_id) AS least_id FROM reached JOIN words other ON other.r = reached.t GROUP BY reached.r) USING (r)
)
SELECT {columns} FROM placed
"""


OP7_SQL = linked_documents(3, 85, "doc_id, n_shingles, component_id, doc_id = component_id AS kept")
OP12_SQL = linked_documents(3, 90, "doc_id, n_shingles, component_id")

OP13_SQL = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
    UNION ALL
    SELECT lang, 2, unnest([array_to_string(w[i:i + 1], ' ') for i in range(1, len(w))]) FROM words
    UNION ALL
    SELECT lang, 3, unnest([array_to_string(w[i:i + 2], ' ') for i in range(1, len(w) - 1)]) FROM words
), counts AS MATERIALIZED (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), candidates AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
    SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM candidates
), parts AS (
    SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS rest FROM cuts
), headed AS MATERIALIZED (
    SELECT parts.*, counts.f AS l FROM parts JOIN counts ON counts.lang = parts.lang AND counts.phrase = head
), scored AS MATERIALIZED (
    SELECT h.lang, h.phrase, h.k, a, cut, l, counts.f AS r, (1000000::HUGEINT * a * a) // (l::HUGEINT * counts.f) AS score
    FROM headed h JOIN counts ON counts.lang = h.lang AND counts.phrase = rest
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_phrases AS (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM candidates WHERE k = 3
), longer AS (
    SELECT lang, phrase, max(a) AS most FROM inner_phrases GROUP BY ALL
), kept AS (
    SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 50 * a
), totals AS (
    SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc": OP1_SQL,
        "op7_minhash": OP7_SQL,
        "op9_naming": OP9_SQL,
        "op10_topk": OP10_SQL,
        "op12_ngrams": OP12_SQL,
        "op13_collocations": OP13_SQL,
    }
