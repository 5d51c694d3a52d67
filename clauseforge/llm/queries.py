"""Driver-facing queries of the text operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table
from . import leakage, lookalikes, markup, near_duplicates, repetition, shared_spans, splitting, tokenizing

Query = Callable[[SparkSession, str], DataFrame]


def _chunks(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "chunks")


def _documents(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents")


QUERIES: dict[str, Query] = {
    "p1_found": lambda s, d: splitting.oversized(_chunks(s, d)),
    "p1_pieces": lambda s, d: splitting.split_oversized(_chunks(s, d)),
    "p2_found": lambda s, d: shared_spans.sharing_pairs(_chunks(s, d)),
    "p2_records": lambda s, d: shared_spans.shared_per_record(_chunks(s, d)),
    "p2_classes": lambda s, d: shared_spans.sharing_classes(_chunks(s, d)),
    "p3_found": lambda s, d: near_duplicates.similar_pairs(_chunks(s, d)),
    "p3_groups": lambda s, d: near_duplicates.near_duplicate_groups(_chunks(s, d)),
    "p4_found": lambda s, d: lookalikes.lookalike_pairs(_chunks(s, d)),
    "p4_canonical": lambda s, d: lookalikes.canonical_texts(_chunks(s, d)),
    "p6_found": lambda s, d: markup.clean_records(_chunks(s, d)).select("id"),
    "p6_clean": lambda s, d: markup.clean_records(_chunks(s, d)),
    "p6_templates": lambda s, d: markup.host_templates(_chunks(s, d)),
    "p7_ids": lambda s, d: tokenizing.encode(_documents(s, d)),
    "p8_found": lambda s, d: leakage.leaked_pairs(_documents(s, d), table(s, d, "eval_items")),
    "p8_leaks": lambda s, d: leakage.leaks(_documents(s, d), table(s, d, "eval_items")),
    "p9_found": lambda s, d: repetition.repetitive_documents(_documents(s, d)),
    "p9_documents": lambda s, d: repetition.document_repetition(_documents(s, d)).select(
        "doc_id", "n_words", "repeated_words", "repeated_share", "sentence_share", "paragraph_share", "fails", "source", "host_docs", "host_fails", "host_rate", "host_bad"
    ),
}

_WORDS = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{M}}\p{{N}}]+')"

# Texts by the least record that holds them, their runs of 200 and which of these stand in other texts.
_SPANS = """r AS (SELECT DISTINCT id, content FROM chunks WHERE id IS NOT NULL AND length(content) >= 200),
        c AS (SELECT content, min(id) AS class_id, count(*) AS copies FROM r GROUP BY content),
        g AS (SELECT class_id, unnest(range(1, length(content) - 198)) AS p, unnest(list_transform(range(1, length(content) - 198), lambda i: substr(content, i, 200))) AS x FROM c),
        h AS (SELECT *, hash(x) AS h FROM g), s AS (SELECT h, x FROM h GROUP BY ALL HAVING count(DISTINCT class_id) > 1), m AS (SELECT class_id, p, h, x FROM h SEMI JOIN s USING (h, x)),
        q AS (SELECT DISTINCT a.class_id AS a, b.class_id AS b, a.p FROM m a JOIN m b ON a.h = b.h AND a.x = b.x AND a.class_id <> b.class_id)"""
_WITHIN = "sum(least(200, coalesce(nx - p, 200)))::BIGINT"
_NEAR = r"""r AS (SELECT DISTINCT id, content, attachment FROM chunks WHERE id IS NOT NULL AND content IS NOT NULL),
        w AS (SELECT content, min(id) AS class_id, regexp_extract_all(content, '[^ \t\n]+') AS w FROM r GROUP BY content),
        s AS (SELECT DISTINCT class_id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 40),
        n AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
        o AS (SELECT a.class_id AS x, b.class_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY ALL),
        e AS (SELECT x, y FROM o JOIN n i ON i.class_id = x JOIN n j ON j.class_id = y WHERE 10 * o >= 7 * (i.n + j.n - o))"""

ORACLES: dict[str, str] = {
    "p2_records": f"""WITH {_SPANS}, v AS (SELECT a AS class_id, p, lead(p) OVER (PARTITION BY a ORDER BY p) AS nx FROM (SELECT DISTINCT a, p FROM q)), k AS (SELECT class_id, {_WITHIN} AS n FROM v GROUP BY 1), l AS (SELECT a AS class_id, count(DISTINCT b) AS links FROM q GROUP BY 1)
        SELECT id, length(content) AS n_chars, CASE WHEN copies > 1 THEN length(content) ELSE n END AS shared_chars, CASE WHEN copies > 1 THEN length(content) ELSE n END / length(content) AS shared_share, class_id, copies, coalesce(links, 0) AS links
        FROM r JOIN c USING (content) LEFT JOIN k USING (class_id) LEFT JOIN l USING (class_id) WHERE copies > 1 OR n > 0""",
    "p2_classes": f"""WITH {_SPANS}, v AS (SELECT a, b, p, lead(p) OVER (PARTITION BY a, b ORDER BY p) AS nx FROM q), k AS (SELECT a, b, {_WITHIN} AS n FROM v GROUP BY ALL)
        SELECT i.a AS class_a, i.b AS class_b, i.n AS shared_a, j.n AS shared_b FROM k i JOIN k j ON i.a = j.b AND i.b = j.a WHERE i.a < i.b""",
    "p3_groups": f"""WITH RECURSIVE {_NEAR}, z AS (SELECT x AS start, x AS seen FROM e UNION SELECT z.start, e.y FROM z JOIN e ON e.x = z.seen), t AS (SELECT start AS class_id, min(seen) AS root FROM z GROUP BY start),
        l AS (SELECT x AS class_id, count(*) AS links FROM e GROUP BY x), u AS (SELECT r.id, r.attachment, coalesce(root, class_id) AS root, coalesce(links, 0) AS links FROM r JOIN w USING (content) LEFT JOIN t USING (class_id) LEFT JOIN l USING (class_id) WHERE len(w.w) >= 40),
        y AS (SELECT root, min(id) AS group_id, count(DISTINCT id) AS records, count(DISTINCT coalesce(attachment, chr(0))) AS attachments FROM u GROUP BY root)
        SELECT DISTINCT id, group_id, links, records, attachments FROM u JOIN y USING (root) WHERE records > 1""",
    "p8_leaks": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM eval_items WHERE text IS NOT NULL),
        dr AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS k, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM d),
        ir AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM i),
        m AS (SELECT DISTINCT doc_id, item_id, k FROM dr JOIN ir USING (g)), n AS (SELECT *, lead(k) OVER (PARTITION BY doc_id, item_id ORDER BY k) AS nx FROM m)
        SELECT doc_id, item_id, count(*) AS n_runs, sum(least(13, coalesce(nx - k, 13)))::BIGINT AS matched_words FROM n GROUP BY ALL""",
    "p1_found": "SELECT DISTINCT id FROM chunks WHERE length(content) > 1800",
    "p2_found": """
        WITH r AS (SELECT DISTINCT id, content FROM chunks WHERE id IS NOT NULL AND length(content) >= 200),
        g AS (SELECT DISTINCT id, hash(x) AS h, x FROM (SELECT id, unnest(list_transform(range(1, length(content) - 198), lambda i: substr(content, i, 200))) AS x FROM r)),
        s AS (SELECT h, x FROM g GROUP BY ALL HAVING count(*) > 1), m AS (SELECT id, h, x FROM g SEMI JOIN s USING (h, x))
        SELECT DISTINCT a.id AS id_a, b.id AS id_b FROM m a JOIN m b ON a.h = b.h AND a.x = b.x AND a.id < b.id""",
    "p3_found": r"""
        WITH r AS (SELECT DISTINCT id, content FROM chunks WHERE id IS NOT NULL AND content IS NOT NULL),
        w AS (SELECT id, regexp_extract_all(content, '[^ \t\n]+') AS w FROM r),
        s AS (SELECT DISTINCT id, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w WHERE len(w) >= 40),
        n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
        o AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.id < b.id GROUP BY ALL)
        SELECT id_a, id_b FROM o JOIN n x ON x.id = id_a JOIN n y ON y.id = id_b WHERE 10 * o >= 7 * (x.n + y.n - o)""",
    "p8_found": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
        i AS (SELECT item_id, {_WORDS.format('text')} AS w FROM eval_items WHERE text IS NOT NULL),
        dr AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM d),
        ir AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM i)
        SELECT DISTINCT doc_id, item_id FROM dr JOIN ir USING (g)""",
    "p9_found": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format('text')} AS w FROM documents WHERE text IS NOT NULL),
        g AS (SELECT doc_id, unnest(range(1, len(w) - 4)) AS k, unnest(list_transform(range(1, len(w) - 4), lambda k: array_to_string(w[k:k + 5], ' '))) AS g FROM d WHERE len(w) >= 30),
        t AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1),
        m AS (SELECT doc_id, count(DISTINCT k + o) AS m FROM t, (SELECT unnest(range(6)) AS o) GROUP BY doc_id)
        SELECT doc_id FROM m JOIN d USING (doc_id) WHERE 10 * m >= 4 * len(w)""",
}
