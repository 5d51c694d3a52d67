"""SQL for the core queries, written for DuckDB over the same tables."""

from __future__ import annotations

_ORPHANS = r"""
    d AS (SELECT lower(regexp_replace(slug, '^\s+|\s+$', '', 'g')) AS k, slug, status, relations, pos,
                 (_source.last_seen)::TIMESTAMPTZ AS last, (_source.first_seen)::TIMESTAMPTZ AS first FROM docs),
    r AS (SELECT * FROM d WHERE k <> '' QUALIFY row_number() OVER (PARTITION BY k ORDER BY last DESC NULLS LAST, pos DESC) = 1),
    e AS (SELECT slug, last, unnest(map_entries(relations)) AS e FROM r),
    p AS (SELECT id, built_at::TIMESTAMP AS ts, doc, events FROM provisions),
    f AS (SELECT 'docs' AS src_table, slug AS src_key, 'relations.' || e.key AS field, unnest(e.value) AS t, last AT TIME ZONE 'UTC' AS ts FROM e
          UNION ALL SELECT 'provisions', id, 'doc', doc, ts FROM p
          UNION ALL SELECT 'provisions', id, 'events.doc', x.doc, ts FROM (SELECT id, ts, unnest(events) AS x FROM p)),
    n AS (SELECT src_table, src_key, field, lower(regexp_replace(t, '^\s+|\s+$', '', 'g')) AS ref_slug, ts FROM f),
    o AS (SELECT DISTINCT src_table, src_key, field, ref_slug, strftime(ts, '%Y-%m') AS period FROM n LEFT JOIN r ON r.k = ref_slug
          WHERE ref_slug <> '' AND (r.k IS NULL OR r.status = 'Deleted' OR (r.first AT TIME ZONE 'UTC') > ts))"""

_DOCS = "cur AS (SELECT * FROM docs QUALIFY row_number() OVER (PARTITION BY slug ORDER BY (_source.last_seen)::TIMESTAMPTZ DESC, pos DESC) = 1)"
_RECORDS = "rec AS (SELECT * FROM chunks QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC) = 1)"
_STRIP = r"regexp_replace({0}, '^[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+|[\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+$', '', 'g')"
_SURROGATE = "coalesce(nullif(liferay_id, ''), 'sha1:' || sha1(coalesce(category, '') || '|' || coalesce(title, '') || '|' || coalesce(reference_no, '')))"
_SIGHTINGS = f"""si AS (SELECT * REPLACE ({_SURROGATE} AS liferay_id) FROM listing_rows),
    so AS (SELECT *, row_number() OVER (PARTITION BY liferay_id ORDER BY scanned_at, title NULLS FIRST, date_issued NULLS FIRST, reference_no NULLS FIRST) AS pos FROM si)"""
_PROVISIONS = "pr AS (SELECT DISTINCT * FROM provisions)"
_EVENTS = f"{_PROVISIONS}, ev AS (SELECT doc, id, n - 1 AS n, events[n].action AS action, events[n].doc AS source, events[n].date AS date, events[n].detail AS detail, events[n].verified AS verified FROM (SELECT *, unnest(range(1, len(events) + 1)) AS n FROM pr))"
_AMENDS = r"(NOT (coalesce({type}, '') = 'Exposure Drafts' OR regexp_matches(coalesce({title}, ''), '(?i)exposure\s+draft|consultation\s+paper|draft\b')) AND regexp_matches(coalesce({title}, ''), '(?i)\bamendment\b') AND NOT regexp_matches(coalesce({title}, ''), '(?i)as amended|incorporating|updated with'))"
_TOKENS = r"""list_sort(list_distinct(list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(coalesce({0}, ''), '[^A-Za-z0-9]+', ' ', 'g')),
    '\birdai?\b', 'insurance regulatory development authority', 'g'), '\breg\b\.?', 'regulations', 'g'), '\bregulation\b', 'regulations', 'g'), ' +'), lambda w: w NOT IN ('', 'of', 'the', 'and', 'for', 'india', 'indian'))))"""
_LETTERS, _DEVA = r"len(regexp_extract_all({0}, '\p{{L}}'))", r"len(regexp_extract_all({0}, '[\x{{900}}-\x{{903}}\x{{904}}-\x{{97F}}]'))"
_DEVA_LETTERS = r"len(regexp_extract_all(regexp_replace({0}, '[^\x{{900}}-\x{{97F}}]', '', 'g'), '\p{{L}}'))"
_LINES = r"regexp_replace(regexp_replace({0}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{{85}}\x{{2028}}\x{{2029}}]', chr(10), 'g'), '\n$', '')"
_BODY = f"b AS (SELECT doc_id, {_STRIP.format('text')} AS body FROM documents WHERE text IS NOT NULL)"
_WINDOWS = "w AS (SELECT doc_id, body, i, i * 1600 AS s, least(i * 1600 + 1800, length(body)) AS e FROM (SELECT *, unnest(range(CASE WHEN length(body) = 0 THEN 0 WHEN length(body) <= 1800 THEN 1 ELSE ceil((length(body) - 1800) / 1600)::INT + 1 END)) AS i FROM b))"


def _after(at: str, reach: int, pattern: str) -> str:
    part, m = f"substr(body, {at} + 1, {reach})", f"regexp_extract(substr(body, {at} + 1, {reach}), '{pattern}')"
    return f"CASE WHEN {m} = '' THEN {at} ELSE {at} + strpos({part}, {m}) - 1 + length({m}) END"


_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SNAP = f"sn AS (SELECT doc_id, body, i, CASE WHEN s > 0 THEN {_after('s', 250, '[.।]' + _WS + '+')} ELSE s END AS s, CASE WHEN e < length(body) THEN {_after('e', 200, '[.।]' + _WS)} ELSE e END AS e FROM w)"


def _cut(source: str) -> str:
    return f"c AS (SELECT doc_id, i, {_STRIP.format('substr(body, (s + 1)::INT, greatest(e - s, 0)::INT)')} AS content FROM {source}), k AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INT AS part, content FROM c WHERE content <> '')"


# Written out here once more, so that a wrong table in the operator shows.
_KINDS = """(1, 'broker', 'Intermediaries', 'Insurance Brokers'), (2, 'corporate agent', 'Intermediaries', 'Corporate Agents'), (3, 'web aggregator', 'Intermediaries', 'Web Aggregators'),
        (4, 'surveyor|loss assessor', 'Intermediaries', 'Surveyors & Loss Assessors'), (5, 'third party administrator|tpa\\b', 'Intermediaries', 'Third Party Administrators (TPAs)'),
        (6, 'insurance marketing firm|imf\\b', 'Intermediaries', 'Insurance Marketing Firms (IMFs)'), (7, 'repositor', 'Intermediaries', 'Insurance Repositories'), (8, 'misp\\b|motor insurance service provider', 'Intermediaries', 'MISPs'),
        (9, 'reinsur|lloyd', 'Insurers', 'Reinsurers'), (10, 'standalone health|health insur', 'Insurers', 'Standalone Health Insurers'), (11, 'life insur', 'Insurers', 'Life Insurers'), (12, 'general insur', 'Insurers', 'General Insurers'),
        (13, 'insurer', 'Insurers', '—'), (14, 'corporate governance|advertis|grievance|policyholder', 'Common', 'Applicable across multiple regulated entities')"""
# Alternatives that may begin inside a word.
_LOOSE = "n IN (10, 11, 12, 14) OR n = 4 AND regexp_matches(lower(title), 'loss assessor') OR n = 6 AND regexp_matches(lower(title), 'insurance marketing firm') OR n = 5 AND FALSE OR n = 8 AND regexp_matches(lower(title), 'motor insurance service provider') OR n = 9 AND regexp_matches(lower(title), 'lloyd')"
_PREFIX = """CASE type WHEN 'Acts' THEN 'act' WHEN 'Rules' THEN 'rules' WHEN 'Regulations' THEN 'reg' WHEN 'Notifications' THEN 'not' WHEN 'Master Circulars' THEN 'mc' WHEN 'Circulars' THEN 'cir'
        WHEN 'Guidelines' THEN 'gl' WHEN 'Orders' THEN 'ord' WHEN 'Notices' THEN 'ntc' WHEN 'Exposure Drafts' THEN 'ed' ELSE 'doc' END"""
_ORDER_LINES = "li AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) - 1 AS ln FROM lineitem)"
_SCORE = "CASE WHEN len(w) = 0 OR len(t) = 0 THEN 0.0 ELSE (CASE WHEN o = len(w) OR o = len(t) THEN greatest(o / (len(w) + len(t) - o), 0.99) ELSE o / (len(w) + len(t) - o) END) * (CASE WHEN len(y) > 0 AND NOT list_has_any(y, t) THEN 0.5 ELSE 1 END) END"
_STRIPPED = r"regexp_replace(regexp_replace(coalesce(title, ''), '\((?:first|second|third|fourth|fifth|sixth|\d+(?:st|nd|rd|th))?\s*amendment\)?', '', 'gi'), '\bamendments?\b', '', 'gi')"

_BARE = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
_COMPACT = r"regexp_replace(upper(regexp_replace({0}, '\s+', '', 'g')), '^\.+|\.+$', '', 'g')"
_ORDINAL = r"(?i)\(\s*(?:first|second|third|fourth|fifth|sixth|seventh|eighth|ninth|tenth|\d+(?:st|nd|rd|th))\s+amendment\s*\)"


def _relations(docs: str) -> str:
    """Relations by comparing all titles with all: ``ed`` the edges, ``op`` what stays open, ``md`` the documents."""
    return rf"""{docs}, t AS (SELECT slug, pos, coalesce(title, '') AS title, refNo, status, relations, _source.pending_relations AS waiting FROM md),
        b AS (SELECT *, {_BARE.format('title')} AS bare, regexp_matches(title, '{_ORDINAL}') AS am,
              nullif(regexp_extract(title, '(?i)withdrawal\s+of\s+circular\s+no\.?\s*([A-Z0-9/&\.\- ]+?)(?:\s+dated\b|,|$)', 1), '') AS wd,
              nullif(regexp_extract(title, '(?i)modificat\w*\s+(?:to|in|of)\s+(?:the\s+)?(.+?)(?:\s+dated\b|$)', 1), '') AS said FROM t),
        n AS (SELECT {_COMPACT.format('refNo')} AS key, max_by(slug, pos) AS dst FROM b WHERE coalesce(refNo, '') <> '' GROUP BY 1),
        w AS (SELECT slug, wd, CASE WHEN dst <> slug THEN dst END AS dst FROM b LEFT JOIN n ON key = {_COMPACT.format('wd')} WHERE wd IS NOT NULL),
        x AS (SELECT slug, 'amends' AS kind, NULL AS said, regexp_replace({_BARE.format(f"regexp_replace(title, '{_ORDINAL}', '', 'g')")}, '(19|20)\d{{2}}$', '') AS f FROM b WHERE am
              UNION ALL SELECT slug, 'modifies', said, {_BARE.format('said')} FROM b WHERE said IS NOT NULL AND NOT am),
        y AS (SELECT x.slug AS src, kind, b.slug AS dst FROM x, b WHERE b.slug <> x.slug AND (contains(bare, f) OR contains(f, bare)) AND CASE kind WHEN 'amends' THEN bare <> '' AND NOT b.am ELSE f <> '' END
              QUALIFY row_number() OVER (PARTITION BY x.slug, kind ORDER BY length(bare) DESC, b.pos) = 1),
        ed AS (SELECT slug AS src, 'withdraws' AS kind, dst FROM w WHERE dst IS NOT NULL UNION ALL SELECT * FROM y),
        op AS (SELECT DISTINCT slug, 'withdraws:' || trim(wd) AS pending FROM w WHERE dst IS NULL
               UNION SELECT slug, CASE kind WHEN 'amends' THEN 'amends:?' ELSE 'modifies:' || left(said, 60) END FROM x WHERE slug NOT IN (SELECT src FROM y WHERE y.kind = x.kind))"""


_WRITTEN = """fr AS (SELECT src, kind, dst FROM ed JOIN t ON slug = src WHERE NOT list_contains(coalesce(relations[kind], []), dst)),
        al AS (SELECT slug, e.key AS kind, e.value AS had FROM (SELECT slug, unnest(map_entries(relations)) AS e FROM t)),
        ad AS (SELECT src AS slug, kind, dst AS go FROM fr UNION SELECT dst, CASE kind WHEN 'withdraws' THEN 'withdrawnBy' WHEN 'amends' THEN 'amendedBy' ELSE 'modifiedBy' END, src FROM fr),
        ag AS (SELECT slug, kind, list(go) AS new FROM ad GROUP BY ALL),
        mm AS (SELECT coalesce(al.slug, ag.slug) AS slug, coalesce(al.kind, ag.kind) AS kind, list_sort(list_concat(coalesce(had, []), list_filter(coalesce(new, []), lambda z: NOT list_contains(coalesce(had, []), z)))) AS l
               FROM al FULL JOIN ag ON al.slug = ag.slug AND al.kind = ag.kind),
        ms AS (SELECT slug, string_agg(kind || ':' || coalesce(array_to_string(l, ','), ''), ';' ORDER BY kind || ':' || coalesce(array_to_string(l, ','), '')) AS relations FROM mm GROUP BY slug),
        po AS (SELECT slug, list(pending) AS p FROM op GROUP BY slug)
        SELECT t.slug, CASE WHEN t.slug IN (SELECT dst FROM ed WHERE kind = 'withdraws') AND coalesce(t.status, '') NOT IN ('Repealed', 'Superseded', 'Lapsed') THEN 'Withdrawn' ELSE t.status END AS status,
        coalesce(ms.relations, '') AS relations, coalesce(array_to_string(list_sort(list_concat(coalesce(waiting, []), list_filter(coalesce(p, []), lambda z: NOT list_contains(coalesce(waiting, []), z)))), ';'), '') AS pending
        FROM t LEFT JOIN ms ON ms.slug = t.slug LEFT JOIN po ON po.slug = t.slug"""
_MADE = """mk AS (SELECT 's' AS k, s_suppkey AS n, 0 AS shift, 'Cover of ' || s_name || ' Regulations, 2016' AS title, 'IRDAI/REF/' || s_suppkey AS refNo FROM supplier
        UNION ALL SELECT 'c', c_custkey, 10000000, 'Withdrawal of circular no. IRDAI/REF/' || c_custkey || ' dated today', NULL FROM customer
        UNION ALL SELECT 'a', s_suppkey, 20000000, 'Cover of ' || s_name || ' (First Amendment) Regulations, 2018', NULL FROM supplier
        UNION ALL SELECT 'm', s_suppkey, 30000000, 'Modification to the Cover of ' || s_name || ' Regulations dated 5 May', NULL FROM supplier),
        md AS (SELECT k || '-' || n AS slug, n + shift AS pos, title, refNo, CASE WHEN n % 7 = 0 THEN 'Lapsed' ELSE 'Existing' END AS status,
               CASE WHEN n % 3 = 0 THEN CASE WHEN k = 'a' THEN map(['amends'], [['s-' || n]]) ELSE map([]::VARCHAR[], []::VARCHAR[][]) END END AS relations, {'pending_relations': NULL::VARCHAR[]} AS _source FROM mk)"""
_CUR = f"{_DOCS}, md AS (SELECT * FROM cur)"

ORACLES: dict[str, str] = {
    "p5_changes": f"WITH {_ORPHANS} SELECT * FROM o",
    "q_relations": f"WITH {_relations(_CUR)} SELECT src, kind, dst FROM ed",
    "q_relations_open": f"WITH {_relations(_CUR)} SELECT slug, pending FROM op",
    "q_relations_made": f"WITH {_relations(_MADE)} SELECT src, kind, dst FROM ed",
    "q_relations_made_open": f"WITH {_relations(_MADE)} SELECT slug, pending FROM op",
    "q_docs_after_relations": f"WITH {_relations(_CUR)}, {_WRITTEN}",
    "q_made_after_relations": f"WITH {_relations(_MADE)}, {_WRITTEN}",
    "p5_found": f"WITH {_ORPHANS} SELECT * FROM o",
    "p5_report": f"WITH {_ORPHANS} SELECT src_table, period, count(*) AS orphans, count(DISTINCT ref_slug) AS slugs FROM o GROUP BY ALL",
    "q_chunk_windows": f"WITH {_BODY}, {_WINDOWS}, {_cut('w')} SELECT doc_id, part, content FROM k",
    "q_chunk_snap": f"WITH {_BODY}, {_WINDOWS}, {_SNAP}, {_cut('sn')} SELECT doc_id, part, content FROM k",
    "q_chunk_ids": f"WITH {_BODY}, {_WINDOWS}, {_SNAP}, {_cut('sn')} SELECT doc_id, part, sha1(doc_id || '|' || part || '|' || content) AS id, {_DEVA.format('content')} / greatest(length(content), 1) < 0.3 AS embeddable FROM k",
    "q_reassemble": f"""WITH {_RECORDS}, one AS (SELECT doc_id, attachment, chunk_index, coalesce(content, '') AS c FROM rec QUALIFY row_number() OVER (PARTITION BY doc_id, attachment, chunk_index ORDER BY (content IS NULL), id) = 1),
        g AS (SELECT doc_id, attachment, list(c ORDER BY chunk_index NULLS FIRST, c) AS p FROM one GROUP BY ALL),
        t AS (SELECT doc_id, attachment, list_reduce(p, lambda a, x: CASE WHEN a = '' THEN x ELSE a || substr(x, coalesce(list_max(list_filter(range(41, least(length(a), length(x), 260) + 1), lambda n: right(a, n) = left(x, n))), 0) + 1) END) AS t FROM g)
        SELECT doc_id, attachment, length(t)::INT AS n_chars, md5(t) AS digest FROM t""",
    "q_script_gate": f"SELECT doc_id, round({_DEVA.format('text')} / greatest(length(text), 1), 6) AS share, CASE WHEN {_LETTERS.format('text')} = 0 THEN 0.0 ELSE round(len(regexp_extract_all(text, '[A-Za-z]')) / {_LETTERS.format('text')}, 6) END AS latin, {_LETTERS.format('text')} > 0 AND {_DEVA_LETTERS.format('text')} > {_LETTERS.format('text')} * 0.5 AS mostly FROM documents WHERE text IS NOT NULL",
    "q_drop_hindi_lines": f"SELECT doc_id, md5(CASE WHEN text = '' THEN '' ELSE coalesce(array_to_string(list_filter(string_split({_LINES.format('text')}, chr(10)), lambda l: NOT ({_LETTERS.format('l')} > 0 AND {_DEVA_LETTERS.format('l')} > {_LETTERS.format('l')} * 0.5)), chr(10)), '') END) AS digest FROM documents WHERE text IS NOT NULL",
    "q_best_title": rf"""WITH t AS (SELECT DISTINCT title FROM listing_rows WHERE title IS NOT NULL), c AS (SELECT title, generate_subscripts(string_split(title, ' / '), 1) AS i, unnest(string_split(title, ' / ')) AS c FROM t)
        SELECT title, c AS best FROM c QUALIFY row_number() OVER (PARTITION BY title ORDER BY CASE WHEN {_LETTERS.format('c')} = 0 THEN 0.0 ELSE round_even(len(regexp_extract_all(c, '[A-Za-z]')) / {_LETTERS.format('c')}, 3) END DESC, length(c) DESC, i) = 1""",
    "q_slugs": f"WITH {_DOCS} SELECT slug, {_PREFIX} || '-' || regexp_replace(left(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 44), '-+$', '') || '-' || year AS base FROM cur",
    "q_references": rf"""SELECT DISTINCT reference_no, regexp_replace(upper(regexp_replace(coalesce(reference_no, ''), '\s+', '', 'g')), '^\.+|\.+$', '', 'g') AS compact,
        CASE d WHEN 'PPGR' THEN 'PP&GR' WHEN 'GAHR' THEN 'GA&HR' WHEN 'ACT' THEN 'ACTL' WHEN 'LEGAL' THEN 'LGL' WHEN 'F&A' THEN 'F&I' ELSE d END AS dept, y AS year
        FROM (SELECT reference_no, list_filter(list_transform(string_split(reference_no, '/')[2:4], lambda p: upper(trim(p))), lambda p: p IN ('NL','HLT','F&I','F&A','ACTL','ACT','LGL','LEGAL','REIN','PP&GR','PPGR','INT','LIFE','GA&HR','GAHR','SDD','IT'))[1] AS d,
        regexp_extract_all(reference_no, '\b(19\d{{2}}|20\d{{2}})\b', 1)[-1] AS y FROM listing_rows)""",
    "q_clause_refs": r"SELECT DISTINCT ref, upper(regexp_replace(regexp_replace(coalesce(ref, ''), '\s+', '', 'g'), '^[().]+|[().]+$', '', 'g')) AS norm FROM provisions",
    "q_dates": r"""SELECT DISTINCT date_issued, strftime(try_strptime(replace(regexp_extract(date_issued, '\d{1,2}[-/]\d{1,2}[-/]\d{4}'), '/', '-'), '%d-%m-%Y'), '%Y-%m-%d') AS parsed,
        CASE WHEN regexp_matches(left(date_issued, 10), '^\d{4}-\d{1,2}-\d{1,2}$') THEN strftime(try_strptime(left(date_issued, 10), '%Y-%m-%d'), '%Y-%m-%d') END AS safe FROM listing_rows""",
    "q_surrogate_ids": f"SELECT DISTINCT {_SURROGATE} AS liferay_id, category FROM listing_rows",
    "q_classify": f"""WITH k(n, p, entity, subtype) AS (VALUES {_KINDS}), t AS (SELECT DISTINCT title FROM listing_rows),
        f AS (SELECT title, arg_min(entity, n) AS entity, arg_min(subtype, n) AS subtype FROM t, k WHERE regexp_matches(lower(title), '\\b(?:' || p || ')') OR regexp_matches(lower(title), p) AND ({_LOOSE}) GROUP BY title)
        SELECT DISTINCT l.title, category, CASE WHEN lower(l.title) LIKE '%master circular%' THEN 'Master Circulars' WHEN lower(l.title) LIKE '%exposure draft%' THEN 'Exposure Drafts'
        WHEN category IN ('Consolidated & Gazette Notified Regulations', 'Updated Regulations') THEN 'Regulations' ELSE category END AS type,
        coalesce(f.entity, 'Common') AS entity, coalesce(f.subtype, '—') AS subtype,
        {_AMENDS.format(type='category', title='l.title')} AS amends, regexp_matches(coalesce(l.title, ''), '(?i)amendment') AND NOT regexp_matches(coalesce(l.title, ''), '(?i)as amended|incorporating') AS audited FROM listing_rows l LEFT JOIN f ON f.title = l.title""",
    "q_latest_sighting": f"WITH {_SIGHTINGS} SELECT liferay_id, pos, array_to_string(pdf_links, ' ') AS links FROM so QUALIFY row_number() OVER (PARTITION BY liferay_id ORDER BY pos DESC) = 1",
    "q_first_last_seen": f"WITH {_SIGHTINGS} SELECT liferay_id, regexp_replace(min(scanned_at)::VARCHAR, '\\.?0+$', '') AS first, max(scanned_at)::VARCHAR AS last, count(*) AS n FROM so GROUP BY liferay_id",
    "q_upsert": f"""WITH {_DOCS}, {_SIGHTINGS}, known AS (SELECT _source.liferay_id AS id FROM cur), f AS (SELECT * FROM so WHERE pos = 1 AND liferay_id NOT IN (SELECT id FROM known WHERE id IS NOT NULL)),
        a AS (SELECT type, _source.liferay_id IN (SELECT liferay_id FROM so) AS seen, false AS made FROM cur UNION ALL
              SELECT CASE WHEN lower(coalesce(title, '')) LIKE '%master circular%' THEN 'Master Circulars' WHEN lower(coalesce(title, '')) LIKE '%exposure draft%' THEN 'Exposure Drafts' WHEN category IN ('Consolidated & Gazette Notified Regulations', 'Updated Regulations') THEN 'Regulations' ELSE category END, true, true FROM f)
        SELECT type, count(*) AS docs, coalesce(sum(seen::BIGINT), 0)::BIGINT AS seen, coalesce(sum(made::BIGINT), 0)::BIGINT AS made FROM a GROUP BY type""",
    "q_migrate": f"WITH {_DOCS} SELECT CASE WHEN status = 'Unclassified' THEN 'Existing' ELSE status END AS status, count(*) AS docs, sum(len(list_filter(coalesce(maintenance, []), lambda m: m NOT IN ('stub', 'verify'))))::BIGINT AS marks FROM cur GROUP BY 1",
    "q_title_tokens": f"WITH {_DOCS} SELECT slug, array_to_string({_TOKENS.format('title')}, ' ') AS tokens FROM cur",
    "q_resolve_titles": f"""WITH {_DOCS}, a AS (SELECT slug AS doc_id, {_TOKENS.format('x')} AS w FROM (SELECT slug, {_STRIPPED} AS x FROM cur WHERE {_AMENDS.format(type='type', title='title')})),
        c AS (SELECT slug, pos, {_TOKENS.format('title')} AS t FROM cur WHERE NOT {_AMENDS.format(type='type', title='title')}),
        m AS (SELECT doc_id, slug, pos, w, t, len(list_intersect(w, t)) AS o, list_filter(w, lambda x: regexp_full_match(x, '(?:19|20)\\d\\d')) AS y FROM a, c WHERE slug <> doc_id),
        s AS (SELECT doc_id, slug, {_SCORE} AS score FROM m QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {_SCORE} DESC, pos) = 1)
        SELECT doc_id, CASE WHEN score >= 0.7 THEN slug END AS slug, round(score, 6) AS score FROM s""",
    "q_title_variants": f"""WITH {_DOCS}, a AS (SELECT slug, {_TOKENS.format('title')} AS w FROM cur), c AS (SELECT slug AS variant, pos, {_TOKENS.format('title')} AS t FROM cur WHERE NOT {_AMENDS.format(type='type', title='title')})
        SELECT slug, variant FROM a, c WHERE slug <> variant AND len(w) > 0 AND list_has_all(t, w) QUALIFY row_number() OVER (PARTITION BY slug ORDER BY pos) = 1""",
    "q_pending": f"WITH {_DOCS} SELECT slug FROM cur WHERE len(coalesce(_source.pdf_links, [])) > 0 AND slug NOT IN (SELECT slug FROM documents WHERE length(text) > 0 AND slug IS NOT NULL)",
    "q_chunks_of_known": f"WITH {_DOCS}, {_RECORDS} SELECT doc_id, count(*) AS chunks FROM rec WHERE doc_id IN (SELECT slug FROM cur WHERE status <> 'Deleted') GROUP BY doc_id",
    "q_top_provisions": f"WITH {_PROVISIONS} SELECT doc, id, rank::INT AS rank FROM (SELECT doc, id, row_number() OVER (PARTITION BY doc ORDER BY seq, id) AS rank FROM pr) WHERE rank <= 10",
    "q_cutoffs": f"WITH {_EVENTS}, d AS (SELECT doc, date FROM ev UNION SELECT doc, introducedOn FROM pr) SELECT doc, string_agg(date, ',' ORDER BY date) AS cutoffs FROM d WHERE coalesce(date, '') <> '' GROUP BY doc",
    "q_event_counts": f"WITH {_EVENTS} SELECT action, verified, count(*) AS events, count(DISTINCT id) AS provisions FROM ev GROUP BY ALL",
    "q_event_dedup": f'WITH {_EVENTS} SELECT id, action, source, detail, n::INT AS n, date, verified FROM ev QUALIFY row_number() OVER (PARTITION BY id, action, source, detail ORDER BY n) = 1',
    "q_identities": rf"""WITH {_PROVISIONS}, x AS (SELECT doc AS doc_id, seq, level, ref, path, upper(regexp_replace(regexp_replace(coalesce(ref, ''), '\s+', '', 'g'), '^[().]+|[().]+$', '', 'g')) AS r,
        CASE WHEN level IN ('regulation', 'schedule', 'part', 'chapter') THEN '' ELSE coalesce(list_filter(string_split(path, '/')[:-2], lambda p: starts_with(p, 'reg-'))[-1], '') END AS up FROM pr)
        SELECT doc_id, seq, level, ref, path FROM x QUALIFY row_number() OVER (PARTITION BY doc_id, level, r, up ORDER BY seq) = 1""",
    "q_amendment_totals": "SELECT lineage, count(*) AS amendments, sum(edges)::BIGINT AS edges, sum(applied)::BIGINT AS applied, sum(unresolved)::BIGINT AS unresolved, sum(unparsed)::BIGINT AS unparsed, max(date) AS last FROM (SELECT DISTINCT * FROM amendments) GROUP BY lineage",
    "q_pending_made": f"WITH {_DOCS} SELECT slug FROM cur WHERE len(coalesce(_source.pdf_links, [])) > 0 AND slug NOT IN (SELECT doc FROM provisions WHERE text IS NOT NULL AND doc IS NOT NULL)",
    "q_variants_made": "SELECT 'p-' || p_partkey AS slug, 'q-' || p_partkey AS variant FROM part",
    "q_edge_tallies": """WITH t AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem), o AS (SELECT l_orderkey, count(DISTINCT l_linenumber) AS n, count(DISTINCT l_partkey) AS m FROM t GROUP BY 1)
        SELECT 'unit_omit' AS rule, 'omit' AS action, 'unit' AS level, 'low' AS confidence, sum(n + 1)::BIGINT AS edges FROM o UNION ALL SELECT 'insert_after', 'insert', 'unit', 'low', sum(m)::BIGINT FROM o""",
    "q_grammar_rules": """WITH k AS (SELECT p_partkey AS k FROM part), r(n, rule, action, level, unit, target_ref, anchor, position, new_ref, old, new, scope, confidence, is_global) AS (VALUES
        (0, 'renumber', 'renumber', 'unit', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'low', false),
        (1, 'global_word_sub', 'substitute', 'words', NULL, NULL, NULL, NULL, NULL, 'a#|b|c', 'd', 'Schedule I', 'high', true),
        (2, 'word_sub_inv', 'substitute', 'words', NULL, NULL, NULL, NULL, NULL, 'x', 'y', 'clause #', 'high', false),
        (3, 'heading_sub', 'substitute', 'unit', 'heading', NULL, NULL, NULL, NULL, NULL, 'Some plain heading #', 'Part II', 'medium', false),
        (4, 'word_insert_after', 'insert', 'words', NULL, NULL, 'x', NULL, NULL, NULL, 'y', 'rule #', 'high', false),
        (5, 'word_omit', 'omit', 'words', NULL, NULL, NULL, NULL, NULL, 'x|y', NULL, 'section #', 'high', false),
        (6, 'unit_sub_first', 'substitute', 'unit', 'form', '#', NULL, NULL, NULL, NULL, NULL, NULL, 'low', false),
        (7, 'unit_sub_refless', 'substitute', 'unit', 'explanation', '(whole)', NULL, NULL, NULL, NULL, NULL, 'regulation #', 'medium', false),
        (8, 'note_sub_for', 'substitute', 'unit', 'note', '#', NULL, NULL, NULL, NULL, NULL, NULL, 'low', false),
        (9, 'insert_new_units', 'insert', 'unit', 'clause', NULL, '(a)', 'after', 'clause # and clause (c)', NULL, NULL, NULL, 'low', false),
        (10, 'insert_after_inv', 'insert', 'unit', 'proviso', NULL, '#', 'after', '(c)', NULL, NULL, NULL, 'low', false),
        (11, 'insert_before', 'insert', 'unit', 'clause', NULL, '#', 'before', NULL, NULL, NULL, NULL, 'low', false),
        (12, 'loc_bare_sub', 'substitute', 'unit', NULL, 'row #', NULL, NULL, NULL, NULL, NULL, 'row #', 'medium', false),
        (13, 'word_sub_defective', 'substitute', 'words', NULL, NULL, NULL, NULL, NULL, 'X#', 'Y', NULL, 'low', false))
        SELECT k || '-' || n AS doc_id, rule, action, level, unit, replace(target_ref, '#', k::VARCHAR) AS target_ref, replace(anchor, '#', k::VARCHAR) AS anchor, position, replace(new_ref, '#', k::VARCHAR) AS new_ref, replace(old, '#', k::VARCHAR) AS old,
        replace(new, '#', k::VARCHAR) AS new, replace(scope, '#', k::VARCHAR) AS scope, confidence, is_global FROM k, r""",
    "q_grammar_unit_sub": f"WITH {_ORDER_LINES} SELECT l_orderkey AS doc_id, ln::INT AS n, 'substitute' AS action, 'unit' AS level, 'clause' AS unit, l_linenumber::VARCHAR AS target_ref, 'regulation ' || l_partkey AS path, 'high' AS confidence FROM li",
    "q_grammar_words": f"WITH {_ORDER_LINES} SELECT l_orderkey AS doc_id, ln::INT AS n, 'substitute' AS action, 'words' AS level, 'part ' || l_partkey AS old, 'supplier ' || l_suppkey AS new, 'regulation ' || l_linenumber AS scope, 'high' AS confidence FROM li",
    "q_grammar_omit_insert": f"""WITH {_ORDER_LINES} SELECT l_orderkey AS doc_id, ln::INT AS n, 'omit' AS action, 'clause' AS unit, '(a)' AS ref, 'low' AS confidence FROM li
        UNION ALL SELECT l_orderkey, ln::INT, 'omit', 'clause', l_linenumber::VARCHAR, 'low' FROM li UNION ALL SELECT l_orderkey, ln::INT, 'insert', 'section', l_partkey::VARCHAR, 'low' FROM li""",
    "q_grammar_scope": f"WITH {_ORDER_LINES} SELECT l_orderkey AS doc_id, (2 * ln + 1)::INT AS n, 'omit' AS action, l_suppkey::VARCHAR AS target_ref, 'Part II of the Schedule ' || CASE WHEN l_returnflag = 'R' THEN 'I' ELSE 'V' END || ' of principal Regulations' AS scope, 'medium' AS confidence FROM li",
    "q_grammar_pairs": f"""WITH {_ORDER_LINES} SELECT l_orderkey AS doc_id, ln::INT AS n, 'substitute' AS action, 'a' || l_linenumber AS old, 'c' || l_suppkey AS new, false AS paired, 'low' AS confidence FROM li
        UNION ALL SELECT l_orderkey, ln::INT, 'substitute', 'b' || l_linenumber, 'd' || l_suppkey, false, 'low' FROM li""",
    "q_segments": f"""WITH {_ORDER_LINES}, c AS (SELECT DISTINCT l_orderkey FROM li)
        SELECT l_orderkey::VARCHAR AS doc_id, 0 AS seq, l_orderkey || '#cha-II' AS id, 'chapter' AS level, 'II' AS ref, 'General' AS heading, '' AS text FROM c
        UNION ALL SELECT l_orderkey::VARCHAR, (3 * ln + 1)::INT, l_orderkey || '#cha-II/reg-' || l_linenumber, 'regulation', l_linenumber::VARCHAR, 'Heading of part ' || l_partkey, '' FROM li
        UNION ALL SELECT l_orderkey::VARCHAR, (3 * ln + 2)::INT, l_orderkey || '#cha-II/reg-' || l_linenumber || '/cla-' || l_suppkey, 'clause', l_suppkey::VARCHAR, 'first clause', '' FROM li
        UNION ALL SELECT l_orderkey::VARCHAR, (3 * ln + 3)::INT, l_orderkey || '#cha-II/reg-' || l_linenumber || '/cla-' || l_suppkey || '/sub-a', 'subclause', 'a', 'its subclause', 'and more' FROM li""",
    "q_lineage_events": """SELECT DISTINCT l_orderkey || '#reg-' || l_linenumber || '/cla-' || l_suppkey AS id, 'substitute' AS action, 'am-' || l_orderkey AS doc, strftime(o_orderdate, '%Y-%m-%d') AS date,
        'For clause ' || l_suppkey || ' of regulation ' || l_linenumber || ', the following shall be substituted' AS detail, true AS verified FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "q_audit_latest": f"WITH {_DOCS} SELECT slug, title, year FROM cur WHERE regexp_matches(coalesce(title, ''), '(?i)amendment') AND NOT regexp_matches(coalesce(title, ''), '(?i)as amended|incorporating') ORDER BY year DESC NULLS FIRST, slug LIMIT 20",
    "q_database_rows": f"""WITH {_DOCS} SELECT slug, coalesce(status, 'Unclassified') AS status, coalesce(nullif(attachments, 0), 1) AS attachments, coalesce(archived, false) AS archived,
        CASE WHEN regexp_matches(left(dateIssued, 10), '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') THEN strftime(try_strptime(left(dateIssued, 10), '%Y-%m-%d'), '%Y-%m-%d') END AS date_issued,
        len(coalesce(subjects, []))::INT AS subjects, len(coalesce(_source.pending_relations, []))::INT AS pending FROM cur""",
    "q_log_rows": f"WITH {_DOCS} SELECT _source.liferay_id AS id, slug, type, title, dept, year::VARCHAR AS year, dateIssued AS date_issued, attachments::VARCHAR AS attachments, to_json(_source.pdf_links)::VARCHAR AS pdf_links FROM cur",
    "q_payloads": f"WITH {_DOCS}, {_RECORDS}, n AS (SELECT doc_id, count(*) AS n FROM rec GROUP BY 1) SELECT slug, coalesce(n, 0)::INT AS chunks FROM cur LEFT JOIN n ON doc_id = slug WHERE lede IS NOT NULL",
    "q_embed": f"WITH {_RECORDS} SELECT id, content IS NOT NULL AND {_DEVA.format('content')} / greatest(length(content), 1) < 0.3 AS embedded FROM rec",
    "q_cosine_topk": """WITH s AS (SELECT a.vec_id AS query, b.vec_id AS neighbour, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, neighbour) AS rank FROM s) SELECT query, neighbour, rank::INT AS rank, round(score, 5) AS score FROM r WHERE rank <= 10""",
    "q_stream_upsert": f"WITH {_SIGHTINGS}, ok AS (SELECT * FROM si WHERE coalesce(title, '') <> '' AND (detail_page IS NOT NULL OR len(coalesce(pdf_links, [])) > 0)) SELECT liferay_id, array_to_string(pdf_links, ' ') AS links FROM ok QUALIFY row_number() OVER (PARTITION BY liferay_id ORDER BY scanned_at DESC) = 1",
}
