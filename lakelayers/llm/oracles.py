"""The same results in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

BLANKS = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), keyed AS (
    SELECT doc_id, parts, list_transform(parts, lambda x: translate(trim(x, {BLANKS}), {LOWER})) AS keys FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keeper
    FROM (SELECT DISTINCT doc_id, unnest(keys) AS key FROM keyed)
    WHERE length(key) >= 20 GROUP BY key HAVING count(*) >= 3
), flat AS (
    SELECT doc_id, unnest(parts) AS line, unnest(keys) AS key, unnest(range(len(parts))) AS pos FROM keyed
), judged AS (
    SELECT doc_id, line, pos, s.key IS NOT NULL AND s.keeper <> doc_id AS dropped
    FROM flat f LEFT JOIN shared s ON f.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5(CAST(doc_id AS VARCHAR)) AS key
    FROM documents
), totals AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank
    FROM sized GROUP BY source
), capped AS (
    SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, 2 * source_size AS cap,
        CAST(2 * source_size AS DOUBLE) / [5, 2, 1][rank % 3 + 1] AS ratio
    FROM totals
), levelled AS (
    SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(sum(cap) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM capped WINDOW before AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
    SELECT level AS lam FROM levelled WHERE level <= ratio ORDER BY ratio, rank LIMIT 1
), targets AS (
    SELECT source, source_size, rank, least(CAST(cap AS DOUBLE), lam * weight) AS target FROM levelled, chosen
), queued AS (
    SELECT doc_id, key, size, source_size, rank, target, pass,
        (pass * source_size + sum(size) OVER (PARTITION BY pass, rank ORDER BY
            CAST('0x' || substr(key, 1, 12) AS BIGINT) % (SELECT CAST(floor(sqrt(count(*))) AS BIGINT) + 1 FROM sized),
            key, doc_id ROWS UNBOUNDED PRECEDING)) / target AS finish
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, (VALUES (0), (1)) p(pass)
    WHERE size > 0
), taken AS (
    SELECT doc_id, size,
        sum(size) OVER (ORDER BY finish, rank, pass, key, doc_id ROWS UNBOUNDED PRECEDING) <=
            (SELECT sum(target) FROM targets) AS taken
    FROM queued
), per_doc AS (
    SELECT doc_id, CAST(coalesce(sum(size) FILTER (taken), 0) AS BIGINT) AS taken FROM taken GROUP BY doc_id
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, t.source_size, t.target, coalesce(d.taken, 0) AS taken
FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN per_doc d ON s.doc_id = d.doc_id
"""

_WORDS = rf"""list_filter(string_split_regex(translate(coalesce(text, ''), {LOWER}),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"""

DECONTAMINATION = f"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark
), windows AS (
    SELECT item, least(len(w), 10) AS n, unnest(list_transform(
        range(1, greatest(len(w) - 9, 1) + 1), lambda i: array_to_string(w[i:i + 9], ' '))) AS phrase
    FROM item_words WHERE len(w) > 0
), doc_words AS (
    SELECT doc_id, {_WORDS} AS w FROM documents
), lengths AS (
    SELECT DISTINCT n FROM windows
), spans AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS start,
        unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS phrase
    FROM doc_words, lengths WHERE len(w) >= n
), hits AS (
    SELECT DISTINCT s.doc_id, s.start, s.n, i.item FROM spans s JOIN windows i ON s.n = i.n AND s.phrase = i.phrase
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start, start + n)) AS place FROM (SELECT DISTINCT doc_id, start, n FROM hits))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
    sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

URL_FILTER = rf"""
WITH RECURSIVE cut AS (
    SELECT page_id, url, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest
    FROM pages
), parts AS (
    SELECT page_id, html, rest,
        coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {LOWER}), '') AS host,
        coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
        translate(regexp_extract(rest, '^[^/?#]*'), {LOWER})
            || regexp_replace(regexp_replace(rest, '^[^/?#]*', ''), '#.*$', '') AS place
    FROM cut
), rules(rule, host, path, verdict) AS (
    VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
        ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
), links AS (
    SELECT DISTINCT place, regexp_replace(regexp_extract(tag, 'href="[^"]*://([^"#]*)', 1), '&amp;', '&', 'g') AS target
    FROM (SELECT place, unnest(regexp_extract_all(html, '<link rel="canonical"[^>]*>')) AS tag FROM parts)
), places AS (
    SELECT DISTINCT host, path, place FROM parts
    UNION SELECT DISTINCT regexp_extract(target, '^[^/?]*'), regexp_extract(target, '^[^/?]*([^?]*)', 1), target FROM links
), own AS (
    SELECT DISTINCT place, arg_max(r.rule, length(r.rule)) OVER (PARTITION BY p.host, p.path, p.place) AS rule,
        arg_max(r.verdict, length(r.rule)) OVER (PARTITION BY p.host, p.path, p.place) AS verdict
    FROM places p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
), edges AS (
    SELECT place AS a, target AS b FROM links UNION SELECT target, place FROM links
), reached AS (
    SELECT o.place AS origin, o.place AS place FROM own o JOIN edges e ON o.place = e.a
    UNION SELECT r.origin, e.b FROM reached r JOIN edges e ON r.place = e.a
), spread AS (
    SELECT r.place, bool_or(o.verdict = 'block') AND NOT bool_or(o.verdict = 'allow') AS blocked
    FROM reached r JOIN own o ON r.origin = o.place GROUP BY r.place
)
SELECT p.page_id, p.host, p.path, o.rule,
    coalesce(o.verdict, CASE WHEN s.blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN own o ON p.place = o.place LEFT JOIN spread s ON p.place = s.place
"""

# Term counts of every source over all kept terms of its language, in whole numbers of 128 bits.
DIVERGENCE = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        list_filter(string_split_regex(translate(coalesce(text, ''), {LOWER}),
            '[\x00-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
    FROM documents
), counted AS (
    SELECT rid, lang, source, term, count(*) AS n
    FROM (SELECT rid, lang, source, unnest(w) AS term FROM docs) GROUP BY ALL
), kept AS (
    SELECT lang, term, sum(n) AS total FROM counted GROUP BY ALL HAVING count(*) >= 3
), counts AS (
    SELECT c.lang, source, term, sum(n) AS n FROM counted c SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
    SELECT lang, sum(total)::HUGEINT AS lang_size, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), sources AS (
    SELECT g.lang, g.source, coalesce(n, 0)::HUGEINT AS size
    FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN
        (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL) s ON g.lang = s.lang AND g.source = s.source
), dense AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.size + z.v) AS p,
        1 + (1000000000::HUGEINT * (k.total + 1)) // (z.lang_size + z.v) AS q
    FROM sources s JOIN sizes z ON s.lang = z.lang JOIN kept k ON s.lang = k.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
    FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
    UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM dense WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
    CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""

TOP_K = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

FILTER_AUDIT = rf"""
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), judged AS (
    SELECT doc_id, part, CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN min(doc_id) OVER (PARTITION BY text) < doc_id THEN 'E' ELSE '' END AS fails
    FROM texts
), marked AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), alike AS (
    SELECT part, fails, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, count(*) AS n
    FROM judged j LEFT JOIN marked m ON j.doc_id = m.doc_id GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS filter, left(filter_order, step - 1) AS before,
    FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)
), flags AS (
    SELECT s.*, a.*, contains(fails, filter) AS fails_it, translate(fails, before, '') = fails AS there FROM alike a, steps s
), counts AS (
    SELECT part, filter_order, step, filter,
        coalesce(sum(n) FILTER (there AND NOT fails_it), 0) AS kept,
        coalesce(sum(n) FILTER (there AND fails_it), 0) AS removed,
        coalesce(sum(n) FILTER (fails_it AND NOT there), 0) AS redundant,
        coalesce(sum(n) FILTER (fails = filter), 0) AS unique_fails,
        coalesce(sum(n) FILTER (there AND fails_it AND good), 0) AS good_lost,
        coalesce(sum(n) FILTER (there AND fails_it AND toxic), 0) AS toxic_lost
    FROM flags GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, filter) AS BIGINT) AS shapley
FROM counts
"""

# Every string of 100 bytes as 200 hexadecimal digits by its digest; pieces keep the cost of cutting them out linear.
SUFFIX_DEDUP = """
WITH raw AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS t, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), pieces AS (
    SELECT doc_id, n, piece * 500 AS base, substr(t, piece * 1000 + 1, 1200) AS t
    FROM (SELECT *, unnest(range(n // 500 + 1)) AS piece FROM raw)
), strings AS (
    SELECT doc_id, base + i AS start, md5_number(substr(t, 2 * i + 1, 200)) AS s
    FROM (SELECT *, unnest(range(least(500, n - base - 99))) AS i FROM pieces WHERE n - base >= 100)
), repeated AS (
    SELECT doc_id, start FROM strings
    QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, start) > 1
), runs AS (
    SELECT doc_id, run, min(start) AS low, max(start) + 100 AS high FROM (
        SELECT doc_id, start, sum(CAST(start - before > 100 OR before IS NULL AS INT)) OVER (PARTITION BY doc_id ORDER BY start) AS run
        FROM (SELECT *, lag(start) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM repeated)
    ) GROUP BY doc_id, run
), ends AS (
    SELECT doc_id, list_concat([0], list(high ORDER BY low)) AS opens, list(low ORDER BY low) AS closes, CAST(sum(high - low) AS BIGINT) AS n_removed,
        count(*) AS n_spans FROM runs GROUP BY doc_id
)
SELECT r.doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(array_to_string(list_transform(range(1, n_spans + 2),
        lambda k: substr(t, 2 * opens[k] + 1, 2 * (coalesce(closes[k], n) - opens[k]))), ''), t))) AS kept_sha256
FROM raw r LEFT JOIN ends e ON r.doc_id = e.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.95
), reached AS (
    SELECT a AS origin, a AS node FROM linked
    UNION SELECT r.origin, l.b FROM reached r JOIN linked l ON r.node = l.a
), component AS (
    SELECT origin AS vec_id, min(node) AS component_id FROM reached GROUP BY origin
), counted AS (
    SELECT a AS vec_id, count(*) AS n FROM linked GROUP BY a
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, e.vec_id) AS component_id,
    coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN component c ON e.vec_id = c.vec_id LEFT JOIN counted k ON e.vec_id = k.vec_id
"""

ORACLES = {
    "op1_suffix_dedup": SUFFIX_DEDUP,
    "op8_embedding_near_dedup": EMBEDDINGS,
    "op2_line_dedup": LINE_DEDUP,
    "op5_mixing": MIXING,
    "op7_decontamination": DECONTAMINATION,
    "op9_url_filter": URL_FILTER,
    "op11_source_divergence": DIVERGENCE,
    "op12_exact_top_k": TOP_K,
    "op13_filter_audit": FILTER_AUDIT,
}
