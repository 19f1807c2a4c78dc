"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op13_phrase_collocations": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        q AS (SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
        w AS (SELECT lang, id, unnest(words) AS a, generate_subscripts(words, 1) AS k FROM q),
        t AS (SELECT lang, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY id ORDER BY k)),
        g AS (
            SELECT lang, 1 AS size, [a] AS g FROM t
            UNION ALL SELECT lang, 2, [a, b] FROM t WHERE b IS NOT NULL
            UNION ALL SELECT lang, 3, [a, b, c] FROM t WHERE c IS NOT NULL),
        f AS MATERIALIZED (SELECT lang, size, array_to_string(g, ' ') AS phrase, any_value(g) AS g, count(*) AS f FROM g GROUP BY ALL),
        n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, size, phrase, g, f AS a FROM f WHERE size > 1 AND f >= 10),
        k AS (
            SELECT lang, phrase, a, k, array_to_string(g[1:k], ' ') AS head, array_to_string(g[k + 1:size], ' ') AS tail
            FROM c, (VALUES (1), (2)) AS t(k) WHERE k < size),
        h AS MATERIALIZED (
            SELECT k.*, f.f AS l FROM k JOIN f ON f.lang = k.lang AND f.phrase = k.head),
        s AS MATERIALIZED (
            SELECT h.lang, h.phrase, h.a, h.k, h.l, f.f AS r,
                   ((1000000::HUGEINT * h.a * h.a) // (h.l::HUGEINT * f.f))::BIGINT AS score
            FROM h JOIN f ON f.lang = h.lang AND f.phrase = h.tail),
        low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
        longer AS (
            SELECT lang, part, max(a) AS a FROM (
                SELECT lang, a, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS part
                FROM c WHERE size = 3) GROUP BY lang, part),
        kept AS (
            SELECT low.* FROM low LEFT JOIN longer ON longer.lang = low.lang AND longer.part = low.phrase
            WHERE longer.a IS NULL OR 100 * longer.a < 50 * low.a)
        SELECT kept.lang, row_number() OVER best AS rank, phrase, a, l, r, n.n, score
        FROM kept JOIN n ON n.lang = kept.lang
        WINDOW best AS (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase)
        QUALIFY row_number() OVER best <= 2000
    """,
}
