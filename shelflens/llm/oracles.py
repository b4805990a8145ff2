"""SQL of the training-data queries, for those that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op6_block_anchors": r"""
        WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
        p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
        windows AS (SELECT doc_id, i, array_to_string(ws[i : i + 12], ' ') AS s FROM p),
        hit AS (SELECT doc_id, i FROM windows JOIN (SELECT s, min(doc_id) AS first FROM windows GROUP BY 1) m USING (s) WHERE first < doc_id),
        gone AS (SELECT DISTINCT doc_id, i + k AS j FROM hit, (SELECT unnest(range(13)) AS k) k),
        word AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM w),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY 1)
        SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    "op12_lexical_search": r"""
        WITH cut AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        lengths AS (SELECT doc_id, len(ts) AS n FROM cut WHERE len(ts) > 0),
        totals AS (SELECT count(*) AS docs, cast(sum(n) AS bigint) AS len FROM lengths),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS term FROM cut) GROUP BY ALL),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        weights AS (SELECT term, cast(floor(1000 * ln(cast(2 * docs + 2 AS double) / (2 * df + 1))) AS bigint) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), totals),
        scores AS (SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // len)))) AS bigint) AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (doc_id), totals GROUP BY 1, 2)
        SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS int) AS rank, doc_id, score FROM scores WHERE score > 0
        QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10""",
}
