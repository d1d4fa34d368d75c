"""The same results in SQL, where SQL can express them over the whole tables."""

from __future__ import annotations

# Fixed value: white space as Python's str.split sees it.
_BLANK = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_WORDS = f"len(list_filter(regexp_split_to_array(clean_text, '{_BLANK}'), lambda w: w <> ''))"


def _bare(column: str) -> str:
    folded = f"replace(replace(lower(upper(coalesce({column}, ''))), 'ß', 'ss'), 'µ', 'μ')"
    return rf"regexp_replace(replace({folded}, 'ς', 'σ'), '[^\p{{L}}\p{{M}}\p{{N}}]+', '', 'g')"


_SETS = f"""
    WITH n AS (SELECT record_id, {_bare('title')} AS a, {_bare('abstract')} AS b FROM papers),
         k AS (SELECT record_id, least(a, b) AS lo, greatest(a, b) AS hi FROM n),
         s AS (SELECT record_id, min(record_id) OVER w AS first, count(*) OVER w AS copies FROM k WINDOW w AS (PARTITION BY lo, hi))
"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": f"""
            WITH w AS (SELECT record_id, token_count_approx AS t, {_WORDS} AS n FROM papers WHERE clean_text IS NOT NULL)
            SELECT record_id FROM w WHERE n > 0 AND (t IS NULL OR 10 * abs(t - n) > n)
        """,
        "p1_words": f"""
            WITH w AS (
                SELECT p.source, l.lang, c.domain, p.clean_text, {_WORDS} AS n
                FROM papers p LEFT JOIN lang_labels l ON p.language = l.label LEFT JOIN category_domain c ON p.categories[1] = c.category
                WHERE clean_text IS NOT NULL)
            SELECT source, lang, domain, count(*) AS n_docs, count(DISTINCT clean_text) AS n_distinct, CAST(sum(n) AS BIGINT) AS n_words
            FROM w GROUP BY ALL
        """,
        "p6_kept": "SELECT spec_name, count(*) AS n_items, 0 AS n_lost, 0 AS n_over, 0 AS n_divided_wrongly FROM pack_spec, documents WHERE text IS NOT NULL GROUP BY spec_name",
        "p7_kept": """
            SELECT source, target_share, max_repeats, target_share > 0 AND max_repeats > 0 AND source IN (SELECT source FROM documents WHERE text <> '' AND source IS NOT NULL) AS there,
                   true AS reached, true AS within FROM mix_targets
        """,
        "p3_found": f"{_SETS} SELECT first AS record_id_a, record_id AS record_id_b FROM s WHERE record_id <> first",
        "p3_copies": f"{_SETS} SELECT record_id, copies AS n_copies FROM s WHERE record_id = first",
    }
