"""The results of the core queries in SQL, over whole tables."""

from __future__ import annotations

from lexloom.functions.text import FUNCTION_WORDS
from lexloom.plans import registry as q
from lexloom.plans import tex_sql as tex

_BLANK, _text, _sub, _strip = tex.BLANK, tex.text, tex.sub, tex.strip


def _norm(c: str) -> str:
    return _sub(_sub(f"lower({c})", f"{_BLANK}+", " "), "^ | $", "")


def _words(c: str) -> str:
    return f"coalesce(len(list_filter(regexp_split_to_array({c}, {_text(_BLANK + '+')}), lambda w: w <> '')), 0)"


def _hash() -> str:
    title, abstract = (_norm(f"coalesce({c}, '')") for c in ("title", "abstract"))
    return f"'sha256:' || sha256({title} || '|||' || {abstract})"


def _pdf(c: str) -> str:
    # Without look-around, a joined line end needs two passes, as the letter after one may stand before the next.
    c = _sub(c, r"([\p{L}\p{M}\p{N}_])-\n([\p{L}\p{M}\p{N}_])", r"\1\2")
    for _ in range(2):
        c = _sub(c, r"([a-z,;])\n([a-z])", r"\1 \2")
    c = _sub(c, r"(?s)\n(?:References|Bibliography|REFERENCES|BIBLIOGRAPHY)\n.*", "", "")
    for body in (r"\d+", rf"\d+{_BLANK}+von{_BLANK}+\d+", rf"Page{_BLANK}+\d+{_BLANK}+of{_BLANK}+\d+"):
        c = _sub(c, rf"(?m)^{body}{_BLANK}*$", "")
    c = _sub(c, rf"arXiv:[^\s]+{_BLANK}+\[[\w.-]+\]{_BLANK}+\d{{1,2}}{_BLANK}+\w+{_BLANK}+\d{{4}}", "")
    c = _sub(c, rf"(?m)^\d{{2}}\.\d{{2}}\.\d{{2,4}}{_BLANK}*$", "")
    return _strip(_sub(_sub(c, r"[ \t]+", " "), r"\n{3,}", "\n\n"))


def _over_texts(expression: str) -> str:
    return f"SELECT record_id, {expression} AS text FROM papers WHERE full_text IS NOT NULL"


def _language(source: str, key: str, c: str) -> str:
    """(key, language) of the rows of a query."""
    count = lambda cls: f"length(regexp_replace({c}, '[^{cls}]', '', 'g'))"
    rows = ", ".join(
        f"len(list_filter(w, lambda x: x IN ({', '.join(_text(x) for x in words.split())}))) AS {lang}_n" for lang, words in FUNCTION_WORDS.items()
    )
    best = "greatest(" + ", ".join(f"{lang}_n" for lang in FUNCTION_WORDS) + ")"
    cases = " ".join(f"WHEN {lang}_n = {best} THEN '{lang}'" for lang in FUNCTION_WORDS)
    return rf"""
        WITH s AS (SELECT {key}, {c} AS t, regexp_split_to_array(lower({c}), '[^\p{{L}}]+') AS w,
                   {count(r'\x{ac00}-\x{d7a3}')} AS h, {count(r'\x{3041}-\x{30ff}')} AS k, {count(r'\x{4e00}-\x{9fff}')} AS z FROM ({source})),
             n AS (SELECT *, {rows} FROM s)
        SELECT {key}, CASE WHEN t IS NULL OR length({_strip('t')}) < 20 THEN 'en'
            WHEN (h + k + z) * 4 >= length(t) THEN CASE WHEN h >= k AND h >= z THEN 'ko' WHEN k * 10 >= z THEN 'ja' ELSE 'zh' END
            {cases} END AS language FROM n
    """


def _cleaned(columns: str, source: str = "arxiv") -> str:
    """Common tables: c (record_id, clean_text, language) of the full texts of a source, and r, what cleaning makes of each record."""
    return f"""
        a AS (SELECT *, coalesce(has_full_text, false) AND full_text <> '' AS has FROM papers WHERE source = '{source}'),
        x AS ({tex.cleaned("SELECT record_id, full_text FROM a WHERE has AND coalesce(full_text_format, '') <> 'pdf_text'", "full_text", "record_id")}),
        f AS (SELECT record_id, t FROM x UNION ALL SELECT record_id, {_pdf('full_text')} FROM a WHERE has AND full_text_format = 'pdf_text'),
        g AS ({_language("SELECT record_id, t FROM f", "record_id", "t")}),
        r0 AS (SELECT a.*, f.t, g.language AS found, (coalesce(full_text_status = 'abstract_only', false) OR NOT coalesce(has_full_text, false)) AND coalesce(abstract, '') <> '' AS own
               FROM a LEFT JOIN f USING (record_id) LEFT JOIN g USING (record_id)),
        r AS (SELECT record_id, CASE WHEN own THEN abstract WHEN has THEN t ELSE clean_text END AS clean_text,
                     CAST(CASE WHEN own THEN {_words('abstract')} WHEN has THEN {_words('t')} ELSE token_count_approx END AS INTEGER) AS token_count_approx,
                     CASE WHEN has THEN found ELSE language END AS language FROM r0)
    """


def _page(c: str) -> str:
    """The text of a page: tags at whose start a block begins are line ends, all others nothing."""
    for pattern, to in (
        (r"(?s)<!--.*?-->", ""), (r"(?is)<script\b[^>]*>.*?</script[^>]*>", ""), (r"(?is)<style\b[^>]*>.*?</style[^>]*>", ""), (r"<![A-Za-z][^>]*>", ""),
        (r"(?i)<(?:p|div|br|li|tr|h[1-6])(?:[\s/][^>]*)?>", "\n"), (r"</?[a-zA-Z][^>]*>", ""),
    ):
        c = _sub(c, pattern, to)
    for name, sign in (("lt", "<"), ("gt", ">"), ("ldquo", "“"), ("rdquo", "”"), ("nbsp", "\u00a0"), ("#32", " "), ("quot", '"'), ("amp", "&")):
        c = f"replace({c}, '&{name};', '{sign}')"
    return _strip(_sub(_sub(c, r"[ \t]+", " "), r"\n{2,}", "\n"))


def _key(seed: int, *columns: str) -> str:
    return f"sha256('{seed}'" + "".join(f" || '|' || coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


_DELIVERY = ("id", "version", "added", "created", "url", "text")


def _mix(auto: bool, fallback: bool, alone: bool = False, bounds: tuple[float, float] | None = None, with_text: bool = False) -> str:
    """The mixture by the row of mix_config with these settings (alone: balanced without fallbacks), within other bounds if given; the plan is worked out in SQL."""
    changed = ["true AS auto_balance", "CAST(NULL AS VARCHAR) AS science_fallback", "CAST(NULL AS VARCHAR) AS general_fallback"] if alone else []
    changed += [f"{bounds[0]}::DOUBLE AS science_ratio_min", f"{bounds[1]}::DOUBLE AS science_ratio_max"] if bounds else []
    config = f"* REPLACE ({', '.join(changed)})" if changed else "*"
    columns = "id, source, url, text, created, added, version"
    order = ", ".join(f"{c} NULLS FIRST" for c in ("id", "version", "added", "created", "url", "sha256(text)"))
    return f"""
        WITH c AS (SELECT {config} FROM mix_config WHERE auto_balance = {auto} AND (science_fallback IS NOT NULL) = {fallback} ORDER BY ALL LIMIT 1),
             s AS (SELECT {columns} FROM corpus WHERE source = 'pes2o_or_crawled'),
             g AS (SELECT {columns} FROM corpus WHERE source = 'general'),
             n AS (SELECT (SELECT count(*) FROM s) AS ns, (SELECT count(*) FROM g) AS ng),
             p AS (SELECT *, (science_ratio_min + science_ratio_max) / 2 AS t, ns::DOUBLE / (ns + ng) AS r FROM n, c),
             w AS (SELECT *, CAST(trunc(ns * (1.0::DOUBLE - t) / t) AS BIGINT) AS gw, CAST(trunc(ng * t / (1.0::DOUBLE - t)) AS BIGINT) AS sw,
                       r > science_ratio_max AND auto_balance AS over, r < science_ratio_min AND auto_balance AS under FROM p),
             a AS (SELECT CASE WHEN over AND general_fallback IS NULL THEN greatest(1, sw) ELSE ns END AS ks,
                          CASE WHEN under AND science_fallback IS NULL THEN greatest(1, gw) ELSE ng END AS kg,
                          CASE WHEN under AND science_fallback IS NOT NULL THEN greatest(0, sw - ns) ELSE 0 END AS xs,
                          CASE WHEN over AND general_fallback IS NOT NULL THEN greatest(0, gw - ng) ELSE 0 END AS xg FROM w),
             s1 AS (SELECT *, row_number() OVER (ORDER BY {_key(q.SEED, *_DELIVERY)}) AS i FROM s),
             g1 AS (SELECT *, row_number() OVER (ORDER BY {_key(q.SEED, *_DELIVERY)}) AS i FROM g),
             es AS (SELECT *, row_number() OVER (ORDER BY {order}) AS i FROM corpus),
             eg AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS i FROM documents),
             m AS (SELECT {columns} FROM s1, a WHERE i <= ks
                   UNION ALL SELECT {columns} FROM g1, a WHERE i <= kg
                   UNION ALL SELECT id, 'pes2o_or_crawled', url, text, created, NULL, version FROM es, a WHERE i <= xs AND text <> ''
                   UNION ALL SELECT CAST(doc_id AS VARCHAR), 'general', url, text, created, NULL, version FROM eg, a WHERE i <= xg AND text <> '')
        SELECT id, source, version, {_key(q.SEED, *_DELIVERY)} AS shuffle_key{", text" if with_text else ""} FROM m
    """


def _geometry(table: str = "documents", id_: str = "doc_id") -> str:
    """Shard and batch of a position, of contiguous shards of which the first are one row longer."""
    n = f"(SELECT count(*) FROM {table})"
    return f"""
        o AS (SELECT {id_}, text, row_number() OVER (ORDER BY {_key(q.SEED, id_)}) - 1 AS pos FROM {table}),
        z AS (SELECT *, {n} AS n, least({q.SHARDS}, {n}) AS p FROM o),
        y AS (SELECT *, n // p AS size, n % p AS longer FROM z),
        x AS (SELECT *, CASE WHEN pos < longer * (size + 1) THEN pos // (size + 1) ELSE longer + (pos - longer * (size + 1)) // greatest(size, 1) END AS shard FROM y),
        placed AS (SELECT {id_}, text, pos, CAST(shard AS INTEGER) AS shard,
                   CAST((pos - CASE WHEN shard < longer THEN shard * (size + 1) ELSE longer * (size + 1) + (shard - longer) * size END) // {q.BATCH} AS INTEGER) AS batch FROM x)
    """


# The table's rows are in the order of delivery, which DuckDB keeps.
_LATEST = """
    d AS (SELECT *, row_number() OVER () AS i FROM parse_results),
    r AS (SELECT arxiv_id, arg_max(text, i) AS text FROM d WHERE text <> '' AND arxiv_id IS NOT NULL GROUP BY arxiv_id)
"""
_HAS = "coalesce(has_full_text, false)"
#: Papers with a file: its id, and the path that a listing names.
_FILES = "w AS (SELECT record_id, arxiv_id, full_text, regexp_extract(pdf_path, '([^/]*)$', 1) AS name FROM papers WHERE source = 'arxiv' AND pdf_path IS NOT NULL AND full_text IS NOT NULL)"
_ID_OF_NAME = r"replace(regexp_replace(name, '\.[^./]*$', ''), '_', '/')"


def _parsed(wanted: str) -> str:
    """Papers after the plain backend's texts of their files were merged, where they are wanted."""
    return f"""
        WITH {_FILES}, t AS (SELECT {_ID_OF_NAME} AS arxiv_id, full_text AS t FROM w WHERE length({_strip('full_text')}) > 50),
             h AS (SELECT p.*, t, t IS NOT NULL AND {wanted} AS hit FROM papers p LEFT JOIN t ON p.arxiv_id = t.arxiv_id AND p.source = 'arxiv')
        SELECT record_id, CASE WHEN hit THEN t ELSE full_text END AS full_text, CASE WHEN hit THEN 'markdown' ELSE full_text_format END AS full_text_format,
               CASE WHEN hit THEN 'arxiv_pdf_plain' ELSE full_text_source_type END AS full_text_source_type, CASE WHEN hit THEN 'pdf_parsed' ELSE full_text_status END AS full_text_status
        FROM h
    """


#: The plain and the page backend over all full texts; a text above 200 characters has words.
_COMPARED = rf"""
    WITH t AS (SELECT record_id, 'plain' AS backend, full_text AS t FROM papers WHERE full_text IS NOT NULL
               UNION ALL SELECT record_id, 'html', {_page('full_text')} FROM papers WHERE full_text IS NOT NULL),
         u AS (SELECT record_id, backend, CASE WHEN length(t) > 200 THEN t END AS t FROM t)
    SELECT record_id, backend, {_words('t')} AS tokens, coalesce(len(regexp_extract_all(t, '\\[a-zA-Z]+')), 0) AS latex_residue FROM u
"""


def oracle_sql() -> dict[str, str]:
    eval_rows = "CASE WHEN count(*) OVER () > 100 THEN ceil(0.005::DOUBLE * count(*) OVER ()) ELSE 0 END"
    return {
        "papers_by_source_type": "SELECT full_text_source_type, count(*) AS n FROM papers GROUP BY 1",
        "content_hash": f"SELECT record_id, {_hash()} AS content_hash FROM papers",
        "normalized_titles": f"SELECT record_id, {_norm('title')} AS title FROM papers",
        "record_ids": "SELECT doc_id, printf('raw_%06d', doc_id) AS record_id, printf('paper_%06d', doc_id) AS paper_id FROM documents",
        "exact_dedup": f"""
            WITH h AS (SELECT record_id, {_hash()} AS content_hash FROM papers)
            SELECT record_id, content_hash, record_id <> min(record_id) OVER (PARTITION BY content_hash) AS is_duplicate FROM h
        """,
        "split_by_source": """
            SELECT CASE source WHEN 'general' THEN 'general' ELSE 'science' END AS side, source, count(*) AS n, count(DISTINCT id) AS n_ids
            FROM corpus WHERE source IN ('pes2o_or_crawled', 'general') GROUP BY ALL
        """,
        "source_ratio": """
            WITH n AS (SELECT count(*) FILTER (source = 'pes2o_or_crawled') AS n_science, count(*) FILTER (source = 'general') AS n_general FROM corpus)
            SELECT science_ratio_min, science_ratio_max, n_science, n_general,
                   n_science::DOUBLE / (n_science + n_general) BETWEEN science_ratio_min AND science_ratio_max AS in_range FROM n, mix_config
        """,
        "mix_supplement": _mix(True, True),
        "mix_validate_only": _mix(False, False),
        "mix_in_range": _mix(True, False),
        "mix_fewer_science": _mix(True, False, alone=True, bounds=q.LOW_RANGE),
        "mix_more_general": _mix(True, True, bounds=q.LOW_RANGE),
        "mix_without_fallback": _mix(False, False, alone=True),
        "normalize_schema": "SELECT CAST(doc_id AS VARCHAR) AS id, source, url, text, created, added, version FROM documents",
        "token_count": f"SELECT record_id, {_words('clean_text')} AS n_tokens FROM papers",
        "latex_residue": r"SELECT record_id, coalesce(len(regexp_extract_all(full_text, '\\[a-zA-Z]+')), 0) AS n_commands FROM papers",
        "clean_pdf_text": _over_texts(_pdf("full_text")),
        "latex_body": _over_texts(tex.body("full_text")),
        "latex_comments": _over_texts(tex.subs("full_text", *tex.COMMENTS)),
        "latex_equations": _over_texts(tex.subs("full_text", *tex.EQUATIONS)),
        "latex_symbols": _over_texts(tex.symbols("full_text")),
        "latex_formats": _over_texts(tex.subs("full_text", *tex.FORMATTED)),
        "latex_references": _over_texts(tex.subs("full_text", *tex.REFERENCES)),
        "clean_latex": f"SELECT record_id, t AS text FROM ({tex.cleaned('SELECT record_id, full_text FROM papers WHERE full_text IS NOT NULL', 'full_text', 'record_id')})",
        "clean_all_records": f"WITH {_cleaned('arxiv')} SELECT * FROM r",
        "clean_all_untouched": f"""
            SELECT record_id, abstract AS clean_text, {_words('abstract')} AS token_count_approx
            FROM papers WHERE source = 'arxiv' AND (coalesce(full_text_status = 'abstract_only', false) OR NOT {_HAS}) AND abstract <> ''
        """,
        "cleaned_count": f"SELECT count(*) AS n_cleaned FROM papers WHERE source = 'arxiv' AND {_HAS} AND full_text <> ''",
        "detect_language": _language("SELECT doc_id, text FROM documents", "doc_id", "text"),
        "tokenize_utf8_lengths": "SELECT doc_id, strlen(coalesce(text, '')) AS n_tokens FROM documents",
        "tokenize_words": f"SELECT doc_id, {_words('text')} AS n_tokens FROM documents",
        "tokenize_truncate": f"SELECT doc_id, least(strlen(coalesce(text, '')), {q.LENGTH}) AS n_tokens FROM documents",
        "shuffled_positions": f"SELECT doc_id, row_number() OVER (ORDER BY {_key(q.SEED, 'doc_id')}) - 1 AS pos FROM documents",
        "pack_accounting": f"""
            WITH {_geometry()}, b AS (SELECT shard, batch, count(*) AS n_docs, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS n_tokens FROM placed GROUP BY ALL)
            SELECT *, n_tokens // {q.LENGTH} AS n_sequences, n_tokens % {q.LENGTH} AS n_dropped FROM b
        """,
        "pack_sequences": f"""
            WITH {_geometry()}, b AS (SELECT shard, batch, string_agg(hex(encode(coalesce(text, ''))) || 'zz', '' ORDER BY pos) AS s FROM placed GROUP BY ALL),
                 e AS (SELECT shard, batch, s, unnest(range(strlen(s) // {2 * q.LENGTH})) AS k FROM b)
            SELECT shard, batch, CAST(k AS INTEGER) AS k, {q.LENGTH} AS n, md5(substr(s, k * {2 * q.LENGTH} + 1, {2 * q.LENGTH})) AS digest, {q.LENGTH} AS n_attended, digest AS labels FROM e
        """,
        "fixed_blocks": f"""
            WITH n AS (SELECT doc_id, strlen(coalesce(text, '')) AS n FROM documents)
            SELECT doc_id, greatest(n // {q.BLOCK}, 1) AS n_blocks, greatest(n // {q.BLOCK}, 1) * {q.BLOCK} AS n_ids, greatest({q.BLOCK} - n, 0) AS n_padding, greatest(n // {q.BLOCK}, 1) AS n_labelled FROM n
        """,
        "train_eval_split": f"""
            SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY {_key(q.SEED, 'doc_id')}) <= {eval_rows} THEN 'eval' ELSE 'train' END AS split FROM documents
        """,
        "token_stats": f"""
            WITH l AS (SELECT least(strlen(coalesce(text, '')), {q.LENGTH}) AS n, {_key(q.SEED, 'doc_id')} AS k FROM documents),
                 a AS (SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS s, arg_min(n, k) AS f FROM l)
            SELECT 'exact' AS mode, n_rows, s AS n_tokens FROM a UNION ALL SELECT 'logged', n_rows, CASE WHEN f = {q.LENGTH} THEN n_rows * {q.LENGTH} ELSE s END FROM a
        """,
        "assign_rank": f"""
            WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY {_key(q.SEED, 'doc_id')}) - 1 AS pos, count(*) OVER () AS n FROM documents),
                 e AS (SELECT doc_id, pos AS i FROM o UNION ALL SELECT o.doc_id, n + k FROM o, (SELECT unnest(range(7)) AS k) WHERE k < (7 - n % 7) % 7 AND pos = (n + k) % n)
            SELECT doc_id, CAST(i % 7 AS INTEGER) AS rank, i // 7 AS slot FROM e
        """,
        "token_stats_whole": "SELECT 'exact' AS mode, count(*) AS n_rows, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS n_tokens FROM documents",
        "micro_batches": f"""
            WITH o AS (SELECT row_number() OVER (ORDER BY {_key(q.SEED, 'doc_id')}) - 1 AS pos, count(*) OVER () AS n FROM documents),
                 e AS (SELECT pos AS i FROM o UNION ALL SELECT n + k FROM o, (SELECT unnest(range(7)) AS k) WHERE k < (7 - n % 7) % 7 AND pos = (n + k) % n)
            SELECT CAST(i % 7 AS INTEGER) AS rank, i // 7 // 16 AS step, count(*) AS n FROM e GROUP BY ALL
        """,
        "merge_parsed": f"""
            WITH {_LATEST}
            SELECT record_id, coalesce(r.text, full_text) AS full_text, CASE WHEN r.text IS NOT NULL THEN true ELSE has_full_text END AS has_full_text,
                   CASE WHEN r.text IS NOT NULL THEN 'markdown' ELSE full_text_format END AS full_text_format,
                   CASE WHEN r.text IS NOT NULL THEN 'arxiv_pdf_pymupdf4llm' ELSE full_text_source_type END AS full_text_source_type,
                   CASE WHEN r.text IS NOT NULL THEN 'pdf_parsed' ELSE full_text_status END AS full_text_status, r.text IS NOT NULL AS matched
            FROM papers p LEFT JOIN r USING (arxiv_id)
        """,
        "rows_updated": f"WITH {_LATEST} SELECT count(*) AS n_updated FROM papers JOIN r USING (arxiv_id)",
        "skip_done": """
            SELECT record_id, arxiv_id FROM papers p WHERE pdf_path IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM parse_results r WHERE r.arxiv_id = p.arxiv_id AND r.error IS NULL)
        """,
        "done_set": """
            SELECT arxiv_id FROM papers WHERE full_text_status = 'pdf_parsed' AND arxiv_id IS NOT NULL
            UNION SELECT arxiv_id FROM parse_results WHERE arxiv_id IS NOT NULL
        """,
        "replace_targets": """
            SELECT arxiv_id, CASE WHEN pdf_path <> '' THEN pdf_path ELSE 'data/pdf/' || replace(arxiv_id, '/', '_') || '.pdf' END AS path
            FROM papers WHERE full_text_source_type = 'arxiv_pdf_pymupdf' AND arxiv_id <> ''
        """,
        "path_ids": r"SELECT record_id, replace(regexp_extract(pdf_path, '([^/]*?)(?:\.[^./]*)?$', 1), '_', '/') AS arxiv_id FROM papers WHERE pdf_path IS NOT NULL",
        "select_pdf_targets": """
            SELECT record_id, full_text_status, full_text_source_type FROM papers
            WHERE full_text_status = 'pdf_downloaded' OR full_text_source_type = 'arxiv_pdf_pymupdf'
        """,
        "comparison_sample": """
            SELECT record_id, arxiv_id, pdf_path FROM papers WHERE full_text_status IN ('pdf_downloaded', 'success')
            AND full_text_source_type IN ('arxiv_pdf_saved', 'arxiv_pdf_pymupdf') AND pdf_path IS NOT NULL ORDER BY record_id LIMIT 20
        """,
        "parse_backend": f"""
            SELECT record_id, CASE WHEN length({_strip('full_text')}) > 50 THEN full_text END AS text,
                   CASE WHEN length({_strip('full_text')}) > 50 THEN NULL ELSE 'no text' END AS error FROM papers WHERE full_text IS NOT NULL
        """,
        "comparison_summary": """
            SELECT backend, count(*) AS n, count(*) FILTER (preview IS NULL) AS n_failed, CAST(sum(tokens) AS BIGINT) AS tokens,
                   CAST(sum(latex_residue) AS BIGINT) AS latex_residue, quantile_cont(seconds, 0.5) AS median_seconds FROM backend_compare GROUP BY backend
        """,
        "parse_stats": """
            SELECT count(*) AS n, count(*) FILTER (text <> '') AS parsed, count(*) FILTER (coalesce(text, '') = '' AND error IS NOT NULL) AS failed,
                   count(*) FILTER (coalesce(text, '') = '' AND error IS NULL) AS skipped FROM parse_results
        """,
        "corpus_sources": "SELECT DISTINCT source FROM (SELECT source FROM corpus ORDER BY id LIMIT 5000)",
        "parse_backend_html": f"""
            WITH t AS (SELECT record_id, {_page('full_text')} AS p FROM papers WHERE full_text IS NOT NULL)
            SELECT record_id, CASE WHEN length(p) > 50 THEN p END AS text, CASE WHEN length(p) > 50 THEN NULL ELSE 'no text' END AS error FROM t
        """,
        "compare_backends": _COMPARED,
        "comparison_totals": f"""
            SELECT backend, count(*) AS n, count(*) FILTER (failed) AS n_failed, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(sum(latex_residue) AS BIGINT) AS latex_residue
            FROM (SELECT c.*, c.tokens = 0 AS failed FROM ({_COMPARED}) c) GROUP BY backend
        """,
        "load_corpus": f"""
            WITH m AS ({_mix(True, True, with_text=True)}), {_geometry("m", "shuffle_key")},
                 b AS (SELECT CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) // {q.LENGTH} AS n FROM placed GROUP BY shard, batch),
                 h AS (SELECT CAST(sum(n) AS BIGINT) AS n, CASE WHEN sum(n) > 100 THEN CAST(ceil(0.005::DOUBLE * sum(n)) AS BIGINT) ELSE 0 END AS held FROM b),
                 e AS (SELECT 'train' AS split, n - held AS n_sequences FROM h UNION ALL SELECT 'eval', held FROM h)
            SELECT split, n_sequences, n_sequences * {q.LENGTH} AS n_tokens FROM e WHERE n_sequences > 0
        """,
        "load_corpus_unpacked": f"""
            WITH m AS ({_mix(True, True, with_text=True)})
            SELECT 'train' AS split, count(*) AS n_sequences, CAST(sum(least(strlen(coalesce(text, '')), {q.LENGTH})) AS BIGINT) AS n_tokens FROM m
        """,
        "store_round_trip": "SELECT record_id, source, year, title, has_full_text, array_to_string(authors, '|') AS authors, length(full_text) AS n_chars FROM papers",
        "store_replaced": """
            WITH y AS (SELECT year FROM papers WHERE source = 'arxiv' GROUP BY year HAVING bool_or(is_duplicate) AND NOT bool_and(coalesce(is_duplicate, false)))
            SELECT source, year, count(*) AS n, count(*) FILTER (is_duplicate) AS n_duplicates FROM papers
            WHERE NOT (source = 'arxiv' AND coalesce(is_duplicate, false) AND year IN (SELECT year FROM y)) GROUP BY source, year
        """,
        "store_merged": f"""
            WITH {_LATEST}
            SELECT record_id, year, coalesce(r.text, full_text) AS full_text, CASE WHEN r.text IS NOT NULL THEN true ELSE has_full_text END AS has_full_text,
                   CASE WHEN r.text IS NOT NULL THEN 'pdf_parsed' ELSE full_text_status END AS full_text_status
            FROM papers p LEFT JOIN r ON p.arxiv_id = r.arxiv_id AND p.source = 'arxiv'
        """,
        "store_cleaned": f"WITH {_cleaned('arxiv')} SELECT * FROM r UNION ALL SELECT record_id, clean_text, token_count_approx, language FROM papers WHERE source <> 'arxiv'",
        "parse_new_files": _parsed("true"),
        "parse_to_replace": _parsed("p.full_text_source_type = 'arxiv_pdf_pymupdf' AND p.arxiv_id <> ''"),
        "parse_library": f"""
            WITH {_FILES},
                 h AS (SELECT p.*, p.pdf_path IS NOT NULL AND (full_text_status = 'pdf_downloaded' OR full_text_source_type = 'arxiv_pdf_pymupdf') AND length(w.full_text) > 200 AS wanted, w.full_text AS t
                       FROM papers p LEFT JOIN w ON regexp_extract(p.pdf_path, '([^/]*)$', 1) = w.name WHERE source = 'arxiv')
            SELECT record_id, CASE WHEN wanted THEN t ELSE full_text END AS full_text, CASE WHEN wanted THEN t ELSE clean_text END AS clean_text,
                   CASE WHEN wanted THEN 'arxiv_pdf_plain' ELSE full_text_source_type END AS full_text_source_type, CASE WHEN wanted THEN 'success' ELSE full_text_status END AS full_text_status,
                   CAST(CASE WHEN wanted THEN {_words('t')} ELSE token_count_approx END AS INTEGER) AS token_count_approx FROM h
        """,
        "pdf_listing": f"WITH {_FILES} SELECT {_ID_OF_NAME} AS arxiv_id, strlen(full_text) AS length FROM w",
        "whole_files": f"WITH {_FILES} SELECT {_ID_OF_NAME} AS arxiv_id, md5(full_text) AS digest FROM w",
        "corpus_from_json": "SELECT id, source, url, text, created, added, version FROM corpus",
        "corpus_from_parquet": "SELECT id, source, url, text, created, added, CASE WHEN source IS NULL THEN version END AS version FROM corpus",
        "corpus_from_arrow": "SELECT id, source, url, text, created, added, version FROM corpus",
        "papers_of_two_shapes": "SELECT record_id, CASE WHEN source = 'arxiv' THEN license END AS license, CASE WHEN source = 'arxiv' THEN doi END AS doi, year FROM papers",
    }
