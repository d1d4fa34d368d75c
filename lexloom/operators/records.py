"""Operators of the paper table: cleaning, deduplication, merging of results, work lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import cleaning, text
from lexloom.operators import parsing

# States, formats and source types of a paper's full text.
ABSTRACT_ONLY, DOWNLOADED, PARSED, SUCCESS = "abstract_only", "pdf_downloaded", "pdf_parsed", "success"
PDF_TEXT, MARKDOWN, PDF_MARKDOWN, LATEX = "pdf_text", "markdown", "pdf_markdown", "latex"
SAVED, PYMUPDF = "arxiv_pdf_saved", "arxiv_pdf_pymupdf"
SOURCE_TYPES = {"pymupdf4llm": "arxiv_pdf_pymupdf4llm", "docling": "arxiv_pdf_docling", "mineru": "arxiv_pdf_mineru", "pymupdf": "arxiv_pdf_pymupdf"}


def is_true(c: Column) -> Column:
    """True for true alone; null is false, so that its negation keeps nulls."""
    return c.eqNullSafe(F.lit(True))


def clean_all(papers: DataFrame, strict_format: bool = False) -> DataFrame:
    """clean_text, token_count_approx and language set anew where there is something to set them from.

    Papers with full text are cleaned by their format: `pdf_text` as extracted
    text, all else as TeX (with strict_format, TeX only for `latex`; Markdown and
    unknown formats stay as they are).  Papers known by their abstract alone, or
    not marked as having full text, then take their abstract, which sets no
    language.  What neither applies to keeps its values.
    """
    has = is_true(F.col("has_full_text"))
    first = has & text.truthy(F.col("full_text"))
    is_pdf = F.col("full_text_format").eqNullSafe(PDF_TEXT)
    as_tex = first & ~is_pdf & (F.col("full_text_format").eqNullSafe(LATEX) if strict_format else F.lit(True))
    # The UDF gets the rows it is for; the others reach it as null.
    tex = cleaning.clean_latex(F.when(as_tex, F.col("full_text")))
    cleaned = papers.withColumn("_full", F.when(first & is_pdf, cleaning.clean_pdf_text(F.col("full_text"))).when(as_tex, tex).when(first, F.col("full_text")))
    second = (F.col("full_text_status").eqNullSafe(ABSTRACT_ONLY) | ~has) & text.truthy(F.col("abstract"))
    out = F.when(second, F.col("abstract")).when(first, F.col("_full")).otherwise(F.col("clean_text"))
    return cleaned.withColumns({
        "clean_text": out,
        "token_count_approx": F.when(second | first, text.token_count(out)).otherwise(F.col("token_count_approx")).cast("int"),
        "language": F.when(first, text.detect_language(F.col("_full"))).otherwise(F.col("language")),
    }).drop("_full")


def cleaned_count(papers: DataFrame) -> DataFrame:
    """(n_cleaned): how many papers have a full text that clean_all cleans."""
    return papers.agg(F.count_if(is_true(F.col("has_full_text")) & text.truthy(F.col("full_text"))).alias("n_cleaned"))


def exact_dedup(papers: DataFrame, id_col: str = "record_id") -> DataFrame:
    """(<id>, content_hash, is_duplicate) with the hash computed anew; the smallest id of a hash is no duplicate.

    The smallest ids are found by partial aggregation and joined back, so that a
    hash shared by a third of the rows is never one window.
    """
    hashed = papers.select(id_col, text.content_hash(F.col("title"), F.col("abstract")).alias("content_hash"))
    firsts = hashed.groupBy("content_hash").agg(F.min(id_col).alias("_first"))
    return hashed.join(firsts, "content_hash").select(id_col, "content_hash", (F.col(id_col) != F.col("_first")).alias("is_duplicate"))


def latest_results(results: DataFrame, key: str = "arxiv_id", order: Sequence[str] = ("delivered",)) -> DataFrame:
    """One result per key, the last in the order of delivery; without it, a merge would multiply rows."""
    kept = [c for c in results.columns if c != key and c not in order]
    return results.groupBy(key).agg(F.max_by(F.struct(*kept), F.struct(*order)).alias("_r")).select(key, "_r.*")


def merge_parsed(papers: DataFrame, results: DataFrame, backend: str = "pymupdf4llm", key: str = "arxiv_id", order: Sequence[str] = ("delivered",)) -> DataFrame:
    """papers with the texts of results: matched papers are updated in five columns, unmatched results are dropped.

    Results without text don't count; of several for one key the last delivered
    does, by the columns of `order`, which results must have.  Adds `_matched`,
    for counting updates.
    """
    if backend not in SOURCE_TYPES and backend not in parsing.BACKENDS:
        raise ValueError(f"no such backend: {backend}")
    if missing := [c for c in order if c not in results.columns]:
        raise KeyError(f"no columns {missing} to order results by")
    texts = latest_results(results.where(text.truthy(F.col("text")) & F.col(key).isNotNull()).select(key, "text", *order), key, order)
    merged = papers.join(texts.withColumnRenamed("text", "_text"), key, "left")
    hit = F.col("_text").isNotNull()
    set_to = {"full_text": F.col("_text"), "has_full_text": F.lit(True), "full_text_format": F.lit(MARKDOWN), "full_text_source_type": F.lit(SOURCE_TYPES.get(backend, f"arxiv_pdf_{backend}")), "full_text_status": F.lit(PARSED)}
    return merged.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in set_to.items()} | {"_matched": hit}).drop("_text").select(*papers.columns, "_matched")


def skip_done(work: DataFrame, done: DataFrame, key: str = "arxiv_id", failed_too: bool = False) -> DataFrame:
    """The work that isn't done.  done is (<key>[, error]); failures are tried again unless failed_too."""
    if not failed_too and "error" in done.columns:
        done = done.where(F.col("error").isNull())
    return work.join(done.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_anti")


def done_set(done: DataFrame, new: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Union of two sets of keys."""
    return done.select(key).union(new.select(key)).distinct()


def replace_targets(papers: DataFrame, source_type: str, folder: str, existing: DataFrame | None = None) -> DataFrame:
    """(arxiv_id, path) of papers whose text came from source_type and is to be replaced; a missing path is made from the id.

    existing, a listing with a column `path`, keeps the targets whose file is there.
    """
    rows = papers.where(F.col("full_text_source_type") == source_type).where(text.truthy(F.col("arxiv_id")))
    out = rows.select("arxiv_id", F.when(text.truthy(F.col("pdf_path")), F.col("pdf_path")).otherwise(text.path_of_id(F.col("arxiv_id"), folder)).alias("path"))
    return out if existing is None else out.join(existing.select("path").distinct(), "path", "left_semi").select("arxiv_id", "path")


def pdf_targets(papers: DataFrame, redo_pymupdf: bool = False, max_items: int | None = None, order: str = "record_id") -> DataFrame:
    """Papers whose PDF was downloaded and not parsed, with redo_pymupdf also those the plainest backend parsed; the first max_items by `order` if given."""
    wanted = F.col("full_text_status") == DOWNLOADED
    if redo_pymupdf:
        wanted = wanted | (F.col("full_text_source_type") == PYMUPDF)
    rows = papers.where(wanted)
    return rows.orderBy(order).limit(max_items) if max_items else rows


def comparison_rows(papers: DataFrame, sample: int, statuses: Sequence[str] = (DOWNLOADED, SUCCESS), types: Sequence[str] = (SAVED, PYMUPDF), order: str = "record_id") -> DataFrame:
    """The first rows by `order` with a PDF in given states and source types."""
    rows = papers.where(F.col("full_text_status").isin(list(statuses)) & F.col("full_text_source_type").isin(list(types))).dropna(subset=["pdf_path"])
    return rows.orderBy(order).limit(sample)
