"""Extraction backends over documents, with failures kept per row.

A backend is a function bytes -> text.  It runs in Arrow batches; its libraries
are imported on first use, and a missing library or a failing document gives an
error beside a null text instead of failing the task.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import cleaning, text

Backend = Callable[[bytes], str | None]

# An output counts as text above so many characters, unstripped in the library profile, stripped in the batch one.
LEAST_LIBRARY, LEAST_BATCH, PREVIEW = 200, 50, 400


class _Text(HTMLParser):
    """The text of a page, block by block; what is in scripts and styles isn't text."""

    def __init__(self) -> None:
        super().__init__()
        self.parts: list[str] = []
        self.mute = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.mute += tag in ("script", "style")
        if tag in ("p", "div", "br", "li", "tr", "h1", "h2", "h3", "h4", "h5", "h6"):
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        self.mute -= tag in ("script", "style") and self.mute > 0

    def handle_data(self, data: str) -> None:
        if not self.mute:
            self.parts.append(data)


def html_text(content: bytes) -> str:
    reader = _Text()
    reader.feed(content.decode("utf-8", "replace"))
    reader.close()
    return re.sub(r"\n{2,}", "\n", re.sub(r"[ \t]+", " ", "".join(reader.parts))).strip()


def plain_text(content: bytes) -> str:
    return content.decode("utf-8", "replace")


def _pymupdf(content: bytes) -> str:
    import fitz

    with fitz.open(stream=content, filetype="pdf") as document:
        return "\n".join(p for p in (page.get_text("text") for page in document) if p.strip())


def _pymupdf4llm(content: bytes) -> str:
    import fitz
    import pymupdf4llm

    with fitz.open(stream=content, filetype="pdf") as document:
        return pymupdf4llm.to_markdown(document)


def _docling(content: bytes) -> str:
    import io

    from docling.datamodel.base_models import DocumentStream, InputFormat
    from docling.datamodel.pipeline_options import PdfPipelineOptions
    from docling.document_converter import DocumentConverter, PdfFormatOption

    options = PdfPipelineOptions(do_formula_enrichment=True, do_table_structure=True)
    converter = DocumentConverter(format_options={InputFormat.PDF: PdfFormatOption(pipeline_options=options)})
    return converter.convert(DocumentStream(name="document.pdf", stream=io.BytesIO(content))).document.export_to_markdown()


def mineru(language: str = "ch") -> Backend:
    """The backend for one of the library's languages; it finds out per document whether to recognise characters or to take the text there is."""

    def run(content: bytes) -> str:
        import tempfile
        from pathlib import Path

        from mineru.cli.common import do_parse

        with tempfile.TemporaryDirectory() as folder:
            do_parse(folder, ["document"], [content], [language], backend="pipeline", parse_method="auto")
            return next(Path(folder).rglob("*.md")).read_text("utf-8")

    return run


BACKENDS: dict[str, Backend] = {"html": html_text, "plain": plain_text, "pymupdf": _pymupdf, "pymupdf4llm": _pymupdf4llm, "docling": _docling, "mineru": mineru()}
#: Backends whose output is cleaned as text extracted from a PDF.
RAW = {"pymupdf"}


def register(name: str, backend: Backend) -> None:
    """Adds a backend under a name."""
    BACKENDS[name] = backend


def backend_of(name: str) -> Backend:
    if name not in BACKENDS:
        raise ValueError(f"no such backend: {name}; there are {sorted(BACKENDS)}")
    return BACKENDS[name]


def read_content(path: str) -> bytes:
    """The bytes of a file, on this machine or on whatever file system its scheme names."""
    if "://" not in path:
        with open(path.removeprefix("file:"), "rb") as file:
            return file.read()
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path)
    with system.open_input_stream(at) as file:
        return file.read()


def parse(df: DataFrame, backend: str, content: str = "content", profile: str = "batch", path: str | None = None) -> DataFrame:
    """df with `text`, `error` and `seconds` instead of its content.

    With path, the tasks read the files that this column names instead, and the
    column stays.  The batch profile wants more than 50 characters without outer
    white space, the library profile more than 200 with it; less is an error.
    Null content and missing files are errors too.  The output of backends in
    RAW is cleaned in the library profile.
    """
    run, stripped = backend_of(backend), profile == "batch"
    least = LEAST_BATCH if stripped else LEAST_LIBRARY

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                began = time.perf_counter()
                try:
                    value = read_content(value) if value is not None and path else value
                    out = run(bytes(value)) if value is not None else None
                    found = out is not None and len(out.strip() if stripped else out) > least
                    rows.append((text.scrub_surrogates(out) if found else None, None if found else "no text"))
                except ImportError as e:
                    rows.append((None, f"backend not installed: {e.name}"))
                except Exception as e:
                    rows.append((None, f"{type(e).__name__}: {e}"))
                rows[-1] += (time.perf_counter() - began,)
            yield pd.DataFrame(rows, columns=["text", "error", "seconds"])

    result = F.pandas_udf(of, "text string, error string, seconds double")
    keep = [c for c in df.columns if c not in ((() if path else (content,)) + ("text", "error", "seconds"))]
    found = df.select(*keep, result(F.col(path or content)).alias("_r"))
    out = cleaning.clean_pdf_text(F.col("_r.text")) if backend in RAW and not stripped else F.col("_r.text")
    return found.select(*keep, out.alias("text"), "_r.error", "_r.seconds")


def compare_backends(df: DataFrame, backends: Sequence[str], id_col: str = "arxiv_id", content: str = "content") -> DataFrame:
    """(<id>, backend, preview, tokens, latex_residue, seconds) for each row and backend, in long form."""
    each = [parse(df.select(id_col, content), b, content, "library").withColumn("backend", F.lit(b)) for b in backends]
    rows = reduce(DataFrame.unionByName, each)
    return rows.select(
        id_col, "backend", F.substring("text", 1, PREVIEW).alias("preview"), text.token_count(F.col("text")).alias("tokens"),
        text.latex_residue(F.col("text")).alias("latex_residue"), "seconds",
    )


def summarize_comparison(compared: DataFrame) -> DataFrame:
    """(backend, n, n_failed, tokens, latex_residue, median_seconds) of compare_backends' rows."""
    return compared.groupBy("backend").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("preview").isNull()).alias("n_failed"), F.sum("tokens").alias("tokens"),
        F.sum("latex_residue").alias("latex_residue"), F.percentile("seconds", 0.5).alias("median_seconds"),
    )


def parse_stats(results: DataFrame) -> DataFrame:
    """(n, parsed, failed, skipped) of results; skipped are those with neither text nor error."""
    parsed, failed = text.truthy(F.col("text")), F.col("error").isNotNull()
    return results.agg(F.count(F.lit(1)).alias("n"), F.count_if(parsed).alias("parsed"), F.count_if(~parsed & failed).alias("failed"), F.count_if(~parsed & ~failed).alias("skipped"))


def library_update(papers: DataFrame, parsed: DataFrame, backend: str, id_col: str = "record_id") -> DataFrame:
    """papers with the texts of parsed (<id>, text) as the library profile sets them: clean text, tokens and language too.

    Of several texts for one id the greatest counts.
    """
    texts = parsed.where(text.truthy(F.col("text"))).groupBy(id_col).agg(F.max("text").alias("_text"))
    fresh = papers.join(texts, id_col, "left")
    hit = F.col("_text").isNotNull()
    clean = F.col("_text")
    set_to = {
        "full_text": clean, "clean_text": clean, "has_full_text": F.lit(True), "full_text_format": F.lit("pdf_markdown"), "full_text_source_type": F.lit(f"arxiv_pdf_{backend}"),
        "full_text_status": F.lit("success"), "token_count_approx": text.token_count(clean), "language": text.detect_language(clean),
    }
    return fresh.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in set_to.items()}).select(*papers.columns)
