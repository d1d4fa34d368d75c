"""Whole pipelines over stores and corpora: from a configuration to training sequences, from PDFs to texts in the store, cleaning in place."""

from __future__ import annotations

import json
from collections.abc import Mapping
from math import ceil
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text
from lexloom.functions.tokenizers import EOS
from lexloom.operators import mixing, order, packing, parsing, records
from lexloom.sources.readers import folders_of, read_corpus, read_folders, read_papers, read_results
from lexloom.sources.storage import Files, cut
from lexloom.sources.writers import replace_papers
from lexloom.streaming.ingest import merge_into_store


def read_config(path: str) -> dict[str, Any]:
    """A configuration in JSON or YAML, by the file's suffix."""
    raw = Path(path).read_text("utf-8")
    if path.endswith(".json"):
        return json.loads(raw)
    import yaml

    return yaml.safe_load(raw)


def load_corpus(
    spark: SparkSession, config: Mapping[str, Any], fallbacks: Mapping[str, DataFrame] | None = None, tokenizer: str = "utf8", eos: int | None = None,
    corpus: DataFrame | None = None, orders: Mapping[str, list] | None = None, batch_size: int = 1000, shards: int | None = None,
) -> dict[str, DataFrame]:
    """{"train", "eval"}: the sequences that a configuration asks for; without an evaluation part, eval is empty and has the same columns.

    The configuration has `data` (path, source_field, text_field,
    science_source_values, general_source_values, mixing, packing) and `training`
    (seed, max_seq_length, preprocess_num_proc).  mixing names fallback corpora,
    which `fallbacks` maps to tables and `orders` to what puts them in order; ids
    are taken from their column `id` where they have one.  Without packing the
    documents themselves, cut to the length, are the sequences.  The mixed texts
    and the sequences are written once, as they are counted.
    """
    data, training = config["data"], config.get("training") or {}
    mix, pack_config = data["mixing"], data.get("packing") or {}
    field, seed, length = data.get("text_field", "text"), training.get("seed", 42), training.get("max_seq_length", 4096)
    rows = corpus if corpus is not None else read_corpus(spark, data["path"])
    if field != "text":
        rows = rows.drop("text").withColumnRenamed(field, "text")
    science, general = mixing.split_by_source(rows, data.get("science_source_values") or [], data.get("general_source_values") or [], data.get("source_field", "source"))
    names = [mix.get("science_fallback_hf"), mix.get("general_fallback_hf")]
    others = [(fallbacks or {}).get(n) if n else None for n in names]
    ids = ["id" if o is not None and "id" in o.columns else None for o in others]
    texts = [mix.get(f"fallback_text_field_{side}", "text") for side in ("science", "general")]
    sorted_by = [(orders or {}).get(n) or [i or t] for n, i, t in zip(names, ids, texts)]
    mixed = cut(mixing.adjust_mixing(
        science, general, mix["science_ratio_min"], mix["science_ratio_max"], mix.get("auto_balance", True), others[0], others[1],
        seed, sorted_by[0], sorted_by[1], ids, texts,
    ))
    packed = pack_config.get("enabled", True)
    n = mixed.count()
    placed = order.with_position(mixed.select("shuffle_key", "text"), seed, ["shuffle_key"], n=n)
    tokens = packing.tokenize(placed, tokenizer, max_length=None if packed else length)
    if packed:
        end = eos if eos is not None else EOS.get(tokenizer)
        done = packing.pack(tokens, length, end, batch_size=batch_size, shards=shards or training.get("preprocess_num_proc", 4), n=n)
        keys = ["shard", "batch", "k"]
    else:
        done, keys = tokens.select("pos", "input_ids"), ["pos"]
    done = cut(done)
    split = order.train_eval_split(done, float(pack_config.get("eval_split", 0.005)), seed, keys)
    return {side: split.where(F.col("split") == side).drop("split") for side in ("train", "eval")}


def token_report(parts: Mapping[str, DataFrame]) -> DataFrame:
    """(split, n_sequences, n_tokens) of load_corpus's parts; an empty part has no row."""
    sized = [df.select(F.lit(side).alias("split"), F.size("input_ids").alias("n")) for side, df in parts.items()]
    rows = sized[0]
    for more in sized[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_sequences"), F.sum("n").alias("n_tokens"))


def clean_store(spark: SparkSession, data_dir: str, source: str = "arxiv", strict_format: bool = False) -> int:
    """Cleans all records of a source and writes their years anew; gives how many full texts were cleaned.

    A damaged file is an error, as its rows would be lost.
    """
    papers = read_folders(spark, data_dir, source, folders_of(spark, data_dir, source, key="record_id"))
    n = records.cleaned_count(papers).first()["n_cleaned"]
    replace_papers(records.clean_all(papers, strict_format), data_dir, source)
    return n


def parse_library(spark: SparkSession, data_dir: str, backend: str = "docling", max_items: int | None = None, redo_pymupdf: bool = False, source: str = "arxiv", dry_run: bool = False) -> dict[str, int]:
    """Parses the downloaded PDFs of a source and writes their texts, clean texts, token counts and languages into the store.

    Gives how many were parsed, failed (a missing file is a failure) and skipped;
    with dry_run nothing is read or written and `selected` tells how many there are.
    """
    parsing.backend_of(backend)
    papers = read_papers(spark, data_dir, source, skip_corrupt=False)
    work = records.pdf_targets(papers, redo_pymupdf, max_items).select("record_id", "pdf_path")
    if dry_run:
        return {"selected": work.count()}
    done = cut(parsing.parse(work, backend, profile="library", path="pdf_path"))
    stats = parsing.parse_stats(done).first()
    if stats["parsed"]:
        folders = folders_of(spark, data_dir, source, done.where(text.truthy(F.col("text"))), "record_id")
        replace_papers(parsing.library_update(read_folders(spark, data_dir, source, folders), done, backend), data_dir, source)
    return {k: stats[k] for k in ("parsed", "failed", "skipped")}


def work_list(spark: SparkSession, data_dir: str, pdf_dir: str, replace_source: str | None = None, source: str = "arxiv") -> DataFrame:
    """(arxiv_id, path) of the PDFs to parse: all in a folder, or, to replace the texts of a source type, those of its papers whose file is in the folder."""
    if Files(spark, pdf_dir).is_folder(pdf_dir):
        there = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(pdf_dir).select("path")
    else:
        there = spark.createDataFrame([], "path string")
    if replace_source is None:
        return there.select(text.id_of_path(F.col("path")).alias("arxiv_id"), "path")
    targets = records.replace_targets(read_papers(spark, data_dir, source), replace_source, pdf_dir)
    # A listing names files by full paths, papers by whatever they were stored under; the ids their names stand for agree.
    listed = there.select(text.id_of_path(F.col("path")).alias("arxiv_id"), "path")
    return targets.select("arxiv_id").distinct().join(listed, "arxiv_id")


def parse_batch(
    spark: SparkSession, data_dir: str, pdf_dir: str, results_dir: str, backend: str = "pymupdf4llm", replace_source: str | None = None, chunk: int = 500,
    dry_run: bool = False, source: str = "arxiv",
) -> dict[str, int]:
    """Parses the PDFs that aren't done and merges their texts into the store; gives the numbers total, done, left, parsed, failed and saved.

    Results go to results_dir/<key>, where the key names the backend and, in
    replace mode, the source type too; what is there is done, failures included.
    Texts are merged from there, and marked as merged afterwards, so that a run
    that ended between the two is made up for by the next.  A task parses about
    `chunk` files.  With dry_run nothing is parsed or written.
    """
    parsing.backend_of(backend)
    key = backend if replace_source is None else f"{backend}_replace_{replace_source}"
    results, merged = f"{results_dir.rstrip('/')}/{key}/results", f"{results_dir.rstrip('/')}/{key}/merged"
    files = Files(spark, results_dir)
    done = read_results(spark, results) if files.is_folder(results) else None
    work = cut(work_list(spark, data_dir, pdf_dir, replace_source, source))
    left = records.skip_done(work, done, failed_too=True) if done is not None else work
    counts = {"total": work.count(), "done": done.select("arxiv_id").distinct().count() if done is not None else 0, "left": left.count()}
    if dry_run:
        return counts
    if counts["left"]:
        parsed = parsing.parse(left.repartition(max(1, ceil(counts["left"] / chunk)), "arxiv_id"), backend, path="path")
        parsed.select("arxiv_id", "text", "error").write.mode("append").parquet(results)
    if not files.is_folder(results):
        return counts | {"parsed": 0, "failed": 0, "saved": 0}
    every = read_results(spark, results)
    if files.is_folder(merged):
        every = every.join(spark.read.schema("arxiv_id string").parquet(merged), "arxiv_id", "left_anti")
    fresh = cut(every)
    stats = parsing.parse_stats(fresh).first()
    saved = 0
    if stats["parsed"]:
        ids = fresh.where(text.truthy(F.col("text"))).select("arxiv_id").distinct()
        saved = read_papers(spark, data_dir, source).select("arxiv_id").join(ids, "arxiv_id", "left_semi").count()
        merge_into_store(fresh, data_dir, source, backend)
    fresh.select("arxiv_id").distinct().write.mode("append").parquet(merged)
    return counts | {"parsed": stats["parsed"], "failed": stats["failed"] + stats["skipped"], "saved": saved}
