"""How many tokens of an existing tokenizer each document holds, and each source, language and domain."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.tokenizers import encoder
from lexloom.llm.common import TOKENIZERS, digest

def token_counts(path: str):
    """Pandas UDF text -> struct(n_tokens, n_words) for the vocabulary file at path, words being what white space separates."""
    kind = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_words", T.LongType())])

    @F.pandas_udf(kind)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for texts in batches:
            yield pd.DataFrame({"n_tokens": [len(encode(t)) for t in texts], "n_words": [len(t.split()) for t in texts]})

    return of


def count_tokens(df: DataFrame, id_cols: Sequence[str], text: str = "clean_text", tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(id columns, _doc, n_tokens, n_words) of every row whose text isn't null.

    Whole texts are hashed and deduplicated, each distinct text is tokenized
    once, and the exact counts are joined back by the digest.  A text that a
    third of the rows share makes a skewed key of that last join, of digests and
    numbers alone, which adaptive execution splits.

    An empty text has 0 tokens; all rows are kept, repeated ones too; null ids
    are kept.
    """
    rows = df.where(F.col(text).isNotNull()).select(*id_cols, digest(F.col(text)).alias("_doc"))
    counted = distinct_counts(df, id_cols[0], text, tokenizers, vocabulary)
    return rows.join(counted, "_doc").select(*id_cols, "_doc", "n_tokens", "n_words")


def distinct_counts(df: DataFrame, id_col: str, text: str, tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(_doc, n_tokens, n_words): one row per distinct text.

    Digests alone are grouped, each with the least hash of an id; the texts of
    these rows are then picked out by a hash join whose built side is digests, so
    that no text is sorted or held.  Rows that repeat an id with its
    text are tokenized again and counted once.
    """
    texts = df.where(F.col(text).isNotNull()).select(digest(F.col(text)).alias("_doc"), F.xxhash64(id_col).alias("_row"), F.col(text).alias("_text"))
    firsts = texts.groupBy("_doc").agg(F.min("_row").alias("_row"))
    n = token_counts(f"{tokenizers}/{vocabulary}")(F.col("_text"))
    counted = texts.join(firsts.hint("shuffle_hash"), ["_doc", "_row"], "left_semi").select("_doc", n.alias("_n"))
    return counted.groupBy("_doc").agg(F.max("_n.n_tokens").alias("n_tokens"), F.max("_n.n_words").alias("n_words"))


def stale_counts(papers: DataFrame, tolerance: float = 0.1, tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(record_id): papers with text whose token_count_approx is null or off by more than `tolerance` of their words.

    Blank texts (nothing but white space) are no cases.
    """
    n = count_tokens(papers, ["record_id", "token_count_approx"], "clean_text", tokenizers, vocabulary)
    off = F.abs(F.col("token_count_approx") - F.col("n_words")) > F.col("n_words") * F.lit(Decimal(str(tolerance)))
    return n.where((F.col("n_words") > 0) & (F.col("token_count_approx").isNull() | off)).select("record_id")


def token_budget(papers: DataFrame, lang_labels: DataFrame, category_domain: DataFrame, text: str = "clean_text", tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """(source, lang, domain, n_docs, n_distinct, n_tokens, n_distinct_tokens, n_words) over papers with text.

    lang is lang_labels' name of the language label, domain that of the first
    category; what has none is null, and null is a group like any other.
    Multiplicities are counted per (text, source, language, domain) before the
    counts are joined, so that a text with many copies is one narrow row there.
    n_distinct counts a text once in each group it occurs in.
    """
    labels = F.broadcast(lang_labels.where(F.col("label").isNotNull()).groupBy(F.col("label").alias("_label")).agg(F.min("lang").alias("lang")))
    domains = F.broadcast(category_domain.where(F.col("category").isNotNull()).groupBy(F.col("category").alias("_category")).agg(F.min("domain").alias("domain")))
    rows = papers.where(F.col(text).isNotNull()).select(
        digest(F.col(text)).alias("_doc"), "source", F.col("language").alias("_label"), F.get("categories", F.lit(0)).alias("_category")
    )
    times = rows.groupBy("_doc", "source", "_label", "_category").agg(F.count(F.lit(1)).alias("_n"))
    named = times.join(labels, "_label", "left").join(domains, "_category", "left")
    times = named.groupBy("_doc", "source", "lang", "domain").agg(F.sum("_n").alias("_n"))
    counted = times.join(distinct_counts(papers, "record_id", text, tokenizers, vocabulary), "_doc")
    return counted.groupBy("source", "lang", "domain").agg(
        F.sum("_n").alias("n_docs"), F.count(F.lit(1)).alias("n_distinct"), F.sum(F.col("_n") * F.col("n_tokens")).alias("n_tokens"),
        F.sum("n_tokens").alias("n_distinct_tokens"), F.sum(F.col("_n") * F.col("n_words")).alias("n_words"),
    )
