"""Tokenized texts packed into sequences of one length, fixed blocks, and token statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.functions.tokenizers import encoder


def tokenize(df: DataFrame, tokenizer: str = "utf8", text: str = "text", max_length: int | None = None, out: str = "input_ids") -> DataFrame:
    """df with the text's ids instead of its text; with max_length, cut to it (for use without packing).  Null counts as empty."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(tokenizer)
        for texts in batches:
            yield pd.Series([encode(t)[:max_length] if t else [] for t in texts])

    return df.withColumn(out, ids(F.col(text))).drop(text)


def token_length(text: Column, max_length: int | None = None) -> Column:
    """How many ids the byte tokenizer gives, without making them."""
    n = F.coalesce(F.octet_length(text), F.lit(0))
    return F.least(n, F.lit(max_length)) if max_length is not None else n


def geometry(pos: Column, n: int, batch_size: int, shards: int) -> tuple[Column, Column]:
    """(shard, batch) of a position: contiguous shards, the first n mod shards of them one row longer, cut into batches."""
    shards = max(1, min(shards, n))
    size, longer = divmod(n, shards)
    edge = longer * (size + 1)
    tail = F.lit(longer) + F.floor((pos - edge) / F.lit(max(1, size)))
    shard = F.when(pos < edge, F.floor(pos / (size + 1))).otherwise(tail)
    start = F.when(pos < edge, shard * (size + 1)).otherwise(edge + (shard - longer) * size)
    return shard.cast("int"), F.floor((pos - start) / batch_size).cast("int")


def pack(df: DataFrame, length: int, eos: int | None, ids: str = "input_ids", pos: str = "pos", batch_size: int = 1000, shards: int = 1, n: int | None = None) -> DataFrame:
    """(shard, batch, k, input_ids, attention_mask, labels), every sequence `length` long.

    Each document is followed by eos; the ids of a batch of documents are laid
    end to end and cut; what is left at the end of a batch is dropped.  A group
    is a batch, so it is bounded.  The arrays stay in the JVM.
    """
    if eos is None:
        raise ValueError("packing needs an id that ends a document")
    shard, batch = geometry(F.col(pos), n if n is not None else df.count(), batch_size, shards)
    docs = df.select(shard.alias("shard"), batch.alias("batch"), F.struct(F.col(pos).alias("pos"), F.concat(F.coalesce(F.col(ids), F.array().cast("array<int>")), F.array(F.lit(eos))).alias("ids")).alias("d"))
    flat = docs.groupBy("shard", "batch").agg(F.flatten(F.transform(F.array_sort(F.collect_list("d")), lambda d: d["ids"])).alias("ids"))
    whole = F.floor(F.size("ids") / length).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), whole - 1), lambda k: F.slice("ids", k * length + 1, length))
    rows = flat.where(whole > 0).select("shard", "batch", F.posexplode(cuts).alias("k", "input_ids"))
    return rows.select("shard", "batch", "k", "input_ids", F.array_repeat(F.lit(1), length).alias("attention_mask"), F.col("input_ids").alias("labels"))


def pack_accounting(lengths: DataFrame, length: int, n_tokens: str = "n_tokens", pos: str = "pos", batch_size: int = 1000, shards: int = 1, n: int | None = None) -> DataFrame:
    """(shard, batch, n_docs, n_tokens, n_sequences, n_dropped) of packing, from lengths alone."""
    shard, batch = geometry(F.col(pos), n if n is not None else lengths.count(), batch_size, shards)
    per = lengths.groupBy(shard.alias("shard"), batch.alias("batch")).agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col(n_tokens) + 1).alias("n_tokens"))
    return per.withColumn("n_sequences", F.floor(F.col("n_tokens") / length)).withColumn("n_dropped", F.col("n_tokens") % length)


def fixed_blocks(df: DataFrame, size: int, eos: int, ids: str = "input_ids") -> DataFrame:
    """df's other columns with (block_id, input_ids, labels): blocks of one size; the rest is dropped, but a short text gives one padded block."""
    keep = [c for c in df.columns if c != ids]
    n = F.floor(F.size(ids) / size).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda k: F.slice(ids, k * size + 1, size))
    padded = F.array(F.concat(F.col(ids), F.array_repeat(F.lit(eos), F.lit(size) - F.size(ids))))
    rows = df.select(*keep, F.posexplode(F.when(n > 0, cuts).otherwise(padded)).alias("block_id", "input_ids"))
    return rows.withColumn("labels", F.col("input_ids"))


def token_stats(df: DataFrame, max_length: int, ids: str = "input_ids", pos: str = "pos", exact: bool = True) -> DataFrame:
    """(n_rows, n_tokens).  exact: the sum of lengths.  Else rows times max_length where the first row is that long, as trainers log it."""
    size = F.size(ids)
    sums = df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(size), F.lit(0)).cast("long").alias("_sum"), F.min_by(size, F.col(pos)).alias("_first"))
    packed = F.when(F.col("_first") == max_length, F.col("n_rows") * max_length).otherwise(F.col("_sum"))
    return sums.select("n_rows", (F.col("_sum") if exact else packed).alias("n_tokens"))
