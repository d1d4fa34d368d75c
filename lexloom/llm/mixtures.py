"""Records of several sources combined so that each has its target share of the tokens.

The quota of each source is exact up to less than its shortest document that is left.  A multivariate
hypergeometric splitting tree deals blocks of the sources to output shards: the
blocks of a range of shards are split between its halves by a seeded draw that
depends on the range alone, so each shard finds its own quotas by walking down
from the root, in parallel and again after a loss.  Within a source the blocks
are permuted by a keyed bijection, of which each shard takes its own stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexloom.llm.common import TOKENIZERS, cut
from lexloom.llm.token_budget import count_tokens

SEED = 20_240_229
#: Tokens of a block and of an output shard.
BLOCK_TOKENS, SHARD_TOKENS = 16_384, 1_000_000
#: Rows that one task puts in order.
BUCKET_ROWS = 50_000


def quotas(available: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens to take of each source.

    Without a total, the largest one at which every source that has tokens can
    give its share with at most its repeats; the shares of sources that have none
    are spread over the others in proportion.  With a total, sources that are too
    small give all they can, and what they lack is spread likewise.
    """
    limit = {s: available.get(s, 0) * max(0, r) for s, share, r in targets}
    share = {s: x for s, x, _ in targets if x > 0 and limit[s] > 0}
    if not share:
        return {s: 0 for s, _, _ in targets}
    if total is None:
        whole = sum(share.values())
        total = int(min(limit[s] / (x / whole) for s, x in share.items()) + 1e-6)
    out = {s: 0 for s, _, _ in targets}
    open_, rest = dict(share), float(total)
    while open_:
        whole = sum(open_.values())
        short = [s for s, x in open_.items() if limit[s] < rest * x / whole - 1e-9]
        if not short:
            for s, x in open_.items():
                out[s] = min(limit[s], round(rest * x / whole))
            break
        for s in short:
            out[s] = limit[s]
            rest -= limit[s]
            del open_[s]
    return out


def shard_quotas(shard: int, shards: int, blocks: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, counts) of the blocks of each source that a shard draws."""
    total = int(blocks.sum())
    edge = lambda k: total * k // shards
    low, high, counts, offset = 0, shards, blocks.astype(np.int64), np.zeros(len(blocks), dtype=np.int64)
    while high - low > 1:
        mid = (low + high) // 2
        draw = np.random.default_rng([seed, low, high])
        left = _hypergeometric(draw, counts, edge(mid) - edge(low))
        if shard < mid:
            counts, high = left, mid
        else:
            counts, offset, low = counts - left, offset + left, mid
    return offset, counts


def hypergeometric(draw: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n things drawn from good and bad ones are good, for populations of any size.

    The probabilities around the mode follow from it by the ratios of neighbours,
    without factorials; beyond twelve standard deviations they are less than what
    a double can tell from the rest.
    """
    low, high, whole = max(0, n - bad), min(n, good), good + bad
    if low == high:
        return low
    mode = min(high, max(low, (n + 1) * (good + 1) // (whole + 2)))
    spread = (n * (good / whole) * (bad / whole) * ((whole - n) / max(1, whole - 1))) ** 0.5
    reach = int(12 * spread) + 64
    up = np.arange(mode, min(high, mode + reach), dtype=float)
    down = np.arange(mode, max(low, mode - reach), -1, dtype=float)
    above = np.cumprod((good - up) * (n - up) / ((up + 1) * (bad - n + up + 1)))
    below = np.cumprod(down * (bad - n + down) / ((good - down + 1) * (n - down + 1)))
    sums = np.cumsum(np.concatenate([below[::-1], [1.0], above]))
    return mode - len(below) + int(np.searchsorted(sums, draw.random() * sums[-1], side="right"))


def _hypergeometric(draw: np.random.Generator, counts: np.ndarray, n: int) -> np.ndarray:
    """Multivariate hypergeometric draw of n of the counted blocks, one source after the other."""
    out, rest = np.zeros_like(counts), int(counts.sum())
    for i, c in enumerate(counts.tolist()):
        rest -= c
        out[i] = hypergeometric(draw, c, rest, n)
        n -= int(out[i])
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed bijection of 0..size-1: a Feistel network, walked until it falls within the range."""
    if size < 2:
        return index.astype(np.int64)
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    value = index.astype(np.uint64)
    todo = np.ones(len(value), dtype=bool)
    while todo.any():
        left, right = value[todo] >> np.uint64(half), value[todo] & mask
        for turn in range(4):
            mix = (right + np.uint64((key * 0x9E3779B97F4A7C15 + turn * 0xD1B54A32D192ED03) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
            mix ^= mix >> np.uint64(29)
            mix *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mix >> np.uint64(31)) & mask)
        value[todo] = (left << np.uint64(half)) | right
        todo = value >= np.uint64(size)
    return value.astype(np.int64)


def _running(rows: DataFrame, per: list[str], order: list[str], n_buckets: int, sums: dict[str, str], hashed: str) -> DataFrame:
    """rows with exclusive running sums within `per`, ordered by `order` (whose first is the hash): buckets of hash ranges first, so that no group is one task."""
    width = (1 << 62) // n_buckets + 1
    bucketed = rows.withColumn("_bucket", F.floor(F.shiftrightunsigned(F.col(hashed), 2) / F.lit(width)).cast("int"))
    totals = bucketed.groupBy(*per, "_bucket").agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums.values())])
    before = W.partitionBy(*per).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(*per, "_bucket", *[F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}") for i in range(len(sums))])
    within = W.partitionBy(*per, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = bucketed.withColumns({f"_w{i}": F.coalesce(F.sum(c).over(within), F.lit(0)) for i, c in enumerate(sums.values())})
    out = inner.join(offsets, [*per, "_bucket"])
    return out.withColumns({name: F.col(f"_w{i}") + F.col(f"_o{i}") for i, name in enumerate(sums)}).select(*rows.columns, *sums)


def mix_sources(
    df: DataFrame, targets: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", total: int | None = None, seed: int = SEED, fill: bool = False,
    tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken", block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """(shard, pos, <id>, copy, source, n_tokens): the selection, dealt to shards and shuffled within each.

    With fill, the total is all the tokens of the listed sources, whatever the
    scarcest of them has: too small ones fall short and the others fill up.
    A document occurs at most max_repeats times, as copies 1, 2 ...  Documents
    without tokens, with a null text or of a source that isn't listed are never
    selected.  Ids should be unique; a repeated one is a document of its own.
    """
    spark: SparkSession = df.sparkSession
    wanted = [(r["source"], float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in targets.where(F.col("source").isNotNull()).orderBy("source").collect()]
    names = [s for s, _, _ in wanted]
    listed = F.broadcast(targets.where(F.col("source").isNotNull()).select(F.col("source").alias("_listed")).distinct())
    items = count_tokens(df.join(listed, F.col(source) == F.col("_listed"), "left_semi"), [id_col, source], text, tokenizers, vocabulary)
    items = cut(items.where(F.col("n_tokens") > 0).select(F.col(id_col), F.col(source).alias("source"), "n_tokens", F.xxhash64(F.lit(seed), F.col(id_col)).alias("_h")))
    have = {r["source"]: (r["t"], r["n"]) for r in items.groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n")).collect()}
    if fill and total is None:
        total = sum(t for t, _ in have.values())
    take = quotas({s: t for s, (t, _) in have.items()}, wanted, total)
    buckets = max(1, ceil(max([n for _, n in have.values()] or [1]) / BUCKET_ROWS) * 2)
    rows = [(s, take[s] // have[s][0], take[s] % have[s][0]) for s in names if s in have and take[s] > 0]
    if not rows:
        return items.select(F.lit(0).alias("shard"), F.lit(0).alias("pos"), id_col, F.lit(1).alias("copy"), "source", "n_tokens").limit(0)
    plan = F.broadcast(spark.createDataFrame(rows, "source string, _full long, _rest long"))
    ordered = cut(_running(items.join(plan, "source"), ["source"], ["_h", id_col], buckets, {"_before": "n_tokens"}, "_h"))
    fits = F.col("_before") + F.col("n_tokens") <= F.col("_rest")
    # What is left of each rest goes to later documents, the longest that still fit first.
    reached = {r["source"]: (r["s"], r["b"]) for r in ordered.groupBy("source").agg(F.coalesce(F.sum(F.when(fits, F.col("n_tokens"))), F.lit(0)).alias("s"), F.first("_rest").alias("b")).collect()}
    gap = spark.createDataFrame([(s, b - t) for s, (t, b) in reached.items()], "source string, _gap long")
    later = ordered.where(~fits).join(F.broadcast(gap), "source").where(F.col("n_tokens") <= F.col("_gap"))
    # How many later documents of each length there are: at most as many rows as the gaps have tokens, and a gap is less than a document.
    open_, picks = {s: b - t for s, (t, b) in reached.items()}, []
    for r in sorted(later.groupBy("source", "n_tokens").count().collect(), key=lambda r: -r["n_tokens"]):
        times = min(r["count"], open_[r["source"]] // r["n_tokens"])
        if times:
            open_[r["source"]] -= times * r["n_tokens"]
            picks.append((r["source"], r["n_tokens"], times))
    wanted_lengths = F.broadcast(spark.createDataFrame(picks, "source string, n_tokens long, _times long"))
    best = W.partitionBy("source", "n_tokens").orderBy("_h", id_col, "_before")
    most = max([times for _, _, times in picks] or [0])
    added = later.join(wanted_lengths, ["source", "n_tokens"]).withColumn("_k", F.row_number().over(best)).where(F.col("_k") <= most).where(F.col("_k") <= F.col("_times"))
    # A source's running sum names a document, whose length is above 0; repeated ids stay apart.
    chosen = ordered.join(added.select("source", "_before", F.lit(True).alias("_extra")), ["source", "_before"], "left")
    times = F.col("_full") + F.when(fits | F.coalesce("_extra", F.lit(False)), 1).otherwise(0)
    copies = chosen.where(times > 0).select(id_col, "source", "n_tokens", F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("copy"))
    copies = copies.withColumn("_h", F.xxhash64(F.lit(seed + 1), F.col(id_col), "copy"))
    lined = cut(_running(copies, ["source"], ["_h", id_col, "copy"], buckets * max(1, max(r for _, _, r in wanted)), {"_at": "n_tokens"}, "_h"))
    lined = lined.withColumn("_block", F.floor(F.col("_at") / F.lit(block_tokens)))
    counts = {r["source"]: r["n"] for r in lined.groupBy("source").agg((F.max("_block") + 1).alias("n")).collect()}
    blocks = np.array([counts.get(s, 0) for s in names], dtype=np.int64)
    shards = max(1, ceil(int(blocks.sum()) * block_tokens / shard_tokens))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch["id"]:
                offset, n = shard_quotas(int(shard), shards, blocks, seed)
                for i, s in enumerate(names):
                    if n[i]:
                        places = np.arange(offset[i], offset[i] + n[i])
                        yield pd.DataFrame({"source": s, "_block": permuted(places, int(blocks[i]), seed + i), "shard": int(shard)})

    dealt = spark.range(shards).mapInPandas(deal, "source string, _block long, shard int")
    placed = lined.join(dealt, ["source", "_block"])
    order = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), F.col(id_col), "copy"), id_col, "copy")
    return placed.select("shard", F.row_number().over(order).alias("pos"), id_col, F.col("copy").cast("int").alias("copy"), "source", "n_tokens")


def share_report(mix: DataFrame, targets: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(source, target_share, reached_share, max_repeats, n_tokens, n_rows, n_docs, most_copies) of every listed source."""
    per = mix.groupBy("source").agg(
        F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("n_rows"), F.sum(F.when(F.col("copy") == 1, 1).otherwise(0)).alias("n_docs"), F.max("copy").alias("most_copies")
    )
    whole = per.agg(F.sum("n_tokens").alias("_all"))
    rows = targets.join(per, "source", "left").join(F.broadcast(whole), F.lit(True), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return rows.select("source", "target_share", (F.coalesce("n_tokens", F.lit(0)) / F.greatest(F.coalesce("_all", F.lit(1)), F.lit(1))).alias("reached_share"), "max_repeats", zero("n_tokens"), zero("n_rows"), zero("n_docs"), zero("most_copies"))
