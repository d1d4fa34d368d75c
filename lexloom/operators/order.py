"""Row order made explicit: seeded keys, positions, exact samples and splits.

Spark rows have no order, so whatever depends on one takes its order from a key:
the SHA-256 of seed and id, the same on every engine.  The first hex digits of
the key spread rows evenly over buckets, of which there are more the more rows
there are: rows are numbered within buckets and shifted by the sizes of the
buckets before, so that no single task orders more than about BUCKET_ROWS rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexloom.sources.storage import cut

#: So many rows are put in order by one task, as far as MOST_DIGITS hex digits of the key (a million buckets) go.
BUCKET_ROWS, MOST_DIGITS = 20_000, 5


def shuffle_key(seed: int, *ids: str | Column) -> Column:
    """A seeded, reproducible random key of a row; null ids count as empty."""
    parts = [F.coalesce((F.col(i) if isinstance(i, str) else i).cast("string"), F.lit("")) for i in ids]
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *parts), 256)


def _digits(n: int) -> int:
    """Hex digits of the key that make a bucket."""
    digits = 1
    while digits < MOST_DIGITS and n > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def _alike(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed, which orders rows of equal keys; what it doesn't tell apart is the same row."""
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in df.dtypes if "map<" not in kind and kind != "variant"])


def with_position(df: DataFrame, seed: int, ids: Sequence[str], out: str = "pos", n: int | None = None) -> DataFrame:
    """df with 0-based positions in the order of the seeded key; equal keys are ordered by a hash of all columns.

    n is the number of rows where it is known; else they are counted.
    """
    digits = _digits(df.count() if n is None else n)
    keyed = df.withColumn("_key", shuffle_key(seed, *ids)).withColumn("_bucket", F.substring("_key", 1, digits))
    sizes = keyed.groupBy("_bucket").count()
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # over the buckets alone
    offsets = sizes.select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = W.partitionBy("_bucket").orderBy("_key", _alike(df))
    numbered = keyed.withColumn("_n", F.row_number().over(within))
    placed = numbered.join(F.broadcast(offsets), "_bucket")  # 16 ** MOST_DIGITS rows at most
    return placed.withColumn(out, (F.col("_offset") + F.col("_n") - 1).cast("long")).drop("_key", "_bucket", "_offset", "_n")


def _edge(keyed: DataFrame, n: int, total: int) -> tuple[str | None, int, int]:
    """(bucket, rows of it, digits): the bucket of the seeded key in which the n-th row lies; None if there are fewer rows.

    The sizes of the buckets, a bounded number, are all the driver sees.
    """
    digits, left = _digits(total), max(0, n)
    for bucket, size in sorted((r["b"], r["count"]) for r in keyed.groupBy(F.substring("_key", 1, digits).alias("b")).count().collect()):
        if size > left:
            return bucket, left, digits
        left -= size
    return None, 0, digits


def sample_exact(df: DataFrame, n: int, seed: int, ids: Sequence[str], total: int | None = None) -> DataFrame:
    """Exactly n rows (all, if there are fewer), the first in the order of the seeded key.

    The buckets before the one in which the n-th row lies are taken whole and
    only that one is put in order, so no task sees more than a bucket, whatever n is.
    """
    keyed = df.withColumn("_key", shuffle_key(seed, *ids))
    last, left, digits = _edge(keyed, n, df.count() if total is None else total)
    if last is None:
        return df
    bucket = F.substring("_key", 1, digits)
    part = keyed.where(bucket == last).orderBy("_key", _alike(df)).limit(left)
    return keyed.where(bucket < last).unionByName(part).drop("_key")


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column], name: str | None = None) -> DataFrame:
    """The first n rows by `order`, nulls first; with a name, numbered from 0 in a column of that name.

    The columns of the order alone are sorted and written once.  From the sizes
    of the sorted partitions follows where the n-th row lies; rows up to its
    values are then taken by a filter, so that n rows are never gathered in one
    task.  Of rows that are equal in all of the order, as many as are still
    wanted are taken; only these pass through one task, as a stream.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    named = [k.alias(f"k{i}") for i, k in enumerate(keys)]
    ranked = cut(df.select(F.struct(*named).alias("_k")).orderBy("_k").withColumn("_p", F.spark_partition_id()))
    left, at = max(0, n), None
    sizes = sorted((r["_p"], r["count"]) for r in ranked.groupBy("_p").count().collect())
    for p, size in sizes:
        if left <= size:
            at = p
            break
        left -= size
    if at is None:
        out = df
    elif left == 0:
        out = df.limit(0)
    else:
        within = ranked.where(F.col("_p") == at).select("_k", F.row_number().over(W.orderBy("_k")).alias("_row"))  # one sorted partition
        values = within.where(F.col("_row") == left).first()["_k"]
        kinds = ranked.schema["_k"].dataType
        last, own = F.struct(*[F.lit(v).cast(k.dataType).alias(k.name) for v, k in zip(values, kinds)]), F.struct(*named)
        below = ranked.where(F.col("_k") < last).count()
        out = df.where(own < last).unionByName(df.where(own == last).limit(n - below))
    if name is None:
        return out
    spread = cut(out.orderBy(*keys).withColumn("_p", F.spark_partition_id()))
    offsets = spread.groupBy("_p").count().select("_p", F.coalesce(F.sum("count").over(W.orderBy("_p").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_o"))
    numbered = spread.withColumn("_row", F.row_number().over(W.partitionBy("_p").orderBy(*keys))).join(F.broadcast(offsets), "_p")
    return numbered.withColumn(name, (F.col("_o") + F.col("_row") - 1).cast("long")).drop("_p", "_row", "_o")


def eval_size(n: int, ratio: float, least: int = 100) -> int:
    """How many of n rows are held out: none unless the ratio is positive and n above `least`; rounded up."""
    return ceil(ratio * n) if ratio > 0 and n > least else 0


def train_eval_split(df: DataFrame, ratio: float, seed: int, ids: Sequence[str], least: int = 100, n: int | None = None) -> DataFrame:
    """df with a column `split`, train or eval; the held-out rows are the first in the order of the seeded key.

    The key of the last held-out row is looked up in its bucket; a filter does
    the rest, without a shuffle of df.  Rows that are the same in every column
    can't be told apart and are held out together.  n is the number of rows
    where it is known.
    """
    n = df.count() if n is None else n
    held = eval_size(n, ratio, least)
    if not held:
        return df.withColumn("split", F.lit("train"))
    key, alike = shuffle_key(seed, *ids), _alike(df)
    keyed = df.select(key.alias("_key"), alike.alias("_alike"))
    last, left, digits = _edge(keyed, held - 1, n)
    edge = keyed.where(F.substring("_key", 1, digits) == last).orderBy("_key", "_alike").limit(left + 1).agg(F.max(F.struct("_key", "_alike")).alias("m")).first()["m"]
    first = (key < edge["_key"]) | (key == edge["_key"]) & (alike <= edge["_alike"])
    return df.withColumn("split", F.when(first, "eval").otherwise("train"))


def assign_rank(df: DataFrame, world: int, seed: int, ids: Sequence[str]) -> DataFrame:
    """df with `rank` and `slot`: rows dealt round-robin to ranks; the first rows come again so that all ranks have equally many.

    An empty table gives an empty one.
    """
    n = df.count()
    placed = with_position(df, seed, ids, "_pos", n)
    extra = (-n) % world if n else 0
    again = F.array("_pos")
    if extra:
        again = F.concat(again, F.when(F.col("_pos") < extra, F.sequence(F.col("_pos") + n, F.lit(n + extra - 1).cast("long"), F.lit(n).cast("long"))).otherwise(F.array().cast("array<bigint>")))
    dealt = placed.withColumn("_at", F.explode(again))
    return dealt.withColumn("rank", (F.col("_at") % world).cast("int")).withColumn("slot", F.floor(F.col("_at") / world)).drop("_pos", "_at")


def micro_batches(df: DataFrame, size: int, pos: str = "slot", out: str = "step") -> DataFrame:
    """df with the step in which a row is used: rows of consecutive positions, `size` at a time, the last step with the rest."""
    return df.withColumn(out, F.floor(F.col(pos) / size).cast("long"))


def effective_batch(world: int, micro: int, accumulation: int) -> int:
    """Rows per update of the weights."""
    return world * micro * accumulation
