"""Items of varying length combined into containers of fixed capacity.

The lengths are counted into a histogram of a bounded number of bins.  Shallow
combinations of bins that fill a container are enumerated; non-negative least
squares against the histogram gives how often to use each, the counts are
rounded down to what is there, and what remains is packed greedily by bins.
All of that works on the histogram, whose size depends on the capacity alone.
The items are then numbered within their bins, in blocks, so that no bin is one
task, and find their slot of the plan by a binary search.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.common import TOKENIZERS, cut
from lexloom.llm.token_budget import count_tokens

#: A container is divided into so many units at most, which bounds the bins of the histogram; lengths are rounded up
#: to units, so capacities above this lose room, and no container takes more items than units.
UNITS = 1024
#: So many items at most are numbered by one task.
BLOCK_ROWS = 100_000


def combinations(units: int, lengths: np.ndarray) -> np.ndarray:
    """(n, 3): non-increasing triples of bins, 0 for none, that fill the window exactly; only of bins that occur."""
    there = np.zeros(units + 1, dtype=bool)
    there[lengths] = True
    there[0] = True
    a, b = np.meshgrid(np.arange(units + 1), np.arange(units + 1), indexing="ij")
    c = units - a - b
    ok = (a >= b) & (b >= c) & (c >= 0) & (a > 0)
    a, b, c = a[ok], b[ok], c[ok]
    ok = there[a] & there[b] & there[c]
    return np.stack([a[ok], b[ok], c[ok]], axis=1)


def nnls(shapes: np.ndarray, target: np.ndarray, weights: np.ndarray, steps: int = 300) -> np.ndarray:
    """Non-negative least squares by multiplicative updates: how often to use each shape.

    Minimises the weighted distance of the items used per bin from the histogram
    `target`.  The matrix has three ones per column at most, so it is never
    built: its products are gathers and counts.
    """
    size = len(target)
    real = shapes > 0
    w2 = weights**2

    def used(x: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        for column, there in zip(shapes.T, real.T):
            out += np.bincount(column[there], weights=x[there], minlength=size)
        return out

    def gathered(r: np.ndarray) -> np.ndarray:
        return np.where(real, r[shapes], 0.0).sum(axis=1)

    x = np.full(len(shapes), target.sum() / max(1, real.sum()))
    up = gathered(w2 * target)
    for _ in range(steps):
        x *= up / np.maximum(gathered(w2 * used(x)), 1e-12)
    return x


def plan(histogram: np.ndarray, units: int) -> list[tuple[tuple[int, ...], int]]:
    """[(bins, times)]: containers, by the bins of their items, that hold every item of a histogram over 0..units."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[tuple[int, ...], int]] = []
    there = np.flatnonzero(left)
    shapes = combinations(units, there)
    if len(shapes):
        # What is left over of short items fills gaps later, so short bins weigh less.
        weights = np.sqrt((np.arange(units + 1) + 1.0) / (units + 1.0))
        x = nnls(shapes, left.astype(float), weights)
        for k in np.argsort(-x, kind="stable"):
            bins, need = np.unique(shapes[k][shapes[k] > 0], return_counts=True)
            times = int(min(np.floor(x[k] + 1e-6), (left[bins] // need).min()))
            if times > 0:
                left[bins] -= times * need
                out.append((tuple(int(v) for v in shapes[k] if v), times))
    while left.any():
        room, used = units, []
        spare = left.copy()
        while room:
            fits = np.flatnonzero(spare[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = min(int(spare[length]), room // length)
            used += [length] * n
            spare[length] -= n
            room -= n * length
        bins, need = np.unique(used, return_counts=True)
        times = int((left[bins] // need).min())
        left[bins] -= times * need
        out.append((tuple(used), times))
    return out


def slots(containers: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int]]:
    """[(bin, first, after, container)]: items first <= number < after of a bin go to containers from `container` on."""
    taken: dict[int, int] = {}
    out, base = [], 1
    for bins, times in containers:
        for b in bins:
            first = taken.get(b, 0)
            out.append((b, first, first + times, base))
            taken[b] = first + times
        base += times
    return out


def pack_items(items: DataFrame, spec: DataFrame, id_col: str = "doc_id", units: int = UNITS) -> DataFrame:
    """(spec_name, container, <id>, piece_no, start, n_tokens): every item in a container of every kind.

    items is (<id>, n_tokens).  An item above the capacity is divided into pieces
    of the capacity and a rest; no other is.  Items without tokens take no room:
    they come once, with a null container.  Items with a null length are left
    out; repeated rows are items of their own.  Kinds with a capacity below 1 are
    left out.
    """
    spark: SparkSession = items.sparkSession
    kinds = [(r["spec_name"], int(r["capacity"])) for r in spec.where(F.col("capacity") >= 1).orderBy("spec_name").collect()]
    columns = ["spec_name", "container", id_col, "piece_no", "start", "n_tokens"]
    if not kinds:
        return items.select(F.lit(None).cast("string").alias("spec_name"), F.lit(None).cast("long").alias("container"), id_col, F.lit(1).alias("piece_no"), F.lit(0).cast("long").alias("start"), F.col("n_tokens").cast("long").alias("n_tokens")).limit(0)
    unit = {name: max(1, ceil(cap / units)) for name, cap in kinds}
    of = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(cap).cast("long").alias("cap"), F.lit(unit[name]).cast("long").alias("unit"), F.lit(cap // unit[name]).cast("long").alias("units")) for name, cap in kinds])
    n = F.col("n_tokens")
    each = items.where(n.isNotNull()).select(F.col(id_col), n.cast("long").alias("n_tokens"), F.explode(of).alias("k"))
    whole = F.greatest(F.ceil(n / F.col("k.cap")), F.lit(1))
    each = each.select(id_col, "k", n, F.explode(F.sequence(F.lit(1).cast("long"), whole)).alias("piece_no"))
    start = (F.col("piece_no") - 1) * F.col("k.cap")
    each = each.select(
        F.col("k.name").alias("spec_name"), F.col(id_col), F.col("piece_no").cast("int").alias("piece_no"), start.alias("start"),
        F.least(n - start, F.col("k.cap")).alias("n_tokens"), "k",
    ).select("*", F.least(F.ceil(F.col("n_tokens") / F.col("k.unit")), F.col("k.units")).cast("int").alias("_bin")).drop("k")
    # A piece of the full capacity takes all units even where the capacity is no multiple of the unit.
    counts = each.groupBy("spec_name", "_bin").count().collect()
    total, starts, edges, bases, at = sum(r["count"] for r in counts), [], [], [], 0
    for k, (name, cap) in enumerate(kinds):
        top = cap // unit[name]
        histogram = np.zeros(top + 1, dtype=np.int64)
        for r in counts:
            if r["spec_name"] == name:
                histogram[r["_bin"]] = r["count"]
        # All items of all kinds in one line, bin after bin; those without tokens have no slot.
        starts.append(at + np.cumsum(histogram) - histogram)
        rows = sorted((starts[k][b] + first, base) for b, first, _, base in slots(plan(histogram, top)))
        edges += [at, *(e for e, _ in rows)]
        bases += [0, *(b for _, b in rows)]
        at += int(histogram.sum())
    blocks = max(1, min(1 << 16, ceil(total / BLOCK_ROWS)) * 4)
    key = F.xxhash64(F.col(id_col), "piece_no")
    each = each.withColumn("_key", key).withColumn("_block", F.pmod(F.col("_key"), F.lit(blocks)))
    sizes = each.groupBy("spec_name", "_bin", "_block").count()
    before = W.partitionBy("spec_name", "_bin").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("spec_name", "_bin", "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = W.partitionBy("spec_name", "_bin", "_block").orderBy("_key", id_col, "piece_no")
    numbered = each.withColumn("_n", F.row_number().over(within) - 1).join(offsets, ["spec_name", "_bin", "_block"]).withColumn("_n", F.col("_n") + F.col("_offset"))
    kind = F.array_position(F.array(*[F.lit(name) for name, _ in kinds]), F.col("spec_name")) - 1
    placed = numbered.withColumn("container", _container_of(starts, np.array(edges), np.array(bases))(kind, "_bin", "_n"))
    return placed.select(*columns)


def _container_of(starts: list[np.ndarray], edges: np.ndarray, bases: np.ndarray):
    """Pandas UDF (kind, bin, number within the bin) -> container, null for items without tokens."""

    @F.pandas_udf(T.LongType())
    def of(kind: pd.Series, bin_: pd.Series, number: pd.Series) -> pd.Series:
        first = np.zeros(len(kind), dtype=np.int64)
        for k, start in enumerate(starts):
            here = (kind == k).to_numpy()
            first[here] = start[bin_.to_numpy()[here]]
        place = first + number.to_numpy()
        slot = np.searchsorted(edges, place, side="right") - 1
        return pd.Series(bases[slot] + place - edges[slot], dtype="Int64", index=kind.index).mask(bin_ == 0)

    return of


def pack_texts(df: DataFrame, spec: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizers: str = TOKENIZERS, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """pack_items over the texts of df, sized in tokens of a public tokenizer; null texts are left out."""
    items = cut(count_tokens(df, [id_col], text, tokenizers, vocabulary).select(id_col, "n_tokens"))
    return pack_items(items, spec, id_col)


def kept_report(items: DataFrame, packed: DataFrame, spec: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(spec_name, n_items, n_lost, n_over, n_divided_wrongly): what has to hold for every packing of items (<id>, n_tokens) with unique ids.

    n_items are the items with a length, n_lost those whose pieces don't add up
    to it, n_over the containers above their capacity, n_divided_wrongly the
    items of more pieces than their length in capacities asks for.
    """
    kinds = F.broadcast(spec.where(F.col("capacity") >= 1).select("spec_name", F.col("capacity").cast("long").alias("_cap")))
    pieces = packed.groupBy("spec_name", id_col).agg(F.sum("n_tokens").alias("_sum"), F.count(F.lit(1)).alias("_pieces"))
    boxes = packed.where(F.col("container").isNotNull()).groupBy("spec_name", "container").agg(F.sum("n_tokens").alias("_n")).join(kinds, "spec_name")
    over = boxes.groupBy("spec_name").agg(F.count_if(F.col("_n") > F.col("_cap")).alias("n_over"))
    names = [r["spec_name"] for r in spec.where(F.col("capacity") >= 1).select("spec_name").collect()]
    wanted = items.where(F.col("n_tokens").isNotNull()).select(id_col, "n_tokens", F.explode(F.array(*[F.lit(n) for n in names])).alias("spec_name"))
    joined = wanted.join(pieces, ["spec_name", id_col], "left").join(kinds, "spec_name")
    most = F.greatest(F.ceil(F.col("n_tokens") / F.col("_cap")), F.lit(1))
    per = joined.groupBy("spec_name").agg(
        F.count(F.lit(1)).alias("n_items"), F.count_if(~F.col("_sum").eqNullSafe(F.col("n_tokens"))).alias("n_lost"), F.count_if(F.col("_pieces") > most).alias("n_divided_wrongly")
    )
    return per.join(over, "spec_name", "left").select("spec_name", "n_items", "n_lost", F.coalesce("n_over", F.lit(0)).alias("n_over"), "n_divided_wrongly")


def fill_report(packed: DataFrame, spec: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(spec_name, capacity, n_containers, n_items, n_divided, n_tokens, fill, n_over): how well each kind is filled."""
    pieces = packed.groupBy("spec_name").agg(
        F.count(F.lit(1)).alias("n_items"), F.sum(F.when(F.col("piece_no") == 2, 1).otherwise(0)).alias("n_divided"), F.sum("n_tokens").alias("n_tokens")
    )
    boxes = packed.where(F.col("container").isNotNull()).groupBy("spec_name", "container").agg(F.sum("n_tokens").alias("_n"))
    boxes = boxes.join(F.broadcast(spec.select("spec_name", "capacity")), "spec_name")
    filled = boxes.groupBy("spec_name", "capacity").agg(F.count(F.lit(1)).alias("n_containers"), F.sum(F.when(F.col("_n") > F.col("capacity"), 1).otherwise(0)).alias("n_over"))
    fill = F.col("n_tokens") / (F.col("n_containers") * F.col("capacity"))
    return filled.join(pieces, "spec_name").select("spec_name", "capacity", "n_containers", "n_items", "n_divided", "n_tokens", fill.alias("fill"), "n_over")
