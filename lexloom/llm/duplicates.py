"""Records that are the same but for white space, letter case, punctuation and the order of their fields."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut

#: Seeds of the two independent 64-bit hashes of a value.
SEEDS = (17, 1_000_003)


def letters_and_digits(text: Column) -> Column:
    """The letters, marks and digits of a text in order, without regard to case; null gives ''.

    Upper-casing first makes sharp s, ligatures and the micro sign equal to what
    upper-casing turns them into; the final sigma is put right afterwards.
    """
    bare = F.regexp_replace(F.upper(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", "")
    return F.translate(F.lower(bare), "ς", "σ")


def with_fingerprint(df: DataFrame, fields: Sequence[str], any_order: bool = True) -> DataFrame:
    """df with `_v` (array of normalised field values) and `_h1`, `_h2`, a commutative hash of the fields.

    Each (field name, value) pair is hashed and the hashes are added as decimals
    that hold any sum, a multiset hash that doesn't depend on the order of the
    fields.  With any_order the name is left out of the pair, so that it doesn't
    matter either which field holds which value.
    """
    values = F.array(*[letters_and_digits(F.col(f)) for f in fields])
    out = df.withColumn("_v", values)

    def total(seed: int) -> Column:
        parts = [
            F.xxhash64(F.lit(seed), *([] if any_order else [F.lit(f)]), F.col("_v")[i]).cast("decimal(38,0)")
            for i, f in enumerate(fields)
        ]
        return reduce(lambda a, b: a + b, parts)

    return out.withColumns({f"_h{i + 1}": total(seed) for i, seed in enumerate(SEEDS)})


def _same_values(a: Column, b: Column, n: int, any_order: bool) -> Column:
    """Whether two arrays of n values are equal, as multisets with any_order; by comparing, not by sorting."""
    if not any_order:
        return a == b
    if n == 2:
        return ((a[0] == b[0]) & (a[1] == b[1])) | ((a[0] == b[1]) & (a[1] == b[0]))
    count = lambda values, x: F.size(F.filter(values, lambda y: y == x))
    return F.forall(a, lambda x: count(a, x) == count(b, x))


def copy_sets(df: DataFrame, id_col: str = "record_id", fields: Sequence[str] = ("title", "abstract"), any_order: bool = True) -> DataFrame:
    """(<id>, first): every record that has a copy, with the smallest id of its set (the first maps to itself).

    1. Only (fingerprint, id) is grouped, with partial aggregation, so that a set
       of any size reaches the shuffle as one row per task.
    2. Records whose fingerprint recurs meet the first record of their
       fingerprint, and their fields are compared with its fields.  A set of a
       third of all rows is a skewed join key that adaptive execution splits.
    3. Records that differ from the first one in spite of an equal fingerprint,
       which takes a collision of 128 bits, are grouped again by their values
       themselves, in sorted order; no case is dropped.

    Null fields equal empty ones; records whose fields hold no letter or digit
    are copies of each other.  Rows that repeat an id count once; if they hold
    different values and are the first of a set, the least values are compared.
    Rows with a null id are left out; other columns are ignored.
    """
    n = len(fields)
    rows = with_fingerprint(
        df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), *[F.col(f).alias(f"_f{i}") for i, f in enumerate(fields)]),
        [f"_f{i}" for i in range(n)], any_order,
    ).select("_id", "_v", "_h1", "_h2")
    sets = (
        rows.groupBy("_h1", "_h2")
        .agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
        .where(F.col("_first") != F.col("_last"))
        .drop("_last")
    )
    members = cut(rows.join(sets, ["_h1", "_h2"]).select("_id", "_v", "_first"))
    firsts = members.where(F.col("_id") == F.col("_first")).groupBy("_first").agg(F.min("_v").alias("_of_first"))
    compared = members.join(firsts, "_first").withColumn("_same", _same_values(F.col("_v"), F.col("_of_first"), n, any_order))
    alike = compared.where("_same").select("_id", "_first")
    key = F.array_sort("_v") if any_order else F.col("_v")
    others = compared.where(~F.col("_same")).select("_id", key.alias("_key"))
    groups = others.groupBy("_key").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).where(F.col("_first") != F.col("_last")).drop("_last")
    return alike.unionByName(others.join(groups, "_key").select("_id", "_first")).distinct().select(F.col("_id").alias(id_col), F.col("_first").alias("first"))


def copy_pairs(df: DataFrame, id_col: str = "record_id", fields: Sequence[str] = ("title", "abstract"), any_order: bool = True) -> DataFrame:
    """(<id>_a, <id>_b): the first record of each set of copies beside each other one; cases as in copy_sets."""
    return (
        copy_sets(df, id_col, fields, any_order)
        .where(F.col(id_col) != F.col("first"))
        .select(F.col("first").alias(f"{id_col}_a"), F.col(id_col).alias(f"{id_col}_b"))
    )


def collapse_copies(df: DataFrame, id_col: str = "record_id", fields: Sequence[str] = ("title", "abstract"), any_order: bool = True) -> DataFrame:
    """One record per set of copies, the one with the smallest id, with `n_copies`, how many records it stands for.

    Records without copies stay, with 1.  Cases as in copy_sets, but that rows
    with a null id are kept, each for itself.
    """
    pairs = copy_pairs(df, id_col, fields, any_order)
    extra = pairs.groupBy(f"{id_col}_a").agg(F.count(F.lit(1)).alias("_more")).withColumnRenamed(f"{id_col}_a", id_col)
    kept = df.join(pairs.select(F.col(f"{id_col}_b").alias(id_col)), id_col, "left_anti")
    kept = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).unionByName(kept.where(F.col(id_col).isNull()))
    return kept.join(extra, id_col, "left").withColumn("n_copies", F.coalesce("_more", F.lit(0)) + 1).drop("_more")
