"""Science and general text brought into a target ratio of documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.order import first_rows, sample_exact, shuffle_key
from lexloom.schema import normalize_to_corpus

# The labels that supplements are given.
SCIENCE_LABEL, GENERAL_LABEL = "pes2o_or_crawled", "general"
#: What identifies a delivery of a document in a corpus.
DELIVERY = ("id", "version", "added", "created", "url", "text")


def split_by_source(df: DataFrame, science: Sequence[str], general: Sequence[str], field: str = "source") -> tuple[DataFrame, DataFrame]:
    """Rows of either list of sources; a value in both lists puts a row on both sides, one in neither (or null) on none."""
    if field not in df.columns:
        raise KeyError(f"no column {field!r}")
    return df.where(F.col(field).isin(list(science))), df.where(F.col(field).isin(list(general)))


@dataclass(frozen=True)
class MixPlan:
    """What is done to bring two sides into the ratio: rows to keep of each (None: all) and rows to add to each."""

    action: str
    keep_science: int | None = None
    keep_general: int | None = None
    add_science: int = 0
    add_general: int = 0


def plan_mix(n_science: int, n_general: int, least: float, most: float, auto_balance: bool = True, science_fallback: bool = False, general_fallback: bool = False) -> MixPlan:
    """The plan for given counts.  The target is the middle of the closed range least..most; fractions are cut off."""
    if n_science + n_general == 0:
        raise ValueError("there is nothing to mix")
    target = (least + most) / 2.0
    if least <= n_science / (n_science + n_general) <= most:
        return MixPlan("in range")
    if not auto_balance:
        return MixPlan("as it is")
    general_wanted = int(n_science * (1.0 - target) / target)
    science_wanted = int(n_general * target / (1.0 - target))
    if n_science / (n_science + n_general) > most:
        if general_fallback:
            return MixPlan("add general", add_general=max(0, general_wanted - n_general))
        return MixPlan("fewer science", keep_science=max(1, science_wanted))
    if science_fallback:
        return MixPlan("add science", add_science=max(0, science_wanted - n_science))
    return MixPlan("fewer general", keep_general=max(1, general_wanted))


def supplement(external: DataFrame, take: int, label: str, order: Sequence[str | Column], id_col: str | None = "id", text: str = "text", name: str = "external") -> DataFrame:
    """The first `take` rows of an external corpus, of which those without text are then dropped, in the corpus schema.

    So it may give fewer rows than asked for.  A missing id becomes name:position.
    """
    first = first_rows(external, take, order, "_n" if id_col is None else None)
    key = F.concat(F.lit(f"{name}:"), F.col("_n").cast("string")) if id_col is None else F.col(id_col).cast("string")
    rows = first.where(F.col(text).isNotNull() & (F.col(text) != ""))
    optional = {c: F.col(c).cast("string") if c in external.columns else F.lit(None).cast("string") for c in ("url", "created", "version")}
    return rows.select(
        key.alias("id"), F.lit(label).alias("source"), optional["url"].alias("url"), F.col(text).alias("text"),
        optional["created"].alias("created"), F.lit(None).cast("string").alias("added"), optional["version"].alias("version"),
    )


def counts(science: DataFrame, general: DataFrame) -> tuple[int, int]:
    """The sizes of both sides, in one job."""
    both = science.select(F.lit(1).alias("s")).unionAll(general.select(F.lit(0).alias("s"))).agg(F.sum("s").alias("s"), F.count("s").alias("n")).first()
    return int(both["s"] or 0), int(both["n"]) - int(both["s"] or 0)


def adjust_mixing(
    science: DataFrame, general: DataFrame, least: float, most: float, auto_balance: bool = True, science_fallback: DataFrame | None = None, general_fallback: DataFrame | None = None,
    seed: int = 42, science_order: Sequence[str | Column] = ("id",), general_order: Sequence[str | Column] = ("id",), fallback_ids: Sequence[str | None] = ("id", "id"),
    fallback_texts: Sequence[str] = ("text", "text"),
) -> DataFrame:
    """Both sides in one corpus-shaped table with a column `shuffle_key` that gives its shuffled order.

    Both sides are counted once.  Raises ValueError if they are empty.
    """
    n_science, n_general = counts(science, general)
    plan = plan_mix(n_science, n_general, least, most, auto_balance, science_fallback is not None, general_fallback is not None)
    s, g = normalize_to_corpus(science), normalize_to_corpus(general)
    if plan.keep_science is not None:
        s = sample_exact(s, plan.keep_science, seed, DELIVERY, n_science)
    if plan.keep_general is not None:
        g = sample_exact(g, plan.keep_general, seed, DELIVERY, n_general)
    if plan.add_science:
        s = s.unionByName(supplement(science_fallback, plan.add_science, SCIENCE_LABEL, science_order, fallback_ids[0], fallback_texts[0]))
    if plan.add_general:
        g = g.unionByName(supplement(general_fallback, plan.add_general, GENERAL_LABEL, general_order, fallback_ids[1], fallback_texts[1]))
    return s.unionByName(g).withColumn("shuffle_key", shuffle_key(seed, *DELIVERY))
