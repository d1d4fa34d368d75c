"""The registered queries of the text operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm import containers, duplicates, languages, lookalikes, markup, mixtures, scans, token_budget
from lexloom.llm.common import cut, read


#: What the bench runs.
HEADLINE = ("p1_found", "p1_totals", "p2_found", "p2_repaired", "p3_found", "p4_found", "p5_found", "p5_text", "p6_containers", "p7_mix", "p8_found", "p8_forms")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.stale_counts(read(spark, d, "papers"))


def p1_totals(spark: SparkSession, d: str) -> DataFrame:
    return token_budget.token_budget(read(spark, d, "papers"), read(spark, d, "lang_labels"), read(spark, d, "category_domain"))


def p1_words(spark: SparkSession, d: str) -> DataFrame:
    """The totals that SQL can check too: documents, distinct texts and words per source, language and domain."""
    return p1_totals(spark, d).select("source", "lang", "domain", "n_docs", "n_distinct", "n_words")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return scans.noisy_lines(read(spark, d, "papers"))


def p2_repaired(spark: SparkSession, d: str) -> DataFrame:
    return scans.repair(read(spark, d, "papers").where(F.col("full_text").isNotNull()))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.copy_pairs(read(spark, d, "papers"))


def p3_copies(spark: SparkSession, d: str) -> DataFrame:
    return duplicates.collapse_copies(read(spark, d, "papers").select("record_id", "title", "abstract")).select("record_id", "n_copies")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.wrong_or_mixed(read(spark, d, "papers"), read(spark, d, "lang_labels"))


def p4_languages(spark: SparkSession, d: str) -> DataFrame:
    rows = languages.identify(read(spark, d, "papers"), read(spark, d, "lang_labels"))
    return rows.select("record_id", "label", "lang", "confidence", F.size("segments").alias("n_segments"))


def p4_segments(spark: SparkSession, d: str) -> DataFrame:
    return languages.language_segments(read(spark, d, "papers"), read(spark, d, "lang_labels"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return markup.markup_found(read(spark, d, "papers"))


def p5_text(spark: SparkSession, d: str) -> DataFrame:
    return markup.clean_markup(read(spark, d, "papers").where(F.col("full_text").isNotNull())).select("record_id", "text")


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    return containers.pack_texts(read(spark, d, "documents"), read(spark, d, "pack_spec"))


def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    return containers.fill_report(cut(p6_containers(spark, d)), read(spark, d, "pack_spec"))


def p6_kept(spark: SparkSession, d: str) -> DataFrame:
    """That every text is there once, whole, and nothing above its capacity; SQL can count the texts too."""
    documents, spec = read(spark, d, "documents"), read(spark, d, "pack_spec")
    items = cut(token_budget.count_tokens(documents, ["doc_id"], "text").select("doc_id", "n_tokens"))
    return containers.kept_report(items, cut(containers.pack_items(items, spec)), spec)


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixtures.mix_sources(read(spark, d, "documents"), read(spark, d, "mix_targets"))


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixtures.share_report(cut(p7_mix(spark, d)), read(spark, d, "mix_targets"))


def p7_kept(spark: SparkSession, d: str) -> DataFrame:
    """That each source that has texts reaches its share of what the listed ones with texts have to give, within its repeats."""
    report = mixtures.share_report(cut(p7_mix(spark, d)), read(spark, d, "mix_targets"))
    whole = report.where(F.col("n_tokens") > 0).agg(F.sum("target_share")).first()[0] or 1.0
    near = F.abs(F.col("reached_share") - F.when(F.col("n_tokens") > 0, F.col("target_share") / F.lit(whole)).otherwise(0.0)) < 0.01
    return report.select("source", "target_share", "max_repeats", (F.col("n_tokens") > 0).alias("there"), near.alias("reached"), (F.col("most_copies") <= F.col("max_repeats")).alias("within"))


def p7_filled(spark: SparkSession, d: str) -> DataFrame:
    return mixtures.mix_sources(read(spark, d, "documents"), read(spark, d, "mix_targets"), fill=True)


def p7_filled_shares(spark: SparkSession, d: str) -> DataFrame:
    """The shares where too small sources fall short of their targets."""
    return mixtures.share_report(cut(p7_filled(spark, d)), read(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.look_alike_pairs(read(spark, d, "documents"))


def p8_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.look_alike_classes(read(spark, d, "documents"))


def p8_forms(spark: SparkSession, d: str) -> DataFrame:
    return lookalikes.with_consistent_form(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", "form")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (p1_found, p1_totals, p1_words, p2_found, p2_repaired, p3_found, p3_copies, p4_found, p4_languages, p4_segments, p5_found, p5_text, p6_containers, p6_fill, p6_kept, p7_mix, p7_shares, p7_kept, p7_filled, p7_filled_shares, p8_found, p8_classes, p8_forms)
    return {q.__name__: q for q in every}
