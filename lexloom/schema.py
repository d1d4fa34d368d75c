"""The schemas of the record store and of corpora, and a record with its defaults."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 31 columns of a paper in order, with the default of each.
_STRING, _LIST = T.StringType(), T.ArrayType(T.StringType())
PAPER_COLUMNS: tuple[tuple[str, T.DataType, Any], ...] = (
    ("record_id", _STRING, ""), ("paper_id", _STRING, ""), ("source", _STRING, ""), ("source_paper_id", _STRING, ""),
    ("arxiv_id", _STRING, None), ("doi", _STRING, None), ("title", _STRING, ""), ("abstract", _STRING, ""),
    ("authors", _LIST, []), ("year", T.IntegerType(), 0), ("categories", _LIST, []), ("license", _STRING, None),
    ("pdf_url", _STRING, None), ("pdf_path", _STRING, None), ("latex_source_path", _STRING, None),
    ("has_full_text", T.BooleanType(), False), ("full_text", _STRING, None), ("full_text_format", _STRING, None),
    ("full_text_source_type", _STRING, None), ("full_text_status", _STRING, "abstract_only"), ("clean_text", _STRING, None),
    ("citation_count", T.IntegerType(), None), ("token_count_approx", T.IntegerType(), None), ("language", _STRING, "en"),
    ("crawl_date", _STRING, ""), ("crawl_batch_id", _STRING, ""), ("fetch_success", T.BooleanType(), True),
    ("error_message", _STRING, None), ("content_hash", _STRING, ""), ("is_duplicate", T.BooleanType(), False),
    ("raw_source_payload", _STRING, ""),
)
# The columns of a corpus in order.
CORPUS_COLUMNS = ("id", "source", "url", "text", "created", "added", "version")

PAPER = T.StructType([T.StructField(name, kind) for name, kind, _ in PAPER_COLUMNS])
CORPUS = T.StructType([T.StructField(name, _STRING) for name in CORPUS_COLUMNS])


def paper(**values: Any) -> dict[str, Any]:
    """A paper record with defaults for what isn't given; an unknown name is an error."""
    unknown = values.keys() - {name for name, _, _ in PAPER_COLUMNS}
    if unknown:
        raise TypeError(f"no such columns: {sorted(unknown)}")
    return {name: values.get(name, list(default) if isinstance(default, list) else default) for name, _, default in PAPER_COLUMNS}


def records_to_table(spark: SparkSession, records: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Records as a typed table in schema order; none gives an empty typed table."""
    return spark.createDataFrame([tuple(paper(**r).values()) for r in records], PAPER)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with exactly the columns of the schema: missing ones null, others dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def normalize_to_corpus(df: DataFrame) -> DataFrame:
    """df in the corpus schema."""
    return conform(df, CORPUS)
