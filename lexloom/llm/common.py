"""What several of the text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.sources.storage import cut

__all__ = ["TOKENIZERS", "cut", "digest", "read"]

#: Where the vocabulary files of the public tokenizers lie; a parameter of every operator that needs one.
TOKENIZERS = "/opt/tokenizers"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def digest(text: Column) -> Column:
    """256-bit digest of a string as 32 bytes."""
    return F.unhex(F.sha2(F.encode(text, "utf-8"), 256))
