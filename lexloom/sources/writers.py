"""Writers of record stores."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.sources.storage import Files

# Fixed value: rows of a file.
ROWS_PER_FILE = 10_000


def append_papers(df: DataFrame, data_dir: str, source: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Appends to data_dir/<source>/year=…; years of 0 and null have folders of their own.

    The year stands in the folder's name alone.  Appending nothing makes no file.
    """
    _write(df, f"{data_dir.rstrip('/')}/{source}", "append", rows_per_file)


def replace_papers(df: DataFrame, data_dir: str, source: str, rows_per_file: int = ROWS_PER_FILE, drop_null_year: bool = False) -> list[str]:
    """Replaces the years that df has rows of, and no others; gives their folders' names.

    df may have been read from the folder it replaces: everything is written
    beside it before the first folder is moved, each old year is moved aside
    before the new one takes its place, and the old ones are deleted when all
    are in place.  After a failure nothing has been deleted: a year that couldn't
    be put in place is moved back, and what was written stays in
    data_dir/_staging_….  A df read with damaged files skipped would lose what
    they hold; read with skip_corrupt=False.
    """
    root = data_dir.rstrip("/")
    target, tag = f"{root}/{source}", uuid.uuid4().hex
    staging, aside = f"{root}/_staging_{tag}", f"{root}/_replaced_{tag}"
    if drop_null_year:
        df = df.where(F.col("year").isNotNull())
    _write(df, staging, "errorifexists", rows_per_file)
    files = Files(df.sparkSession, root)
    years = [name for name in files.folders(staging) if name.startswith("year=")]
    for name in years:
        had = files.is_folder(f"{target}/{name}")
        if had:
            files.move(f"{target}/{name}", f"{aside}/{name}")
        try:
            files.move(f"{staging}/{name}", f"{target}/{name}")
        except Exception:
            if had:
                files.move(f"{aside}/{name}", f"{target}/{name}")
            raise
    files.delete(staging)
    files.delete(aside)
    return years


def _write(df: DataFrame, target: str, mode: str, rows_per_file: int) -> None:
    # Rebalancing by year splits large years and merges small ones by their measured size.
    df.hint("rebalance", F.col("year")).write.mode(mode).option("maxRecordsPerFile", rows_per_file).partitionBy("year").parquet(target)
