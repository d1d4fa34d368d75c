"""Readers of record stores, corpora and files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexloom.schema import PAPER, conform
from lexloom.sources.storage import Files

# The sources that are read when none is named, and the file that marks a saved dataset.
DEFAULT_SOURCES, SAVED_MARK = ("arxiv", "semantic_scholar"), "dataset_info.json"
RESULTS = "arxiv_id string, text string, error string"


def read_papers(spark: SparkSession, data_dir: str, source: str | Sequence[str] | None = None, skip_corrupt: bool = True) -> DataFrame:
    """All papers below data_dir/<source>, of the default sources if none is named, in the paper schema.

    Missing folders are left out, no file at all gives an empty table, and
    unreadable files are skipped unless skip_corrupt is false, as it has to be for
    whatever is written back.  The year comes from the file where it has one (a
    `year=` folder may disagree), else from the folder.
    """
    wanted = DEFAULT_SOURCES if source is None else (source,) if isinstance(source, str) else tuple(source)
    files = Files(spark, data_dir)
    paths = [p for s in wanted if files.is_folder(p := f"{data_dir.rstrip('/')}/{s}")]
    if not paths:
        return spark.createDataFrame([], PAPER)
    rows = _store(spark, paths, skip_corrupt)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/year=(\d+)/", 1)
    return rows.withColumn("year", F.coalesce("year", F.when(folder != "", folder).cast("int")))


def _store(spark: SparkSession, paths: Sequence[str], skip_corrupt: bool) -> DataFrame:
    reader = spark.read.schema(PAPER).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", str(skip_corrupt).lower())
    return reader.parquet(*paths)


def folders_of(spark: SparkSession, data_dir: str, source: str, keys: DataFrame | None = None, key: str = "arxiv_id") -> list[str]:
    """The year folders of a store, with keys those that hold any of them; only the key is read of every file."""
    root = f"{data_dir.rstrip('/')}/{source}"
    if not Files(spark, root).is_folder(root):
        return []
    where = F.regexp_extract(F.col("_metadata.file_path"), r"/(year=[^/]+)/[^/]*$", 1)
    rows = _store(spark, [root], False).select(key, where.alias("folder"))
    if keys is not None:
        rows = rows.join(keys.select(key).where(F.col(key).isNotNull()).distinct(), key, "left_semi")
    found = [r["folder"] for r in rows.select("folder").distinct().collect()]
    if "" in found:
        raise ValueError(f"files outside of year folders in {root} can't be replaced")
    return sorted(found)


def read_folders(spark: SparkSession, data_dir: str, source: str, folders: Sequence[str]) -> DataFrame:
    """The papers of some year folders, to be written back: damaged files are an error, and the year is the folder's."""
    if not folders:
        return spark.createDataFrame([], PAPER)
    rows = _store(spark, [f"{data_dir.rstrip('/')}/{source}/{f}" for f in folders], False)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/year=(\d+)/", 1)
    return rows.withColumn("year", F.when(folder != "", folder).cast("int"))


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Extraction results with `delivered`, which orders them: time of the file, its path, and the row's place in it."""
    at = F.struct(F.col("_metadata.file_modification_time"), F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return spark.read.schema(RESULTS).parquet(path).select("*", at.alias("delivered"))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """A corpus from a saved dataset, a file or a folder, on any file system.

    In this order: a folder with a saved dataset, a .parquet file, a .jsonl or
    .json file (one record per line), a folder with parquet files below it (which
    hide all .jsonl there), a folder with .jsonl files below it.  Anything else is
    a ValueError.
    """
    files = Files(spark, path)
    if files.is_file(f"{path.rstrip('/')}/{SAVED_MARK}"):
        return read_saved_dataset(spark, path)
    if files.is_file(path) and path.endswith(".parquet"):
        return spark.read.parquet(path)
    if files.is_file(path) and path.endswith((".jsonl", ".json")):
        return spark.read.json(path)
    if files.is_folder(path):
        for suffix, read in ((".parquet", lambda r: r.option("mergeSchema", "true").parquet(path)), (".jsonl", lambda r: r.json(path))):
            if next(files.below(path, suffix), None) is not None:
                return read(spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}"))
    raise ValueError(f"no corpus at {path}")


class _Part(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _opened(path: str) -> pa.NativeFile:
    """A file as a stream, on the file system its scheme names."""
    if "://" not in path and not path.startswith("file:"):
        return pa.memory_map(path)
    system, at = pafs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_stream(at)


class _SavedReader(DataSourceReader):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [_Part(p) for p in self.paths]

    def read(self, partition: _Part) -> Iterator[pa.RecordBatch]:
        with _opened(partition.path) as source:
            yield from pa.ipc.open_stream(source)


class SavedDataset(DataSource):
    """Files of Arrow streams, one task per file, read batch by batch by the executors from wherever they lie."""

    @classmethod
    def name(cls) -> str:
        return "saved_dataset"

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        with _opened(self._paths()[0]) as source:
            return from_arrow_schema(pa.ipc.open_stream(source).schema)

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _SavedReader(self._paths())

    def _paths(self) -> list[str]:
        return self.options["paths"].split("\n")


def read_saved_dataset(spark: SparkSession, path: str) -> DataFrame:
    """A dataset saved as Arrow streams."""
    spark.dataSource.register(SavedDataset)
    paths = sorted(Files(spark, path).below(path, ".arrow"))
    if not paths:
        raise ValueError(f"no saved dataset at {path}")
    return spark.read.format("saved_dataset").option("paths", "\n".join(paths)).load()


def read_whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): each file as one string."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def list_pdfs(spark: SparkSession, folder: str, content: bool = False, ordered: bool = False) -> DataFrame:
    """(path, length[, content]) of the PDFs in a folder, not below it; the content is read only when asked for, and the rows sorted by path."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    out = rows.select("path", "length", *(["content"] if content else []))
    return out.orderBy("path") if ordered else out


def read_union(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files of differing columns, by name, missing ones null, in the paper schema."""
    return conform(spark.read.option("mergeSchema", "true").parquet(*paths), PAPER)
