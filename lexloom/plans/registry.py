"""The registered queries of the core operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import cleaning, text
from lexloom.operators import mixing, order, packing, parsing, records
from lexloom.plans import pipelines
from lexloom.schema import CORPUS_COLUMNS, normalize_to_corpus
from lexloom.sources import readers, writers
from lexloom.sources.storage import Files, fresh_folder
from lexloom.streaming.ingest import merge_into_store

SCIENCE, GENERAL = ("pes2o_or_crawled",), ("general",)
SEED, LENGTH, BATCH, SHARDS, BLOCK = 42, 512, 100, 4, 512
#: A range of the share of science that the corpus is above of.
LOW_RANGE = (0.5, 0.6)
#: Corpora that stand in for remote ones, by the name mix_config gives, with what puts them in order; of equal rows it doesn't matter which comes first.
FALLBACK_ORDER = {"corpus": lambda: ["id", "version", "added", "created", "url", F.sha2(F.col("text"), 256)], "documents": lambda: ["id"]}

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def read(spark: SparkSession, d: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{table}.parquet")


@query
def papers_by_source_type(spark: SparkSession, d: str) -> DataFrame:
    read(spark, d, "papers").createOrReplaceTempView("papers")
    return spark.sql("SELECT full_text_source_type, count(*) AS n FROM papers GROUP BY full_text_source_type")


@query
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").select("record_id", text.content_hash(F.col("title"), F.col("abstract")).alias("content_hash"))


@query
def normalized_titles(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").select("record_id", text.normalize_text(F.col("title")).alias("title"))


@query
def record_ids(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", text.record_id(F.col("doc_id")).alias("record_id"), text.paper_id(F.col("doc_id")).alias("paper_id"))


@query
def exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return records.exact_dedup(read(spark, d, "papers"))


@query
def split_by_source(spark: SparkSession, d: str) -> DataFrame:
    s, g = mixing.split_by_source(read(spark, d, "corpus"), SCIENCE, GENERAL)
    both = s.withColumn("side", F.lit("science")).unionByName(g.withColumn("side", F.lit("general")))
    return both.groupBy("side", "source").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("n_ids"))


@query
def source_ratio(spark: SparkSession, d: str) -> DataFrame:
    s, g = mixing.split_by_source(read(spark, d, "corpus"), SCIENCE, GENERAL)
    n_science, n_general = mixing.counts(s, g)
    rows = read(spark, d, "mix_config").withColumns({"n_science": F.lit(n_science).cast("long"), "n_general": F.lit(n_general).cast("long")})
    ratio = F.col("n_science") / (F.col("n_science") + F.col("n_general"))
    return rows.select("science_ratio_min", "science_ratio_max", "n_science", "n_general", ratio.between(F.col("science_ratio_min"), F.col("science_ratio_max")).alias("in_range"))


def _fallbacks(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"corpus": read(spark, d, "corpus"), "documents": read(spark, d, "documents").withColumnRenamed("doc_id", "id")}


def _mix(spark: SparkSession, d: str, auto: bool, fallback: bool, alone: bool = False, bounds: tuple[float, float] | None = None) -> DataFrame:
    """The mixture by the row of mix_config with these settings; alone: balanced without fallbacks, within other bounds if given."""
    config = next(r.asDict() for r in read(spark, d, "mix_config").collect() if r["auto_balance"] == auto and (r["science_fallback"] is not None) == fallback)
    if alone:
        config |= {"science_fallback": None, "general_fallback": None, "auto_balance": True}
    least, most = bounds or (config["science_ratio_min"], config["science_ratio_max"])
    s, g = mixing.split_by_source(read(spark, d, "corpus"), SCIENCE, GENERAL)
    tables, names = _fallbacks(spark, d), (config["science_fallback"], config["general_fallback"])
    science, general = (tables[n] if n else None for n in names)
    orders = [FALLBACK_ORDER[n]() if n else ["id"] for n in names]
    return mixing.adjust_mixing(s, g, least, most, config["auto_balance"], science, general, SEED, *orders)


@query
def mix_supplement(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d, True, True).select("id", "source", "version", "shuffle_key")


@query
def mix_validate_only(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d, False, False).select("id", "source", "version", "shuffle_key")


@query
def mix_in_range(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d, True, False).select("id", "source", "version", "shuffle_key")


@query
def mix_fewer_science(spark: SparkSession, d: str) -> DataFrame:
    """Science above the range, without a fallback for the general side."""
    return _mix(spark, d, True, False, alone=True, bounds=LOW_RANGE).select("id", "source", "version", "shuffle_key")


@query
def mix_more_general(spark: SparkSession, d: str) -> DataFrame:
    """Science above the range, with a fallback for the general side."""
    return _mix(spark, d, True, True, bounds=LOW_RANGE).select("id", "source", "version", "shuffle_key")


@query
def mix_without_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Science below the range, without fallbacks: fewer general rows."""
    return _mix(spark, d, False, False, alone=True).select("id", "source", "version", "shuffle_key")


@query
def normalize_schema(spark: SparkSession, d: str) -> DataFrame:
    return normalize_to_corpus(read(spark, d, "documents").withColumnRenamed("doc_id", "id"))


@query
def token_count(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").select("record_id", text.token_count(F.col("clean_text")).alias("n_tokens"))


@query
def latex_residue(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").select("record_id", text.latex_residue(F.col("full_text")).alias("n_commands"))


def _over_texts(spark: SparkSession, d: str, step: Callable) -> DataFrame:
    """A step of cleaning over the whole texts of all papers."""
    return read(spark, d, "papers").where(F.col("full_text").isNotNull()).select("record_id", step(F.col("full_text")).alias("text"))


@query
def clean_pdf_text(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.clean_pdf_text)


@query
def latex_body(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_body)


@query
def latex_comments(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_comments)


@query
def latex_equations(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_equations)


@query
def latex_symbols(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_symbols)


@query
def latex_formats(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_formats)


@query
def latex_references(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.latex_references)


@query
def clean_latex(spark: SparkSession, d: str) -> DataFrame:
    return _over_texts(spark, d, cleaning.clean_latex)


@query
def clean_all_records(spark: SparkSession, d: str) -> DataFrame:
    cleaned = records.clean_all(read(spark, d, "papers").where(F.col("source") == "arxiv"))
    return cleaned.select("record_id", "clean_text", "token_count_approx", "language")


@query
def clean_all_untouched(spark: SparkSession, d: str) -> DataFrame:
    """What cleaning sets where no TeX cleaning is involved: the abstracts."""
    cleaned = records.clean_all(read(spark, d, "papers").where(F.col("source") == "arxiv"))
    own = (F.col("full_text_status").eqNullSafe("abstract_only") | ~records.is_true(F.col("has_full_text"))) & text.truthy(F.col("abstract"))
    return cleaned.where(own).select("record_id", "clean_text", "token_count_approx")


@query
def cleaned_count(spark: SparkSession, d: str) -> DataFrame:
    return records.cleaned_count(read(spark, d, "papers").where(F.col("source") == "arxiv"))


@query
def detect_language(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", text.detect_language(F.col("text")).alias("language"))


@query
def tokenize_utf8_lengths(spark: SparkSession, d: str) -> DataFrame:
    return packing.tokenize(read(spark, d, "documents").select("doc_id", "text")).select("doc_id", F.size("input_ids").alias("n_tokens"))


@query
def tokenize_truncate(spark: SparkSession, d: str) -> DataFrame:
    return packing.tokenize(read(spark, d, "documents").select("doc_id", "text"), max_length=LENGTH).select("doc_id", F.size("input_ids").alias("n_tokens"))


@query
def tokenize_words(spark: SparkSession, d: str) -> DataFrame:
    return packing.tokenize(read(spark, d, "documents").select("doc_id", "text"), "ws").select("doc_id", F.size("input_ids").alias("n_tokens"))


def _placed(spark: SparkSession, d: str) -> DataFrame:
    return order.with_position(read(spark, d, "documents").select("doc_id", "text"), SEED, ["doc_id"])


@query
def shuffled_positions(spark: SparkSession, d: str) -> DataFrame:
    return _placed(spark, d).select("doc_id", "pos")


@query
def pack_accounting(spark: SparkSession, d: str) -> DataFrame:
    placed = _placed(spark, d).select("pos", packing.token_length(F.col("text")).alias("n_tokens"))
    return packing.pack_accounting(placed, LENGTH, batch_size=BATCH, shards=SHARDS, n=read(spark, d, "documents").count())


@query
def pack_sequences(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack(packing.tokenize(_placed(spark, d)), LENGTH, 256, batch_size=BATCH, shards=SHARDS, n=read(spark, d, "documents").count())
    digest = lambda ids: F.md5(F.encode(F.array_join(F.transform(ids, lambda i: F.when(i == 256, "zz").otherwise(F.lpad(F.hex(i), 2, "0"))), ""), "utf-8"))
    attended = F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return packed.select("shard", "batch", "k", F.size("input_ids").alias("n"), digest("input_ids").alias("digest"), attended.alias("n_attended"), digest("labels").alias("labels"))


@query
def fixed_blocks(spark: SparkSession, d: str) -> DataFrame:
    blocks = packing.fixed_blocks(packing.tokenize(read(spark, d, "documents").select("doc_id", "text")), BLOCK, 256)
    pad = F.size(F.filter("input_ids", lambda i: i == 256))
    same = F.count_if(F.col("labels") == F.col("input_ids"))
    return blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(F.size("input_ids")).alias("n_ids"), F.sum(pad).alias("n_padding"), same.alias("n_labelled"))


@query
def train_eval_split(spark: SparkSession, d: str) -> DataFrame:
    return order.train_eval_split(read(spark, d, "documents").select("doc_id"), 0.005, SEED, ["doc_id"])


@query
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    placed = packing.tokenize(_placed(spark, d), max_length=LENGTH)
    exact, logged = (packing.token_stats(placed, LENGTH, exact=e) for e in (True, False))
    return exact.withColumn("mode", F.lit("exact")).unionByName(logged.withColumn("mode", F.lit("logged")))


@query
def token_stats_whole(spark: SparkSession, d: str) -> DataFrame:
    """Exact statistics of the texts as they are, which aren't cut to a sequence."""
    return packing.token_stats(packing.tokenize(_placed(spark, d)), LENGTH).withColumn("mode", F.lit("exact"))


@query
def assign_rank(spark: SparkSession, d: str) -> DataFrame:
    return order.assign_rank(read(spark, d, "documents").select("doc_id"), 7, SEED, ["doc_id"])


def _results(spark: SparkSession, d: str) -> DataFrame:
    return readers.read_results(spark, f"{d}/parse_results.parquet")


@query
def micro_batches(spark: SparkSession, d: str) -> DataFrame:
    dealt = order.assign_rank(read(spark, d, "documents").select("doc_id"), 7, SEED, ["doc_id"])
    return order.micro_batches(dealt, 16).groupBy("rank", "step").agg(F.count(F.lit(1)).alias("n"))


@query
def merge_parsed(spark: SparkSession, d: str) -> DataFrame:
    merged = records.merge_parsed(read(spark, d, "papers"), _results(spark, d))
    return merged.select("record_id", "full_text", "has_full_text", "full_text_format", "full_text_source_type", "full_text_status", F.col("_matched").alias("matched"))


@query
def rows_updated(spark: SparkSession, d: str) -> DataFrame:
    return records.merge_parsed(read(spark, d, "papers"), _results(spark, d)).agg(F.count_if("_matched").alias("n_updated"))


@query
def skip_done(spark: SparkSession, d: str) -> DataFrame:
    work = read(spark, d, "papers").where(F.col("pdf_path").isNotNull()).select("record_id", "arxiv_id")
    return records.skip_done(work, read(spark, d, "parse_results"))


@query
def done_set(spark: SparkSession, d: str) -> DataFrame:
    done = read(spark, d, "papers").where(F.col("full_text_status") == "pdf_parsed").where(F.col("arxiv_id").isNotNull())
    return records.done_set(done, read(spark, d, "parse_results").where(F.col("arxiv_id").isNotNull()))


@query
def replace_targets(spark: SparkSession, d: str) -> DataFrame:
    return records.replace_targets(read(spark, d, "papers"), "arxiv_pdf_pymupdf", "data/pdf")


@query
def path_ids(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").where(F.col("pdf_path").isNotNull()).select("record_id", text.id_of_path(F.col("pdf_path")).alias("arxiv_id"))


@query
def select_pdf_targets(spark: SparkSession, d: str) -> DataFrame:
    return records.pdf_targets(read(spark, d, "papers"), redo_pymupdf=True).select("record_id", "full_text_status", "full_text_source_type")


@query
def comparison_sample(spark: SparkSession, d: str) -> DataFrame:
    return records.comparison_rows(read(spark, d, "papers"), 20).select("record_id", "arxiv_id", "pdf_path")


def _contents(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "papers").where(F.col("full_text").isNotNull()).select("record_id", F.encode("full_text", "utf-8").alias("content"))


@query
def parse_backend(spark: SparkSession, d: str) -> DataFrame:
    return parsing.parse(_contents(spark, d), "plain").select("record_id", "text", "error")


@query
def parse_backend_html(spark: SparkSession, d: str) -> DataFrame:
    return parsing.parse(_contents(spark, d), "html").select("record_id", "text", "error")


@query
def compare_backends(spark: SparkSession, d: str) -> DataFrame:
    rows = parsing.compare_backends(_contents(spark, d), ["plain", "html"], "record_id")
    return rows.select("record_id", "backend", "tokens", "latex_residue")


@query
def comparison_summary(spark: SparkSession, d: str) -> DataFrame:
    return parsing.summarize_comparison(read(spark, d, "backend_compare"))


@query
def comparison_totals(spark: SparkSession, d: str) -> DataFrame:
    """What the comparison of backends comes to, but for its times."""
    compared = parsing.compare_backends(_contents(spark, d), ["plain", "html"], "record_id")
    return parsing.summarize_comparison(compared).drop("median_seconds")


@query
def parse_stats(spark: SparkSession, d: str) -> DataFrame:
    return parsing.parse_stats(read(spark, d, "parse_results"))


@query
def corpus_sources(spark: SparkSession, d: str) -> DataFrame:
    """The distinct sources of the first 5,000 rows by id, as the feature reports them."""
    return read(spark, d, "corpus").orderBy("id").limit(5000).select("source").distinct()


def config_of(d: str) -> dict:
    """The configuration of the flagship: the bounds and fallbacks of mix_config's first row."""
    mix = {"science_ratio_min": 0.80, "science_ratio_max": 0.85, "auto_balance": True, "science_fallback_hf": "corpus", "general_fallback_hf": "documents"}
    data = {"path": f"{d}/corpus.parquet", "science_source_values": list(SCIENCE), "general_source_values": list(GENERAL), "mixing": mix, "packing": {"enabled": True, "eval_split": 0.005}}
    return {"data": data, "training": {"seed": SEED, "max_seq_length": LENGTH, "preprocess_num_proc": SHARDS}}


def _loaded(spark: SparkSession, d: str, config: dict) -> dict[str, DataFrame]:
    orders = {n: of() for n, of in FALLBACK_ORDER.items()}
    return pipelines.load_corpus(spark, config, _fallbacks(spark, d), corpus=read(spark, d, "corpus"), orders=orders, batch_size=BATCH)


@query
def load_corpus(spark: SparkSession, d: str) -> DataFrame:
    return flagship(spark, d)


@query
def load_corpus_unpacked(spark: SparkSession, d: str) -> DataFrame:
    """Documents cut to the length, and no evaluation part."""
    config = config_of(d)
    config["data"]["packing"] = {"enabled": False, "eval_split": 0}
    return pipelines.token_report(_loaded(spark, d, config))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Split by source, mix, tokenize, pack, hold out and count: (split, n_sequences, n_tokens)."""
    return pipelines.token_report(_loaded(spark, d, config_of(d)))


def _stored(spark: SparkSession, d: str) -> str:
    """A store that holds all papers by source and year."""
    root, papers = fresh_folder(spark, "store"), read(spark, d, "papers")
    for source in readers.DEFAULT_SOURCES:
        writers.append_papers(papers.where(F.col("source") == source), root, source)
    return root


@query
def store_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Appended to a store by source and year, and read back."""
    back = readers.read_papers(spark, _stored(spark, d))
    return back.select("record_id", "source", "year", "title", "has_full_text", F.array_join("authors", "|").alias("authors"), F.length("full_text").alias("n_chars"))


@query
def store_replaced(spark: SparkSession, d: str) -> DataFrame:
    """The years that hold a duplicate written anew without their duplicates."""
    root = _stored(spark, d)
    papers = readers.read_papers(spark, root, "arxiv", skip_corrupt=False)
    years = papers.where("is_duplicate").select("year").distinct()
    writers.replace_papers(papers.where(~records.is_true(F.col("is_duplicate"))).join(years, "year", "left_semi").select(papers.columns), root, "arxiv")
    return readers.read_papers(spark, root).groupBy("source", "year").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_duplicate").alias("n_duplicates"))


@query
def store_merged(spark: SparkSession, d: str) -> DataFrame:
    """Results merged into the years of a store that they touch."""
    root = _stored(spark, d)
    merge_into_store(_results(spark, d), root, "arxiv")
    return readers.read_papers(spark, root).select("record_id", "year", "full_text", "has_full_text", "full_text_status")


@query
def store_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """A source of a store cleaned in place."""
    root = _stored(spark, d)
    pipelines.clean_store(spark, root)
    return readers.read_papers(spark, root).select("record_id", "clean_text", "token_count_approx", "language")


def _write_files(df: DataFrame, folder: str) -> None:
    """A file per row of (name, content), below a folder of the shared file system."""

    def write(batches):
        from pyarrow import fs

        system, at = fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))
        system.create_dir(at)
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                with system.open_output_stream(f"{at}/{name}") as out:
                    out.write(bytes(content))
            yield batch[["name"]]

    df.select("name", "content").mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()


def _with_files(spark: SparkSession, d: str) -> tuple[str, str]:
    """A store, and a folder with a file for each of its papers that has a path and a text."""
    root = _stored(spark, d)
    named = read(spark, d, "papers").where((F.col("source") == "arxiv") & F.col("pdf_path").isNotNull() & F.col("full_text").isNotNull())
    _write_files(named.select(F.substring_index("pdf_path", "/", -1).alias("name"), F.encode("full_text", "utf-8").alias("content")), f"{root}/pdf")
    return root, f"{root}/pdf"


@query
def parse_new_files(spark: SparkSession, d: str) -> DataFrame:
    """All files of a folder parsed and merged into a store."""
    root, folder = _with_files(spark, d)
    stats = pipelines.parse_batch(spark, root, folder, f"{root}/results", "plain")
    again = pipelines.parse_batch(spark, root, folder, f"{root}/results", "plain")
    assert again["left"] == 0 and stats["left"] == stats["total"]
    return readers.read_papers(spark, root).select("record_id", "full_text", "full_text_format", "full_text_source_type", "full_text_status")


@query
def parse_to_replace(spark: SparkSession, d: str) -> DataFrame:
    """The texts that one backend made, made anew by another from the files that are there."""
    root, folder = _with_files(spark, d)
    pipelines.parse_batch(spark, root, folder, f"{root}/results", "plain", replace_source="arxiv_pdf_pymupdf")
    return readers.read_papers(spark, root).select("record_id", "full_text", "full_text_format", "full_text_source_type", "full_text_status")


@query
def parse_library(spark: SparkSession, d: str) -> DataFrame:
    """Downloaded files, and those that the plainest backend parsed, parsed by the library's profile into clean texts."""
    root, folder = _with_files(spark, d)
    papers = readers.read_papers(spark, root, "arxiv", skip_corrupt=False)
    writers.replace_papers(papers.withColumn("pdf_path", F.concat(F.lit(f"{folder}/"), F.substring_index("pdf_path", "/", -1))), root, "arxiv")
    pipelines.parse_library(spark, root, "plain", redo_pymupdf=True)
    return readers.read_papers(spark, root, "arxiv").select("record_id", "full_text", "clean_text", "full_text_source_type", "full_text_status", "token_count_approx")


@query
def pdf_listing(spark: SparkSession, d: str) -> DataFrame:
    _, folder = _with_files(spark, d)
    return readers.list_pdfs(spark, folder).select(text.id_of_path(F.col("path")).alias("arxiv_id"), "length")


@query
def corpus_from_json(spark: SparkSession, d: str) -> DataFrame:
    folder = fresh_folder(spark, "corpus")
    read(spark, d, "corpus").write.json(f"{folder}/a/b")
    files = Files(spark, folder)
    for path in list(files.below(folder, ".json")):
        files.move(path, f"{path}l")
    return normalize_to_corpus(readers.read_corpus(spark, f"{folder}/a"))


@query
def corpus_from_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Files below a folder whose columns differ."""
    folder, rows = fresh_folder(spark, "corpus"), read(spark, d, "corpus")
    rows.where(F.col("source").isNotNull()).drop("version").write.parquet(f"{folder}/a")
    rows.where(F.col("source").isNull()).drop("source").write.parquet(f"{folder}/b/c")
    return normalize_to_corpus(readers.read_corpus(spark, folder))


@query
def corpus_from_arrow(spark: SparkSession, d: str) -> DataFrame:
    """A saved dataset of Arrow streams."""
    folder = fresh_folder(spark, "dataset")

    def streams(batches):
        import pyarrow as pa

        sink = pa.BufferOutputStream()
        writer = None
        for batch in batches:
            writer = writer or pa.ipc.new_stream(sink, batch.schema)
            writer.write_batch(batch)
        if writer:
            writer.close()
            body = sink.getvalue().to_pybytes()
            yield pa.RecordBatch.from_pydict({"content": [body]})

    parts = read(spark, d, "corpus").select(*CORPUS_COLUMNS).mapInArrow(streams, "content binary")
    _write_files(parts.select(F.concat(F.lit("data-"), F.sha2("content", 256), F.lit(".arrow")).alias("name"), "content"), folder)
    _write_files(spark.createDataFrame([(readers.SAVED_MARK, bytearray(b"{}"))], "name string, content binary"), folder)
    return readers.read_corpus(spark, folder)


@query
def papers_of_two_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Two tables of papers, one without licenses, united by name."""
    folder, papers = fresh_folder(spark, "papers"), read(spark, d, "papers")
    papers.where(F.col("source") == "arxiv").write.parquet(f"{folder}/a")
    papers.where(F.col("source") != "arxiv").drop("license", "doi").write.parquet(f"{folder}/b")
    return readers.read_union(spark, [f"{folder}/a", f"{folder}/b"]).select("record_id", "license", "doi", "year")


@query
def whole_files(spark: SparkSession, d: str) -> DataFrame:
    """Each full text written to a file and read as one string."""
    _, folder = _with_files(spark, d)
    rows = readers.read_whole_texts(spark, folder)
    return rows.select(text.id_of_path(F.col("path")).alias("arxiv_id"), F.md5(F.encode("text", "utf-8")).alias("digest"))
