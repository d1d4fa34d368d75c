import json

import pyarrow as pa
import pytest

from lexloom import infra
from lexloom.plans import pipelines
from lexloom.schema import records_to_table
from lexloom.sources import readers, storage, writers
from lexloom.sources.storage import Files
from lexloom.streaming import ingest


def table(spark, *years, prefix="r"):
    return records_to_table(spark, [{"record_id": f"{prefix}{i}", "year": y, "arxiv_id": str(i)} for i, y in enumerate(years)])


def test_papers_round_trip(spark, tmp_path):
    root = str(tmp_path)
    assert readers.read_papers(spark, root).count() == 0
    writers.append_papers(table(spark, 2020, 2021, 0, None), root, "arxiv")
    writers.append_papers(table(spark, 2021, prefix="s"), root, "semantic_scholar")
    assert readers.read_papers(spark, root).count() == 5 and readers.read_papers(spark, root, "arxiv").count() == 4
    back = {r["record_id"]: r["year"] for r in readers.read_papers(spark, root, "arxiv").collect()}
    assert back == {"r0": 2020, "r1": 2021, "r2": 0, "r3": None}
    (tmp_path / "arxiv" / "year=2020" / "bad.parquet").write_bytes(b"not parquet")
    assert readers.read_papers(spark, root, "arxiv").count() == 4


def test_replace_reads_what_it_replaces(spark, tmp_path):
    root = str(tmp_path)
    writers.append_papers(table(spark, 2020, 2020, 2021), root, "arxiv")
    some = readers.read_papers(spark, root, "arxiv").where("record_id = 'r0'")
    writers.replace_papers(some, root, "arxiv")
    assert sorted(r["record_id"] for r in readers.read_papers(spark, root, "arxiv").collect()) == ["r0", "r2"]
    assert not list(tmp_path.glob("_staging_*"))


def damage(root):
    """Two years of five files each, one of which is damaged; gives the bytes of all files."""
    bad = sorted((root / "arxiv" / "year=2020").glob("*.parquet"))[0]
    bad.write_bytes(b"PAR1 damaged" + bad.read_bytes()[12:-8])
    return {p: p.read_bytes() for p in (root / "arxiv").rglob("*.parquet")}


def test_merge_leaves_a_damaged_store_as_it_is(spark, tmp_path):
    root = str(tmp_path)
    for i in range(4):
        writers.append_papers(table(spark, *[2020] * 5, *[2021] * 5, prefix=f"r{i}-"), root, "arxiv")
    before = damage(tmp_path)
    results = spark.createDataFrame([("0", "a text", None, 1)], f"{ingest.RESULTS}, delivered int")
    with pytest.raises(Exception):
        ingest.merge_into_store(results, root, "arxiv")
    assert before == {p: p.read_bytes() for p in (tmp_path / "arxiv").rglob("*.parquet")}
    with pytest.raises(Exception):
        pipelines.clean_store(spark, root)
    assert before == {p: p.read_bytes() for p in (tmp_path / "arxiv").rglob("*.parquet")}


def test_what_was_written_is_kept_when_it_can_not_be_put_in_place(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    writers.append_papers(table(spark, 2020, 2021), root, "arxiv")
    move, calls = Files.move, []

    def failing(self, path, to):
        calls.append(path)
        if len(calls) == 4:  # the second year's new folder
            raise OSError("no room")
        move(self, path, to)

    monkeypatch.setattr(Files, "move", failing)
    with pytest.raises(OSError):
        writers.replace_papers(table(spark, 2020, 2021, prefix="s"), root, "arxiv")
    assert {r["record_id"] for r in readers.read_papers(spark, root, "arxiv").collect()} == {"s0", "r1"}
    assert list(tmp_path.glob("_staging_*/year=2021/*.parquet")) and list(tmp_path.glob("_replaced_*/year=2020/*.parquet"))


def test_files_outside_of_year_folders(spark, tmp_path):
    table(spark, 2020).write.parquet(str(tmp_path / "arxiv"))
    with pytest.raises(ValueError):
        readers.folders_of(spark, str(tmp_path), "arxiv")
    assert readers.folders_of(spark, str(tmp_path), "none") == [] and readers.read_folders(spark, str(tmp_path), "none", []).count() == 0


def test_only_touched_years_are_written(spark, tmp_path):
    root = str(tmp_path)
    writers.append_papers(table(spark, 2020, 2021, None), root, "arxiv")
    old = {p.name for p in (tmp_path / "arxiv").rglob("*.parquet")}
    results = spark.createDataFrame([("1", "first", None, 2), ("1", "last", None, 3), ("1", "zero", None, 1), ("2", "x", None, 1)], f"{ingest.RESULTS}, delivered int")
    assert ingest.merge_into_store(results, root, "arxiv") == ["year=2021", "year=__HIVE_DEFAULT_PARTITION__"]
    assert len(old & {p.name for p in (tmp_path / "arxiv").rglob("*.parquet")}) == 1
    assert {r["record_id"]: (r["full_text"], r["year"]) for r in readers.read_papers(spark, root, "arxiv").collect()} == {"r0": (None, 2020), "r1": ("last", 2021), "r2": ("x", None)}
    assert ingest.merge_into_store(results.limit(0), root, "arxiv") == []


def test_shared_folder(spark, tmp_path):
    assert storage.fresh_folder(spark, "x") != storage.fresh_folder(spark, "x") and storage.cut(spark.range(3)).count() == 3


def test_read_corpus(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(tmp_path))
    (tmp_path / "only.json").write_text(json.dumps({"id": "1", "text": "x"}))
    with pytest.raises(ValueError):
        readers.read_corpus(spark, str(tmp_path))
    assert readers.read_corpus(spark, str(tmp_path / "only.json")).count() == 1
    deep = tmp_path / "a" / "b"
    deep.mkdir(parents=True)
    (deep / "x.jsonl").write_text(json.dumps({"id": "2", "text": "y"}) + "\n" + json.dumps({"id": "3", "text": "z"}))
    assert readers.read_corpus(spark, str(tmp_path)).count() == 2
    spark.createDataFrame([("9", "p")], "id string, text string").write.parquet(str(tmp_path / "c" / "p"))
    assert [r["id"] for r in readers.read_corpus(spark, str(tmp_path)).collect()] == ["9"]


def test_saved_dataset(spark, tmp_path):
    (tmp_path / "dataset_info.json").write_text("{}")
    batch = pa.record_batch({"id": ["1", "2"], "text": ["a", None]})
    for name in ("data-0.arrow", "data-1.arrow"):
        with pa.ipc.new_stream(str(tmp_path / name), batch.schema) as out:
            out.write_batch(batch)
    df = readers.read_corpus(spark, str(tmp_path))
    assert df.count() == 4 and df.where("text is null").count() == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ntwo", "utf-8")
    assert readers.read_whole_texts(spark, str(tmp_path / "a.txt")).first()["text"] == "one\n\ntwo"
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    (tmp_path / "b.pdf").write_bytes(b"%PDF-2")
    assert [(r["path"][-5:], r["length"]) for r in readers.list_pdfs(spark, str(tmp_path), ordered=True).collect()] == [("a.pdf", 4), ("b.pdf", 6)]
    assert bytes(readers.list_pdfs(spark, str(tmp_path), content=True).where("length = 4").first()["content"]) == b"%PDF"
    spark.createDataFrame([("1",)], "record_id string").write.parquet(str(tmp_path / "p1"))
    spark.createDataFrame([("2", "mit")], "record_id string, license string").write.parquet(str(tmp_path / "p2"))
    assert {(r["record_id"], r["license"]) for r in readers.read_union(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")]).collect()} == {("1", None), ("2", "mit")}


def test_stream_merges_each_file_once(spark, tmp_path):
    root, results, check = str(tmp_path / "papers"), str(tmp_path / "results"), str(tmp_path / "check")
    writers.append_papers(table(spark, 2020, 2021), root, "arxiv")
    rows = spark.createDataFrame([("0", "a text", None), ("7", "no paper", None)], ingest.RESULTS)
    rows.write.parquet(results)
    for _ in range(2):
        ingest.merge_stream(ingest.stream_results(spark, results), root, "arxiv", check).awaitTermination()
    out = {r["record_id"]: r["full_text"] for r in readers.read_papers(spark, root, "arxiv").collect()}
    assert out == {"r0": "a text", "r1": None}


def test_infra(tmp_path):
    waits, calls = [], []

    @infra.retry(2, 2.0, (OSError,), waits.append)
    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return "done"

    assert flaky() == "done" and waits == [1.0, 2.0]
    slept = []
    limiter = infra.RateLimiter(5, lambda: 0.0, slept.append)
    limiter.wait(), limiter.wait(), limiter.wait()
    assert slept == [5.0, 10.0]
    state = infra.Checkpoint(str(tmp_path / "c.json"))
    state.add(["b", "a"]), state.set_offset(3), state.save()
    again = infra.Checkpoint(str(tmp_path / "c.json"))
    assert again.is_done("a") and again.get("last_offset") == 3
    again.reset()
    assert infra.Checkpoint(str(tmp_path / "c.json")).state == {}
    (tmp_path / "c.json").write_text("{")
    assert infra.Checkpoint(str(tmp_path / "c.json")).state == {}
    assert infra.batch_config("b", {"first_year": 1})["first_year"] == 1
    log = infra.logger("test_infra", str(tmp_path))
    log.warning("hello")
    assert infra.logger("test_infra", str(tmp_path)) is log and len(log.handlers) == 2
    assert json.loads(next(tmp_path.glob("*.jsonl")).read_text())["message"] == "hello"
    assert infra.progress(60, 100, 60.0, 30) == {"done": 60, "total": 100, "per_minute": 30.0, "minutes_left": 40 / 30}
