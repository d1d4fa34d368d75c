import json

import pytest

from lexloom.plans import pipelines
from lexloom.schema import CORPUS, records_to_table
from lexloom.sources import readers, writers

CONFIG = """
data:
  path: {path}
  science_source_values: [s]
  general_source_values: [g]
  mixing: {{science_ratio_min: 0.80, science_ratio_max: 0.85, auto_balance: true, general_fallback_hf: other}}
  packing: {{enabled: {packed}, eval_split: {eval_split}}}
training: {{seed: 7, max_seq_length: 16, preprocess_num_proc: 2}}
"""


def config_of(tmp_path, **values):
    (tmp_path / "config.yaml").write_text(CONFIG.format(path=tmp_path / "corpus.parquet", **values))
    return pipelines.read_config(str(tmp_path / "config.yaml"))


def corpus(spark, tmp_path, science=450, general=100):
    rows = [(str(i), "s" if i < science else "g", None, f"a text {i:04}", None, None, None) for i in range(science + general)]
    spark.createDataFrame(rows, CORPUS).write.parquet(str(tmp_path / "corpus.parquet"))


def test_read_config(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a": [1, None]}))
    assert pipelines.read_config(str(tmp_path / "c.json")) == {"a": [1, None]}
    assert config_of(tmp_path, packed="false", eval_split=0)["data"]["packing"] == {"enabled": False, "eval_split": 0}


def test_load_corpus(spark, tmp_path):
    corpus(spark, tmp_path)
    parts = pipelines.load_corpus(spark, config_of(tmp_path, packed="true", eval_split=0.01))
    report = {r["split"]: (r["n_sequences"], r["n_tokens"]) for r in pipelines.token_report(parts).collect()}
    # Two shards of 275 documents with 12 ids each, their separators counted, make 206 sequences each.
    assert report == {"train": (407, 407 * 16), "eval": (5, 5 * 16)}
    row = parts["train"].first()
    assert row["labels"] == row["input_ids"] and sum(row["attention_mask"]) == 16


def test_nothing_is_held_out(spark, tmp_path):
    corpus(spark, tmp_path)
    parts = pipelines.load_corpus(spark, config_of(tmp_path, packed="false", eval_split=0))
    assert parts["eval"].count() == 0 and parts["eval"].schema == parts["train"].schema and parts["train"].count() == 550


def test_fallback_by_name(spark, tmp_path):
    corpus(spark, tmp_path, 90, 10)
    other = spark.createDataFrame([(i, f"more {i}") for i in range(50)], "id int, text string")
    parts = pipelines.load_corpus(spark, config_of(tmp_path, packed="false", eval_split=0), {"other": other})
    assert parts["train"].count() == 90 + 10 + 9
    bare = pipelines.load_corpus(spark, config_of(tmp_path, packed="false", eval_split=0), {"other": other.select("text")})
    assert bare["train"].count() == 109


def store(spark, tmp_path, *rows):
    root = str(tmp_path / "store")
    writers.append_papers(records_to_table(spark, [{"record_id": f"r{i}", "arxiv_id": f"x/{i}", "year": 2020 + i} | r for i, r in enumerate(rows)]), root, "arxiv")
    (tmp_path / "pdf").mkdir()
    for i in (0, 1, 3):
        (tmp_path / "pdf" / f"x_{i}.pdf").write_text("short" if i == 1 else "word " * 60)
    return root


def test_parse_batch(spark, tmp_path):
    root, pdf, out = store(spark, tmp_path, {}, {}, {"full_text_source_type": "old"}), str(tmp_path / "pdf"), str(tmp_path / "out")
    assert pipelines.parse_batch(spark, root, pdf, out, "plain", dry_run=True) == {"total": 3, "done": 0, "left": 3}
    assert not (tmp_path / "out").exists()
    assert pipelines.parse_batch(spark, root, pdf, out, "plain") == {"total": 3, "done": 0, "left": 3, "parsed": 2, "failed": 1, "saved": 1}
    assert pipelines.parse_batch(spark, root, pdf, out, "plain") == {"total": 3, "done": 3, "left": 0, "parsed": 0, "failed": 0, "saved": 0}
    assert pipelines.parse_batch(spark, root, pdf, out, "plain", "arxiv_pdf_plain")["total"] == 1
    rows = {r["record_id"]: r for r in readers.read_papers(spark, root, "arxiv").collect()}
    assert rows["r0"]["full_text_source_type"] == "arxiv_pdf_plain" and rows["r1"]["full_text"] is None and rows["r2"]["full_text_source_type"] == "old"
    with pytest.raises(ValueError):
        pipelines.parse_batch(spark, root, pdf, out, "nothing")


def test_texts_that_were_not_merged_are_merged_next_time(spark, tmp_path, monkeypatch):
    root, pdf, out = store(spark, tmp_path, {}), str(tmp_path / "pdf"), str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(pipelines, "merge_into_store", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            pipelines.parse_batch(spark, root, pdf, out, "plain")
    assert pipelines.parse_batch(spark, root, pdf, out, "plain") == {"total": 3, "done": 3, "left": 0, "parsed": 2, "failed": 1, "saved": 1}
    assert readers.read_papers(spark, root, "arxiv").first()["full_text"].startswith("word")


def test_parse_library(spark, tmp_path):
    pdf = f"{tmp_path}/pdf/x_%d.pdf"
    root = store(spark, tmp_path, {"full_text_status": "pdf_downloaded", "pdf_path": pdf % 0}, {"full_text_status": "pdf_downloaded", "pdf_path": pdf % 1}, {"full_text_status": "pdf_downloaded", "pdf_path": pdf % 2}, {"full_text_source_type": "arxiv_pdf_pymupdf", "pdf_path": pdf % 3})
    assert pipelines.parse_library(spark, root, "plain", dry_run=True) == {"selected": 3}
    assert pipelines.parse_library(spark, root, "plain", max_items=1) == {"parsed": 1, "failed": 0, "skipped": 0}
    assert pipelines.parse_library(spark, root, "plain", redo_pymupdf=True) == {"parsed": 1, "failed": 2, "skipped": 0}
    rows = {r["record_id"]: r for r in readers.read_papers(spark, root, "arxiv").collect()}
    assert [rows[f"r{i}"]["token_count_approx"] for i in range(4)] == [60, None, None, 60] and rows["r3"]["full_text_status"] == "success"


def test_clean_store(spark, tmp_path):
    root = store(spark, tmp_path, {"has_full_text": True, "full_text": r"\textbf{A} b", "full_text_status": "success"}, {"abstract": "own"})
    assert pipelines.clean_store(spark, root) == 1
    assert [r["clean_text"] for r in readers.read_papers(spark, root, "arxiv").orderBy("record_id").collect()] == ["A b", "own"]
