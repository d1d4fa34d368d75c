import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.operators import mixing, order, packing, parsing, records
from lexloom.schema import CORPUS, PAPER, conform, normalize_to_corpus, paper, records_to_table


def corpus(spark, rows):
    return spark.createDataFrame([(str(i), s, None, t, None, None, None) for i, (s, t) in enumerate(rows)], CORPUS)


def test_schema(spark):
    assert len(PAPER) == 31 and records_to_table(spark, []).schema == PAPER
    assert records_to_table(spark, [{"record_id": "r", "authors": ["a"]}]).first()["language"] == "en"
    with pytest.raises(TypeError):
        paper(nothing=1)
    out = normalize_to_corpus(spark.createDataFrame([(1, "x", 2.0)], "id long, text string, extra double"))
    assert out.columns == CORPUS.names and out.first()["id"] == "1" and out.first()["source"] is None
    assert conform(spark.createDataFrame([], "a int"), PAPER).count() == 0


def test_split_by_source(spark):
    df = corpus(spark, [("a", "1"), ("b", "2"), ("c", "3"), (None, "4")])
    s, g = mixing.split_by_source(df, ["a", "b"], ["b"])
    assert {r["source"] for r in s.collect()} == {"a", "b"} and [r["source"] for r in g.collect()] == ["b"]
    assert mixing.split_by_source(df, [], [])[0].count() == 0
    with pytest.raises(KeyError):
        mixing.split_by_source(df, [], [], "nothing")


@pytest.mark.parametrize(
    ("n", "options", "plan"),
    [
        ((80, 20), {}, mixing.MixPlan("in range")), ((85, 15), {}, mixing.MixPlan("in range")),
        ((900, 100), {}, mixing.MixPlan("fewer science", keep_science=471)), ((900, 100), {"general_fallback": True}, mixing.MixPlan("add general", add_general=90)),
        ((600, 400), {}, mixing.MixPlan("fewer general", keep_general=127)), ((600, 400), {"science_fallback": True}, mixing.MixPlan("add science", add_science=1285)),
        ((100, 7), {}, mixing.MixPlan("fewer science", keep_science=32)), ((100, 0), {}, mixing.MixPlan("fewer science", keep_science=1)), ((0, 9), {}, mixing.MixPlan("fewer general", keep_general=1)),
        ((900, 100), {"auto_balance": False}, mixing.MixPlan("as it is")),
    ],
)
def test_plan_mix(n, options, plan):
    assert mixing.plan_mix(*n, 0.80, 0.85, **options) == plan


def test_plan_mix_of_nothing():
    with pytest.raises(ValueError):
        mixing.plan_mix(0, 0, 0.8, 0.85)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5000), st.integers(1, 5000))
def test_mix_reaches_the_target(s, g):
    plan = mixing.plan_mix(s, g, 0.80, 0.85)
    s2, g2 = plan.keep_science or s, plan.keep_general or g
    assert plan.action == "in range" or max(s2, g2) == 1 or min(s2, g2) == 1 or abs(s2 - (s2 + g2) * 0.825) <= 1.01 / 0.175


def test_adjust_mixing(spark):
    df = corpus(spark, [("s", f"x{i}") for i in range(90)] + [("g", f"y{i}") for i in range(10)])
    s, g = mixing.split_by_source(df, ["s"], ["g"])
    out = mixing.adjust_mixing(s, g, 0.80, 0.85)
    assert out.groupBy("source").count().orderBy("source").collect() == [("g", 10), ("s", 47)]
    assert [r["id"] for r in out.orderBy("shuffle_key").collect()] == [r["id"] for r in mixing.adjust_mixing(s, g, 0.80, 0.85).orderBy("shuffle_key").collect()]
    external = spark.createDataFrame([(i, None if i == 1 else "t") for i in range(50)], "id long, text string")
    grown = mixing.adjust_mixing(s, g, 0.80, 0.85, general_fallback=external)
    assert grown.where("source = 'general'").count() == 9 - 1  # one of the nine has no text


def test_supplement(spark):
    external = spark.createDataFrame([(0, "a"), (1, ""), (2, "b"), (3, "c")], "id int, text string")
    assert [r["text"] for r in mixing.supplement(external, 3, "general", ["id"]).orderBy("id").collect()] == ["a", "b"]
    assert [r["id"] for r in mixing.supplement(external, 3, "general", ["id"], None, name="e").orderBy("id").collect()] == ["e:0", "e:2"]


def test_positions_are_a_permutation(spark):
    df = spark.range(1000).withColumn("pos", F.lit("taken")).drop("pos")
    placed = order.with_position(df, 42, ["id"]).collect()
    assert sorted(r["pos"] for r in placed) == list(range(1000))
    keys = sorted(range(1000), key=lambda i: hashlib.sha256(f"42|{i}".encode()).hexdigest())
    assert [r["id"] for r in sorted(placed, key=lambda r: r["pos"])] == keys
    assert order.with_position(df.limit(0), 42, ["id"]).count() == 0
    ties = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    assert sorted(r["pos"] for r in order.with_position(ties, 1, ["id"]).collect()) == [0, 1, 2]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 1, 2, 3]), st.sampled_from([None, "a", "b"])), max_size=25), st.integers(0, 30))
def test_first_rows(spark, rows, n):
    df = spark.createDataFrame(rows, "a int, b string").repartition(3)
    first = [tuple(r) for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))[:n]]
    out = [tuple(r) for r in order.first_rows(df, n, ["a", "b"]).collect()]
    assert sorted(out, key=str) == sorted(first, key=str)
    numbered = order.first_rows(df, n, ["a", "b"], "i").orderBy("i").collect()
    assert [(r["a"], r["b"]) for r in numbered] == first and [r["i"] for r in numbered] == list(range(len(first)))


def test_positions_with_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(order, "BUCKET_ROWS", 2)
    df = spark.range(500)
    keys = sorted(range(500), key=lambda i: hashlib.sha256(f"42|{i}".encode()).hexdigest())
    assert [r["id"] for r in order.with_position(df, 42, ["id"]).orderBy("pos").collect()] == keys
    split = order.train_eval_split(df, 0.05, 42, ["id"])
    assert {r["id"] for r in split.where("split = 'eval'").collect()} == set(keys[:25])
    assert {r["id"] for r in order.sample_exact(df, 17, 42, ["id"]).collect()} == set(keys[:17])


def test_micro_batches(spark):
    rows = order.micro_batches(order.assign_rank(spark.range(10), 2, 1, ["id"]), 2).groupBy("rank", "step").count().collect()
    assert sorted(tuple(r) for r in rows) == [(0, 0, 2), (0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 1, 2), (1, 2, 1)]
    assert order.effective_batch(4, 2, 16) == 128


def test_sample_and_split(spark):
    df = spark.range(200)
    assert order.sample_exact(df, 7, 1, ["id"]).count() == 7 and order.sample_exact(df, 900, 1, ["id"]).count() == 200
    assert order.eval_size(100, 0.005) == 0 and order.eval_size(200, 0.005) == 1 and order.eval_size(201, 0.005) == 2 and order.eval_size(500, 0) == 0
    split = order.train_eval_split(df, 0.01, 1, ["id"])
    assert split.where("split = 'eval'").count() == 2 and split.count() == 200
    assert order.train_eval_split(df.limit(0), 0.5, 1, ["id"]).count() == 0


@pytest.mark.parametrize(("n", "world"), [(10, 4), (8, 4), (3, 7), (1, 5), (0, 3)])
def test_assign_rank(spark, n, world):
    rows = order.assign_rank(spark.range(n), world, 1, ["id"]).collect()
    per = math.ceil(n / world)
    assert len(rows) == per * world and {(r["rank"], r["slot"]) for r in rows} == {(a, b) for a in range(world) for b in range(per)}
    assert {r["id"] for r in rows} == set(range(n))


def packed(spark, docs, **options):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "pos long, input_ids array<int>")
    return [(r["shard"], r["batch"], r["k"], r["input_ids"]) for r in packing.pack(df, 4, 0, **options).orderBy("shard", "batch", "k").collect()]


def test_pack(spark):
    assert [x[3] for x in packed(spark, [[1, 2, 3], [4], [5, 6]])] == [[1, 2, 3, 0], [4, 0, 5, 6]]
    assert packed(spark, [[7]]) == [] and packed(spark, []) == [] and [x[3] for x in packed(spark, [None, [], None, []])] == [[0, 0, 0, 0]]
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([], "pos long, input_ids array<int>"), 4, None)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=30), st.integers(1, 6), st.integers(1, 5))
def test_packing_keeps_tokens(spark, sizes, batch, shards):
    out = packed(spark, [[1] * n for n in sizes], batch_size=batch, shards=shards)
    groups, n = {}, len(sizes)
    p = min(shards, n)
    for i, size in enumerate(sizes):
        d, m = divmod(n, p)
        shard = i // (d + 1) if i < m * (d + 1) else m + (i - m * (d + 1)) // d
        start = shard * (d + 1) if shard < m else m * (d + 1) + (shard - m) * d
        groups[shard, (i - start) // batch] = groups.get((shard, (i - start) // batch), 0) + size + 1
    assert len(out) == sum(v // 4 for v in groups.values())
    rows = spark.createDataFrame(list(enumerate(sizes)), "pos long, n_tokens long")
    report = packing.pack_accounting(rows, 4, batch_size=batch, shards=shards).agg(F.sum("n_sequences"), F.sum(F.col("n_sequences") * 4 + F.col("n_dropped"))).first()
    assert tuple(report) == (len(out), sum(sizes) + n)


def test_fixed_blocks(spark):
    df = spark.createDataFrame([(n, [1] * n) for n in (10, 4, 3, 0)], "n int, input_ids array<int>")
    rows = packing.fixed_blocks(df, 4, 9).collect()
    assert {n: sum(r["n"] == n for r in rows) for n in (10, 4, 3, 0)} == {10: 2, 4: 1, 3: 1, 0: 1}
    assert next(r["labels"] for r in rows if r["n"] == 3) == [1, 1, 1, 9]


def test_token_stats(spark):
    df = spark.createDataFrame([(0, [1] * 8), (1, [1])], "pos long, input_ids array<int>")
    assert tuple(packing.token_stats(df, 8).first()) == (2, 9) and tuple(packing.token_stats(df, 8, exact=False).first()) == (2, 16)
    assert tuple(packing.token_stats(df.limit(0), 8).first()) == (0, 0)


def test_tokenize(spark):
    df = spark.createDataFrame([("ab",), ("",), (None,)], "text string")
    assert [r[0] for r in packing.tokenize(df).collect()] == [[97, 98], [], []]
    assert packing.tokenize(df, max_length=1).first()[0] == [97]


def papers(spark, *rows):
    return records_to_table(spark, [{"record_id": f"r{i}"} | r for i, r in enumerate(rows)])


def test_clean_all(spark):
    df = papers(
        spark,
        {"has_full_text": True, "full_text_status": "success", "full_text": r"\textbf{A} b", "full_text_format": "latex", "language": "xx"},
        {"has_full_text": True, "full_text_status": "success", "full_text": "con-\ntinued", "full_text_format": "pdf_text"},
        {"has_full_text": True, "full_text": r"\emph{full}", "abstract": "an abstract", "language": "xx"},
        {"has_full_text": None, "full_text_status": "success", "abstract": "other abstract", "language": "xx"},
        {"has_full_text": True, "full_text_status": "success", "full_text": None, "clean_text": "kept", "language": "xx"},
        {"has_full_text": True, "full_text_status": "success", "full_text": "", "abstract": "", "clean_text": None},
    )
    out = {r["record_id"]: (r["clean_text"], r["token_count_approx"], r["language"]) for r in records.clean_all(df).collect()}
    assert out == {"r0": ("A b", 2, "en"), "r1": ("continued", 1, "en"), "r2": ("an abstract", 2, "en"), "r3": ("other abstract", 2, "xx"), "r4": ("kept", None, "xx"), "r5": (None, None, "en")}
    assert records.clean_all(df.limit(0)).count() == 0
    assert records.clean_all(papers(spark, {"has_full_text": True, "full_text_status": "s", "full_text": "a_b c", "full_text_format": "markdown"}), strict_format=True).first()["clean_text"] == "a_b c"


def test_exact_dedup(spark):
    df = papers(spark, {"title": "A  b"}, {"title": "a B"}, {"title": "c"}, {"title": None, "abstract": None}, {"title": "", "abstract": ""})
    assert [r["is_duplicate"] for r in records.exact_dedup(df).orderBy("record_id").collect()] == [False, True, False, False, True]


def test_merge(spark):
    df = papers(spark, {"arxiv_id": "1"}, {"arxiv_id": "1"}, {"arxiv_id": "2", "full_text": "old"}, {"arxiv_id": None})
    results = spark.createDataFrame([("1", "z", None, 1), ("1", "b", None, 2), ("2", "", None, 3), ("2", None, "bad", 4), ("9", "x", None, 5), (None, "y", None, 6)], "arxiv_id string, text string, error string, delivered int")
    out = records.merge_parsed(df, results).orderBy("record_id").collect()
    assert [r["full_text"] for r in out] == ["b", "b", "old", None] and [r["_matched"] for r in out] == [True, True, False, False]
    assert out[0]["full_text_status"] == "pdf_parsed" and len(out) == 4
    assert records.merge_parsed(df, results.limit(0)).where("_matched").count() == 0
    assert [r["arxiv_id"] for r in records.skip_done(df.select("arxiv_id").distinct(), results).where("arxiv_id is not null").collect()] == []
    assert records.skip_done(df.select("arxiv_id"), results.where("error is not null"), failed_too=True).where("arxiv_id = '2'").count() == 0
    assert records.done_set(df.select("arxiv_id"), results.select("arxiv_id")).count() == 4
    with pytest.raises(ValueError):
        records.merge_parsed(df, results, "nothing")
    with pytest.raises(KeyError):
        records.merge_parsed(df, results.drop("delivered"))


def test_targets(spark):
    df = papers(
        spark,
        {"arxiv_id": "a/1", "full_text_source_type": "arxiv_pdf_pymupdf", "full_text_status": "success"},
        {"arxiv_id": "", "full_text_source_type": "arxiv_pdf_pymupdf"},
        {"arxiv_id": "b", "full_text_status": "pdf_downloaded", "full_text_source_type": "arxiv_pdf_saved", "pdf_path": "x/b.pdf"},
        {"arxiv_id": "c", "full_text_status": None},
    )
    assert [tuple(r) for r in records.replace_targets(df, "arxiv_pdf_pymupdf", "pdf").collect()] == [("a/1", "pdf/a_1.pdf")]
    there = spark.createDataFrame([("elsewhere",)], "path string")
    assert records.replace_targets(df, "arxiv_pdf_pymupdf", "pdf", there).count() == 0
    assert records.pdf_targets(df).count() == 1 and records.pdf_targets(df, True).count() == 3 and records.pdf_targets(df, True, 2).count() == 2
    assert [r["record_id"] for r in records.comparison_rows(df, 5).collect()] == ["r2"]


def test_parse(spark):
    page = b"<html><script>x</script><p>" + b"word " * 60 + b"</p></html>"
    df = spark.createDataFrame([("1", bytearray(page)), ("2", bytearray(b"short")), ("3", None)], "id string, content binary").withColumn("text", F.lit("clash"))
    rows = {r["id"]: r for r in parsing.parse(df, "html").collect()}
    assert rows["1"]["text"].startswith("word") and "x" not in rows["1"]["text"] and rows["2"]["error"] and rows["3"]["error"]
    missing = parsing.parse(df, "docling").where("id = '1'").first()
    assert missing["text"] is None and "not installed" in missing["error"]
    parsing.register("broken", lambda content: 1 / 0)
    assert "ZeroDivisionError" in parsing.parse(df, "broken").first()["error"]
    with pytest.raises(ValueError):
        parsing.parse(df, "nothing")
    compared = parsing.compare_backends(df.drop("text"), ["html", "plain"], "id")
    assert compared.count() == 6 and parsing.summarize_comparison(compared).count() == 2
    assert parsing.parse(df.limit(0), "html").count() == 0


def test_parse_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_text("word " * 60)
    df = spark.createDataFrame([("1", str(tmp_path / "a.pdf")), ("2", f"file://{tmp_path}/a.pdf"), ("3", str(tmp_path / "none.pdf")), ("4", None)], "id string, path string")
    rows = {r["id"]: r for r in parsing.parse(df, "plain", path="path").collect()}
    assert rows["1"]["text"] == rows["2"]["text"] and rows["1"]["path"] and "FileNotFoundError" in rows["3"]["error"] and rows["4"]["error"]
    parsing.register("pages", lambda content: "con-\ntinued\n12\n" + "word " * 60)
    parsing.RAW.add("pages")
    assert parsing.parse(df, "pages", path="path", profile="library").first()["text"].startswith("continued\n\nword")


def test_parse_stats(spark):
    df = spark.createDataFrame([("t", None), (None, "e"), ("", None)], "text string, error string")
    assert tuple(parsing.parse_stats(df).first()) == (3, 1, 1, 1)


def test_library_update(spark):
    df = papers(spark, {}, {})
    parsed = spark.createDataFrame([("r0", "Some text of a paper.")], "record_id string, text string")
    out = parsing.library_update(df, parsed, "docling").orderBy("record_id").collect()
    assert out[0]["full_text_status"] == "success" and out[0]["token_count_approx"] == 5 and out[1]["clean_text"] is None
