"""Containers and mixtures."""

from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import containers, mixtures

needs_files = pytest.mark.skipif(not Path("/opt/tokenizers").is_dir(), reason="no vocabulary files")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_plan_holds_every_item(lengths):
    histogram = np.bincount(lengths or [0], minlength=41)
    boxes = containers.plan(histogram, 40)
    used = Counter()
    for bins, times in boxes:
        assert sum(bins) <= 40 and times > 0
        for b in bins:
            used[b] += times
    assert used == Counter(lengths)


def test_plan_fills_well():
    draw = np.random.default_rng(1).gamma(2, 60, 20000).astype(int).clip(1, 256)
    boxes = sum(times for _, times in containers.plan(np.bincount(draw, minlength=257), 256))
    assert draw.sum() / (boxes * 256) > 0.99


def test_nnls_solves_what_can_be_solved():
    shapes = np.array([[3, 1, 0], [2, 2, 0], [4, 0, 0]])
    target = np.array([0, 5.0, 8.0, 5.0, 2.0])
    assert np.allclose(containers.nnls(shapes, target, np.ones(5), 2000), [5, 4, 2], atol=0.05)


def packed(spark, sizes, capacity):
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, n_tokens long, spec_name string")
    spec = spark.createDataFrame([("one", capacity), ("none", 0)], "spec_name string, capacity int")
    return containers.pack_items(items, spec).collect()


@pytest.mark.parametrize("capacity", [1, 7, 10, 1500])
def test_containers(spark, capacity):
    sizes = [*range(0, 40), 5, 5, 5, 1500, 3001]
    rows = packed(spark, sizes, capacity)
    boxes, pieces = Counter(), defaultdict(list)
    for r in rows:
        if r["container"] is not None:
            boxes[r["container"]] += r["n_tokens"]
        pieces[r["doc_id"]].append((r["start"], r["n_tokens"]))
    assert max(boxes.values()) <= capacity and set(boxes) == set(range(1, max(boxes) + 1))
    for i, n in enumerate(sizes):
        parts = sorted(pieces[i])
        assert sum(p for _, p in parts) == n and len(parts) == max(1, -(-n // capacity))
        assert [s for s, _ in parts] == [k * capacity for k in range(len(parts))]
    assert [r["container"] for r in rows if r["n_tokens"] == 0] == [None]


def test_containers_of_odd_input(spark):
    assert packed(spark, [], 10) == [] and len(packed(spark, [None, 3, 3], 10)) == 2
    same = packed(spark, [5] * 5000, 10)
    assert max(r["container"] for r in same) == 2500
    empty = spark.createDataFrame([], "spec_name string, capacity int")
    assert containers.pack_items(spark.createDataFrame([(1, 2)], "doc_id long, n_tokens long"), empty).count() == 0


def test_kept_report(spark):
    items = spark.createDataFrame([(1, 5), (2, 9), (3, 0), (4, None)], "doc_id long, n_tokens long")
    spec = spark.createDataFrame([("s", 4), ("none", 0)], "spec_name string, capacity int")
    packed = containers.pack_items(items, spec)
    assert [tuple(r) for r in containers.kept_report(items, packed, spec).collect()] == [("s", 3, 0, 0, 0)]
    spoilt = packed.where("doc_id <> 1 or piece_no <> 1").withColumn("container", F.lit(1))
    assert [tuple(r) for r in containers.kept_report(items, spoilt, spec).collect()] == [("s", 3, 1, 1, 0)]


@needs_files
def test_any_later_document_may_fill_a_gap(spark):
    """Of thousands of documents only one fits the rest."""
    df = spark.createDataFrame([(i, "a b c d e f g" if i else "a b c", "a") for i in range(3000)], "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    mix = mixtures.mix_sources(df, targets, total=10).collect()
    assert sorted(r["n_tokens"] for r in mix) == [3, 7]


@needs_files
def test_pack_texts(spark):
    df = spark.createDataFrame([(1, "a b c", 9), (1, "a b c", 9), (2, None, 9), (3, "", 9), (4, "word " * 3000, 9)], "doc_id long, text string, n_tokens int")
    spec = spark.createDataFrame([("s", 256)], "spec_name string, capacity int")
    out = containers.pack_texts(df, spec)
    report = containers.fill_report(out, spec).first()
    assert report["n_divided"] == 1 and report["n_over"] == 0 and out.where("doc_id = 3 and container is null").count() == 1 and out.where("doc_id = 1").count() == 2


TARGETS = [("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.2, 3), ("d", 0.0, 1)]


def test_quotas():
    assert mixtures.quotas({"a": 1000, "b": 1000, "c": 1000}, TARGETS) == {"a": 1000, "b": 600, "c": 400, "d": 0}
    assert mixtures.quotas({"a": 1000, "c": 10}, TARGETS) == {"a": 75, "b": 0, "c": 30, "d": 0}  # c repeats thrice; b is missing
    assert mixtures.quotas({}, TARGETS) == {"a": 0, "b": 0, "c": 0, "d": 0}
    given_ = mixtures.quotas({"a": 1000, "b": 100, "c": 1000}, TARGETS, 1000)
    assert given_["b"] == 200 and sum(given_.values()) == 1000 and abs(given_["a"] / given_["c"] - 2.5) < 0.02


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_splitting_tree_is_exact_and_disjoint(shards):
    blocks = np.array([50, 0, 7, 1000])
    taken = [set() for _ in blocks]
    sizes = []
    for k in range(shards):
        offset, n = mixtures.shard_quotas(k, shards, blocks, 5)
        sizes.append(int(n.sum()))
        for s in range(len(blocks)):
            stretch = set(range(offset[s], offset[s] + n[s]))
            assert not stretch & taken[s]
            taken[s] |= stretch
    assert [len(t) for t in taken] == blocks.tolist() and max(sizes) - min(sizes) <= 1
    again = mixtures.shard_quotas(shards - 1, shards, blocks, 5)
    assert (again[1] == n).all()


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 80), st.integers(0, 10**6))
def test_hypergeometric_stays_in_range(good, bad, n, seed):
    n = min(n, good + bad)
    assert max(0, n - bad) <= mixtures.hypergeometric(np.random.default_rng(seed), good, bad, n) <= min(n, good)


def test_hypergeometric_has_its_probabilities():
    from math import comb

    draw, good, bad, n, times = np.random.default_rng(3), 7, 11, 6, 20_000
    seen = Counter(mixtures.hypergeometric(draw, good, bad, n) for _ in range(times))
    for k in range(7):
        p = comb(good, k) * comb(bad, n - k) / comb(good + bad, n)
        assert abs(seen[k] - times * p) < 5 * (times * p * (1 - p)) ** 0.5 + 1


def test_hypergeometric_of_huge_populations():
    draw, good, bad, n = np.random.default_rng(4), 3 * 10**10, 7 * 10**10, 10**6
    values = np.array([mixtures.hypergeometric(draw, good, bad, n) for _ in range(3000)])
    assert abs(values.mean() - 0.3 * n) < 5 * (0.21 * n / 3000) ** 0.5 and abs(values.var() / (0.21 * n) - 1) < 0.15
    blocks = np.array([4 * 10**11, 10**9, 7])
    parts = [mixtures.shard_quotas(k, 4, blocks, 1)[1] for k in range(4)]
    assert sum(parts).tolist() == blocks.tolist()


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 10**6))
def test_permuted_is_a_bijection(size, key):
    assert sorted(mixtures.permuted(np.arange(size), size, key).tolist()) == list(range(size))


@needs_files
def test_mixture(spark):
    rows = [(i, f"word {i} " * (5 + i % 7), s) for i, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 40 + ["x"] * 50 + [None] * 5)] + [(9999, None, "a"), (9998, "", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_tokens", F.lit("clash"))
    targets = spark.createDataFrame([*TARGETS, ("missing", 0.1, 2)], "source string, target_share double, max_repeats int")
    mix = mixtures.mix_sources(df, targets, block_tokens=64, shard_tokens=1000).cache()
    report = {r["source"]: r for r in mixtures.share_report(mix, targets).collect()}
    for s, share, most in TARGETS[:3]:
        assert abs(report[s]["reached_share"] - share) < 0.01 and report[s]["most_copies"] <= most
    assert report["missing"]["reached_share"] == 0 and report["d"]["n_rows"] == 0 and "x" not in {r["source"] for r in mix.collect()}
    assert mix.groupBy("doc_id", "copy").count().where("count > 1").count() == 0
    per = mix.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("m"), F.count_distinct("source").alias("s")).collect()
    assert len(per) > 3 and all(r["n"] == r["m"] for r in per) and max(r["s"] for r in per) == 3
    assert mixtures.mix_sources(df.limit(0), targets).count() == 0 and mixtures.mix_sources(df, targets.limit(0)).count() == 0
    ties = spark.createDataFrame([(1, "same text", "a")] * 5, "doc_id long, text string, source string")
    assert mixtures.mix_sources(ties, targets).count() == 5
