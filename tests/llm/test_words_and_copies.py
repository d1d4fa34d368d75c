"""Token budget, formatting duplicates and look-alike text."""

from collections import Counter, defaultdict
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import duplicates, lookalikes, token_budget

VOCABULARY = "/opt/tokenizers"
needs_files = pytest.mark.skipif(not Path(VOCABULARY).is_dir(), reason="no vocabulary files")


def budget_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "record_id string, source string, language string, categories array<string>, clean_text string, token_count_approx int, n_tokens int")


@needs_files
def test_token_counts_and_clashing_names(spark):
    df = budget_rows(spark, ("1", "a", "en", ["x"], "two words", 2, 99), ("2", "a", "en", None, "two words", 3, 99), ("3", "b", None, [], "", 0, 99), ("4", None, None, None, None, None, None), ("5", "b", "en", ["x"], " \n", 7, 1), ("6", "b", "en", ["y"], "one " * 30000, None, 1), ("1", "a", "en", ["x"], "two words", 2, 99))
    n = {(r["record_id"], r["n_words"]) for r in token_budget.count_tokens(df, ["record_id"]).collect()}
    assert n == {("1", 2), ("2", 2), ("3", 0), ("5", 0), ("6", 30000)}
    assert token_budget.count_tokens(df, ["record_id"]).count() == 6
    assert sorted(r[0] for r in token_budget.stale_counts(df).collect()) == ["2", "6"]
    assert token_budget.count_tokens(df.limit(0), ["record_id"]).count() == 0
    labels = spark.createDataFrame([("en", "en")], "label string, lang string")
    domains = spark.createDataFrame([("x", "X")], "category string, domain string")
    out = {(r["source"], r["lang"], r["domain"]): r for r in token_budget.token_budget(df, labels, domains).collect()}
    assert out["a", "en", "X"]["n_docs"] == 2 and out["a", "en", "X"]["n_distinct"] == 1 and out["a", "en", "X"]["n_tokens"] == 2 * out["a", "en", "X"]["n_distinct_tokens"]
    assert out["a", "en", None]["n_docs"] == 1 and out["b", None, None]["n_tokens"] == 0
    assert token_budget.token_budget(df.limit(0), labels, domains).count() == 0


@needs_files
def test_all_kinds_of_vocabularies(spark):
    df = budget_rows(spark, ("1", "a", "en", [], "<|endoftext|> a small text", 2, 0))
    for name in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "word_bpe_49k.json"):
        assert token_budget.count_tokens(df, ["record_id"], vocabulary=name).first()["n_tokens"] > 3


def test_tolerance_is_exact(spark):
    df = budget_rows(spark, ("at", "a", "en", [], "w " * 30, 33, 0), ("over", "a", "en", [], "w " * 30, 34, 0))
    assert [r[0] for r in token_budget.stale_counts(df).collect()] == ["over"]


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "record_id string, title string, abstract string, first string, _v int, n_copies int")


def brute_copies(rows):
    sets = defaultdict(set)
    for id_, title, abstract, *_ in rows:
        bare = [("".join(c for c in (x or "").upper().lower() if c.isalnum())) for x in (title, abstract)]
        if id_ is not None:
            sets[tuple(sorted(bare))].add(id_)
    return sorted((min(s), x) for s in sets.values() for x in s if x != min(s))


CASES = [
    ("b", "A title!", "Some text, 5 K", "x", 1, 1), ("a", "SOME  TEXT 5 k", "a-title", "x", 1, 1), ("c", "A title", "Some text, 6 K", None, None, None), ("d", None, "", None, None, None),
    ("e", "", " ?", None, None, None), ("f", "Straße", "µm", None, None, None), ("g", "STRASSE", "ΜM", None, None, None), (None, "A title", "Some text 5 K", None, None, None), ("b", "A title!", "Some text, 5 K", "x", 1, 1),
    ("h", "w " * 40000, None, None, None, None), ("i", None, "W" * 40000, None, None, None), ("j", "A titleSome", "text 5 K", None, None, None),
]


def test_copies(spark):
    out = sorted(tuple(r) for r in duplicates.copy_pairs(records(spark, *CASES)).collect())
    assert out == [("a", "b"), ("d", "e"), ("f", "g"), ("h", "i")] == brute_copies(CASES)
    kept = {r["record_id"]: r["n_copies"] for r in duplicates.collapse_copies(records(spark, *CASES)).collect()}
    assert kept == {"a": 2, "c": 1, "d": 2, "f": 2, "h": 2, "j": 1, None: 1}
    assert duplicates.copy_pairs(records(spark, *CASES).limit(0)).count() == 0
    named = duplicates.copy_pairs(records(spark, *CASES), any_order=False)
    assert sorted(tuple(r) for r in named.collect()) == [("d", "e"), ("f", "g")]


def test_equal_fingerprints_of_different_records(spark, monkeypatch):
    """With a hash that always collides, the comparison of the fields alone decides."""
    monkeypatch.setattr(duplicates.F, "xxhash64", lambda *a: F.lit(1).cast("long"))
    assert sorted(tuple(r) for r in duplicates.copy_pairs(records(spark, *CASES)).collect()) == brute_copies(CASES)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["ab", "A b", "a.b", "ba", "", None]), st.sampled_from(["ab", "B!", "b", None])), min_size=1, max_size=12))
def test_copies_by_brute_force(spark, fields):
    rows = [(f"{i:02}", a, b, None, None, None) for i, (a, b) in enumerate(fields)]
    assert sorted(tuple(r) for r in duplicates.copy_pairs(records(spark, *rows)).collect()) == brute_copies(rows)


LOOKS = {
    "full width": ("ABC 12", "ＡＢＣ　１２"), "accents": ("café Å", "cafe\u0301 A\u030a"), "ignorable": ("water", "wa\u200bt\u00ader\ufeff"), "spaces": ("a b", "a\u00a0b"), "width of a space": ("a b", "a\u3000b"),
    "latin": ("peace", "реасе"), "mixed word": ("сплав", "сплaв"), "greek": ("NaCl OH", "ΝaCl ΟΗ"), "ligature": ("find", "ﬁnd"), "kelvin": ("5 K Ω", "5 \u212a \u2126"), "half width": ("カタ", "ｶﾀ"), "jamo": ("한", "\u1112\u1161\u11ab"),
    "armenian": ("honour Lot", "հօոօսr Լօt"), "cherokee": ("DRAW WELL", "\u13a0\u13a1\u13aa\u13b3 \u13b3\u13ac\u13de\u13de"),
    "accent behind a twin": ("café 5 Å", "caf\u0435\u0301 5 \u0410\u030a"), "accent within a word": ("кафе\u0301с", "кафe\u0301c"),
    "hyphen": ("a-b", "a‑b"), "jo": ("плёнка", "плe\u0308нка"),
}
UNLIKE = {"case": ("Abc", "abc"), "accent": ("cafe", "café"), "raised": ("cm2", "cm²"), "dash": ("a-b", "a–b"), "word": ("a b", "a b c"), "alpha": ("α form", "a form")}


@pytest.mark.parametrize("name", LOOKS)
def test_looks_alike(name):
    a, b = LOOKS[name]
    assert lookalikes.look_of(a) == lookalikes.look_of(b) and lookalikes.form_of(a) == lookalikes.form_of(b)


@pytest.mark.parametrize("name", UNLIKE)
def test_looks_different(name):
    a, b = UNLIKE[name]
    assert lookalikes.look_of(a) != lookalikes.look_of(b)


def test_words_that_belong_there():
    assert lookalikes.look_of("Հայաստան է") == "Հայաստան է" and lookalikes.look_of("Հայաuտան") == "Հայաստան"
    assert lookalikes.form_of("the name «сплав» of it") == "the name «сплав» of it"


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=30))
def test_forms_are_stable(value):
    assert lookalikes.look_of(lookalikes.look_of(value)) == lookalikes.look_of(value)
    assert lookalikes.form_of(lookalikes.form_of(value)) == lookalikes.form_of(value)


def test_characters_are_replaced_alike_one_by_one_and_together():
    for text in ("".join(map(chr, range(0x2000, 0x2100))), "ﬁ ﾊﾟ №\u3164", "".join(map(chr, range(0xFF00, 0xFFEF)))):
        for visible in (True, False):
            assert lookalikes._mapped(text, visible) == "".join(lookalikes._char(c, visible) for c in text)


def test_classes_stay_linear(spark):
    df = spark.createDataFrame([(i, "a" * (i % 20) + "\u200b" * (1 + i // 20) + "a" * (20 - i % 20)) for i in range(400)], "doc_id long, text string")
    rows = lookalikes.look_alike_classes(df).collect()
    assert len(rows) == 400 and {r["class"] for r in rows} == {0} and {r["n_links"] for r in rows} == {399}


def test_pairs_by_brute_force(spark):
    texts = [x for pair in [*LOOKS.values(), *UNLIKE.values()] for x in pair] + ["peace", "peace", "", None, "\u200b", "long " * 50000, "lоng " * 50000]
    rows = [(i, t, 0) for i, t in enumerate(texts)] + [(3, texts[3], 1)]
    expected = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i < j and a is not None and b is not None and a != b and lookalikes.look_of(a) == lookalikes.look_of(b)}
    df = spark.createDataFrame(rows, "doc_id long, text string, form int")
    out = [tuple(r) for r in lookalikes.look_alike_pairs(df).collect()]
    assert set(out) == expected and max(Counter(out).values()) == 1
    assert lookalikes.look_alike_pairs(df.limit(0)).count() == 0
    links = Counter(x for pair in expected for x in pair)
    classes = lookalikes.look_alike_classes(df).collect()
    assert {(r["doc_id"], r["n_links"]) for r in classes} == set(links.items())
    assert all(r["class"] == min(i for i in links if lookalikes.look_of(texts[i]) == lookalikes.look_of(texts[r["doc_id"]])) for r in classes)
    assert lookalikes.look_alike_classes(df.limit(0)).count() == 0
    formed = lookalikes.with_consistent_form(df)
    assert formed.count() == len(rows) and formed.where("text is null").first()["form"] is None
