"""Noise of scanned pages, languages and markup."""

from pathlib import Path

import pytest

import pages as labelled
from lexloom.llm import languages, markup, scans

needs_files = pytest.mark.skipif(not Path("/opt/tokenizers").is_dir(), reason="no vocabulary files")

SCAN = """Introduction
   The model contains only few parameters and repro-
duces the lattice of low-energy samples with a high-
pressure cell. The rnodel was 1ast used in the well
known scattering study of the conductivity of gra¬

Lanqui et al.
- 12 -
\x0cHOW THE MODEL CONTROLS THE LATTICE ...
phite. The model has conductivity of 5 K and T_c.
sample   T (K)   value
WU-5286   227   179
266
311
(4)

Results
The scattering study of graphite is known. It repro-
duces
13.04.21"""
CLEAN = "The model was last used in the well known study of scattering and conductivity of graphite at high-pressure. It reproduces parameters. "


def scan_rows(spark, *rows):
    return spark.createDataFrame(list(rows), "record_id string, title string, abstract string, full_text string, word string")


def test_noise_of_a_scan(spark):
    rows = [("s", "How the model controls the lattice of graphite", None, SCAN, "x")] + [(f"a{i}", None, CLEAN * 3, None, None) for i in range(10)] + [("n", None, None, "", None), (None, None, None, "a", None)]
    df = scan_rows(spark, *rows)
    lines = SCAN.split("\n")
    out = {(lines[r["line_no"] - 1], r["noise"]) for r in scans.noisy_lines(df).where("record_id = 's'").collect()}
    assert out == {
        (lines[1], "hyphen"), (lines[4], "hyphen"), (lines[17], "hyphen"), (lines[3], "misread"),
        ("Lanqui et al.", "furniture"), ("- 12 -", "furniture"), (lines[8], "furniture"), ("13.04.21", "furniture"),
    }
    text = {r["record_id"]: r["text"] for r in scans.repair(df).collect()}
    assert "reproduces the lattice of low-energy samples with a high-pressure cell. The model was last used" in text["s"]
    assert "conductivity of graphite. The model" in text["s"] and "Lanqui" not in text["s"] and "266\n311" in text["s"]
    assert text["n"] == "" and text["a1"] is None and len(text) == 13
    assert scans.noisy_lines(df.limit(0)).count() == 0
    assert scans.noisy_lines(df.drop("title", "abstract", "word")).count() >= 4


def test_long_and_repeated_scans(spark):
    long = SCAN + "\n" + "The model of the lattice is used here\n" * 20000
    df = scan_rows(spark, ("s", None, CLEAN, long, None), ("s", None, CLEAN, long, None))
    out = scans.noisy_lines(df)
    assert out.count() == out.distinct().count() > 0


def test_bare_numbers():
    doc = "5\nA line of running text that goes on and on\nfor some lines\n6\nand it ends here.\nsample   T (K)   value\nAB-12   1   2\n40\n41\n7\n"
    kinds = dict(zip(doc.split("\n"), scans.classes_of(doc)))
    assert kinds["5"] == kinds["6"] == kinds["7"] == "furniture" and kinds["40"] == kinds["41"] == "number"


def wrapped(seed, rows=30):
    import random

    draw = random.Random(seed)
    words = "the lattice pressure model results of water in runs were measured and found again low high".split()
    return "\n".join(" ".join(draw.choice(words) for _ in range(8)) for _ in range(rows))


def test_headers_and_footers_without_form_feeds():
    pages = [f"Methods of the study\n{wrapped(i)}\n© The Authors, all rights reserved" for i in range(5)]
    text = "\n".join(pages)
    kinds = scans.classes_of(text)
    assert {x for x, c in zip(text.split("\n"), kinds) if c == "furniture"} == {"Methods of the study", "© The Authors, all rights reserved"}
    assert kinds.count("furniture") == 10
    passage = wrapped(1, 12) + "\n"
    assert "furniture" not in scans.classes_of(passage * 6)


def test_a_year_amid_the_text_is_text():
    text = f"{wrapped(1)}\nIn the survey of Klein et al.\n1998\nthe water was low and the model of it high\n{wrapped(2)}"
    assert "furniture" not in scans.classes_of(text)
    counted = f"{wrapped(1)}\n1998\n{wrapped(2)}\n1999\n{wrapped(3)}"
    assert scans.classes_of(counted).count("furniture") == 2


def test_lines_of_any_length_are_classed():
    row = "sample   " + "12.5   " * 80 + "7"
    assert scans.classes_of(row) == ["table"] and scans.classes_of("A\n" + "word " * 40000)[1] == "text"


REAL = {"are": 5000, "arc": 40, "modern": 900, "modem": 12, "had": 4000, "bad": 30, "hear": 10, "bear": 1, "clear": 800, "dear": 9, "eat": 1000, "cat": 20, "com": 90, "corn": 3, "tie": 700, "tic": 5}


@needs_files
def test_words_of_their_own_stay(spark):
    words = scans.lexicon(tuple(f"/opt/tokenizers/{f}" for f in scans.LEXICON))
    for more in ({}, {"model": 100, "rnodel": 2, "lattice": 9000, "latticc": 4, "Iattice": 1}):
        vocab = spark.createDataFrame([(w, n, scans.anagram_hash(w)) for w, n in (REAL | more).items()], "word string, n long, hash long")
        assert {r["word"] for r in scans.corrections(vocab, words=words).collect()} == set(more) - {"model", "lattice"} - {"Iattice"}
    # Ten times the text doesn't make them misreadings.
    vocab = spark.createDataFrame([(w, 10 * n, scans.anagram_hash(w)) for w, n in REAL.items()], "word string, n long, hash long")
    assert scans.corrections(vocab, words=words).count() == 0


def test_corrections(spark):
    words = {"model": 100, "rnodel": 2, "modcl": 1, "form": 50, "forrn": 40, "Model": 30, "of": 99, "0f": 1, "xyz": 3, "iii": 1}
    vocab = spark.createDataFrame([(w, n, scans.anagram_hash(w)) for w, n in words.items()], "word string, n long, hash long")
    out = {r["word"]: (r["correction"], r["place"], r["width"]) for r in scans.corrections(vocab).collect()}
    assert out == {"rnodel": ("model", 0, 2), "modcl": ("model", 3, 1)}
    assert scans.corrections(vocab.limit(0)).count() == 0


def test_anagram_hash():
    assert scans.anagram_hash("abc") == scans.anagram_hash("cba") != scans.anagram_hash("abd")
    shift = (scans.anagram_hash("m") - scans.anagram_hash("rn")) % scans.MODULUS
    assert (scans.anagram_hash("rnodel") + shift) % scans.MODULUS == scans.anagram_hash("model")


SENTENCES = {
    "en": ["The transition is accompanied by a drop of the surface tension.", "Both samples were sealed in glass before the measurement began.", "We report the rate of the reaction near the boundary of the grain."],
    "de": ["Die Ergebnisse zeigen, dass die Löslichkeit deutlich abnimmt.", "Wir untersuchen die Beweglichkeit von Graphit mit Hilfe der Streuung.", "Damit steht ein einfaches Verfahren zur Verfügung."],
    "fr": ["Les mesures ont été répétées et complétées par la suite.", "Nous étudions la viscosité de la couche par diffusion des rayons.", "Cette méthode permet de déterminer la solubilité du graphite."],
    "ja": ["本研究では電子顕微鏡を用いて粘度を測定した。", "圧力が高いとスペクトルに新しいピークが現れる。", "この現象は表面にある欠陥によるものと考えられる。"],
}


@needs_files
def test_languages(spark):
    rows, held = [], {}
    for lang, sentences in SENTENCES.items():
        for i in range(12):
            rows.append((f"{lang}{i}", lang if i % 6 else "en", " ".join(sentences[j % 3] for j in range(i, i + 4)), None))
    mixed = SENTENCES["en"][0] + " " + SENTENCES["en"][1] + "\n\n" + SENTENCES["de"][0] + " " + SENTENCES["ja"][0] + "\n\nTable\n\n" + SENTENCES["en"][2]
    quoted = SENTENCES["en"][0] + " See also „Die Ergebnisse zeigen, dass die Löslichkeit abnimmt“ (Mol, 1999)."
    rows += [("mixed", "en", mixed, None), ("quoted", "en", quoted, None), ("null", None, SENTENCES["fr"][0], None), ("odd", "xx", SENTENCES["fr"][0], None), ("blank", None, " \n", None), ("none", None, None, None), ("x", "en", "5.1 + 3", None), ("long", "en", " ".join(SENTENCES["en"] * 2000), None)]
    df = spark.createDataFrame(rows, "record_id string, language string, clean_text string, lang string")
    labels = spark.createDataFrame([(x, x) for x in SENTENCES], "label string, lang string")
    out = {r["record_id"]: r for r in languages.identify(df, labels).collect()}
    assert len(out) == len(rows)
    for lang in SENTENCES:
        assert all(out[f"{lang}{i}"]["lang"] == lang for i in range(12))
    assert out["blank"]["lang"] is None and out["none"]["segments"] == [] and 0 < out["mixed"]["confidence"] < out["long"]["confidence"] <= 1
    found = {(r["record_id"], r["para_no"], r["lang"]) for r in languages.wrong_or_mixed(df, labels).collect()}
    assert {x[1:] for x in found if x[0] == "mixed"} == {(1, "en"), (2, "de"), (2, "ja"), (4, "en")}
    wrong = {f"{lang}{i}" for lang in ("de", "fr", "ja") for i in (0, 6)} | {"mixed", "null", "odd"}
    assert {x[0] for x in found} - {"x"} == wrong
    places = languages.language_segments(df, labels)
    assert places.where("record_id = 'mixed'").count() == 5 and places.where("start >= end").count() == 0
    assert languages.identify(df.limit(0), labels).count() == 0 and languages.identify(df, labels.limit(0)).where("lang is null").count() == len(rows)


UNSEEN = {
    "en": ["Heat is lost through the wall when the valve remains open.", "None of these methods was able to find the missing atoms.", "The second set of curves has been shifted for clarity."],
    "de": ["Der zweite Versuch wurde bei niedrigem Druck durchgeführt.", "Es wurde kein Einfluss der Temperatur auf das Ergebnis gefunden.", "Zur Messung diente eine Waage mit hoher Genauigkeit."],
    "fr": ["La seconde série de mesures a été faite à basse température.", "On ne trouve aucune trace de cette phase dans les échantillons.", "Le modèle décrit bien la forme des courbes observées."],
    "ja": ["測定の結果は理論とよく一致している。", "温度を下げると電気伝導度が大きく減少した。", "この方法を用いて結晶の構造を調べた。"],
}


@pytest.fixture(scope="module")
def model():
    samples = {lang: [" ".join(s[i % 3 :] + s[: i % 3]) for i in range(20)] for lang, s in SENTENCES.items()}
    learn, held = languages.held_out(samples)
    assert [len(learn["en"]), len(held["en"])] == [18, 2] and not set(UNSEEN["en"]) & set(SENTENCES["en"])
    out = languages.fit(learn, "/opt/tokenizers/piece_bpe_32k.model")
    languages.calibrate(out, held)
    return out


@needs_files
def test_sentences_that_were_not_learnt_from(model):
    for lang, sentences in UNSEEN.items():
        for sentence in sentences:
            assert languages.segments_of(sentence, model)[1] == lang, sentence


@needs_files
def test_switches_within_a_paragraph_have_places(model):
    parts = [SENTENCES["en"][0], SENTENCES["de"][0], SENTENCES["en"][1], SENTENCES["ja"][0]]
    text = "Table 1\n\n" + " ".join(parts) + "\n\n12.5"
    segments, lang, sure = languages.segments_of(text, model)
    assert [(s.para_no, s.lang) for s in segments] == [(1, "en"), (2, "en"), (2, "de"), (2, "en"), (2, "ja")] and lang == "en" and 0 < sure < 0.8
    assert [text[s.start : s.end] for s in segments] == ["Table 1", *parts]
    assert [s.whole for s in segments] == [False, True, True, True, True]


@needs_files
def test_every_sentence_has_a_segment(model):
    text = "Fig. 2 shows it\n\nOui. " + SENTENCES["fr"][0] + " Ja\n\nxyz"
    segments = languages.segments_of(text, model)[0]
    assert all(any(s.start <= i < s.end for s in segments) for i, c in enumerate(text) if c.isalpha())
    assert languages.segments_of("12 + 3 = 15\n\n", model) == ([], None, 0.0)
    assert [s.lang for s in languages.segments_of("Die", model)[0]] == [languages.segments_of("Die", model)[1]]


@needs_files
def test_confidence_is_fitted_on_held_out_labels(model):
    right = {lang: [" ".join(s)] * 10 for lang, s in UNSEEN.items()}
    assert languages.calibrate(model, right) < 0.05 and languages.calibration_error(model, right) < 0.1
    wrong = {lang: right[other] + right[lang] for lang, other in zip(right, ["de", "fr", "ja", "en"])}
    assert languages.calibrate(model, wrong) > 0.3
    languages.calibrate(model, right)


def test_quotations_and_references_of_any_length():
    long = "sehr lange Worte " * 100
    assert languages.words_of(f"We read „{long}“ once ({long}1999).") == ["we", "read", "once"]
    assert languages.words_of("see (and hear) it") == ["see", "and", "hear", "it"]


@needs_files
def test_forward_sums_all_segmentations():
    import itertools

    import numpy as np

    voc = languages.pieces("/opt/tokenizers/piece_bpe_32k.model")
    table = np.random.default_rng(1).random((voc.size, 2)) / 100
    text, total = "▁later", np.zeros(2)
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        edges = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(text)]
        ids = [voc.index.get(text[a:b]) for a, b in zip(edges, edges[1:])]
        if None not in ids:
            total += np.prod(table[ids], axis=0)
    assert np.allclose(languages.forward(voc.edges("later"), table), np.log(total))


PAGES = {
    "<p>Some <b>text</b>.</p>": {"html"}, "Tom &amp; Co": {"html"}, "<!-- x --> text": {"html"}, "# Title\n\ntext": {"markdown"}, "Title\n=====\n\ntext": {"markdown"}, "a **b** c": {"markdown"}, "a ~~b~~ c": {"markdown"},
    "see [x](http://y.z)": {"markdown"}, "![x](y.png) text": {"markdown"}, "a `b` c": {"markdown"}, "a *b* c": {"markdown"}, "text [^1].": {"markdown"}, "== Head ==\n\n* one\n* two": {"wiki"}, "a [[b|c]] d": {"wiki"}, "a ''b'' c": {"wiki"},
    "text{{citation needed}} on": {"wiki"}, "a <ref>n</ref>": {"wiki"}, "<math>\\frac{1}{2}</math>": {"wiki", "latex"}, r"a \emph{b} c": {"latex"}, "so $x^2$ is": {"latex"}, "x_{max} of": {"latex"}, "$$ \\sigma $$\n\n**b**": {"latex", "markdown"},
    "== H ==\n\n# one\n# two": {"wiki"}, "# H\n\n- one\n- two": {"markdown"}, "<p>a</p>\n\n== H ==": {"html", "wiki"}, r"<math>\lambda</math> <b>x</b>": {"html", "wiki", "latex"},
    "x_max was 5 and p* = 9 for T < 3 K and x > 5 (run #24) at $ 5 per kg and $ 7": set(), "    for x in y:\n        z_a = x": set(), "- 12 -\ntext": set(), "T < 3 and x\n> 7.8 of": set(), "the {111} planes [12]": set(), "": set(), "Table\n18. Then": set(),
}


@pytest.mark.parametrize("page", PAGES)
def test_kinds_of_markup(page):
    assert markup.kinds_of(markup.nodes_of(page)[1]) == PAGES[page]


def test_clean_text_keeps_structure():
    page = "<html><head><title>T</title><style>p {x}</style></head><body><h2>Head</h2><p>Some <em>text</em> of a paragraph, with marks.</p><ul><li>one</li><li>two</li></ul><pre><code>if a &lt; b:\n    c</code></pre></body></html>"
    assert markup.clean_of(page)[0] == "## Head\n\nSome text of a paragraph, with marks.\n\n- one\n- two\n\n```\nif a < b:\n    c\n```"
    tex = "\\documentclass{a}\n\\begin{document}\n\\section{S}\nText \\textbf{bold} $x^2$ 5\\%. % note\n\\begin{equation}\nE = m\n\\end{equation}\n\\begin{itemize}\\item a\\item b\\end{itemize}\n\\end{document}"
    assert markup.clean_of(tex)[0] == "## S\n\nText bold $x^2$ 5%.\n\n$$E = m$$\n\n- a\n- b"
    assert markup.clean_of("{{Infobox | a = b}}\n\n== H ==\n\nA '''b''' [[c|d]].<ref>n</ref>\n\n# x\n# y\n\n{|\n| a || b\n|}")[0] == "## H\n\nA b d.\n\n1. x\n2. y\n\na | b"
    assert markup.clean_of("Title\n=====\n\nA **b** [c](d).\n\n```py\nx = 1\n```\n\n| a | b |\n|---|---|\n| 1 | 2 |")[0] == "# Title\n\nA b c.\n\n```\nx = 1\n```\n\na | b\n1 | 2"
    assert markup.clean_of("plain text.\n\nmore.") == ("plain text.\n\nmore.", set())


def test_tag_path_ratios_drop_what_is_no_text(monkeypatch):
    nodes = [markup.Node("html/body/p", "text", "A long paragraph, with several marks. And more of it, too."), markup.Node("html/body/nav", "text", "Home"), markup.Node("html/style", "text", "p {x}")]
    monkeypatch.setattr(markup, "SILENT", frozenset())
    assert markup.content_paths(nodes) == {"html/body/p"} and markup.content_paths([]) == set()


@pytest.mark.parametrize("page, content, other", labelled.PAGES)
def test_menus_and_adverts(monkeypatch, page, content, other):
    monkeypatch.setattr(markup, "SILENT", frozenset())
    text = markup.clean_of(page)[0]
    assert all(c in text for c in content)
    kept = [o for o in other if o in text]
    assert not set(kept) - {"Printed from www.island.example", "We use cookies. Accept", "Buy new boots now! 50 % off."}


def test_the_threshold_is_what_labelled_pages_give():
    pages = []
    for page, content, other in labelled.PAGES:
        nodes = markup.nodes_of(page)[0]
        pages.append((nodes, {i for i, n in enumerate(nodes) if " ".join(n.text.split()) not in other}))
    threshold, rejected = markup.fit_threshold(pages)
    assert markup.THRESHOLD <= threshold and rejected > 0.9


def test_menus_of_links():
    items = "".join(f"<li><a href='{x}'>{x} of the site, with more.</a></li>" for x in ("Home", "News", "Shop"))
    page = f"<body><ul class='m'>{items}</ul><p>{labelled.P1}</p><ul><li>One <a href='x'>thing</a> that is said.</li><li>Another one.</li></ul><div class='side'><h3>Offers</h3><div>Only today</div></div></body>"
    assert markup.clean_of(page)[0] == f"{labelled.P1}\n\n- One thing that is said.\n- Another one."


def test_paths_tell_classes_and_kinds(spark):
    page = "<html><body><div class='box big' id=\"n12\"><p>a <b>b</b> &amp; $x^2$</p></div></body></html>"
    rows = {r["path"]: r for r in markup.markup_paths(spark.createDataFrame([("1", page), ("2", None), ("3", "")], "record_id string, full_text string")).collect()}
    assert {"html/body/div.box#n0/p", "html/entity", "html/b", "latex/math"} <= set(rows) and rows["html/body/div.box#n0/p"]["content"] and rows["html/b"]["n"] == 2


def test_structure_of_any_depth():
    templates = "x {{a|{{b|{{c|{{d|{{e|f}}}}}}}}}} y"
    assert markup.clean_of(templates)[0] == "x y" and markup.kinds_of(markup.nodes_of(templates)[1]) == {"wiki"}
    deep = "\\textbf{" * 9 + "word" + "}" * 9
    assert markup.clean_of(f"A {deep} of it~\\cite{{a{{b{{c{{d{{e}}}}}}}}}}.")[0] == "A word of it."
    assert markup.clean_of("\\begin{document}\\section{A {b {c {d {e}}}} f}\n\ntext\\footnote{one {two {three}}}\\end{document}")[0].startswith("## A")
    assert markup.kinds_of(markup.nodes_of("\\chapter{One}")[1]) == {"latex"}


def test_unclosed_braces_take_linear_time():
    import time

    began = time.thread_time()
    for mark in ("{{a ", "\\a{b ", "\\cite{", "\\section{"):
        markup.clean_of(mark * 50_000)
    assert time.thread_time() - began < 20


def test_markup_rows(spark):
    rows = [("1", "<b>x</b> **y**", "k", 1), ("1", "<b>x</b> **y**", "k", 1), ("2", None, None, None), ("3", "", None, None), (None, "a &lt; b", None, None), ("5", "<p>" + "word, " * 60000 + "</p>", None, None), ("6", "{{" * 3000 + "<" * 3000 + "$" * 3001, None, None)]
    df = spark.createDataFrame(rows, "record_id string, full_text string, text string, kinds int")
    found = {tuple(r) for r in markup.markup_found(df).collect()}
    assert found == {("1", "html"), ("1", "markdown"), (None, "html"), ("5", "html")}
    cleaned = markup.clean_markup(df)
    assert cleaned.count() == 7 and cleaned.where("record_id = '2'").first()["text"] is None and cleaned.where("record_id = '3'").first()["text"] == ""
    assert markup.markup_found(df.limit(0)).count() == 0
