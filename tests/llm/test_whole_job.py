"""Noise and markup that bounds within the code once left out."""

import time
from pathlib import Path

import pytest

from lexloom.llm import markup, mixtures, scans

BODY = "The lattice was measured again at low pressure and\nthe results were the same in every one of the runs.\n" * 3


def test_running_header_that_differs_in_two_places():
    title = "Tuning the carrier \n mobility of\nhigh-pressure hydrogen"
    for header, of in (("Tuning the carrier mobility of", title), ("Tunirig tlie carrier mobility of", title), ("TUNING  THE CARRIER MOBIUTY OF", title), ("Modern rnethods of turbulence", "Modem methods of turbulence in wide channels")):
        text = BODY + header + "\n" + BODY
        assert scans.classes_of(text, of, None)[6] == "furniture", header
    assert scans.classes_of(BODY + "Turning to the carrier side of it\n" + BODY, title, None)[6] == "text"


def test_header_near_another_that_differs_in_two_places():
    head = "HOW THE MODEL CONTROLS THE LATTICE OF GRAPHITE ..."
    assert scans._near("HOW THE MODEL CONTROLS TIIE LATTICE OF GRAPHTE ...", head)
    assert scans._near("HOW THE MODEL CONTROLS THE LATTICE OF GRAPHITE.", head)
    assert not scans._near("Now the model control is a lattice of graphene....", head)


def test_one_wide_line_leaves_a_page_a_page():
    wide = "sample   " + "12.5   " * 30
    text = BODY + "12\n\x0cHOW THE MODEL CONTROLS THE LATTICE ...\n" + BODY + wide + "\n" + BODY
    assert scans.classes_of(text)[6:8] == ["furniture", "furniture"]
    merged = BODY.replace("\n", " ") * 8 + "\n\n"
    assert scans.classes_of(merged + "12\nHOW THE MODEL CONTROLS THE LATTICE ...\n" + merged)[2:4] == ["number", "text"]


LONG = "word and word, " * 700


@pytest.mark.parametrize("page, kinds", [(f"**{LONG}end**", {"markdown"}), (f"__{LONG}end__", {"markdown"}), (f"$$ {LONG} $$", {"latex"}), (f"\\[ {LONG} \\]", {"latex"}), (f"so ${LONG}x$ is", {"latex"}), (f"<!DOCTYPE {LONG}>", {"html"})])
def test_long_spans_of_markup(page, kinds):
    assert markup.kinds_of(markup.nodes_of(page)[1]) == kinds


def test_long_formulas_are_kept():
    body = "\\alpha_{1} + \\frac{a}{b} + " * 400 + "1"
    for page in (f"A text.\n\n$${body}$$\n\nMore.", f"A text.\n\n\\[{body}\\]\n\nMore."):
        assert markup.clean_of(page)[0] == f"A text.\n\n$${body}$$\n\nMore."
    assert f"${body}$" in markup.clean_of(f"A text with ${body}$ in it.")[0]
    assert markup.clean_of(f"A **{LONG}end** of it.")[0] == f"A {LONG}end of it."


def test_text_between_two_formulas_is_no_formula():
    page = f"At 17.5 s$^{{-1}}$, the \\textbf{{rate}} of {LONG}and then 13.1 s$^{{-1}}$, below it."
    assert markup.clean_of(page)[0] == f"At 17.5 s$^{{-1}}$, the rate of {LONG}and then 13.1 s$^{{-1}}$, below it."


def test_openers_without_closers_take_linear_time():
    began = time.thread_time()
    for mark in ("**a ", "__a ", "\\[ a ", "$a ", "<!a"):
        markup.clean_of(mark * 50_000)
    assert time.thread_time() - began < 20


@pytest.mark.skipif(not Path("/opt/tokenizers").is_dir(), reason="no vocabulary files")
def test_scarce_source_falls_short_of_a_filled_mix(spark):
    rows = [(i, f"word {i} " * 6, s) for i, s in enumerate(["a"] * 300 + ["b"] * 300 + ["c"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 2), ("c", 0.1, 4)], "source string, target_share double, max_repeats int")
    least, filled = (mixtures.share_report(mixtures.mix_sources(df, targets, fill=x), targets).collect() for x in (False, True))
    assert sum(r["n_rows"] for r in least) < 50
    report = {r["source"]: r for r in filled}
    assert sum(r["n_tokens"] for r in filled) > 0.99 * sum(len(t.split()) for _, t, _ in rows)
    assert report["c"]["n_rows"] == 4 and report["c"]["reached_share"] < 0.02 and all(r["most_copies"] <= r["max_repeats"] for r in filled)
