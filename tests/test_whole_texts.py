"""The TeX steps over whole texts against the rule table, and statistics of texts that aren't cut."""

from pathlib import Path

import pytest

from lexloom.functions import cleaning
from lexloom.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).is_dir(), reason="no test tables")
#: What the patterns of a step's rules hold.
STEPS = {
    "body": ("document",), "comments": ("%.*$",), "equations": tuple(rf"\\begin\{{{n}" for n in ("equation", "align", "eqnarray", "gather", "multline", "displaymath")) + (r"\\\[.*?\\\]", r"\$\$.*?\$\$"),
    "symbols": (r"\\(alpha|",), "formats": tuple(rf"\\{c}\{{" for c in cleaning.FORMAT_COMMANDS), "references": (r"\\(?:cite|", r"\\(?:ref|"),
}


@pytest.mark.parametrize("step", STEPS)
def test_step_over_whole_texts(spark, step):
    rules = [(p, to) for p, to in cleaning._RULES if any(x in p.pattern for x in STEPS[step])]
    texts = {r["record_id"]: r["full_text"] for r in registry.read(spark, DATA, "papers").where("full_text is not null").collect()}
    got = {r["record_id"]: r["text"] for r in registry.queries()[f"latex_{step}"](spark, DATA).collect()}
    assert rules and got.keys() == texts.keys()
    for key, text in texts.items():
        for pattern, to in rules:
            text = pattern.sub(to, text)
        assert got[key] == text


def test_statistics_of_whole_texts(spark):
    row = registry.queries()["token_stats_whole"](spark, DATA).first()
    texts = [r["text"] or "" for r in registry.read(spark, DATA, "documents").collect()]
    assert (row["n_rows"], row["n_tokens"]) == (len(texts), sum(len(t.encode()) for t in texts))
