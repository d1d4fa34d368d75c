import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.functions import cleaning, text
from lexloom.functions.tokenizers import encoder

PARAGRAPH = "The transition at 498 K is accompanied by a drop of the lifetime. "


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "c string").select(f(F.col("c")).alias("r")).first()[0]


def test_normalize_text(spark):
    assert one(spark, "  Foo\n BAR ", text.normalize_text) == "foo bar"
    assert one(spark, None, text.normalize_text) is None


def test_content_hash(spark):
    row = spark.createDataFrame([("Foo  BAR", "ABC ")], "t string, a string").select(text.content_hash(F.col("t"), F.col("a"))).first()[0]
    assert row == "sha256:68eb8b13a90c8cd37a504877c493df748f49a44eeb7e9844a90f8aaa0a86aba7"
    empty = spark.createDataFrame([(None, None), ("", " ")], "t string, a string").select(text.content_hash(F.col("t"), F.col("a")).alias("h")).distinct()
    assert empty.count() == 1


def test_ids(spark):
    row = spark.range(7, 8).select(text.record_id(F.col("id")), text.paper_id(F.col("id"))).first()
    assert tuple(row) == ("raw_000007", "paper_000007")
    assert text.batch_id("x") == "x" and re.fullmatch(r"batch_\d{8}_\d{6}", text.batch_id())


def test_token_count(spark):
    for value, n in ((None, 0), ("", 0), (" a  b\n", 2), ("a b　c", 3), ("\x1c", 0)):
        assert one(spark, value, text.token_count) == n


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aB1 \n\t  \x1c​é", max_size=12), min_size=1, max_size=8))
def test_token_count_is_split(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "c string").select("c", text.token_count(F.col("c")).alias("n")).collect()
    assert all(r["n"] == len(r["c"].split()) for r in rows)


def test_detect_language(spark):
    cases = {
        None: "en", "short": "en", PARAGRAPH: "en", "Die Ergebnisse zeigen, dass die Löslichkeit von Kupfer nicht abnimmt und stabil ist.": "de",
        "압력이 382 bar를 넘으면 스펙트럼에 새로운 봉우리가 나타난다.": "ko", "本研究では電子顕微鏡を用いて粘度を測定した。圧力が高いと新しいピークが現れる。": "ja",
        "根据分子动力学的数据，我们提出了一个预测介电常数的模型。所有测量都重复了多次。": "zh", "xxxx yyyy zzzz wwww vvvv": "en",
    }
    for value, lang in cases.items():
        assert one(spark, value, text.detect_language) == lang


def test_paths(spark):
    assert one(spark, "data/pdf/cond-mat_1012.pdf", text.id_of_path) == "cond-mat/1012"
    assert one(spark, "cond-mat/1012", lambda c: text.path_of_id(c, "data/pdf/")) == "data/pdf/cond-mat_1012.pdf"
    assert text.scrub_surrogates("a\ud800b") == "a�b"
    assert one(spark, r"\alpha x \b1", text.latex_residue) == 2 and one(spark, None, text.latex_residue) == 0


def test_clean_pdf_text(spark):
    assert one(spark, "con-\ntinued text\nflows\n12\nEnd", cleaning.clean_pdf_text) == "continued text flows\n\nEnd"
    assert one(spark, "Body.\nReferences\n[1] x", cleaning.clean_pdf_text) == "Body."
    assert one(spark, "Body.\nReferences", cleaning.clean_pdf_text) == "Body.\nReferences"
    assert one(spark, "A\nPage 3 of 10\n3 von 12\n17.01.24\narXiv:2101.1v1 [cs.CE] 3 Jan 2021\nB", cleaning.clean_pdf_text) == "A\n\nB"
    assert one(spark, None, cleaning.clean_pdf_text) is None and one(spark, "", cleaning.clean_pdf_text) == ""


LATEX = {
    "x^{2}": "x2", "a_b": "ab", r"\frac{a}{b}": "a/b", "50\\% off % note": "50% off", r"\section{Intro}Text": "Intro\n\nText", r"\textbf{A} \cite{k} B": "A B",
    r"\begin{equation}E=mc^2\end{equation}": "[EQUATION]", r"$\alpha$": "α", r"\begin{table}x\caption{Cap}\end{table}": "[TABLE: Cap]", r"\begin{table}x\end{table}": "",
    r"A\footnote{n}": "A (n)", r"\begin{itemize}\item one\item two\end{itemize}": "- one\n- two", r"\input{f}": "∈putf", r"x \sim y": "x y", r"foo\_bar": "foo", "a\\\\b": "a\\",
    "a\\begin{document}b\\end{document}c\\end{document}": "b", "": "",
}


def test_latex_to_text():
    for source, plain in LATEX.items():
        assert cleaning.latex_to_text(source) == plain


def test_clean_latex_column(spark):
    rows = spark.createDataFrame([(k, v) for k, v in LATEX.items()] + [(None, None)], "s string, t string")
    assert all(r["o"] == r["t"] for r in rows.select("t", cleaning.clean_latex("s").alias("o")).collect())


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet="abc XY.,é", max_size=40))
def test_plain_prose_is_kept(value):
    once = cleaning.latex_to_text(value)
    assert once == re.sub(r"[ \t]+", " ", value).strip() and cleaning.latex_to_text(once) == once


def test_symbols():
    assert len(cleaning.SYMBOLS) == 83 and cleaning.SYMBOLS["lambda"] == "λ" and cleaning.SYMBOLS["Omega"] == "Ω"


def test_long_text(spark):
    long = PARAGRAPH * 4000
    assert one(spark, long, text.token_count) == len(long.split())
    assert one(spark, long, cleaning.clean_pdf_text) == long.strip()


def test_tokenizers():
    assert encoder("utf8")("é") == [195, 169] and len(encoder("ws")("a b  c")) == 3
    for name in ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        assert encoder(f"/opt/tokenizers/{name}")("a small text")
    try:
        encoder("none")
    except ValueError:
        pass
    else:
        raise AssertionError
