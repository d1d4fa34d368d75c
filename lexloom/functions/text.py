"""Scalar text functions as Catalyst expressions, equal to their definition in terms of Python strings.

Java's regular expressions see ASCII only by default and stop `.` and `$` at more
line ends than Python's, so every pattern here states its dialect.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: white space as Python sees it.
BLANK = r"(?U)[\s\x1c-\x1f]"
# Where an id starts, how content is joined and named, and how long a text must be to have a language.
RECORD_FORMAT, PAPER_FORMAT = "raw_%06d", "paper_%06d"
HASH_PREFIX, HASH_JOIN = "sha256:", "|||"
LEAST_LANGUAGE_LENGTH, DEFAULT_LANGUAGE = 20, "en"
#: Frequent words by language; a text belongs to the language whose words it holds most often.
FUNCTION_WORDS = {
    "en": "the of and to in is was that for with by are were be this which from at as on it its an we our can has have",
    "de": "der die das und von mit für ist wird wurde nicht den dem des ein eine einer auf bei zu im auch sich als wie nach durch zur",
    "fr": "le la les des du et est une dans par pour que qui sur pas ne avec sont au aux ce cette nous été en",
    "es": "el los las del una que se con por para como es en fue más este esta entre sobre al su sus no hemos",
    "pt": "o os as um uma do da dos das em que se com por para como não ao foi foram entre este esta mais na no",
}


def strip(c: Column) -> Column:
    """Without white space at either end."""
    return F.regexp_replace(c, rf"^{BLANK}+|{BLANK}+\z", "")


def normalize_text(c: Column) -> Column:
    """Lower case, runs of white space as one space, none at the ends; null stays null."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), rf"{BLANK}+", " "), r"^ | \z", "")


def content_hash(title: Column, abstract: Column) -> Column:
    """SHA-256 over the normalised title and abstract; null counts as empty."""
    parts = [F.coalesce(normalize_text(c), F.lit("")) for c in (title, abstract)]
    return F.concat(F.lit(HASH_PREFIX), F.sha2(F.encode(F.concat_ws(HASH_JOIN, *parts), "utf-8"), 256))


def record_id(n: Column) -> Column:
    return F.format_string(RECORD_FORMAT, n)


def paper_id(n: Column) -> Column:
    return F.format_string(PAPER_FORMAT, n)


def batch_id(custom: str | None = None, now: datetime | None = None) -> str:
    """The given name, else one made of the local time."""
    return custom or (now or datetime.now()).strftime("batch_%Y%m%d_%H%M%S")


def token_count(c: Column) -> Column:
    """How many words white space separates; null and empty have 0."""
    return F.coalesce(F.size(F.filter(F.split(c, rf"{BLANK}+"), lambda w: w != "")), F.lit(0))


def latex_residue(c: Column) -> Column:
    """How many TeX commands are left in a text."""
    return F.coalesce(F.regexp_count(c, F.lit(r"\\[a-zA-Z]+")), F.lit(0))


def detect_language(c: Column) -> Column:
    """A language by script or by function words, over the whole text.

    Null, short (under 20 characters without outer white space) and undecided
    texts are `en`; so is a tie.
    """
    letters = lambda cls: F.regexp_count(c, F.lit(f"[{cls}]"))
    words = lambda some: F.regexp_count(F.lower(c), F.lit(rf"(?<!\p{{L}})(?:{'|'.join(some.split())})(?!\p{{L}})"))
    counts = F.struct(
        letters(r"\x{ac00}-\x{d7a3}").alias("hangul"), letters(r"\x{3041}-\x{30ff}").alias("kana"), letters(r"\x{4e00}-\x{9fff}").alias("han"),
        F.length(c).alias("all"), F.length(strip(c)).alias("bare"), *[words(some).alias(lang) for lang, some in FUNCTION_WORDS.items()],
    )

    def decide(n: Column) -> Column:
        best = F.greatest(*[n[lang] for lang in FUNCTION_WORDS])
        by_words = F.coalesce(*[F.when(n[lang] == best, lang) for lang in FUNCTION_WORDS])
        by_script = F.when((n["hangul"] >= n["kana"]) & (n["hangul"] >= n["han"]), "ko").when(n["kana"] * 10 >= n["han"], "ja").otherwise("zh")
        wide = (n["hangul"] + n["kana"] + n["han"]) * 4 >= n["all"]
        return F.when(n["all"].isNull() | (n["bare"] < LEAST_LANGUAGE_LENGTH), DEFAULT_LANGUAGE).when(wide, by_script).otherwise(by_words)

    # The counts are bound to a variable, so that each is made once however often it is looked at.
    return F.transform(F.array(counts), decide)[0]


def id_of_path(path: Column) -> Column:
    """The id a PDF's path stands for: the stem, with `_` as `/`."""
    return F.translate(F.regexp_extract(path, r"([^/]*?)(?:\.[^./]*)?$", 1), "_", "/")


def path_of_id(id_: Column, folder: str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), F.translate(id_, "/", "_"), F.lit(".pdf"))


def scrub_surrogates(text: str) -> str:
    """Lone surrogates replaced, for extractors that return such strings."""
    return "".join("�" if "\ud800" <= ch <= "\udfff" else ch for ch in text)


def truthy(c: Column) -> Column:
    """Neither null nor empty, never null itself."""
    return c.isNotNull() & (c != "")
