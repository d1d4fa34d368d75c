"""One consistent form for text that looks alike but is encoded differently.

Two forms are computed for every distinct text:

* ``form``: compatibility composition (NFKC), look-alike letters folded to one
  script per word, every white space mapped to a plain space or line feed,
  default-ignorable characters removed, and full case folding.  Equal forms make
  a class; it is the key that groups documents.
* ``look``: the same without case folding and with the characters whose
  compatibility mapping changes what one sees (raised and lowered digits,
  fractions, circled and squared signs) left alone.  It is the exact check.

The form is computed once per distinct text of the table, in Arrow batches; the
look only of texts that share their form with another one.
"""

from __future__ import annotations

import functools
import hashlib
import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.common import cut, digest

# Letters of other scripts drawn like a Latin letter.
CYRILLIC_TO_LATIN = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X",
    "Ѕ": "S", "І": "I", "Ј": "J", "Ү": "Y", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W", "Ё": "Ë", "Ї": "Ï",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ё": "ë", "ї": "ï", "Ӏ": "I", "ӏ": "l",
}
GREEK_TO_LATIN = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ϲ": "c", "ϳ": "j", "ν": "v", "ό": "ó",
}
ARMENIAN_TO_LATIN = {"Լ": "L", "Ս": "U", "Տ": "S", "Օ": "O", "հ": "h", "ո": "n", "ս": "u", "օ": "o"}
CHEROKEE_TO_LATIN = {
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G",
    "Ꮓ": "Z", "Ꮟ": "b", "Ꮢ": "R", "Ꮤ": "W", "Ꮥ": "S", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ꮷ": "d", "Ᏻ": "G", "Ᏼ": "B",
}
#: Each of these scripts with its letters that have a Latin twin, as (table, first letter, last letter).
SCRIPTS = ((CYRILLIC_TO_LATIN, "Ѐ", "ԯ"), (GREEK_TO_LATIN, "Ͱ", "Ͽ"), (ARMENIAN_TO_LATIN, "Ա", "և"), (CHEROKEE_TO_LATIN, "Ꭰ", "Ᏽ"))
# Ranges with the Unicode property Default_Ignorable_Code_Point.
DEFAULT_IGNORABLE = (
    (0x00AD, 0x00AD), (0x034F, 0x034F), (0x061C, 0x061C), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F),
    (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF),
    (0xFFA0, 0xFFA0), (0xFFF0, 0xFFF8), (0x1BCA0, 0x1BCA3), (0x1D173, 0x1D17A), (0xE0000, 0xE0FFF),
)
# Signs drawn like the hyphen; longer dashes differ visibly.
HYPHENS = "‐‑﹣－"
#: Decomposition types whose mapping keeps the look.
SAME_LOOK = ("<wide>", "<narrow>", "<noBreak>", "<compat>")

_FOREIGN = re.compile("[" + "".join(f"{low}-{high}" for _, low, high in SCRIPTS) + "]+")
_SPECIAL = re.compile(r"[^\x20-\x7e\n]")
_PLAIN = frozenset(map(chr, range(0x20, 0x7F))) | {"\n"}
#: Up to so many different characters of a text are replaced one by one, which is faster than looking up each of its characters.
FEW = 24


def _ignorable(code: int) -> bool:
    return any(a <= code <= b for a, b in DEFAULT_IGNORABLE)


@functools.lru_cache(maxsize=1 << 16)
def _char(ch: str, visible: bool) -> str:
    """What a single character becomes before composition; what it becomes stays as it is."""
    code = ord(ch)
    if _ignorable(code):
        return ""
    if ch in HYPHENS:
        return "-"
    if ch in "\r\x0b\x0c\x85\u2028\u2029":
        return "\n"
    if ch == "\t" or unicodedata.category(ch) == "Zs":
        return " "
    kind = unicodedata.decomposition(ch).split(" ", 1)[0]
    if kind.startswith("<") and (not visible or kind in SAME_LOOK):
        return "".join(c if c == ch or c in _PLAIN else _char(c, visible) for c in unicodedata.normalize("NFKD", ch))
    return ch


def _mapped(text: str, visible: bool) -> str:
    """The text with each character replaced by what it becomes."""
    changed = {c: to for c in set(text) - _PLAIN if (to := _char(c, visible)) != c}
    if len(changed) > FEW:
        return text.translate({ord(c): to for c, to in changed.items()})
    for c, to in changed.items():
        text = text.replace(c, to)
    return text


@functools.lru_cache(maxsize=1 << 16)
def _word(word: str) -> str:
    """A word in one script: the script of its letters that have no Latin twin, else Latin; accents are taken apart, as twins share them."""
    word = unicodedata.normalize("NFD", word)
    for k, (table, low, high) in enumerate(SCRIPTS):
        if any(low <= c <= high and c not in table and c.isalpha() for c in word):
            back = _inverse(k)
            return "".join(back.get(c, c) for c in word)
    return "".join(next((table[c] for table, _, _ in SCRIPTS if c in table), c) for c in word)


def _in_word(ch: str) -> bool:
    return ch.isalpha() or unicodedata.combining(ch) > 0


def _one_script(text: str) -> str:
    """Every word that holds a letter of another script than Latin which may have a twin there, written in one script."""
    out, done = [], 0
    for match in _FOREIGN.finditer(text):
        start, end = match.span()
        if start < done:
            continue
        while start > done and _in_word(text[start - 1]):
            start -= 1
        while end < len(text) and _in_word(text[end]):
            end += 1
        out += [text[done:start], _word(text[start:end])]
        done = end
    return "".join(out) + text[done:]


def _tidy(text: str) -> str:
    if "  " in text:
        text = re.sub(r"  +", " ", text)
    if " \n" in text or "\n " in text:
        text = re.sub(r" ?\n ?", "\n", text)
    return text.strip()


@functools.lru_cache(maxsize=len(SCRIPTS))
def _inverse(k: int) -> dict[str, str]:
    """Letters of Latin and the other scripts that have a twin in script k."""
    to = {latin: own for own, latin in reversed(SCRIPTS[k][0].items())}
    return to | {c: to[latin] for j, (table, _, _) in enumerate(SCRIPTS) if j != k for c, latin in table.items() if latin in to}


def look_of(text: str) -> str:
    """The text with every character replaced by the one that stands for all of its look."""
    if text.isascii() and not _SPECIAL.search(text):
        return _tidy(text)
    text = _one_script(unicodedata.normalize("NFC", _mapped(text.replace("\r\n", "\n"), True)))
    # A letter that took its twin's place may now compose with the accent behind it.
    return _tidy(unicodedata.normalize("NFC", text))


def form_of(text: str) -> str:
    """The consistent form: equal for all texts that look alike, also across letter case and raised digits."""
    if text.isascii() and not _SPECIAL.search(text):
        return _tidy(text.lower())
    text = unicodedata.normalize("NFKC", _mapped(text.replace("\r\n", "\n"), False))
    return _tidy(unicodedata.normalize("NFKC", _one_script(text).casefold()))


def _per_value(values: pd.Series, of) -> pd.Series:
    """of() of every distinct value, spread over its occurrences; null stays null."""
    codes, distinct = pd.factorize(values)
    done = pd.Series([of(v) for v in distinct], dtype=object)
    return pd.Series([None if c < 0 else done[c] for c in codes], index=values.index, dtype=object)


@F.pandas_udf(T.StringType())
def consistent_form(values: pd.Series) -> pd.Series:
    return _per_value(values, form_of)


def _digests(of: Callable[[str], str]):
    """Pandas UDF text -> 16 bytes for what of() makes of it."""

    @F.pandas_udf(T.BinaryType())
    def digested(values: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else hashlib.blake2b(of(v).encode("utf-8", "replace"), digest_size=16).digest() for v in values], index=values.index, dtype=object)

    return digested


def with_consistent_form(df: DataFrame, text: str = "text", out: str = "form") -> DataFrame:
    """df with one more column, the consistent form of a text column.

    Null gives null and a text of white space or ignorable characters alone gives ''.
    All rows are kept, repeated ones too.  A column named like `out` is replaced.
    """
    return df.withColumn(out, consistent_form(F.col(text)))


def _texts(df: DataFrame, text: str) -> DataFrame:
    """(_same, _text): each distinct text with its digest."""
    return df.where(F.col(text).isNotNull()).select(digest(F.col(text)).alias("_same"), F.col(text).alias("_text")).groupBy("_same").agg(F.first("_text").alias("_text"))


def _several(rows: DataFrame, key: str) -> DataFrame:
    """(key): the keys that more than one text has."""
    return rows.groupBy(key).agg(F.min("_same").alias("_least"), F.max("_same").alias("_most")).where(F.col("_least") != F.col("_most")).select(key)


def look_alike_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """(_same, _look): the digests of the texts that look like another one, and of their look.

    Texts are grouped by the digest of their consistent form; the look, as the
    exact check, is computed only of those whose form another text has too.
    """
    forms = cut(_texts(df, text).select("_same", _digests(form_of)("_text").alias("_form")))
    candidates = cut(forms.join(_several(forms, "_form"), "_form", "left_semi").select("_same"))
    again = df.where(F.col(text).isNotNull()).select(F.col(text).alias("_text")).withColumn("_same", digest(F.col("_text"))).join(candidates, "_same", "left_semi")
    looks = cut(_texts(again, "_text").select("_same", _digests(look_of)("_text").alias("_look")))
    return looks.join(_several(looks, "_look"), "_look", "left_semi").select("_same", "_look")


def _members(df: DataFrame, looks: DataFrame, id_col: str, text: str) -> DataFrame:
    """(_id, _same, _look): the rows that look like one with another text; rows that repeat an id and a text count once."""
    rows = df.where(F.col(text).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), digest(F.col(text)).alias("_same"))
    return rows.join(looks, "_same").distinct()


def look_alike_classes(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(<id>, class, n_links): each row that looks like one with another text, with the smallest id of its look and the number of such rows.

    The number of pairs in a class may grow as its square; this stays linear.
    Cases as in look_alike_pairs.
    """
    members = cut(_members(df, look_alike_texts(df, text), id_col, text))
    looks = members.groupBy("_look").agg(F.min("_id").alias("class"), F.count(F.lit(1)).alias("_all"))
    same = members.groupBy("_same").agg(F.count(F.lit(1)).alias("_own"))
    joined = members.join(looks, "_look").join(same, "_same")
    return joined.select(F.col("_id").alias(id_col), "class", (F.col("_all") - F.col("_own")).alias("n_links"))


def look_alike_pairs(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Pairs (<id>_a < <id>_b) of rows whose texts differ as strings and look the same.

    Pairs are formed between the distinct texts of a look and only then spread
    over the rows that hold them, so rows with the very same text never meet each
    other, however many they are.  Null texts and null ids are in no pair; of
    rows that repeat an id and a text one counts; other columns are ignored.
    """
    texts = cut(look_alike_texts(df, text))
    members = cut(_members(df, texts, id_col, text))
    others = texts.select("_look", F.col("_same").alias("_other"))
    pairs = texts.join(others, "_look").where(F.col("_same") < F.col("_other"))
    left = members.select(F.col("_id").alias("_x"), "_same")
    right = members.select(F.col("_id").alias("_y"), F.col("_same").alias("_other"))
    return (
        pairs.select("_same", "_other").join(left, "_same").join(right, "_other").where(F.col("_x") != F.col("_y"))
        .select(F.least("_x", "_y").alias(f"{id_col}_a"), F.greatest("_x", "_y").alias(f"{id_col}_b"))
    )
