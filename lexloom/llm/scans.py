"""Noise in text from scanned pages: page furniture, words broken across lines, misrecognised characters.

1. Every line of a document is classed by its place and shape.  Furniture are
   lines at the edges of pages: numbers that count pages, lines that recur from
   page to page but for numbers and misread characters, and such as bear the
   title, authors or volume.  Pages need no form feeds.
2. The words of the running text of all documents are counted.  A rare word
   meets the frequent words it may be a misreading of by anagram hash: the sum
   of the fifth powers of its characters.  A confusion of characters changes the
   hash by a fixed difference, so that rare and frequent words are joined on
   hash and difference in SQL, and verified by carrying the confusion out.  How
   often each confusion happens is estimated from all words; a word that occurs
   more often than that explains is a word of its own, the sooner if a public
   vocabulary has it.
3. A line that ends in a sign of hyphenation is judged by how often the joined
   and the hyphenated word occur in all documents.
4. Repair drops furniture, joins broken words, puts in the corrections and makes
   paragraphs.
"""

from __future__ import annotations

import base64
import functools
import json
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher
from operator import eq
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.common import TOKENIZERS, cut

# Signs that stand for hyphenation at the end of a line.
BREAKS = "-‐‑­¬"

#: Characters from which a line is wider than a page's.
WIDE = 130

_BLANKS = " \t\r\x0c "
_NUMBERED = re.compile(
    r"(?:[-–—]\s*\d{1,5}\s*[-–—]|\[\s*\d{1,5}\s*\]|p\.\s*\d{1,5}\s*/\s*\d{1,5}|(?:Page|Seite|Página|Pagina|Pág\.|Stranica)\s+\d{1,5}(?:\s*(?:of|von|de|/|sur)\s*\d{1,5})?"
    r"|\d{1,5}\s+(?:von|of|de|sur)\s+\d{1,5}|(?:쪽|第)\s*\d{1,5}\s*(?:页|頁)?|\d{1,5}\s*/\s*\d{1,5})",
    re.I,
)
_STAMP = re.compile(r"arXiv\s*:\s*\S{6,}\s.*\d{4}|arXiv\s*:\s*\S{6,}(?:\s*\[[^\]]*\])?$")
_DATE = re.compile(r"\d{1,2}\.\d{1,2}\.(?:\d{2}|\d{4})")
_BARE = re.compile(r"\d{1,5}|[ivxlc]{1,7}")
_AUTHORS = re.compile(r"(?:\d{1,5}\s{1,6})?(?:[^\s(]{3,}\s+(?:et\s+\S{1,4}\.?|\S{1,3}\s+al\.)|[^\W\d_a-z]\S{2,}?.?et.{1,2}al\.)(?:\s{1,6}\d{1,5})?")
_VOLUME = re.compile(r"(?:\d{1,5}\s{1,6})?(?:\S.{3,},\s+V\S{1,3}\.\s*|[^\W\d_a-z][^\d.]{8,}[,\s]\S{0,3}ol\S{0,4}?\s?)\d{1,5}(?:\s{1,6}\d{1,5})?")
_PAGED = re.compile(r"^\d{1,5}\s{2,6}(?=\D)|(?<=\S)\s{2,6}\d{1,5}$")
_SAMPLES = re.compile(r"[A-Z]{1,3}-?\d+(?:\s+-?[\d.,]+){1,8}")
_HEADER = re.compile(r"[^\\|{}<>=]*[^\\|{}<>=.,;:!?-]")
_HEADING = re.compile(r"#{1,6}\s+\S.*")
_EQUATION = re.compile(r"\(\s*\d{1,3}[a-z]?\s*\)|.*[^\s\w]\s*=\s*.*\(\d{1,3}\)|\S{1,12}\s*=\s*\S.*")
_WORD = re.compile(r"[^\W_][\w!|'’]*(?:-[^\W_][\w!|'’]*)*|[!|][^\W\d_][\w!|]*")
_LETTER = re.compile(r"[A-Za-zÀ-ɏ]")


def _is_upper(line: str) -> bool:
    letters = [c for c in line if c.isalpha()]
    return len(letters) >= 8 and " " in line and sum(c.isupper() for c in letters) >= 0.85 * len(letters) and any(c != c.lower() for c in letters)


def _like(line: str, title: str) -> bool:
    """Whether a line is the beginning of a case-folded title, but for case and misread characters."""
    line = line.rstrip(". ").casefold()
    if len(line) < 8 or line[:1] != title[:1] and line[1:3] != title[1:3]:
        return False
    if any(_same(line, title[: len(line) + shift]) for shift in (0, 1, -1)):
        return True
    # Characters in common bound the likeness with any of the beginnings.
    if (Counter(line) & Counter(title[: len(line) + 3])).total() < 0.88 * (len(line) - 1.5):
        return False
    return any(_alike(line, title[: len(line) + shift]) for shift in (0, -1, 1, -2, 2, -3, 3))


def _same(line: str, other: str) -> bool:
    """Whether two lines agree in place, or from both ends up to a character that became two or vanished; a cheap test before _alike."""
    n = max(1, len(line))
    if len(line) == len(other) and sum(map(eq, line, other)) >= 0.85 * n:
        return True
    front = len(commonprefix((line, other)))
    return front + len(commonprefix((line[front:][::-1], other[front:][::-1]))) >= 0.88 * n


def _alike(line: str, other: str) -> bool:
    """Whether two lines agree in long enough blocks, wherever their lengths change."""
    match = SequenceMatcher(None, line, other, autojunk=False)
    # The quicker ratios are upper bounds.
    return match.real_quick_ratio() >= 0.88 and match.quick_ratio() >= 0.88 and match.ratio() >= 0.88


def _flat(line: str) -> str:
    """A line without page numbers at its ends and with single spaces."""
    if line[:1].isdigit() or line[-1:].isdigit():
        line = _PAGED.sub("", line)
    return " ".join(line.split())


def _is_table(line: str) -> bool:
    """Whether a line is a row of a table: a wide gap before its last entry, and one behind one of its first four words; or a sample with numbers."""
    gaps = re.findall(r"\s+", line)
    wide = [len(g) > 1 or g == "\t" for g in gaps]
    return len(gaps) > 1 and wide[-1] and any(wide[:-1][:4]) or _SAMPLES.fullmatch(line) is not None


def classes_of(text: str, *titles: str | None) -> list[str]:
    """A class per line: blank, furniture, table, number, heading, equation, code or text.

    A document most of whose text isn't broken to a page's width has no furniture
    but numbered lines, stamps and dates.
    """
    lines = text.split("\n")
    n = len(lines)
    bare = [x.strip(_BLANKS) for x in lines]
    out = ["text"] * n
    filled = [i for i in range(n) if bare[i]]
    if not filled:
        return ["blank"] * n
    wrapped = len(filled) > 3 and _is_wrapped([len(bare[i]) for i in filled])
    for i in range(n):
        s = bare[i]
        size = len(s)
        if not s:
            out[i] = "blank"
        elif size < 40 and _NUMBERED.fullmatch(s) or "arXiv" in s[:8] and _STAMP.fullmatch(s):
            out[i] = "furniture"
        elif size < 12 and _DATE.fullmatch(s):
            out[i] = "date"
        elif size < 9 and _BARE.fullmatch(s):
            out[i] = "bare"
        elif s[0] == "#" and _HEADING.fullmatch(s):
            out[i] = "heading"
        elif wrapped and (("al" in s[-12:] or "et" in s[-18:]) and _AUTHORS.fullmatch(s) or s[-1].isdigit() and ("ol" in s or " V" in s) and s[0].isalnum() and _VOLUME.fullmatch(s)):
            out[i] = "furniture"
        elif s[0] == "(" and size < 12 and re.fullmatch(r"\(\s*\d{1,3}[a-z]?\s*\)", s):
            out[i] = "equation"
        elif wrapped and (s.endswith("...") or "... " in s or not s[1:4].islower()) and (_PAGED.sub("", s).endswith(" ...") or _is_upper(_PAGED.sub("", s))) and not re.search(r"\s{2,}\S+\s{2,}", s):
            out[i] = "furniture"
        elif ("  " in s or "\t" in s or s[0].isupper() and not s[1:2].islower()) and _is_table(s):
            out[i] = "table"
        elif lines[i].startswith("    ") and not (i and out[i - 1] == "text"):
            out[i] = "code"
    # Title and abstract may stand in each other's place; the shorter one is the title.
    for title in sorted((" ".join(t.split()).casefold() for t in titles if wrapped and t), key=len)[:1]:
        for i in filled:
            if out[i] == "text" and not (i + 1 < n and re.fullmatch(r"[=-]{3,}", bare[i + 1])) and len(flat := _flat(bare[i])) <= len(title) + 12 and _like(flat, title):
                out[i] = "furniture"
    if wrapped:
        heads = {_flat(bare[i]) for i in filled if out[i] == "furniture" and len(bare[i]) > 9 and bare[i][:1].isalpha()}
        for i in filled if heads else ():
            if out[i] == "text" and len(bare[i]) > 9 and _at_edge(lines, out, i) and any(_near(_flat(bare[i]), h) for h in heads):
                out[i] = "furniture"
        _recurring(lines, bare, out, filled)
    _numbers(lines, bare, out, wrapped)
    if wrapped:
        # A line that starts anew where a word was broken off, and doesn't go on in the next, is a running header.
        running = [i for i in filled if out[i] == "text"]
        for i, j, k in zip(running, running[1:], running[2:]):
            if bare[i][-1] in BREAKS and bare[i][-2:-1].isalpha() and re.match(r"[^\W\d_]", bare[j]) and bare[j][0].isupper() and bare[j][1:2].islower() | (bare[j][1:2] == " ") and bare[k][0].islower() and not bare[j].endswith((".", ",")):
                if bare[i][-1] != "-" or bare[i][-2].islower() and out[j - 1] != "text" or "\x0c" in lines[j] or len(bare[j]) < 0.9 * len(bare[i]):
                    out[j] = "furniture"
    return out


def _recurring(lines: list[str], bare: list[str], out: list[str], filled: list[int]) -> None:
    """Lines that recur from page to page but for their numbers.

    Twice is enough at an edge that shows itself by a form feed, page number or
    other furniture.  Elsewhere a line has to recur three times at distances like
    those of pages, and not as part of a longer passage that recurs; it is shorter
    than the lines around it, or recurs a fourth time and what stands before and
    after it changes.
    """
    places: dict[str, list[int]] = defaultdict(list)
    for i in filled:
        if out[i] == "text" and not bare[i][0].islower():
            places[_key(_flat(bare[i]))].append(i)
    sure = ("furniture", "bare", "date")
    edge = lambda i: "\x0c" in lines[i] or i and out[i - 1] in sure or i + 1 < len(out) and out[i + 1] in sure
    regular: dict[int, list[int]] = {}
    for at in places.values():
        if len(at) < 2 or not _HEADER.fullmatch(bare[at[0]]) or sum(map(str.isalpha, bare[at[0]])) < 4:
            continue
        edges = [i for i in at if edge(i)]
        if len(edges) > 1:
            for i in edges:
                out[i] = "furniture"
        gaps = [b - a for a, b in zip(at, at[1:])]
        if len(at) > 2 and min(gaps) > 4 and max(gaps) <= 3 * min(gaps):
            regular |= dict.fromkeys(at, at)
    if not regular:
        return
    width = sorted(len(bare[i]) for i in filled if out[i] == "text")
    width = width[len(width) // 2] if width else 0

    def beside(i: int, step: int) -> str:
        while 0 <= (i := i + step) < len(bare) and (i in regular or not bare[i] or out[i] in sure):
            pass
        return bare[i].split()[0 if step > 0 else -1] if 0 <= i < len(bare) else ""

    long_runs = {i for i in regular if all(i + k in regular for k in range(-1, 3)) or all(i + k in regular for k in range(-2, 2)) or all(i + k in regular for k in range(4)) or all(i - k in regular for k in range(4))}
    for i, at in regular.items():
        if out[i] == "text" and i not in long_runs:
            changes = len(at) > 3 and all(3 * len({beside(j, step) for j in at}) > 2 * len(at) for step in (-1, 1))
            if changes or len(bare[i]) < 0.75 * width and " " in bare[i]:
                out[i] = "furniture"


def _is_wrapped(lengths: list[int]) -> bool:
    """Whether most of the text stands in lines of a page's width; single wide rows or merged paragraphs don't count."""
    return max(lengths) < WIDE or 2 * sum(x for x in lengths if x >= WIDE) < sum(lengths)


def _at_edge(lines: list[str], out: list[str], i: int) -> bool:
    """Whether a line may stand at the edge of a page: at a form feed, or beside something that isn't running text."""
    beside = [out[j] if 0 <= j < len(out) else "blank" for j in (i - 1, i + 1)]
    return lines[i][:1] == "\x0c" or any(k in ("blank", "furniture", "bare", "date") for k in beside)


def _near(line: str, head: str) -> bool:
    """Whether two lines are the same but for a few misread characters."""
    if abs(len(line) - len(head)) > 3:
        return False
    return _same(line, head) or sum(map(eq, line, head)) >= 0.8 * len(head) or sum(map(eq, line[::-1], head[::-1])) >= 0.8 * len(head) or _alike(line, head)


def _key(line: str) -> str:
    return re.sub(r"\d+", "0", line).casefold()


def _numbers(lines: list[str], bare: list[str], out: list[str], wrapped: bool) -> None:
    """Lines with a bare number or a date: of the page, or of a table or text.

    A number that could be a year, stands amid the text and counts no pages is
    text.
    """
    n = len(bare)
    ends = [i for i in range(n) if bare[i]]
    ends = {ends[0], ends[-1]}

    def counts_pages(i: int, value: int) -> bool:
        near = [next((j for j in range(i + step, n if step > 0 else -1, step) if out[j] != "blank"), None) for step in (-1, 1)]
        return i in ends or "\x0c" in lines[i] or any(j is not None and ("\x0c" in lines[j] or out[j] in ("furniture", "date")) for j in near) or any(v in (value - 1, value + 1) for j, v in sure if j != i)

    def beside(i: int, step: int) -> str:
        j = i + step
        return out[j] if 0 <= j < n else "edge"

    sure: list[tuple[int, int]] = []
    open_: list[int] = []
    for i in range(n):
        if out[i] == "date":
            out[i] = "furniture" if wrapped or beside(i, -1) in ("blank", "edge", "furniture") else "text"
        if out[i] != "bare":
            continue
        before = beside(i, -1)
        if not bare[i].isdigit():
            out[i] = "furniture" if wrapped else "text"
        elif before in ("table", "number"):
            out[i] = "number"
            open_.append(i)
        elif wrapped:
            out[i] = "furniture"
            sure.append((i, int(bare[i])))
        else:
            out[i] = "number"
    for i, value in sure if wrapped else ():
        if 1500 <= value <= 2100 and not counts_pages(i, value):
            out[i] = "text"
    sure = [(i, v) for i, v in sure if out[i] == "furniture"]
    for i in open_:
        value = int(bare[i])
        last = next((v for j, v in reversed(sure) if j < i), None)
        following = next((v for j, v in sure if j > i), None)
        if wrapped and (last is not None and value == last + 1 and following != value or last is None and following is not None and value == following - 1):
            out[i] = "furniture"
            sure = sorted([*sure, (i, value)])


def words_of(line: str) -> list[str]:
    """The words of a line that hold a Latin letter, with signs that may stand for letters inside them."""
    return [w.rstrip("_'’") if w[-1] in "_'’" else w for w in _WORD.findall(line) if "a" <= w[0] <= "z" or _LETTER.search(w)]


def running_words(text: str, *titles: str | None) -> tuple[list[str], list[tuple[int, list[str]]], list[tuple[int, str, str, str, int]]]:
    """Classes of the lines, the words of each line of running text, and words broken at line ends.

    A word broken across lines is no word of either line but a break: (line,
    left part, sign, right part, next line).
    """
    classes = classes_of(text, *titles)
    lines = text.split("\n")
    running = [i for i, c in enumerate(classes) if c in ("text", "heading")]
    words: list[tuple[int, list[str]]] = []
    breaks: list[tuple[int, str, str, str, int]] = []
    carried = False
    for k, i in enumerate(running):
        line = lines[i].strip(_BLANKS)
        found = words_of(line)
        if carried and found:
            found.pop(0)
        carried = False
        if line[-1:] in BREAKS and len(line) > 2 and k + 1 < len(running) and (line[-2].isalnum() or line[-2] in "!|"):
            j = running[k + 1]
            gap = classes[i + 1 : j]
            right = _WORD.match(lines[j].strip(_BLANKS))
            left = re.search(r"[^\W_][\w!|'’]*(?:-[\w!|'’]+)*$|[!|][\w!|]+$", line[:-1])
            if right and left and _LETTER.search(left[0]) and ("furniture" in gap or not gap):
                breaks.append((i, left[0], line[-1], right[0].strip("_'’"), j))
                carried = True
                if found:
                    found.pop()
        if found:
            words.append((i, found))
    return classes, words, breaks


# What recognition makes of letters, as (true, seen).
CONFUSIONS = (
    ("e", "c"), ("c", "e"), ("t", "f"), ("f", "i"), ("h", "b"), ("y", "v"), ("i", "!"), ("i", "1"), ("l", "1"), ("l", "!"), ("l", "|"),
    ("i", "|"), ("i", "l"), ("o", "0"), ("s", "5"), ("b", "6"), ("é", "6"), ("g", "9"), ("g", "q"), ("q", "g"), ("z", "2"), ("m", "rn"), ("rn", "m"), ("n", "ri"), ("ri", "n"),
    ("h", "li"), ("li", "h"), ("in", "m"), ("m", "in"), ("w", "vv"), ("vv", "w"), ("tt", "H"), ("d", "cl"), ("cl", "d"), ("u", "ii"), ("n", "ii"), ("ll", "U"),
    ("O", "0"), ("S", "5"), ("B", "8"), ("G", "6"), ("Z", "2"), ("I", "l"), ("I", "1"), ("I", "|"), ("I", "!"), ("T", "7"), ("E", "F"), ("fi", "h"), ("a", "@"), ("k", "lc"), ("D", "O"), ("Q", "O"),
    ("ü", "ii"), ("ä", "a"), ("ö", "o"), ("ü", "u"), ("é", "e"), ("è", "e"), ("ê", "e"), ("á", "a"), ("à", "a"), ("ã", "a"), ("í", "i"), ("ó", "o"), ("õ", "o"), ("ú", "u"), ("ç", "c"), ("ñ", "n"), ("ß", "B"),
)
#: Anagram hashes are sums of fifth powers modulo this prime, so that two of them add up within 64 bits.
MODULUS = (1 << 61) - 1
#: A word is frequent from so many occurrences on, and so many times those of the rare word.
FREQUENT, TIMES = 8, 10
#: How much more often than its confusions on average a word may be misread, and places without a misreading that are added to those of each confusion.
EXCESS, PRIOR = 3.0, 2000.0
#: The vocabulary files whose whole words are words.
LEXICON = ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model", "word_bpe_49k.json")
#: So many of the most frequent words are known to every task, to leave out at once what can't be a misreading.
KNOWN = 50_000


def anagram_hash(word: str) -> int:
    return sum(pow(ord(c), 5, MODULUS) for c in word) % MODULUS


#: A letter per class of line.
CODES = {"blank": "b", "furniture": "f", "table": "t", "number": "n", "heading": "h", "equation": "e", "code": "c", "text": "x"}
_CLASSES = {code: name for name, code in CODES.items()}
_BREAK = "struct<line_no int, left string, sign string, right string, next_no int>"
_READ = f"_id string, classes string, lines array<int>, words array<string>, breaks array<{_BREAK}>, word string, n long, hash long"


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per text its lines' classes, words by line and breaks; and the words of each batch with their counts, the map side of the vocabulary."""
    names = [x.split()[0] for x in ("_id", "classes", "lines", "words", "breaks", "word", "n", "hash")]
    for batch in batches:
        total: Counter[str] = Counter()
        out: list[tuple] = []
        for id_, title, abstract, text in zip(batch["_id"], batch["_title"], batch["_abstract"], batch["_text"]):
            if abstract:
                total.update(words_of(abstract))
            if text is not None:
                classes, words, breaks = running_words(text, title, abstract)
                total.update([w for _, found in words for w in found])
                torn = [{"line_no": i + 1, "left": left, "sign": sign, "right": right, "next_no": j + 1} for i, left, sign, right, j in breaks]
                out.append((id_, "".join([CODES[c] for c in classes]), [i + 1 for i, _ in words], [" ".join(found) for _, found in words], torn, None, None, None))
        out += [(None, None, None, None, None, w, n, anagram_hash(w)) for w, n in total.items()]
        yield pd.DataFrame(out, columns=names).astype({"n": "Int64", "hash": "Int64"})


def _columns(df: DataFrame, title: str, abstract: str) -> list[Column]:
    return [(F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(a) for c, a in ((title, "_title"), (abstract, "_abstract"))]


def read_texts(df: DataFrame, id_col: str = "record_id", text: str = "full_text", title: str = "title", abstract: str = "abstract") -> DataFrame:
    """What is read of each text, in one pass, written once: rows of texts (_id, classes, lines, words, breaks) and rows of counted words (word, n, hash)."""
    rows = df.select(F.col(id_col).cast("string").alias("_id"), *_columns(df, title, abstract), F.col(text).alias("_text"))
    return cut(rows.mapInPandas(_read, _READ))


def vocabulary(read: DataFrame) -> DataFrame:
    """(word, n, hash) over the running text and the abstracts of all rows."""
    counts = read.where(F.col("word").isNotNull())
    return counts.groupBy("word").agg(F.sum("n").alias("n"), F.max("hash").alias("hash"))


def _confusions() -> Column:
    """The confusions as an array of structs, each with the difference it makes to the anagram hash."""
    return F.array(*[
        F.struct(F.lit(rank).alias("rank"), F.lit(true).alias("true"), F.lit(seen).alias("seen"), F.lit((anagram_hash(true) - anagram_hash(seen)) % MODULUS).cast("long").alias("shift"))
        for rank, (true, seen) in enumerate(CONFUSIONS)
    ])


@functools.lru_cache(maxsize=4)
def lexicon(files: tuple[str, ...]) -> tuple[str, ...]:
    """The words of three letters or more that are whole pieces of public vocabularies, in lower case."""
    words: set[str] = set()
    for path in files:
        if path.endswith(".tiktoken"):
            with open(path, "rb") as lines:
                pieces = [base64.b64decode(line.split()[0]).decode("utf-8", "ignore") for line in lines]
            words.update(p[1:] for p in pieces if p[:1] == " ")
        elif path.endswith(".json"):
            with open(path, "rb") as content:
                pieces = json.load(content)["model"]["vocab"]
            words.update(p[:-4] if p.endswith("</w>") else p[1:] for p in pieces if p.endswith("</w>") or p[:1] == "Ġ")
        else:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            words.update(p[1:] for p in map(model.id_to_piece, range(model.get_piece_size())) if p[:1] == "▁")
    return tuple(sorted({w.lower() for w in words if len(w) > 2 and w.isalpha()}))


def _occurrences(word: Column, part: Column) -> Column:
    return (F.length(word) - F.length(F.replace(word, part, F.lit("")))) / F.length(part)


def corrections(vocab: DataFrame, frequent: int = FREQUENT, times: int = TIMES, words: Sequence[str] = ()) -> DataFrame:
    """(word, correction, place, width): rare words that are misreadings of frequent ones.

    A rare word is joined with the frequent words whose anagram hash differs from
    its own by the difference of a confusion whose seen form it holds; carrying
    the confusion out verifies a candidate.  Candidates are ranked by frequency;
    place is where the misread characters begin, counted from 0, width how many.

    How often a confusion happens is the share of its places in frequent words
    where it was seen, words that a public vocabulary has left aside.  That gives
    how many misreadings of a frequent word to expect.  A candidate that occurs
    more often than EXCESS times that and three standard deviations is a word of
    its own; one that isn't in `words` may occur three times more.
    """
    spark = vocab.sparkSession
    rare = vocab.where((F.length("word") > 2) & F.col("word").rlike(r"\p{Ll}|[!|]") & ~F.col("word").rlike(r"^(.)\1*$") & ~F.col("word").rlike(r"^\p{Lu}{1,3}-?\d+$"))
    tried = rare.select("word", "n", "hash", F.explode(F.filter(_confusions(), lambda c: F.contains(F.col("word"), c["seen"]))).alias("c"))
    tried = tried.select("word", F.col("n").alias("_n"), "c", F.pmod(F.col("hash") + F.col("c.shift"), F.lit(MODULUS)).alias("hash"))
    known = vocab.where((F.col("n") >= frequent) & ~F.col("word").rlike(r"[!|]")).select(F.col("word").alias("correction"), F.col("n").alias("_m"), "hash")
    seen, true, word = F.col("c.seen"), F.col("c.true"), F.col("word")
    places = F.filter(
        F.sequence(F.lit(1), F.length(word) - F.length(seen) + 1),
        lambda p: F.concat(F.substring(word, F.lit(1), p - 1), true, F.substring(word, p + F.length(seen), F.length(word))) == F.col("correction"),
    )
    # A join condition on the confusion's seen form keeps the candidates few.
    pairs = tried.join(known, "hash").where(F.col("_m") >= times * F.col("_n")).withColumn("_places", F.filter(places, lambda p: F.substring(word, p, F.length(seen)) == seen))
    best = F.max_by(
        F.struct("correction", (F.col("_places")[0] - 1).alias("place"), F.length(seen).alias("width"), F.col("c.rank").alias("rank"), "_m", "_n"),
        F.struct(F.col("_m"), -F.col("c.rank"), F.col("correction")),
    )
    found = pairs.where(F.size("_places") > 0).groupBy("word").agg(best.alias("_b")).select("word", "_b.*")
    listed = F.broadcast(spark.createDataFrame([(w,) for w in words] or [(None,)], "_w string"))  # as many words as the vocabulary files have
    found = cut(found.join(listed, F.lower("word") == F.col("_w"), "left").withColumn("_own", F.col("_w").isNotNull()).drop("_w"))
    chances = known.select("_m", "correction", F.explode(F.filter(_confusions(), lambda c: F.contains(F.col("correction"), c["true"]))).alias("c"))
    chances = chances.groupBy(F.col("c.rank").alias("rank")).agg(F.sum(F.col("_m") * _occurrences(F.col("correction"), F.col("c.true"))).alias("_of"))
    happened = found.where(~F.col("_own")).groupBy("rank").agg(F.sum("_n").alias("_did"))
    rates = chances.join(happened, "rank", "left").select("rank", ((F.coalesce("_did", F.lit(0)) + 1) / (F.col("_of") + PRIOR)).alias("_rate"))
    expected = F.col("_m") * F.col("_rate")
    most = EXCESS * expected + 3 * F.sqrt(expected) + F.when(F.col("_own"), 0).otherwise(3)
    return found.join(F.broadcast(rates), "rank").where(F.col("_n") <= most).select("word", "correction", "place", "width")  # a rate per confusion


def noise_marks(df: DataFrame, id_col: str = "record_id", text: str = "full_text", title: str = "title", abstract: str = "abstract", tokenizers: str = TOKENIZERS, files: Sequence[str] = LEXICON) -> DataFrame:
    """(_id, line_no, next_no, noise, word, left, right, correction): every mark of noise, with what repairs it.

    noise is furniture, hyphen or misread, or classes: the classes of all lines
    of a document, a letter each.  Texts are read once.  The most frequent words,
    a number bounded by KNOWN and never one with a correction, are taken out of
    their words first, so that only what is left reaches the join with the
    corrections.
    """
    read = read_texts(df, id_col, text, title, abstract)
    vocab = cut(vocabulary(read))
    fixes = cut(corrections(vocab, words=lexicon(tuple(f"{tokenizers}/{f}" for f in files))))
    known = vocab.join(fixes, "word", "left_anti").orderBy(F.desc("n"), "word").limit(KNOWN).where(F.col("n") > 1).select("word")
    texts = read.where(F.col("classes").isNotNull())
    none, nothing = F.lit(None).cast("string"), F.lit(None).cast("int")

    def mark(rows: DataFrame, noise: str, line: Column, after: Column = nothing, word: Column = none, left: Column = none, right: Column = none, correction: Column = none) -> DataFrame:
        return rows.select("_id", line.cast("int").alias("line_no"), after.alias("next_no"), F.lit(noise).alias("noise"), word.alias("word"), left.alias("left"), right.alias("right"), correction.alias("correction"))

    classes = mark(texts, "classes", F.lit(0), word=F.col("classes"))
    at = F.filter(F.sequence(F.lit(1), F.length("classes")), lambda i: F.substring("classes", i, 1) == CODES["furniture"])
    furniture = mark(texts.select("_id", F.explode(at).alias("_i")), "furniture", F.col("_i"))
    lines = texts.select("_id", F.explode(F.arrays_zip("lines", "words")).alias("_l"))
    words = lines.select("_id", F.col("_l.lines").alias("_i"), F.explode(F.split("_l.words", " ")).alias("word"))
    rare = words.join(F.broadcast(known), "word", "left_anti")  # KNOWN words at most
    misread = mark(rare.join(fixes, "word"), "misread", F.col("_i"), word=F.col("word"), correction=F.col("correction"))
    breaks = cut(texts.select("_id", F.explode("breaks").alias("_b")).select("_id", "_b.*").withColumn("word", F.concat("left", "right")))
    # A misread character before the cut lies in the first line.
    where = F.when(F.col("place") < F.length("left"), F.col("line_no")).otherwise(F.col("next_no"))
    torn = mark(breaks.join(fixes, "word"), "misread", where, F.col("next_no"), F.col("word"), F.col("left"), F.col("right"), F.col("correction"))
    forms = breaks.select("left", "right").distinct()
    judged = forms
    for name, form in (("_joined", F.concat("left", "right")), ("_hyphened", F.concat("left", F.lit("-"), "right")), ("_l", F.col("left")), ("_r", F.col("right"))):
        judged = judged.join(vocab.select(F.col("word").alias(name + "w"), F.col("n").alias(name)), form == F.col(name + "w"), "left").drop(name + "w")
    judged = judged.fillna(0, ["_joined", "_hyphened", "_l", "_r"])
    judged = judged.join(fixes.select(F.col("word").alias("_fixed")), F.concat("left", "right") == F.col("_fixed"), "left")
    joined = F.col("_joined") + F.when(F.col("_fixed").isNotNull(), F.lit(FREQUENT)).otherwise(F.lit(0))
    whole = F.col("right").rlike(r"^[\p{Lu}\p{N}]") | (F.col("_l") >= FREQUENT) & (F.col("_r") >= FREQUENT)
    broken = F.when((joined == 0) & (F.col("_hyphened") == 0), ~whole).otherwise(joined > F.col("_hyphened"))
    hyphen = mark(breaks.join(judged.where(broken).select("left", "right"), ["left", "right"]), "hyphen", F.col("line_no"), F.col("next_no"), F.col("word"), F.col("left"), F.col("right"))
    return classes.unionByName(furniture).unionByName(misread).unionByName(torn).unionByName(hyphen)


def noisy_lines(df: DataFrame, id_col: str = "record_id", text: str = "full_text", title: str = "title", abstract: str = "abstract") -> DataFrame:
    """(<id>, line_no, noise): each noisy line of the text, once per noise in it.

    Null and blank texts have none.  Rows that repeat an id give its lines once.
    Without a title or abstract column, these are taken to be null.
    """
    marks = noise_marks(df, id_col, text, title, abstract).where(F.col("noise") != "classes")
    return marks.select(F.col("_id").alias(id_col), "line_no", "noise").distinct()


def repaired(text: str, marks: list, *titles: str | None) -> str:
    """The running text in continuous paragraphs, without what the marks name.

    marks are (line_no, next_no, noise, word, left, right, correction); without
    one of the lines' classes these are found anew.  Headings, tables, equations
    and code keep their lines.
    """
    lines = [x.strip("\r\x0c") for x in text.split("\n")]
    codes = next((m[3] for m in marks if m[2] == "classes" and len(m[3]) == len(lines)), None)
    classes = [_CLASSES[c] for c in codes] if codes is not None else classes_of(text, *titles)
    marks = [m for m in marks if m[2] != "classes"]
    broken: set[int] = set()
    for line, after, noise, word, left, right, correction in marks:
        if noise == "furniture":
            classes[line - 1] = "furniture"
        elif noise == "hyphen":
            broken.add(line - 1)
        elif left is None:
            lines[line - 1] = re.sub(rf"(?<!\w){re.escape(word)}(?!\w)", lambda _: correction, lines[line - 1])
    for line, after, noise, word, left, right, correction in marks:
        if noise == "misread" and left is not None:
            # The word is broken over two lines; the cut stays where the left part ends.
            a = next((k for k in (line - 1, line - 2, *range(line - 3, -1, -1)) if lines[k].rstrip(_BLANKS)[:-1].endswith(left)), None)
            if a is None or after is None:
                continue
            cut_at = len(left) if word[: len(left)] == correction[: len(left)] else len(left) + len(correction) - len(word)
            lines[a] = lines[a].rstrip(_BLANKS)[: -1 - len(left)] + correction[:cut_at] + lines[a].rstrip(_BLANKS)[-1]
            lines[after - 1] = lines[after - 1].replace(right, correction[cut_at:], 1)
    out: list[str] = []
    paragraph = ""
    gap, previous, torn = True, "", False
    for i, line in enumerate(lines):
        kind = classes[i]
        if kind == "furniture":
            continue
        if kind == "blank":
            near = (i and classes[i - 1] == "furniture") or (i + 1 < len(lines) and classes[i + 1] == "furniture")
            gap = gap or not near or paragraph.endswith((".", "!", "?", ":", "。"))
            continue
        body = " ".join(line.split()) if kind in ("text", "heading") else line.strip(_BLANKS)
        if kind == "text" and previous == "text" and (torn or not (gap or line.startswith("  "))):
            if torn:
                paragraph = paragraph[:-1] + body if i and torn == 1 else paragraph + body
            else:
                paragraph += " " + body
        else:
            if paragraph:
                tight = previous == kind and kind in ("table", "number", "code")
                if tight:
                    paragraph += "\n" + body
                    gap, previous, torn = False, kind, 0
                    continue
                out.append(paragraph)
            paragraph = body
        torn = 1 if i in broken else 2 if kind == "text" and body[-1:] == "-" and len(body) > 1 and body[-2].isalpha() else 0
        gap, previous = False, kind
    if paragraph:
        out.append(paragraph)
    return "\n\n".join(out)


def repair(df: DataFrame, id_col: str = "record_id", text: str = "full_text", title: str = "title", abstract: str = "abstract") -> DataFrame:
    """(<id>, text): the repaired text of every row; null stays null, and rows with a null id are repaired by shape alone.

    The marks of one document are gathered at its row, at most some per line of
    it.  Rows that repeat an id share their marks, so ids should be unique.
    """
    parts = ("line_no", "next_no", "noise", "word", "left", "right", "correction")
    marks = noise_marks(df, id_col, text, title, abstract).distinct().groupBy("_id").agg(F.sort_array(F.collect_list(F.struct(*parts))).alias("_marks"))
    rows = df.select(F.col(id_col), F.col(id_col).cast("string").alias("_id"), *_columns(df, title, abstract), F.col(text).alias("_text"))

    @F.pandas_udf(T.StringType())
    def mend(texts: pd.Series, found: pd.Series, heads: pd.Series, bodies: pd.Series) -> pd.Series:
        return pd.Series([
            None if t is None else repaired(t, [tuple(m[p] for p in parts) for m in (ms if ms is not None else [])], h, b)
            for t, ms, h, b in zip(texts, found, heads, bodies)
        ])

    return rows.join(marks, "_id", "left").select(id_col, mend("_text", "_marks", "_title", "_abstract").alias("text"))
