"""The language of documents and of the segments of mixed ones, with a confidence.

The score of a word in a language is its probability under a unigram model of
pieces, summed over all its segmentations into pieces of a fixed public
vocabulary by the forward algorithm.  The piece probabilities of each language
are fitted by expectation-maximisation on a bounded sample of labelled rows; as
labels are partly wrong and texts partly mixed, the fit is repeated on the
sentences that the first model assigns to each language.  The table of
probabilities has one row per piece and is all that reaches the tasks.  How
confident a score makes is fitted on labelled rows that were held out.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.llm.common import TOKENIZERS

#: The model is fitted on so many documents of each label at most, taken by a hash of their id.
SAMPLE_PER_LANGUAGE = 400
#: Only documents of at most so many characters are taken to learn from, which bounds what the driver holds.
SAMPLE_LENGTH = 20_000
#: Weight, in pieces, of the average over all languages within each one's probabilities.
PRIOR = 2000.0
#: A sentence has a language of its own from so many letters and words on (of scripts without spaces, letters alone) ...
LETTERS, WORDS, WIDE_LETTERS = 18, 4, 8
#: ... and so many nats ahead of the second language, and so many per letter.
MARGIN, MARGIN_PER_LETTER = 6.0, 0.08
#: Each so many-th sampled document isn't learnt from, but tells how far scores are to be trusted.
HELD_OUT = 10
#: Without held-out sentences, scores are divided by this before they are made a confidence, as words aren't independent.
TEMPERATURE = 3.0

# What a full stop after doesn't end a sentence.
ABBREVIATIONS = frozenset("al fig figs vol sec eq eqs tab no nos dr prof vs cf ca approx resp ref refs p pp ed eds st bzw vgl abb tabl fig gl núm etc".split())

_WIDE = "぀-ヿ㐀-鿿豈-﫿가-힯ᄀ-ᇿ"
_WORDS = re.compile(rf"[぀-ヿ㐀-鿿豈-﫿ー]+|[가-힯ᄀ-ᇿ]+|[^\W\d_{_WIDE}]+(?:['’][^\W\d_{_WIDE}]+)*")
_WIDE_CHAR = re.compile(rf"[{_WIDE}]")
_END = re.compile(r"(?<=[.!?])[\"'”’»)\]]*\s+(?=[\"'“„«‘(\[]*[^\W\d_a-zß-ÿ])|(?<=[。！？])\s*(?=\S)")


_QUOTED = re.compile(r"[„“«‚‘「『\"][^„“”«»‚‘’「」『』\"]+[“”»’」』\"]")
_BRACKETS = re.compile(r"\([^()]*\)")
_YEAR_END = re.compile(r"\d{4}[a-z]?\)$")


def words_of(text: str) -> list[str]:
    """The words of a sentence; quoted words and titles and references in parentheses aren't in its language."""
    bare = _BRACKETS.sub(lambda m: " " if _YEAR_END.search(m[0]) else m[0], _QUOTED.sub(" ", text))
    return [w.lower() for w in _WORDS.findall(bare if _WORDS.search(bare) else text)]


def spans_of(paragraph: str) -> list[tuple[int, int]]:
    """Where sentences start and end, without white space around them; a full stop after an abbreviation doesn't end one."""
    cuts, start = [], 0
    for match in _END.finditer(paragraph):
        before = re.search(r"([^\W\d_]+)\.$", paragraph[start : match.start() + 1].rstrip())
        if before and before[1].lower() in ABBREVIATIONS:
            continue
        cuts.append((start, match.end()))
        start = match.end()
    cuts.append((start, len(paragraph)))
    out = []
    for a, b in cuts:
        part = paragraph[a:b]
        if part.strip():
            out.append((a + len(part) - len(part.lstrip()), a + len(part.rstrip())))
    return out


def sentences_of(paragraph: str) -> list[str]:
    """Sentences in order."""
    return [paragraph[a:b] for a, b in spans_of(paragraph)]


class Pieces:
    """The vocabulary: which pieces there are, and how a character outside of it falls back to bytes."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.index: dict[str, int] = {}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        for i in range(model.get_piece_size()):
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)):
                self.index[model.id_to_piece(i)] = i
        self.size = model.get_piece_size()
        self.longest = max(map(len, self.index))

    def edges(self, word: str) -> list[list[tuple[int, tuple[int, ...]]]]:
        """Per end position of a word the (start, pieces) that lead there: a piece, or the bytes of a character that is none."""
        text = word if _WIDE_CHAR.match(word) else "▁" + word
        get, longest, out = self.index.get, min(self.longest, 16), [[]]
        for end in range(1, len(text) + 1):
            here = []
            for start in range(max(0, end - longest), end):
                piece = get(text[start:end])
                if piece is not None:
                    here.append((start, (piece,)))
            if not here or here[-1][0] != end - 1:
                here.append((end - 1, tuple(self.bytes[b] for b in text[end - 1].encode("utf-8", "replace"))))
            out.append(here)
        return out


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def forward(edges: list, table: np.ndarray) -> np.ndarray:
    """Log-probability of a word in each language, over all segmentations; table: pieces x languages."""
    alpha, offset = [np.ones(table.shape[1])], 0.0
    for here in edges[1:]:
        total = 0.0
        for start, ids in here:
            p = table[ids[0]] if len(ids) == 1 else np.prod(table[list(ids)], axis=0)
            total = total + alpha[start] * p
        alpha.append(total)
        if total.max() < 1e-150:
            alpha = [a * 1e150 for a in alpha]
            offset -= 150 * math.log(10)
    return np.log(np.maximum(alpha[-1], 1e-300)) + offset


def expected(edges: list, p: np.ndarray, weight: float, into: np.ndarray) -> None:
    """Adds the expected number of uses of each piece in a word, times weight; p: probabilities of one language."""
    n = len(edges)
    value = [[math.prod(p[i] for i in ids) for _, ids in here] for here in edges]
    a = [1.0] + [0.0] * (n - 1)
    for end in range(1, n):
        a[end] = sum(a[start] * v for (start, _), v in zip(edges[end], value[end]))
    if not a[-1] > 1e-280:
        # Too long for one number: its most likely pieces are counted as they stand.
        for here in edges[1:]:
            for i in here[-1][1]:
                into[i] += weight
        return
    b = [0.0] * n
    b[-1] = 1.0
    for end in range(n - 1, 0, -1):
        for (start, ids), v in zip(edges[end], value[end]):
            share = v * b[end]
            b[start] += share
            use = weight * a[start] * share / a[-1]
            for i in ids:
                into[i] += use


class Model:
    """Piece probabilities of each language; scores words, with a cache."""

    def __init__(self, langs: list[str], table: np.ndarray, path: str) -> None:
        self.langs, self.table, self.path, self.temperature = langs, table, path, TEMPERATURE
        self.cache: dict[str, np.ndarray] = {}

    def __getstate__(self) -> tuple:
        return self.langs, self.table.astype("float32"), self.path, self.temperature

    def __setstate__(self, state: tuple) -> None:
        self.langs, table, self.path, self.temperature = state
        self.table, self.cache = table.astype("float64"), {}

    def word(self, word: str) -> np.ndarray:
        score = self.cache.get(word)
        if score is None:
            if len(self.cache) > 200_000:
                self.cache.clear()
            score = self.cache[word] = forward(pieces(self.path).edges(word), self.table)
        return score

    def score(self, words: list[str]) -> np.ndarray:
        return np.sum([self.word(w) for w in words], axis=0) if words else np.zeros(len(self.langs))

    def confidence(self, score: np.ndarray, letters: int) -> np.ndarray:
        """Probabilities of the languages, softened by the length of the text."""
        x = (score - score.max()) / (self.temperature * max(1.0, math.sqrt(letters / 20)))
        e = np.exp(x)
        return e / e.sum()


def fit(samples: dict[str, list[str]], path: str, rounds: int = 2, steps: int = 2) -> Model:
    """A model from texts by (partly wrong) language; the sentences are assigned anew between rounds."""
    voc, langs = pieces(path), sorted(samples)
    edges_of = functools.lru_cache(maxsize=None)(voc.edges)
    texts = [(lang, s) for lang in langs for t in samples[lang] for para in t.split("\n\n") for s in sentences_of(para)]
    owned = [(lang, words_of(s)) for lang, s in texts]
    table = np.full((voc.size, len(langs)), 1e-4)
    for again in range(rounds):
        counts = {lang: Counter() for lang in langs}
        for lang, words in owned:
            if lang is not None:
                counts[lang].update(words)
        for step in range(steps):
            raw = np.zeros((voc.size, len(langs)))
            for k, lang in enumerate(langs):
                column, p = np.zeros(voc.size), table[:, k].tolist()
                for word, n in counts[lang].items():
                    expected(edges_of(word), p, float(n), column)
                raw[:, k] = column
            share = raw / np.maximum(raw.sum(axis=0), 1.0)
            base = share.mean(axis=1) + 1e-7
            base /= base.sum()
            table = (raw + PRIOR * base[:, None]) / (raw.sum(axis=0) + PRIOR)
        if again + 1 < rounds:
            model = Model(langs, table, path)
            anew = []
            for (lang, words) in owned:
                s = model.score(words)
                order = np.sort(s)
                letters = sum(map(len, words))
                anew.append((langs[int(s.argmax())] if letters >= LETTERS and len(order) > 1 and order[-1] - order[-2] > MARGIN else None if letters >= LETTERS else lang, words))
            owned = anew
    return Model(langs, table, path)


def _is_whole(sentence: str, words: list[str], letters: int) -> bool:
    """Whether a sentence ends like one and is long enough to have a language of its own."""
    wide = sum(len(w) for w in words if _WIDE_CHAR.match(w))
    return sentence.rstrip("\"'”’»)]0123456789 ").endswith((".", "!", "?", "。", "！", "？", "[")) and (letters >= LETTERS and len(words) >= WORDS or wide >= WIDE_LETTERS)


def held_out_scores(model: Model, held: dict[str, list[str]]) -> list[tuple[int, np.ndarray, int]]:
    """(label, score, letters) of the whole sentences of labelled texts the model hasn't seen."""
    out = []
    for lang in sorted(held):
        for text in held[lang]:
            for paragraph in text.split("\n\n"):
                for sentence in sentences_of(paragraph):
                    words = words_of(sentence)
                    letters = sum(map(len, words))
                    if lang in model.langs and _is_whole(sentence, words, letters):
                        out.append((model.langs.index(lang), model.score(words), letters))
    return out


def calibrate(model: Model, held: dict[str, list[str]]) -> float:
    """Sets the model's temperature to the one that makes the labels of held-out sentences likeliest; gives the share of labels taken to be wrong.

    A label is that of its document, which may be wrong or mixed; it is taken to
    be any language with some probability, which is fitted too.
    """
    scored = held_out_scores(model, held)
    if not scored or len(model.langs) < 2:
        return 0.0
    best = (-math.inf, model.temperature, 0.0)
    for temperature in np.geomspace(0.25, 32.0, 29):
        model.temperature = float(temperature)
        p = np.array([model.confidence(score, letters)[label] for label, score, letters in scored])
        for wrong in np.geomspace(0.001, 0.5, 25):
            likely = float(np.log((1 - wrong) * p + wrong / len(model.langs)).sum())
            if likely > best[0]:
                best = (likely, float(temperature), float(wrong))
    model.temperature = best[1]
    return best[2]


def calibration_error(model: Model, held: dict[str, list[str]], wrong: float = 0.0, bins: int = 10) -> float:
    """The mean distance between how often the label of a held-out sentence is the language found and how often it should be, over bins of confidence.

    It should be with the confidence, but for the share of wrong labels.
    """
    sums = defaultdict(lambda: [0.0, 0])
    scored = held_out_scores(model, held)
    for label, score, letters in scored:
        sure = model.confidence(score, letters)
        entry = sums[min(bins - 1, int(sure.max() * bins))]
        entry[0], entry[1] = entry[0] + (1 - wrong) * float(sure.max()) + wrong / len(model.langs), entry[1] + (int(sure.argmax()) == label)
    return sum(abs(expected - right) for expected, right in sums.values()) / max(1, len(scored))


def training_sample(df: DataFrame, labels: dict[str, str], text: str, label: str, id_col: str, per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, list[str]]:
    """Texts by language, at most per_language of each: first the labels are counted, then a share of each is taken by a hash of the id."""
    named = df.where(F.col(text).rlike(r"\S") & (F.length(text) <= SAMPLE_LENGTH)).select(F.col(id_col).cast("string").alias("_id"), F.col(label).alias("_label"), F.col(text).alias("_text"))
    mapping = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    named = named.withColumn("_lang", F.try_element_at(mapping, F.col("_label"))).where(F.col("_lang").isNotNull())
    counts = {r["_lang"]: r["count"] for r in named.groupBy("_lang").count().collect()}
    place = F.pmod(F.xxhash64("_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.2 * per_language / n + 1e-9))]) if counts else F.lit(None)
    out: dict[str, list[str]] = {lang: [] for lang in sorted(set(labels.values()))}
    if counts:
        rows = named.where(place < F.element_at(share, F.col("_lang"))).select("_lang", place.alias("_place"), "_text").collect()
        for r in sorted(rows, key=lambda r: (r["_place"], r["_text"])):
            if len(out[r["_lang"]]) < per_language:
                out[r["_lang"]].append(r["_text"])
    return {k: v for k, v in out.items() if v}


class Segment(NamedTuple):
    """A stretch of one language within a paragraph: from `start` to before `end` in the text; whole tells whether it has a whole sentence that is surely in it."""

    para_no: int
    start: int
    end: int
    lang: str
    letters: int
    confidence: float
    whole: bool


def segments_of(text: str, model: Model) -> tuple[list[Segment], str | None, float]:
    """(segments, language, confidence) of a text; paragraphs count from 1.

    Every sentence with a letter is in a segment; neighbours of one language are
    one.  A sentence is in the language of its highest score if that is ahead by
    a margin.  What isn't (headings, short or undecided sentences) takes the
    language of the sentence before it, or after it, in the text; only where no
    sentence is sure is everything scored together.  The language of the text is
    the one with most letters of sure sentences, its confidence the share of
    letters that are expected to be in it.
    """
    found: list[tuple[int, int, int, np.ndarray, int, int | None, bool]] = []
    offset = 0
    for no, para in enumerate(text.split("\n\n"), 1):
        for a, b in spans_of(para):
            sentence = para[a:b]
            words = words_of(sentence)
            letters = sum(map(len, words))
            if letters:
                score = model.score(words)
                order = np.sort(score)
                ahead = order[-1] - order[-2] if len(order) > 1 else math.inf
                far = ahead >= max(MARGIN, MARGIN_PER_LETTER * letters)
                whole = far and _is_whole(sentence, words, letters)
                found.append((no, offset + a, offset + b, score, letters, int(score.argmax()) if whole else None, whole))
        offset += len(para) + 2
    if not found:
        return [], None, 0.0
    sure = [k for *_, k, _ in found if k is not None]
    if not sure:
        # Nothing is sure by itself: the text is scored as it stands.
        best = int(sum(score for _, _, _, score, _, _, _ in found).argmax())
    else:
        weight = [sum(letters for _, _, _, _, letters, k, _ in found if k == x) for x in range(len(model.langs))]
        best = max(range(len(model.langs)), key=lambda x: (weight[x], model.langs[x]))
    last, given = None, []
    for *_, k, _ in found:
        last = k if k is not None else last
        given.append(last)
    first = sure[0] if sure else best
    given = [first if k is None else k for k in given]
    runs: list[list] = []
    for (no, start, end, score, letters, _, whole), k in zip(found, given):
        if runs and runs[-1][0] == no and runs[-1][1] == k:
            run = runs[-1]
            run[3], run[4], run[5], run[6] = end, run[4] + score, run[5] + letters, run[6] or whole
        else:
            runs.append([no, k, start, end, score, letters, whole])
    segments = [Segment(no, start, end, model.langs[k], letters, float(model.confidence(score, letters)[k]), whole or not sure) for no, k, start, end, score, letters, whole in runs]
    total = sum(s.letters for s in segments)
    return segments, model.langs[best], sum(s.letters * s.confidence for s in segments if s.lang == model.langs[best]) / total


_SEGMENT = T.StructType([
    T.StructField("para_no", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("lang", T.StringType()),
    T.StructField("letters", T.IntegerType()), T.StructField("confidence", T.DoubleType()), T.StructField("whole", T.BooleanType()),
])
_RESULT = T.StructType([T.StructField("segments", T.ArrayType(_SEGMENT)), T.StructField("lang", T.StringType()), T.StructField("confidence", T.DoubleType())])


def identifier(model: Model):
    """Pandas UDF text -> struct(segments, lang, confidence)."""

    @F.pandas_udf(_RESULT)
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            done = [([], None, None) if t is None or not t.strip() else segments_of(t, model) for t in texts]
            yield pd.DataFrame({"segments": [[s._asdict() for s in d[0]] for d in done], "lang": [d[1] for d in done], "confidence": [d[2] for d in done]})

    # Else a filter on what it finds is put before it, with a second evaluation of its own.
    return of.asNondeterministic()


def held_out(samples: dict[str, list[str]], every: int = HELD_OUT) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """(to learn from, to hold out): each `every`-th text of a language is held out."""
    learn = {lang: [t for i, t in enumerate(texts) if i % every != every - 1] for lang, texts in samples.items()}
    return learn, {lang: texts[every - 1 :: every] for lang, texts in samples.items()}


def label_table(lang_labels: DataFrame) -> dict[str, str]:
    """lang_labels as a dict; a small fixed table."""
    return {r["label"]: r["lang"] for r in lang_labels.where(F.col("label").isNotNull() & F.col("lang").isNotNull()).select("label", "lang").orderBy("label", "lang").collect()}


def identify(df: DataFrame, lang_labels: DataFrame, id_col: str = "record_id", text: str = "clean_text", label: str = "language", tokenizers: str = TOKENIZERS, vocabulary: str = "piece_bpe_32k.model", per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """(<id>, label, label_lang, segments, lang, confidence) of every row; segments as in segments_of.

    label_lang is what the label names by lang_labels, or null.  Null and blank
    texts have no segments and a null language.  Whole texts are read, in one
    Arrow pass without a shuffle.  All rows are kept, repeated ones too.  With no
    labelled row to learn from there are no languages: lang is null everywhere.
    """
    labels = label_table(lang_labels)
    samples = training_sample(df, labels, text, label, id_col, per_language) if labels else {}
    named = F.try_element_at(F.create_map(*[F.lit(x) for pair in labels.items() for x in pair]), F.col(label)) if labels else F.lit(None).cast("string")
    rows = df.select(F.col(id_col), F.col(label).alias("label"), named.alias("label_lang"), F.col(text).alias("_text"))
    if not samples:
        return rows.select(id_col, "label", "label_lang", F.array().cast(T.ArrayType(_SEGMENT)).alias("segments"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"))
    learn, held = held_out(samples)
    model = fit(learn, f"{tokenizers}/{vocabulary}")
    calibrate(model, held)
    return rows.withColumn("_r", identifier(model)("_text")).select(id_col, "label", "label_lang", "_r.segments", "_r.lang", "_r.confidence")


def language_segments(df: DataFrame, lang_labels: DataFrame, id_col: str = "record_id", text: str = "clean_text", label: str = "language", **options) -> DataFrame:
    """(<id>, para_no, start, end, lang, confidence, whole): the segments of every row, by their place in its text; rows without letters have none."""
    rows = identify(df, lang_labels, id_col, text, label, **options)
    return rows.select(id_col, F.explode("segments").alias("_s")).select(id_col, "_s.para_no", "_s.start", "_s.end", "_s.lang", "_s.confidence", "_s.whole")


def wrong_or_mixed(df: DataFrame, lang_labels: DataFrame, id_col: str = "record_id", text: str = "clean_text", label: str = "language", **options) -> DataFrame:
    """(<id>, para_no, lang): per paragraph the languages of its whole sentences, for rows whose label doesn't fit.

    A row is a case if its label is null, names no language or another than its
    text's main one, or if its text has whole sentences in several languages.
    """
    rows = identify(df.where(F.col(text).isNotNull() & F.col(text).rlike(r"\S")), lang_labels, id_col, text, label, **options)
    rows = rows.withColumn("segments", F.filter("segments", lambda s: s["whole"]))
    several = F.size(F.array_distinct(F.transform("segments", lambda s: s["lang"]))) > 1
    cases = rows.where(F.col("lang").isNotNull() & (F.col("label_lang").isNull() | (F.col("label_lang") != F.col("lang")) | several))
    return cases.select(id_col, F.explode("segments").alias("_s")).select(id_col, F.col("_s.para_no").alias("para_no"), F.col("_s.lang").alias("lang")).distinct()
