"""Operator 2: toxicity from a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, maps homoglyphs of other scripts to Latin letters and undoes digit substitutions
inside words. An entry matches from the start of a word: a stem matches all its inflections, a whole
word only itself. Hits inside an exception phrase do not count. The summed weights are
normalised by the length of the text and calibrated to 0..1.

Terms and their weights are learned from labelled rows: a word, or the start of a word, that stands in
more toxic documents than the toxic share of all words lets expect gets the logarithm of that ratio.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcome_lens.llm.common import give_back, texts, whole_text

# Insults that weigh from the start, phrases in which a hit does not count, look-alikes.
START_TERMS = (
    "idiot moron stupid scum loser pathetic worthless disgusting trash clown imbecile bastard vermin "
    "dummkopf arschloch abschaum trottel connard abruti salaud imbécile estúpido imbécil basura"
).split()
START_WEIGHT = 3.0
EXCEPTIONS = (
    "trash can", "trash bin", "trash collection", "clown fish", "clown school", "circus clown",
    "pathetic fallacy", "sore loser rule", "pond scum", "idiot board", "idiot proof",
)
HOMOGLYPHS = str.maketrans(
    "аеорсухіјѕԁһӏαεοιυρτκνχμΑΒΕΖΗΙΚΜΝΟΡΤΥΧВМНТАЕОРСУХ",
    "aeopcyxijsdhlaeoiuptkvxuabezhikmnoptyxbmhtaeopcyx",
)
SUBSTITUTES = str.maketrans("013457@$", "oieastas")

SAMPLE_ROWS = 20_000  # labelled rows that terms and calibration are learned from
MAX_TERMS = 3_000  # entries of the lexicon
MIN_DOCS = 8  # toxic documents a term must stand in
MIN_WEIGHT = 1.5
STEMS = range(4, 10)
HELD_OUT = 5  # rows whose crc32(doc_id) is a multiple are never learned from

NOT_LATIN = re.compile("[Ͱ-ӿԀ-ԯ＀-～​-‏­]")
HIDDEN = re.compile("[​-‏­]")
WIDE = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)}
HAS_SUBSTITUTE = re.compile("[013457@$]")
WORD_WITH_SUBSTITUTE = re.compile(r"\b[\w@$]+")


class Model(NamedTuple):
    """Terms with weights (a trailing ``*`` marks a stem) and the calibration of the normalised sum."""

    terms: dict[str, float]
    bias: float
    slopes: tuple[float, float, float]


START = Model({t: START_WEIGHT for t in START_TERMS}, -4.0, (2.0, 1.0, -0.3))


def fold(text: str) -> str:
    """Lower case, look-alikes as Latin letters, substituted digits and signs inside words as letters."""
    text = text.lower()
    if not text.isascii() and NOT_LATIN.search(text):
        text = HIDDEN.sub("", text.translate(WIDE)).lower().translate(HOMOGLYPHS)
    if HAS_SUBSTITUTE.search(text):
        text = WORD_WITH_SUBSTITUTE.sub(_unmasked, text)
    return text


def _unmasked(found: re.Match) -> str:
    word = found[0]
    if word.isalpha():
        return word
    return word.translate(SUBSTITUTES) if any(c.isalpha() for c in word) else word


class Lexicon:
    """The automaton of a model's terms and of the exception phrases."""

    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for term, weight in model.terms.items():
            self.automaton.add_word(term.rstrip("*"), (len(term.rstrip("*")), weight, not term.endswith("*")))
        for phrase in EXCEPTIONS:
            self.automaton.add_word(phrase, (len(phrase), 0.0, True))
        self.automaton.make_automaton()

    def weigh(self, text: str) -> tuple[float, int, int]:
        """Summed weight, number of hits, and words of a text. Of terms that start together the heaviest counts."""
        folded = fold(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight, whole) in self.automaton.iter(folded):
            first = end - size + 1
            if first and folded[first - 1].isalnum():
                continue
            if whole and end + 1 < len(folded) and folded[end + 1].isalnum():
                continue
            if weight == 0:
                spared.append((first, end))
            elif weight > best.get(first, 0):
                best[first] = weight
        for a, b in spared:
            for first in [f for f in best if a <= f <= b]:
                del best[first]
        return sum(best.values()), len(best), len(folded.split())


def features(total: float, words: int) -> tuple[float, float, float]:
    """Weight a hundred words, weight, and length, on logarithmic scales."""
    return math.log1p(100 * total / (words + 10)), math.log1p(total), math.log1p(words)


def scored(model: Model) -> callable:
    """An Arrow function from texts to scores."""
    built: list[Lexicon] = []

    def score(text: pa.Array) -> pa.Array:
        if not built:
            built.append(Lexicon(model))
        out = []
        for one in text.to_pylist():
            total, _, words = built[0].weigh(one)
            z = model.bias + float(np.dot(model.slopes, features(total, words))) if total else -8.0
            out.append(1 / (1 + math.exp(-min(max(z, -30), 30))))
        give_back()
        return pa.array(out, pa.float64())

    return F.arrow_udf(score, "double").asNondeterministic()


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT == 0


def folded_words(sample: DataFrame) -> DataFrame:
    """``toxic, words`` of the texts that have words.

    Functions before a filter are marked as not deterministic: else the filter calls them a second time, in Python workers of its own.
    """
    folded = F.arrow_udf(lambda t: pa.array([fold(x) for x in t.to_pylist()], pa.string()), "string").asNondeterministic()
    words = F.regexp_extract_all(F.col("folded"), F.lit("[\\p{L}]+"), 0)
    return sample.select("toxic", folded(F.col("text")).alias("folded")).select("toxic", words.alias("words")).filter(F.size("words") > 0)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Terms and calibration from at most ``sample_rows`` labelled rows, none of them held out.

    The sample is taken by a hash of the id, so reruns learn from the same rows. Rows without an id or a
    label are not learned from. Without both labels the start lexicon is the model.
    """
    known = labels.select(F.col("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).dropDuplicates(["doc_id"])
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = texts(docs).join(F.broadcast(known), "doc_id").select("toxic", "text").checkpoint()
    rows = folded_words(sample)
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.sum(F.size("words")).alias("n")).collect()}
    if len(sizes) < 2:
        return START
    share = sizes[1] / (sizes[0] + sizes[1])
    # rows of a document: its distinct words, and the distinct starts of them
    word = F.explode(F.array_distinct("words")).alias("word")
    starts = F.array(F.col("word"), *(F.when(F.length("word") > n, F.concat(F.substring("word", 1, n), F.lit("*"))) for n in STEMS))
    counted = (
        rows.select("toxic", word)
        .filter(F.length("word") >= 4)
        .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .select(F.explode(F.array_compact(starts)).alias("term"), "toxic", "n")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    )
    weight = F.log((F.col("toxic") + 0.5) / (share * F.col("n") + 0.5))
    found = (
        counted.filter(F.col("toxic") >= MIN_DOCS)
        .select("term", weight.alias("weight"), "toxic")
        .filter(F.col("weight") >= MIN_WEIGHT)
        .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term")
        .limit(MAX_TERMS)
        .collect()
    )
    terms = {t: START_WEIGHT for t in START_TERMS} | telling({r.term: (r.weight, r.toxic) for r in found})
    return calibrated(sample, terms)


def telling(terms: dict[str, tuple[float, int]], gain: float = 0.4, nearly: float = 0.95) -> dict[str, float]:
    """Weights of the terms that others do not stand for as well.

    A stem goes if a longer one, or a word, stands in nearly as many toxic documents; a longer term
    goes if a kept stem of it weighs about as much.
    """
    longest = dict(terms)
    for term, (_, documents) in terms.items():
        bare = term.rstrip("*")
        for size in range(1, len(bare) + (not term.endswith("*"))):
            shorter = bare[:size] + "*"
            if shorter in terms and documents >= nearly * terms[shorter][1]:
                longest.pop(shorter, None)
    kept: dict[str, float] = {}
    for term in sorted(longest, key=lambda t: (len(t.rstrip("*")), not t.endswith("*"), t)):
        bare = term.rstrip("*")
        above = [kept[bare[:n] + "*"] for n in range(1, len(bare) + 1) if bare[:n] + "*" in kept]
        if not above or terms[term][0] > max(above) + gain:
            kept[term] = terms[term][0]
    return kept


def weighed(sample: DataFrame, terms: dict[str, float]) -> DataFrame:
    """``toxic`` and the features ``f`` of the texts with hits."""
    plain = Model(terms, 0.0, (0.0, 0.0, 0.0))
    built: list[Lexicon] = []

    def weigh(text: pa.Array) -> pa.Array:
        if not built:
            built.append(Lexicon(plain))
        found = [built[0].weigh(x) for x in text.to_pylist()]
        return pa.array([list(features(t, w)) if t else None for t, _, w in found], pa.list_(pa.float64()))

    found = F.arrow_udf(weigh, "array<double>").asNondeterministic()
    return sample.select("toxic", found(F.col("text")).alias("f")).filter("f is not null")


def calibrated(sample: DataFrame, terms: dict[str, float]) -> Model:
    """Slopes of the three features by logistic regression over the sample."""
    rows = weighed(sample, terms)
    rows = rows.select(F.col("toxic").cast("double").alias("toxic"), *(F.col("f")[i].alias(f"f{i}") for i in range(3))).checkpoint()
    if rows.select("toxic").distinct().count() < 2:
        return START._replace(terms=terms)
    vectors = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="v").transform(rows)
    fitted = LogisticRegression(featuresCol="v", labelCol="toxic", regParam=1e-4, maxIter=50).fit(vectors)
    return Model(terms, float(fitted.intercept), tuple(float(c) for c in fitted.coefficients))


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null and empty texts have the lowest score."""
    rows = texts(docs).select("doc_id", scored(model)(F.col("text")).alias("score"))
    return rows.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below one half, unchanged."""
    return docs.filter(scored(model)(whole_text()) < 0.5)
