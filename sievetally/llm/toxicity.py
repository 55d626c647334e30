"""Toxicity: a classifier whose score may not depend on which group a sentence names.

A logistic regression over the words of a text and their beginnings, hashed to buckets. Training compares labelled texts with
counterfactual ones, and adds the squared differences of their scores to the loss:

- A text that names a group is compared with one that names another group in its place.
- Every labelled text is compared with the same text and one identity term more, for each term that it lacks, and these
  texts with each other within a group of terms.

A group that is mostly named in toxic labelled texts then earns no weight of its own, and neither does one whose name
begins like a word of abuse; neutral mentions of it are not flagged.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievetally.llm.common import sample_of, slices

BUCKETS = 1 << 20
# Lengths of word beginnings that are features beside the whole word.
BEGINNINGS = (3, 4, 5, 6)
# Labelled rows to learn from, about, where there are more; half of them of either label.
TRAIN_ROWS = 8000
# Labelled texts that must have a feature before it gets a weight.
LEAST_TEXTS = 4
LEAST_DEVIATIONS = 3.5
PENALTY = 1.0
MEMO = 100_000

# Words that name groups of people, by language and inflection. A term is swapped for another of its own row.
IDENTITY_TERMS = (
    # English
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("blacks", "whites", "asians", "latinos", "africans", "europeans", "arabs", "indians"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("disabled", "blind", "deaf"),
    ("elderly", "young"),
    # German
    ("frauen", "männer", "mädchen", "jungen"),
    ("frau", "mann"),
    ("weiblich", "männlich"),
    ("muslime", "christen", "juden", "hindus", "katholiken", "atheisten"),
    ("muslimisch", "christlich", "jüdisch", "katholisch"),
    ("schwule", "lesben", "homosexuelle", "transsexuelle"),
    ("ausländer", "einwanderer", "flüchtlinge", "einheimische"),
    ("schwarze", "weiße", "asiaten", "araber", "türken"),
    ("behinderte", "blinde", "gehörlose"),
    # French
    ("femmes", "hommes", "filles", "garçons"),
    ("femme", "homme", "fille", "garçon"),
    ("musulmans", "chrétiens", "juifs", "hindous", "catholiques", "athées"),
    ("musulmane", "chrétienne", "juive", "catholique", "athée"),
    ("homosexuels", "lesbiennes", "bisexuels", "transgenres"),
    ("étrangers", "immigrés", "réfugiés", "autochtones"),
    ("noirs", "blancs", "arabes", "asiatiques"),
    ("handicapés", "aveugles", "sourds"),
    # Spanish
    ("mujeres", "hombres", "niñas", "niños"),
    ("mujer", "hombre", "niña", "niño"),
    ("musulmanes", "cristianos", "judíos", "hindúes", "católicos", "ateos"),
    ("musulmana", "cristiana", "judía", "católica", "atea"),
    ("homosexuales", "lesbianas", "bisexuales", "transexuales"),
    ("extranjeros", "inmigrantes", "refugiados", "indígenas"),
    ("negros", "blancos", "árabes", "asiáticos", "gitanos"),
    ("discapacitados", "ciegos", "sordos"),
)

_words = re.compile(r"[^\W\d_]+").findall


def word_features(word: str) -> list[int]:
    """Buckets of one lower-case word."""
    parts = [f"={word}", *(f"^{word[:n]}" for n in BEGINNINGS if len(word) >= n)]
    return [xxhash.xxh3_64_intdigest(p) & (BUCKETS - 1) for p in parts]


def features_of(words: set[str]) -> np.ndarray:
    """Buckets of a set of words, one entry for each word that has the feature."""
    return np.fromiter(itertools.chain.from_iterable(map(word_features, sorted(words))), np.int32)


def words_of(text: str | None) -> set[str]:
    """Distinct lower-case words; none for a null text."""
    return set().union(*(_words(part.lower()) for part in slices(text or "")))


def swapped(words: set[str], groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> set[str] | None:
    """The words with every identity term swapped for another of its row, chosen by the words alone; None if there is none."""
    chosen = {}
    for row in groups:
        for term in row:
            if term in words and len(row) > 1:
                others = [x for x in row if x != term]
                chosen[term] = others[hashlib.sha1(f"{term} {len(words)}".encode()).digest()[0] % len(others)]
    return (words - chosen.keys()) | set(chosen.values()) if chosen else None


@dataclass
class ToxicityModel:
    """Weights by bucket, and a bias; the score is the logistic function of the bias and the weights of all distinct words' features."""

    weights: dict[int, float]
    bias: float

    def word_weight(self, word: str) -> float:
        return sum(self.weights.get(b, 0.0) for b in word_features(word))


class Scorer:
    """Scores whole texts in one task; remembers the weights of MEMO words."""

    def __init__(self, model: ToxicityModel):
        self.model, self.memo = model, {}

    def score(self, text: str | None) -> float:
        words, memo = words_of(text), self.memo
        if len(memo) > MEMO:
            memo.clear()
        for word in words:
            if word not in memo:
                memo[word] = self.model.word_weight(word)
        total = math.fsum(map(memo.__getitem__, words)) + self.model.bias
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))


class _Rows:
    """Sparse 0/1 rows over dense columns."""

    def __init__(self, rows: list[np.ndarray]):
        self.columns = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
        self.of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.n = len(rows)

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, weights[self.columns], self.n)

    def back(self, errors: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, errors[self.of], width)


def telling_features(features: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Buckets in at least LEAST_TEXTS texts whose share of label 1 is LEAST_DEVIATIONS standard deviations from that of all texts."""
    texts, ones = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for feature, label in zip(features, y, strict=True):
        own = np.unique(feature)
        texts[own] += 1
        ones[own] += label
    share = y.mean()
    away = np.abs(ones - texts * share) / np.sqrt(np.maximum(texts, 1) * share * (1 - share))
    return np.flatnonzero((texts >= LEAST_TEXTS) & (away >= LEAST_DEVIATIONS))


class Insertions:
    """The counterfactual texts that have one identity term more than a labelled text, all of them at once.

    A text's logit grows by the weight of the term's features, whatever the text; so the mean over all texts that
    lack a term is its weight squared, times the share of those texts.
    """

    def __init__(self, groups: tuple[tuple[str, ...], ...], lacking: dict[str, int], texts: int):
        self.terms = [(t, row) for row, terms in enumerate(groups) for t in terms]
        self.rows = np.array([row for _, row in self.terms], np.int64)
        counts = np.array([lacking.get(t, texts) for t, _ in self.terms], np.float64)
        self.share = counts / max(1, texts)
        self.pairs = int(counts.sum())

    def matrix(self, place: np.ndarray, width: int) -> np.ndarray:
        """How often each term has each kept feature."""
        out = np.zeros((len(self.terms), width))
        for i, (term, _) in enumerate(self.terms):
            at = place[word_features(term)]
            np.add.at(out[i], at[at >= 0], 1)
        return out

    def gaps(self, weights: np.ndarray) -> np.ndarray:
        """Gradient of half the summed squares by term: of its own change, and of its distance to the other terms of its row."""
        own = np.bincount(self.rows, weights) / np.maximum(1, np.bincount(self.rows))
        return self.share * (weights + weights - own[self.rows])


def train(features: list[np.ndarray], counterfactuals: list[np.ndarray | None], labels: list[int], penalty: float = PENALTY, insertions: Insertions | None = None, decay: float = 1e-3, steps: int = 200, rate: float = 0.1) -> ToxicityModel:
    """Fits by Adam on all rows: cross-entropy, with both labels of equal weight in sum, plus decay and the counterfactual penalties.

    Without rows of both labels the score is the share of label 1 for all texts (one half without any row).
    """
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return ToxicityModel({}, 0.0 if not len(y) else (20.0 if y[0] else -20.0))
    kept = telling_features(features, y)
    # A feature of counterfactuals has to get a weight too where its counterpart has one, or the penalty could not reach it.
    if kept.size:
        kept = np.union1d(kept, np.concatenate([kept[:0], *(np.setxor1d(f, c) for f, c in zip(features, counterfactuals, strict=True) if c is not None)]))
    place = np.full(BUCKETS, -1)
    place[kept] = np.arange(len(kept))

    def dense(row: np.ndarray) -> np.ndarray:
        at = place[row]
        return at[at >= 0]

    rows = _Rows([dense(r) for r in features])
    swaps = [i for i, c in enumerate(counterfactuals) if c is not None]
    before, after = _Rows([dense(features[i]) for i in swaps]), _Rows([dense(counterfactuals[i]) for i in swaps])
    terms = insertions.matrix(place, len(kept)) if insertions and insertions.terms else None
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    w, bias = np.zeros(len(kept)), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(rows.times(w) + bias, -500, 500)))
        error = (p - y) * share
        gradient = rows.back(error, len(w)) + decay * w
        if swaps:
            gap = (before.times(w) - after.times(w)) * (2 * penalty / len(swaps))
            gradient += before.back(gap, len(w)) - after.back(gap, len(w))
        if terms is not None:
            gradient += 2 * penalty * (insertions.gaps(terms @ w) @ terms)
        g = error.sum()
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        mb, vb = 0.9 * mb + 0.1 * g, 0.999 * vb + 0.001 * g**2
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        bias -= now * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    return ToxicityModel(dict(zip(kept.tolist(), w.tolist(), strict=True)), float(bias))


def _known(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, train_rows: int = TRAIN_ROWS, penalty: float = PENALTY) -> ToxicityModel:
    """A model of the documents with a 0/1 label, from about train_rows ids, half of either label, chosen by a hash of the id; whole texts.

    A label with fewer ids than that gives all of them, so that rare toxic rows are not thinned out. The chosen ids and labels, of bounded number, are
    broadcast to the documents. Tasks send the features of those to the driver, not the texts. Null labels are left out, null
    texts have no words; of repeated ids the least text and label count. `groups` are rows of identity terms in lower case, each one word.
    """
    terms = [t for row in groups for t in row]

    @F.pandas_udf("own binary, other binary, named array<int>")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            words = [words_of(t) for t in texts]
            other = [swapped(w, groups) for w in words]
            yield pd.DataFrame({"own": [features_of(w).tobytes() for w in words], "other": [None if w is None else features_of(w).tobytes() for w in other], "named": [[i for i, t in enumerate(terms) if t in w] for w in words]})

    known = _known(labels, id_col, label_col)
    chosen = sample_of(known.where("y = 0"), "id", train_rows // 2).unionByName(sample_of(known.where("y = 1"), "id", train_rows // 2))
    chosen = chosen.groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id").agg(F.min("t").alias("t"), F.min("y").alias("y"))
    sample = texts.select("id", "y", features("t").alias("x")).collect()
    sample.sort(key=lambda r: r["id"])
    own = [np.frombuffer(r["x"]["own"], np.int32) for r in sample]
    other = [None if r["x"]["other"] is None else np.frombuffer(r["x"]["other"], np.int32) for r in sample]
    named = Counter(terms[i] for r in sample for i in r["x"]["named"])
    insertions = Insertions(groups, {t: len(sample) - named[t] for t in terms}, len(sample))
    return train(own, other, [r["y"] for r in sample], penalty, insertions)


def counterfactual_report(docs: DataFrame, labels: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", groups: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> DataFrame:
    """One row (texts, pairs, mean_change, false_positives, false_positives_with_term): how identity terms move the scores of texts labelled 0.

    A pair is a text and the same text with one term that it lacks. mean_change is the mean distance of both scores; the last two are the shares
    of texts, and of texts with a term more, that score one half or more. Their difference is the gap that the penalty is to close.
    """
    terms = sorted({t for row in groups for t in row})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("pairs long, change double, plain long, flagged long")
    def compare(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        weights = np.array([shared.value.word_weight(t) for t in terms])
        for texts in batches:
            out = []
            for text in texts:
                words = words_of(text)
                plain = scorer.score(text)
                logit = math.log(plain) - math.log1p(-plain) if 0 < plain < 1 else math.copysign(500, plain - 0.5)
                scores = 1 / (1 + np.exp(-np.clip(logit + weights[[t not in words for t in terms]], -500, 500)))
                out.append((len(scores), float(np.abs(scores - plain).sum()), len(scores) * (plain >= 0.5), int((scores >= 0.5).sum())))
            yield pd.DataFrame(out, columns=["pairs", "change", "plain", "flagged"])

    clean = _known(labels, id_col, label_col).groupBy("id").agg(F.min("y").alias("y")).where("y = 0")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(clean, "id").select(compare("t").alias("x"))
    sums = rows.agg(F.count(F.lit(1)).alias("texts"), *(F.sum(f"x.{c}").alias(c) for c in ("pairs", "change", "plain", "flagged")))
    return sums.select("texts", F.coalesce("pairs", F.lit(0)).alias("pairs"), *(F.try_divide(c, "pairs").alias(name) for c, name in (("change", "mean_change"), ("plain", "false_positives"), ("flagged", "false_positives_with_term"))))


def toxicity(model: ToxicityModel, df: DataFrame, text: Column) -> Column:
    """Score from 0 to 1 of a text column, whole texts; null and empty texts have the score of a text without words."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype=float)

    return score(text)


def classify(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, score, predicted) of every row; predicted is 1 from the threshold on. Repeated rows and null ids stay as they are."""
    scored = docs.select(F.col(id_col).alias("doc_id"), toxicity(model, docs, F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
