"""Language identification: averaged hashed subword embeddings, a linear softmax, and a calibrated rejection.

A text's features are the character n-grams of its words, hashed to BUCKETS rows of an embedding
table; their mean goes through a linear layer and a softmax. Table and layer are trained by
stochastic gradient descent in numpy. As both layers are linear, prediction looks up, for every
n-gram, its row of their product, so that a text costs one look-up per n-gram.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sievetally.llm.common import as_row, slices
from sievetally.session import cut_lineage

UNDETERMINED = "und"
BUCKETS = 1 << 16
DIMENSIONS = 16
ORDERS = (1, 2, 3, 4)
# Labelled rows to learn from, about, where there are more; whole texts.
TRAIN_ROWS = 6000
# Rows of each language, about, where its part of those is less; all where it has fewer.
LANGUAGE_ROWS = 200
# Different labels at most: the table of a model has BUCKETS * 4 bytes for each, and every task holds it.
MOST_LANGUAGES = 400
# Share of the correctly labelled calibration rows that the rejection may lose.
REJECTED_SHARE = 0.0005
# No score from here on is rejected: an answer likelier than all others together stays.
MOST_REJECTED = 0.5
_GOLD = 0x9E3779B97F4A7C15


def _letters() -> np.ndarray:
    """For every code point 2 if it is a letter, 1 if it is a mark on one, else 0."""
    return np.fromiter(({"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.int8, 0x110000)


_tables: list[np.ndarray] = []


def code_points(text: str) -> np.ndarray:
    """Lower-case letters of a text; every run of other characters is one 0, also at both ends. Empty without a letter."""
    if not _tables:
        _tables.append(_letters())
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _tables[0][points]
    if not (kinds == 2).any():
        return np.zeros(0, np.uint32)
    points = np.concatenate([[0], np.where(kinds > 0, points, 0), [0]]).astype(np.uint32)
    return points[np.concatenate([[True], (points[1:] != 0) | (points[:-1] != 0)])]


def ngrams(points: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of the n-grams of all ORDERS; 0 is a word's edge, and no n-gram reaches over one."""
    shift = np.uint64(64 - buckets.bit_length() + 1)
    wide, found = points.astype(np.uint64), []
    value = np.zeros(len(points) + 1, np.uint64)
    inside = np.ones(len(points) + 1, bool)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            break
        value = (value[:n] * np.uint64(0x100000001B3) + wide[order - 1 :] + np.uint64(order)) * np.uint64(_GOLD)
        inside = inside[:n] & (points[order - 2 : order - 2 + n] != 0) if order > 2 else inside[:n]
        keep = inside if order > 1 else points != 0
        if order in ORDERS:
            found.append(((value ^ (value >> np.uint64(29))) * np.uint64(_GOLD))[keep] >> shift)
    return np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """(buckets, the share of each) of the n-grams of a whole text, read in slices; None for a null text and one without a letter."""
    counts = np.zeros(BUCKETS, np.int64)
    for part in slices(text or ""):
        counts += np.bincount(ngrams(code_points(part), BUCKETS), minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return (found.astype(np.uint16), (counts[found] / counts.sum()).astype(np.float32)) if len(found) else None


@dataclass
class LanguageModel:
    """languages, the product of both layers by bucket, the bias, the temperature and the score below which a text is rejected.

    accuracy and right_scores, the scores of right answers, are of the held-out rows of the sample.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0
    accuracy: float = field(default=float("nan"))
    right_scores: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def logits(self, text: str) -> np.ndarray | None:
        """None for a text without a letter. No n-gram reaches over a word's edge, so long texts are summed in slices."""
        total, n = np.zeros(len(self.languages)), 0
        for part in slices(text):
            grams = ngrams(code_points(part), len(self.table))
            total += self.table[grams].sum(axis=0)
            n += len(grams)
        return total / n + self.bias if n else None

    def score(self, text: str | None) -> tuple[str, float]:
        """(language, calibrated probability); (und, 0) for a null text and one without a letter."""
        logits = self.logits(text) if text else None
        if logits is None:
            return UNDETERMINED, 0.0
        p = _softmax(logits[None] / self.temperature)[0]
        return self.languages[int(p.argmax())], float(p.max())


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], **options) -> LanguageModel:
    """train_features of whole texts; those without a letter are left out."""
    rows = [(x, y) for x, y in zip(map(features, texts), labels, strict=True) if x]
    return train_features([x for x, _ in rows], [y for _, y in rows], **options)


def train_features(grams: list[tuple[np.ndarray, np.ndarray]], kept: list[str], epochs: int = 3, rate: float = 20.0, batch: int = 32, seed: int = 0, rejected_share: float = REJECTED_SHARE, language_rows: int = LANGUAGE_ROWS) -> LanguageModel:
    """Fits the model on three quarters of the rows, features with their label, and calibrates temperature and rejection on the rest.

    With no row, the model knows no language and calls all texts und.
    """
    languages = sorted(set(kept))
    if not languages:
        return LanguageModel([UNDETERMINED], np.zeros((BUCKETS, 1)), np.zeros(1))
    y = np.array([languages.index(x) for x in kept])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    # One row of each language, the last in this order, is always learned from.
    sure = np.isin(order, [order[np.flatnonzero(y[order] == k)[-1]] for k in range(len(languages))])
    first = np.arange(len(y)) < len(y) // 4
    held = order[first & ~sure]
    own = order[~first | sure]
    # Rows of a rare language are repeated, or the others would outweigh them.
    counts = np.bincount(y[own], minlength=len(languages))
    least = min(language_rows, counts.max())
    own = np.concatenate([own, *(np.resize(own[y[own] == k], least - n) for k, n in enumerate(counts) if n < least)])
    table = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS))
    layer, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, step = epochs * -(-len(own) // batch), 0
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(own), -(-len(own) // batch)):
            now = rate * (1 - step / steps)
            step += 1
            ids = np.concatenate([grams[i][0] for i in part])
            weights = np.concatenate([grams[i][1] for i in part])
            doc = np.repeat(np.arange(len(part)), [len(grams[i][0]) for i in part])
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            hidden = np.add.reduceat(table[ids] * weights[:, None], starts)
            error = _softmax(hidden @ layer + bias)
            error[np.arange(len(part)), y[part]] -= 1
            error /= len(part)
            back = error @ layer.T
            layer -= now * hidden.T @ error
            bias -= 0.1 * now * error.sum(axis=0)
            np.subtract.at(table, ids, now * weights[:, None] * back[doc])
    model = LanguageModel(languages, (table @ layer).astype(np.float32), bias)
    if len(held):
        _calibrate(model, [grams[i] for i in held], y[held], rejected_share)
    return model


def _calibrate(model: LanguageModel, grams: list, y: np.ndarray, rejected_share: float) -> None:
    """The temperature of least cross-entropy on held-out rows; a score that all but a small share of their right answers reach."""
    logits = np.array([(model.table[g] * w[:, None]).sum(axis=0) for g, w in grams]) + model.bias
    loss = {t: -np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in np.geomspace(0.05, 20, 121)}
    model.temperature = float(min(loss, key=loss.get))
    p = _softmax(logits / model.temperature)
    right = p.argmax(axis=1) == y
    model.accuracy = float(right.mean())
    model.right_scores = p.max(axis=1)[right]
    model.least_score = float(min(MOST_REJECTED, np.quantile(model.right_scores, rejected_share))) if right.any() else 0.0


def chosen_below(known: DataFrame, train_rows: int, language_rows: int, most_languages: int) -> DataFrame:
    """(y, below) for rows (id, y): a row of label y is learned from if choice("id") is below.

    Every language has its part of train_rows, or about language_rows where that is more, or all its rows where it has fewer.
    The driver holds one number for each language; more than most_languages of them are an error.
    """
    counts = known.groupBy("y").agg(F.approx_count_distinct("id", 0.01)).limit(most_languages + 1).collect()
    if len(counts) > most_languages:
        raise ValueError(f"more than {most_languages} different labels: their model would not fit the tasks")
    total = sum(n for _, n in counts)
    below = [(y, int((1 << 30) * min(1.0, max(language_rows, train_rows * n / total) / max(n, 1)))) for y, n in counts]
    return known.sparkSession.createDataFrame(below, StructType([known.schema["y"], StructField("below", LongType())]))


def choice(id_col: str) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(1 << 30))


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", train_rows: int = TRAIN_ROWS, language_rows: int = LANGUAGE_ROWS, most_languages: int = MOST_LANGUAGES) -> LanguageModel:
    """A model of rows with text and label, from about train_rows of them, but language_rows of each language, chosen by a hash of the id; whole texts.

    Tasks send the n-gram shares of those to the driver, not the texts: at most 6 bytes for each of BUCKETS a row.
    Of repeated ids the least beginning, label and shares count. The rejection is calibrated on a quarter of the chosen rows.
    """
    known = _known(rows, F.lit(True), id_col, text_col, label_col).where("y IS NOT NULL")
    return _fit_chosen(_with_chosen(known, train_rows, language_rows, most_languages), language_rows)


def _known(rows: DataFrame, learnable: Column, id_col: str, text_col: str, label_col: str, *more: Column) -> DataFrame:
    """(id, t, y and more): y is null where a row is not to be learned from."""
    known = learnable & F.col(text_col).isNotNull()
    return rows.select(*more, F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.when(known, F.col(label_col)).alias("y"))


def _with_chosen(known: DataFrame, train_rows: int, language_rows: int, most_languages: int) -> DataFrame:
    below = chosen_below(known.where("y IS NOT NULL").select("id", "y"), train_rows, language_rows, most_languages)
    joined = known.join(F.broadcast(below), "y", "left")
    return joined.withColumn("chosen", F.coalesce(choice("id") < F.col("below"), F.lit(False))).drop("below")


def _fit_chosen(known: DataFrame, language_rows: int) -> LanguageModel:
    @F.pandas_udf("found binary, shares binary")
    def grams(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = [features(t) or (None, None) for t in texts]
            yield pd.DataFrame([[None if a is None else a.tobytes() for a in row] for row in rows], columns=["found", "shares"])

    # Beginnings only put the rows in a fixed order for the driver, that of their texts.
    sample = known.where("chosen").select("id", F.struct(F.substring("t", 1, 64).alias("begins"), "y", grams("t").alias("x")).alias("row"))
    sample = sample.groupBy("id").agg(F.min("row").alias("row")).where("row.x.found IS NOT NULL").select("row.begins", "row.y", "row.x.found", "row.x.shares").collect()
    sample.sort(key=lambda r: (r["begins"], r["y"], bytes(r["found"]), bytes(r["shares"])))
    own = [(np.frombuffer(r["found"], np.uint16), np.frombuffer(r["shares"], np.float32)) for r in sample]
    return train_features(own, [r["y"] for r in sample], language_rows=language_rows)


def learn_and_identify(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", train_rows: int = TRAIN_ROWS, language_rows: int = LANGUAGE_ROWS, most_languages: int = MOST_LANGUAGES, keep_rows: bool = False) -> DataFrame:
    """(doc_id, lang_pred, score, rejected), with keep_rows also the row itself as a struct `row`, of every row, whole texts.

    A model is fitted as by fit() on the learnable rows that have text and label. Every text is scored once, into a written table; the
    rejection is the REJECTED_SHARE percentile of the right answers among all learnable rows that were not learned from, and so
    behaves alike at every size. A null text and one without a letter are und with score 0 and rejected; repeated rows and null ids
    stay as they are. Without a learnable row all are und.
    """
    row = [as_row(docs).alias("row")] if keep_rows else []
    known = _with_chosen(_known(docs, learnable, id_col, text_col, label_col, *row), train_rows, language_rows, most_languages)
    model = _fit_chosen(known, language_rows)
    scored = known.select(*(["row"] if keep_rows else []), "id", "y", "chosen", language(model, docs, F.col("t")).alias("found"))
    scored = cut_lineage(scored, "languages")
    right = scored.where("NOT chosen AND found.lang = y").select("found.score")
    held = docs.sparkSession.createDataFrame([(float(x),) for x in model.right_scores], "score double")
    # Percentiles are of ranks within 1 / 200,000 of all rows.
    least = right.union(held).agg(F.percentile_approx("score", REJECTED_SHARE, 200_000)).first()[0]
    least = 0.0 if least is None else min(MOST_REJECTED, least)
    rejected = (F.col("found.lang") == UNDETERMINED) | (F.col("found.score") < least)
    return scored.select(*(["row"] if keep_rows else []), F.col("id").alias("doc_id"), F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), rejected.alias("rejected"))


def language(model: LanguageModel, df: DataFrame, text: Column) -> Column:
    """struct(lang string, score double, rejected boolean) of a text column; rejected: und, or a score under the model's least."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, rejected boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            out = pd.DataFrame([own.score(t) for t in texts], columns=["lang", "score"])
            out["rejected"] = (out["lang"] == UNDETERMINED) | (out["score"] < own.least_score)
            yield out

    return predict(text)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row, whole texts.

    A null text and one without a letter are und with score 0; repeated rows and null ids stay as they are.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), language(model, docs, F.col(text_col)).alias("found"))
    return found.select("doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))
