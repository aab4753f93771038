"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic documents are examples; all other texts count as unlabelled, whether
somebody has looked at them or not. With the class prior p, the risk of a scorer is
p R+(toxic) + max(0, R-(unlabelled) - p R-(toxic)): the second term is the risk on
clean texts, corrected for the toxic ones among the unlabelled, and kept from going
below zero, where it would only show that the examples are learnt by heart.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ludolytics.llm.shared import giving_back, keep

WORDS = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings that are features besides whole words.
PREFIXES = (4, 5, 6, 7)


def words_of(text: str | None) -> set[str]:
    """The distinct words of a whole text, in lower case."""
    return set(WORDS.findall((text or "").lower()))


def terms_of(text: str | None) -> set[str]:
    """Words; beginnings of words (`begin-`), so that forms help each other; and beginnings of two or more words (`begin=`)."""
    words = words_of(text)
    terms = set(words)
    for length in PREFIXES:
        for begin, n in Counter(word[:length] for word in words if len(word) > length).items():
            terms.add(begin + "-")
            if n > 1:
                terms.add(begin + "=")
    return terms


def without_shadows(terms: list[tuple[str, int]]) -> list[str]:
    """The terms, in the given order, less beginnings that nearly always stand for one narrower term."""
    narrower: dict[str, int] = {}  # by term, the most toxic texts that one narrower term is in
    for term, count in terms:
        word, mark = term.rstrip("-="), term[-1] if term[-1] in "-=" else ""
        wider = [word + "-"] if mark == "=" else []
        wider += [word[:k] + m for k in PREFIXES if k < len(word) for m in ("-" if mark != "=" else "-=")]
        for other in wider:
            narrower[other] = max(narrower.get(other, 0), count)
    return [term for term, count in terms if narrower.get(term, 0) < 0.8 * count]


@dataclass(frozen=True)
class Settings:
    """max_positive and max_unlabelled bound the texts that a model is fitted to, max_words its size.

    A word or beginning is a feature if its shares among toxic and unlabelled texts differ by
    more than min_chi2 allows for chance, and if it is in min_toxic toxic texts or more.
    """

    max_positive: int = 3000
    max_unlabelled: int = 9000
    max_words: int = 512
    min_chi2: float = 40.0
    min_toxic: int = 5
    steps: int = 600
    rate: float = 0.1
    l2: float = 1e-5


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        """Logistic of the summed weights; the same for any order of the words."""
        weights = self.weights
        total = self.bias + sum(sorted(weights[term] for term in weights.keys() & terms_of(text)))
        return float(1 / (1 + np.exp(-total)))


def risk_slope(xp: np.ndarray, xu: np.ndarray, w: np.ndarray, prior: float) -> np.ndarray:
    """Where to go from `w`: the slope of the risk, or away from the clean part of it where that is below nought."""
    zp, zu = xp @ w, xu @ w
    sp, su = 1 / (1 + np.exp(-zp)), 1 / (1 + np.exp(-zu))
    clean_risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    clean_slope = xu.T @ (su / len(xu)) - prior * (xp.T @ (sp / len(xp)))
    if clean_risk >= 0:
        return prior * (xp.T @ ((sp - 1) / len(xp))) + clean_slope
    return -clean_slope  # undo the over-fit before going on


def fit_nnpu(toxic: np.ndarray, unlabelled: np.ndarray, prior: float, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Weights and bias for rows of 0/1 features, by full steps of Adam on the logistic risk."""
    xp = np.hstack([toxic, np.ones((len(toxic), 1))]).astype(np.float32)
    xu = np.hstack([unlabelled, np.ones((len(unlabelled), 1))]).astype(np.float32)
    weights = np.zeros(xp.shape[1])
    weights[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, settings.steps + 1):
        slope = risk_slope(xp, xu, weights.astype(np.float32), prior)
        slope = slope + settings.l2 * np.append(weights[:-1], 0)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        weights = weights - settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights[:-1], float(weights[-1])


def is_held_out(id_col: str = "doc_id") -> F.Column:
    """crc32 of the id as text leaves no remainder by five; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> Model | None:
    """A model of the documents' toxicity, from labels of rows that aren't held out. None without a toxic one.

    Ids are chosen by their hash, so the sample does not depend on order or partitions.
    The prior is the toxic share of all labels in training. The ids chosen are bounded by
    the settings and so broadcast; their texts are reduced to words where they lie. Of an id
    with several rows, one text stands for it, by the hash of its words: so the rows that are
    kept and collected are as few as the ids, however often one is repeated.
    """
    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("doc_id").isNotNull())
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().where(~is_held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, n_toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return None
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    toxic = known.where("toxic = 1").select("doc_id").orderBy(*by_hash).limit(settings.max_positive)
    other = chosen.where(~is_held_out()).select("doc_id").distinct().orderBy(*by_hash).limit(settings.max_unlabelled)
    ids = toxic.withColumn("p", F.lit(1)).unionByName(other.withColumn("p", F.lit(0))).groupBy("doc_id").agg(F.max("p").alias("p"), F.max(1 - F.col("p")).alias("u"))

    @giving_back
    def reduce_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(terms_of(text)) for text in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found, pa.list_(pa.string()))], ["doc_id", "p", "u", "words"])

    sample = chosen.join(F.broadcast(ids), "doc_id").select("doc_id", "p", "u", "text")
    reduced = sample.mapInArrow(reduce_text, "doc_id long, p int, u int, words array<string>")
    of_id = F.min(F.struct(F.xxhash64("words").alias("hash"), "words")).alias("least")
    sample = keep(reduced.groupBy("doc_id", "p", "u").agg(of_id).select("doc_id", "p", "u", "least.words"))
    n_p, n_u = sample.agg(F.coalesce(F.sum("p"), F.lit(0)), F.coalesce(F.sum("u"), F.lit(0))).first()
    if not n_p:
        return None
    counts = sample.select("p", "u", F.explode("words").alias("word")).groupBy("word").agg(F.sum("p").alias("a"), F.sum("u").alias("b"))
    rest = (F.lit(n_p + n_u) - F.col("a") - F.col("b"))
    odd = F.col("a") * (n_u - F.col("b")) - F.col("b") * (n_p - F.col("a"))
    chi2 = F.lit(float(n_p + n_u)) * odd * odd / (F.lit(float(n_p) * n_u) * (F.col("a") + F.col("b")) * rest)
    top = counts.where((F.col("a") >= settings.min_toxic) & (rest > 0)).select("word", "a", chi2.alias("chi2")).where(F.col("chi2") >= settings.min_chi2)
    best = top.orderBy(F.desc("chi2"), "word").limit(8 * settings.max_words).collect()
    features = sorted(without_shadows([(row["word"], row["a"]) for row in best])[: settings.max_words])
    if not features:
        return Model({}, float(np.log(n_toxic / n) if n_toxic < n else 0.0))
    place = {word: k for k, word in enumerate(features)}
    at = F.transform(F.filter("words", lambda w: w.isin(features)), lambda w: w)
    rows = sample.select("doc_id", "p", "u", at.alias("words")).orderBy("doc_id", F.array_join("words", " ")).collect()  # bounded by the settings
    matrix = np.zeros((len(rows), len(features)), np.float32)
    for k, row in enumerate(rows):
        matrix[k, [place[word] for word in row["words"]]] = 1
    p, u = (np.array([row[name] for row in rows]) == 1 for name in ("p", "u"))
    weights, bias = fit_nnpu(matrix[p], matrix[u], min(max(n_toxic / n, 1e-4), 0.5), settings)
    return Model({word: float(w) for word, w in zip(features, weights, strict=True) if w}, bias)


def scores(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, a row for each row; whole texts, no input but the text.

    A null or empty text has the score of a text without any word the model knows. Without a
    model (no toxic example) every score is 0. A null doc_id is held out. An empty table
    gives no rows; other columns are neither read nor returned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([model.score(text) if model else 0.0 for text in batch.column(2).to_pylist()], float)
            columns = [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def clean(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores below the threshold."""
    if model is None:
        return docs
    names, at = docs.columns, docs.columns.index(text_col)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(text) < threshold for text in batch.column(at).to_pylist()], pa.bool_()))

    return docs.select(names).mapInArrow(run, docs.schema)
