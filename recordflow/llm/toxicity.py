"""Toxicity by multiple-instance learning: sentence scores, joined by noisy-or, fitted to document labels."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordflow.llm.common import mapped, packed, table, unpacked

#: Labelled documents that a model is fitted on at most, those of the smallest hash of their id.
MAX_TRAINING_DOCS = 20_000

#: Features that a model has weights for at most: those that tell the labels apart best.
MAX_FEATURES = 2_000

#: Features found in fewer training documents than this tell nothing about other documents.
LEAST_DOCS = 5

#: Standard deviations from the overall share of toxic documents at which a feature is no chance find.
LEAST_Z = 4.0

#: Lengths of the word beginnings that are features beside the whole word: they stand for stems.
PREFIXES = range(3, 9)

#: Words whose weights one task keeps at hand.
CACHED_WORDS = 200_000

_TOKEN = re.compile(r"\w+|[.!?\n]")
_STOPS = frozenset(".!?\n")

SENTENCES = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
)


def features(word: str) -> list[str]:
    """The whole word, and its beginnings."""
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if n <= len(word))]


@dataclass
class Model:
    """A sentence's log odds are ``bias`` and the weights of the features of its different words."""

    weights: dict[str, float]
    bias: float
    words: dict[str, float] = field(default_factory=dict)

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            found = self.words[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return found

    def odds(self, text: str) -> list[float]:
        """The log odds of every sentence with a word."""
        out, known, seen = [], self.words.get, set()
        total, words = self.bias, 0
        for token in _TOKEN.findall(text.lower()):
            if token in _STOPS:
                if words:
                    out.append(total)
                    total, words = self.bias, 0
                    seen.clear()
            else:
                words += 1
                w = known(token)
                if w is None:
                    w = self.weight(token)
                if w and token not in seen:
                    seen.add(token)
                    total += w
        if words:
            out.append(total)
        return out

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The noisy-or of all sentences, and (start, end, score) of those at or above one half."""
        odds = self.odds(text)
        found = {i: 1 / (1 + math.exp(-x)) for i, x in enumerate(odds) if x >= 0}
        spans = [(*span, found[i]) for i, span in enumerate(sentence_spans(text)) if i in found] if found else []
        return -math.expm1(-sum(map(_softplus, odds))), spans


def sentence_spans(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of every sentence with a word."""
    start = end = None
    for m in _TOKEN.finditer(text):
        if m.group() not in _STOPS:
            start, end = m.start() if start is None else start, m.end()
        elif start is not None:
            yield start, end
            start = None
    if start is not None:
        yield start, end


def _softplus(x: float) -> float:
    return max(x, 0.0) + math.log1p(math.exp(-abs(x)))


def fit(
    bags: list[list[list[int]]], labels: np.ndarray, n_features: int, steps: int = 400, l2: float = 1e-4, plain: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Weights and bias that make the noisy-or of each bag's sentences likely for its label (Adam on the whole set).

    ``plain`` says how many sentences without any feature each bag has besides.
    """
    bag, flat, sizes = [], [], []
    for b, sentences in enumerate(bags):
        for s in sentences:
            bag.append(b)
            sizes.append(len(s))
            flat += s
    bag, flat = np.array(bag, np.int64), np.array(flat, np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    n, y = max(len(bags), 1), labels.astype(float)
    plain = np.zeros(len(bags)) if plain is None else plain.astype(float)
    w, b = np.zeros(n_features), -5.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(row, w[flat], len(sizes))
        p = 1 / (1 + np.exp(-z))
        clean = np.bincount(bag, np.logaddexp(0, z), len(bags)) + plain * np.logaddexp(0, b)  # -log of the chance that no sentence is toxic
        toxic = np.maximum(-np.expm1(-clean), 1e-9)
        # d loss / d z of a sentence: p for a clean document, -p (1 - toxic) / toxic for a toxic one
        sign = np.where(y == 1, -(1 - toxic) / toxic, 1.0)
        slope = p * sign[bag] / n
        of_plain = (plain * sign).sum() / (1 + np.exp(-b)) / n
        g = np.append(np.bincount(flat, slope[row], n_features) + l2 * w, slope.sum() + of_plain)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - d[:-1], b - d[-1]
    return w, float(b)


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = MAX_TRAINING_DOCS,
    max_features: int = MAX_FEATURES,
    text: str = "text",
) -> Model:
    """A model from labels (doc_id, toxic), fitted on at most ``max_docs`` labelled documents.

    Features are chosen by how far their share of toxic documents is from the overall one, counted
    by Spark; only ids of chosen ones, sentence by sentence, reach the driver. Labels other than
    0 and 1 and null ids are passed over; of contradicting labels the largest counts; of rows with the same id
    each one counts. Without labels of both kinds the model gives every document the same small score.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(max_docs)
    # Bounded by max_docs rows of an id and a label.
    texts = docs.select("doc_id", F.col(text).alias("text")).where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\w+)"), F.lit(1)))
    lengths = F.array(*map(F.lit, PREFIXES))
    stems = F.flatten(F.transform(found, lambda w: F.transform(F.filter(lengths, lambda n: n <= F.char_length(w)), lambda n: F.concat(F.lit("^"), F.left(w, n)))))
    whole = F.transform(found, lambda w: F.concat(F.lit("="), w))
    tokens = texts.select("toxic", F.explode(F.array_distinct(F.concat(whole, stems))).alias("word"))
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n, n_toxic = sum(totals.values()), totals.get(1, 0)
    if not 0 < n_toxic < n:
        return Model({}, -5.0)
    rate = n_toxic / n
    counted = tokens.groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("k")).where(F.col("n") >= LEAST_DOCS)
    excess = F.abs(F.col("k") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    chosen = counted.where(excess >= LEAST_Z).orderBy(excess.desc(), "word").limit(max_features).select("word")
    vocabulary = {r["word"]: i for i, r in enumerate(chosen.collect())}

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column("text").to_pylist():
                sentences: list[set[str]] = [set()]
                for t in _TOKEN.findall(x.lower()):
                    if t in _STOPS:
                        sentences.append(set())
                    else:
                        sentences[-1].add(t)
                ids = [[vocabulary[f] for w in sorted(s) for f in features(w) if f in vocabulary] for s in sentences if s]
                out.append({"plain": sum(not s for s in ids), "ids": [s for s in ids if s]})
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), "bag": pa.array(out, BAG)})

    schema = "toxic int, bag struct<plain:int,ids:array<array<int>>>"
    got = mapped(texts.select(F.col("toxic").cast("int").alias("toxic"), "text"), bags, schema).toPandas()
    y = got["toxic"].to_numpy()
    # Sentences without a chosen feature have the bias alone, so their number is enough.
    w, b = fit([[list(s) for s in x["ids"]] for x in got["bag"]], y, len(vocabulary), plain=np.array([x["plain"] for x in got["bag"]]))
    return Model({t: float(w[i]) for t, i in vocabulary.items() if abs(w[i]) > 0.01}, b)


BAG = pa.struct([("plain", pa.int32()), ("ids", pa.list_(pa.list_(pa.int32())))])


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with ``toxicity`` (0 to 1) and ``offending``, the spans of sentences at or above one half.

    A null or empty text has no sentence, so its score is 0. Columns of these names are replaced.
    """
    kept_fields = [f for f in docs.schema.fields if f.name not in ("toxicity", "offending")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scored = [model.score(x or "") for x in batch.column(text).to_pylist()]
            found = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in s] for _, s in scored], SPANS)
            cols = [batch.column(f.name) for f in kept_fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([s for s, _ in scored], pa.float64()), found], [*(f.name for f in kept_fields), "toxicity", "offending"])

    schema = T.StructType([*kept_fields, T.StructField("toxicity", T.DoubleType()), T.StructField("offending", SENTENCES)])
    return mapped(docs, run, schema)


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def held_out(doc_id: str = "doc_id"):
    """Rows kept from training; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def contract_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return train(docs, table(spark, sf_dir, "labels").where(~held_out()))


def op2_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, contract_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").alias("n_offending"),
    )


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that are more likely clean than toxic."""
    scored = score(packed(docs, "text"), contract_model(spark, docs, sf_dir))
    return unpacked(scored.where(F.col("toxicity") < 0.5), docs.columns)
