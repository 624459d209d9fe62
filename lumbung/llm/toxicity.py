"""Toxicity by a counterfactually regularised classifier.

A logistic regression over words and word beginnings of a text. Where a sentence
of the labelled texts names a group, it is written again with another group of
the same kind, and training penalises the square of the score's change. What a
text says about a group then counts, which group it is does not.

Labels are learnt from a bounded number of labelled rows (``TRAIN_ROWS``); the
model has a bounded number of features (``MOST_FEATURES``). Both are parameters
of ``train``, and so is the weight of the penalty. What all swaps ask of the
weights is summed up on the executors, to one number per pair of features. Texts
of any length are scored whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import checkpointed, ids_and_texts, named, whole_rows

TRAIN_ROWS = 8_000
MOST_FEATURES = 1_000
LEAST_ROWS, LEAST_SURPRISE = 3, 12.0  # rows with a feature; its log-likelihood ratio against chance
THRESHOLD = 0.3
FOLDS, HELD_OUT_FOLD = 4, 2
RIDGE, FAIRNESS = 0.02, 50.0  # weights of the penalties on weights and on changes of the score
STEPS = 400
BEGINNINGS = (4, 5)

# Names of groups, by kind: any one can stand where another of its kind does.
GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("black", "white", "asian", "latino"), ("africans", "europeans", "asians", "americans"),
    ("immigrants", "natives"), ("foreigners", "locals"), ("blind", "deaf", "disabled"), ("old", "young"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("ausländer", "einheimische"),
    ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"), ("étrangers", "habitants"),
    ("mujeres", "hombres"), ("cristianos", "musulmanes", "judíos"), ("extranjeros", "vecinos"),
)
OTHERS = {term: [other for other in group if other != term] for group in GROUPS for term in group}

WORD = re.compile(r"[^\W\d_]+")
SENTENCE = re.compile(r"[^.!?\n]+")
GROUP_NAME = re.compile(r"\b(?:" + "|".join(sorted(OTHERS, key=len, reverse=True)) + r")\b")


def parts(words: set[str]) -> set[str]:
    """Words, and the beginnings of longer ones (marked by a star)."""
    found = set(words)
    for size in BEGINNINGS:
        found |= {word[:size] + "*" for word in words if len(word) > size}
    return found


def parts_of(text: str) -> set[str]:
    return parts(set(WORD.findall(text.lower())))


def swaps_of(text: str) -> set[tuple[str, str]]:
    """What a sentence loses and gains when it names another group; equal changes count once in a text.

    A part that a sentence has anyway does not change, so the rest of the sentence matters.
    """
    found = set()
    lowered = text.lower()
    if not GROUP_NAME.search(lowered):
        return found
    for sentence in SENTENCE.findall(lowered):
        here = parts_of(sentence) if GROUP_NAME.search(sentence) else set()
        for term in set(GROUP_NAME.findall(sentence)):
            for other in OTHERS[term]:
                there = parts_of(re.sub(rf"\b{term}\b", other, sentence))
                found.add((" ".join(sorted(here - there)), " ".join(sorted(there - here))))
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    intercept: float

    def score(self, text: str) -> float:
        weight = self.weights.get
        total = self.intercept + math.fsum(w for w in map(weight, parts_of(text)) if w is not None)
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, total))))


def surprise(total: int, positive: int) -> Column:
    """Log-likelihood ratio of a part's share of positive rows against that of all, from ``rows`` and ``hits``."""
    rows, hits, rate = F.col("rows"), F.col("hits"), positive / total

    def against(found: Column, expected: Column) -> Column:
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    others = F.lit(total) - rows
    inside = against(hits, rows * rate) + against(rows - hits, rows * (1 - rate))
    outside = against(positive - hits, others * rate) + against(others - positive + hits, others * (1 - rate))
    return 2 * (inside + outside)


def swing_of(changes: DataFrame, kept: list[str]) -> np.ndarray:
    """Mean product of what distinct ``changes`` (gone, come) do to each pair of features, of those that do anything.

    Every task sums its own; a pair of features is one row in the end, so the driver gets a bounded matrix.
    """
    column = {name: k for k, name in enumerate(kept)}

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, acting = np.zeros((len(kept), len(kept))), 0
        for batch in batches:
            for gone, come in zip(batch.column("gone").to_pylist(), batch.column("come").to_pylist()):
                moves = Counter(column[word] for word in come.split() if word in column)
                moves.subtract(column[word] for word in gone.split() if word in column)
                at = [k for k, by in moves.items() if by]
                total[np.ix_(at, at)] += np.outer([moves[k] for k in at], [moves[k] for k in at])
                acting += bool(at)
        i, j = total.nonzero()
        columns = [np.append(i, -1), np.append(j, -1), np.append(total[i, j], float(acting))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "value"])

    found = changes.mapInArrow(summed, "i long, j long, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (found[c].to_numpy() for c in ("i", "j", "value"))
    swing, inside = np.zeros((len(kept), len(kept)), np.float32), i >= 0
    swing[i[inside], j[inside]] = value[inside]
    return swing / max(value[~inside].sum(), 1)


def fit(kept: list[str], features: list[list[str]], labels: np.ndarray, swing: np.ndarray, fairness: float = FAIRNESS) -> Model:
    """Weights of the parts in ``kept``, which the rows' ``features`` are taken from."""
    total, positive = len(labels), int(labels.sum())
    intercept = math.log((positive + 1) / (total - positive + 1))
    if not kept or not 0 < positive < total:
        return Model({}, intercept)
    column = {name: k for k, name in enumerate(kept)}
    x = np.zeros((total, len(kept)), np.float32)
    for row, found in enumerate(features):
        x[row, [column[name] for name in found]] = 1.0
    # Accelerated gradient descent; the step follows from a bound on the curvature.
    y, w, b = labels.astype(np.float32), np.zeros(len(kept), np.float32), np.float32(intercept)
    steepest = 0.25 * float(np.linalg.norm(x.T @ x / total, 1)) + 0.25 + RIDGE / total
    rate = 1.0 / (steepest + fairness * float(np.abs(swing).sum(1).max(initial=0.0)))
    w_ahead, b_ahead = w, b
    for step in range(STEPS):
        error = 1.0 / (1.0 + np.exp(-np.clip(x @ w_ahead + b_ahead, -60, 60))) - y
        slope = x.T @ error / total + RIDGE / total * w_ahead + fairness * (swing @ w_ahead)
        new_w, new_b = w_ahead - rate * slope, b_ahead - rate * error.mean()
        push = step / (step + 3.0)
        w_ahead, b_ahead = new_w + push * (new_w - w), new_b + push * (new_b - b)
        w, b = new_w, new_b
    return Model({name: float(w[k]) for name, k in column.items()}, float(b))


def held_out() -> Column:
    """A quarter of the ids, kept from training; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_features: int = MOST_FEATURES, fairness: float = FAIRNESS
) -> Model:
    """Learn from at most ``rows`` labelled documents, chosen by a hash of their ids."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def features(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(parts_of(t)) for t in texts.to_pylist()], pa.list_(pa.string()))

    @F.arrow_udf(T.ArrayType(T.ArrayType(T.StringType())))
    def swaps(texts: pa.Array) -> pa.Array:
        return pa.array([sorted(swaps_of(t)) for t in texts.to_pylist()], pa.list_(pa.list_(pa.string())))

    marked = labels.select(named("doc_id").cast("long").alias("doc_id"), named("toxic").cast("int").alias("toxic"))
    marked = marked.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out())
    chosen = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id", F.lit("train")), "doc_id").limit(rows)
    texts = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id")
    # Repeated rows of an id are one, the one with the smallest text hash, in every task before the shuffle.
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    texts = texts.groupBy("doc_id", "toxic").agg(first).select("doc_id", "toxic", "first.text")  # ``rows`` rows at most
    sample = checkpointed(texts.select("doc_id", "toxic", features("text").alias("parts"), swaps("text").alias("swaps")))
    total, positive = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    kept: list[str] = []
    if 0 < positive < total:
        # Parts are counted where they are; only those that tell something come to the driver.
        counted = sample.select("toxic", F.explode("parts").alias("part")).groupBy("part")
        counted = counted.agg(F.count("*").alias("rows"), F.sum("toxic").alias("hits")).filter(F.col("rows") >= LEAST_ROWS)
        telling = counted.withColumn("surprise", surprise(total, positive)).filter(F.col("surprise") >= LEAST_SURPRISE)
        best = telling.orderBy(F.col("surprise").desc(), "part").limit(most_features)
        kept = [row["part"] for row in best.collect()]
    known = F.array(*map(F.lit, kept)).cast("array<string>")
    found = sample.select("doc_id", "toxic", F.array_intersect("parts", known).alias("parts")).collect()
    found.sort(key=lambda row: (row["doc_id"], row["toxic"], row["parts"]))
    changes = sample.select(F.explode("swaps").alias("change"))
    changes = changes.select(F.get("change", 0).alias("gone"), F.get("change", 1).alias("come")).distinct()
    swing = swing_of(changes, kept) if kept else np.zeros((0, 0), np.float32)
    return fit(kept, [row["parts"] for row in found], np.array([row["toxic"] for row in found], float), swing, fairness)


def score(text: str | Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(map(model.score, texts.to_pylist()), pa.float64())

    return scored(text)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and empty texts get the score of a text without words. Rows with the same text have the same score.
    Without labels of both kinds every score is the share of toxic rows (one of each added).
    """
    model = train(docs, labels)
    scored = ids_and_texts(docs).select("doc_id", held_out().alias("held_out"), score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Whole rows that are not predicted toxic.

    Null and empty texts have the score of a text without words, texts of any length are scored whole. Repeated rows
    stay or go together, other columns are kept whatever their names. No rows, no rows.
    """
    model = train(docs, labels)
    return whole_rows(docs).filter(score("text", model) < THRESHOLD).select("row.*")
