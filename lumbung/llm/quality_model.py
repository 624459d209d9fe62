"""Quality by a logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Words are runs of letters and digits, and runs of other signs. A text's single
words and pairs of neighbours are hashed to ``BUCKETS`` places and counted, and
the counts divided by their length as a vector; a pair of equal words is one
n-gram of its own, whichever word it is. A score is the sparse dot product with
the weights, which are mostly zero, so only those that are not travel to the
tasks.

Training takes a bounded number of labelled rows (``TRAIN_ROWS``), dealt into
``PARTS`` parts by a hash of their ids. In each of ``EPOCHS`` rounds every part
goes through its rows from the state all have agreed on, one update per row, and
the changes are averaged on the executors. The driver sees one number pair per
bucket, never a row.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import checkpointed, ids_and_texts, named

TRAIN_ROWS = 12_000
PARTS, EPOCHS = 4, 6
BUCKETS = 1 << 18
BIAS = BUCKETS  # one more place, always on
# The learner's step size and its penalties on the sum of the weights and of their squares.
STEP, SMOOTHING, L1, L2 = 2.0, 1.0, 0.1, 0.1
THRESHOLD = 0.5
FOLDS, HELD_OUT_FOLD = 3, 1

WORD = re.compile(r"\w+|[^\w\s]+")
REPEATED = "\n"  # stands for any pair of equal words; no word has a line break


def bucket(gram: str) -> int:
    return xxhash.xxh32_intdigest(gram) % BUCKETS


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their values; a text without words has none."""
    words = WORD.findall(text)
    found: dict[int, int] = {}
    for gram, n in Counter(words).items():
        place = bucket(gram)
        found[place] = found.get(place, 0) + n
    for (a, b), n in Counter(zip(words, words[1:])).items():
        place = bucket(REPEATED if a == b else f"{a} {b}")
        found[place] = found.get(place, 0) + n
    places = np.fromiter(sorted(found), np.int32, len(found))
    values = np.array([found[place] for place in places], float)
    return places, values / max(np.sqrt(values @ values), 1.0)


def weights(pull: np.ndarray, square: np.ndarray) -> np.ndarray:
    """The regularised leader: zero where the summed gradients ``pull`` stay within L1."""
    beyond = np.maximum(np.abs(pull) - L1, 0.0)
    return -np.sign(pull) * beyond / ((SMOOTHING + np.sqrt(square)) / STEP + L2)


def sigmoid(total: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(total, -500.0, 500.0))))


def learn(pull: np.ndarray, square: np.ndarray, places: np.ndarray, values: np.ndarray, label: int) -> None:
    """One row's update, in place; ``places`` include the bias."""
    old_pull, old_square = pull[places], square[places]
    old_weights = weights(old_pull, old_square)
    gradient = (sigmoid(old_weights @ values) - label) * values
    new_square = old_square + gradient**2
    pull[places] = old_pull + gradient - (np.sqrt(new_square) - np.sqrt(old_square)) / STEP * old_weights
    square[places] = new_square


@dataclass(frozen=True)
class Model:
    """The weights that are not zero: ``places`` ascending, the bias apart."""

    places: np.ndarray
    values: np.ndarray
    bias: float

    def score(self, text: str) -> float:
        places, values = features(text)
        if not len(self.places) or not len(places):
            return sigmoid(self.bias)
        at = np.minimum(np.searchsorted(self.places, places), len(self.places) - 1)
        known = np.where(self.places[at] == places, self.values[at], 0.0)
        return sigmoid(known @ values + self.bias)


def held_out() -> Column:
    """A third of the ids, kept from training; rows without an id are not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))


FEATURES = T.StructType().add("places", T.ArrayType(T.IntegerType())).add("values", T.ArrayType(T.DoubleType()))


@F.arrow_udf(FEATURES)
def hashed(texts: pa.Array) -> pa.Array:
    found = [features(t) for t in texts.to_pylist()]
    return pa.array([{"places": p, "values": v} for p, v in found], pa.struct([("places", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))]))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """part, turn, label, places, values of at most ``rows`` labelled documents, chosen by a hash of their ids.

    An id labelled twice has its larger label; of rows with the same id the one with the smallest text hash counts.
    """
    marked = labels.select(named("doc_id").cast("long").alias("doc_id"), named("quality").cast("int").alias("label"))
    marked = marked.filter("doc_id IS NOT NULL AND label IN (0, 1)").filter(~held_out())
    chosen = marked.groupBy("doc_id").agg(F.max("label").alias("label"))
    turn = F.xxhash64("doc_id", F.lit("quality"))
    chosen = chosen.orderBy(turn, "doc_id").limit(rows)
    texts = ids_and_texts(docs).join(F.broadcast(chosen), "doc_id")  # ``rows`` rows at most are broadcast
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    texts = texts.groupBy("doc_id", "label").agg(first)
    return texts.select(
        F.pmod(turn, F.lit(PARTS)).cast("int").alias("part"), turn.alias("turn"), "doc_id", "label", hashed("first.text").alias("x")
    )


def rounds(sample: DataFrame, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Averaged state of all parts after so many rounds."""
    context = sample.sparkSession.sparkContext
    dealt = checkpointed(sample.repartition(PARTS, "part").sortWithinPartitions("part", "turn", "doc_id"))
    pull, square = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    changes = T.StructType().add("place", T.IntegerType()).add("pull", T.DoubleType()).add("square", T.DoubleType())
    for _ in range(epochs):
        state = context.broadcast((pull, square))

        def one_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # A task may hold several parts; each starts from the agreed state.
            part, mine = None, None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["part"] != part:
                        if mine:
                            yield changed(mine, state.value)
                        part, mine = row["part"], tuple(a.copy() for a in state.value)
                    places = np.append(np.array(row["x"]["places"], np.int64), BIAS)
                    learn(*mine, places, np.append(row["x"]["values"], 1.0), row["label"])
            if mine:
                yield changed(mine, state.value)

        moved = dealt.mapInArrow(one_round, changes).groupBy("place").agg(F.sum("pull").alias("pull"), F.sum("square").alias("square"))
        found = moved.toArrow()  # one row per bucket at most
        at = found["place"].to_numpy()
        pull[at] += found["pull"].to_numpy() / PARTS
        square[at] += found["square"].to_numpy() / PARTS
        state.unpersist()
    return pull, square


def changed(mine: tuple[np.ndarray, np.ndarray], before: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    at = np.flatnonzero((mine[0] != before[0]) | (mine[1] != before[1])).astype(np.int32)
    columns = [pa.array(at), *(pa.array(new[at] - old[at]) for new, old in zip(mine, before))]
    return pa.RecordBatch.from_arrays(columns, ["place", "pull", "square"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, epochs: int = EPOCHS) -> Model:
    """Learn from at most ``rows`` labelled documents that are not held out. Without any, all scores are one half."""
    learnt = weights(*rounds(training_rows(docs, labels, rows), epochs))
    places = np.flatnonzero(learnt[:BUCKETS])
    return Model(places.astype(np.int32), learnt[places], float(learnt[BIAS]))


def score(text: str | Column, model: Model) -> Column:
    @F.arrow_udf(T.DoubleType())
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(map(model.score, texts.to_pylist()), pa.float64())

    return scored(text)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Null and empty texts and texts of white space get the score of the bias alone. Texts of any length are scored
    whole, equal texts equally, repeated rows come out repeated. Other columns are not looked at, whatever their names.
    """
    model = train(docs, labels)
    scored = ids_and_texts(docs).select("doc_id", held_out().alias("held_out"), score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
