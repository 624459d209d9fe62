"""Document fingerprints from statistically improbable byte windows.

Every window of 64 bytes has an entropy. How often each entropy occurs in the
corpus says how improbable a window is; the rarest window of every stretch of 64
windows scores a point, and windows with enough points are a text's features.
Each sets five bits of a Bloom filter; after 160 features the next filter of the
chain begins. Two texts are compared filter by filter: common bits, less what
chance gives, over what is possible.

Entropies of sliding windows come from counting, for each byte, equal bytes among
the 63 before and after it: one comparison of shifted arrays per distance. Texts
of a batch are laid end to end for that, and windows that cross an end are left
out. Those are 63 in a row, so no stretch sees two texts and a text's features
depend on nothing but itself.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import ids_and_texts

WINDOW = 64
LEAST_POINTS = 16
ENTROPIES = 1001  # thousandths of the highest entropy
LEAST_ENTROPY = 100
FILTER_BITS, HASHES, FEATURES_PER_FILTER = 2048, 5, 160
SEGMENT = 1 << 17  # bytes looked at together
NEVER = np.int64(1 << 62)

_counts = np.arange(WINDOW + 1, dtype=np.float64)
_terms = np.round(_counts * np.log2(np.maximum(_counts, 1)) * 65536).astype(np.int64)
STEP = np.diff(_terms)  # what one more equal byte adds to the sum of n log n
HIGHEST = int(_terms[WINDOW])

# ------------------------------------------------------------------ features


def entropies(data: np.ndarray) -> np.ndarray:
    """Entropy in thousandths of the window that starts at each byte but the last 63."""
    before, after = np.zeros(len(data), np.uint8), np.zeros(len(data), np.uint8)
    for distance in range(1, min(WINDOW, len(data))):
        equal = (data[distance:] == data[:-distance]).view(np.uint8)
        before[distance:] += equal
        after[:-distance] += equal
    total = np.cumsum(STEP[before])
    total[WINDOW:] -= np.cumsum(STEP[after[:-WINDOW]])
    return (HIGHEST - total[WINDOW - 1 :]) * (ENTROPIES - 1) // HIGHEST


def laid_out(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end, with room on both sides, and where each text starts and the last one ends."""
    room = bytes(2 * WINDOW)
    starts = np.cumsum([len(room), *map(len, texts)])
    return np.frombuffer(b"".join([room, *texts, room]), np.uint8), starts


def whole_windows(starts: np.ndarray, low: int, high: int) -> np.ndarray:
    """Which positions from low to high start a window inside one text."""
    valid = np.zeros(high - low, np.int32)
    first, last = starts[:-1], np.maximum(starts[1:] - WINDOW + 1, starts[:-1])
    near = (first < high) & (last > low) & (last > first)
    np.add.at(valid, np.clip(first[near] - low, 0, None), 1)
    ends = last[near] - low
    np.add.at(valid, ends[ends < high - low], -1)
    return np.cumsum(valid) > 0


def histogram(texts: Sequence[bytes]) -> np.ndarray:
    """How many windows have each entropy."""
    data, starts = laid_out(texts)
    counts = np.zeros(ENTROPIES, np.int64)
    for low in range(0, len(data) - WINDOW + 1, SEGMENT):
        high = min(low + SEGMENT, len(data) - WINDOW + 1)
        found = entropies(data[low : high + WINDOW - 1])
        counts += np.bincount(found[whole_windows(starts, low, high)], minlength=ENTROPIES)
    return counts


def feature_positions(data: np.ndarray, starts: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Positions of windows that are the rarest (then the first) of enough stretches of 64 windows."""
    chosen = []
    for low in range(WINDOW, len(data) - 2 * WINDOW + 1, SEGMENT):
        high = min(low + SEGMENT, len(data) - 2 * WINDOW + 1)
        left, right = low - WINDOW + 1, high + WINDOW - 1
        rank = ranks[entropies(data[left : right + WINDOW - 1])]
        place = np.arange(right - left, dtype=np.int64)
        key = np.where(whole_windows(starts, left, right) & (rank >= 0), rank << 32 | place, NEVER)
        width = 1
        while width < WINDOW:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        points = np.bincount(key[key != NEVER] & 0xFFFFFFFF, minlength=right - left)
        chosen.append(np.flatnonzero(points[WINDOW - 1 : WINDOW - 1 + high - low] >= LEAST_POINTS) + low)
    return np.concatenate(chosen) if chosen else np.zeros(0, np.int64)


def hashed(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the window at each position."""
    windows = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[positions]
    value = np.full(len(positions), 0x9E3779B97F4A7C15, np.uint64)
    for word in np.ascontiguousarray(windows).view("<u8").T:
        value = (value ^ word) * np.uint64(0xFF51AFD7ED558CCD)
        value ^= value >> np.uint64(32)
    value *= np.uint64(0xC4CEB9FE1A85EC53)
    return value ^ (value >> np.uint64(29))


def fingerprints(texts: Sequence[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Per text its chain of filters, one packed row each. Empty texts have none.

    A text without features (shorter than a window, or of one byte all over) has itself as its only feature.
    """
    data, starts = laid_out(texts)
    positions = feature_positions(data, starts, ranks)
    hashes = hashed(data, positions)
    owner = np.searchsorted(starts, positions, "right") - 1
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    shifts = (11 * np.arange(HASHES)).astype(np.uint64)
    chains = []
    for text, low, high in zip(texts, bounds[:-1], bounds[1:]):
        own = hashes[low:high]
        own = own[np.sort(np.unique(own, return_index=True)[1])]
        if text and not len(own):
            own = np.array([xxhash.xxh64_intdigest(text)], np.uint64)
        filters = -(-len(own) // FEATURES_PER_FILTER)
        bits = np.zeros((filters, FILTER_BITS), np.uint8)
        places = (own[:, None] >> shifts & np.uint64(FILTER_BITS - 1)).astype(np.int64)
        bits[np.arange(len(own))[:, None] // FEATURES_PER_FILTER, places] = 1
        chains.append(np.packbits(bits, axis=1))
    return chains


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: how well the filters of one chain are found in the other, weighed by their bits.

    The shorter chain is looked up in the longer; of equal lengths, both ways.
    """
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    x, y = a.view(np.uint64), b.view(np.uint64)
    bits_x, bits_y = np.bitwise_count(x).sum(1, dtype=np.int64), np.bitwise_count(y).sum(1, dtype=np.int64)
    common = np.stack([np.bitwise_count(row & y).sum(1, dtype=np.int64) for row in x])
    chance = bits_x[:, None] * bits_y / FILTER_BITS
    possible = np.maximum(np.minimum(bits_x[:, None], bits_y) - chance, 1.0)
    score = np.clip((common - chance) / possible, 0.0, 1.0)
    ways = []
    if len(a) <= len(b):
        ways.append((score.max(1) * bits_x).sum() / bits_x.sum())
    if len(b) <= len(a):
        ways.append((score.max(0) * bits_y).sum() / bits_y.sum())
    return float(sum(ways) / len(ways))


def as_text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


# ------------------------------------------------------------------ on Spark


def rarity_ranks(docs: DataFrame) -> np.ndarray:
    """Rank of each entropy over all windows of all documents, rarest first; -1 below the least entropy."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ENTROPIES, np.int64)
        for batch in batches:
            total += histogram(batch.column("text").cast(pa.binary()).to_pylist())
        filled = np.flatnonzero(total)
        yield pa.record_batch({"entropy": pa.array(filled, pa.int32()), "n": pa.array(total[filled], pa.int64())})

    counted = ids_and_texts(docs).select("text").mapInArrow(count, "entropy int, n long")
    counts = np.zeros(ENTROPIES, np.int64)
    for row in counted.groupBy("entropy").agg(F.sum("n").alias("n")).collect():  # 1001 rows at most
        counts[row["entropy"]] = row["n"]
    ranks = np.empty(ENTROPIES, np.int64)
    ranks[np.lexsort((np.arange(ENTROPIES), counts))] = np.arange(ENTROPIES)
    ranks[:LEAST_ENTROPY] = -1
    return ranks


# Rows of a range of ids that one task sorts, and a limit to the list of ranges; beyond it ranges get longer.
ROWS_PER_RANGE = 1_000
MOST_RANGES = 100_000
SAMPLES_PER_RANGE = 10


def with_order(docs: DataFrame) -> DataFrame:
    """doc_id and text with what they are ordered by: ids ascending, null last, equal ids by a hash of the text."""
    return ids_and_texts(docs).select(
        F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash")).alias("place"),
        "text",
    )


def range_starts(ordered: DataFrame) -> list[tuple]:
    """Places of existing rows, the first one of all included, that cut the rows into ranges of about equal length."""
    rows = ordered.count()
    ranges = min(max(1, rows // ROWS_PER_RANGE), MOST_RANGES)
    fraction = min(1.0, SAMPLES_PER_RANGE * ranges / max(rows, 1))
    first = ordered.agg(F.min("place").alias("place")).first()["place"]
    if first is None:
        return []
    sample = ordered.select("place.*").sample(fraction, seed=7).collect() if ranges > 1 else []
    sample = sorted({key(row) for row in sample})
    step = max(1, len(sample) // ranges)
    return sorted({key(first), *sample[step::step]})


def key(place) -> tuple:
    return (place["none"], place["doc_id"] or 0, place["hash"])


def next_to_each_other(docs: DataFrame) -> DataFrame:
    """Rows by range, each range sorted and closed by a copy of the next range's first row (``borrowed``).

    After the last range comes the first again.
    """
    ordered = with_order(docs)
    starts = range_starts(ordered)
    at = {start: i for i, start in enumerate(starts)}

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ranges_of(places: pa.Array) -> pa.Array:
        out = []
        for place in places.to_pylist():
            mine = bisect_right(starts, key(place)) - 1
            out.append([mine, (mine - 1) % len(starts)] if key(place) in at else [mine])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = ordered.select("place", "text", F.posexplode(ranges_of("place")).alias("borrowed", "range"))
    return (
        dealt.select("range", F.col("borrowed") == 1, "place", "text")
        .toDF("range", "borrowed", "place", "text")
        .repartition("range")
        .sortWithinPartitions("range", "borrowed", "place")
    )


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = (
    "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def digests(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its text edited with the next document's, and how near it is
    to that one and to the next document's.

    Null texts are empty; rows without an id come last. A document alone is its own next one. Repeated rows follow
    each other. Empty texts have an empty fingerprint, which is like other empty ones and unlike the rest.
    """
    ranks = rarity_ranks(docs)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, with its fingerprint; its next one has not come yet
        for batch in batches:
            new = batch.select(["range", "borrowed", "place", "text"]).to_pylist()
            prints = fingerprints([row["text"].encode() for row in new], ranks)
            rows = [held] if held else []
            rows += zip(new, prints)
            pairs = [
                (row, chain, following, other)
                for (row, chain), (following, other) in zip(rows, rows[1:])
                if row["range"] == following["range"] and not row["borrowed"]
            ]
            held = rows[-1] if rows else None
            changed = [edited(row["text"], following["text"]) for row, _, following, _ in pairs]
            others = fingerprints([text.encode() for text in changed], ranks)
            yield pa.record_batch(
                {
                    "doc_id": pa.array([row["place"]["doc_id"] for row, *_ in pairs], pa.int64()),
                    "n_chars": pa.array([len(row["text"]) for row, *_ in pairs], pa.int64()),
                    "edited_text": pa.array(changed, pa.string()),
                    "fingerprint": pa.array([as_text(chain) for _, chain, *_ in pairs], pa.string()),
                    "edited_fingerprint": pa.array(map(as_text, others), pa.string()),
                    "near_edited": pa.array([likeness(p[1], e) for p, e in zip(pairs, others)], pa.float64()),
                    "near_next": pa.array([likeness(p[1], p[3]) for p in pairs], pa.float64()),
                }
            )

    return next_to_each_other(docs).mapInArrow(compare, COLUMNS)
