"""Near copies: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, linked into groups.

Candidates share a band: five minima of the shingles under as many hash
functions. There are ``BANDS`` of them, so a pair of similarity s is missed with a
probability of (1 - s^5)^40: one in eight million at 0.8, less above it, while
texts that share one passage hardly ever meet. Texts whose SimHash fingerprints
are linked by their Golay codewords (see ``simhash``) share one more band, however
the minima fall. Nothing is capped, and how often a shingle occurs does not matter.

Every band links its texts to one of them, its center: the text that meets the
most others, which for edited copies is the one closest to their original. Both
texts are brought together (compressed) and compared as whole sets, so a link is
exact, and what a text lacks of its center (how many shingles) and has beyond it
(which ones) is known from then on.

Two texts with the same center that are still in different groups are decided by
that. What they lack and have beyond it bounds from below how much they differ,
unless they share shingles that the center has not; the few pairs that do, or
that stay within the bound, are compared as whole sets too. So texts that all
resemble one another, but too little, do not make all their pairs. Equal sets are
one node from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.simhash import SEED, connected, fingerprint, first_rows, rooted
from lumbung.llm.tables import checkpointed, ids_and_texts

SHINGLE_WORDS = 5
# Similarity as a fraction, so that bounds are whole numbers.
LEAST, OUT_OF = 4, 5
BANDS, MINIMA = 40, 5
SHINGLES_AT_ONCE = 1 << 10


def fixed_numbers(count: int, label: str) -> np.ndarray:
    """The same 64-bit numbers on every machine."""
    return np.array([xxhash.xxh64_intdigest(f"{label} {i}", SEED) for i in range(count)], np.uint64)


FLIPS = fixed_numbers(BANDS * MINIMA, "flip").astype(np.uint32)[:, None]
FACTORS = fixed_numbers(BANDS * MINIMA, "factor").astype(np.uint32)[:, None] | np.uint32(1)
BAND_STARTS = fixed_numbers(BANDS, "band")
MIX, MIX_LONG = np.uint32(fixed_numbers(1, "mix")[0] & 0xFFFFFFFF | 1), fixed_numbers(1, "mix long")[0] | np.uint64(1)


def shingles_of(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than a shingle has are one, no words are none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    width = min(len(words), SHINGLE_WORDS)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, len(words) - width + 1))


def bands_of(found: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; an empty set has none."""
    if not len(found):
        return np.empty(0, np.uint64)
    low = found.astype(np.uint32)
    minima = np.full(BANDS * MINIMA, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), SHINGLES_AT_ONCE):
        mixed = (low[start : start + SHINGLES_AT_ONCE] ^ FLIPS) * FACTORS
        mixed ^= mixed >> np.uint32(15)
        mixed *= MIX
        minima = np.minimum(minima, mixed.min(1))
    keys = BAND_STARTS.copy()
    for column in minima.reshape(BANDS, MINIMA).T:
        keys = (keys ^ column) * MIX_LONG
        keys ^= keys >> np.uint64(29)
    return keys


DESCRIBED = T.StructType().add("key", T.LongType()).add("size", T.IntegerType()).add("bands", T.ArrayType(T.LongType()))


@F.arrow_udf(DESCRIBED)
def described(texts: pa.Array) -> pa.Array:
    """Key of a text's set, its size and its bands."""
    keys, sizes, bands = [], [], []
    for text in texts.cast(pa.binary()).to_pylist():
        found = shingles_of(text)
        keys.append(xxhash.xxh64_intdigest(found.astype("<u8").tobytes(), SEED))
        sizes.append(len(found))
        bands.append(bands_of(found).view(np.int64))
    columns = [pa.array(np.array(keys, np.uint64).view(np.int64)), pa.array(sizes, pa.int32()), pa.array(bands, pa.list_(pa.int64()))]
    return pa.StructArray.from_arrays(columns, ["key", "size", "bands"])


@F.arrow_udf(T.BinaryType())
def packed(texts: pa.Array) -> pa.Array:
    """Compressed texts, a third of the bytes that their sets would take."""
    pack = zstandard.ZstdCompressor().compress
    return pa.array([pack(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


COMPARED = T.StructType().add("lacks", T.IntegerType()).add("beyond", T.ArrayType(T.LongType()))


@F.arrow_udf(COMPARED)
def compared(centers: pa.Array, texts: pa.Array) -> pa.Array:
    """How many of its center's shingles a packed text lacks, and which ones it has beyond them."""
    unpack = zstandard.ZstdDecompressor().decompress
    lacks, beyond, before, of_center = [], [], None, None
    for center, text in zip(centers.to_pylist(), texts.to_pylist()):
        if center != before:  # pairs of one center often follow each other
            before, of_center = center, shingles_of(unpack(center))
        found = shingles_of(unpack(text))
        own = np.setdiff1d(found, of_center, True)
        lacks.append(len(of_center) - (len(found) - len(own)))
        beyond.append(own.view(np.int64))
    return pa.StructArray.from_arrays([pa.array(lacks, pa.int32()), pa.array(beyond, pa.list_(pa.int64()))], ["lacks", "beyond"])


def id_and_hash(doc_id: str, text_hash: Column) -> list[Column]:
    """What picks a text again: its id, or zero where there is none, and its hash."""
    return [F.coalesce(doc_id, F.lit(0).cast("long")).alias("id"), text_hash.alias("text_hash")]


def similar_sets() -> Column:
    """Of a pair compared by ``lacks`` and ``beyond``: what differs is no more than similar sets of these sizes can."""
    return OUT_OF * (F.col("lacks") + F.size("beyond")) <= (OUT_OF - LEAST) * (F.col("center_size") + F.size("beyond"))


def comparisons(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """center, key, size, center_size, lacks, beyond for distinct pairs (center, key) of keys."""
    keys = pairs.select(F.explode(F.array("center", "key")).alias("key")).distinct()
    # The first text of each key; repeated rows of it are one again.
    wanted = checkpointed(nodes.join(keys, "key", "left_semi").select("key", "size", *id_and_hash("first.doc_id", F.col("first.text_hash"))))
    rows = texts.select(*id_and_hash("doc_id", F.xxhash64("text")), packed("text").alias("packed"))
    found = rows.join(wanted, ["id", "text_hash"]).groupBy("key").agg(F.any_value("packed").alias("packed"), F.any_value("size").alias("size"))
    found = checkpointed(found)
    centers = found.select(F.col("key").alias("center"), F.col("packed").alias("of_center"), F.col("size").alias("center_size"))
    both = pairs.join(found, "key").join(centers, "center")
    both = both.select("center", "key", "size", "center_size", compared("of_center", "packed").alias("c"))
    return both.select("center", "key", "size", "center_size", "c.lacks", "c.beyond")


def fingerprint_bands(marked: DataFrame) -> DataFrame:
    """Distinct (key, band): one band per group of fingerprints that are linked at two or fewer differing bits."""
    groups = rooted(marked).select("fingerprint", F.xxhash64(F.lit("fingerprint"), "root").alias("band"))
    return marked.select("key", "fingerprint").distinct().join(groups, "fingerprint").select("key", "band").distinct()


def centered(nodes: DataFrame, further: DataFrame | None = None) -> DataFrame:
    """Distinct pairs (center, key): every text with the centers of its bands, its own and ``further`` ones (key, band)."""
    banded = nodes.select("key", F.explode("bands").alias("band"))
    if further is not None:
        banded = banded.unionByName(further)
    # Most bands have one text and go at once; the others are few enough to be broadcast, or are joined.
    met = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met = checkpointed(banded.join(met, "band"))
    meetings = met.groupBy("key").agg(F.sum("n").alias("meetings"))
    centers = met.join(meetings, "key").groupBy("band").agg(F.max(F.struct("meetings", "key")).alias("most"))
    pairs = met.join(centers.select("band", F.col("most.key").alias("center")), "band").select("center", "key")
    return checkpointed(pairs.filter("center != key").distinct())


def undecided(records: DataFrame) -> DataFrame:
    """Pairs (center, key) of texts that have a center in common, are in different groups and may be similar.

    Two texts differ in at least as many shingles as their numbers of missing ones differ by, and in all that they
    have beyond their center, but for those both have.
    """
    roots = connected(records.filter(similar_sets()).select(F.col("center").alias("a"), F.col("key").alias("b")))
    rooted = records.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    border = F.min("root").alias("low"), F.max("root").alias("high")
    open_centers = rooted.groupBy("center").agg(*border).filter("low != high").select("center")
    rooted = checkpointed(rooted.join(open_centers, "center").withColumn("own", F.size("beyond")))
    facts = ["key", "root", "size", "lacks", "own"]

    def of(side: str, frame: DataFrame, *on: str) -> DataFrame:
        return frame.select("center", *on, *[F.col(c).alias(f"{side}_{c}") for c in frame.columns if c not in ("center", *on)])

    def within(shared: Column) -> Column:
        least = F.col("x_own") + F.col("y_own") - 2 * shared + F.abs(F.col("x_lacks") - F.col("y_lacks"))
        return (LEAST + OUT_OF) * least <= (OUT_OF - LEAST) * (F.col("x_size") + F.col("y_size"))

    # Without a shared shingle beyond the center one of the two, x, is not similar to it; then y is smaller than it.
    apart = of("x", rooted.filter(~similar_sets()).select("center", *facts)).join(
        of("y", rooted.filter("size < center_size").select("center", *facts)), "center"
    )
    apart = apart.filter((F.col("x_root") != F.col("y_root")) & within(F.lit(0))).select("x_key", "y_key")
    tokens = rooted.select("center", *facts, F.explode("beyond").alias("token"))
    # Shingles that the same texts of different groups have, such as those of a passage, count as one with a weight.
    who = F.bit_xor(F.xxhash64("key")).alias("who")
    held = tokens.groupBy("center", "token").agg(*border, F.count("*").alias("n"), who).filter("low != high")
    weights = held.groupBy("center", "who", "n").agg(F.min("token").alias("token"), F.count("*").alias("weight"))
    held = checkpointed(tokens.join(weights.select("center", "token", "weight"), ["center", "token"]))
    # No text shares more with another than all that it shares with any.
    most = held.groupBy("center", "key").agg(F.sum("weight").alias("most"))
    held = held.join(most, ["center", "key"]).select("center", "token", "weight", *facts, "most")
    both = of("x", held, "token", "weight").join(of("y", held.drop("weight"), "token"), ["center", "token"])
    both = both.filter((F.col("x_key") < F.col("y_key")) & (F.col("x_root") != F.col("y_root")) & within(F.least("x_most", "y_most")))
    numbers = [f"{side}_{c}" for side in "xy" for c in ("size", "lacks", "own")]
    sharing = both.groupBy("center", "x_key", "y_key").agg(F.sum("weight").alias("shared"), *[F.any_value(c).alias(c) for c in numbers])
    sharing = sharing.filter(within(F.col("shared"))).select("x_key", "y_key")
    pairs = [p.select(F.greatest("x_key", "y_key").alias("center"), F.least("x_key", "y_key").alias("key")) for p in (apart, sharing)]
    return checkpointed(pairs[0].union(pairs[1]).distinct())


def links(nodes: DataFrame, texts: DataFrame, further: DataFrame | None = None) -> DataFrame:
    """Pairs ``a``, ``b`` of similar sets, enough of them to connect every group."""
    first = checkpointed(comparisons(centered(nodes, further), nodes, texts))
    found = first.unionByName(comparisons(undecided(first), nodes, texts))
    return found.filter(similar_sets()).select(F.col("center").alias("a"), F.col("key").alias("b"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Whole rows, one of each group: the one with the smallest id (null last), then the smallest text hash.

    Null and empty texts and texts of white space are one group. Texts of any length are compared whole; repeated
    rows are one. Columns keep their names and values, whatever they are called. No rows, no rows.
    """
    texts = ids_and_texts(docs)
    marked = texts.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), described("text").alias("set"), fingerprint("text").alias("fingerprint")
    )
    marked = checkpointed(marked.select("doc_id", "text_hash", "fingerprint", "set.*"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    of_set = [F.any_value(c).alias(c) for c in ("size", "bands")]
    nodes = checkpointed(marked.groupBy("key").agg(F.min(order).alias("first"), *of_set))
    roots = connected(links(nodes, texts, fingerprint_bands(marked))).withColumnRenamed("node", "key")
    found = nodes.select("key", "first").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    return first_rows(docs, found)
