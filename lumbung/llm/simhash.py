"""SimHash near-duplicates by Golay-code fuzzy hashing.

A text's fingerprint has 64 bits. It is cut into three segments. If two
fingerprints differ in at most two bits, then one of them has a segment without
errors while the next segment (in a circle) has at most one:

    errors in (A, B, C)         no error, then at most one
    (0,1,1) (0,0,2) ...         A, then B
    (1,0,1) (2,0,0) ...         B, then C
    (1,1,0) (0,2,0) ...         C, then A

A key is the error-free segment with one of the codeword indices of the next
segment (see ``golay``): three families of at most six keys. Equal keys make a
candidate, the count of differing bits decides. Copies are one fingerprint
before any key is made, so that groups of equal texts cost nothing.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.golay import codeword_indices
from lumbung.llm.tables import checkpointed, ids_and_texts, whole_rows

SHINGLE_WORDS = 3
SEED = 42
MOST_DIFFERING_BITS = 2
# First bit and number of bits of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SHINGLES_AT_ONCE = 1 << 16


def fingerprint_of(text: bytes, width: int = SHINGLE_WORDS) -> int:
    """Lower-case A-Z, words between ASCII white space, shingles with repeats, majority of hash bits."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    total = len(words) - width + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64, total)
    counts = np.zeros(64, np.int64)
    for start in range(0, total, SHINGLES_AT_ONCE):
        part = hashes[start : start + SHINGLES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """The fingerprint as a signed 64-bit number."""
    out = np.fromiter((fingerprint_of(t) for t in texts.cast(pa.binary()).to_pylist()), np.uint64, len(texts))
    return pa.array(out.view(np.int64))


@F.arrow_udf(T.ArrayType(T.LongType()))
def candidate_keys(fingerprints: pa.Array) -> pa.Array:
    values = fingerprints.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    parts = [((values >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64) for at, bits in SEGMENTS]
    keys, masks = [], []
    for family, exact in enumerate(parts):
        index, there = codeword_indices(parts[(family + 1) % len(parts)])
        keys.append(np.int64(family) << 36 | exact[:, None] << 12 | index.astype(np.int64))
        masks.append(there)
    keys, masks = np.hstack(keys), np.hstack(masks)
    offsets = np.concatenate([[0], np.cumsum(masks.sum(1))]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, keys[masks])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash and fingerprint of every row. Null texts count as empty, null ids stay."""
    return ids_and_texts(docs).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), fingerprint("text").alias("fingerprint")
    )


def links(distinct: DataFrame, most_bits: int = MOST_DIFFERING_BITS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints that differ in at most two bits."""
    if most_bits > MOST_DIFFERING_BITS:
        raise ValueError(f"keys only cover {MOST_DIFFERING_BITS} differing bits, not {most_bits}")
    keyed = distinct.select("fingerprint", F.explode(candidate_keys("fingerprint")).alias("key"))
    left = keyed.select("key", F.col("fingerprint").alias("a"))
    right = keyed.select("key", F.col("fingerprint").alias("b"))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits)
    return left.join(right, (left["key"] == right["key"]) & near).select("a", "b").distinct()


def connected(pairs: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of the pairs.

    Two alternating steps: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. The edges turn into stars around the
    smallest nodes in a number of rounds that grows with the logarithm of a chain's
    length. Neighbourhoods are reduced to their minimum by partial aggregation and
    joined back, so no task ever holds a node's whole neighbourhood.
    """
    edges = checkpointed(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = checkpointed(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u, 1))")).first()
        if state == seen:
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
        seen = state


def rooted(marked: DataFrame) -> DataFrame:
    """One row per fingerprint: its ``root`` (the smallest fingerprint reachable) and its first document.

    First is the smallest id (null last), then the smallest text hash. Copies are reduced to one row per task
    before they are shuffled, and only fingerprints are grouped by root, so many copies are no large group.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    nodes = marked.groupBy("fingerprint").agg(F.min(order).alias("first"))
    roots = connected(links(marked.select("fingerprint").distinct()))
    found = nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    return found.withColumn("root", F.coalesce("root", "fingerprint"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint as 16 hex digits, component_id (smallest id reachable).

    Empty texts and texts of white space have fingerprint zero and are linked like any other. Repeated rows
    come out repeated. Rows with a null id get their component's smallest id, null if it has none. No rows, no rows.
    """
    marked = checkpointed(fingerprints(docs))
    nodes = rooted(marked)
    smallest = nodes.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    of_each = nodes.join(smallest, "root").select("fingerprint", "component_id")
    # The only join with all documents; Spark splits the side of a fingerprint that many of them share.
    return marked.join(of_each, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """Whole rows, one of each group: the one with the smallest id (null last), then the smallest text hash."""
    return first_rows(docs, rooted(checkpointed(fingerprints(docs))))


def first_rows(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Whole rows of the first document of each ``root``."""
    first = nodes.groupBy("root").agg(F.min("first").alias("first"))
    first = first.select(F.col("first.none").alias("none"), id_or_zero("first.doc_id").alias("id"), "first.text_hash")
    rows = whole_rows(docs).select(
        "row", F.col("doc_id").isNull().alias("none"), id_or_zero("doc_id").alias("id"), F.xxhash64("text").alias("text_hash")
    )
    keys = ["none", "id", "text_hash"]
    chosen = rows.join(first, keys, "left_semi")
    # Only repeated rows (same id and text) are still together; they already lie where the join has put them.
    numbered = Window.partitionBy(*keys).orderBy(F.xxhash64("row"))
    return chosen.withColumn("n", F.row_number().over(numbered)).filter("n = 1").select("row.*")


def id_or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long"))
