"""The trie of conversation prefixes, from whole sequences collapsed to weighted ones.

Equal conversations are one sequence with a weight and a list of its members.
Sequences that are a proper prefix of another are no leaves; an anti-join with
the inner prefixes finds the leaves. Then every sequence hands its weight to its
prefixes, and what is asked about a node is a sum or a minimum over them.

A prefix is known by its depth and the exclusive or of hashes of its turns, each
taken together with its place (128 bits). That is summed up over parts of a
conversation side by side, so no task has to read a conversation from its first
turn to its last. Texts are only looked at where they are read: what travels is
a checksum and a length.

Sums over a subtree take every node once. A node shared by several leaves belongs
to the smallest of them; a leaf's own nodes are the end of its path, so their
characters are the smaller one of two numbers: those of all its own nodes, and
those from a place to its end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.llm.tables import checkpointed, named, short_batches
from lumbung.llm.turns import before, in_order, parts_of

# Conversation c begins with up to crc32(c) % SHARED_UP_TO turns of conversation c - c % GROUP.
GROUP, SHARED_UP_TO = 100, 6

NODE = ("depth", "x", "y")


def root() -> list[Column]:
    return [F.lit(0).cast("long").alias(c) for c in NODE]


def facts(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest and code points of the text; nulls of role and text are empty."""
    text = F.coalesce(named("text").cast("string"), F.lit(""))
    return conversations.select(
        named("conv_id").cast("long").alias("conv_id"),
        named("turn").cast("long").alias("turn"),
        F.coalesce(named("role").cast("string"), F.lit("")).alias("role"),
        F.unhex(F.md5(text)).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    ).filter("conv_id IS NOT NULL")


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns with their ``depth`` from 1, and how many turns every conversation has."""
    placed = in_order(facts(conversations), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest"))
    pieces = parts_of(placed)
    earlier = pieces.select("conv_id", "part", "first", F.coalesce(before(F.sum, "n"), F.lit(0)).alias("earlier"))
    rows = placed.join(earlier, ["conv_id", "part"]).withColumn("depth", F.col("at") - F.col("first") + F.col("earlier") + 1)
    rows = rows.select("conv_id", "part", "depth", "role", "digest", "chars")
    return rows, pieces.groupBy("conv_id").agg(F.sum("n").alias("turns"))


def rebuilt(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every conversation's own turns after its first ones, which those of its group's conversation replace.

    Those few are carried as one short list per group, the parts of a conversation stay as they are.
    """
    share = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED_UP_TO).alias("share")
    convs = lengths.select("conv_id", share, (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    turn = F.struct("depth", "role", "digest", "chars")
    heads = rows.filter((F.col("depth") < SHARED_UP_TO) & (F.col("conv_id") % GROUP == 0))
    heads = heads.groupBy(F.col("conv_id").alias("base")).agg(F.sort_array(F.collect_list(turn)).alias("head"))
    taken = convs.join(heads, "base", "left").select("conv_id", "share", F.slice("head", 1, F.col("share").cast("int")).alias("head"))
    own = rows.join(taken.select("conv_id", "share", F.coalesce(F.size("head"), F.lit(0)).alias("taken")), "conv_id")
    own = own.filter("depth > share").withColumn("depth", F.col("depth") - F.col("share") + F.col("taken"))
    columns = ["conv_id", "part", "depth", "role", "digest", "chars"]
    shared = taken.select("conv_id", F.lit(-1).alias("part"), F.inline("head"))
    return shared.select(*columns).unionByName(own.select(*columns))


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, the node that each turn leads to (``NODE``), its parent's x and y, chars, chars up to here."""
    hashed = turns.select(
        "conv_id", "part", "depth", "chars",
        F.xxhash64("depth", "role", "digest").alias("hx"), F.xxhash64("digest", "depth", "role").alias("hy"),
    )
    sums = {"x": (F.bit_xor, "hx"), "y": (F.bit_xor, "hy"), "upto": (F.sum, "chars")}
    pieces = hashed.groupBy("conv_id", "part").agg(*[agg(of).alias(name) for name, (agg, of) in sums.items()])
    further = pieces.select("conv_id", "part", *[before(agg, name).alias(f"{name}_before") for name, (agg, _) in sums.items()])
    further = further.filter("upto_before IS NOT NULL")  # parts after the first one
    inside = Window.partitionBy("conv_id", "part").orderBy("depth")
    running = hashed.select("*", *[agg(of).over(inside).alias(name) for name, (agg, of) in sums.items()])
    found = running.join(further, ["conv_id", "part"], "left")
    zero = F.lit(0).cast("long")
    x, y = (F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", zero)) for c in ("x", "y"))
    return found.select(
        "conv_id", "depth", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("hx")).alias("above_x"),
        y.bitwiseXOR(F.col("hy")).alias("above_y"), "chars", (F.col("upto") + F.coalesce("upto_before", zero)).alias("upto"),
    )


def sequences(lengths: DataFrame, path: DataFrame) -> DataFrame:
    """The whole sequence of every conversation: its node and all its characters; without turns the root."""
    whole = path.groupBy("conv_id").agg(F.max(F.struct(*NODE, "upto")).alias("whole"))
    zero = F.lit(0).cast("long")
    joined = lengths.select("conv_id").join(whole, "conv_id", "left")
    return joined.select("conv_id", *[F.coalesce(f"whole.{c}", zero).alias(c) for c in (*NODE, "upto")])


def nodes_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes of the trie with what is asked about them, but for the list of members, and all whole sequences."""
    rows, lengths = numbered(conversations)
    path = checkpointed(paths(rebuilt(rows, lengths)))
    ends = checkpointed(sequences(lengths, path))
    # Whole-sequence collapse: a weight and the smallest member.
    collapsed = ends.groupBy(*NODE).agg(F.count("*").alias("weight"), F.min("conv_id").alias("conv_id"), F.first("upto").alias("all"))
    of_first = path.join(
        collapsed.select("conv_id", "weight", "all", F.col("depth").alias("last")), "conv_id"
    )
    inner = of_first.filter("depth < last").select(*NODE).distinct()
    # Only the root can be a prefix without a turn.
    inner = inner.union(of_first.limit(1).select(*root()))
    leaves = collapsed.join(inner, list(NODE), "left_anti").select("conv_id", F.lit(True).alias("is_leaf"))
    weighted = of_first.select(*NODE, "above_x", "above_y", "chars", "upto", "conv_id", "weight", "all")
    origin = [F.lit(None).cast("long").alias(c) for c in ("above_x", "above_y")]
    zero = F.lit(0).cast("long")
    at_root = collapsed.select(*root(), *origin, zero.alias("chars"), zero.alias("upto"), "conv_id", "weight", "all")
    marked = weighted.unionByName(at_root).join(leaves, "conv_id", "left")
    marked = marked.select("*", (F.col("all") - F.col("upto") + F.col("chars")).alias("rest"))
    marked = checkpointed(marked.select(*NODE, "above_x", "above_y", "chars", "conv_id", "weight", "is_leaf", "rest"))
    nodes = marked.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.first("above_x").alias("above_x"),
        F.first("above_y").alias("above_y"),
        F.sum("weight").alias("n_convs"),
        F.count("is_leaf").alias("n_leaves"),
        F.sum(F.col("weight") * F.col("rest")).alias("all_chars"),
        F.min(F.when(F.col("is_leaf"), F.struct(F.col("conv_id").alias("leaf"), "rest"))).alias("owner"),
    )
    nodes = checkpointed(nodes)
    own = nodes.groupBy(F.col("owner.leaf").alias("conv_id")).agg(F.max("owner.rest").alias("own"))
    once = marked.filter("is_leaf").join(own, "conv_id").groupBy(*NODE).agg(F.sum(F.least("own", "rest")).alias("once"))
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above_x").alias("x"), F.col("above_y").alias("y"))
    children = children.agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x").alias("above_x"), F.col("y").alias("above_y"), F.col("conv_id").alias("parent_conv_id")
    )
    found = nodes.join(once, list(NODE)).join(children, list(NODE), "left").join(parents, ["depth", "above_x", "above_y"], "left")
    return found.select(
        *NODE, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves", (F.col("all_chars") - F.col("once")).alias("saved_tokens"),
    ), ends


HASHED = "depth long, x long, y long, ends_sha256 string"


def hashed_ends(ends: DataFrame) -> DataFrame:
    """Checksum of the members' ids, ascending, for every node where conversations end.

    Sorted by node over the cluster, a node's ids are joined to one text per part; only those texts of a node
    meet in a task, where the checksum reads one after the other.
    """
    short_batches(ends.sparkSession)
    order = (*NODE, "conv_id")
    ranged = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = checkpointed(ranged.withColumn("at", F.monotonically_increasing_id())).withColumn("part", F.shiftright("at", 33))
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    pieces = placed.groupBy(*NODE, "part").agg(ids.alias("ids"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            found = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if key == node:
                    digest.update(b"," + ids.encode())
                    continue
                if node:
                    found.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            if found:
                yield rows_of(found)
        if node:
            yield rows_of([(*node, digest.hexdigest())])

    return pieces.repartition(*NODE).sortWithinPartitions(*NODE, "part").mapInArrow(read, HASHED)


def rows_of(found: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, pa.string() if k == len(NODE) else pa.int64()) for k, c in enumerate(zip(*found))]
    return pa.RecordBatch.from_arrays(columns, [*NODE, "ends_sha256"])


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Null roles and texts are empty. Rows without a conv_id belong to no conversation. Turns of the same number lie
    by role, then by the checksum of the text; repeated rows are turns of their own. A conversation that is rebuilt
    without turns is a member of the root. Texts may have any length. No conversations, no nodes.
    """
    nodes, ends = nodes_of(conversations)
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    joined = nodes.join(hashed_ends(ends), list(NODE), "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
