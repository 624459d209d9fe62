"""Repair of conversation structure by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` by the first letters of its roles:
an optional system turn, then user and assistant in turn. Turns are kept, given
another role, deleted, or inserted, each at a price, and the cheapest way is
wanted; of several, the one whose letters come first in ASCII order.

The search goes depth first through edits in ASCII order (D, I, K, R) and gives
up a path when its cost and a lower bound of the rest exceed the bound; then the
bound rises by one. States that failed with some budget are remembered, so they
are entered again only with a larger one, and in every round a state is entered
once from its cheapest path. The lower bound is the cost of a relaxed problem
that only forgets that a system turn alone is no end. Under the right bound the
first accepting path is therefore the answer.

A conversation is searched by one letter per turn, which is no longer than its
audit, one string by definition. Letters are gathered part by part
(``turns.in_order``). Texts are only streamed past the finished edits.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import ROWS_PER_BATCH, checkpointed, named, short_batches
from lumbung.llm.turns import in_order

DROPPED, EMPTIED, UNENDED, REPEATED, AS_USER, OUT_OF = 0, 1, 2, 3, 4, 20
WHITE = r" \t-\r"
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1  # costs; the last one for a truncated turn that stays

# What has been read: nothing, only a system turn, an open user turn, whole exchanges.
NOTHING, SYSTEM, USER, EXCHANGES = range(4)
# Where a kept turn leads, by its letter; a turn with a new role and an inserted one are what the state asks for.
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": EXCHANGES}, {"u": USER})
WANTED = (USER, USER, EXCHANGES, USER)
ROLE = {USER: "user", EXCHANGES: "assistant"}
LEGAL = {"su", "ua", "au"}

FACTS = "intact", "blank", "duplicate", "truncated"
# One letter per turn: s, u, a or x for another role, moved on by its fault.
CLASSES = "suax"


def code_of(initial: str, fault: int) -> str:
    return chr(ord("A") + 4 * CLASSES.index(initial) + fault)


CODES = {code_of(initial, fault): (initial, fault) for initial in CLASSES for fault in range(4)}


def edits_of(turns: list[tuple[str, int]], at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
    """letter, cost, place and state afterwards, in ASCII order of the letters."""
    there = at < len(turns)
    if there:
        yield "D", DELETE, at + 1, state
    yield "I", INSERT, at, WANTED[state]
    if there:
        initial, fault = turns[at]
        if fault in (0, 3):
            stays = CUT_OFF if fault == 3 else 0
            if initial in KEPT[state]:
                yield "K", stays, at + 1, KEPT[state][initial]
            yield "R", REROLE + stays, at + 1, WANTED[state]


def lower_bounds(turns: list[tuple[str, int]]) -> array:
    """For every place and state the least cost of the rest, if a system turn alone could end a conversation."""
    bounds = array("q", bytes(8 * 4 * (len(turns) + 1)))
    never = 1 << 60
    for at in range(len(turns), -1, -1):
        here = [never] * 4
        for state in range(4):
            if at == len(turns):
                here[state] = never if state == USER else 0
                continue
            for letter, cost, to, then in edits_of(turns, at, state):
                if letter != "I":
                    here[state] = min(here[state], cost + bounds[4 * to + then])
        # Insertions stay at a place: one or two of them lead from any state to any that they can reach.
        for _ in range(2):
            for state in range(4):
                here[state] = min(here[state], INSERT + here[WANTED[state]])
        bounds[4 * at : 4 * at + 4] = array("q", here)
    return bounds


def search(turns: list[tuple[str, int]]) -> tuple[int, str]:
    """Least cost and its first edits in ASCII order, for turns given as (letter of the role, fault)."""
    rest = lower_bounds(turns)
    failed = array("q", [-1]) * len(rest)  # the largest budget with which a state has failed
    bound = rest[NOTHING]
    while (found := deepened(turns, rest, failed, bound)) is None:
        bound += 1
    return bound, found


def deepened(turns: list[tuple[str, int]], rest: array, failed: array, bound: int) -> str | None:
    """The first accepting path within the bound."""
    path = bytearray()
    # An open state: place, state, budget left, edits not tried yet.
    open_states = [(0, NOTHING, bound, edits_of(turns, 0, NOTHING))]
    if not turns:
        return ""
    while open_states:
        at, state, budget, edits = open_states[-1]
        for letter, cost, to, then in edits:
            left = budget - cost
            key = 4 * to + then
            if left < rest[key] or left <= failed[key]:
                continue
            path.append(ord(letter))
            if to == len(turns) and then in (NOTHING, EXCHANGES):
                return path.decode()
            open_states.append((to, then, left, edits_of(turns, to, then)))
            break
        else:
            failed[4 * at + state] = max(failed[4 * at + state], budget)
            open_states.pop()
            if path:
                path.pop()
    return None


SOLVED = T.StructType()
for _name in (*FACTS[1:], "illegal", "cost"):
    SOLVED = SOLVED.add(_name, T.LongType())
SOLVED = SOLVED.add("audit", T.StringType())


def solved_of(codes: str) -> dict:
    turns = [CODES[code] for code in codes]
    cost, audit = search(turns)
    faults = [fault for _, fault in turns]
    counts = {name: faults.count(k) for k, name in enumerate(FACTS) if k}
    illegal = sum(a + b not in LEGAL for (a, _), (b, _) in zip(turns, turns[1:]))
    return counts | {"illegal": illegal, "cost": cost, "audit": audit}


@F.arrow_udf(SOLVED)
def solved(codes: pa.Array) -> pa.Array:
    # Copied conversations have the same letters, and most are short.
    known: dict[str, dict] = {}
    found = []
    for text in codes.to_pylist():
        if text not in known:
            known[text] = solved_of(text)
        found.append(known[text])
    return pa.array(found, pa.struct([(f.name, pa.string() if f.name == "audit" else pa.int64()) for f in SOLVED]))


def given_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of every row; nulls of role and text are one space."""
    short_batches(conversations.sparkSession)
    space = F.lit(" ")
    return conversations.select(
        named("conv_id").cast("long").alias("conv_id"),
        named("turn").cast("long").alias("turn"),
        F.coalesce(named("role").cast("string"), space).alias("role"),
        F.coalesce(named("text").cast("string"), space).alias("text"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Faults planted by a checksum of ``conv_id:turn`` (nulls: one space); ``there`` is false for a dropped row."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % OUT_OF
    text = F.when(kind == EMPTIED, "").when(kind == UNENDED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (kind != DROPPED).alias("there"),
        F.explode(F.when(kind == REPEATED, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    )


# Ties of the turn are decided by role and checksum of the text, so that texts need not travel to be put in order.
ORDER = ("turn", "role", "digest")


def described(turns: DataFrame) -> DataFrame:
    """The rows that are there, without their texts: what the search has to know."""
    last = F.regexp_extract("text", rf"([^{WHITE}])[{WHITE}]*\z", 1)
    return turns.filter("there").select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("truncated"),
    )


def coded(placed: DataFrame) -> DataFrame:
    """conv_id, part, at and the letter of every row."""
    twins = ["conv_id", "role", "digest"]
    # Only texts that a conversation repeats are joined; there are few, and blank ones are not asked about.
    repeated = placed.filter("not blank").groupBy(*twins).agg(F.min("at").alias("original"), F.count("*").alias("n"))
    repeated = repeated.filter("n > 1").select(*[F.col(c).alias(f"{c}_of_twin") for c in twins], "original")
    same = [F.col(c).eqNullSafe(F.col(f"{c}_of_twin")) for c in twins]
    rows = placed.join(repeated, same, "left")
    fault = F.when(F.col("blank"), 1).when(F.col("at") > F.col("original"), 2).when(F.col("truncated"), 3).otherwise(0)
    initial = F.instr(F.lit(CLASSES[:3]), F.substring("role", 1, 1)) - 1
    kind = F.when((F.col("role") == "") | (initial < 0), len(CLASSES) - 1).otherwise(initial)
    return rows.select("conv_id", "part", "at", F.char(F.lit(ord("A")) + 4 * kind + fault).alias("code"))


def in_one(group: DataFrame, order: str, letters: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, letters))), lambda s: s[letters]), "")


def audits(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, counts of faults, illegal neighbours, cost and audit."""
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = in_order(described(turns), *order)
    rows = coded(placed)
    # Letters are joined within a part first: no list holds more rows of a conversation than a part.
    pieces = rows.groupBy("conv_id", "part").agg(in_one(rows, "at", "code").alias("codes"))
    whole = pieces.groupBy("conv_id").agg(in_one(pieces, "part", "codes").alias("codes"))
    found = whole.select(F.col("conv_id").alias("of"), solved("codes").alias("solved"))
    there = F.when(F.col("there"), F.col("turn"))
    spread = turns.groupBy("conv_id").agg(
        F.min(there).alias("low"), F.max(there).alias("high"), F.count_distinct(there).alias("different")
    )
    # Exact beyond 64 bits; null if the number itself doesn't fit in them.
    gaps = F.col("high").cast("decimal(20,0)") - F.col("low").cast("decimal(20,0)") + 1 - F.col("different")
    gaps = F.when(F.col("low").isNull(), F.lit(0)).otherwise(gaps).try_cast("long")
    nothing = F.lit(0).cast("long")
    counts = [c.name for c in SOLVED if c.name != "audit"]
    return spread.join(found, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id",
        gaps.alias("gaps"),
        *[F.coalesce(f"solved.{c}", nothing).alias(c) for c in counts],
        F.coalesce("solved.audit", F.lit("")).alias("audit"),
    )


def beside_audits(turns: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation one row with its audit, then its turns in order; lies by conversation, sorted.

    A hash of the repaired text has to read a conversation from its first to its last turn, so its rows go past
    one task. They are streamed there, sorted by Spark with spilling; only the audit is held.
    """
    none = [F.lit(None).cast(t).alias(c) for c, t in (("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"))]
    heads = found.select("conv_id", *none, "audit", F.lit(0).cast("long").alias("number"))
    rows = turns.filter("there").select(
        "conv_id", "turn", "role", F.unhex(F.md5("text")).alias("digest"), "text",
        F.lit(None).cast("string").alias("audit"), F.lit(1).cast("long").alias("number"),
    )
    together = heads.unionByName(rows).repartition("conv_id")
    return together.sortWithinPartitions("conv_id", "number", F.col("turn").asc_nulls_first(), "role", "digest")


def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, edit, role, text) for each edit in order; an edit ``""`` ends a conversation."""
    open_id, edits, at, state = None, None, 0, NOTHING

    def inserted():
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            state, at = WANTED[state], at + 1
            yield open_id, "I", ROLE[state], ""

    for batch in batches:
        for conv, role, text, audit in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "audit"))):
            if audit is not None:
                if edits is not None:
                    yield from inserted()
                    yield open_id, "", "", ""
                open_id, edits, at, state = conv, audit, 0, NOTHING
                continue
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == "K":
                state = KEPT[state][role[:1]]
            elif edit == "R":
                state = WANTED[state]
                role = ROLE[state]
            yield open_id, edit, role, text
    if edits is not None:
        yield from inserted()
        yield open_id, "", "", ""


def repaired(conversations: DataFrame, planted: bool = False) -> DataFrame:
    """The edits row by row: conv_id, place (from 0), edit (D, I, K, R), role and text as repaired.

    ``planted`` damages the rows first. Deleted rows come out with edit D and as they were.
    """
    turns = prepared(conversations, planted)

    def edited(batches):
        place, rows = 0, []
        for conv, edit, role, text in walked(batches):
            if not edit:
                place = 0
                continue
            rows.append((conv, place, edit, role, text))
            place += 1
            if len(rows) == ROWS_PER_BATCH:
                yield batch_of(rows, ("conv_id", "place", "edit", "role", "text"))
                rows = []
        if rows:
            yield batch_of(rows, ("conv_id", "place", "edit", "role", "text"))

    schema = "conv_id long, place long, edit string, role string, text string"
    return beside_audits(turns, audits(turns)).mapInArrow(edited, schema)  # what reports() hashes, row by row


def batch_of(rows: list[tuple], names: tuple[str, ...]) -> pa.RecordBatch:
    kinds = {"conv_id": pa.int64(), "place": pa.int64()}
    columns = [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))]
    return pa.RecordBatch.from_arrays(columns, list(names))


def prepared(conversations: DataFrame, planted: bool) -> DataFrame:
    turns = given_turns(conversations)
    return damaged(turns) if planted else turns.withColumns({"there": F.lit(True), "copy": F.lit(1)})


def reports(conversations: DataFrame, planted: bool = False) -> DataFrame:
    """One row per conversation: gaps, faults, illegal, cost, audit and the checksum of the repaired text.

    Nulls of role and text are one space, and so are those of conv_id and turn in the checksum that plants faults; a
    null conv_id is a conversation of its own, a null turn comes first and counts for no gap. Rows of the same turn
    lie by role, then by the checksum of the text; repeated rows are duplicates. A conversation without rows after
    damage has zeros, an empty audit and the checksum of nothing. Numbers of missing turns beyond 64 bits are null.
    No rows, no conversations.
    """
    turns = prepared(conversations, planted)
    found = checkpointed(audits(turns))

    def hashed(batches):
        digest, first, rows = hashlib.sha256(), True, []
        for conv, edit, role, text in walked(batches):
            if not edit:
                rows.append((conv, digest.hexdigest()))
                digest, first = hashlib.sha256(), True
                if len(rows) == ROWS_PER_BATCH:
                    yield batch_of(rows, ("conv_id", "repaired_sha256"))
                    rows = []
            elif edit != "D":
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if rows:
            yield batch_of(rows, ("conv_id", "repaired_sha256"))

    hashes = beside_audits(turns, found).mapInArrow(hashed, "conv_id long, repaired_sha256 string")
    hashes = hashes.withColumnRenamed("conv_id", "of")
    return found.join(hashes, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
