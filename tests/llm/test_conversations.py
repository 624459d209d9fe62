"""Repair and prefix trie of conversations against plain versions."""

import hashlib
import itertools
import random
import zlib

import pytest

from lumbung.llm import prefix_trie, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def md5(text):
    return hashlib.md5(text.encode()).digest()


def checksum(text):
    return zlib.crc32(text.encode())


def plain_least(rows):
    """(cost, audit, repaired) by trying every state after every row; rows are (role, text, fault)."""
    leads = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    wanted = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}

    def with_inserts(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                to = wanted[state]
                new = (cost + 2, audit + "I", (*out, names[to] + ":"))
                states[to] = min(states.get(to, new), new)
        return states

    states = with_inserts({"": (0, "", ())})
    for role, text, fault in rows:
        after = {}

        def offer(state, new):
            after[state] = min(after.get(state, new), new)

        for state, (cost, audit, out) in states.items():
            offer(state, (cost + 3, audit + "D", out))
            if fault in ("", "truncated"):
                stays = int(fault == "truncated")
                if (state, role[:1]) in leads:
                    offer(leads[state, role[:1]], (cost + stays, audit + "K", (*out, f"{role}:{text}")))
                to = wanted[state]
                offer(to, (cost + 2 + stays, audit + "R", (*out, f"{names[to]}:{text}")))
        states = with_inserts(after)
    return min(states[s] for s in ("", "a") if s in states)


def plain_repair(rows):
    ids = {r[0] for r in rows}
    by_conv = {i: [] for i in ids}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = checksum(key) % 20
        role, text = role if role is not None else " ", text if text is not None else " "
        text = {1: "", 2: "".join(c for c in text if c not in ".!?")}.get(kind, text)
        role = "user" if kind == 4 else role
        if kind:
            by_conv[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    found = []
    for conv, turns in by_conv.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), md5(t[2])))
        seen, marked = set(), []
        for _, role, text in turns:
            body = text.strip(WHITE)
            if not body:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            else:
                fault = "" if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        numbers = [t[0] for t in turns if t[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        initials = [role[:1] for role, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, repaired = plain_least(marked)
        counts = [sum(f == name for _, _, f in marked) for name in ("blank", "duplicate", "truncated")]
        found.append((conv, gaps, *counts, illegal, cost, audit, sha("\n".join(repaired))))
    return sorted(found, key=str)


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired_rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in turn_repair.reports(frame, planted=True).collect()), key=str)


def made_conversations(seed, conversations=60):
    draw = random.Random(seed)
    rows = []
    for conv in range(conversations):
        length = draw.choice([1, 2, 3, 5, 8, 14])
        for turn in range(length):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = draw.choice(["Yes.", "No!", "cut off", "", " \t\n", None, "é. \x0b", "Longer text with words.\n", f"T{turn}."])
            rows.append((conv * 37 % 211, draw.choice([turn, turn, turn, None, turn + 2]), role, text))
    return rows


def test_repair_equals_plain_version(spark):
    rows = made_conversations(1) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (-7, -3, "user", "x")]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("conv_id", "conv_id")
    for clash in ("at", "part", "code", "there", "audit", "a.b"):
        frame = frame.withColumn(clash, frame["turn"])
    assert repaired_rows(frame) == plain_repair(rows)


def test_repair_of_given_table(spark):
    folder = "/root/testdata/sf0.001/conversations.parquet"
    frame = spark.read.parquet(folder)
    assert repaired_rows(frame) == plain_repair([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_repair_of_nothing(spark):
    assert turn_repair.reports(spark.createDataFrame([], SCHEMA), planted=True).collect() == []


@pytest.mark.parametrize("length", range(5))
def test_search_finds_least_audit(length):
    kinds = [(i, f) for i in "suax" for f in range(4)]
    names = ["", "blank", "duplicate", "truncated"]
    draw = random.Random(length)
    every = list(itertools.product(kinds, repeat=length)) if length < 3 else [tuple(draw.choices(kinds, k=length + 4)) for _ in range(800)]
    for turns in every:
        cost, audit, _ = plain_least([(initial, str(k), names[fault]) for k, (initial, fault) in enumerate(turns)])
        assert turn_repair.search(list(turns)) == (cost, audit)


def test_search_of_long_conversation_enters_few_states(monkeypatch):
    draw = random.Random(3)
    turns = [(draw.choice("suax"), draw.choice([0, 0, 0, 1, 2, 3])) for _ in range(20_000)]
    entered = 0
    plain = turn_repair.edits_of

    def counted(*args):
        nonlocal entered
        entered += 1
        return plain(*args)

    rest = turn_repair.lower_bounds(turns)
    monkeypatch.setattr(turn_repair, "edits_of", counted)
    monkeypatch.setattr(turn_repair, "lower_bounds", lambda _: rest)
    cost, audit = turn_repair.search(turns)
    assert len(audit) >= 20_000 and cost >= rest[0]
    assert entered < 20 * len(turns)


def test_repaired_rows_follow_the_audit(spark):
    rows = [(1, 0, "assistant", "Hello."), (1, 1, "user", "A question?"), (1, 2, "tool", "An answer."), (1, 3, "user", "")]
    found = turn_repair.repaired(spark.createDataFrame(rows, SCHEMA)).orderBy("place").collect()
    assert [(r.edit, r.role, r.text) for r in found] == [
        ("I", "user", ""), ("K", "assistant", "Hello."), ("K", "user", "A question?"), ("R", "assistant", "An answer."), ("D", "user", ""),
    ]


def plain_trie(rows):
    original = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            original.setdefault(conv, []).append((turn, role or "", text or ""))
    for turns in original.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), md5(t[2])))
    sequences = {}
    for conv, turns in original.items():
        share = checksum(str(conv)) % 6
        base = conv - (conv - 100 * int(conv / 100))
        sequences[conv] = tuple(t[1:] for t in original.get(base, [])[:share] + turns[share:])
    members = {}
    for conv, sequence in sequences.items():
        for depth in range(len(sequence) + 1):
            members.setdefault(sequence[:depth], []).append(conv)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        below = [totals[c] for c in children.get(node, [])]
        totals[node] = (own + sum(b[0] for b in below), sum(b[1] for b in below) or 1)
    found = []
    for node, convs in members.items():
        ends = sorted(c for c in convs if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        row = (min(convs), len(node), parent, len(convs), len(children.get(node, [])), totals[node][1], totals[node][0])
        found.append((*row, sha(",".join(map(str, ends)))))
    return sorted(found, key=str)


def trie_rows(frame):
    return sorted((tuple(r) for r in prefix_trie.trie(frame).collect()), key=str)


def test_trie_equals_plain_version(spark):
    draw = random.Random(5)
    rows = []
    for conv in [0, 100, 200, 300, *range(1, 60), *range(101, 140), 205, 399, -5, -150, 10_000]:
        for turn in range(draw.choice([1, 1, 2, 3, 4, 7])):
            rows.append((conv, draw.choice([turn, turn, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "bé", "", None, "Longer."])))
    rows += [(7, 0, "user", "a")] * 3 + [(None, 0, "user", "left out")]
    frame = spark.createDataFrame(rows, SCHEMA)
    for clash in ("at", "part", "depth", "x", "weight", "a.b"):
        frame = frame.withColumn(clash, frame["turn"])
    assert trie_rows(frame) == plain_trie(rows)


def test_trie_of_given_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    assert trie_rows(frame) == plain_trie([tuple(r) for r in frame.select("conv_id", "turn", "role", "text").collect()])


def test_trie_of_nothing(spark):
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("partitions", ["2", "13"])
def test_long_and_copied_conversations_over_many_parts(spark, partitions):
    """A conversation with most of the rows is cut over parts, results don't depend on where."""
    rows = [(3, t, "user" if t % 2 else "assistant", f"Text {t % 50}.") for t in range(600)]
    rows += [(i, t, "ua"[t % 2], "The same.") for i in range(400, 460) for t in range(3)]
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
        assert trie_rows(frame) == plain_trie(rows)
        assert repaired_rows(frame) == plain_repair(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before[0])
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before[1])


@pytest.mark.parametrize("name", ["op11_turn_repair", "op13_prefix_trie"])
def test_queries_equal_their_sql(spark, name, tmp_path):
    """On rows with nulls, repeated turns and damage of every kind."""
    import duckdb

    from lumbung.llm.queries import ORACLE, QUERIES

    rows = made_conversations(7) + [(100 * (i // 3), i % 3, "user", "Hi.") for i in range(30)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    wanted = db.execute(ORACLE[name])
    columns = [c[0] for c in wanted.description]
    found = QUERIES[name](spark, str(tmp_path))
    assert sorted(columns) == sorted(found.columns)
    assert sorted(map(str, wanted.fetchall())) == sorted(str(tuple(r[c] for c in columns)) for r in found.collect())
