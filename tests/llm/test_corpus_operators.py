"""Operators that look at many documents, against plain versions."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from lumbung.llm import golay, mixing, sharding, simhash

# ---------------------------------------------------------------- near-duplicates


def test_golay_neighbours_share_a_codeword():
    dice = np.random.default_rng(1)
    words = dice.integers(0, 1 << 23, 3000)
    own, there = golay.codeword_indices(words)
    for bit in range(23):
        other, also = golay.codeword_indices(words ^ (1 << bit))
        shared = (own[:, :, None] == other[:, None, :]) & there[:, :, None] & also[:, None, :]
        assert shared.any((1, 2)).all()
    assert set(there.sum(1)) <= {1, 6}


def test_keys_meet_for_two_differing_bits():
    dice = random.Random(8)
    for a, b in [*combinations(range(64), 2), *((i, i) for i in range(64))]:
        value = dice.getrandbits(64)
        other = value ^ (1 << a) ^ (1 << b if a != b else 0)
        assert set(keys(value)) & set(keys(other))


def keys(value):
    import pyarrow as pa

    signed = pa.array(np.array([value], np.uint64).view(np.int64))
    return simhash.candidate_keys.func(signed).to_pylist()[0]


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """doc_id -> smallest doc_id reachable over fingerprints that differ in two bits or fewer."""
    parent = {i: i for i in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(prints, 2):
        if (prints[a] ^ prints[b]).bit_count() <= 2:
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    return {i: top(i) for i in prints}


def test_groups_equal_a_plain_version(documents):
    dice = random.Random(6)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(40):
        base = dice.choices(words, k=dice.choice([1, 2, 3, 40, 400]))
        texts.append(" ".join(base))
        for _ in range(dice.randint(0, 6)):
            edit = list(base)
            edit[dice.randrange(len(edit))] = dice.choice(words)
            texts.append(" \n".join(edit).upper() if dice.random() < 0.2 else " ".join(edit))
    texts += ["", "  ", texts[0], texts[0], texts[7]]
    dice.shuffle(texts)
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    expected = plain_components(prints)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(documents(*enumerate(texts))).collect()}
    assert found == {i: (f"{prints[i]:016x}", expected[i]) for i in prints}
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(documents(*enumerate(texts))).collect())
    assert kept == sorted(set(expected.values()))


def test_long_chains_are_one_component(spark):
    dice = random.Random(2)
    order = dice.sample(range(400), 400)
    pairs = [(min(a, b), max(a, b)) for a, b in zip(order, order[1:])]
    found = simhash.connected(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(r["node"] for r in found) == list(range(400)) and {r["root"] for r in found} == {0}


# ---------------------------------------------------------------- shards


def plain_jump(key, shards):
    place, jump = -1, 0
    while jump < shards:
        place = jump
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        jump = int((place + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return place


def test_jump_equals_a_plain_version():
    dice = random.Random(9)
    values = [dice.getrandbits(64) for _ in range(2000)] + [0, 2**64 - 1]
    for shards in (1, 2, 8, 9, 1000):
        assert sharding.jump(np.array(values, np.uint64), shards).tolist() == [plain_jump(v, shards) for v in values]


def test_shards_are_gapless_and_move_only_to_the_new_one(documents):
    rows = [(i, "x" * (i % 7)) for i in range(3000)] + [(5, "x" * 5)] * 40 + [(None, "y")] * 3
    found = sharding.sharded(documents(*rows)).collect()
    assert len(found) == len(rows)
    for shard in range(8):
        slots = sorted(r["slot"] for r in found if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    moved = [r for r in found if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {8} and 0.07 < len(moved) / len(found) < 0.16
    assert {r["law"] for r in found} == {"key"}
    again = sharding.sharded(documents(*rows[::-1])).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))


def test_a_third_of_all_rows_being_equal_is_spread(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_STRETCH", 100)
    rows = documents(*[(i, "x") for i in range(6_000)]).unionByName(documents((7, "same")).crossJoin(spark.range(3_000)).drop("id"))
    found = sharding.sharded(rows)
    slots = [r["slot"] for r in found.filter(F.col("shard") == found.filter("text_crc32 = crc32('same')").first()["shard"]).collect()]
    assert sorted(slots) == list(range(len(slots))) and len(slots) > 3_000
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "false")  # so few rows would be put together again
        tasks = sharding.sharded(rows).filter("text_crc32 = crc32('same')").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(key, before)
    assert found.count() == 9_000 and max(r["count"] for r in tasks) < 2_500


# ---------------------------------------------------------------- mixing


def plain_targets(sizes):
    """Deal the wanted words by weight; stop sources at their limit and deal the excess again."""
    names = sorted(sizes, key=lambda n: (n is None, n or ""))
    weights = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [n for n in names if n not in full]
        share = {n: weights[n] * left / sum(weights[m] for m in rest) for n in rest}
        above = [n for n in rest if share[n] > 2 * sizes[n]]
        if not above:
            return full | share
        for n in above:
            full[n] = 2 * sizes[n]
            left -= full[n]


@pytest.mark.parametrize("seed", range(5))
def test_targets_equal_a_plain_version(spark, seed):
    dice = random.Random(seed)
    sizes = {n: dice.choice([0, 1, 5, 100, 10_000]) for n in ["a", "B", "é", "z1", None, "", "zz"]}
    frame = spark.createDataFrame([(n, s) for n, s in sizes.items()], "source string, size long")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(plain_targets(sizes), abs=1e-6)


def test_copies_follow_the_rates(documents):
    rows = [(i, "one two three") for i in range(4000)]
    docs = documents(*rows[:3000]).union(documents(*rows[3000:], source="s2"))
    found = mixing.mixed(docs).collect()
    for of in ({r["target"] for r in found}):
        mine = [r for r in found if r["target"] == of]
        assert sum(r["taken"] for r in mine) == pytest.approx(of, rel=0.05)
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    wanted = sorted(r["doc_id"] for r in found for _ in range(r["copies"]))
    assert sorted(r["doc_id"] for r in mixing.emitted(docs).collect()) == wanted
    assert sorted(map(str, mixing.mixed(docs.repartition(7)).collect())) == sorted(map(str, found))


def test_large_source_lists_are_joined(documents, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_BROADCAST_SOURCES", 0)
    docs = documents((1, "a b"), (2, None)).union(documents((3, "c"), source=None))
    assert mixing.mixed(docs).count() == 3
