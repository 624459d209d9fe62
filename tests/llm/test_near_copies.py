import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lumbung.llm import near_copies, simhash


def plain_set(text):
    words = text.lower().split()
    width = min(len(words), 5)
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def plain_kept(texts):
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = {i: plain_set(t) for i, t in texts.items()}
    for a, b in combinations(texts, 2):
        shared, whole = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if 5 * shared >= 4 * whole:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return sorted({find(i) for i in texts})


@pytest.mark.parametrize("seed", [31, 32])
def test_stage_keeps_one_of_each_group_of_similar_texts(spark, documents, tmp_path, seed):
    dice = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(dice.choices(words, k=30))
    texts = []
    for _ in range(40):
        base = dice.choices(words, k=dice.choice([1, 3, 4, 5, 9, 30, 60, 200, 500]))
        texts.append(" ".join(base))
        for _ in range(dice.randint(0, 5)):
            edit = list(base)
            for _ in range(dice.randint(1, 1 + len(edit) // 30)):
                edit[dice.randrange(len(edit))] = dice.choice(words)
            texts.append(" \n".join(edit).upper() if dice.random() < 0.3 else " ".join(edit[dice.randint(0, 3) :]))
    texts += [f"{passage} {' '.join(dice.choices(words, k=k))}" for k in range(1, 60)]
    texts += ["", "  ", texts[0], texts[7]]
    dice.shuffle(texts)
    texts = dict(enumerate(texts))
    kept = corpus_pipeline.without_near_duplicates(spark, documents(*texts.items()), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in kept) == plain_kept(texts)


def test_more_bits_than_the_keys_cover_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fingerprint long"), 3)


def hashes(text):
    return near_copies.shingles_of(text.encode())


def test_bands_find_pairs_just_above_the_limit():
    """Recall of the candidates at the limit itself, where it is lowest, over 3,000 pairs; brute force has all."""
    dice = random.Random(8)
    found = 0
    for size in [9, 18, 45, 90, 450] * 600:
        # shared : whole = 8 : 10
        numbers = near_copies.np.array(dice.sample(range(1 << 62), size // 9 * 10), near_copies.np.uint64)
        one, other = numbers[: size], numbers[size // 9 :]
        found += bool(set(near_copies.bands_of(near_copies.np.sort(one))) & set(near_copies.bands_of(near_copies.np.sort(other))))
    assert found == 3_000


def test_candidates_of_a_shared_passage_grow_in_proportion(spark, documents):
    """Texts of 160 words that have 30 in common: nearly none of their pairs are candidates."""
    dice = random.Random(10)
    passage = " ".join(f"p{i}" for i in range(30))
    counts = []
    for n in (400, 800):
        rows = [(i, f"{passage} " + " ".join(f"w{dice.randrange(10**9)}" for _ in range(130))) for i in range(n)]
        texts = documents(*rows).select("text", near_copies.described("text").alias("set")).select("set.*")
        banded = texts.selectExpr("key", "explode(bands) AS band")
        pairs = banded.alias("x").join(banded.alias("y"), "band").filter("x.key < y.key").select("x.key", "y.key").distinct()
        counts.append(pairs.count())
    assert counts[0] <= 400 and counts[1] <= 800


def test_texts_that_resemble_one_another_too_little_do_not_make_all_pairs(spark, documents, tmp_path):
    """Copies of one text with so many edits each that most are similar to none, but share bands with many."""
    dice = random.Random(11)
    base = [f"b{i}" for i in range(150)]
    sizes, texts = [], {}
    for n in (150, 300):
        texts = {0: " ".join(base)}
        for i in range(1, n):
            edit = list(base)
            for place in dice.sample(range(150), dice.choice([1, 2, 4, 5, 6, 7, 8])):
                edit[place] = f"own{i}x{place}" if dice.random() < 0.9 else "often"
            texts[i] = " ".join(edit if i % 10 else edit[: 150 - i % 37])
        nodes = documents(*texts.items()).select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("first"), near_copies.described("text").alias("set"))
        nodes = near_copies.checkpointed(nodes.select("first", "set.*"))
        rows = near_copies.ids_and_texts(documents(*texts.items()))
        first = near_copies.comparisons(near_copies.centered(nodes), nodes, rows)
        sizes.append((first.count(), near_copies.undecided(first).count()))
    (stars, left), (more_stars, more_left) = sizes  # of 11,175 and 44,850 pairs
    assert stars < 6 * 150 and more_stars < 6 * 300 and left < 2 * 150 and more_left < 2 * 300, sizes
    kept = corpus_pipeline.without_near_duplicates(spark, documents(*texts.items()), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in kept) == plain_kept(texts)


def test_fingerprints_propose_pairs_whatever_their_minima(spark, documents):
    """Without a band in common, texts whose fingerprints are linked are compared still, and only similar ones are linked."""
    dice = random.Random(14)
    base = [f"w{i}" for i in dice.sample(range(9_000), 900)]
    filler = " ".join(["over and again"] * 400)  # three shingles decide every bit

    def near(text):
        return (simhash.fingerprint_of(text.encode()) ^ simhash.fingerprint_of(" ".join(base).encode())).bit_count() <= 2

    texts = {1: " ".join(base), 2: next(filter(near, (" ".join([*base, f"more{i}"]) for i in range(1_000)))), 3: " ".join(base[:450]), 4: f"{filler} one end", 5: f"{filler} {' '.join(base[:9])}"}
    plain = {i: simhash.fingerprint_of(t.encode()) for i, t in texts.items()}
    assert (plain[1] ^ plain[2]).bit_count() <= 2 and (plain[4] ^ plain[5]).bit_count() <= 2
    docs = near_copies.ids_and_texts(documents(*texts.items()))
    marked = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), near_copies.described("text").alias("set"), simhash.fingerprint("text").alias("fingerprint")
    ).select("doc_id", "text_hash", "fingerprint", "set.*")
    first = F.struct(F.lit(False).alias("none"), "doc_id", "text_hash").alias("first")
    nodes = marked.select("key", first, "size", F.array().cast("array<bigint>").alias("bands"))
    ids = {r["key"]: r["doc_id"] for r in marked.collect()}
    found = near_copies.links(nodes, docs, near_copies.fingerprint_bands(marked)).collect()
    assert [sorted((ids[r["a"]], ids[r["b"]])) for r in found] == [[1, 2]]
