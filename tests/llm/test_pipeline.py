"""The whole pipeline against a plain version over a small folder."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import tiktoken

import corpus_pipeline
from lumbung.llm import bpe, mixing, toxicity
from tests.llm.test_corpus_operators import plain_targets
from tests.llm.test_near_copies import plain_kept


def test_pipeline_equals_a_plain_version(spark, documents, labels, tmp_path):
    dice = random.Random(12)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts = {}
    for i in range(160):
        text = " ".join(dice.choices(words, k=dice.randint(5, 80)))
        if i % 8 == 0:
            text += " scum"
        if i % 5 == 0:
            text += f" ann{i}@mail.example.com or not"
        texts[i] = texts[i - 1] if i % 11 == 5 else text
        if i % 11 == 7:  # near copies: 40 words in common, one or two more
            texts[i] = texts[7] + f" more{i}" if i > 7 else " ".join(words[:40])
    source = {i: f"s{i % 3}" if i % 4 else None for i in texts}
    frames = [documents((i, t), source=source[i]) for i, t in texts.items()]
    docs = frames[0]
    for frame in frames[1:]:
        docs = docs.union(frame)
    docs.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    labels(*[(i, 1, int("scum" in t)) for i, t in texts.items()]).write.parquet(f"{tmp_path}/labels.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")

    model = toxicity.train(read, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    kept = {i: t for i, t in texts.items() if model.score(t) < toxicity.THRESHOLD}
    assert set(texts) - set(kept) == {i for i, t in texts.items() if "scum" in t}
    first = set(plain_kept(kept))
    assert sum(i % 11 == 7 for i in first) == 1 and len(first) < len(kept) - 12
    kept = {i: re.sub(r"ann\d+@mail\.example\.com", "[EMAIL]", t) for i, t in kept.items() if i in first}
    sizes = Counter()
    for i, t in kept.items():
        sizes[source[i]] += len(t.split())
    targets = plain_targets(sizes)
    codec = bpe.codec(public_tokenizers.path(bpe.RANKS), public_tokenizers.PATTERN)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})
    expected = []
    for i, t in kept.items():
        rate = targets[source[i]] / sizes[source[i]]
        u = int(hashlib.md5(f"{mixing.SEED}:{i}".encode()).hexdigest()[:13], 16) / (1 << 52)
        times = int(rate) + (u < rate - int(rate))
        expected += [(i, t, len(t), tuple(library.encode_ordinary(t)))] * times
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["text"], r["n_chars"], tuple(r["token_ids"])) for r in found) == sorted(expected)
