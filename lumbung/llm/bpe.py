"""Byte-level BPE: encoding by a rank queue over a hierarchical bitmap, and decoding.

A text is cut by the vocabulary's pattern into pre-tokens. Inside a pre-token the
pair of neighbours with the lowest rank is merged first, the leftmost of equal
ones, until no pair has a rank. The queue holds, for each rank, a bucket of
positions of a linked list of tokens. A bitmap with one bit per rank says which
buckets are filled, a second one which words of the first are not zero, so the
lowest rank takes two find-first-set steps, however long the pre-token is.
Entries whose pair has changed since are skipped when they come up.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Callable
from heapq import heappop, heappush
from sys import getsizeof

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbung.llm.tables import whole_rows

RANKS = "byte_bpe_50k.tiktoken"
BITS = 8  # 2**BITS ranks in a word of the lower bitmap
MASK = (1 << BITS) - 1
REMEMBERED_BYTES = 160 * 1024**2  # of strings and their ids that a worker keeps, however many texts it meets
BYTES_PER_ENTRY = 64  # of the dictionary itself
LONGEST_REMEMBERED = 64


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token."""
    rank_of = ranks.get
    whole = rank_of(piece)
    if whole is not None:
        return [whole]
    size = len(piece)
    after, before = list(range(1, size + 1)), list(range(-1, size))  # the linked list of tokens, by first byte
    pair = [rank_of(piece[i : i + 2]) for i in range(size - 1)]  # rank of the pair that begins at a token
    pair.append(None)
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}  # the lower bitmap, by word
    filled = 0  # the upper bitmap: words that are not zero
    fresh = enumerate(pair)
    while True:
        for position, rank in fresh:
            if rank is None:
                continue
            bucket = buckets.get(rank)
            if bucket:
                heappush(bucket, position)
            else:
                buckets[rank] = [position]
                high = rank >> BITS
                words[high] = words.get(high, 0) | 1 << (rank & MASK)
                filled |= 1 << high
        fresh = ()
        if not filled:
            break
        high = (filled & -filled).bit_length() - 1
        word = words[high]
        lowest = word & -word
        rank = high << BITS | lowest.bit_length() - 1
        bucket = buckets[rank]
        i = heappop(bucket)
        if not bucket:
            words[high] = word = word ^ lowest
            if not word:
                filled ^= 1 << high
        if pair[i] != rank:
            continue
        gone = after[i]
        end = after[i] = after[gone]
        before[end] = i
        pair[gone] = None
        pair[i] = right = rank_of(piece[i : after[end]]) if end < size else None
        left = before[i]
        if left < 0:
            fresh = ((i, right),)
        else:
            pair[left] = joined = rank_of(piece[left:end])
            fresh = ((i, right), (left, joined))
    ids, i = [], 0
    while i < size:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class Remembered(dict):
    """Ids of short strings that begin with a pre-token and end with one: pre-tokens, and words with what is at them.

    There are two generations with half of the budget in bytes each. When the younger one is full it becomes the older
    one, whose strings are forgotten unless they are met again meanwhile. A pre-token is cut alone as it is in its text:
    the pattern looks ahead behind white space only.
    """

    def __init__(self, codec: Codec, budget: int):
        super().__init__()
        self.codec, self.half, self.older = codec, budget // 2, {}
        self.room = self.half

    def __missing__(self, part: str) -> bytes:
        return self.kept(part, self.codec.pieces)

    def kept(self, part: str, encode: Callable[[str], bytes]) -> bytes:
        ids = self.older.get(part)
        if ids is None:
            ids = encode(part)
        if len(part) <= LONGEST_REMEMBERED:
            self.room -= getsizeof(part) + getsizeof(ids) + BYTES_PER_ENTRY
            if self.room < 0:
                self.older = None  # given back before the copy is made
                self.older = self.copy()
                self.clear()
                self.room = self.half
            self[part] = ids
        return ids


class Codec:
    """Token ids are kept as packed 32-bit numbers, which join without an object per token."""

    def __init__(self, path: str, pattern: str, budget: int = REMEMBERED_BYTES):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())
        self.pattern = regex.compile(pattern)
        # White space next to a space, which the pattern may join with its surroundings.
        self.loose = regex.compile(r" (?:\s|(?<=\s ))")
        self.remembered = Remembered(self, budget)

    def pieces(self, text: str) -> bytes:
        found = self.pattern.findall(text)
        if len(found) == 1 and len(found[0]) == len(text):
            return self.merged(text)
        known = self.remembered
        return b"".join([known.get(piece) or known.kept(piece, self.merged) for piece in found])

    def merged(self, piece: str) -> bytes:
        return array("i", merge(piece.encode(), self.ranks)).tobytes()

    def encode(self, text: str) -> bytes:
        """A single space always begins a pre-token, so words between single spaces can be looked up one by one."""
        if not text:
            return b""
        if text[0].isspace() or text[-1].isspace() or self.loose.search(text):
            return self.pieces(text)
        known = self.remembered
        head, *rest = text.split(" ")
        return b"".join([known[head], *[known[" " + part] for part in rest]])

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        found = [self.encode(text) if text else b"" for text in texts.to_pylist()]
        offsets = np.cumsum([0, *(len(ids) // 4 for ids in found)])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), np.frombuffer(b"".join(found), np.int32))

    def decode_all(self, sequences: pa.ListArray) -> pa.Array:
        """The bytes of each sequence of ids; those of one after another are cut at the sequences' ends."""
        sequences = sequences.fill_null([])
        spelled = self.tokens.take(sequences.flatten())
        ends = np.concatenate([[0], np.cumsum(sequences.value_lengths().to_numpy())])
        places = np.frombuffer(spelled.buffers()[1], np.int64)[spelled.offset + ends]
        data = spelled.buffers()[2]
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(sequences), [None, pa.py_buffer(places.tobytes()), data]
        ).cast(pa.binary())


@functools.cache
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


IDS = T.ArrayType(T.IntegerType())


def encode(text: str | Column, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """Token ids of a text column; null and empty texts have none. ``ranks`` names a file of the tokenizer folder."""

    @F.arrow_udf(IDS)
    def ids(texts: pa.Array) -> pa.Array:
        return codec(public_tokenizers.path(ranks), pattern).encode_all(texts)

    return ids(text)


def decode(ids: str | Column, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """The bytes of a column of token ids. Ids of a cut sequence need not be whole UTF-8; null has no bytes."""

    @F.arrow_udf(T.BinaryType())
    def text(sequences: pa.Array) -> pa.Array:
        return codec(public_tokenizers.path(ranks), pattern).decode_all(sequences)

    return text(ids)


def there_and_back(text: str | Column, ranks: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Column:
    """A struct of a text's ``ids`` and of the ``decoded`` bytes of those ids, in one pass.

    ``decode(encode(text))`` next to ``encode(text)`` would encode twice, since Spark hands chained Python functions
    to a worker as one.
    """

    @F.arrow_udf(T.StructType().add("ids", IDS).add("decoded", T.BinaryType()))
    def both(texts: pa.Array) -> pa.Array:
        own = codec(public_tokenizers.path(ranks), pattern)
        ids = own.encode_all(texts)
        return pa.StructArray.from_arrays([ids, own.decode_all(ids)], ["ids", "decoded"])

    return both(text)


def tokenized(docs: DataFrame) -> DataFrame:
    """Whole rows with their token ids, in a new column ``token_ids`` (underscores follow if the name is taken).

    Null and empty texts have no ids. Texts of any length are encoded whole, equal texts equally; repeated rows come
    out repeated. No rows, no rows.
    """
    name = "token_ids"
    while name.lower() in map(str.lower, docs.columns):
        name += "_"
    return whole_rows(docs).select("row.*", encode("text").alias(name))
