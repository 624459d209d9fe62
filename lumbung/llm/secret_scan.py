"""Secrets in texts: fixed formats, and strings that zstandard finds new in a sensitive context.

A candidate is a long string of key characters in a sensitive context: after a
sensitive word on its line (``reach`` characters back at most), also right after
``NAME=``; below the header of a private key; or below a mapping key that has no
value on its own line. It has letters and digits, or letters alone that no word
is made of. Its novelty is the number of bytes that its compression adds, per
character, when the compressor already knows the surrounding text and a
dictionary of identifiers. Names built from known parts
add few bytes; random keys add about one byte per character,
less when they are long. What random strings of that length and alphabet add is
measured, and is what candidates are compared with.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import random
import re
import string
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed formats. Failing matches (see ``base_spans``) are used up like good ones.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")
LEAST_VALUE, LEAST_ACCESS = 8, 16
# Lower-case parts of which every match of ASSIGN has one; they only save the slower search.
ASSIGN_PARTS = ("passw", "secret", "token", "api")

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{16,}")
LEAST_CANDIDATE = 16
INNER_EQUALS = re.compile(r"=+(?=[^=])")  # padding at the end is no separator
CONTEXT = re.compile(
    r"pass(word|wd|phrase)|pwd|secret|token|bearer|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth|credential|signature",
    re.I,
)
REACH = 48  # characters before a candidate that may hold the sensitive word; None: its whole line
HEADER = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----[^\n]*\n")
BODY_LINE = re.compile(r"[ \t>|]*(?:[A-Za-z0-9+/=]+|[A-Za-z-]+: [^\n]*|)[ \t\r]*(?:\n|\Z)")  # base64, a header of it, or nothing
MAPPING_KEY = re.compile(r"""^([ \t{,-]*)["']?[\w.-]+["']?[ \t]*[:=][ \t]*[|>]?[+-]?[ \t\r]*\n""", re.M)
LINE = re.compile(r"([ \t]*)([^\n]*)(?:\n|\Z)")
# Letters alone look drawn at random if their case changes this often, or if so many are letters that words seldom have.
CASE_CHANGES, RARE, LEAST_RARE, LEAST_LETTERS = 1 / 6, "jkqvwxyz", 0.15, 20
SURROUNDINGS = 512  # characters on either side that the compressor knows
LEAST_NOVELTY = 0.9  # share of the bytes that a random string of the same length and alphabet adds
DRAWN = 5  # random strings to compare with
LEVEL = 9
# What names in code and configuration are made of.
IDENTIFIERS = b" ".join(
    b"""access account address admin api application archive auth authorization aws base64 basic bearer bucket build
    cache callback cert certificate class client cloud code com config connection const content cookie create
    credential data database date debug default delete deploy development document domain download email enabled
    endpoint environment error example export false file filename function generated github google handler hash
    header host html http https identifier image import index input instance integer interface java javascript json
    kubernetes label language length license link list local localhost login manager master message metadata method
    module name namespace network null number object option order org output package page param password path port
    private production project property protocol provider public query record region release repository request
    resource response result return role root schema secret security server service session setting signature size
    source staging static status storage string struct system table target template test text time timeout timestamp
    token true type update upload url user username value variable vector version window www xml yaml 2019 2020 2021
    2022 2023 2024 2025 2026 0123456789 abcdefghijklmnopqrstuvwxyz""".split()
)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found: list[tuple[str, int, int]] = []
    lowered = text.lower()
    if any(part in lowered for part in ASSIGN_PARTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


@functools.cache
def empty_frame() -> int:
    return len(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress(b""))


def novelty(candidate: str, surroundings: str) -> float:
    """Bytes that the candidate adds to what is known already, per character."""
    known = zstandard.ZstdCompressionDict(IDENTIFIERS + b" " + surroundings.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)
    return (len(packer.compress(candidate.encode())) - empty_frame()) / len(candidate)


def alphabet_of(value: str) -> str:
    """The smallest usual alphabet of keys that has all characters of a string."""
    for usual in ("0123456789ABCDEF", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        if set(value) <= set(usual):
            return usual
    classes = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
    return "".join(c for c in classes if set(c) & set(value)) + "".join(sorted(set(value) - set("".join(classes))))


@functools.lru_cache(4096)
def usual_novelty(length: int, alphabet: str) -> float:
    """What random strings of this length and alphabet add per character, at most one byte.

    Long strings get entropy codes, so fewer bytes than characters. The strings are drawn with a fixed seed.
    """
    dice = random.Random(f"{length} {alphabet}")
    drawn = ["".join(dice.choices(alphabet, k=length)) for _ in range(DRAWN)]
    return min(1.0, sum(novelty(one, "") for one in drawn) / DRAWN)


def below(text: str) -> list[tuple[int, int]]:
    """Stretches of lines below key headers and below sensitive mapping keys without a value, in order."""
    found = []
    for header in HEADER.finditer(text):
        end = header.end()
        while end < len(text) and (line := BODY_LINE.match(text, end)):
            end = line.end()
        found.append((header.end(), end))
    for key in MAPPING_KEY.finditer(text):
        if not CONTEXT.search(key.group()):
            continue
        # The next line that is not empty, and those after it that are indented deeper than the key.
        end, lines = key.end(), 0
        while end < len(text) and (line := LINE.match(text, end)):
            if line.group(2).strip():
                if lines and len(line.group(1)) <= len(key.group(1)):
                    break
                lines += 1
            end = line.end()
        found.append((key.end(), end))
    return sorted(found)


class Places:
    """Stretches of a text that can be asked about in any order; each question is a binary search."""

    def __init__(self, stretches: list[tuple[int, int]]):
        ordered = sorted(stretches)
        self.starts = [start for start, _ in ordered]
        self.ends = list(itertools.accumulate((end for _, end in ordered), max))

    def touch(self, start: int, end: int) -> bool:
        """Whether any of them has a place in common with this one."""
        before = bisect.bisect_left(self.starts, end)
        return before > 0 and self.ends[before - 1] > start

    def last_start(self, at: int) -> int:
        """Start of the last one that begins before ``at``; -1 without one."""
        before = bisect.bisect_left(self.starts, at)
        return self.starts[before - 1] if before else -1


@dataclass(frozen=True)
class Surroundings:
    """What a text has to say about any of its candidates."""

    text: str
    taken: Places
    words: Places
    below: Places
    reach: int | None

    def sensitive(self, start: int, end: int) -> bool:
        if self.below.touch(start, end):
            return True
        word = self.words.last_start(start)
        near = self.reach is None or word >= start - self.reach
        return word >= 0 and near and "\n" not in self.text[word:start]


def surroundings_of(text: str, taken: list[tuple[str, int, int]], reach: int | None) -> Surroundings:
    words = Places([m.span() for m in CONTEXT.finditer(text)])
    return Surroundings(text, Places([(s, e) for _, s, e in taken]), words, Places(below(text)), reach)


def drawn_letters(value: str) -> bool:
    """Whether letters look drawn at random rather than written."""
    letters = [c for c in value if c.isalpha()]
    changes = sum(a.islower() != b.islower() for a, b in itertools.pairwise(letters))
    rare = sum(c in RARE for c in value.lower())
    odd = len(letters) >= LEAST_LETTERS and rare >= LEAST_RARE * len(letters)
    return changes >= CASE_CHANGES * len(letters) if changes > 2 else odd


def novel_in(around: Surroundings, start: int, end: int) -> float | None:
    """Novelty of a candidate in a sensitive context, if it is high enough."""
    text, value = around.text, around.text[start:end]
    if end - start < LEAST_CANDIDATE or not any(map(str.isalpha, value)):
        return None
    if not any(map(str.isdigit, value)) and not drawn_letters(value):
        return None
    if not around.sensitive(start, end) or around.taken.touch(start, end):
        return None
    score = novelty(value, text[max(0, start - SURROUNDINGS) : start] + text[end : end + SURROUNDINGS])
    return score if score >= LEAST_NOVELTY * usual_novelty(end - start, alphabet_of(value.rstrip("="))) else None


def novel_spans(text: str, taken: list[tuple[str, int, int]], reach: int | None = REACH) -> list[tuple[str, int, int, float]]:
    """Values after the names they are assigned to (``NAME=value`` is one run of key characters), else whole runs."""
    found, around = [], None
    for match in CANDIDATE.finditer(text):
        around = around or surroundings_of(text, taken, reach)
        start, end = match.span()
        cuts = [m.span() for m in INNER_EQUALS.finditer(match.group())]
        starts = [start, *[start + at for _, at in cuts]]
        ends = [*[start + at for at, _ in cuts], end]
        parts = [*zip(starts, ends)] if cuts else []
        scored = [(s, e, novel_in(around, s, e)) for s, e in parts]
        scored = [one for one in scored if one[2] is not None] or [(start, end, novel_in(around, start, end))]
        found += [("novel", s, e, score) for s, e, score in scored if score is not None]
    return found


def find(text: str, reach: int | None = REACH) -> list[tuple[str, int, int, float | None]]:
    base = base_spans(text)
    found = [(*span, None) for span in base] + novel_spans(text, base, reach)
    return sorted(found, key=lambda span: (span[1], KINDS.index(span[0])))


SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.IntegerType())
    .add("end", T.IntegerType())
    .add("novelty", T.DoubleType())
)
ARROW_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("novelty", pa.float64())])
)


def spans(text: str | Column, reach: int | None = REACH) -> Column:
    """All spans of a text in code points (end exclusive), by start, then by kind. Null and empty texts have none.

    ``novelty`` is null for the fixed formats, which are reported whatever their novelty. ``reach`` is how far
    before a candidate its line is searched for a sensitive word; with None it is the whole line. Texts of any
    length are searched whole, in proportion to their length; equal texts have equal spans.
    """

    @F.arrow_udf(SPANS)
    def scan(texts: pa.Array) -> pa.Array:
        names = ("kind", "start", "end", "novelty")
        return pa.array([[dict(zip(names, s)) for s in find(t, reach)] if t else [] for t in texts.to_pylist()], ARROW_SPANS)

    return scan(text)
