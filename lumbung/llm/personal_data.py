"""Personal data by candidate boosting, in Spark's own functions only.

Generators with high recall propose spans. Those of fixed formats are reported
as they are. The others are scored by boosted trees over features of the string
and its surroundings; the trees are trained on the labelled examples of
``personal_examples``, their sums calibrated on examples kept apart, and each
kind has the lowest threshold that is precise enough there. Generators overlap;
where spans are redacted, overlapping ones become one.

Positions come from cutting a text by a pattern: pieces and matches alternate,
so their lengths add up to where each match starts. Lengths are in code points.

Patterns are written for a matcher that backtracks: runs are possessive and only
begin where a run begins (or right after a match), so long runs without a match
cost no more than one look at each character.
"""

from __future__ import annotations

import functools
import json
import math
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm.personal_examples import EXAMPLES
from lumbung.llm.tables import named
from lumbung.llm.trees import Tree, grow, value_of

BASE = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
APART = r"(?:\) ?| / |[ ./-]| \()?"  # between two digits of a local phone number
# What a text must contain for a pattern to be worth trying, and the pattern.
PATTERNS = {
    "email": ("@", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("[0-9]", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
    # Any 7 to 12 digits with single separators; dates, amounts and numbers of things are left to the trees.
    "local_phone": (
        "[0-9]",
        rf"(?<![0-9A-Za-z+().,:_-])(?<![0-9+)] )(?<![0-9] / )(?![0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}(?![0-9-]))\(?[0-9](?:{APART}[0-9]){{6,11}}+(?!{APART}[0-9]|[A-Za-z])",
    ),
    "national_id": ("[0-9]-", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
    "iban": ("[A-Z]{2}[0-9]{2}", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    "spelled_email": (
        "(?i)[(\\[]at[)\\]]",
        r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Z0-9-]++)++",
    ),
}
# Numbers are what the pattern of cards finds and the check of cards refuses.
EXTRA = ("number", *(k for k in PATTERNS if k not in BASE))
BEFORE, AFTER = 32, 8
CONTEXT = (
    r"(?i)(card|visa|master|account|konto|compte|cuenta|iban|bank|phone|tel\b|tel[.:]|telef|mobil|call|fax|handy|ssn|social|"
    r"security|passport|tax|mail|contact|reach|kontakt|contacto)"
)
AGAINST = r"(?i)(isbn|order|invoice|tracking|serial|part|sku|version|model|build|ticket|commit|timestamp|date|no\.|#|\$|€|=)\W*$"
# Days, with the year first or last.
DAY, MONTH, YEAR = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])", "(?:19|20)[0-9]{2}"
DATE = rf"^(?:{YEAR}[ ./-]?{MONTH}[ ./-]?{DAY}|{DAY}[ ./-]{MONTH}[ ./-]{YEAR}|{MONTH}[ ./-]{DAY}[ ./-]{YEAR}|{YEAR}[ /-]{YEAR})"
FEATURES = (
    "kind", "digits", "length", "marks", "luhn", "distinct", "context", "against", "glued", "measure", "two_letters", "opens", "groups",
    "thousands", "date",
)
ROUNDS, DEPTH, RATE, LEAST_PRECISION = 40, 3, 0.3, 0.95


def positions(text: Column, kind: str) -> Column:
    """kind, start, end and value of every match, in order."""
    needed, pattern = PATTERNS[kind]
    pieces = F.split(text, pattern)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")

    def add(sofar: Column, pair: Column) -> Column:
        start = sofar["at"] + F.char_length(pair["piece"])
        end = start + F.char_length(pair["value"])
        here = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        known = F.concat(sofar["found"], F.array(here))
        return F.struct(end.alias("at"), known.alias("found"))

    pairs = F.arrays_zip(pieces, matches).cast("array<struct<piece: string, value: string>>")
    walked = F.aggregate(
        F.filter(pairs, lambda pair: pair["value"].isNotNull()),
        F.struct(F.lit(0).alias("at"), none.alias("found")),
        add,
        lambda sofar: sofar["found"],
    )
    return F.when(text.rlike(needed), walked).otherwise(none)


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits pass the check of card numbers."""
    digits = F.reverse(only_digits(value))
    places = F.sequence(F.lit(1), F.greatest(F.char_length(digits), F.lit(1)))

    def worth(place: Column) -> Column:
        digit = F.coalesce(F.substring(digits, place, F.lit(1)).try_cast("int"), F.lit(0))
        twice = digit * 2
        return F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(places, F.lit(0), lambda total, place: total + worth(place)) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """What a match of a fixed format must fulfil besides its pattern."""
    value = match["value"]
    digits = F.char_length(only_digits(value))
    if kind == "ip":
        # Leading zeros aside, a part of more than three digits is above 255.
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: (F.char_length(p) <= 3) & (F.substring(p, 1, 3).cast("int") <= 255))
    if kind == "card":
        return digits.between(13, 19) & luhn(value)
    if kind == "phone":
        return digits.between(9, 15)
    return F.lit(True)


def features(kind: str | Column, value: Column, before: Column, after: Column) -> dict[str, Column]:
    digits = only_digits(value)
    flag = lambda condition: condition.cast("double")
    code = F.lit(float(EXTRA.index(kind))) if isinstance(kind, str) else (F.array_position(F.lit(list(EXTRA)), kind) - 1).cast("double")
    return {
        "kind": code,
        "digits": F.char_length(digits).cast("double"),
        "length": F.char_length(value).cast("double"),
        "marks": F.char_length(F.regexp_replace(value, "[0-9A-Za-z]", "")).cast("double"),
        "luhn": flag(luhn(value)),
        "distinct": F.size(F.array_distinct(F.split(digits, ""))).cast("double"),
        "context": flag(before.rlike(CONTEXT)),
        "against": flag(before.rlike(AGAINST)),
        "glued": flag(before.rlike(r"[\p{L}\p{N}_.,/\\:-]$")) + flag(after.rlike(r"^[\p{L}_/\\:]|^[.,][0-9]")),
        "measure": flag(after.rlike(r"^ ?(%|px|kg|km|cm|mm|ms|USD|EUR)")),
        "opens": flag(value.rlike(r"^(?:0|\()")),
        "groups": F.size(F.split(F.regexp_replace(value, "[^0-9]+", " "), " ")).cast("double"),
        "thousands": flag(value.rlike(r"^[1-9][0-9]{0,2}(?:([ .])[0-9]{3})(?:\1[0-9]{3})+$")),
        "date": flag(value.rlike(DATE)),
        "two_letters": flag(value.rlike("^(AT|BE|CH|CZ|DE|DK|ES|FI|FR|GB|HU|IE|IT|LU|NL|NO|PL|PT|RO|SE|SK)")),
    }


# ------------------------------------------------------------------ training


@functools.cache
def boosted(table: tuple[tuple[float, ...], ...]) -> tuple[tuple[Tree, ...], float, float, dict[int, float]]:
    """Trees, calibration (slope, offset) and thresholds by kind, from rows of features and a label.

    Every third row is kept for calibration and thresholds.
    """
    rows = np.array(table)
    x, y = rows[:, :-1], rows[:, -1]
    apart = np.arange(len(rows)) % 3 == 2
    base = math.log((y[~apart].sum() + 1) / ((1 - y[~apart]).sum() + 1))
    sums, trees = np.full(len(rows), base), []
    for _ in range(ROUNDS):
        chance = 1 / (1 + np.exp(-sums))
        slope, bend = (y - chance)[~apart], (chance * (1 - chance))[~apart]

        def leaf(found: np.ndarray, slope=slope, bend=bend) -> float:
            return RATE * float(np.clip(slope[found].sum() / (bend[found].sum() + 1.0), -4, 4))

        tree = grow(x[~apart], slope, np.ones(len(slope)), DEPTH, 3.0, leaf)
        trees.append(tree)
        sums += np.array([value_of(tree, row) for row in x])
    a, b = 1.0, 0.0
    for _ in range(200):  # logistic fit of the kept rows' labels to their sums, held near the identity
        error = 1 / (1 + np.exp(-(a * sums[apart] + b))) - y[apart]
        a -= 0.05 * float((error * sums[apart]).mean() + 0.01 * (a - 1))
        b -= 0.05 * float(error.mean() + 0.01 * b)
    chance = 1 / (1 + np.exp(-(a * sums + b)))
    limits = {}
    for kind in range(len(EXTRA)):
        mine = apart & (x[:, 0] == kind)
        limits[kind] = 0.5
        for limit in sorted(chance[mine]):
            chosen = mine & (chance >= limit)
            if y[chosen].mean() >= LEAST_PRECISION:
                # Halfway down to the next lower example, at least even odds.
                lower = chance[mine & (chance < limit)]
                limits[kind] = max(0.5, float(limit + (lower.max() if len(lower) else 0.0)) / 2)
                break
    return tuple(trees), a, a * base + b, limits


def learnt(spark: SparkSession) -> tuple:
    """Score the labelled examples' features with the same expressions as texts, then train on them."""
    examples = spark.range(1).select(
        F.inline(F.from_json(F.lit(json.dumps(EXAMPLES())), "array<struct<kind: string, before: string, value: string, after: string, label: double>>"))
    )
    found = features(F.col("kind"), F.col("value"), F.col("before"), F.col("after"))
    rows = examples.select(*[found[name].alias(name) for name in FEATURES], "label").collect()  # some hundred examples
    return boosted(tuple(tuple(row) for row in rows))


def tree_column(tree: Tree, found: dict[str, Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, threshold, low, high = tree
    return F.when(found[FEATURES[feature]] <= threshold, tree_column(low, found)).otherwise(tree_column(high, found))


# ------------------------------------------------------------------ texts


def with_spans(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, the columns named in ``keep``, ``base`` and ``added`` spans (kind, start, end).

    Both are by kind, then start. An added span never touches a base one. Null texts are empty and have no spans;
    texts of any length are searched whole, repeated rows come out repeated. No rows, no rows.
    """
    trees, a, b, limits = learnt(docs.sparkSession)
    rows = docs.select(
        *keep,
        named("doc_id").cast("long").alias("doc_id"),
        F.coalesce(named("text").cast("string"), F.lit("")).alias("text"),
    )
    columns = [*keep, "doc_id", "text"]
    # Each step is a selection of its own, so that nothing is searched twice.
    found = rows.select(*columns, *[positions(F.col("text"), kind).alias(kind) for kind in PATTERNS])
    base = F.concat(
        *[F.transform(F.filter(kind, partial(holds, kind)), partial(span, kind)) for kind in BASE]
    )
    sources = {kind: "card" if kind == "number" else kind for kind in EXTRA}
    proposed = F.concat(*[F.transform(found_as, partial(proposal, kind)) for kind, found_as in sources.items()])
    offered = found.select(*columns, base.alias("base"), proposed.alias("proposed"))
    free = F.filter("proposed", lambda p: ~F.exists("base", lambda s: (s["start"] < p["end"]) & (p["start"] < s["end"])))
    described = offered.select(*columns, "base", F.transform(free, lambda p: describe(p)).alias("described"))

    def scored(p: Column) -> Column:
        values = {name: p[name] for name in FEATURES}
        total = functools.reduce(Column.__add__, [tree_column(tree, values) for tree in trees])
        limit = functools.reduce(lambda c, k: c.when(p["kind"] == float(k), limits[k]), limits, F.when(F.lit(False), 1.0))
        chance = 1 / (1 + F.exp(-(total * a + b)))
        return F.struct(p["name"].alias("kind"), p["start"].alias("start"), p["end"].alias("end"), (chance >= limit).alias("taken"))

    chosen = F.filter(F.transform("described", scored), lambda p: p["taken"])
    plain = F.transform(chosen, lambda p: F.struct(p["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))
    return described.select(*columns, "base", F.sort_array(plain).alias("added"))


def span(kind: str, match: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), match["start"].alias("start"), match["end"].alias("end"))


def proposal(kind: str, match: Column) -> Column:
    return F.struct(
        F.lit(kind).alias("name"), match["start"].alias("start"), match["end"].alias("end"), match["value"].alias("value")
    )


def describe(p: Column) -> Column:
    text = F.col("text")
    first = F.greatest(p["start"] - BEFORE, F.lit(0))
    before = F.substring(text, first + 1, p["start"] - first)
    after = F.substring(text, p["end"] + 1, F.lit(AFTER))
    found = features(p["name"], p["value"], before, after)
    return F.struct(p["name"].alias("name"), p["start"].alias("start"), p["end"].alias("end"), *[found[f].alias(f) for f in FEATURES])


def redacted(docs: DataFrame) -> DataFrame:
    """Whole rows with every span replaced by its kind in brackets; overlapping spans become one, named by the first.

    ``n_chars``, where there is such a column, is counted again. Null texts stay null.
    """
    packed = F.struct(*[named(c).alias(c) for c in docs.columns]).alias("row")
    found = with_spans(docs.select(packed, named("doc_id"), named("text")), keep=("row",))
    ordered = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("minus_end"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
    )
    rows = found.select("row", "text", ordered.alias("spans"))

    def cut(sofar: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), sofar["at"] + 1, F.greatest(s["start"] - sofar["at"], F.lit(0)))
        fresh = F.concat(sofar["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))
        out = F.when(s["start"] >= sofar["at"], fresh).otherwise(sofar["out"])
        return F.struct(F.greatest(sofar["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    finish = lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.char_length("text")))
    text = F.when(F.size("spans") == 0, F.col("text")).otherwise(F.aggregate("spans", start, cut, finish))
    changed = rows.select("row", F.when(F.col("row.text").isNotNull(), text).alias("new_text"))
    out = []
    for c in docs.columns:
        value = F.col("row").getField(c)
        if c == "text":
            value = F.col("new_text")
        elif c == "n_chars":
            value = F.coalesce(F.char_length("new_text").cast(docs.schema[c].dataType), value)
        out.append(value.alias(c))
    return changed.select(*out)
