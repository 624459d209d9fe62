"""Quality rules as a short-circuit cascade, in Spark's own functions only.

A document is kept if no rule rejects it, in whatever order they are asked. Every
rule says what it costs a row: the characters and words it has to go through
again, and one unit for asking. On a sample, drawn by a hash of the ids and never
leaving the executors, mean cost and share of rejected rows are estimated, in one
job; rules then stand in order of rejections per cost in one CASE expression,
which asks no further once a rule has rejected. Costs are counted, not timed, so
the order is the same on every run. It changes the cost, never a verdict.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.llm.tables import named

WHITE_SPACE, WORD = r"[ \t-\r]+", r"[^ \t-\r]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW_WORDS = 8
LEAST_WORDS, MOST_REPEATED = 20, 30  # words; per cent of words in repeated windows
SAMPLE_ROWS = 500  # about so many rows are looked at for costs and rejections; they decide the order only


class Rule(NamedTuple):
    """What rejects a row, and what asking costs: characters or words that are gone through once more."""

    rejects: Column
    cost: Column


def rules() -> dict[str, Rule]:
    """All rules, built when a session is there. Those on base counts only compare numbers."""
    words, chars, free = F.greatest("n_words", F.lit(1)), F.char_length("text"), F.lit(0)
    letters = F.regexp_count("text", F.lit(r"\p{L}"))
    # Words equal to the one before; only counted where this rule is asked.
    stutter = F.size(F.filter("hashes", lambda hash, at: F.coalesce(F.get("hashes", at - 1) == hash, F.lit(False))))
    return {
        "mean_word_length": Rule(~F.expr("word_chars / greatest(n_words, 1)").between(2, 20), free),
        "symbols": Rule(F.col("n_symbols") > 0.1 * words, free),
        "repeated_lines": Rule(F.col("n_dup_lines") > F.greatest(0.3 * F.col("n_lines"), F.lit(2)), free),
        "exclamations": Rule(F.regexp_count("text", F.lit("!")) > 0.3 * words, chars),
        "capitals": Rule(F.regexp_count("text", F.lit(r"\p{Lu}")) > 0.5 * F.greatest(letters, F.lit(1)), 2 * chars),
        "few_letters": Rule(letters < 0.5 * F.col("word_chars"), chars),
        "stutter": Rule(stutter > 0.3 * words, F.col("n_words")),
        "ellipses": Rule(
            F.regexp_count("text", F.lit(r"(?:\.\.\.|…)[ \t\r]*(?:\n|$)")) > 0.3 * F.greatest("n_lines", F.lit(1)), chars
        ),
    }


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, text, the base counts and the words' hashes of every row. Null texts have no words.

    Steps are separate selections: what a lambda looks up has to be a finished column, or it would be computed
    again for every element. Each array is named twice in the next step, so Spark does not merge the steps.
    """
    texts = docs.select(
        named("doc_id").cast("long").alias("doc_id"), F.coalesce(named("text").cast("string"), F.lit("")).alias("text")
    )
    cut = texts.withColumns(
        {
            "words": F.array_remove(F.split("text", WHITE_SPACE), ""),
            "lines": F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD)),
        }
    )
    hashed = cut.select(
        "doc_id",
        "text",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    counts = ("doc_id", "text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines")
    # A window's hash comes from the hashes of its words, in order.
    counts = (*counts, "hashes")
    windows = hashed.select(
        *counts,
        F.when(
            F.size("hashes") >= WINDOW_WORDS,
            F.transform(
                F.sequence(F.lit(1), F.size("hashes") - (WINDOW_WORDS - 1)),
                lambda first: F.xxhash64(F.slice("hashes", first, WINDOW_WORDS)),
            ),
        )
        .otherwise(F.array().cast("array<bigint>"))
        .alias("windows"),
    )
    # Only texts with a repeated window are looked at further: equal hashes stand together once sorted.
    ordered = windows.select(
        *counts,
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda hash, at: F.struct(hash.alias("hash"), at.alias("at")))),
        ).alias("ordered"),
    )
    repeated = ordered.select(
        *counts,
        F.when(
            F.col("ordered").isNotNull(),
            F.array_sort(
                F.transform(
                    F.filter(
                        F.transform("ordered", lambda one, i: F.struct(one["at"].alias("at"), alike(one, i).alias("alike"))),
                        lambda one: one["alike"],
                    ),
                    lambda one: one["at"],
                )
            ),
        ).alias("starts"),
    )
    # Words covered: up to the next repeated window, and all of the last one.
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda start, i: F.least(F.lit(WINDOW_WORDS), F.coalesce(F.get("starts", i + 1) - start, F.lit(WINDOW_WORDS))),
        ),
        F.lit(0),
        lambda total, words: total + words,
    )
    return repeated.select(*counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def alike(one: Column, i: Column) -> Column:
    """Whether a sorted window has an equal neighbour."""
    before, after = F.get("ordered", i - 1)["hash"], F.get("ordered", i + 1)["hash"]
    return F.coalesce(before == one["hash"], F.lit(False)) | F.coalesce(after == one["hash"], F.lit(False))


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About so many documents, spread over all of them by a hash of the id; all, if there are fewer."""
    one_of = max(1, docs.count() // rows)
    return docs.filter(F.pmod(F.xxhash64(named("doc_id"), F.lit("sample")), F.lit(one_of)) == 0)


def cheapest_first(docs: DataFrame, found: Mapping[str, Rule], sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by rejections per cost on a sample; equal ones by name. One row comes to the driver."""
    asked = []
    for i, rule in enumerate(found.values()):
        asked += [F.count_if(rule.rejects).alias(f"rejected{i}"), (F.count("*") + F.coalesce(F.sum(rule.cost), F.lit(0))).alias(f"cost{i}")]
    row = counted(sampled(docs, sample_rows)).agg(*asked).first()
    worth = {name: row[f"rejected{i}"] / max(row[f"cost{i}"], 1) for i, name in enumerate(found)}
    return sorted(found, key=lambda name: (-worth[name], name))


def cascade(found: Mapping[str, Rule], order: Sequence[str]) -> Column:
    """The first rule in ``order`` that rejects a row, or null."""
    first = F.when(F.lit(False), F.lit(""))
    for name in order:
        first = first.when(found[name].rejects, F.lit(name))
    return first


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: its counts, whether the base rules reject it, whether it is kept.

    Null and empty texts, and texts of white space, have no words and are rejected. Repeated rows come out
    repeated, rows without an id stay. No rows, no verdicts.
    """
    rows, found = counted(docs), rules()
    order = cheapest_first(docs, found)
    base_failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    verdict = rows.withColumn("base_failed", base_failed)
    kept = F.when(F.col("base_failed"), False).otherwise(cascade(found, order).isNull())
    return verdict.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        kept.alias("kept"),
    )
