"""Line-first cleaning: rules judge every line, failing lines go, and documents that lose too much text are rejected.

DataFrame functions only. Higher-order functions are evaluated outside generated code, so a value that several of them
use is bound once (``_let``) instead of being repeated.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
WINDOW = 3

# Fixed values of the line rules.
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"""[.!?…:;。！？]["'”’»)\]]*$"""
SEPARATORS = ("|", "»", "›", "•", "·", "/", ">", "-")
BOILERPLATE = (
    "all rights reserved",
    "back to top",
    "click here",
    "cookie policy",
    "enable javascript",
    "lorem ipsum",
    "privacy policy",
    "terms of service",
    "terms of use",
)

MAX_SYMBOL_PERCENT = 10
MIN_DISTINCT_PERCENT = 30
MIN_RULE_WORDS = 10
#: Up to so many different repeated windows are looked up one by one; more are found by sorting. Both are exact.
LOOKED_UP = 32


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")


def _matches(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _covered(starts: Column) -> Column:
    """Words that windows at these sorted starts cover."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).alias("end")),
        lambda done, at: F.struct(
            (done["total"] + WINDOW - F.greatest(done["end"] - at, F.lit(0))).alias("total"), (at + WINDOW).alias("end")
        ),
        lambda done: done["total"],
    )


def with_repeated_words(rows: DataFrame, words: str, column: str) -> DataFrame:
    """``rows`` with a ``column``: how many of the ``words`` are in windows of three that occur at least twice among
    them, first occurrences included.

    Every window has a 64-bit hash; equal neighbours among the sorted hashes are repeats. The cost is n log n for long
    and for very repetitive texts too.
    """
    codes, ordered, repeats = (f"{column}_{name}" for name in ("codes", "ordered", "repeats"))
    word = F.col(words)
    code = lambda at: F.xxhash64(*(F.get(word, at + i) for i in range(WINDOW)))
    last = F.size(word) - WINDOW
    places = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn(codes, F.transform(places, code))
    rows = rows.withColumn(ordered, F.sort_array(codes))
    doubled = F.filter(ordered, lambda one, k: F.coalesce(F.get(ordered, k + 1) == one, F.lit(False)))
    rows = rows.withColumn(repeats, F.array_distinct(doubled))

    numbered = F.transform(codes, lambda one, at: F.struct(one.alias("code"), at.alias("at")))
    looked_up = F.transform(
        F.filter(numbered, lambda one: F.array_contains(repeats, one["code"])), lambda one: one["at"]
    )

    def by_sorting(windows: Column) -> Column:
        same = lambda one, k: F.coalesce(F.get(windows, k)["code"] == one["code"], F.lit(False))
        found = F.filter(windows, lambda one, k: same(one, k - 1) | same(one, k + 1))
        return F.array_sort(F.transform(found, lambda one: one["at"]))

    n_repeats = F.size(repeats)
    found = (
        F.when(n_repeats == 0, F.lit(0).cast("long"))
        .when(n_repeats <= LOOKED_UP, _covered(looked_up))
        .otherwise(_covered(_let(F.sort_array(numbered), by_sorting)))
    )
    return rows.withColumn(column, found).drop(codes, ordered, repeats)


def line_report(text: Column) -> Column:
    """An array with one struct per line: ``line, words, n_symbols, failed`` (the first rule that fails, or null)."""

    def judged(line: Column, words: Column, n_symbols: Column, folded: Column) -> Column:
        n = F.size(words)
        end = F.substring(F.rtrim(line, F.lit(" \t\x0b\f\r")), -8, 8)
        separators = F.size(F.filter(words, lambda word: word.isin(*SEPARATORS)))
        phrases = functools.reduce(Column.__or__, (folded.contains(phrase) for phrase in BOILERPLATE))
        failed = (
            F.when(n == 0, F.lit(None))
            .when(~end.rlike(SENTENCE_END), "punctuation")
            .when((n >= 4) & (separators * 5 >= n), "navigation")
            .when(n_symbols * 100 > MAX_SYMBOL_PERCENT * F.length(line), "symbols")
            .when((n >= MIN_RULE_WORDS) & (line == F.upper(line)) & (line != folded), "capitals")
            .when((n >= MIN_RULE_WORDS) & (F.size(F.array_distinct(words)) * 100 < MIN_DISTINCT_PERCENT * n), "repetition")
            .when(phrases, "boilerplate")
        )
        return F.struct(
            line.alias("line"), words.alias("words"), n_symbols.cast("long").alias("n_symbols"), failed.alias("failed")
        )

    def of(line: Column) -> Column:
        parts = F.struct(
            words_of(line).alias("words"), _matches(line, SYMBOLS).alias("n_symbols"), F.lower(line).alias("folded")
        )
        return _let(parts, lambda one: judged(line, one["words"], one["n_symbols"], one["folded"]))

    return F.transform(F.split(text, "\n"), of)


def quality_report(documents: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text``; others do not matter) the counts, the verdicts and ``clean_text``.

    ``base_failed``: under 50 words, or over half of the words in repeated three-word windows. ``kept``: not
    ``base_failed``, and at most ``max_lost_percent`` of the words are in lines that a rule removes. ``clean_text`` is the
    text without these lines. A null or empty text has no words and is not kept; its ``clean_text`` is empty. A null
    ``doc_id`` stays null, and repeated rows are judged one by one. Texts of any length are read whole.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return with_judgement(rows, "judged", max_lost_percent).select("doc_id", "judged.*")


def with_judgement(documents: DataFrame, column: str, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """``documents`` with a struct ``column`` of everything that is known about ``text``; null counts as empty."""
    lines, words, repeated = (f"{column}_{name}" for name in ("lines", "words", "repeated"))
    rows = documents.withColumn(lines, line_report(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = rows.withColumn(words, F.flatten(F.transform(lines, lambda one: one["words"])))
    rows = with_repeated_words(rows, words, repeated)

    zero = F.lit(0).cast("long")
    total = F.size(words).cast("long")
    full = F.transform(F.filter(lines, lambda one: F.size(one["words"]) > 0), lambda one: one["line"])
    failing = F.filter(lines, lambda one: one["failed"].isNotNull())
    lost = F.aggregate(failing, zero, lambda done, one: done + F.size(one["words"]))
    held = F.filter(lines, lambda one: one["failed"].isNull())
    base_failed = (total < MIN_WORDS) | (100 * F.col(repeated) > MAX_REPEAT_PERCENT * total)
    found = F.struct(
        total.alias("n_words"),
        F.aggregate(words, zero, lambda done, word: done + F.length(word)).alias("word_chars"),
        F.aggregate(lines, zero, lambda done, one: done + one["n_symbols"]).alias("n_symbols"),
        _let(full, lambda one: F.size(one) - F.size(F.array_distinct(one))).cast("long").alias("n_dup_lines"),
        F.col(repeated).alias("n_repeat_words"),
        lost.alias("n_lost_words"),
        base_failed.alias("base_failed"),
        (~base_failed & (100 * lost <= max_lost_percent * total)).alias("kept"),
        F.array_join(F.transform(held, lambda one: one["line"]), "\n").alias("clean_text"),
    )
    return rows.withColumn(column, found).drop(lines, words, repeated)


def clean_documents(documents: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """``documents`` without those that are rejected, in the columns they had; failing lines are gone from ``text``.

    A column ``n_chars`` is brought up to date where there is one.
    """
    judged = f"judged_{uuid.uuid4().hex}"
    rows = with_judgement(documents, judged, max_lost_percent)
    # Through a generator, since a filter on a plain computed column would have it computed twice.
    rows = rows.select(*(F.col(f"`{name}`") for name in documents.columns), F.explode(F.array(judged)).alias(judged))
    clean = F.col(judged)["clean_text"]
    columns = []
    for name in documents.columns:
        if name == "text":
            columns.append(clean.alias("text"))
        elif name == "n_chars":
            columns.append(F.length(clean).cast(documents.schema[name].dataType).alias(name))
        else:
            columns.append(F.col(f"`{name}`"))
    return rows.filter(F.col(judged)["kept"]).select(*columns)
