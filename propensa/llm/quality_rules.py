"""Quality rules as one projection of a threshold table (op 9), native.

The measures of a text (words, symbols, repeated lines and word windows) are
array expressions; ``RULES`` compares ratios of them with thresholds, and
``kept`` is the conjunction of all rows of that table.  No user functions.

Repeated five-word windows are found inside the row: each window is a 64-bit
hash, a sort key packs the hash's low bits above the window's position, and
neighbours in sorted order whose whole hashes agree are repeats.

Cases: a null or empty text has no words and fails; rows are independent, so
repeated rows and ties do not matter; columns other than doc_id and text are
ignored; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensa.llm.arrow import text_of

#: The word separators and symbols of the measures.
SPACE = " \t\n\u000b\f\r"
SPLIT = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: Common words of the languages the rules are meant for.
STOP_WORDS = ["a", "and", "as", "for", "in", "is", "it", "of", "on", "that", "the", "to", "was", "with",
              "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht",
              "sich", "und", "von", "zu", "auf", "au", "avec", "dans", "de", "du", "en", "est", "et", "la",
              "le", "les", "ou", "par", "pas", "pour", "que", "qui", "sur", "un", "une", "con", "del", "el",
              "las", "los", "no", "para", "por", "se", "su", "una", "y"]
#: name, numerator, denominator, least and most quotient.  A numerator of
#: ``stop_words + 1`` leaves texts of up to 100 words without a stop word in.
RULES = [
    ("mean_word_length", "word_chars", "n_words", 1.5, 25.0),
    ("symbol_ratio", "n_symbols", "n_words", 0.0, 0.25),
    ("shouting_ratio", "n_bangs", "n_words", 0.0, 0.25),
    ("stop_word_ratio", "n_stop_words + 1", "n_words", 0.01, None),
    ("repeated_line_ratio", "n_dup_lines", "n_lines", 0.0, 0.3),
]


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules use, one row per row of ``docs``.

    Each step is a projection of its own, so that an array used by several
    expressions is computed once.
    """
    bare = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    split = bare.withColumns({
        "words": F.array_remove(F.split("text", SPLIT), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACE, "") != ""),
        "n_symbols": _drops("text", SYMBOLS), "n_bangs": _drops("text", "!"),
        "word_chars": F.length(F.translate("text", SPACE, "")).cast("long")}).drop("text")
    counted = split.withColumns({
        "n_words": F.size("words").cast("long"), "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_stop_words": F.size(F.filter("words", lambda w: F.btrim(F.lower(w), F.lit(".,;:!?")).isin(STOP_WORDS)))
        .cast("long"),
        "hashes": F.transform("words", lambda w: F.xxhash64(w))}).drop("words", "lines")
    windows = counted.withColumn("windows", F.when(F.col("n_words") >= WINDOW, F.expr(
        f"transform(slice(hashes, 1, size(hashes) - {WINDOW - 1}), (h, i) -> xxhash64(h, "
        + ", ".join(f"get(hashes, i + {k})" for k in range(1, WINDOW)) + "))"))
        .otherwise(F.expr("array(0L)").cast("array<bigint>"))).drop("hashes")
    bits = windows.withColumn("bits", F.expr("length(bin(size(windows)))"))
    bits = bits.withColumn("mask", F.expr("shiftleft(1L, bits) - 1L"))
    keys = bits.withColumn("keys", F.expr("sort_array(transform(windows, (w, i) -> shiftleft(w, bits) | i))"))
    full = "get(windows, cast({} & mask as int))"
    repeated = keys.withColumn("at", F.expr(
        f"sort_array(transform(filter(keys, (k, i) -> {full.format('k')} = {full.format('get(keys, i - 1)')} is true"
        f" or {full.format('k')} = {full.format('get(keys, i + 1)')} is true), k -> k & mask))")).drop("windows", "keys")
    return repeated.withColumn("n_repeat_words", F.expr(
        f"aggregate(transform(at, (p, i) -> least({WINDOW}L, p - coalesce(get(at, i - 1), p - {WINDOW}L))), "
        "0L, (a, x) -> a + x)")).drop("at", "bits", "mask")


def _drops(column: str, characters: str) -> Column:
    """How many of the given characters a text has."""
    return (F.length(column) - F.length(F.translate(column, characters, ""))).cast("long")


def compiled(rules: list = RULES) -> Column:
    """The threshold table as one Boolean expression."""
    verdict = F.lit(True)
    for _, numerator, denominator, least, most in rules:
        over, under = F.expr(numerator).cast("double"), F.expr(denominator).cast("double")
        if least is not None:
            verdict &= over >= least * under
        if most is not None:
            verdict &= over <= most * under
    return verdict


def quality_rules(docs: DataFrame, rules: list = RULES) -> DataFrame:
    """Measures, ``base_failed`` (too few words, or over a fifth of them in
    repeated windows) and ``kept`` of every row of ``docs``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measures(docs).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & compiled(rules))
