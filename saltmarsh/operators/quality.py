"""Quality of descriptions: flags in a fixed order, a score, and what to do with them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fragments that OCR leaves of decorations.
NOISE = ("aono", "ocrojojo", "ojsjojo", "fragance", "mineral cruelty", "paraben free", "oil free", "free free", "ree ree", "ree", "vaneue", "+ informacion", "+ información", "odo tipo de piel")
MIN_CHARS = 40
STATUSES = ("pass", "reconstruct", "quarantine")
OCR_ENGINES = ("tesseract", "paddleocr", "ocr")


_WORD = r"[\p{L}\p{N}_]"
# The letters of the catalogue's languages, small and great.
_SMALL, _GREAT = "a-záéíóúñü", "A-ZÁÉÍÓÚÑÜ"


def _collapsed(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def _token(words: str) -> str:
    return rf"(?<!{_WORD})(?:{words})(?!{_WORD})"


def noise_tokens(text: Column, tokens: tuple[str, ...] = NOISE) -> Column:
    """Sorted noise tokens that stand in the text as whole words."""
    low = F.lower(text)
    each = F.array_compact(F.array(*[F.when(low.rlike(_token(re.escape(t))), F.lit(t)) for t in sorted(tokens)]))
    return F.when(low.rlike(_token("|".join(map(re.escape, tokens)))), each).otherwise(F.array().cast("array<string>"))


def flags(raw: Column, engine: Column | None = None, reconstructed: Column | None = None, min_chars: int = MIN_CHARS, tokens: tuple[str, ...] = NOISE) -> Column:
    """Names of the defects found, in order."""
    return _flags(raw, _collapsed(raw), F.lower(_collapsed(raw)), engine, reconstructed, min_chars, tokens)


def _flags(raw: Column, t: Column, low: Column, engine: Column | None = None, reconstructed: Column | None = None, min_chars: int = MIN_CHARS, tokens: tuple[str, ...] = NOISE) -> Column:
    """t: the text with single spaces; low: that in small letters. Patterns look at each place of the text once."""
    size = F.char_length(t)
    found = [
        F.when(size == 0, "empty").when(size < min_chars, "too_short"),
        F.when(t.rlike("[ÃÂ�]"), "mojibake"),
        F.when(low.rlike(_token("|".join(map(re.escape, sorted(tokens, key=len, reverse=True))))), "ocr_noise_tokens"),
        F.when(low.rlike(rf"(?<!{_WORD})({_WORD}++) \1(?!{_WORD})"), "repeated_words"),
        F.when(low.rlike(rf"{_WORD}- [a-záéíóúñ]"), "split_word"),
        F.when(t.rlike(rf"(?<!{_WORD})[{_SMALL}]++[{_GREAT}][{_SMALL}]++(?!{_WORD})"), "mixed_case_word"),
        F.when((size >= min_chars) & ~t.rlike("[.!?]") & ~F.coalesce(raw, F.lit("")).contains("\n"), "no_sentence_structure"),
    ]
    if engine is not None:
        strict = F.element_at(F.split(engine, r"\+"), -1).isin(*OCR_ENGINES)
        found.append(F.when(strict & ~(reconstructed if reconstructed is not None else F.lit(False)), "visual_layout_not_reconstructed"))
    return F.array_compact(F.array(*found))


def status(f: Column) -> Column:
    """Nothing, or not even a text: those are clear; the rest can be rebuilt."""
    return F.when(F.size(f) == 0, "pass").when(F.array_contains(f, "empty") | F.array_contains(f, "mojibake"), "quarantine").otherwise("reconstruct")


def score(f: Column) -> Column:
    return F.greatest(F.lit(0), 100 - 18 * F.size(f))


def assess(df: DataFrame, text: str, **options) -> DataFrame:
    """df with flags, status and score; what they are made of is bound once, in columns that go again."""
    bound = df.withColumn("_collapsed", _collapsed(F.col(text))).withColumn("_low", F.lower("_collapsed"))
    found = bound.withColumn("flags", _flags(F.col(text), F.col("_collapsed"), F.col("_low"), **options)).drop("_collapsed", "_low")
    return found.withColumn("status", status(F.col("flags"))).withColumn("score", score(F.col("flags")))


def status_counts(assessed: DataFrame) -> DataFrame:
    """One row: a count for each status, zeros too."""
    return assessed.agg(*[F.count_if(F.col("status") == s).alias(s) for s in STATUSES], F.count("*").alias("total"))
