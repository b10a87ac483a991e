"""String columns: recognised-text normalisation, similarity, lists and lengths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters commonly misread for digits, and the digit they stand for.
DIGIT_LOOKALIKES = {"o": "0", "O": "0", "l": "1", "L": "1", "I": "1", "]": "1"}
# The wider table adds these letters and deletes these characters.
MORE_LOOKALIKES = {"Q": "0", "|": "1", "S": "5", "s": "5", "Z": "2", "B": "8"}
DELETED_CHARACTERS = " \n-."


def normalise_plate(c: Column) -> Column:
    """Replace look-alike letters by digits and trim."""
    return F.trim(F.translate(c, "".join(DIGIT_LOOKALIKES), "".join(DIGIT_LOOKALIKES.values())))


def normalise_plate_wide(c: Column) -> Column:
    """As ``normalise_plate`` with the wider table; separators are deleted."""
    table = DIGIT_LOOKALIKES | MORE_LOOKALIKES
    return F.trim(F.translate(c, "".join(table) + DELETED_CHARACTERS, "".join(table.values())))


def character_accuracy(truth: Column, guess: Column) -> Column:
    """1 - edit distance / max(length of the truth, 1); may be negative."""
    return 1 - F.levenshtein(truth, guess) / F.greatest(F.length(truth), F.lit(1))


def common_subsequence_length(a: str | Column, b: str | Column) -> Column:
    """Length of the longest common subsequence of two short texts, row by row of the usual table."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    places = F.sequence(F.lit(1), F.length(b))
    first = F.array_repeat(F.lit(0), F.length(b) + 1)

    def next_row(row, letter):
        def cell(new, j):
            left = F.element_at(new, -1)
            return F.array_append(new, F.when(F.substring(b, j, F.lit(1)) == letter, F.get(row, j - 1) + 1).otherwise(F.greatest(F.get(row, j), left)))

        return F.aggregate(places, F.array(F.lit(0)), cell)

    full = F.element_at(F.aggregate(F.split(a, ""), first, next_row), -1)
    return F.when((F.length(a) == 0) | (F.length(b) == 0), 0).otherwise(full)


def indel_ratio(a: str | Column, b: str | Column) -> Column:
    """Similarity with substitution cost two: 2 * LCS / (sum of lengths); 1 for two empty texts."""
    a, b = (F.col(c) if isinstance(c, str) else c for c in (a, b))
    total = F.length(a) + F.length(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * common_subsequence_length(a, b) / total)


def digits_to_number(c: Column, kind: str = "double") -> Column:
    """Keep digits and dots, cast; NULL where that is no number."""
    return F.regexp_replace(c, r"[^\d.]", "").try_cast(kind)


def split_list(c: Column, sentinel: str | None = None) -> Column:
    """Comma list to trimmed items; NULL, empty or sentinel text gives an empty list."""
    empty = F.array().cast("array<string>")
    skip = c.isNull() | (F.trim(c) == "")
    if sentinel is not None:
        skip = skip | (c == sentinel)
    return F.when(skip, empty).otherwise(F.transform(F.split(c, ","), lambda item: F.trim(item)))


def word_count(c: Column) -> Column:
    """Words split on whitespace after dots are removed."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(c, r"\.", ""), r"\s+", " "))
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, " ")))


def join_path(*parts: Column | str) -> Column:
    return F.concat_ws("/", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def first_wrong(truth: Column, *guesses: Column) -> Column:
    """The first guess that is not exactly the truth; NULL if all are exact."""
    out = F.lit(None).cast("string")
    for g in reversed(guesses):
        out = F.when(~g.eqNullSafe(truth), g).otherwise(out)
    return out
