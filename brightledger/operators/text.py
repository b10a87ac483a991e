"""Text cleaning, tokens, n-grams and corpus statistics. All steps are built-in columns over whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.strings import word_count
from brightledger.operators.aggregates import exact_quantiles
from brightledger.session import materialise

# Letter variants with the form they are unified to; the two zero-width marks
# become a space and nothing.
LETTER_VARIANTS = {"ي": "ی", "ك": "ک", "ة": "ه", "ۀ": "ه", "ؤ": "و", "إ": "ا", "أ": "ا", "آ": "ا", "\u200c": " "}
REMOVED_LETTERS = "\u200b"
# Pictograph ranges, repeatable punctuation and vowel marks.
PICTOGRAPHS = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}]+"
REPEATED_PUNCTUATION = r"([؟!.,]){2,}"
VOWEL_MARKS = ["\u064b", "\u064c", "\u064d", "\u064e", "\u064f", "\u0650", "\u0651", "\u0652", "\u0670"]
VOWEL_MARK_CLASS = "[\u064b-\u0652\u0670]"
# Informal expressions and their plain form.
INFORMAL_WORDS = {
    "خخخ": "خنده", "عه": "تعجب", "عهه": "تعجب", "عههه": "تعجب", "عهههه": "تعجب", "اووف": "ناراحتی",
    "اوووف": "ناراحتی", "وای": "تعجب", "ایشالا": "ان\u200cشاءالله", "انشالا": "ان\u200cشاءالله", "الهییی": "دلسوزی",
}
#: Hash buckets that runs of words are counted in, and how many of them are looked into first.
NGRAM_BUCKETS, FIRST_BUCKETS = 1 << 20, 4_096
WORD = r"(?U)\b\w\w+\b"


def unify_letters(c: Column, variants: dict[str, str] = LETTER_VARIANTS, removed: str = REMOVED_LETTERS) -> Column:
    return F.translate(c, "".join(variants) + removed, "".join(variants.values()))


def clean_punctuation(c: Column) -> Column:
    """Drop pictographs, collapse repeated punctuation to its last mark, squeeze whitespace."""
    c = F.regexp_replace(c, PICTOGRAPHS, "")
    c = F.regexp_replace(c, REPEATED_PUNCTUATION, "$1")
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean(c: Column, variants: dict[str, str] = LETTER_VARIANTS, removed: str = REMOVED_LETTERS) -> Column:
    """Full cleaning; a missing text becomes the empty text."""
    return clean_punctuation(unify_letters(F.coalesce(c, F.lit("")), variants, removed))


def remove_marks(c: Column, mark_class: str = VOWEL_MARK_CLASS) -> Column:
    return F.regexp_replace(c, mark_class, "")


def marks_present(df: DataFrame, columns: dict[str, Column], marks: Sequence[str] = VOWEL_MARKS) -> DataFrame:
    """Which marks occur anywhere in each text column; one pass, one flag per (column, mark)."""
    flags = [F.coalesce(F.max(c.contains(m)), F.lit(False)).alias(f"{name}_{i}")
             for name, c in columns.items() for i, m in enumerate(marks)]
    cells = F.array(*[F.struct(F.lit(name).alias("column"), F.lit(m).alias("mark"), F.col(f"{name}_{i}").alias("present"))
                      for name in columns for i, m in enumerate(marks)])
    return df.agg(*flags).select(F.inline(cells))


def tokens(c: Column) -> Column:
    """Whitespace tokens; a missing or blank text gives an empty list."""
    squeezed = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(squeezed == "", F.array().cast("array<string>")).otherwise(F.split(squeezed, " "))


def without_stop_words(c: Column, stop_words: Sequence[str]) -> Column:
    return F.filter(c, lambda w: ~w.isin(*stop_words))


def shorten_repeats(c: Column) -> Column:
    """Three or more of a letter in a row become two, in every token."""
    return F.transform(c, lambda w: F.regexp_replace(w, r"(.)\1{2,}", "$1$1"))


def replace_words(c: Column, mapping: dict[str, str] = INFORMAL_WORDS) -> Column:
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.transform(c, lambda w: F.coalesce(F.try_element_at(lookup, w), w))


def words(c: Column) -> Column:
    """Lower-cased word tokens of two or more characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), 0)


def word_frequency(df: DataFrame, token_list: str, excluded: Sequence[str] = (), k: int | None = None) -> DataFrame:
    """Counts per token, counted map-side; with ``k`` the top-k report."""
    f = df.select(F.explode(token_list).alias("word"))
    if excluded:
        f = f.filter(~F.col("word").isin(*excluded))
    f = f.groupBy("word").agg(F.count("*").alias("n"))
    return f if k is None else f.orderBy(F.desc("n"), "word").limit(k)


def ngrams(c: Column, n: int) -> Column:
    """Space-joined runs of ``n`` tokens of one list."""
    if n == 1:
        return c
    starts = F.when(F.size(c) >= n, F.sequence(F.lit(1), F.size(c) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(c, i, n), " "))


def top_ngrams(df: DataFrame, word_list: Column, n: int = 1, k: int = 20, buckets: int = NGRAM_BUCKETS, first: int = FIRST_BUCKETS) -> DataFrame:
    """Top-k runs of ``n`` words; ``word_list`` is usually ``words(text)``.

    Runs of several words are mostly different, so they are counted by hash bucket first, which combines map-side whatever the text
    holds. Runs of the fullest ``first`` buckets are counted one by one; if the k-th of them isn't ahead of the next bucket as a whole,
    so are those of every bucket that holds as many. What lies in other buckets can't be among the first k.
    """
    lists = df.select(word_list.alias("w"))
    if n == 1:
        return _most_frequent(lists.select(F.explode("w").alias("ngram")), k)
    # as ``ngrams``, but joined place by place after the explode, in compiled code
    places = lists.filter(F.size("w") >= n).select("w", F.explode(F.sequence(F.lit(0), F.size("w") - n)).alias("i"))
    grams = places.select(F.concat_ws(" ", *[F.get("w", F.col("i") + j) for j in range(n)]).alias("ngram"))
    keyed = grams.withColumn("bucket", F.pmod(F.xxhash64("ngram"), F.lit(buckets)))
    sizes = materialise(keyed.groupBy("bucket").agg(F.count("*").alias("size")), "buckets")
    fullest = sizes.orderBy(F.desc("size"), "bucket").limit(first + 1).collect()
    chosen = df.sparkSession.createDataFrame([(r["bucket"],) for r in fullest[:first]], "bucket bigint")
    top = materialise(_most_frequent(keyed.join(F.broadcast(chosen), "bucket", "left_semi"), k), "ngrams")
    if len(fullest) > first:
        counts = [r["n"] for r in top.collect()]
        least = min(counts) if len(counts) == k else 0
        if least <= fullest[first]["size"]:
            top = _most_frequent(keyed.join(sizes.filter(F.col("size") >= least), "bucket", "left_semi"), k)
    return top.orderBy(F.desc("n"), "ngram")


def _most_frequent(grams: DataFrame, k: int) -> DataFrame:
    return grams.groupBy("ngram").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "ngram").limit(k)


def length_statistics(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean and exact median of the character and word counts."""
    by = list(by)
    lengths = df.filter(F.col(text).isNotNull()).select(*by, F.length(text).alias("chars"), word_count(F.col(text)).alias("words"))
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in ("chars", "words")])
    long = lengths.select(*by, F.inline(cells))
    means = long.groupBy(*by, "measure").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))
    return means.join(exact_quantiles(long, "v", {"median": 0.5}, [*by, "measure"]), [*by, "measure"])
