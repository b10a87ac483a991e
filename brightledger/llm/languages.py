"""Language of a text by n-gram filters that hold a bit mask of languages in every slot.

An n-gram of letters has a few slots of one table. A slot's mask has the bits of all languages with an n-gram there, so the AND of
an n-gram's slots names all its languages at once, and some by chance: the share of a language's bits that are set tells how many.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, read
from brightledger.session import materialise

#: N-gram lengths; a word's edges count as letters.
LENGTHS = (3, 4)
#: Slots of the filter (a power of two), and slots of an n-gram in it.
SLOTS, PROBES = 1 << 18, 2
#: Labelled texts of a language, about, that the filter is learned from.
FIT_TEXTS = 20_000
#: An n-gram belongs to a language if it is in so many of its texts at least, in this share of them, and there at least
#: this often beside the language where it is most frequent.
LEAST_TEXTS, LEAST_SHARE, BESIDE = 3, 0.002, 0.2
#: Letters that are hashed at once.
BLOCK = 1 << 16
UNKNOWN = "und"


@lru_cache(maxsize=1)
def folding() -> np.ndarray:
    """Code point to its lower-case letter, or 0 for what isn't a letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            y = x.lower()
            out[c] = ord(y) if len(y) == 1 else c
    return out


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each with an edge before and behind, and where each text begins."""
    size = np.fromiter((len(t or "") for t in texts), np.int64, len(texts)) + 2
    flat = np.frombuffer("".join(f" {t or ''} " for t in texts).encode("utf-32-le"), np.uint32)
    return flat, np.r_[0, np.cumsum(size)]


def _grams(folded: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(where, hash) of every n-gram inside a word and its edges."""
    last = len(folded) - n + 1
    if last < 1:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    there = folded != 0
    fits = there[1:last + 1].copy() if n > 2 else there[:last] | there[1:last + 1]
    for i in range(2, n - 1):
        fits &= there[i:last + i]
    h = np.full(last, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + folded[i:last + i]
    at = np.flatnonzero(fits)
    h = h[at]
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return at, h ^ h >> np.uint64(31)


def grams(texts: list[str | None], lengths=LENGTHS):
    """Blocks of (text number, hash) of all n-grams of ``texts``, whole texts in order."""
    flat, first = _code_points(texts)
    for start in range(0, len(flat), BLOCK):
        folded = folding()[flat[start:start + BLOCK + max(lengths) - 1]]
        for n in lengths:
            at, h = _grams(folded[:BLOCK + n - 1], n)
            yield np.searchsorted(first, at + start, "right") - 1, h


def slots(h: np.ndarray, n_slots: int = SLOTS, probes: int = PROBES):
    width = n_slots.bit_length() - 1
    return [(h >> np.uint64(width * i) & np.uint64(n_slots - 1)).astype(np.int64) for i in range(probes)]


class Filter:
    """Language masks by slot; ``masks`` has one row a slot, a bit a language."""

    def __init__(self, languages: list[str], n_slots: int = SLOTS, probes: int = PROBES):
        self.languages, self.probes = languages, probes
        self.masks = np.zeros((n_slots, max(1, -(-len(languages) // 64))), np.uint64)
        self.by_chance = np.zeros(len(languages))

    def fill(self, slot: np.ndarray, word: np.ndarray, mask: np.ndarray) -> Filter:
        """Set 64-bit words of masks and note the share of n-grams that each language's bits take by chance."""
        self.masks[slot, word] = mask.view(np.uint64)
        for i in range(len(self.languages)):
            self.by_chance[i] = (self.masks[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() ** self.probes
        return self

    def counts(self, texts: list[str | None], lengths=LENGTHS) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of every text by language, corrected for those found by chance, and all n-grams of every text."""
        hits, every = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts), np.int64)
        for row, h in grams(texts, lengths):
            every += np.bincount(row, minlength=len(texts))
            where = slots(h, len(self.masks), self.probes)
            for word in range(self.masks.shape[1]):
                mask = self.masks[where[0], word]
                for s in where[1:]:
                    mask &= self.masks[s, word]
                for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                    bit = mask & np.uint64(1 << i % 64) != 0
                    hits[:, i] += np.bincount(row[bit], minlength=len(texts))
        chance = self.by_chance[None, :]
        return np.maximum(hits - every[:, None] * chance, 0) / np.maximum(1 - chance, 1e-9), every

    def decide(self, texts: list[str | None], lengths=LENGTHS) -> tuple[list[str], np.ndarray]:
        """Language of every text and its share of the n-grams found. The first language wins ties, and where none is found."""
        hits, every = self.counts(texts, lengths)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        best, total = hits.argmax(axis=1), hits.sum(axis=1)
        score = np.where(total > 0, hits.max(axis=1) / np.where(total > 0, total, 1), 0.0)
        return [self.languages[i] if n else UNKNOWN for i, n in zip(best, every)], score


def learned_grams(labelled: DataFrame, languages: list[str], lengths=LENGTHS) -> DataFrame:
    """(language, gram, texts): in how many texts of a language (by number) each n-gram is; a null gram counts all its texts.

    n-grams of a batch are counted before they are handed on.
    """
    number = {x: i for i, x in enumerate(languages)}

    def work(batches):
        for b in batches:
            tongue = np.fromiter((number.get(x, -1) for x in b.column(0).to_pylist()), np.int64, b.num_rows)
            row, h = (np.concatenate(x) for x in zip((np.zeros(0, np.int64), np.zeros(0, np.uint64)), *grams(b.column(1).to_pylist(), lengths)))
            order = np.lexsort((row, h))
            row, h = row[order], h[order]
            once = np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])][:len(h)]
            row, h = tongue[row[once]], h[once]
            order = np.lexsort((row, h))
            row, h = row[order], h[order]
            start = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (h[1:] != h[:-1])][:len(h)])
            n = np.diff(np.r_[start, len(h)])
            texts = np.bincount(tongue[tongue >= 0], minlength=len(languages))
            columns = [np.r_[row[start], np.arange(len(languages))], pa.array(np.r_[h[start].view(np.int64), np.zeros(len(languages), np.int64)],
                       mask=np.r_[np.zeros(len(start), bool), np.ones(len(languages), bool)]), np.r_[n, texts]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["language", "gram", "texts"])

    found = map_arrow(labelled.select("lang", "text"), work, "language bigint, gram bigint, texts bigint")
    return found.filter("language >= 0").groupBy("language", "gram").agg(F.sum("texts").alias("texts"))


def learned(labelled: DataFrame, lengths=LENGTHS, n_slots: int = SLOTS, probes: int = PROBES, fit_texts: int = FIT_TEXTS) -> Filter:
    """The filter of ``labelled`` (lang, text; no nulls in lang), from about ``fit_texts`` rows of each language at most.

    Languages are in the order of their labelled rows, most first, then by name. What reaches the driver is a row a language and
    ``n_slots`` masks, whatever the rows.
    """
    counts = sorted(labelled.groupBy("lang").count().collect(), key=lambda r: (-r["count"], r["lang"]))
    languages = [r["lang"] for r in counts if r["count"] >= LEAST_TEXTS]
    out = Filter(languages, n_slots, probes)
    if not languages:
        return out
    share = F.lit(0.0)
    for r in counts:
        if r["count"] >= LEAST_TEXTS:
            share = F.when(F.col("lang") == r["lang"], min(1.0, fit_texts / r["count"])).otherwise(share)
    table = materialise(learned_grams(labelled.filter(F.rand(7) < share), languages, lengths), "grams")
    texts = F.lit(1)
    for r in table.filter("gram is null").collect():
        texts = F.when(F.col("language") == r["language"], max(1, r["texts"])).otherwise(texts)
    shares = table.filter("gram is not null").withColumn("share", F.col("texts") / texts).filter(
        (F.col("texts") >= LEAST_TEXTS) & (F.col("share") >= LEAST_SHARE))
    belongs = shares.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("language", "share")).alias("in")).select(
        "gram", F.explode(F.filter("in", lambda x: x["share"] >= F.col("top") * BESIDE)["language"]).alias("language"))
    width = n_slots.bit_length() - 1
    where = F.array(*[F.shiftrightunsigned("gram", width * i).bitwiseAND(F.lit(n_slots - 1)) for i in range(probes)])
    masks = belongs.select(F.explode(where).alias("slot"), "language").groupBy("slot", F.expr("language div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(language % 64 as int))")).alias("mask")).toArrow()
    return out.fill(*(masks.column(i).to_numpy() for i in range(3)))


def identified(docs: DataFrame, known: Filter, lengths=LENGTHS) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs`` (doc_id, text; other columns are ignored).

    A null text, or one without a letter, is ``und`` with score 0; so is every text if no language was learned. A text of letters
    whose n-grams belong to no language gets the most frequent one with score 0. Ties go to the more frequent language. Very long
    texts are read whole; rows repeated come back as often; an empty table gives none.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches):
        for b in batches:
            names, score = known.decide(b.column(1).to_pylist(), lengths)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, lang_pred string, score double")


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id as text modulo ``by``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % by


def op11_languages(spark, folder):
    docs = read(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    known = learned(docs.filter(~held_out & F.col("lang").isNotNull()))
    return identified(docs, known).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
