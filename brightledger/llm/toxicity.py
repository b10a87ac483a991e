"""Toxicity scores: a learned lexicon, misspellings through Levenshtein automata, contexts that tell quotation from abuse."""

from __future__ import annotations

import math
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, read
from brightledger.session import materialise

THRESHOLD = 0.3
#: Bound of the fit: labelled training rows of either label (by hash order).
FIT_ROWS = 10_000
#: A term must be in so many toxic training texts, in so many different surroundings, and that much likelier there.
LEAST_TEXTS, LEAST_PLACES, LEAST_LIFT = 4, 4, 30.0
#: Terms of at least so many letters are matched with one edit; what an inexact match counts.
FUZZY_LETTERS, FUZZY_WEIGHT = 5, 0.6
#: Words on either side of a term that are its context.
WINDOW = 4
#: Marks of a quotation by family, words that report speech, and words that address somebody.
QUOTES = {'"': '"', "“": "“", "”": "“", "„": "“", "«": "«", "»": "«", "‹": "‹", "›": "‹"}
REPORTING = "said says wrote writes called calls quoted sagte sagt schrieb nannte dit disait écrit appelle dijo dice escribió llamó".split()
ADDRESS = "you your you're du dich dein sie ihr tu toi ton vous votre tú usted ustedes eres".split()
#: What a quoted or reported term counts, and what one next to an address counts.
QUOTED, REPORTED, ADDRESSED = 0.3, 0.6, 1.3
#: Terms of at least so many letters are matched with two edits.
LONG_LETTERS = 9
#: Marks inside of a word that mask letters, and the letters that each may stand for; "" is any.
MASKS = {"*": "", "@": "a", "$": "s", "!": "il", "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
_WORD = re.compile(r"[^\W\d_]+")
#: A word with digits or marks inside, and what a text with such a word holds.
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++(?:[\d*@$!]++[^\W\d_]++)+")
_INNER = re.compile(r"[\d*@$!](?=[^\W\d_])")
#: Letters of words that a worker remembers, about, and parts of automaton states that it keeps; beyond, it begins anew.
KEPT_LETTERS, KEPT_PARTS = 16 << 20, 4 << 20


class Matcher:
    """Words within ``most`` edits of a lexicon: the automata of all distances, intersected with the lexicon's trie, determinised as needed.

    A state is a set of (trie node, edits so far, pending deletion); a word runs until the set is empty.
    """

    def __init__(self, terms: dict[str, float], exact: frozenset[str] = frozenset(), most: int = 1):
        """``exact``: terms whose near words are no misspellings but words of their own."""
        self.terms, self.exact, self.most = terms, exact, most
        long = {t: w for t, w in terms.items() if len(t) >= LONG_LETTERS and t not in exact} if most == 1 else {}
        self.longer = Matcher(long, exact, 2) if long else None
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[str | None] = [None]
        for t in sorted(terms):
            node = 0
            for c in t:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term_at.append(None)
                node = self.children[node][c]
            self.term_at[node] = t
        self.forget()
        self.plain: set[str] = set()
        self.found: dict[str, tuple[str, int]] = {}
        self.letters = 0

    def forget(self) -> None:
        """Begin the automaton anew; its states are made as words need them."""
        start = self.closed({(0, 0)})
        self.ids, self.states, self.arcs, self.parts = {start: 0}, [start], [{}], len(start)

    def closed(self, pairs: set[tuple[int, int]]) -> frozenset:
        """Add what is reached by leaving out letters of a term."""
        out = set(pairs)
        for _ in range(self.most):
            out |= {(child, edits + 1) for node, edits in out if edits < self.most for child in self.children[node].values()}
        return frozenset(out)

    def step(self, state: int, char: str) -> int:
        out = set()
        for node, edits in self.states[state]:
            child = self.children[node].get(char)
            if child is not None:
                out.add((child, edits))
            if edits < self.most:
                out.add((node, edits + 1))  # a letter too many
                out.update((other, edits + 1) for c, other in self.children[node].items() if c != char)
        new = self.closed(out)
        if not new:
            target = -1
        else:
            target = self.ids.setdefault(new, len(self.states))
            if target == len(self.states):
                self.states.append(new)
                self.arcs.append({})
                self.parts += len(new)
        self.arcs[state][char] = target
        return target

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits): an exact term, else the first term within the edits that is long enough for it."""
        if self.parts > KEPT_PARTS:
            self.forget()
        state = 0
        for c in word:
            state = self.arcs[state].get(c, 0) or self.step(state, c)
            if state < 0:
                return None
        hits = [(edits, self.term_at[node]) for node, edits in self.states[state] if self.term_at[node]]
        hits = [(e, t) for e, t in hits if not e or len(t) >= FUZZY_LETTERS and t not in self.exact]
        return (min(hits)[1], min(hits)[0]) if hits else None

    def masked(self, word: str) -> tuple[str, int] | None:
        """The first term of as many letters, some of which marks stand for: one, or a third of the term's."""
        nodes, marks = {0}, 0
        for c in word:
            may = MASKS.get(c)
            marks += may is not None
            nodes = {child for n in nodes for x, child in self.children[n].items() if (x == c if may is None else not may or x in may)}
            if not nodes:
                return None
        hits = [t for t in (self.term_at[n] for n in nodes) if t and t not in self.exact and len(t) > 2 and marks <= max(1, len(t) // 3)]
        return (min(hits), marks) if marks and hits else None

    def swapped(self, word: str) -> tuple[str, int] | None:
        """The first long enough term that two neighbouring letters changed places in."""
        hits = [t for i in range(len(word) - 1) if (t := word[:i] + word[i + 1] + word[i] + word[i + 2:]) in self.terms and t not in self.exact]
        return (min(hits), 1) if hits else None

    def near(self, word: str) -> tuple[str, int] | None:
        """A match of any kind, that with the fewest changes first."""
        found = self.match(word) or (None if word.isalpha() else self.masked(word))
        if found is None and len(word) >= FUZZY_LETTERS:
            found = self.swapped(word)
        if found is None and self.longer and len(word) >= LONG_LETTERS - 2:
            found = self.longer.match(word)
        return found

    def words(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, word) of every word: a run of letters, or one with digits and marks inside if that is a term as a whole."""
        if not _INNER.search(text):
            return [(*m.span(), m[0]) for m in _WORD.finditer(text)]
        whole = [m for m in _MASKED.finditer(text) if self.of_text([m[0]])]
        out, k = [], 0
        for m in _WORD.finditer(text):
            while k < len(whole) and whole[k].end() <= m.start():
                k += 1
            if k == len(whole) or m.end() <= whole[k].start():
                out.append((*m.span(), m[0]))
            elif m.start() == whole[k].start():
                out.append((*whole[k].span(), whole[k][0]))
        return out

    def of_text(self, words: list[str]) -> dict[str, tuple[str, int]]:
        """Matches by word."""
        each = set(words)
        for w in each.difference(self.plain, self.found):
            m = self.near(w)
            self.letters += len(w)
            if m:
                self.found[w] = m
            else:
                self.plain.add(w)
        hits = {w: self.found[w] for w in each.intersection(self.found)}
        if self.letters > KEPT_LETTERS:
            self.plain.clear()
            self.found.clear()
            self.letters = 0
        return hits


_QUOTE = re.compile(f"[{''.join(QUOTES)}]|\\n[^\\S\\n]*\\n")


def quoted_spans(text: str) -> list[tuple[int, int]]:
    """Quotations of a text, whatever their length, in the order of their ends: an opening mark to the next closing one of its family.

    A mark opens before a character other than a space, and not behind a letter or digit; it closes the other way round. One that may
    do either closes what is open. An empty line ends an open quotation without one.
    """
    spans, open_ = [], {}
    for m in _QUOTE.finditer(text):
        if len(m[0]) > 1:
            open_.clear()
            continue
        family, i = QUOTES[m[0]], m.start()
        before, after = text[i - 1:i], text[i + 1:i + 2]
        if family in open_ and before and not before.isspace() and not after.isalnum():
            spans.append((open_.pop(family), i))
        elif after and not after.isspace() and not before.isalnum():
            open_[family] = i
    return spans


def within(spans: list[tuple[int, int]], start: int, end: int, at: int = 0) -> bool:
    """Whether one of ``spans`` holds the term from ``start`` to ``end``; those before ``at`` end earlier."""
    return any(a < start and end <= b for a, b in spans[at:at + 2 * len(QUOTES)])


def context_weight(quoted: bool, before: list[str], after: list[str]) -> float:
    """Below 1 for a term in quotation marks or reported, above for one that addresses somebody."""
    weight = QUOTED if quoted else 1.0
    if any(w in REPORTING for w in before):
        weight *= REPORTED
    if any(w in ADDRESS for w in before + after):
        weight *= ADDRESSED
    return weight


def features(text: str, matcher: Matcher) -> list[float]:
    """[terms weighted by likelihood and context, log of distinct terms, matches per hundred words] of a text."""
    low = text.lower()
    places = matcher.words(low)
    words = [w for _, _, w in places]
    hits = matcher.of_text(words)
    if not hits:
        return [0.0, 0.0, 0.0]
    best: dict[str, float] = {}
    n, spans = 0, quoted_spans(low)
    ends = [b for _, b in spans]
    for i, (start, end, word) in enumerate(places):
        if word in hits:
            n += 1
            term, edits = hits[word]
            quoted = within(spans, start, end, bisect_left(ends, end))
            near = context_weight(quoted, words[max(0, i - WINDOW):i], words[i + 1:i + 1 + WINDOW])
            best[term] = max(best.get(term, 0.0), near * (FUZZY_WEIGHT if edits else 1.0))
    return [sum(w * matcher.terms[t] for t, w in best.items()), math.log1p(len(best)), min(10.0, 100.0 * n / len(words))]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Weights (intercept first) of a ridge logistic regression, by Newton's method."""
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + ridge * np.r_[0, w[1:]]
        hessian = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.diag([1e-6, *np.ones(x.shape[1] - 1)])
        move = np.linalg.solve(hessian, gradient)
        w -= move * min(1.0, 5 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-7:
            break
    return w


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """(text, toxic): at most ``rows`` labelled training texts of either label, those of the smallest hashes, each text once."""
    known = labels.filter("toxic is not null and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = [known.filter(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for c in ("toxic > 0", "toxic <= 0")]
    ids = materialise(chosen[0].unionByName(chosen[1]), "fit-ids")
    texts = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(ids), "doc_id")  # bounded by ``rows``
    return materialise(texts.groupBy("text").agg(F.max("toxic").alias("toxic")).withColumn("toxic", (F.col("toxic") > 0).cast("int")), "fit")


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """Terms that mark toxic texts, with the log of how much likelier they are there.

    Copies of one text share their surroundings, so a term must be found between different neighbours. Evidence alone decides: a
    term is in at least ``LEAST_TEXTS`` of the toxic rows of the fit, which bounds how many there can be.
    """
    counts = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    toxic, clean = counts["t"], counts["n"] - counts["t"]
    if not toxic:
        return {}
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))
    each = rows.select("toxic", F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(
        F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b"))
    lift = ((F.col("a") + 0.5) / (toxic + 1)) / ((F.col("b") + 0.5) / (clean + 1))
    likely = each.filter(F.col("a") >= LEAST_TEXTS).withColumn("lift", lift).filter(F.col("lift") >= LEAST_LIFT)
    likely = materialise(likely.select("term", "lift"), "terms")
    placed = rows.filter("toxic = 1").withColumn("w", words).select(
        F.explode(F.transform("w", lambda x, i: F.struct(x.alias("term"), F.coalesce(F.get("w", i - 1), F.lit("")).alias("p"),
                                                         F.coalesce(F.get("w", i + 1), F.lit("")).alias("q")))).alias("s")).select("s.*")
    near = placed.join(likely, "term").groupBy("term", "p", "q").agg(F.first("lift").alias("lift"))
    wide = near.groupBy("term").agg(F.max("lift").alias("lift"), F.count_distinct("p").alias("np"), F.count_distinct("q").alias("nq"))
    good = wide.filter((F.col("np") >= LEAST_PLACES) & (F.col("nq") >= LEAST_PLACES) & (F.length("term") > 1))
    return {r["term"]: math.log(r["lift"]) / math.log(LEAST_LIFT) for r in good.collect()}


def exact_terms(rows: DataFrame, lexicon: dict[str, float]) -> frozenset[str]:
    """Terms whose inexact matches are about as likely in clean training texts as in toxic ones."""
    def work(batches):
        matcher = Matcher(lexicon)
        for b in batches:
            found = [(t, y) for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                     for t in {t for t, e in matcher.of_text([w for _, _, w in matcher.words(text.lower())]).values() if e}]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32())], names=["term", "toxic"])

    n = rows.agg(F.coalesce(F.sum("toxic"), F.lit(0)).alias("t"), F.count("*").alias("n")).first()
    counts = map_arrow(rows.select("text", "toxic"), work, "term string, toxic int").groupBy("term").agg(
        F.sum("toxic").alias("a"), (F.count("*") - F.sum("toxic")).alias("b")).filter("b > 0").collect()  # one row per term at most
    toxic, clean = n["t"], n["n"] - n["t"]
    return frozenset(r["term"] for r in counts if (r["a"] + 0.5) / (toxic + 1) < LEAST_LIFT * (r["b"] + 0.5) / (clean + 1))


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Matcher, np.ndarray]:
    """The lexicon's matcher and the weights of the features, from training labels only."""
    rows = training_rows(docs, labels)
    lexicon = learn_lexicon(rows)
    exact = exact_terms(rows, lexicon)

    def measure(batches):
        matcher = Matcher(lexicon, exact)
        for b in batches:
            out = [features(t, matcher) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array([o[k] for o in out], pa.float64()) for k in range(3))], names=["toxic", "f0", "f1", "f2"])

    seen = np.array(map_arrow(rows.select("text", "toxic"), measure, "toxic int, f0 double, f1 double, f2 double").collect(), float).reshape(-1, 4)
    if len(set(seen[:, 0])) < 2:
        share = seen[:, 0].mean() if len(seen) else 0.0
        return Matcher(lexicon, exact), np.array([math.log((share + 1e-3) / (1 - share + 1e-3)), 0, 0, 0])
    return Matcher(lexicon, exact), logistic(seen[:, 1:], seen[:, 0])


def scored(docs: DataFrame, known: Matcher, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text; others are ignored).

    Null and empty texts score as texts without a term; very long ones are read whole. Rows repeated come back as often; a null doc_id isn't held out.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    terms, exact = known.terms, known.exact

    def work(batches):
        matcher = Matcher(terms, exact)
        for b in batches:
            x = np.array([features(t or "", matcher) for t in b.column(1).to_pylist()]).reshape(-1, 3)
            p = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["doc_id", "score"])

    found = map_arrow(docs.select("doc_id", "text"), work, f"doc_id {kind}, score double")
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op4_toxicity(spark, folder):
    docs = read(spark, folder, "documents")
    return scored(docs, *fit(docs, read(spark, folder, "labels")))
