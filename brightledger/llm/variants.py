"""Spelling variants of a corpus' words: one-edit neighbours by PartEnum signatures of letter multisets."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, read
from brightledger.llm.words import byte_table, translated
from brightledger.session import materialise

LEAST_LENGTH, LEAST_COUNT, TIMES, DROPPED = 7, 2, 10, 31
#: One edit changes a letter multiset, as a set of (letter, how many before it), in two elements at most.
APART = 2
#: First- and second-level parts of PartEnum.
#: Six parts, any four of them a signature: 15 for a word. More than one first-level part leaves too few letters in a signature.
FIRST, SECOND = 1, 6
#: Bytes of words that a task compares at once. The words of a larger bucket meet by key instead, dealt over many tasks.
HELD_BYTES = 1 << 19
#: Longer words are compared with each of their bucket, one by one.
LONG = 1_000
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
ONLY_LOWER = byte_table(lambda b: True)


def edited(doc_id, run: str, dropped: int = DROPPED) -> str:
    """``run`` as it counts in a document: one letter is dropped where the hash of both says so."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    if h % dropped:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, dropped: int = DROPPED) -> DataFrame:
    """(word, n): words of at least ``least_length`` letters with their occurrences. Only distinct words of a task are shuffled."""
    long_runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def handed(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def work(batches):
        counts = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), translated(b.column(1), ONLY_LOWER).to_pylist()):
                for run, n in Counter(long_runs.findall(text)).items():
                    word = edited("" if doc is None else doc, run, dropped)
                    if len(word) >= least_length:
                        counts[word] += n
                if len(counts) > HELD_WORDS:
                    yield handed(counts)
                    counts.clear()
        yield handed(counts)

    return map_arrow(docs.select("doc_id", "text"), work, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def part_choices(apart: int = APART, first: int = FIRST, second: int = SECOND) -> list[tuple[int, ...]]:
    """Parts that each signature covers. Sets that differ in ``apart`` elements agree on all parts of some choice.

    The elements are dealt to ``first`` groups. In one of them the sets differ in at most ``(apart + 1) / first - 1`` elements
    (rounded up); cut into ``second`` parts, the others of its parts are equal.
    """
    inner = -(-(apart + 1) // first) - 1
    if second <= inner:
        raise ValueError("too few parts")
    return [tuple(g * second + p for p in kept) for g, kept in product(range(first), combinations(range(second), second - inner))]


def _mixed(x: np.ndarray) -> np.ndarray:
    """64-bit mixing of whole numbers."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _elements(letters: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Hash of an element: a letter with the number of equal ones before it."""
    return _mixed(letters.astype(np.uint64) << np.uint64(32) | before.astype(np.uint64))


class Letters:
    """Letters of some words, one after the other."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        self.owner = np.repeat(np.arange(len(words)), self.size)
        self.place = np.arange(len(self.flat)) - self.first[self.owner]

    def counted(self, word: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """How often each ``letter`` is in the word of the same row."""
        both = np.sort(self.owner.astype(np.uint64) << np.uint64(32) | self.flat)
        asked = word.astype(np.uint64) << np.uint64(32) | letter
        return np.searchsorted(both, asked, "right") - np.searchsorted(both, asked, "left")


def signatures(words: list[str], apart: int = APART, first: int = FIRST, second: int = SECOND) -> np.ndarray:
    """One row of 64-bit signatures for each word, by its letter multiset; equal parts of a choice give an equal signature."""
    choices, parts = part_choices(apart, first, second), first * second
    w = Letters(words)
    order = np.sort(w.owner.astype(np.uint64) << np.uint64(32) | w.flat)
    start = np.flatnonzero(np.r_[True, order[1:] != order[:-1]][:len(order)])
    before = np.arange(len(order)) - np.repeat(start, np.diff(np.r_[start, len(order)]))
    element = _elements(order & np.uint64(0xFFFFFFFF), before)
    each = np.zeros((len(words), parts), np.uint64)
    at = (order >> np.uint64(32)).astype(np.int64) * parts + (element % np.uint64(parts)).astype(np.int64)
    np.add.at(each.reshape(-1), at, _mixed(element))
    out = np.empty((len(words), len(choices)), np.uint64)
    for i, choice in enumerate(choices):
        sig = np.full(len(words), i, np.uint64)
        for p in choice:
            sig = _mixed(sig ^ each[:, p])
        out[:, i] = sig
    return out


def with_signatures(words: DataFrame) -> DataFrame:
    """(choice, sig, word, n): every word once for each of its signatures."""
    n_choices = len(part_choices())

    def work(batches):
        for b in batches:
            sigs = signatures(b.column(0).to_pylist()).view(np.int64)
            rows = pa.array(np.repeat(np.arange(b.num_rows), n_choices))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(n_choices, dtype=np.int32), b.num_rows)), pa.array(sigs.reshape(-1)), b.column(0).take(rows), b.column(1).take(rows)],
                names=["choice", "sig", "word", "n"])

    return map_arrow(words.select("word", "n"), work, "choice int, sig bigint, word string, n bigint")


BASE = np.uint64(0x100000001B3)


def edit_keys(w: Letters, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, place, key): words of one bucket are one edit apart just if they share a key, up to collisions of hashes.

    Place -1: the word itself. Places up to its size: the word without that letter (one of a run of equal letters), which equals
    another word. Places beyond: the word with that letter open, which equals another with the same letter open.
    """
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(w.size.max(initial=0)) + 1, BASE, np.uint64))
        own = (_mixed(w.flat) * powers[w.place])
        upto = np.cumsum(own)  # sums wrap around, as do their differences
        start = np.r_[np.uint64(0), upto][w.first]
        whole = (np.r_[np.uint64(0), upto][w.first + w.size] - start)
        head = upto - own - start[w.owner]
        tail = whole[w.owner] - head - own  # letters behind, at their own places
        shorter = _mixed(bucket[w.owner] ^ _mixed(head * BASE + tail))
        open_ = _mixed(bucket[w.owner] ^ _mixed((head + tail) ^ _mixed(w.place + 7) ^ _mixed(w.size[w.owner] + (1 << 40))))
        itself = _mixed(bucket ^ _mixed(whole * BASE))
    last = np.r_[w.flat[1:] != w.flat[:-1], True] | (w.place == w.size[w.owner] - 1)
    size = w.size[w.owner]
    return (np.concatenate([np.arange(len(w.words)), w.owner[last], w.owner]),
            np.concatenate([np.full(len(w.words), -1), w.place[last], w.place + size]),
            np.concatenate([itself, shorter[last], open_]))


def _key_pairs(key: np.ndarray, word: np.ndarray, place: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """(a, b, place) of rows with an equal key: a the shorter or earlier word, place the letter of b that a lacks or has otherwise."""
    order = np.lexsort((place, key))
    key, word, place = key[order], word[order], place[order]
    open_, out = place >= size[word], []
    apart = 1
    while True:
        same = (key[apart:] == key[:-apart]) if apart < len(key) else np.zeros(0, bool)
        if not same.any():
            break
        both = same & open_[apart:] & open_[:-apart]
        out.append((word[:-apart][both], word[apart:][both], (place - size[word])[apart:][both]))
        lead = same & (place[:-apart] == -1) & (place[apart:] >= 0) & ~open_[apart:]
        out.append((word[:-apart][lead], word[apart:][lead], place[apart:][lead]))
        apart += 1
    return out


def one_edit(a: str, b: str, place: int) -> bool:
    """Whether ``a`` is ``b`` without the letter at ``place``, or with another one there."""
    return a != b and a[:place] == b[:place] and (a[place:] if len(a) < len(b) else a[place + 1:]) == b[place + 1:]


def _edit_place(a: str, b: str) -> int | None:
    """The place of the only edit between two words, ``a`` not the longer; None if there are more or none."""
    place = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return place if len(b) - len(a) <= 1 and place < len(b) and one_edit(a, b, place) else None


def _first_choice(w: Letters, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The first choice of parts on which two words with one edit agree: where their pair counts."""
    parts, choices = FIRST * SECOND, part_choices()
    y = w.flat[w.first[b] + place]
    replaced = w.size[a] == w.size[b]
    x = np.where(replaced, w.flat[w.first[a] + np.minimum(place, w.size[a] - 1)], y)
    of_y = (_elements(y, w.counted(b, y) - 1) % np.uint64(parts)).astype(np.int64)
    of_x = (_elements(x, w.counted(a, x) - 1) % np.uint64(parts)).astype(np.int64)
    of_x = np.where(replaced, of_x, of_y)
    table = np.array([[next(i for i, c in enumerate(choices) if p not in c and q not in c) for q in range(parts)] for p in range(parts)])
    return table[of_x, of_y]


def _verified(w: Letters, choice: np.ndarray, found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) that are one edit apart, each in its first choice only; ``choice`` holds that of every word's row."""
    none = np.zeros(0, np.int64)
    a, b, place = (np.concatenate([none, *(f[i] for f in found)]) for i in range(3))
    if len(a):
        fits = choice[a] == choice[b]
        a, b, place = a[fits], b[fits], place[fits]
        here = _first_choice(w, a, b, place) == choice[a]
        a, b, place = a[here], b[here], place[here]
        right = np.fromiter((one_edit(w.words[i], w.words[j], k) for i, j, k in zip(a.tolist(), b.tolist(), place.tolist())), bool, len(a))
        a, b = a[right], b[right]
    return a, b


FOUND = "word string, n bigint, n_near bigint, near string, near_n bigint, choice int, sig bigint"
_FOUND = pa.schema([("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("near", pa.string()), ("near_n", pa.int64()),
                    ("choice", pa.int32()), ("sig", pa.int64())])


def _best(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """One row for each word with neighbours among the pairs (a, b): how many, and that of the largest n (ties: the smallest word)."""
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    place = np.empty(len(words), np.int64)  # ranks of the words in code-point order
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][:len(own)])
    count = np.diff(np.r_[first, len(own)])
    own, other, none = own[first].tolist(), other[first].tolist(), pa.nulls(len(first), pa.int64())
    columns = [[words[i] for i in own], none, count, [words[i] for i in other], n[other], none.cast(pa.int32()), none]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _pairs_inside(x: pa.Table) -> pa.RecordBatch:
    """Neighbours inside whole buckets of rows sorted by (choice, sig)."""
    choice, sig, n = (x.column(i).to_numpy() for i in (0, 1, 3))
    same = (choice[1:] == choice[:-1]) & (sig[1:] == sig[:-1])
    several = np.r_[same, False] | np.r_[False, same]
    several = several[:len(choice)]
    choice, sig, n, words = choice[several], sig[several], n[several], x.column(2).filter(pa.array(several)).to_pylist()
    bucket = np.cumsum(np.r_[True, (choice[1:] != choice[:-1]) | (sig[1:] != sig[:-1])][:len(words)])
    size = np.fromiter(map(len, words), np.int64, len(words))
    short, pairs = np.flatnonzero(size <= LONG), []
    if len(short):
        w = Letters([words[i] for i in short])
        word, place, key = edit_keys(w, _mixed(bucket[short]))
        a, b = _verified(w, choice[short], _key_pairs(key, word, place, w.size))
        pairs.append((short[a], short[b]))
    if len(short) < len(words):
        found = []
        for i in np.flatnonzero(size > LONG):
            for j in range(*np.searchsorted(bucket, [bucket[i], bucket[i] + 1])):
                if size[j] <= LONG or j < i:  # two long words meet once
                    a, b = (i, j) if (size[i], i) <= (size[j], j) else (j, i)
                    if (place := _edit_place(words[a], words[b])) is not None:
                        found.append((a, b, place))
        if found:
            pairs.append(_verified(Letters(words), choice, [tuple(np.array(found).T)]))
    none = [np.zeros(0, np.int64)]
    return _best(words, n, *(np.concatenate(none + [p[i] for p in pairs]) for i in (0, 1)))


def _bucket_pairs(batches, held_bytes: int):
    """Neighbours inside buckets of rows (choice, sig, word, n), sorted. The rows of a bucket of more than ``held_bytes`` come back."""

    def crowd(x):
        none = pa.nulls(x.num_rows)
        columns = [x.column("word"), x.column("n"), none, none, none, x.column("choice"), x.column("sig")]
        t = pa.Table.from_arrays([pa.chunked_array(c.chunks if isinstance(c, pa.ChunkedArray) else [c]).cast(f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)
        return t.combine_chunks().to_batches()

    def of_key(x, key):
        return (x.column("choice").to_numpy() == key[0]) & (x.column("sig").to_numpy() == key[1])

    held, size, crowded = [], 0, None  # crowded: key of a bucket that came back so far
    for b in batches:
        t = pa.Table.from_batches([b])
        if crowded is not None:
            n = int(of_key(t, crowded).sum())
            yield from crowd(t.slice(0, n))
            t = t.slice(n)
            if t.num_rows:
                crowded = None
        if not t.num_rows:
            continue
        held.append(t)
        size += t.column("word").nbytes
        if size <= held_bytes:
            continue
        every = pa.concat_tables(held).combine_chunks()
        key = every.column("choice")[-1].as_py(), every.column("sig")[-1].as_py()
        last = every.num_rows - int(of_key(every, key).sum())  # the last bucket may go on
        yield _pairs_inside(every.slice(0, last))
        rest = every.slice(last)
        held, size = [rest], rest.column("word").nbytes
        if size > held_bytes:
            yield from crowd(rest)
            held, size, crowded = [], 0, key
    if held:
        yield _pairs_inside(pa.concat_tables(held).combine_chunks())


def _crowded_pairs(rows: DataFrame) -> DataFrame:
    """Neighbours in buckets that no task should hold: words of a bucket meet by what one edit leaves, at most some dozen for a key.

    Short words meet by the word without, or with an open, letter; long ones by their first or last half, one of which an edit leaves.
    """
    place = F.sequence(F.lit(1), F.length("word"))

    def around(i):
        return F.substr("word", F.lit(1), i - 1), F.substr("word", i + 1)

    def half(m):
        return F.ceil((m - 1) / 2).cast("int")

    open_ = F.transform(place, lambda i: F.xxhash64(i, F.length("word"), *around(i)))
    shorter = F.array_distinct(F.transform(place, lambda i: F.xxhash64(F.concat(*around(i)))))
    halves = F.flatten(F.transform(F.array(F.length("word") - 1, F.length("word")), lambda m: F.array(
        F.xxhash64(m, F.lit(1), F.substr("word", F.lit(1), half(m))), F.xxhash64(m, F.lit(2), F.substr("word", F.length("word") - half(m) + 1)))))
    with_key = rows.filter(F.length("word") <= LONG).withColumn("key", F.explode(F.concat(open_, F.array(F.xxhash64("word")), shorter)))
    with_half = rows.filter(F.length("word") >= LONG).withColumn("key", F.explode(halves))
    out = []
    for keyed, fits in ((with_key, F.lit(True)), (with_half, F.greatest(F.length("word"), F.length("word_b")) > LONG)):
        other = keyed.select("choice", "sig", "key", F.col("word").alias("word_b"), F.col("n").alias("n_b"))
        near = (F.col("word") < F.col("word_b")) & fits & (F.levenshtein("word", "word_b", 1) == 1)
        out.append(keyed.join(other, ["choice", "sig", "key"]).filter(near).select("choice", "word", "n", "word_b", "n_b").distinct())

    def work(batches):
        for b in batches:
            words, m = b.column(1).to_pylist() + b.column(3).to_pylist(), b.num_rows
            found = [(i, m + i) if len(words[i]) <= len(words[m + i]) else (m + i, i) for i in range(m)]
            placed = [(x, y, _edit_place(words[x], words[y])) for x, y in found]
            n = np.concatenate([b.column(2).to_numpy(), b.column(4).to_numpy()])
            pairs = _verified(Letters(words), np.tile(b.column(0).to_numpy(), 2), [tuple(np.array(placed, np.int64).reshape(-1, 3).T)])
            yield _best(words, n, *pairs)

    return map_arrow(out[0].unionByName(out[1]), work, FOUND)


def near_words(words: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """(word, n_near, near, near_n) of every distinct word of ``words`` (word, n) that has a neighbour one edit away.

    near is the neighbour of the largest n, the smallest in code-point order of several. Words meet by PartEnum signatures; a pair
    is taken in the first signature that both share, so none is counted twice.
    """
    dealt = with_signatures(words).repartition("choice", "sig").sortWithinPartitions("choice", "sig")
    found = materialise(map_arrow(dealt, lambda b: _bucket_pairs(b, held_bytes), FOUND), "variants")
    crowded = found.filter("choice is not null")
    every = found.filter("choice is null").unionByName(_crowded_pairs(crowded)).select(
        "word", "n_near", F.struct((-F.col("near_n")).alias("less"), "near").alias("best"))
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best")).select(
        "word", "n_near", F.col("best.near").alias("near"), (-F.col("best.less")).alias("near_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms from each word of ``forms`` (word, form), which has no circle.

    A chain is halved in each round, and a round is written under ``spark.checkpoint.dir``.
    """
    links = materialise(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "forms")
    while not links.filter("open").isEmpty():
        ends = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        links = materialise(links.join(ends.hint("merge"), links["root"] == ends["at"], "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("open")), "forms")
    return links.select("word", "root")


def spelling_variants(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, times: int = TIMES,
                      dropped: int = DROPPED) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word of ``docs`` (doc_id, text; other columns are ignored).

    Words are lower-cased runs of Latin letters of at least ``least_length`` and ``least_count`` occurrences over all documents, one
    letter dropped where ``edited`` says so. form is the most frequent word one edit away, if it is at least ``times`` as frequent;
    root ends the chain of forms. Null and empty texts have no word; texts of any length are read whole; rows repeated count as
    often; a null doc_id counts as an empty one; an empty table has no words. Distinct words, not occurrences, are compared.
    """
    words = materialise(word_counts(docs, least_length, dropped).filter(F.col("n") >= least_count), "words")
    near = near_words(words).withColumnRenamed("word", "own")
    form = F.col("near_n") >= times * F.col("n")
    forms = materialise(words.join(near.hint("merge"), words["word"] == near["own"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(form, F.col("near")).alias("form"),
        F.when(form, F.col("near_n")).alias("form_n")), "forms")
    ends = roots(forms.filter("form is not null")).withColumnRenamed("word", "own")
    return forms.join(ends.hint("merge"), forms["word"] == ends["own"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_variants(spark, folder):
    return spelling_variants(read(spark, folder, "documents"))


SQL = rf"""
WITH RECURSIVE crc AS (SELECT i, 0 AS k, i AS c FROM range(256) r(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM crc WHERE k < 8),
steps AS (SELECT list(c ORDER BY i) AS step FROM crc WHERE k = 8),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
      FROM documents),
c AS (SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x FROM r WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run),
b AS (SELECT run, n, list_transform(range(0, len(x) // 2), lambda i: ('0x' || substring(x, 2 * i + 1, 2))::BIGINT) AS bytes FROM c),
h AS (SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda a, d: xor(a >> 8, step[(xor(a, d) & 255) + 1])), 4294967295::BIGINT) AS h FROM b, steps),
e AS (SELECT CASE WHEN h % {DROPPED} = 0 THEN left(run, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
i AS (SELECT word, n, unnest(range(0, length(word))) AS pos FROM w),
s AS (SELECT DISTINCT word, n, left(word, pos) || substring(word, pos + 2) AS cut FROM i),
o AS (SELECT word, n, pos, left(word, pos) || '_' || substring(word, pos + 2) AS cut FROM i),
q AS (SELECT x.word, y.word AS other, y.n AS m FROM o x JOIN o y ON x.cut = y.cut AND x.word <> y.word
  UNION ALL SELECT w.word, s.word, s.n FROM w JOIN s ON w.word = s.cut UNION ALL SELECT s.word, w.word, w.n FROM w JOIN s ON w.word = s.cut),
f AS (SELECT word, count(*) AS n_near, min({{'m': -m, 'other': other}}) AS best FROM q GROUP BY word),
g AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= {TIMES} * n THEN best.other END AS form, CASE WHEN -best.m >= {TIMES} * n THEN -best.m END AS form_n
      FROM w LEFT JOIN f USING (word)),
t AS (SELECT word, word AS root, 0 AS k FROM g UNION ALL SELECT t.word, g.form, k + 1 FROM t JOIN g ON t.root = g.word WHERE g.form IS NOT NULL),
z AS (SELECT word, max_by(root, k) AS root FROM t GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM g JOIN z USING (word)"""
