"""Token counts from a tokenizer compiled to a deterministic transducer.

A byte-pair encoding is right if and only if every two neighbouring tokens are the encoding of their joined text. So the last
token of every prefix follows from the last tokens of a few shorter prefixes: those that a token may still begin at. They are
the state; a character leads to the next state and changes the count by a number fixed for that transition. States and
transitions are compiled as texts need them and kept for the worker's life, up to a bound.

No piece runs across the end of a word (a mark after something else), so the state returns to the start there.

A chunk of a long text does not know the state it is entered with, so it is mapped for all that its left context allows: a state
is a position near the chunk's start where a token may end, and that token. Each is run on from there; a position that no
tokens lead to from the entry is a hole. Entries soon come to the same state and go on as one. The chunk's map takes each entry to its exits
(the positions near the chunk's end that tokens lead to) with the count between them. Two tokens enclose one encoding only, so
such maps compose like relations, in any grouping, and a text's chunks are mapped and composed in tasks of bounded size.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache, reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import batch, map_arrow, read

OVER = 4096
CHUNK = 1 << 16
#: Bounds of what a worker keeps: entries of the transducer (states, transitions, tokens that may follow, each no longer than a
#: few pieces), looked at every ``BLOCK`` characters, and bytes of whole words with their counts (paths from start to start).
MAX_ENTRIES, MAX_WORD_BYTES, BLOCK = 2_000_000, 128 << 20, 256
#: Characters of the text before a chunk that it is mapped with: at least twice the longest piece.
CONTEXT = 256
#: States that are always there: the start of a word, and the one that no token leads to.
START, DEAD = 0, 1
#: Stands for the last token at a position that no tokens lead to.
HOLE = ""
MARK = "▁"
_SEGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_SEGMENT_START = re.compile(f"(?<=[^{MARK}]){MARK}")


class Transducer(dict):
    """Counts tokens as the piece model does. As a dict: counts of words, each read as if a mark came before it."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        skip = {i for i in range(model.get_piece_size()) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)}
        self.score = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if i not in skip}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.score):
            raise ValueError("a piece runs across the end of a word")
        self.begun = {p[:k] for p in self.score for k in range(len(p))}
        self.longest = max(map(len, self.score))
        if 2 * self.longest > CONTEXT:
            raise ValueError("a piece is longer than half the context")
        self.clear_words()
        self.clear_states()

    def clear_words(self) -> None:
        self.clear()
        self.word_bytes = 0

    def clear_states(self) -> None:
        # a state: the text that may still become part of a token, and for each position in it the last token so far and
        # the number of tokens there, less the number at the last position that is no hole
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.fits: dict[tuple[str | None, str], bool] = {}
        self.n_arcs = 0
        self.state_of(("", ((None, 0),)))
        self.state_of(("", ()))

    def state_of(self, key: tuple) -> int:
        found = self.ids.setdefault(key, len(self.states))
        if found == len(self.states):
            self.states.append(key)
            self.arcs.append({})
        return found

    def within_bounds(self, states: list[int]) -> list[int]:
        """The given states, after all others are forgotten if too much is kept."""
        if len(self.states) + self.n_arcs + len(self.fits) <= MAX_ENTRIES:
            return states
        keys = [self.states[s] for s in states]
        self.clear_states()
        return [self.state_of(k) for k in keys]

    def merged(self, text: str) -> list[str]:
        """The encoding of a short text by its definition: the best-scored neighbours join first, leftmost of equals."""
        parts = list(text)
        while True:
            best = max(((self.score[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.score), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    def may_follow(self, last: str | None, token: str) -> bool:
        known = self.fits.get((last, token))
        if known is None:
            whole = [token] if last is None else [last, token]
            known = self.fits[last, token] = self.merged("".join(whole)) == whole
        return known

    def weight(self, token: str) -> int:
        """A character that no piece covers counts as its bytes."""
        return 1 if token in self.score else len(token.encode())

    def arc(self, state: int, char: str) -> tuple[int, int]:
        """Compile a transition: the next state and the change of the count."""
        open_text, last = self.states[state]
        text = open_text + char
        token, change = HOLE, 0
        for at, (before, n) in enumerate(last):
            part = text[at:]
            if before != HOLE and (part in self.score or len(part) == 1) and self.may_follow(before, part):
                token, change = part, n + self.weight(part)
                break
        keep = next((k for k in range(len(text)) if text[k:] in self.begun), len(text))
        window = (*((t, 0 if t == HOLE else n - change) for t, n in last[keep:]), (token, 0))
        if keep == len(text) and token not in self.score and token != HOLE:
            window = ((None, 0),)  # nothing joins an uncovered character
        holes = next((k for k, (t, _) in enumerate(window) if t != HOLE), None)
        key = ("", ()) if holes is None or not last else (text[keep + holes:], window[holes:])
        found = self.arcs[state][char] = (self.state_of(key), change)
        self.n_arcs += 1
        return found

    def run(self, state: int, text: str) -> tuple[int, int]:
        total = 0
        for c in text:
            step = self.arcs[state].get(c) or self.arc(state, c)
            state = step[0]
            total += step[1]
        return state, total

    def run_within_bounds(self, state: int, text: str) -> tuple[int, int]:
        total = 0
        for i in range(0, len(text), BLOCK):
            [state] = self.within_bounds([state])
            state, n = self.run(state, text[i:i + BLOCK])
            total += n
        return state, total

    def segment(self, text: str) -> int:
        """Tokens of one segment (marks, then other characters), from the start state."""
        return self.run_within_bounds(START, text)[1]

    def __missing__(self, word: str) -> int:
        n = self.segment(MARK + word)
        self.word_bytes += 200 + 4 * len(word)  # the key at its widest, its count and its place in the table
        if self.word_bytes > MAX_WORD_BYTES:
            self.clear_words()
        else:
            self[word] = n
        return n

    def count(self, marked: str) -> int:
        """Tokens of a text whose spaces are marks and that begins and ends where segments do."""
        words = marked.split(MARK)
        if "" in words[1:]:  # runs of marks
            return sum(self[s[1:]] if s[0] == MARK != s[1:2] != "" else self.segment(s) for s in _SEGMENT.findall(marked))
        head = self.segment(words[0]) if words[0] else 0
        return head + sum(map(self.__getitem__, words[1:]))

    def entries(self, context: str) -> list[tuple[int, str | None]]:
        """Where a text may be after ``context``: characters back to a position that a token may begin at, and the last token there.

        A context shorter than ``CONTEXT`` is the text from its beginning. Starts of segments know no last token.
        """
        found: list[tuple[int, str | None]] = []
        for back in range(min(self.longest, len(context) + 1)):
            at = len(context) - back
            if context[at:] not in self.begun:
                continue
            if at == 0 or back and context[at] == MARK != context[at - 1]:
                found.append((back, None))
                continue
            tokens = [context[at - k:at] for k in range(1, min(self.longest, at) + 1)]
            found += [(back, t) for t in tokens if t in self.score and self.may_follow(None, t)]
            if tokens[0] not in self.score:
                found += [(back, None), (back, tokens[0])]
        return found

    def exits(self, state: int, count: int) -> list[tuple[int, str | None, int]]:
        open_text, last = self.states[state]
        return [(len(open_text) - i, t, count + n) for i, (t, n) in enumerate(last) if t != HOLE]

    def map_of(self, context: str, text: str) -> StateMap:
        """State map of a chunk after its left context: for each entry a class and a count, and the exits of each class."""
        whole, at = context + text, len(context)
        first = _SEGMENT_START.search(whole, at)
        end = first.start() if first else len(whole)
        open_: dict[tuple, tuple[int, int]] = {}
        for back, t in self.entries(context):
            [state] = self.within_bounds([self.state_of(("", ((t, 0),)))])
            open_[back, t] = self.states[state], 0, at - back  # as a key: later entries may make this one's number invalid
        moved = {}
        for entry, (key, n, begin) in open_.items():
            state, more = self.run(self.state_of(key), whole[begin:at])
            moved[entry] = self.states[state], n + more
        for i in range(at, end, BLOCK):
            self.within_bounds([])
            block, steps = whole[i:min(i + BLOCK, end)], {}
            for key in {key for key, _ in moved.values()}:
                state, more = self.run(self.state_of(key), block)
                steps[key] = self.states[state], more
            moved = {e: (steps[key][0], n + steps[key][1]) for e, (key, n) in moved.items()}
        moved = {e: (key, n) for e, (key, n) in moved.items() if key[1]}
        if first is None:
            keys = list(dict.fromkeys(key for key, _ in moved.values()))
            return {e: (keys.index(key), n) for e, (key, n) in moved.items()}, [self.exits(self.state_of(key), 0) for key in keys]
        # a word ends here: whatever is no hole at its end goes on from the start state
        tail = max(m.start() for m in _SEGMENT_START.finditer(whole, end))
        middle = self.count(whole[end:tail]) if tail > end else 0
        state, n = self.run_within_bounds(START, whole[tail:])
        return {e: (0, k) for e, (key, k) in moved.items() if key[1][-1][0] != HOLE}, [self.exits(state, middle + n)]


StateMap = tuple[dict[tuple[int, str | None], tuple[int, int]], list[list[tuple[int, str | None, int]]]]


def compose(a: StateMap, b: StateMap) -> StateMap:
    """The map of a chunk with map ``a`` followed by one with map ``b``. Associative."""
    classes = []
    for exits in a[1]:
        reached = {}
        for back, t, n in exits:
            if (back, t) in b[0]:
                k, more = b[0][back, t]
                reached.update({(back_, t_): n + more + n_ for back_, t_, n_ in b[1][k]})
        classes.append([(*e, n) for e, n in reached.items()])
    return {e: (k, n) for e, (k, n) in a[0].items() if classes[k]}, classes


def applied(whole: StateMap) -> int:
    """The count of a whole text: from its beginning to the token that ends with it."""
    k, n = whole[0][0, None]
    [count] = [n_ for back, _, n_ in whole[1][k] if back == 0]
    return n + count


def packed(one: StateMap) -> str:
    return json.dumps([[(*e, *v) for e, v in one[0].items()], one[1]], ensure_ascii=False)


def unpacked(text: str) -> StateMap:
    entries, classes = json.loads(text)
    return {(back, t): (k, n) for back, t, k, n in entries}, classes


@lru_cache(maxsize=2)
def compiled(path: str) -> Transducer:
    return Transducer(path)


def marked(text: str, first: bool) -> str:
    return (MARK if first else "") + text.replace(" ", MARK)


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def counted(docs: DataFrame, model: str | None = None, over: int = OVER, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text; others are ignored).

    A null or empty text has no bytes and no tokens. Texts up to ``chunk`` characters are counted where they are read. Longer
    ones, with or without spaces, are cut and dealt out; their chunks' maps (a few KB each) are composed in runs of 256, then whole. Rows repeated come back as often.
    ``model`` must be there on every executor.
    """
    model = model or default_model()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = f"doc_id {kind}, n_bytes bigint, n_tokens bigint"
    maps = pa.schema([("row", pa.int64()), ("part", pa.int64()), ("bytes", pa.int64()), ("map", pa.string())])

    def whole(batches):
        machine = compiled(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(t.encode()) for t in texts], pa.int64()),
                pa.array([machine.count(marked(t, True)) if t else 0 for t in texts], pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    def parts(batches):
        machine = compiled(model)
        for b in batches:
            found = []
            row, part, before, texts = (b.column(i).to_pylist() for i in range(4))
            for p, k, t in zip(part, before, texts):
                context = marked(t[:k], 0 < k < CONTEXT)
                found.append((len(t[k:].encode()), packed(machine.map_of(context, marked(t[k:], p == 0)))))
            yield batch(maps, row, part, *zip(*found)) if found else batch(maps, *[[]] * 4)

    def composed(frame):
        import pandas as pd

        frame = frame.sort_values("part")
        whole = reduce(compose, map(unpacked, frame["map"]))
        return pd.DataFrame({"row": frame["row"].iloc[:1], "part": [frame["part"].iloc[0] // 256], "bytes": [frame["bytes"].sum()],
                             "map": [packed(whole)]})

    def finished(frame):
        import pandas as pd

        last = composed(frame)
        return pd.DataFrame({"row": last["row"], "n_bytes": last["bytes"], "n_tokens": [applied(unpacked(last["map"].iloc[0]))]})

    short = map_arrow(rows.filter(F.length("text") <= chunk), whole, counts)
    long = rows.filter(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id())
    begin = F.col("part") * chunk
    before = F.least(begin, F.lit(CONTEXT))
    cut = long.select("row", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(length(text) - 1) div {chunk}"))).alias("part"), "text").select(
        "row", "part", before.alias("before"), F.substring(F.col("text"), (begin - before + 1).cast("int"), (before + chunk).cast("int")).alias("text"))
    schema = "row bigint, part bigint, bytes bigint, map string"
    mapped = map_arrow(cut.repartition("row", "part"), parts, schema)
    runs = mapped.groupBy("row", F.expr("part div 256").alias("run")).applyInPandas(composed, schema)
    totals = runs.groupBy("row").applyInPandas(finished, "row bigint, n_bytes bigint, n_tokens bigint")
    counted_long = long.select("row", "doc_id").join(totals, "row").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(counted_long).withColumn("over_limit", F.col("n_tokens") > over)


def op5_token_counts(spark, folder):
    return counted(read(spark, folder, "documents"))
