import random
from functools import reduce

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from brightledger.llm import tokens

PATH = tokens.default_model()
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
MACHINE = tokens.compiled(PATH)
PARTS = ["a", "the", " ", "  ", "\n", "\t", "▁", "é", "ß", "中", "🙂", "in", "tion", "ing", "0", "42", ".", "</s>", "<unk>", "<0x0A>", "́", " ", "\x00", "|", "!!"]


def want(text):
    return len(MODEL.encode(text)) if text else 0


def by_maps(text, size):
    marked = tokens.marked(text, True)
    maps = [MACHINE.map_of(marked[max(0, i - tokens.CONTEXT):i], marked[i:i + size]) for i in range(0, len(marked), size)]
    maps = [tokens.unpacked(tokens.packed(m)) for m in maps]
    while len(maps) > 1:  # any grouping gives the same
        k = random.randrange(len(maps) - 1)
        maps[k:k + 2] = [tokens.compose(maps[k], maps[k + 1])]
    return tokens.applied(maps[0])


@given(st.lists(st.sampled_from(PARTS), max_size=60).map("".join) | st.text(max_size=60))
@settings(max_examples=600, deadline=None)
def test_counts_and_state_maps(text):
    n = want(text)
    assert (MACHINE.count(tokens.marked(text, True)) if text else 0) == n
    if text:
        assert by_maps(text, random.choice([1, 2, 3, 7])) == n


def test_long_runs():
    for text in [" " * 100, " " * 37 + "the", "a" * 500, "=" * 333, "ab" * 200 + " " * 20 + "x"]:
        assert MACHINE.count(tokens.marked(text, True)) == want(text)
        assert by_maps(text, 16) == want(text)


def test_texts_without_spaces(monkeypatch):
    draw = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
    texts = ["".join(draw.choices(letters, k=60_000)), "".join(draw.choices("的一是不了人我在有他", k=30_000)), "=" * 20_000, "a" * 20_000]
    monkeypatch.setattr(tokens, "MAX_ENTRIES", 50_000)
    for text in texts:
        marked = tokens.marked(text, True)
        maps = [MACHINE.map_of(marked[max(0, i - tokens.CONTEXT):i], marked[i:i + 5000]) for i in range(0, len(marked), 5000)]
        # a map is small whatever its chunk holds, and what is kept stays bounded inside one word
        assert max(len(tokens.packed(m)) for m in maps) < 60_000
        assert len(MACHINE.states) + MACHINE.n_arcs + len(MACHINE.fits) < 50_000 + 400 * tokens.BLOCK
        assert tokens.applied(reduce(tokens.compose, maps)) == want(text) == MACHINE.count(marked)


def test_long_texts_in_spark(spark):
    draw = random.Random(6)
    texts = ["".join(draw.choices("abcdefghij0123456789", k=700_000)), "".join(draw.choices("的一是不了人我在有他", k=400_000)), "ab " * 100_000, " " * 70_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for chunk in (tokens.CHUNK, 1000):
        got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in tokens.counted(docs, chunk=chunk).collect()}
        assert got == {i: (len(t.encode()), want(t)) for i, t in enumerate(texts)}


def test_query_equals_library(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in tokens.counted(docs, chunk=1000).collect()}
    for r in docs.select("doc_id", "text").collect():
        n = want(r["text"])
        assert got[r["doc_id"]] == (len(r["text"].encode()), n, n > 4096)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "x " * 5000), (4, "x " * 5000), (5, "y" * 3000), (6, " ")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, n_tokens int")
    got = sorted(((r[0], r[2]) for r in tokens.counted(docs, chunk=100).collect()), key=str)
    assert got == sorted(((d, want(t or "")) for d, t in rows), key=str)
    assert tokens.counted(docs.limit(0)).isEmpty()
