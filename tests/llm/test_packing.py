import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brightledger.llm import packing

TOKENIZER = Tokenizer.from_file(packing.default_tokenizer())
WORDS = packing.word_ids(packing.default_tokenizer())


@given(st.text(max_size=80) | st.lists(st.sampled_from(["It's", " ", "\n", "́a", "İ", "ΑΣ", "<|endoftext|>", "\x1c", " ", "12", "don't", "é", "\x01", ".\x01"]), max_size=20).map("".join))
@settings(max_examples=500, deadline=None)
def test_ids_word_by_word(text):
    assert np.frombuffer(WORDS.encode([text])[0], "<u4").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@given(st.lists(st.integers(1, 2047), max_size=60))
@settings(max_examples=200, deadline=None)
def test_assignment_fills_sequences(tails):
    pieces = packing.assign(tails)
    sums, cut = {}, {}
    for d, start, n, s, offset in pieces:
        assert sums.get(s, 0) == offset and cut.get(d, 0) == start and n > 0
        sums[s], cut[d] = offset + n, start + n
    assert [cut[d] for d in range(len(tails))] == tails
    assert sorted(sums.values(), reverse=True) == packing.capacities(sum(tails))


def test_documents_go_to_the_cheapest_sequence_with_room():
    assert [(d, s) for d, _, _, s, _ in packing.assign([1024, 1024, 512, 512, 512, 512])] == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0), (5, 1)]


def check(rows, texts):
    ends, pieces = {}, {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
        pieces.setdefault(r["doc_id"], []).append(r)
    assert all(n == 2048 or n < 2048 and n & (n - 1) == 0 for n in ends.values())
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        ids = np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_round_trip(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    check(packing.packed(docs, lot=50_000).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_edges(spark):
    rows = {1: None, 2: "", None: "null id", 4: "long " * 9000}
    docs = spark.createDataFrame([(d, t, 5) for d, t in rows.items()], "doc_id bigint, text string, length int")
    check(packing.packed(docs).collect(), rows)
    twice = packing.packed(docs.union(docs)).agg({"length": "sum"}).first()[0]
    assert twice == 2 * packing.packed(docs).agg({"length": "sum"}).first()[0]
    assert packing.packed(docs.limit(0)).isEmpty()
    with_ids = packing.packed(docs, with_ids=True).collect()
    assert all(len(r["ids"]) == r["length"] for r in with_ids)
