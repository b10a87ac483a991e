"""Cost-balanced packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.llm.common import map_arrow, read
from brightledger.llm.words import listed, split

LENGTH = 2048
END = 1
#: Cost of a piece: its tokens times LINEAR plus their square times QUADRATIC (attention within the piece).
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH
#: Tokens that are packed together, about; what a task holds.
LOT = 1 << 20
#: Bytes of words and ids that a worker keeps, with about ENTRY_BYTES for each word; words of more than LONG_WORD letters aren't kept.
KEPT_BYTES, ENTRY_BYTES, LONG_WORD = 256 << 20, 200, 1_000
#: New words that are encoded in one call, parted by a character that is a token of its own between spaces.
JOINED, PARTING = 256, "\x01"


class WordIds(dict):
    """Ids of words as bytes: white space parts tokens in this tokenizer and leaves none of its own.

    Texts are split at ASCII white space only; other white space stays inside a word and is left to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.kept = Tokenizer.from_file(path), 0
        self.parting = self.tokenizer.encode(PARTING, add_special_tokens=False).ids
        if len(self.parting) != 1:
            raise ValueError("the parting character is not one token")

    def encoded(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new words, encoded together; words that hold the parting character or are long alone."""
        alone = [w for w in words if PARTING in w or len(w) > LONG_WORD]
        out = {w: np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in alone}
        words = [w for w in words if w not in out]
        parts = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        texts = [f" {PARTING} ".join(p) for p in parts]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids, at = np.array(e.ids, "<u4"), 0
            raw, ends = ids.tobytes(), [*np.flatnonzero(ids == self.parting[0]).tolist(), len(ids)]
            for word, end in zip(part, ends, strict=True):
                out[word] = raw[4 * at:4 * end]
                at = end + 1
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, size = self.encode_batch(pa.array(texts, pa.large_string()))
        ends = np.cumsum(size)
        return [ids[end - n:end].tobytes() for n, end in zip(size, ends)]

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has. Every distinct word of the batch is looked up once."""
        words, rows = split(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = words.dictionary_encode()
        distinct = listed(coded.dictionary)
        each = list(map(self.get, distinct))
        new = self.encoded([w for w, ids in zip(distinct, each) if ids is None])
        if new:
            each = [new[w] if ids is None else ids for w, ids in zip(distinct, each)]
        fresh = {w: ids for w, ids in new.items() if len(w) <= LONG_WORD}
        more = sum(4 * len(w) + len(ids) + ENTRY_BYTES for w, ids in fresh.items())
        if self.kept + more > KEPT_BYTES:
            self.clear()
            self.kept = 0
        if more <= KEPT_BYTES:
            self.update(fresh)
            self.kept += more
        flat, size = np.frombuffer(b"".join(each), "<u4"), np.fromiter(map(len, each), np.int64, len(each)) // 4
        index = coded.indices.to_numpy()
        length = size[index]
        behind = np.cumsum(length)
        start = (np.cumsum(size) - size)[index] - (behind - length)
        ids = flat[np.repeat(start, length) + np.arange(int(length.sum()))]
        return ids, np.bincount(rows, length, len(texts)).astype(np.int64)


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def capacities(tokens: int, length: int = LENGTH) -> list[int]:
    """Sequences for so many tokens: full ones, then powers of two for the rest, so that none is padded."""
    rest = tokens % length
    return [length] * (tokens // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(tails: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of pieces: longest document first, each to the sequence of the lowest cost
    that has room for it; where none has, it is cut and fills the cheapest one with any room.

    Capacities add up to the tokens, so all sequences end full. Ties go to the first document and the first sequence.
    """
    room = np.array(capacities(sum(tails), length), np.int64)
    size, cost, used = room.copy(), np.zeros(len(room)), np.zeros(len(room), np.int64)
    pieces = []
    for d in sorted(range(len(tails)), key=lambda d: (-tails[d], d)):
        start, left = 0, tails[d]
        while left:
            fitting = room >= left
            open_ = fitting if fitting.any() else room > 0
            s = int(np.where(open_, cost / size, np.inf).argmin())  # small sequences count by their share of work
            n = min(left, int(room[s]))
            pieces.append((d, start, n, s, int(used[s])))
            room[s] -= n
            used[s] += n
            cost[s] += LINEAR * n + QUADRATIC * n * n
            start, left = start + n, left - n
    return pieces


def _lot(ids: list[bytes], length: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces of a lot: every full length of a document is a sequence of its own, the rests are assigned by cost."""
    sizes = [len(b) // 4 for b in ids]
    pieces = [(d, k * length, length, 0, 0) for d, n in enumerate(sizes) for k in range(n // length)]
    pieces = [(d, start, n, s, 0) for s, (d, start, n, _, _) in enumerate(pieces)]
    whole = len(pieces)
    rests = [(d, n % length) for d, n in enumerate(sizes) if n % length]
    for d, start, n, s, offset in assign([n for _, n in rests], length):
        doc, rest = rests[d]
        pieces.append((doc, sizes[doc] - rest + start, n, whole + s, offset))
    return pieces


def packed(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end: int = END, lot: int = LOT, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all rows of ``docs`` (doc_id, text).

    Null and empty texts have the end token only. Documents are packed in lots of about ``lot`` tokens within their partition,
    so nothing is shuffled, a task holds one lot (and one document's ids), and a retried task gives the same pieces. A lot's
    sequences are full or a power of two long: no padding. sequence_id is unique over all lots. Repeated rows are packed as
    often. ``with_ids`` adds the token ids; ``tokenizer`` must be there on every executor.
    """
    path = tokenizer or default_tokenizer()
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema += ", ids array<bigint>" * with_ids

    def work(batches):
        from pyspark import TaskContext

        words, stop = word_ids(path), np.array([end], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 36
        held, ids, tokens, id_type = [], [], 0, None

        def emit():
            nonlocal sequence, held, ids, tokens
            rows = _lot(ids, length)
            cut = [ids[d][4 * a:4 * (a + n)] for d, a, n, _, _ in rows]
            columns = [pa.array([held[r[0]] for r in rows], id_type), *(pa.array(c, pa.int64()) for c in (
                [r[1] for r in rows], [r[2] for r in rows], [zlib.crc32(c) for c in cut], [len(ids[r[0]]) // 4 for r in rows],
                [sequence + r[3] for r in rows], [r[4] for r in rows]))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([np.frombuffer(c, "<u4").astype(np.int64) for c in cut], pa.list_(pa.int64())))
                names.append("ids")
            sequence += max((r[3] for r in rows), default=-1) + 1
            held, ids, tokens = [], [], 0
            return pa.RecordBatch.from_arrays(columns, names=names)

        for b in batches:
            id_type = b.column(0).type
            found, size = words.encode_batch(b.column(1))
            raw, ends = found.tobytes(), np.cumsum(size) * 4
            for doc, n, behind in zip(b.column(0).to_pylist(), size.tolist(), ends.tolist()):
                held.append(doc)
                ids.append(raw[behind - 4 * n:behind] + stop)
                tokens += n + 1
                if tokens >= lot:
                    yield emit()
        if held:
            yield emit()

    return map_arrow(docs.select("doc_id", "text"), work, schema)


def op6_packing(spark, folder):
    return packed(read(spark, folder, "documents"))


def stage(spark, docs, folder):
    """The pieces of all documents; nulls, empty and very long texts and repeated rows as in ``packed``."""
    return packed(docs)
