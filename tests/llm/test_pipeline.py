"""Stages of the pipeline against plain versions of what they keep."""

import pytest
from test_packing import check
from test_simhash import brute

import corpus_pipeline
from brightledger.llm import mixing, pii, quality
from brightledger.session import materialise


@pytest.fixture(scope="module")
def kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], folder), name))
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_stay(kept):
    assert all(set(k.columns) == set(kept[0].columns) for k in kept[:-1])


def test_stages(spark, kept):
    raw, good, single, clean, mix, packed = kept
    assert ids(good) == ids(quality.judged(raw).filter("kept"))
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    assert ids(single) == sorted({c for _, _, c in brute(rows)})
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    for r in single.collect():
        found = pii.entities(r["text"])
        assert (texts[r["doc_id"]] == r["text"]) == (not found)
        assert not any(v in texts[r["doc_id"]] for _, _, kind, _, v in found if kind in ("email", "card", "key", "ip"))
    assert set(ids(mix)) <= set(ids(clean))
    check(packed.collect(), {r["doc_id"]: r["text"] for r in mix.collect()})


def test_run_applies_all_stages(spark, folder, kept):
    assert ids(corpus_pipeline.run(spark, folder)) == ids(kept[-1])


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, folder), name)
    assert docs.isEmpty()


def test_null_ids_texts_and_clashing_columns(spark, folder):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "src0", 0, "x"), (2, "word " * 30, "en", "src1", 150, "x")]
    rows += [(d, " ".join(f"w{d}x{i}" for i in range(80)), "en", "src0", 500, "y") for d in (3, 4, 4, None)]
    rows += [(4, " ".join(f"other{i}" for i in range(90)), "de", "src2", 500, "z"), (5, rows[3][1], "en", "src0", 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = materialise(stage(spark, docs, folder), name)
        assert set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars", "fp"}
    assert len(ids_or_null(docs)) == len(set(ids_or_null(docs)))


def ids_or_null(df):
    return [r["doc_id"] for r in df.collect()]
