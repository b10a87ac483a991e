"""What queries move and how often they read, which their results do not show."""

import random

import pytest

from brightledger.operators import joins
from brightledger.plans.catalog import all_queries
from brightledger.sources import files


def plan(df):
    return df._jdf.queryExecution().toString()


def kept_labels(monkeypatch, module):
    """Labels of the stage tables that a module writes."""
    labels, write = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, label: labels.append(label) or write(df, label))
    return labels


@pytest.fixture(scope="module")
def boxes(spark):
    rnd = random.Random(7)

    def rows(p, n):
        for image, count in (("few", 5), ("more", n), ("other", 3), (None, 2)):
            for i in range(count):
                x, y = rnd.randrange(0, 200), rnd.randrange(0, 150)
                yield image, f"{p}{i:03d}", x, y, x + rnd.randrange(0, 90), y + rnd.randrange(0, 80)

    schema = "filename string, {} string, xmin int, ymin int, xmax int, ymax int"
    truth, guesses = list(rows("t", 40)), list(rows("p", 50))
    return [spark.createDataFrame([*r, r[3], r[-1]], schema.format(c)) for r, c in ((truth, "box_id"), (guesses, "pred_id"))]


def values(df):
    return sorted((tuple(str(v) for v in r) for r in df.collect()))


def test_boxes_of_small_images_are_not_copied_to_cells(spark, boxes):
    small = [df.filter("filename = 'few'") for df in boxes]
    assert "Generate" not in plan(joins.overlapping_boxes(*small))
    assert "Generate" not in plan(joins.best_overlap(*small))


def test_small_and_crowded_images_give_the_same(spark, boxes):
    for f in (joins.overlapping_boxes, joins.best_overlap):
        every = [values(f(*boxes, most=most)) for most in (0, 30, 1000)]
        assert every[0] and every[0] == every[1] == every[2]


def test_matching_in_one_list_and_in_rounds_is_the_same(spark, boxes, monkeypatch):
    pairs = joins.overlapping_boxes(*boxes)
    pairs = pairs.unionByName(spark.createDataFrame([(None, "a", "b", 0.9), ("few", None, "p000", 0.95), ("other", "t000", None, 0.7)], pairs.schema))
    every = [values(joins.greedy_matches(pairs, threshold=0.2, most=most)) for most in (0, 20, 100_000)]
    assert every[0] and every[0] == every[1] == every[2]
    labels = kept_labels(monkeypatch, joins)
    joins.greedy_matches(pairs.filter("filename is not null and box_id is not null and pred_id is not null")).collect()
    assert labels == ["pairs", "crowded"]  # no round was written


def test_dense_ids_read_the_lines_once(spark, folder):
    assert "lineitem" not in plan(all_queries()["j11_dense_id_mapping"](spark, folder))


def test_annotation_files_hold_a_bounded_number_of_documents(spark, tmp_path):
    documents = spark.range(25).coalesce(1).selectExpr("'f' AS folder", "concat('img_', id) AS filename", "struct(1 AS width, 2 AS height) AS size")
    files.write_annotations(documents, str(tmp_path / "xml"), per_file=10)
    assert len(list((tmp_path / "xml").glob("part-*"))) == 3
    assert files.read_annotation_documents(spark, str(tmp_path / "xml")).count() == 25


def test_annotation_files_are_compressed(spark, tmp_path):
    documents = spark.range(500).selectExpr("'f' AS folder", "concat('img_', id) AS filename", "struct(1 AS width, 2 AS height) AS size",
                                            "array(struct(struct(1 AS xmin, 2 AS ymin, 3 AS xmax, 4 AS ymax) AS bndbox, ' a b ' AS ocr_text, 1 AS worth_ocr)) AS object")
    sizes = {}
    for name, options in (("plain", {"compression": "none"}), ("as_is", {})):
        files.write_annotations(documents.coalesce(1), str(tmp_path / name), **options)
        sizes[name] = sum(f.stat().st_size for f in (tmp_path / name).glob("part-*"))
    assert sizes["as_is"] * 10 < sizes["plain"]
    plain, rows = (files.annotation_rows(files.read_annotation_documents(spark, str(tmp_path / name))).orderBy("filename").collect() for name in sizes)
    assert rows == plain and len(rows) == 500


def test_every_block_of_a_stratum_has_its_own_task(spark):
    from pyspark.sql import functions as F

    from brightledger.operators import descent

    dense = spark.range(4000).select((F.col("id") % 97).cast("int").alias("u"), (F.col("id") % 89).cast("int").alias("i"), (F.col("id") % 5).alias("label"))
    rows = descent.strata(dense, 8, 1)
    ratings = descent.packed_strata(rows)
    assert ratings.count() <= 64  # bytes of a block and stratum, not a row for every rating
    state = descent.packed_state(descent.first_state(dense, 3, 1), 8, 3)
    out = descent.train_packed(state, ratings, 0, 8, 2.0, 0.02, 0.02, 3)
    files = out.filter("kind = 0").select("home", F.input_file_name().alias("file")).distinct()
    assert files.count() == files.select("file").distinct().count() == 8


def test_settings_that_share_factors_are_measured_in_one_pass(spark, monkeypatch):
    from brightledger.operators import recommend

    rnd = random.Random(5)
    rows = [(u, i, float(rnd.randrange(1, 6))) for u in range(30) for i in range(12) if rnd.random() < 0.5]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, label double")
    edges = spark.createDataFrame([(u, (u * 7 + 1) % 30, 1.0) for u in range(0, 30, 2)], "src bigint, dst bigint, weight double")
    ranks = spark.createDataFrame([(u, 0.1 + u) for u in range(30)], "node bigint, rank double")
    prepared, grid = recommend.prepare(ratings, edges, ranks), {"rank": [2], "strength": [0.4, 0.8], "rate": [0.5, 1.0], "iterations": [2]}
    test = ratings.limit(60)
    passes, made = [], recommend._HotRatings
    monkeypatch.setattr(recommend, "_HotRatings", lambda df: passes.append(1) or made(df))
    got = {(r["rate"], r["strength"]): r for r in recommend.grid_search(prepared, test, grid).collect()}
    assert len(got) == 4 and len(passes) == 1
    known = recommend.factors(prepared, rank=2, iterations=2)
    for (rate, strength), r in got.items():
        want = recommend.fit_quality(recommend.fit(prepared, rank=2, iterations=2, rate=rate, strength=strength, known=known), test).first()
        assert all(r[c] == pytest.approx(want[c], abs=1e-12) for c in ("mae", "rmse", "mse", "r2"))


def test_runs_of_words_are_counted_by_bucket_first(spark, monkeypatch):
    from collections import Counter

    from pyspark.sql import functions as F

    from brightledger.operators import text

    rnd = random.Random(11)
    lists = [[rnd.choice("abcdefgh") for _ in range(rnd.randrange(0, 40))] for _ in range(60)]
    df = spark.createDataFrame([(x,) for x in lists], "w array<string>")
    labels = kept_labels(monkeypatch, text)
    for n, buckets, first in ((2, 1 << 20, 4096), (2, 16, 3), (3, 64, 20), (3, 1 << 20, 1), (9, 8, 2)):
        counts = Counter(" ".join(x[i:i + n]) for x in lists for i in range(len(x) - n + 1))
        want = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:20]
        assert [(r["ngram"], r["n"]) for r in text.top_ngrams(df, F.col("w"), n, 20, buckets, first).collect()] == want
    assert "buckets" in labels


def test_pairs_of_words_are_counted_once(spark, folder, monkeypatch):
    from brightledger.operators import word_space as ws

    texts = [[rnd.choice(["the", "of", *"abcdefghij"]) for _ in range(40)] for rnd in [random.Random(3)] for _ in range(30)]
    docs = spark.createDataFrame([(t,) for t in texts], "w array<string>")
    vocabulary = ws.vocabulary_of(docs, "w")
    lists, keyed = ws.coded(docs, "w", vocabulary)
    assert keyed.schema["word"].dataType.simpleString() == "bigint"
    labels = kept_labels(monkeypatch, ws)
    found = ws.information(ws.word_pairs(lists, "w", 5), keyed)
    assert labels.count("pairs") == 1 and "slice" not in plan(found)  # joins read the written counts, not the texts
    plain = ws.information(ws.word_pairs(docs, "w", 5), vocabulary.select("word", "id"))
    assert found.count() and values(found) == values(plain)


def test_words_that_share_a_hash_are_counted_as_they_are(spark):
    from brightledger.operators import word_space as ws

    docs = spark.createDataFrame([(["a", "b", "a"],)], "w array<string>")
    twice = spark.createDataFrame([("a", 0), ("a", 1)], "word string, id bigint")
    lists, keyed = ws.coded(docs, "w", twice)
    assert lists.first()["w"] == ["a", "b", "a"] and keyed.schema["word"].dataType.simpleString() == "string"


def test_word_vectors_go_to_blocks_of_lists(spark, monkeypatch):
    from brightledger.operators import retrieval as rt

    rnd = random.Random(2)
    words = {f"w{k}": [[rnd.random() if rnd.random() < 0.9 else None for _ in range(3)] for _ in range(2 if k == 5 else 1)] for k in range(30)}
    words["w7"] = [None]
    lists = [(k % 50, None if k % 9 == 0 else [rnd.choice([*words, "other", None]) for _ in range(rnd.randrange(0, 7))]) for k in range(70)]
    docs = spark.createDataFrame([((d, "x"), w) for d, w in lists], "row struct<a: bigint, b: string>, w array<string>")
    vocabulary = spark.createDataFrame([(w, v) for w, vs in words.items() for v in vs] + [(None, [1.0] * 3)], "word string, vector array<float>")
    want = {}
    for d in range(50):
        met = [v or [None] * 3 for k, w in lists if k == d for x in w or [] for v in words.get(x, [])]
        parts = [[float(v[i]) for v in met if v[i] is not None] for i in range(3)]
        want[d] = [sum(p) / len(met) if p else None for p in parts] if met else [0.0] * 3
    for held, cell in ((65_536, 4_000_000), (7, 20)):
        monkeypatch.setattr(rt, "HELD_WORDS", held)
        monkeypatch.setattr(rt, "CELL_TOKENS", cell)
        out = rt.mean_word_vectors(docs, "row", "w", vocabulary, 3)
        assert "_sums_by_list" in plan(out) or "MapInArrow" in plan(out)
        got = out.collect()
        assert len(got) == 70
        for r in got:
            assert [v if v is None else pytest.approx(v, abs=1e-6) for v in want[r["row"]["a"]]] == r["vector"]


def test_rounds_of_training_have_no_more_tasks_than_cores(spark, folder):
    from brightledger.operators import models
    from brightledger.plans import learning
    from brightledger.sources.tables import Tables

    cores = spark.sparkContext.defaultParallelism
    rows = spark.range(0, 1000, 1, 5 * cores)
    assert models.for_rounds(rows).rdd.getNumPartitions() == cores and models.for_rounds(rows).count() == 1000
    assert models.for_rounds(spark.range(0, 10, 1, 1)).rdd.getNumPartitions() == 1
    for made in (learning.labelled_vectors, learning.class_vectors):
        assert "Coalesce" in plan(made(Tables(spark, folder)))


def test_hot_ratings_are_known_from_the_biases_counts(spark, monkeypatch):
    from brightledger.operators import recommend

    rnd = random.Random(9)
    rows = [(u if rnd.random() < 0.5 else 1, i, float(rnd.randrange(1, 6))) for u in range(30) for i in range(12)]
    ratings = spark.createDataFrame(rows, "user_id bigint, item_id bigint, label double")
    searched, search = [], recommend.hot_keys
    monkeypatch.setattr(recommend, "hot_keys", lambda df, keys: searched.append(keys) or search(df, keys))
    hot = recommend._HotRatings(ratings)
    recommend.bias_baseline(ratings, hot=hot)
    assert not searched
    assert {k: hot._hot(k) for k in ("user_id", "item_id")} == {k: search(ratings, [k]) for k in ("user_id", "item_id")}


def test_lines_meet_orders_and_are_summed_once(spark, folder):
    from brightledger.sources.tables import Tables

    text = Tables(spark, folder).ratings._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_stored_parts_are_hashed_once(spark):
    from pyspark.sql import functions as F

    from brightledger.operators import models
    df = spark.range(200).select(F.col("id").alias("key"), (F.col("id") * 2.0).alias("label"))
    stored, plain = models.split_parts(df, "key", stored="prices"), models.split_parts(df, "key")
    for a, b in zip(stored, plain):
        assert sorted(a.collect()) == sorted(b.collect()) and a.columns == b.columns
        assert "md5" not in a._jdf.queryExecution().optimizedPlan().toString() and "md5" in b._jdf.queryExecution().optimizedPlan().toString()


def test_least_squares_keeps_few_shuffles_and_blocks_follow_the_ratings(spark, monkeypatch):
    from brightledger.operators import recommend

    rnd = random.Random(9)
    rows = [(u, i, float(rnd.randrange(1, 6))) for u in range(40) for i in range(25) if rnd.random() < 0.5]
    prepared = recommend.prepare(spark.createDataFrame(rows, "user_id bigint, item_id bigint, label double"))
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {str(b).split("_")[1] for b in manager.getAllBlocks().mkString(" ").split() if str(b).startswith("shuffle_")}

    made, als = [], recommend.ALS
    monkeypatch.setattr(recommend, "ALS", lambda **given: made.append(given) or als(**given))
    before = shuffles()
    users, items = recommend.factors(prepared, rank=3, iterations=10)
    assert len(shuffles() - before) < 10  # two in each of ten iterations
    assert users.count() == 40 and items.count() == 25
    monkeypatch.setattr(recommend, "ALS_BLOCK_RATINGS", 20)
    recommend.factors(prepared, rank=3, iterations=1)
    assert [g["numUserBlocks"] for g in made] == [g["numItemBlocks"] for g in made] == [10, -(-len(rows) // 20)]
    model = recommend.fit(prepared, rank=3, iterations=10, known=(users, items))
    assert recommend.fit_quality(model, spark.createDataFrame(rows, "user_id bigint, item_id bigint, label double")).first()["r2"] > 0.3
