"""Boundary cases of row operators, validation, text and evaluation."""

import pytest
from pyspark.sql import functions as F

from brightledger.functions import dates, strings
from brightledger.operators import aggregates, arrays, evaluation, rows, selection, statistics, text, validation


def one(spark, value, column, kind="double"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column.alias("r")).first()["r"]


def test_bins_are_right_closed(spark):
    c = rows.right_closed_bins(F.col("v"), [0, 10, 20], ["low", "high"])
    assert [one(spark, v, c) for v in (0.0, 0.1, 10.0, 10.1, 20.0, 20.1, None)] == [None, "low", "low", "high", "high", None, None]


def test_timing_class(spark):
    assert [one(spark, v, rows.timing_class(F.col("v")), "int") for v in (-1, -2, 0, 29, 30)] == [0, 1, 2, 2, 3]


def test_part_of_day(spark):
    got = [one(spark, h, dates.part_of_day(F.col("v")), "int") for h in (5, 6, 11, 12, 17, 18, 23)]
    assert got == ["Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


def test_event_time_with_and_without_fraction(spark):
    c = dates.parse_event_time(F.col("v")).cast("string")
    assert one(spark, "2024-01-02T03:04:05.000006Z", c, "string") == "2024-01-02 03:04:05.000006"
    assert one(spark, "2024-01-02T03:04:05Z", c, "string") == "2024-01-02 03:04:05"
    assert one(spark, "yesterday", c, "string") is None


def test_list_splitting(spark):
    c = F.array_join(strings.split_list(F.col("v"), "None"), "|")
    assert [one(spark, v, c, "string") for v in ("a, b ,c", "None", "", None)] == ["a|b|c", "", "", ""]


def test_lists_of_texts_without_items(spark, tmp_path):
    import duckdb
    from compare import differences

    from brightledger.plans.catalog import all_queries, all_sql

    texts = ["a, b ,c", "one", "None", "", "  ", None, ", ", "x,"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    diff, n = differences(all_queries()["f9_split_list"](spark, str(tmp_path)), con, all_sql()["f9_split_list"])
    assert diff is None, diff
    assert n == len(texts)


def test_plate_normalisation(spark):
    assert one(spark, " oO1l]B ", strings.normalise_plate(F.col("v")), "string") == "00111B"
    assert one(spark, " QS|s Z-B.\n", strings.normalise_plate_wide(F.col("v")), "string") == "051528"


def test_recode_and_clip(spark):
    assert one(spark, "x", rows.recode(F.col("v"), {"a": 1}), "string") is None
    assert one(spark, "x", rows.recode(F.col("v"), {"a": 1}, 0), "string") == 0
    assert one(spark, None, rows.clip(F.col("v"), 0.0, 1.0)) is None


def test_scan_mode_error(spark, tables):
    with pytest.raises(ValueError):
        rows.scan_boxes(tables.boxes, "other")


def test_keyed_update_adds_and_keeps(spark):
    df = spark.createDataFrame([(1, 10), (2, 20)], "k int, v int")
    new = spark.createDataFrame([(2, 99, "n")], "k int, v int, w string")
    got = rows.keyed_update(df, new, ["k"], ["v", "w"]).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 10, None), (2, 99, "n")]


def test_sample_is_stable(tables):
    d = tables.documents.select("doc_id")
    a, b = (sorted(r[0] for r in rows.seeded_sample(d.repartition(n), "doc_id", 30).collect()) for n in (1, 7))
    assert a == b and len(a) == 30


def test_constant_column(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert {r["s"] for r in arrays.min_max_scaled(df, "v", "s").collect()} == {0.0}
    assert {r["z"] for r in arrays.standardised(df, "v", "z").collect()} == {0.0}
    assert aggregates.histogram(df, "v", 5).collect()[0]["n"] == 2


def test_histogram_last_bin_holds_the_maximum(spark):
    df = spark.range(11).select(F.col("id").cast("double").alias("v"))
    assert {r["bin"]: r["n"] for r in aggregates.histogram(df, "v", 5).collect()} == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_standings_ties_by_name(spark):
    m = spark.createDataFrame([("g", "b", "a", 1, 1), ("g", "a", "c", 0, 0), ("g", "b", "c", 2, 2)],
                              "group string, team_a string, team_b string, score_a int, score_b int")
    assert [(r["team"], r["points"]) for r in aggregates.standings(m).orderBy("place").collect()] == [("a", 2), ("b", 2)]


MESSAGE = ('{"transaction_id":"t","timestamp":"2024-01-02T00:00:00Z","customer_id":"c","merchant_id":"m","merchant_category":"x",'
           '"payment_method":"%s","amount":%s,"location":{"lat":1.0,"lng":2.0},"device_info":%s,"status":"approved",'
           '"commission_type":"flat","commission_amount":2,"vat_amount":9,"total_amount":%s,"customer_type":"CIP","risk_level":1,'
           '"failure_reason":null}')


def check(spark, text, as_of="2024-01-02 12:00:00"):
    df = spark.createDataFrame([(text,)], "value string")
    r = validation.validate(df, F.lit(as_of).cast("timestamp")).first()
    return r["reject_reason"], r["errors"]


def test_validation_rules(spark):
    assert check(spark, MESSAGE % ("pos", 100, "{}", 111)) == (None, [])
    assert check(spark, MESSAGE % ("mobile", 100, "{}", 112), "2024-01-01 00:00:00") == (None, ["ERR_AMOUNT", "ERR_TIME", "ERR_DEVICE"])
    assert check(spark, MESSAGE % ("mobile", 100, '{"os":"iOS"}', 111)) == (None, [])
    assert check(spark, MESSAGE % ("mobile", 100, '{"os":"Other"}', 111)) == (None, ["ERR_DEVICE"])
    assert check(spark, MESSAGE % ("pos", 100, "{}", 111), "2024-01-03 00:00:00") == (None, [])
    assert check(spark, MESSAGE % ("pos", 100, "{}", 111), "2024-01-03 00:00:01") == (None, ["ERR_TIME"])


def test_rejects(spark):
    assert check(spark, "{")[0] == "malformed"
    assert check(spark, (MESSAGE % ("pos", 100, "{}", 111)).replace('"lat":1.0,', ""))[0] == "missing:lat"
    assert check(spark, (MESSAGE % ("pos", 100, "{}", 111)).replace('"status":"approved",', ""))[0] == "missing:status"
    assert check(spark, MESSAGE % ("pos", '"many"', "{}", 111))[0] == "cast:amount"


def test_cleaning(spark):
    assert one(spark, None, text.clean(F.col("v")), "string") == ""
    assert one(spark, " ك​ a‌b \U0001F600!!?? .. ", text.clean(F.col("v")), "string") == "ک a b !?? ."
    assert one(spark, "sooo goood", F.array_join(text.shorten_repeats(text.tokens(F.col("v"))), " "), "string") == "soo good"
    assert one(spark, "وای x", F.array_join(text.replace_words(text.tokens(F.col("v"))), " "), "string") == "تعجب x"
    assert one(spark, "one two", F.array_join(text.ngrams(text.words(F.col("v")), 3), "|"), "string") == ""


def test_marks(spark):
    df = spark.createDataFrame([("aً",), (None,)], "v string")
    got = {(r["column"], r["mark"]): r["present"] for r in text.marks_present(
        df, {"before": F.col("v"), "after": text.remove_marks(F.col("v"))}).collect()}
    assert got["before", "ً"] and not got["after", "ً"] and not got["before", "ٰ"] and len(got) == 18


def test_splits_partition_the_rows(tables):
    s = selection.random_split(tables.lineitem, "l_orderkey", {"a": 0.7, "b": 0.15, "c": 0.15})
    assert s.count() == tables.lineitem.count()
    assert s.select("l_orderkey", "split").distinct().groupBy("l_orderkey").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("key", ["concat('img_', id)", "-id", "id", "cast(-id as decimal(20,0))"])
def test_splits_by_keys_of_any_type_and_sign(spark, key):
    s = selection.random_split(spark.range(2_000).selectExpr(f"{key} as k"), "k", {"train": 0.8, "test": 0.2})
    assert 0.77 < s.filter("split = 'train'").count() / 2_000 < 0.83
    assert selection.stratified_split(s.withColumn("label", F.lit(1)), "label", "k").filter("split = 'train'").count() == 1_600


def test_unseen_category(spark):
    train, new = spark.createDataFrame([("b",), ("a",)], "c string"), spark.createDataFrame([("a",), ("z",)], "c string")
    assert {r["c"]: r["code"] for r in selection.label_codes(new, "c", fit_on=train).collect()} == {"a": 0, "z": None}


def test_unknown_strategy():
    with pytest.raises(ValueError):
        selection.uncertainty("p", "guess")


def test_undefined_class_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (1, 1)], "y int, p int")
    r = {x["label"]: x for x in evaluation.class_report(df, "y", "p").collect()}
    assert (r[0]["precision"], r[0]["recall"], r[0]["f1"]) == (0.0, 0.0, 0.0)
    assert r[1]["precision"] == pytest.approx(1 / 3) and r[1]["recall"] == 1.0


def test_roc_area_all_tied(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (0, 0.5)], "y int, s double")
    assert evaluation.roc_area(df, "y", "s").first()["auc"] == 0.5


def test_decision_labels(spark):
    c = statistics.decision(F.col("v"))
    assert [one(spark, p, c) for p in (0.01, 0.07, 0.5)] == ["rejected at 0.05", "rejected at 0.1", "not rejected"]
