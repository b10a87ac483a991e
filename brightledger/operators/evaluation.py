"""Model and result quality: classification, ranking, regression, masks, recognised text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightledger.functions.strings import character_accuracy, indel_ratio, normalise_plate_wide
from brightledger.operators.ordering import with_running_sums


def confusion(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Counts per (truth, guess): a row pair is shuffled only after map-side counting."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(F.count("*").alias("n"))


def class_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support of every class; undefined ratios are 0."""
    c = confusion(df, truth, guess)
    hit = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    by_truth = c.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    by_guess = c.groupBy(F.col("guess").alias("label")).agg(F.sum("n").alias("predicted"))
    j = by_truth.join(by_guess, "label", "full").na.fill(0, ["support", "tp", "predicted"])
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    j = j.withColumns({"precision": zero(F.try_divide("tp", "predicted")), "recall": zero(F.try_divide("tp", "support"))})
    f1 = zero(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    return j.withColumn("f1", f1)


def classification_summary(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Accuracy with macro and support-weighted precision, recall and F1."""
    r = class_report(df, truth, guess)
    w = lambda c: F.sum(F.col(c) * F.col("support")) / F.sum("support")
    return r.agg((F.sum("tp") / F.sum("support")).alias("accuracy"),
                 *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
                 *[w(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")])


def _score_counts(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: ties, however many, become one row."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))


def roc_area(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve by the rank sum with average ranks for ties."""
    run = with_running_sums(_score_counts(df, label, score, by), {"cum_neg": "neg", "cum_pos": "pos"}, ["score"], by,
                            totals_too=True)
    wins = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0))
    return run.groupBy(*by).agg(wins.alias("_w"), F.max("cum_neg_total").alias("_n"), F.max("cum_pos_total").alias("_p")).select(
        *by, F.try_divide("_w", F.col("_n") * F.col("_p")).alias("auc"))


def one_vs_rest(df: DataFrame, truth: str, probs: str, n_classes: int) -> DataFrame:
    """One row per (row, class) with a 0/1 label and that class's score."""
    cells = F.array(*[F.struct(F.lit(k).alias("class"), (F.col(truth) == k).cast("int").alias("label"),
                               F.col(probs)[k].alias("score")) for k in range(n_classes)])
    return df.select(F.inline(cells))


def macro_roc_area(df: DataFrame, truth: str, probs: str, n_classes: int) -> DataFrame:
    return roc_area(one_vs_rest(df, truth, probs, n_classes), "label", "score", ["class"]).agg(F.avg("auc").alias("macro_auc"))


def roc_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct score taken as the threshold."""
    run = with_running_sums(_score_counts(df, label, score, by), {"fp": "neg", "tp": "pos"}, [F.col("score").desc()], by,
                            totals_too=True)
    return run.select(*by, F.col("score").alias("threshold"), F.try_divide("fp", "fp_total").alias("fpr"),
                      F.try_divide("tp", "tp_total").alias("tpr"))


def regression_summary(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE, R2, MAPE (floor 1e-8) and the cumulative error per group, in one pass."""
    y, p = F.col(truth), F.col(guess)
    err = y - p
    sums = df.groupBy(*by).agg(F.avg(F.abs(err)).alias("mae"), F.avg(err * err).alias("mse"), F.sum(err * err).alias("_sse"),
                  (F.var_pop(y) * F.count(y)).alias("_sst"), F.sum(err).alias("cumulative_error"),
                  (100 * F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(1e-8)))).alias("mape"))
    return sums.select(*by, "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide("_sse", "_sst")).alias("r2"), "mape",
                       "cumulative_error")


def mask_overlap(df: DataFrame, image: str, guess: Column, truth: Column) -> DataFrame:
    """Dice and intersection-over-union per image, from a pixel table with two 0/1 masks."""
    both = guess.cast("boolean") & truth.cast("boolean")
    either = guess.cast("boolean") | truth.cast("boolean")
    c = df.groupBy(image).agg(F.count_if(both).alias("_i"), F.count_if(either).alias("_u"),
                              F.count_if(guess.cast("boolean")).alias("_g"), F.count_if(truth.cast("boolean")).alias("_t"))
    return c.select(image, (2 * F.col("_i") / (F.col("_g") + F.col("_t") + F.lit(1e-8))).alias("dice"),
                    (F.col("_i") / (F.col("_u") + F.lit(1e-8))).alias("iou"))


def text_quality(df: DataFrame, truth: str, guesses: dict[str, str]) -> DataFrame:
    """Per method: exact and normalised match rate, mean distance, similarity ratio, character accuracy."""
    t = normalise_plate_wide(F.col(truth))
    cells = F.array(*[F.struct(F.lit(m).alias("method"), F.col(c).alias("raw")) for m, c in guesses.items()])
    long = df.select(F.col(truth).alias("truth"), t.alias("t"), F.inline(cells)).withColumn("g", normalise_plate_wide(F.col("raw")))
    # equal pairs are merged first, so the Python ratio runs once per distinct pair
    pairs = long.groupBy("method", "truth", "raw", "t", "g").agg(F.count("*").alias("c")).withColumn(
        "ratio", indel_ratio("t", "g"))
    mean = lambda x: F.sum(x * F.col("c")) / F.sum("c")
    return pairs.groupBy("method").agg(
        mean((F.col("truth") == F.col("raw")).cast("int")).alias("exact"),
        mean((F.col("t") == F.col("g")).cast("int")).alias("normalised"),
        mean(F.levenshtein("t", "g")).alias("mean_distance"), mean(F.col("ratio")).alias("mean_ratio"),
        mean(character_accuracy(F.col("t"), F.col("g"))).alias("char_accuracy"))


def ranking_quality(ranked: DataFrame, relevant_totals: DataFrame, query: str, rank: str, relevance: str, k: int) -> DataFrame:
    """Precision, recall, F1 and NDCG at k per query.

    ``ranked`` holds at most k rows per query (rank from 1); ``relevant_totals`` the number of
    relevant items per query (``n_relevant``). The ideal gain reorders the query's own k rows.
    """
    gain = F.pow(F.lit(2.0), F.col(relevance)) - 1
    ideal = Window.partitionBy(query).orderBy(F.desc(relevance), rank)
    r = ranked.filter(F.col(rank) <= k).withColumn("_ideal", F.row_number().over(ideal))
    per = r.groupBy(query).agg(
        F.count_if(F.col(relevance) > 0).alias("_hits"), F.sum(gain / F.log2(F.col(rank) + 1)).alias("_dcg"),
        F.sum(gain / F.log2(F.col("_ideal") + 1)).alias("_idcg"))
    out = per.join(relevant_totals, query, "left")
    p, rec = F.col("_hits") / k, F.coalesce(F.try_divide("_hits", "n_relevant"), F.lit(0.0))
    return out.select(query, p.alias("precision"), rec.alias("recall"),
                      F.coalesce(F.try_divide(2 * p * rec, p + rec), F.lit(0.0)).alias("f1"),
                      F.coalesce(F.try_divide("_dcg", "_idcg"), F.lit(0.0)).alias("ndcg"))
