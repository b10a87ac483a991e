"""Mixing sources to target weights: budgets down a tree, then token prefixes of seeded epochs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightledger.llm.common import WORD, read
from brightledger.session import materialise

LEVELS = ["domain", "lang", "source"]
SEED = 42
#: Hex digits of a row's place that make its slot; only the slot that a budget ends in is put in full order.
SLOT_DIGITS = 4
#: Parameters of the registered query: the target is this share of all words, and no leaf is read more often than this.
SHARE, EPOCHS = 0.6, 3
#: Fixed weights of the registered query; values not listed weigh 1.
WEIGHTS = {"domain": {"web": 3.0, "books": 2.0, "code": 1.0}, "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0}, "source": {"src0": 2.0}}


def domain_of(source: str) -> Column:
    """The domain of a source of the given tables, by its number: code (every fifth), books (three in ten), else web."""
    number = F.coalesce(F.expr(f"try_cast(regexp_extract({source}, '([0-9]+)$', 1) as bigint)"), F.lit(0))
    return F.when(number % 5 == 4, "code").when(number % 10 >= 6, "books").otherwise("web")


def weight_of(level: str, weights: dict[str, dict[str, float]]) -> Column:
    """Weight of a value of a level; 1 where none is given, also for null."""
    out = F.lit(1.0)
    for value, w in weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(float(w))).otherwise(out)
    return out


def shared(nodes: DataFrame, parent: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Add ``budget`` to siblings (columns cap, weight, parent_budget): by weight, no more than ``cap``, what is short going to siblings.

    Siblings are ordered by how soon they are full; those before the first that isn't full get their cap, the rest share what
    remains by weight. The parent has its own cap, so only what all siblings lack went to the parent's siblings before.
    """
    group = Window.partitionBy(*parent)
    ranked = group.orderBy(F.col("cap") / F.col("weight"), *order)
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    after = group.orderBy((F.col("cap") / F.col("weight")).desc(), *[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    rate = (F.col("parent_budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    out = nodes.withColumn("_rate", rate)
    full = F.col("cap") <= F.col("_rate") * F.col("weight")
    # rates fall from the first sibling that isn't full, so the largest of theirs is its
    level = F.max(F.when(~full, F.col("_rate"))).over(group)
    return out.withColumn("_level", level).withColumn(
        "budget", F.when(F.col("_level").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.greatest(F.col("_level"), F.lit(0.0)) * F.col("weight")))).drop("_rate", "_level")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], prefix: str) -> Column:
    same = F.lit(True)
    for c in names:
        same = same & left[c].eqNullSafe(right[prefix + c])
    return same


def budgets(rows: DataFrame, share: float, weights: dict[str, dict[str, float]], epochs: int, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(levels, tokens, budget) of every leaf of ``rows`` (levels, n_tokens): whole tokens, at most ``epochs`` times those it has.

    The target is ``share`` times all tokens. Nothing is taken below a weight that isn't positive.
    """
    leaves = materialise(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    target = float(leaves.agg(F.sum("tokens")).first()[0] or 0) * share
    nodes = leaves.withColumn("cap", (F.col("tokens") * epochs).cast("double"))
    for level in levels:
        nodes = nodes.filter(weight_of(level, weights) > 0)
    known, parent = None, []
    for level in levels:
        path = [*parent, level]
        at = nodes.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", weight_of(level, weights))
        if known is None:
            at = at.withColumn("parent_budget", F.lit(target))
        else:
            up = known.withColumnsRenamed({c: f"_p_{c}" for c in parent}).withColumnRenamed("budget", "parent_budget")
            at = at.join(up, _same(at, up, parent, "_p_")).drop(*[f"_p_{c}" for c in parent])
        known, parent = shared(at, parent, path).select(*path, "budget"), path
    known = known.withColumnsRenamed({c: f"_b_{c}" for c in levels})
    # a hundredth is added before cutting so that sums of parts that make a whole number stay whole
    return leaves.join(known, _same(leaves, known, levels, "_b_"), "left").select(
        *levels, "tokens", F.floor(F.coalesce("budget", F.lit(0.0)) + 0.01).alias("budget"))


def limits(rows: DataFrame, leaves: DataFrame, seed: int = SEED, levels: Sequence[str] = LEVELS) -> DataFrame:
    """(levels, whole, limit) of every leaf that gets anything: its whole epochs and the last place taken in the next one.

    An epoch orders a leaf's documents by their place, a hash of seed, epoch and doc_id; one is taken while the tokens before it
    are below the budget. Slots (leading digits of the place) are counted first: only the slot that a budget ends in is
    put in order, so no leaf, however large, is sorted in one task.
    """
    plan = leaves.filter("tokens > 0 and budget > 0").select(
        *[F.col(c).alias(f"_l_{c}") for c in levels], F.expr("budget div tokens").alias("whole"), (F.col("budget") % F.col("tokens")).alias("_rest"))
    part = plan.filter("_rest > 0")
    mine = rows.join(part, _same(rows, part, levels, "_l_")).select(*levels, "n_tokens", "_rest", place(F.col("whole"), seed).alias("_place"))
    mine = mine.withColumn("_slot", F.substring("_place", 1, SLOT_DIGITS))
    slots = mine.groupBy(*levels, "_slot", "_rest").agg(F.sum("n_tokens").alias("_n"))
    upto = Window.partitionBy(*levels).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0))).filter("_before < _rest")
    last = slots.groupBy(*levels).agg(F.max_by(F.struct("_slot", "_before"), "_slot").alias("s")).select(
        *[F.col(c).alias(f"_c_{c}") for c in levels], F.col("s._slot").alias("_c__slot"), "s._before")
    inside = mine.join(last, _same(mine, last, [*levels, "_slot"], "_c_")).groupBy(*levels, "_rest", "_before", "_place").agg(F.sum("n_tokens").alias("_n"))
    order = Window.partitionBy(*levels).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    taken = inside.withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(order), F.lit(0))).filter("_at < _rest")
    ends = taken.groupBy(*levels).agg(F.max("_place").alias("limit")).withColumnsRenamed({c: f"_e_{c}" for c in levels})
    plan = plan.withColumnsRenamed({f"_l_{c}": c for c in levels})
    return plan.join(ends, _same(plan, ends, levels, "_e_"), "left").select(*levels, "whole", "limit")


def place(epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def selected(docs: DataFrame, ends: DataFrame, seed: int = SEED, levels: Sequence[str] = LEVELS) -> DataFrame:
    """The rows of ``docs`` (doc_id, levels, others), once for each ``epoch`` that takes them. Rows meet only the table of leaves."""
    ends = ends.withColumnsRenamed({c: f"_e_{c}" for c in levels})
    joined = docs.join(ends, _same(docs, ends, levels, "_e_"))
    more = F.when(place(F.col("whole"), seed) <= F.col("limit"), F.array("whole")).otherwise(F.array().cast("array<bigint>"))
    every = F.when(F.col("whole") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("whole") - 1)).otherwise(F.array().cast("array<bigint>"))
    return joined.select(*docs.columns, F.explode(F.concat(every, more)).alias("epoch"))


def with_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens): tokens are words here; null and empty texts have none and are never needed."""
    tokens = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint")
    return docs.select("doc_id", domain_of("source").alias("domain"), "lang", "source", tokens.alias("n_tokens"))


def mixed(docs: DataFrame, share: float = SHARE, epochs: int = EPOCHS, weights: dict[str, dict[str, float]] | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, domain, lang, source, n_tokens, epoch): which documents make up a mix of ``share`` times all tokens.

    Documents of no tokens are taken with what surrounds them in an epoch's order. Null languages and sources are leaves of
    their own. Rows with the same doc_id in a leaf are taken together. Where all leaves together have less than the target,
    all is taken.
    """
    rows = materialise(with_tokens(docs), "mix")
    leaves = materialise(budgets(rows, share, weights or WEIGHTS, epochs), "budgets")
    return selected(rows, materialise(limits(rows, leaves, seed), "limits"), seed)


def op1_mixing(spark, folder):
    return mixed(read(spark, folder, "documents"))


def stage(spark, docs, folder):
    """The rows of ``docs`` that a mix of at most one epoch takes; none is repeated and all columns stay."""
    rows = materialise(with_tokens(docs), "mix")
    leaves = materialise(budgets(rows, SHARE, WEIGHTS, 1), "budgets")
    ends = materialise(limits(rows, leaves), "limits")
    packed = docs.select("doc_id", domain_of("source").alias("domain"), "lang", "source", F.struct(*docs.columns).alias("_row"))
    return selected(packed, ends).select("_row.*")


def _sql() -> str:
    def weight(level):
        arms = "".join(f" WHEN {level} = '{v}' THEN {w}" for v, w in WEIGHTS.get(level, {}).items())
        return f"CASE{arms} ELSE 1.0 END::DOUBLE" if arms else "1.0::DOUBLE"

    parts, parent = [], []
    for level in LEVELS:
        path = [*parent, level]
        on = " AND ".join(f"c.{c} IS NOT DISTINCT FROM p.{c}" for c in parent)
        up = f"JOIN b_{parent[-1]} p ON {on}" if parent else "CROSS JOIN target p"
        group = "PARTITION BY " + ", ".join(parent) if parent else ""
        names = ", ".join(path)
        parts.append(f"""
c_{level} AS (SELECT {names}, sum(tokens * {EPOCHS})::DOUBLE AS cap, {weight(level)} AS weight FROM leaves GROUP BY ALL),
r_{level} AS (SELECT *, (pb - coalesce(sum(cap) OVER ({group} ORDER BY cap / weight, {names} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER ({group} ORDER BY cap / weight, {names} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM (SELECT c.*, p.budget AS pb FROM c_{level} c {up})),
b_{level} AS (SELECT {names}, CASE WHEN lev IS NULL THEN cap ELSE least(cap, greatest(lev, 0) * weight) END AS budget
  FROM (SELECT *, max(CASE WHEN NOT cap <= rate * weight THEN rate END) OVER ({group}) AS lev FROM r_{level})),""")
        parent = path
    names = ", ".join(LEVELS)
    on = " AND ".join(f"d.{c} IS NOT DISTINCT FROM l.{c}" for c in LEVELS)
    return rf"""
WITH d AS (SELECT doc_id, CASE WHEN n % 5 = 4 THEN 'code' WHEN n % 10 >= 6 THEN 'books' ELSE 'web' END AS domain, lang, source, n_tokens
  FROM (SELECT *, coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT), 0) AS n,
    len(regexp_extract_all(coalesce(text, ''), '[^ 	-]+'))::BIGINT AS n_tokens FROM documents)),
leaves AS (SELECT {names}, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
target AS (SELECT sum(tokens)::DOUBLE * {SHARE} AS budget FROM leaves),{"".join(parts)}
l AS (SELECT leaves.*, floor(budget + 0.01)::BIGINT AS budget FROM leaves JOIN b_{LEVELS[-1]} b ON {on.replace('d.', 'leaves.').replace('l.', 'b.')} WHERE tokens > 0),
e AS (SELECT d.*, (budget // tokens)::BIGINT AS whole, (budget % tokens)::BIGINT AS rest FROM d JOIN l ON {on} WHERE budget > 0),
o AS (SELECT *, md5('{SEED}:' || whole::VARCHAR || ':' || coalesce(doc_id::VARCHAR, '')) AS place FROM e),
q AS (SELECT {names}, place, sum(n_tokens) AS n FROM o GROUP BY ALL),
s AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY {names} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM q)
SELECT doc_id, {names}, n_tokens, epoch FROM (SELECT doc_id, {names}, n_tokens, unnest(range(whole)) AS epoch FROM o)
UNION ALL SELECT d.doc_id, {", ".join("d." + c for c in LEVELS)}, n_tokens, whole AS epoch FROM o d JOIN s l ON {on} AND d.place = l.place WHERE before < rest"""


SQL = _sql()
