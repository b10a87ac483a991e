"""Row-wise operators: filters, recoding, clean-up, derived columns, keyed update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightledger.functions.geometry import box_area

BOX_COLUMNS = ["xmin", "ymin", "xmax", "ymax"]
NO_TEXT = "[NO TEXT]"


def scan_boxes(df: DataFrame, mode: str) -> DataFrame:
    """``train``: all four coordinates present. ``predict``: any missing."""
    if mode == "train":
        cond = F.lit(True)
        for c in BOX_COLUMNS:
            cond = cond & F.col(c).isNotNull()
        return df.filter(cond)
    if mode == "predict":
        cond = F.lit(False)
        for c in BOX_COLUMNS:
            cond = cond | F.col(c).isNull()
        return df.filter(cond)
    raise ValueError(f"mode must be train or predict, not {mode!r}")


def retain_recent(df: DataFrame, time_column: str, as_of: Column, seconds: int = 86_400) -> DataFrame:
    """Rows not yet expired: newer than ``as_of`` minus the time to live."""
    return df.filter(F.col(time_column) > as_of - F.expr(f"INTERVAL {int(seconds)} SECONDS"))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def drop_empty_boxes(df: DataFrame) -> DataFrame:
    cond = F.lit(True)
    for c in BOX_COLUMNS:
        cond = cond & (F.col(c) == 0)
    return df.filter(~cond)


def readable_text(c: Column) -> Column:
    return c.isNotNull() & (c != NO_TEXT)


def indicator(cond: Column) -> Column:
    """1 where true, 0 where false or unknown."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def timing_class(days: Column) -> Column:
    """-1 is the 'none' marker; otherwise negative, below thirty, or later."""
    return F.when(days == -1, 0).when(days < 0, 1).when(days < 30, 2).otherwise(3)


def right_closed_bins(c: Column, edges: Sequence[float | Column], labels: Sequence[str]) -> Column:
    """Label of the interval (edge[i], edge[i+1]] holding the value; NULL outside."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    edges = [e if isinstance(e, Column) else F.lit(float(e)) for e in edges]
    out = F.when(c <= edges[0], None)
    for upper, label in zip(edges[1:], labels):
        out = out.when(c <= upper, label)
    return out


def recode(c: Column, mapping: dict, default=None) -> Column:
    """Dictionary lookup inside the projection; unmapped values give ``default``."""
    pairs = [F.lit(v) for kv in mapping.items() for v in kv]
    found = F.try_element_at(F.create_map(*pairs), c)
    return found if default is None else F.coalesce(found, F.lit(default))


def money_shares(amount: Column) -> dict[str, Column]:
    """Commission (2 %) and tax (9 %) in whole units, and the sum of the three."""
    commission = F.floor(amount * 2 / 100).cast("bigint")
    vat = F.floor(amount * 9 / 100).cast("bigint")
    return {"commission_amount": commission, "vat_amount": vat, "total_amount": amount + commission + vat}


def box_features(df: DataFrame) -> DataFrame:
    width, height = F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")
    return df.withColumns({
        "bbox_width": width, "bbox_height": height, "bbox_area": box_area(),
        "aspect_ratio": F.try_divide(width, height),
        "area_fraction": F.try_divide(box_area(), F.col("width") * F.col("height")),
        "center_x_norm": F.try_divide((F.col("xmin") + F.col("xmax")) / 2, F.col("width")),
        "center_y_norm": F.try_divide((F.col("ymin") + F.col("ymax")) / 2, F.col("height")),
        "margin_left": F.col("xmin"), "margin_top": F.col("ymin"),
        "margin_right": F.col("width") - F.col("xmax"), "margin_bottom": F.col("height") - F.col("ymax"),
    })


def rescale_boxes(df: DataFrame, grid: int = 224) -> DataFrame:
    return df.withColumns({c: F.col(c) / (F.col("width" if c[0] == "x" else "height") / grid) for c in BOX_COLUMNS})


def clip(c: Column, lower, upper) -> Column:
    lower, upper = (v if isinstance(v, Column) else F.lit(v) for v in (lower, upper))
    return F.when(c.isNotNull(), F.greatest(F.least(c, upper), lower))


def body_mass_index(weight: Column, height_cm: Column) -> Column:
    return F.try_divide(weight, F.pow(height_cm / 100, F.lit(2)))


def keyed_update(df: DataFrame, changes: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Set ``columns`` of the rows whose key occurs in ``changes``; other rows are kept.

    ``changes`` must hold one row per key. A column missing from ``df`` is added.
    """
    base = add_missing_columns(df, {c: changes.schema[c].dataType.simpleString() for c in columns})
    new = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(new, list(keys), "left")
    return joined.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).select(*base.columns)


def add_missing_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns})


def portable_hash(key: Column, seed: int = 42) -> Column:
    """Hash in [0, 2^32) of a key of any type and sign, which any SQL engine repeats: the first 32 bits of md5("seed:key").

    A null key hashes as an empty text.
    """
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement; the same rows for the same seed under any partitioning."""
    return df.orderBy(portable_hash(F.col(key), seed), key).limit(n)
