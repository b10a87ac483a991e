"""Image rows to tables: pixels, grey values, blur scores and corpus statistics.

Functions take a frame with an ``image`` struct column as the built-in image source gives it
(origin, height, width, nChannels, mode, data; colour bytes in blue-green-red order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.operators.aggregates import exact_quantiles

GREY_WEIGHTS = (0.2989, 0.5870, 0.1140)  # fixed values: red, green, blue
BLUR_THRESHOLD = 100.0  # fixed value: a lower Laplacian variance counts as blurry

_FLAT = ["origin", "height", "width", "nChannels", "data"]


def image_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"image.{c}").alias(c) for c in _FLAT])


def _channels(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """(height, width, 3) red, green, blue."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(a, 3, axis=2) if channels == 1 else a[:, :, 2::-1]


def pixels(df: DataFrame) -> DataFrame:
    """One row per pixel with its colours (0..255) and relative position."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                rgb = _channels(r.data, r.height, r.width, r.nChannels).reshape(-1, 3).astype(np.int32)
                y, x = np.divmod(np.arange(r.height * r.width, dtype=np.int32), r.width)
                yield pd.DataFrame({"origin": r.origin, "x": x, "y": y, "r": rgb[:, 0], "g": rgb[:, 1], "b": rgb[:, 2],
                                    "pos_x": x / r.width, "pos_y": y / r.height})

    return image_columns(df).mapInPandas(
        run, "origin string, x int, y int, r int, g int, b int, pos_x double, pos_y double")


def with_grey(px: DataFrame) -> DataFrame:
    """Grey value 0..255 and the colours scaled to 0..1."""
    r, g, b = (w * F.col(c) for w, c in zip(GREY_WEIGHTS, ("r", "g", "b")))
    return px.withColumn("grey", r + g + b).withColumns({f"{c}01": F.col(c) / 255.0 for c in ("r", "g", "b")})


def _laplacian(grey: np.ndarray) -> np.ndarray:
    mirror = np.pad(grey, 1, mode="reflect" if min(grey.shape) > 1 else "edge")
    return mirror[:-2, 1:-1] + mirror[2:, 1:-1] + mirror[1:-1, :-2] + mirror[1:-1, 2:] - 4 * grey


def blur_scores(df: DataFrame, threshold: float = BLUR_THRESHOLD) -> DataFrame:
    """Variance of the Laplacian of the grey image, blur flag and noise (deviation of grey)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            greys = [_channels(r.data, r.height, r.width, r.nChannels) @ np.array(GREY_WEIGHTS) for r in batch.itertuples(index=False)]
            yield pd.DataFrame({"origin": batch["origin"], "width": batch["width"], "height": batch["height"],
                                "blur_score": [float(_laplacian(g).var()) for g in greys],
                                "noise": [float(g.std()) for g in greys]})

    scored = image_columns(df).mapInPandas(run, "origin string, width int, height int, blur_score double, noise double")
    return scored.withColumn("is_blurry", (F.col("blur_score") < threshold).cast("int"))


def blur_summary(scores: DataFrame) -> DataFrame:
    """Share blurry, mean, exact median and sample deviation of the scores, one row."""
    base = scores.agg(F.count("*").alias("n"), F.avg("is_blurry").alias("share_blurry"), F.avg("blur_score").alias("mean"),
                      F.stddev_samp("blur_score").alias("std"))
    median = exact_quantiles(scores, "blur_score", {"median": 0.5}).scalar()
    return base.withColumn("median", median)


def mean_crop_size(boxes: DataFrame) -> DataFrame:
    """Whole-number mean width and height of the boxes."""
    return boxes.agg(F.avg(F.col("xmax") - F.col("xmin")).cast("int").alias("crop_width"),
                     F.avg(F.col("ymax") - F.col("ymin")).cast("int").alias("crop_height"))
