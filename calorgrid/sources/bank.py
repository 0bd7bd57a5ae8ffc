"""A bank of descriptors that is made once, kept as parquet, and made anew when its frames change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.numeric import standardised
from calorgrid.operators import raster
from calorgrid.sources.sinks import _folder


def descriptors(frames: DataFrame, ident: str, values: str, width: int, height: int, small: tuple[int, int]) -> DataFrame:
    """``ident, descriptor``: rasters averaged down to ``small`` (width, height), then standardised; null where there is none."""
    coarse = raster.mapped(frames.select(ident, values), values, width, height, lambda a: raster.area_resize(a, *small), "_small")
    return coarse.select(ident, F.when(F.col("_small").isNotNull(), standardised(F.col("_small"))).alias("descriptor"))


def cached_bank(frames: DataFrame, path: str, make) -> DataFrame:
    """``make(frames)``, read from ``path`` if what lies there has as many rows as ``frames``, else made and written there."""
    spark = frames.sparkSession
    hadoop, fs = _folder(spark, path)
    if fs.exists(hadoop):
        bank = spark.read.parquet(path)
        if bank.count() == frames.count():
            return bank
    make(frames).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
