"""Exact percentiles of groups of any size, without a task that sees a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.session import SMALL_BYTES, checkpointed, estimated_bytes

_CELLS = 4096
#: keys as text and back: nulls are told, times keep their microseconds
_JSON = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def exact_medians(rows: DataFrame, keys: list[str], value: str, most_rows: int = 20000) -> DataFrame:
    """``keys..., n, median`` (the mean of the two middle values where n is even): see ``exact_quantiles``."""
    return exact_quantiles(rows, keys, value, {"median": 0.5}, most_rows)


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float], most_rows: int = 20000) -> DataFrame:
    """``keys..., n`` and a column for each share: its exact percentile, interpolated between the two nearest ranks, of keys
    with any number of rows.

    The range of a rank is cut into cells, the cells are counted, and the cell that holds it is the next range, until at
    most ``most_rows`` rows or one distinct value are left. Null and NaN values are left out; a key without values gives
    no row, null keys are keys. The table of ranges, two rows a key and share, is broadcast: the caller bounds the number of
    keys."""
    data = rows.select(F.struct(*[F.col(k) for k in keys]).alias("_key"), F.to_json(F.struct(*[F.col(k) for k in keys]), _JSON).alias("_id"), F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    at = [F.lit(float(q)) * (F.col("n") - 1) for q in shares.values()]
    ranks = F.array_distinct(F.array(*[r.cast("long") for x in at for r in (F.floor(x), F.ceil(x))]))
    ranges = (
        data.groupBy("_id")
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .withColumn("rank", F.explode(ranks))
        .select("_id", "n", "rank", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("held"))
    )
    ranges = checkpointed(ranges)
    wide = (F.col("held") > most_rows) & (F.col("lo") < F.col("hi"))
    w = Window.partitionBy("_id", "rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    while ranges.where(wide).limit(1).count():
        inside = data.join(F.broadcast(ranges.where(wide)), "_id").where("v between lo and hi")
        cell = F.least(F.floor((F.col("v") / _CELLS - F.col("lo") / _CELLS) / (F.col("hi") / _CELLS - F.col("lo") / _CELLS) * _CELLS), F.lit(_CELLS - 1))
        cells = inside.groupBy("_id", "n", "rank", "below", cell.alias("cell")).agg(F.count("*").alias("held"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        cells = cells.withColumn("below", F.col("below") + F.coalesce(F.sum("held").over(w), F.lit(0)))
        chosen = cells.where("below <= rank and rank < below + held").select(*ranges.columns)
        ranges = checkpointed(ranges.where(~wide).unionByName(chosen))
    single = ranges.where("lo = hi").select("_id", "n", "rank", F.col("lo").alias("m"))
    picked = (
        data.join(F.broadcast(ranges.where("lo < hi")), "_id")
        .where("v between lo and hi")
        .groupBy("_id", "n", "rank", "below")
        .agg(F.sort_array(F.collect_list("v")).alias("vs"))
        .select("_id", "n", "rank", F.get("vs", (F.col("rank") - F.col("below")).cast("int")).alias("m"))
    )
    found = single.unionByName(picked).groupBy("_id", "n").agg(F.map_from_entries(F.collect_list(F.struct("rank", "m"))).alias("_m"))
    value_at = lambda r: F.element_at("_m", r.cast("long"))
    out = [(value_at(F.floor(x)) + (value_at(F.ceil(x)) - value_at(F.floor(x))) * (x - F.floor(x))).alias(name) for name, x in zip(shares, at, strict=True)]
    kind = data.schema["_key"].dataType.simpleString()
    return found.select(F.from_json("_id", kind, _JSON).alias("_key"), "n", *out).select("_key.*", "n", *[F.col(f"`{name}`") for name in shares])


def quantiles(rows: DataFrame, keys: list[str], value: str, shares: dict[str, float], most_rows: int = 1_000_000, most_heavy: int = 10_000) -> DataFrame:
    """``keys...`` and a column for each share: its exact interpolated percentile (null for a key without values, NaN left out).

    A key's distinct values are gathered in one task only up to ``most_rows`` rows; keys of more rows, of which the rows
    bound the number (more than ``most_heavy`` is an error: raise ``most_rows``), go by ``exact_quantiles``. Counting the
    keys reads no other column, and is left out for inputs of a few megabytes, which one task may hold."""
    plain = [F.percentile(F.when(~F.isnan(value), F.col(value)), q).alias(name) for name, q in shares.items()]
    if estimated_bytes(rows) < SMALL_BYTES:
        return rows.groupBy(*keys).agg(*plain)
    ids = F.to_json(F.struct(*[F.col(k) for k in keys]), _JSON)
    tall = [r[0] for r in rows.groupBy(ids.alias("_id")).agg(F.count("*").alias("n")).where(F.col("n") > most_rows).limit(most_heavy + 1).collect()]
    if not tall:
        return rows.groupBy(*keys).agg(*plain)
    if len(tall) > most_heavy:
        raise ValueError("too many keys with many rows")
    known = F.broadcast(rows.sparkSession.createDataFrame([(x,) for x in tall], "_id string"))
    marked = rows.withColumn("_id", ids)
    light = marked.join(known, "_id", "left_anti").groupBy(*keys).agg(*plain)
    heavy = exact_quantiles(marked.join(known, "_id", "left_semi"), keys, value, shares)
    empty = marked.join(known, "_id", "left_semi").groupBy(*keys).agg(F.max(F.when(~F.isnan(value), F.col(value))).alias("_any")).where("_any is null").drop("_any")
    return light.unionByName(heavy.drop("n")).unionByName(empty, allowMissingColumns=True)
