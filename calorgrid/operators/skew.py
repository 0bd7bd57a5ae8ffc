"""Results per key where a few keys hold most rows.

Heavy keys are found with a mergeable frequent-items sketch and counted exactly; their rows are spread by a salt, marked
by a broadcast join with the list of heavy keys (at most 1/share of them). All other keys take the ordinary shuffle; the
results are united by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.session import checkpointed

_SEP = "\x1f"


def _joined(keys: list[str]) -> Column:
    return F.concat_ws(_SEP, *keys)


def heavy_keys(rows: DataFrame, keys: list[str], share: float, tracked: int = 16384) -> DataFrame:
    """``keys..., n`` of the keys that hold at least ``share`` of all rows in which every key column is present.

    A sketch of ``tracked`` counters, whose counts are wrong by at most 3.5/tracked of the rows, names the candidates;
    one more pass with the candidates broadcast (at most 2/share) counts them exactly. At most 1/share keys come out,
    none of an empty table; a key at exactly ``share`` does."""
    if not 8.0 / tracked < share <= 1:
        raise ValueError("share must be above 8/tracked and at most 1")
    whole = rows.select(*keys).dropna("any", subset=keys).withColumn("_key", _joined(keys))
    most = int(2 / share) + 1
    sketch = whole.agg(F.count("*").alias("_total"), F.expr(f"approx_top_k(_key, {most}, {tracked})").alias("_top"))
    candidates = sketch.select("_total", F.inline("_top")).where(F.col("count") >= F.lit(share / 2) * F.col("_total")).select("_total", F.col("item").alias("_key"))
    counted = whole.join(F.broadcast(candidates), "_key").groupBy(*keys).agg(F.count("*").alias("n"), F.first("_total").alias("_total"))
    return counted.where(F.col("n") >= F.lit(share) * F.col("_total")).select(*keys, "n")


def per_key(rows: DataFrame, keys: list[str], measure: str, ident: str, heavy: DataFrame, worst: int = 3, salts: int = 256) -> DataFrame:
    """``keys..., n, n_value, mean_value, max_value, worst``: one row per key; ``worst`` has the ids of its largest values.

    NaN, infinities and null are no values, null keys are keys of their own, ties in ``worst`` go to the smaller id. Rows of
    ``heavy`` keys (see ``heavy_keys``), told by a broadcast join (at most 1/share keys, written once), are spread by a salt,
    a hash of the id, and reduced by (key, salt) first, so that no task gets a whole heavy key; rows of all other keys are
    reduced by key in the same plan, and both united by key. Sums are combined, and of each key's values only the
    ``worst`` largest kept, before the shuffle. Two scans: for the sums, and for the largest. No rows give no rows."""
    value = F.when(F.abs(F.col(measure)) < F.lit(float("inf")), F.col(measure) + F.lit(0.0))
    base = rows.select(*keys, F.col(ident).alias("_id"), value.alias("_v"), _joined(keys).alias("_key"))
    whole = F.lit(True)
    for k in keys:
        whole &= F.col(k).isNotNull()
    marks = checkpointed(heavy.select(_joined(keys).alias("_key"))).select("_key", F.lit(True).alias("_heavy"))
    salt = F.when(F.col("_heavy") & whole, F.pmod(F.xxhash64("_id"), F.lit(salts))).otherwise(-1)
    salted = base.join(F.broadcast(marks), "_key", "left").select(*keys, "_id", "_v", salt.alias("_salt"))
    parts = salted.groupBy(*keys, "_salt").agg(F.count("*").alias("n"), F.count("_v").alias("n_value"), F.sum("_v").alias("_s"), F.max("_v").alias("max_value"))
    first = _ranked(salted.where("_v is not null"), [*keys, "_salt"], worst)
    best = first.groupBy(*keys, "_salt").agg(F.collect_list(F.struct((-F.col("_v")).alias("m"), F.col("_id").isNull().alias("u"), "_id")).alias("_top"))
    # both are of one row a (key, salt)
    both = parts.unionByName(best, allowMissingColumns=True).groupBy(*keys)
    sums = both.agg(*[F.sum(c).alias(c) for c in ("n", "n_value", "_s")], F.max("max_value").alias("max_value"), F.array_sort(F.flatten(F.collect_list("_top"))).alias("_top"))
    ids = F.transform(F.slice("_top", 1, worst), lambda x: x["_id"])
    return sums.select(*keys, "n", "n_value", (F.col("_s") / F.col("n_value")).alias("mean_value"), "max_value", ids.alias("worst"))


def _ranked(rows: DataFrame, by: list[str], worst: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("_v"), F.asc_nulls_last("_id"))
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= worst).drop("_r")
