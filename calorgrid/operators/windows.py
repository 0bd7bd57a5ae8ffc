"""Ordered and peer-group computations: peer medians, runs, round-robin and stride picks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.session import SMALL_BYTES, checkpointed, estimated_bytes

#: rows of a group that one task looks at for runs
_STRETCH = 100_000


def with_peer_median(rows: DataFrame, by: Sequence[str], value: str, counted: Column | None = None, least: int = 2, name: str = "peer") -> DataFrame:
    """``rows`` with the median of their group; null with fewer than ``least`` peers. Only ``counted`` rows are peers.

    Groups are the boxes of one class in one frame; the median is joined, so nothing is buffered row by row."""
    peer = F.col(value) if counted is None else F.when(counted, F.col(value))
    middle = rows.groupBy(*by).agg(F.median(peer).alias("_m"), F.count(peer).alias("_k"))
    on = F.lit(True)
    for c in by:
        on &= F.col(f"r.{c}").eqNullSafe(F.col(f"m.{c}"))
    out = rows.alias("r").join(middle.alias("m"), on, "left")
    return out.select("r.*", F.when(F.col("m._k") >= least, F.col("m._m")).alias(name))


def run_lengths(rows: DataFrame, by: Sequence[str], order: Sequence[str], hot: Column) -> DataFrame:
    """``by..., run, length``: stretches of successive rows for which ``hot`` holds (null doesn't); ``run`` is the place of the
    first row in its group, from 1.

    Rows are ``numbered`` by range partitions, so a group of any size is spread. Within a partition runs are islands of
    successive places; a run that goes on in the next one is sewn to it: only each group's islands of a partition, at most
    as many as it has runs there, meet by their ends."""
    placed = numbered(rows.withColumn("_hot", F.coalesce(hot, F.lit(False))), by, [F.col(c) for c in order], "_i")
    if estimated_bytes(rows) < SMALL_BYTES:  # one stretch a group
        marked = placed.where("_hot").withColumn("_g", F.col("_i") - F.row_number().over(Window.partitionBy(*by).orderBy("_i")))
        return marked.groupBy(*by, "_g").agg((F.min("_i") + 1).alias("run"), F.count("*").alias("length")).drop("_g")
    part = placed.select(*by, "_i", "_hot").withColumn("_part", F.floor(F.col("_i") / _STRETCH))
    w = Window.partitionBy(*by, "_part").orderBy("_i")
    marked = part.where("_hot").withColumn("_g", F.col("_i") - F.row_number().over(w))
    islands = marked.groupBy(*by, "_part", "_g").agg(F.min("_i").alias("_a"), F.max("_i").alias("_b"))
    # an island that neither begins nor ends its stretch is a run; of the others there are two a stretch at most
    whole = (F.col("_a") % _STRETCH != 0) & (F.col("_b") % _STRETCH != _STRETCH - 1)
    v = Window.partitionBy(*by).orderBy("_a")
    edges = islands.where(~whole).withColumn("_new", F.when(F.lag("_b").over(v) == F.col("_a") - 1, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(v))
    sewn = edges.groupBy(*by, "_run").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b")).drop("_run")
    runs = islands.where(whole).select(*by, "_a", "_b").unionByName(sewn)
    return runs.select(*by, (F.col("_a") + 1).alias("run"), (F.col("_b") - F.col("_a") + 1).alias("length"))


def round_robin(rows: DataFrame, panel: str, date: str, order: Sequence[Column], quota: int, always: Column | None = None) -> DataFrame:
    """Up to ``quota`` rows of each panel, dealt over its dates in turn; ``always`` rows come first and raise the quota to fit.

    Rows beyond the quota-th of their date can't be dealt and are dropped before anything is gathered by panel."""
    kept = F.coalesce(always, F.lit(False)) if always is not None else F.lit(False)
    marked = rows.withColumn("_first", F.when(kept, 0).otherwise(1))
    w = Window.partitionBy(panel, date, "_first").orderBy(*order)
    v = Window.partitionBy(panel).orderBy("_first", "_round", date)
    others = marked.where("_first = 1").withColumn("_round", F.row_number().over(w)).where(F.col("_round") <= quota)
    dealt = marked.where("_first = 0").withColumn("_round", F.row_number().over(w)).unionByName(others).withColumn("pick", F.row_number().over(v))
    return dealt.where((F.col("pick") <= quota) | (F.col("_first") == 0)).drop("_first", "_round")


def numbered(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "i") -> DataFrame:
    """``rows`` with their place in their group's order, from 0; null groups are groups.

    Rows are range-partitioned by (group, order) and written to the checkpoint folder, so a group of any size is spread;
    a row's place is its position in the whole less that of its group's first row. Ties need a last key to be settled."""
    keep = [c for c in rows.columns if c != name]
    if estimated_bytes(rows) < SMALL_BYTES:  # such a group fits into a task
        w = Window.partitionBy(*(by or [F.lit("all")])).orderBy(*order)
        return rows.withColumn(name, (F.row_number().over(w) - 1).cast("long")).select(*keep, name)
    keys = [*[F.col(c) for c in by], *order]
    spread = checkpointed(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)).withColumn("_id", F.monotonically_increasing_id())
    spread = spread.withColumn("_part", F.call_function("shiftright", "_id", F.lit(33)))
    parts = spread.groupBy("_part").agg((F.max("_id") - F.min("_id") + 1).alias("_n"), F.min("_id").alias("_least"))
    before = Window.partitionBy(F.lit("all")).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_least")).alias("_shift"))  # one row a partition
    placed = spread.join(F.broadcast(starts), "_part").withColumn("_g", F.col("_id") + F.col("_shift"))
    if not by:
        return placed.withColumn(name, F.col("_g")).select(*[c for c in rows.columns if c != name], name)
    first = placed.groupBy(*by).agg(F.min("_g").alias("_f")).alias("f")
    on = F.lit(True)
    for c in by:
        on &= F.col(f"r.{c}").eqNullSafe(F.col(f"f.{c}"))
    return placed.alias("r").join(first, on).select(*[F.col(f"r.{c}") for c in rows.columns if c != name], (F.col("r._g") - F.col("f._f")).alias(name))


def stride(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str], step: int, limit: int | None = None) -> DataFrame:
    """Every ``step``-th row of each group, up to ``limit``."""
    out = numbered(rows, by, order, "_i").where(F.col("_i") % step == 0)
    return (out if limit is None else out.where(F.col("_i") < step * limit)).drop("_i")


def middle_member(rows: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The upper middle row of each group."""
    sizes = rows.groupBy(*by).agg(F.count("*").alias("_n")).alias("s")
    on = F.lit(True)
    for c in by:
        on &= F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}"))
    out = numbered(rows, by, order, "_i").alias("r").join(sizes, on)
    return out.where(F.col("r._i") == F.floor(F.col("s._n") / 2)).select(*[F.col(f"r.{c}") for c in rows.columns])
