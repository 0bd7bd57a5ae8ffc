"""Filling fixed-capacity containers: minimum bin slack over the histogram of lengths.

Items of one length are alike, so containers are planned on the counts of lengths, of which there are at most
``capacity``; only the items' places in the plan are found on the data. Each container begins with the longest length
left; a bitset of reachable sums, built length by length, gives the multiset of remaining lengths that fills the rest
best, its counts are backtracked, and the pattern is repeated as often as the counts allow.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.session import checkpointed


def fullest(lengths: Sequence[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, how many) that fill ``room`` best, from lengths in falling order; longer lengths are used first."""
    if room <= 0:
        return []
    bits, mask = 1, (1 << (room + 1)) - 1
    steps: list[tuple[int, int]] = []
    for n in lengths:
        most = min(counts[n], room // n)
        if most <= 0:
            continue
        steps.append((n, bits))
        left, chunk = most, 1
        while left:  # 1, 2, 4, ... copies and the rest give every number of copies
            take = min(chunk, left)
            bits |= bits << (n * take) & mask
            left -= take
            chunk *= 2
        if bits >> room & 1:
            break
    at, out = bits.bit_length() - 1, []
    for n, before in reversed(steps):
        k = 0
        while not before >> at & 1:
            at -= n
            k += 1
        if k:
            out.append((n, k))
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(containers, [(length, how many in each)]) for items of 1 to ``capacity``; every item has its place."""
    counts = {n: c for n, c in counts.items() if c > 0}
    order = sorted(counts, reverse=True)
    out = []
    while order:
        seed = order[0]
        counts[seed] -= 1
        room = capacity - seed
        inside = [n for n in order if n <= room] if room else []
        pattern = dict(fullest(inside, counts, room))
        counts[seed] += 1
        pattern[seed] = pattern.get(seed, 0) + 1
        times = min(counts[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            counts[n] -= k * times
        order = [n for n in order if counts[n]]
        out.append((times, sorted(pattern.items(), reverse=True)))
    return out


def pack(items: DataFrame, key: str, size: str, capacities: Sequence[int], bucket_rows: int = 500_000) -> DataFrame:
    """``capacity, container, key, piece, start, size`` for every item and capacity.

    An item beyond the capacity is cut into full pieces and a rest, no other is cut; ``start`` is where a piece begins.
    Containers count from 0. An item of size 0 (or null) takes no room and lies in container 0. Equal sizes and repeated
    keys are items of their own; no items give no rows. Ranks within a length are taken by (length, hash bucket of the
    key), so a length that most items share is spread; the histogram and the plan are bounded by the capacity."""
    caps = sorted({int(c) for c in capacities})
    if not caps or caps[0] < 1:
        raise ValueError("capacities must be positive")
    each = items.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("n"))
    each = each.withColumn("capacity", F.explode(F.array(*[F.lit(c) for c in caps])))
    pieces = each.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(F.expr("cast((n + capacity - 1) div capacity as int)") - 1, F.lit(0)))))
    pieces = pieces.select("capacity", "key", "piece", F.least(F.col("n") - F.col("piece").cast("long") * F.col("capacity"), F.col("capacity")).cast("int").alias("size"))
    lengths = checkpointed(pieces.where("size > 0").groupBy("capacity", "size").agg(F.count("*").alias("n")))

    def plans(pdf: pd.DataFrame) -> pd.DataFrame:
        cap, rows, base, used = int(pdf["capacity"].iloc[0]), [], 0, {}
        for times, pattern in plan(dict(zip(pdf["size"].tolist(), pdf["n"].tolist(), strict=True)), cap):
            for n, k in pattern:
                rows.append((cap, n, used.get(n, 0), k, base))
                used[n] = used.get(n, 0) + k * times
            base += times
        return pd.DataFrame(rows, columns=["capacity", "size", "first", "each", "base"])

    # each capacity's plan is a task of its own, as far as their hashes differ
    table = lengths.repartition(4 * len(caps), "capacity").groupBy("capacity").applyInPandas(plans, "capacity int, size int, first long, each long, base long").toPandas()
    # sorted by (capacity, size) and first rank, to look places up by bisection
    table = table.sort_values(["capacity", "size", "first"], ignore_index=True)
    wide = max(caps) + 1
    slot = {c: i for i, c in enumerate(caps)}
    starts = (table["capacity"].map(slot).to_numpy(dtype=np.int64) * wide + table["size"].to_numpy(dtype=np.int64)) if len(table) else np.zeros(0, np.int64)
    first, per, base = (table[c].to_numpy(dtype=np.int64) for c in ("first", "each", "base"))

    most = lengths.agg(F.max("n")).first()[0] or 0
    buckets = max(16, -(-int(most) // bucket_rows))
    spread = pieces.withColumn("bucket", F.pmod(F.xxhash64("key", "piece"), F.lit(buckets)))
    by = ["capacity", "size", "bucket"]
    before = Window.partitionBy("capacity", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spread.where("size > 0").groupBy(*by).agg(F.count("*").alias("m")).withColumn("offset", F.coalesce(F.sum("m").over(before), F.lit(0))).drop("m")
    ranked = (
        spread.where("size > 0")
        .withColumn("r", F.row_number().over(Window.partitionBy(*by).orderBy("key", "piece")))
        .join(offsets, by)
        .select("capacity", "key", "piece", "size", (F.col("offset") + F.col("r") - 1).alias("rank"))
    )

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank = pdf["rank"].to_numpy(dtype=np.int64)
            which = pdf["capacity"].map(slot).to_numpy(dtype=np.int64) * wide + pdf["size"].to_numpy(dtype=np.int64)
            at = np.zeros(len(pdf), dtype=np.int64)
            order = np.argsort(which, kind="stable")
            kinds, begin = np.unique(which[order], return_index=True)
            for k, rows in zip(kinds, np.split(order, begin[1:]), strict=True):
                lo, hi = np.searchsorted(starts, k, "left"), np.searchsorted(starts, k, "right")
                at[rows] = lo + np.searchsorted(first[lo:hi], rank[rows], side="right") - 1
            yield pdf.drop(columns="rank").assign(container=base[at] + (rank - first[at]) // per[at])

    kind = dict(each.dtypes)["key"]
    placed = ranked.mapInPandas(place, f"capacity int, key {kind}, piece int, size int, container long")
    empty = pieces.where("size = 0").select("capacity", "key", "piece", "size", F.lit(0).cast("long").alias("container"))
    return placed.unionByName(empty).select(
        "capacity", "container", F.col("key").alias(key), "piece", (F.col("piece").cast("long") * F.col("capacity")).alias("start"), "size"
    )


def fill(packed: DataFrame) -> DataFrame:
    """``capacity, containers, items, used, slack`` of a packing; slack is the unused share of all containers."""
    each = packed.groupBy("capacity", "container").agg(F.sum("size").alias("used"), F.count("*").alias("items"))
    sums = each.groupBy("capacity").agg(F.count("*").alias("containers"), F.sum("items").alias("items"), F.sum("used").alias("used"))
    return sums.withColumn("slack", F.round(1 - F.col("used") / (F.col("containers") * F.col("capacity")), 6))
