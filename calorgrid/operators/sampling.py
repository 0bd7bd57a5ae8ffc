"""Samples and splits: seeded picks per group, folds, balanced validation sets, assignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.operators.windows import numbered


def shuffled(*key: str, seed: int = 0) -> Column:
    """Order of a seeded shuffle that doesn't depend on partitions: a hash of key and seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key], F.lit(str(seed))))


def per_group(rows: DataFrame, by: Sequence[str], key: Sequence[str], k: int, seed: int = 0) -> DataFrame:
    """``k`` rows of each group, by seeded hash."""
    w = Window.partitionBy(*by).orderBy(shuffled(*key, seed=seed), *key)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def all_rare_and_some_common(rows: DataFrame, rare: Column, key: str, k: int, seed: int = 0) -> DataFrame:
    """Every row for which ``rare`` holds and ``k`` of the others."""
    some = rows.where(~F.coalesce(rare, F.lit(False))).orderBy(shuffled(key, seed=seed), key).limit(k)
    return rows.where(rare).unionByName(some)


def following_owners(rows: DataFrame, owner: str) -> DataFrame:
    """``owner, next``: each owner with the next in order, the last with the first; one row an owner."""
    owners = rows.where(F.col(owner).isNotNull()).select(owner).distinct()
    every = Window.partitionBy(F.lit("all"))
    return owners.select(owner, F.coalesce(F.lead(owner).over(every.orderBy(owner)), F.min(owner).over(every)).alias("next"))


def cross_review(rows: DataFrame, owner: str, key: str, following: dict[str, str] | DataFrame, share: float = 0.1, seed: int = 0) -> DataFrame:
    """``rows`` as ``own``, and max(1, round half to even of share) of each owner's again, as ``cross``, for the next owner.
    ``following`` tells it: a short dictionary, or a table ``owner, next`` of any size."""
    ranked = numbered(rows.withColumn("_h", shuffled(key, seed=seed)), [owner], [F.col("_h"), F.col(key)], "_i").drop("_h").alias("r")
    sizes = rows.groupBy(owner).agg(F.count("*").alias("_n")).alias("s")
    picked = ranked.join(sizes, F.col(f"r.{owner}").eqNullSafe(F.col(f"s.{owner}"))).where(F.col("_i") < F.greatest(F.lit(1.0), F.rint(F.col("_n") * share)))
    cross = picked.select(*[F.col(f"r.{c}") for c in rows.columns])
    if isinstance(following, DataFrame):
        cross = cross.join(following.select(owner, F.col("next").alias("_next")), owner, "left").withColumn(owner, F.col("_next")).drop("_next")
    else:
        to = F.create_map(*[F.lit(x) for kv in following.items() for x in kv])
        cross = cross.withColumn(owner, F.try_element_at(to, F.col(owner)))
    return rows.withColumn("role", F.lit("own")).unionByName(cross.withColumn("role", F.lit("cross")))


def fold_splits(rows: DataFrame, session: str) -> DataFrame:
    """``session, fold, split`` of every pair of sessions: the folds without the rows, which may be joined when a fold is used.
    Null sessions are none."""
    sessions = rows.where(F.col(session).isNotNull()).select(F.col(session).alias("session")).distinct()
    both = sessions.join(sessions.select(F.col("session").alias("fold")), F.lit(True))
    return both.withColumn("split", F.when(F.col("session") == F.col("fold"), "val").otherwise("train"))


def leave_one_out(rows: DataFrame, session: str, sessions: Sequence[str] | DataFrame) -> DataFrame:
    """Each row once for each fold, in ``val`` where its session is held out; the folds are a short list, or a table ``fold``
    (broadcast, as its rows times those of ``rows`` come out)."""
    if isinstance(sessions, DataFrame):
        each = rows.crossJoin(F.broadcast(sessions.select("fold")))
    else:
        each = rows.withColumn("fold", F.explode(F.array(*[F.lit(s) for s in sessions])))
    return each.withColumn("split", F.when(F.col(session) == F.col("fold"), "val").otherwise("train"))


def balanced_sessions(rows: DataFrame, session: str, cls: str, ratio: float = 0.2, frame: str | None = None, most_sessions: int = 10_000) -> list[str]:
    """Sessions for validation: greedily the one that brings class shares and size nearest to ``ratio``, until it is reached.

    Size is counted in frames if ``frame`` names their column, else in rows. A session that would leave nothing for
    training is passed over, so one session alone gives none (see ``balanced_validation``). Works on the session x class
    counts, of which ``most_sessions`` x 64 may be; more of them, or more than ``most_sessions``, is an error."""
    table = rows.groupBy(session, cls).count().limit(most_sessions * 64 + 1).collect()
    if len(table) > most_sessions * 64:
        raise ValueError("too many counts of sessions and classes")
    counts: dict[str, dict] = {}
    for s, c, n in table:
        counts.setdefault(s, {})[c] = n
    if len(counts) > most_sessions:
        raise ValueError("too many sessions")
    sizes = {s: sum(per.values()) for s, per in counts.items()}
    if frame is not None:
        sizes = dict(rows.groupBy(session).agg(F.countDistinct(frame)).collect())
    total: dict = {}
    for per in counts.values():
        for c, n in per.items():
            total[c] = total.get(c, 0) + n
    everything = sum(sizes.values())
    target, size, chosen, inside = max(1, int(ratio * everything)), 0, [], dict.fromkeys(total, 0)
    left = sorted(counts, key=str)
    while size < target:

        def cost(s: str) -> float:
            off = sum(total[c] * abs((inside[c] + counts[s].get(c, 0)) / total[c] - ratio) for c in total)
            return round(off + 2 * abs(size + sizes[s] - target), 9)  # noqa: B023

        able = [s for s in left if size + sizes[s] < everything]
        if not able:
            break
        best = min(able, key=lambda s: (cost(s), str(s)))
        left.remove(best)
        chosen.append(best)
        size += sizes[best]
        for c, n in counts[best].items():
            inside[c] += n
    return chosen


def balanced_validation(rows: DataFrame, session: str, cls: str, frame: str, ratio: float = 0.2, seed: int = 0) -> DataFrame:
    """``rows`` with ``split``: whole sessions for validation by ``balanced_sessions``; where there is only one, its frames by
    seeded hash, max(1, floor of ratio) of them (one frame alone is trained on). Null sessions are a session, null frames a
    frame."""
    named = rows.withColumn("_s", F.coalesce(F.col(session).cast("string"), F.lit("(none)"))).withColumn("_f", F.coalesce(F.col(frame).cast("string"), F.lit("(none)")))
    held = balanced_sessions(named, "_s", cls, ratio, "_f")
    if held:
        return named.withColumn("split", F.when(F.col("_s").isin(held), "val").otherwise("train")).drop("_s", "_f")
    frames = numbered(named.select("_f").distinct().withColumn("_h", shuffled("_f", seed=seed)), [], [F.col("_h"), F.col("_f")], "_i")
    # one row with the number of frames
    n = frames.agg(F.count("*").alias("_n"))
    some = frames.join(F.broadcast(n), F.lit(True)).where(F.col("_i") < F.least(F.greatest(F.lit(1), F.floor(F.col("_n") * ratio)), F.col("_n") - 1)).select("_f", F.lit("val").alias("split"))
    return named.join(some, "_f", "left").withColumn("split", F.coalesce("split", F.lit("train"))).drop("_s", "_f")


def _digits(c: Column, at: int) -> Column:
    """Eight hexadecimal digits of a hash as a number."""
    return F.conv(F.substring(c, at, 8), 16, 10).cast("long")


def patches(rows: DataFrame, ident: str, n: int, width: int, height: int, least: int, most: int, hidden: Sequence[tuple] = (), seed: int = 0) -> DataFrame:
    """``rows`` with ``patch, x, y, side``: ``n`` square patches of each row's raster, side and place by a hash of id, number and
    seed; those that touch a rectangle of ``hidden`` (x0, y0, x1, y1) are left out."""
    h = F.md5(F.concat_ws("|", F.col(ident).cast("string"), F.col("patch").cast("string"), F.lit(str(seed))))
    each = rows.withColumn("patch", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("_h", h).withColumn("side", (least + _digits(F.col("_h"), 1) % (most - least + 1)).cast("int"))
    placed = each.withColumn("x", (_digits(F.col("_h"), 9) % (width + 1 - F.col("side"))).cast("int")).withColumn("y", (_digits(F.col("_h"), 17) % (height + 1 - F.col("side"))).cast("int"))
    whole = F.lit(True)
    for a, b, c, d in hidden:
        whole &= ~((F.col("x") < c) & (F.col("x") + F.col("side") > a) & (F.col("y") < d) & (F.col("y") + F.col("side") > b))
    return placed.where(whole).drop("_h")


def synthetic_labels(frames: DataFrame, stem: str, ident: str, classes: int, seed: int = 0) -> DataFrame:
    """``stem, box_idx, cls, cx, cy, w, h``: two to four boxes a frame by hashes of its id, as input of trial runs."""
    name = lambda *parts: F.md5(F.concat_ws("|", F.col(ident).cast("string"), *parts, F.lit(str(seed))))
    n = 2 + _digits(name(F.lit("n")), 1) % 3
    each = frames.withColumn("box_idx", F.explode(F.sequence(F.lit(0), F.lit(3)))).where(F.col("box_idx") < n).withColumn("_h", name(F.col("box_idx").cast("string")))
    at = lambda k: 0.2 + _digits(F.col("_h"), k) % 600 / 1000.0
    return each.select(stem, "box_idx", (_digits(F.col("_h"), 1) % classes).cast("int").alias("cls"), at(9).alias("cx"), at(17).alias("cy"), F.lit(0.1).alias("w"), F.lit(0.1).alias("h"))


def jittered(rows: DataFrame, columns: Sequence[str], key: str, amount: float, seed: int = 0) -> DataFrame:
    """Columns moved by up to ``amount``, evenly, by a hash of key and seed: alike however the rows are parted."""
    return rows.withColumns({c: F.col(c) + jitter(c, key, seed) * amount for c in columns})


def jitter(name: str, key: str, seed: int = 0) -> Column:
    """A number between -1 and 1 by a hash of key, name and seed."""
    return _digits(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(f"{name}{seed}"))), 1) / 2**32 * 2 - 1
