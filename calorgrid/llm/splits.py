"""Splits that keep related records together: components, then grouped iterative stratification."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.keys import let, stem_struct
from calorgrid.operators.components import connected_components
from calorgrid.session import checkpointed


def cabinet_groups(frames: DataFrame, moves: DataFrame, columns: Sequence[str] = ("frame_id",), others: bool = False) -> DataFrame:
    """``columns`` and ``group_key`` of each frame whose stem names site and building; with ``others``, of any frame, the key
    being null where it doesn't. The key is made on the row itself: repeated rows come out as often as they are there.

    Cabinets linked by ``moves`` (old_key, new_key; repeated, circular and null rows allowed) are one group, named by
    its first cabinet key. Other frames (null stem, no stem at all) give no row unless asked for; a frame whose panel is told nowhere
    keeps ``site_building``. No moves: every cabinet is its own group."""
    old, new = (stem_struct(F.concat(F.col(c), F.lit("_")), F.lit(None).cast("string"))["cabinet"] for c in ("old_key", "new_key"))
    links = moves.select(F.coalesce(old, F.col("old_key")).alias("a"), F.coalesce(new, F.col("new_key")).alias("b"))
    groups = connected_components(links, "a", "b").withColumnRenamed("node", "cabinet")
    # a generator that isn't outer drops frames without a cabinet; a filter would parse every stem twice
    named = let(stem_struct(F.col("stem"), F.col("panel")), lambda k: F.when(k.isNotNull(), F.array(F.struct(k["cabinet"].alias("cabinet")))))
    keyed = frames.select(*columns, F.inline_outer(named) if others else F.inline(named))
    return keyed.join(groups, "cabinet", "left").select(*columns, F.coalesce("component", "cabinet").alias("group_key"))


def place(labels: np.ndarray, need: np.ndarray, rounds: int = 400, shakes: int = 24) -> np.ndarray:
    """Split of each group. labels: groups x labels, counts; need: splits x labels, counts still wanted (changed here).

    The label with the fewest counts outstanding comes first; its groups, largest first, go to the split that needs
    that label most among those with room for the group, or, where none has, to the one that then is least over; ties go
    to the split that needs most records at all, then to the first. Then single groups are moved and pairs swapped, the
    best step first, while that brings the splits nearer to what they want (at most ``rounds`` steps)."""
    out = np.full(len(labels), -1, dtype=np.int64)
    left = labels.astype(float)
    wanted_all = need.copy()
    while (todo := out < 0).any():
        rest = left[todo].sum(axis=0)
        if not (rest > 0).any():
            out[todo] = int(np.argmax(need.sum(axis=1)))
            break
        label = int(np.argmin(np.where(rest > 0, rest, np.inf)))
        rows = np.flatnonzero(todo & (left[:, label] > 0))
        for i in rows[np.argsort(-left[rows, label], kind="stable")]:
            room = need.sum(axis=1) - left[i].sum()
            fits = room >= -1e-9
            if not fits.any():
                fits = room >= room.max() - 1e-9
            wanted = np.where(fits, need[:, label], -np.inf)
            best = np.flatnonzero(wanted >= wanted.max() - 1e-9)
            k = int(best[np.argmax(need[best].sum(axis=1))])
            out[i] = k
            need[k] -= left[i]
    improve(left, out, need, wanted_all, rounds)
    # few groups can stick in a poor corner: shake them (the same way each time) and keep what is better
    weight = 1 / np.maximum(_full(np.abs(wanted_all)).sum(axis=0), 1.0) ** 2
    cost = lambda x: float((_full(x) ** 2 @ weight).sum())
    rng, reached = np.random.default_rng(len(labels)), cost(need)
    for _ in range(shakes if len(need) > 1 else 0):
        if reached < 1e-5:  # misses of about a thousandth
            break
        other, lack = out.copy(), need.copy()
        for i in rng.choice(len(out), min(len(out), 3), replace=False):
            k = int(rng.integers(len(need)))
            lack[other[i]] += left[i]
            lack[k] -= left[i]
            other[i] = k
        improve(left, other, lack, wanted_all, rounds)
        if (now := cost(lack)) < reached - 1e-12:
            reached, out, need[:] = now, other, lack
    return out


def _full(x: np.ndarray) -> np.ndarray:
    """Label counts, and behind them their sum."""
    return np.column_stack([x, x.sum(axis=1)])


def improve(labels: np.ndarray, out: np.ndarray, need: np.ndarray, wanted: np.ndarray, rounds: int, near: int = 16) -> None:
    """Moves and swaps that lower the sum of squares of what the splits lack, of each label and of all records, each as a
    share of what there is of it (changes ``out`` and ``need``). A swap's partner is looked for among the ``near`` groups
    on either side of the size that would even the two splits out."""
    weight = 1 / np.maximum(_full(np.abs(wanted)).sum(axis=0), 1.0) ** 2
    g = _full(labels)
    alone = 2 * (g * g) @ weight
    for _ in range(rounds):
        lack = _full(need)
        best = (-1e-12, None)
        for a in range(len(need)):
            mine = np.flatnonzero(out == a)
            if not len(mine):
                continue
            for b in range(len(need)):
                if a == b:
                    continue
                gap = lack[a] - lack[b]
                delta = alone[mine] + 2 * (g[mine] * weight) @ gap
                k = int(np.argmin(delta))
                if delta[k] < best[0]:
                    best = (float(delta[k]), (mine[k], a, None, b))
                theirs = np.flatnonzero(out == b)
                if a > b or not len(theirs):
                    continue
                theirs = theirs[np.argsort(g[theirs, -1], kind="stable")]
                # moving d = g_i - g_j from a to b is best at d = -gap / 2
                at = np.searchsorted(g[theirs, -1], g[mine, -1] + gap[-1] / 2)
                pick = np.clip(at[:, None] + np.arange(-near, near), 0, len(theirs) - 1)
                d = g[mine][:, None, :] - g[theirs][pick]
                delta = 2 * (d * d) @ weight + 2 * (d * weight) @ gap
                k = int(np.argmin(delta))
                if delta.flat[k] < best[0]:
                    i, j = np.unravel_index(k, delta.shape)
                    best = (float(delta.flat[k]), (mine[i], a, theirs[pick[i, j]], b))
        if best[1] is None:
            return
        i, a, j, b = best[1]
        out[i] = b
        need[a] += labels[i]
        need[b] -= labels[i]
        if j is not None:
            out[j] = a
            need[b] += labels[j]
            need[a] -= labels[j]


def grouped_splits(
    records: DataFrame,
    group: str,
    label: Column,
    labels: Sequence[str],
    proportions: dict[str, float],
    heavy_share: float = 1 / 2000,
    shard_groups: int = 20000,
) -> DataFrame:
    """``group, split`` for every group of ``records``, by grouped iterative stratification (see ``placed_groups``)."""
    heavy, light = placed_groups(records, group, label, labels, proportions, heavy_share, shard_groups)
    return heavy.unionByName(light)


def placed_groups(
    records: DataFrame,
    group: str,
    label: Column,
    labels: Sequence[str],
    proportions: dict[str, float],
    heavy_share: float = 1 / 2000,
    shard_groups: int = 20000,
) -> tuple[DataFrame, DataFrame]:
    """``group, split`` of the heavy groups, and of all others, by grouped iterative stratification.

    Groups with at least ``heavy_share`` of all records, or of the records of one label, are placed first, together; there
    are at most (labels + 2)/heavy_share of them, and all groups of a very rare label are among them. The others are
    placed by shards of about ``shard_groups`` groups, each shard with its part of what the heavy groups left open. Labels outside ``labels`` and null ones count as one more label. A null group is a group. Only the label
    totals and the open need (splits x labels numbers) reach the driver."""
    names = list(proportions)
    known = F.coalesce(F.array_position(F.array(*[F.lit(x) for x in labels]), label).cast("int"), F.lit(0))
    width = len(labels) + 1
    cols = [f"n{j}" for j in range(width)]
    vectors = checkpointed(
        records.select(F.col(group).alias("grp"), known.alias("j"))
        .groupBy("grp")
        .agg(F.count("*").alias("n"), *[F.count_if(F.col("j") == j).alias(f"n{j}") for j in range(width)])
    )
    first = vectors.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("groups"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in cols]).first()
    share = np.array([proportions[x] for x in names], dtype=float)
    share /= share.sum()
    want = np.outer(share, [first[c] for c in cols])
    heavy_group = F.col("n") >= max(1.0, heavy_share * first["n"])
    for c in cols:
        heavy_group |= F.col(c) >= max(1.0, heavy_share * first[c])

    def of(pdf: pd.DataFrame, need: np.ndarray) -> pd.DataFrame:
        pdf = pdf.sort_values("grp", na_position="first", ignore_index=True)
        k = place(pdf[cols].to_numpy(dtype=float), need)
        return pd.DataFrame({"grp": pdf["grp"], "split": [names[i] for i in k], "n": pdf["n"], **{c: pdf[c] for c in cols}})

    schema = f"grp {dict(vectors.dtypes)['grp']}, split string, n long, " + ", ".join(f"{c} long" for c in cols)
    heavy = checkpointed(vectors.where(heavy_group).groupBy().applyInPandas(lambda pdf: of(pdf, want.copy()), schema))
    need = want.copy()
    for row in heavy.groupBy("split").agg(*[F.sum(c).alias(c) for c in cols]).collect():
        need[names.index(row["split"])] -= [row[c] for c in cols]
    rest_total = np.maximum(need.sum(axis=0), 1e-9)
    shards = max(1, -(-int(first["groups"]) // shard_groups))

    def tail(pdf: pd.DataFrame) -> pd.DataFrame:
        return of(pdf, need * (pdf[cols].sum().to_numpy(dtype=float) / rest_total))

    light = vectors.where(~heavy_group).groupBy(F.pmod(F.xxhash64("grp"), F.lit(shards))).applyInPandas(tail, schema)
    return tuple(x.select(F.col("grp").alias(group), "split") for x in (heavy, light))


def frame_splits(frames: DataFrame, moves: DataFrame, proportions: dict[str, float], labels: Sequence[str]) -> DataFrame:
    """``frame_id, group_key, split`` for every row of ``frames``; label is the verdict.

    A frame without a cabinet is grouped by its stem as it is, one without a stem by its id; those with neither are one group."""
    own = F.coalesce(F.concat(F.lit("stem:"), F.col("stem")), F.concat(F.lit("frame:"), F.col("frame_id").cast("string")), F.lit("frame:"))
    keyed = checkpointed(cabinet_groups(frames, moves, ("frame_id", "stem", "verdict"), others=True).select("frame_id", "verdict", F.coalesce("group_key", own).alias("group_key")))
    heavy, light = placed_groups(keyed, "group_key", F.col("verdict"), labels, proportions)
    # heavy groups are of a bounded number, so no frame of theirs is moved; the others are too small to skew a join
    first = keyed.join(F.broadcast(heavy), "group_key", "left")
    out = first.where("split is null").drop("split").join(light, "group_key").unionByName(first.where("split is not null"))
    return out.select("frame_id", "group_key", "split")


def split_shares(frames: DataFrame, splits: DataFrame, proportions: dict[str, float], labels: Sequence[str], within: float) -> DataFrame:
    """``split, label, n, share, kept``: records of each split with a label (other and null ones under ``(other)``, all under
    ``(all)``), their share of the label's records, and whether it is as asked for, give or take ``within`` and one group's
    mean share of the label (groups can't be cut). A frame_id is taken to be unique; no frames give no rows."""
    known = F.when(F.col("verdict").isin(list(labels)), F.col("verdict")).otherwise("(other)")
    both = frames.select("frame_id", F.explode(F.array(known, F.lit("(all)"))).alias("label")).join(splits, "frame_id")
    counts = checkpointed(both.groupBy("group_key", "split", "label").agg(F.count("*").alias("n")))
    of = counts.groupBy("label").agg(F.sum("n").alias("_of"), F.count("*").alias("_groups"))
    total = sum(proportions.values())
    names = F.array(*[F.struct(F.lit(k).alias("split"), F.lit(v / total).alias("_want")) for k, v in proportions.items()])
    each = of.select("label", "_of", "_groups", F.inline(names)).join(counts.groupBy("label", "split").agg(F.sum("n").alias("n")), ["label", "split"], "left")
    share = F.coalesce("n", F.lit(0)) / F.col("_of")
    return each.select("split", "label", F.coalesce("n", F.lit(0)).alias("n"), share.alias("share"), (F.abs(share - F.col("_want")) <= within + 1 / F.col("_groups")).alias("kept"))
