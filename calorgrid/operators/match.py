"""Joins of boxes by overlap, greedy one-to-one matching, merging, and what is measured on matches."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.geometry import iou
from calorgrid.operators.exact import quantiles

BOX = ("x1", "y1", "x2", "y2")


def _box(alias: str) -> list[Column]:
    return [F.col(f"{alias}.{c}").cast("double") for c in BOX]


def overlapping(a: DataFrame, b: DataFrame, frame: str, least: float, same_class: bool | None = True, cls: str = "cls") -> DataFrame:
    """Rows ``a``, ``b`` (structs) and ``iou`` of box pairs of one frame that overlap by ``least`` or more.

    The frame (and class, unless pairs of different or of any classes are wanted) is the equi-join key; overlap is a
    residual condition."""
    on = F.col(f"a.{frame}") == F.col(f"b.{frame}")
    if same_class is not None:
        on &= (F.col(f"a.{cls}") == F.col(f"b.{cls}")) if same_class else (F.col(f"a.{cls}") != F.col(f"b.{cls}"))
    pairs = a.alias("a").join(b.alias("b"), on).withColumn("iou", iou(_box("a"), _box("b"))).where(F.col("iou") >= least)
    return pairs.select(F.struct("a.*").alias("a"), F.struct("b.*").alias("b"), "iou")


def greedy_matches(reference: DataFrame, other: DataFrame, frame: str, idx: str, least: float = 0.5, cls: str = "cls") -> DataFrame:
    """``frame, ref_idx, hyp_idx, iou``: one-to-one matches. References in order of ``idx`` take the unused box of their
    class with the largest overlap (the first of equal ones); it counts from ``least`` on.

    A fold over each frame's references in the JVM; a frame's boxes are few."""
    pairs = overlapping(reference, other, frame, 1e-12, True, cls)
    listed = pairs.groupBy(F.col(f"a.{frame}").alias(frame), F.col(f"a.{cls}").alias("_c"), F.col(f"a.{idx}").alias("r")).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("iou")).alias("m"), F.col(f"b.{idx}").alias("h")))).alias("hs")
    )
    kind = "array<struct<r:{0},h:{0},v:double>>".format(dict(reference.dtypes)[idx])
    per = listed.groupBy(frame, "_c").agg(F.array_sort(F.collect_list(F.struct("r", "hs"))).alias("rs"))

    def take(acc: Column, x: Column) -> Column:
        best = F.get(F.filter(x["hs"], lambda h: ~F.exists(acc, lambda u: u["h"] == h["h"])), 0)
        fits = best.isNotNull() & (-best["m"] >= least)
        return F.when(fits, F.concat(acc, F.array(F.struct(x["r"].alias("r"), best["h"].alias("h"), (-best["m"]).alias("v"))))).otherwise(acc)

    folded = per.select(frame, F.inline(F.aggregate("rs", F.array().cast(kind), take)))
    return folded.select(frame, F.col("r").alias("ref_idx"), F.col("h").alias("hyp_idx"), F.col("v").alias("iou"))


def match_scores(reference: DataFrame, other: DataFrame, matches: DataFrame, frame: str, idx: str, cls: str = "cls") -> DataFrame:
    """``cls, tp, fp, fn, precision, recall, f_score, touch`` per class and, under null, of all; empty counts divide by 1."""
    hit = matches.join(reference.select(frame, F.col(idx).alias("ref_idx"), cls), [frame, "ref_idx"]).groupBy(cls).agg(F.count("*").alias("tp"))
    n = lambda df, name: df.groupBy(cls).agg(F.count("*").alias(name))
    each = n(reference, "n_ref").join(n(other, "n_hyp"), cls, "full").join(hit, cls, "left").fillna(0, ["n_ref", "n_hyp", "tp"])
    total = each.rollup(cls).agg(*[F.sum(c).alias(c) for c in ("tp", "n_ref", "n_hyp")])
    one = F.lit(1)
    p, r = F.col("tp") / F.greatest(F.col("n_hyp"), one), F.col("tp") / F.greatest(F.col("n_ref"), one)
    return total.select(cls, "tp", (F.col("n_hyp") - F.col("tp")).alias("fp"), (F.col("n_ref") - F.col("tp")).alias("fn"), p.alias("precision"), r.alias("recall"), (2 * p * r / F.greatest(p + r, F.lit(1e-9))).alias("f_score"), (F.col("n_hyp") + F.col("n_ref") - 2 * F.col("tp")).alias("touch"))


def prediction_scores(predicted: DataFrame, truth: DataFrame, matches: DataFrame, frame: str, idx: str, cls: str = "cls", weight: float = 0.3) -> DataFrame:
    """``cls, tp, fp, fn, saving_pct, cost, median_iou`` per class and, under null, of all, from matches that predictions drove
    (``ref_idx`` is the prediction's). Saving compares what a person has to touch with drawing all boxes anew; cost counts a
    false box ``weight``, a missed one 1; the median overlap of a class without matches is null."""
    hit = matches.join(predicted.select(frame, F.col(idx).alias("ref_idx"), cls), [frame, "ref_idx"]).select(cls, "iou")
    tall = lambda df: df.select(F.explode(F.array(cls, F.lit(None).cast(dict(predicted.dtypes)[cls]))).alias(cls), *[c for c in df.columns if c == "iou"])
    n = lambda df, what: tall(df.select(cls)).select(cls, F.lit(what).alias("what"))
    each = n(hit, "tp").unionByName(n(predicted, "np")).unionByName(n(truth, "nt")).groupBy(cls).agg(*[F.count_if(F.col("what") == w).alias(w) for w in ("tp", "np", "nt")])
    middle = quantiles(tall(hit), [cls], "iou", {"median_iou": 0.5})
    both = each.alias("a").join(middle.alias("b"), F.col(f"a.{cls}").eqNullSafe(F.col(f"b.{cls}")), "left")
    fp, fn = F.col("np") - F.col("tp"), F.col("nt") - F.col("tp")
    return both.select(F.col(f"a.{cls}").alias(cls), "tp", fp.alias("fp"), fn.alias("fn"), ((1 - (fp + fn) / F.greatest(F.col("nt"), F.lit(1))) * 100).alias("saving_pct"), (weight * fp + fn).alias("cost"), "median_iou")


def merge_split_boxes(boxes: DataFrame, frame: str, idx: str, mergeable: Sequence[int], least_x: float = 0.6, most_gap: float = 40, cls: str = "cls") -> DataFrame:
    """Boxes with vertically split parts joined until nothing changes: same mergeable class, horizontal overlap of at least
    ``least_x`` of the narrower one, gap up to ``most_gap``. The first such pair becomes one box, which keeps the smaller index
    and goes to the end of the list, and so on. Order within a frame matters, so frames (a few boxes each) are folded
    whole; pairs that were found apart aren't looked at again."""
    cols = [frame, idx, cls, *BOX]
    kinds = dict(boxes.dtypes)

    def joins(a: list, b: list) -> bool:
        wide = (min(a[5], b[5]) - max(a[3], b[3])) / max(min(a[5] - a[3], b[5] - b[3]), 1e-9)
        return a[2] == b[2] and wide >= least_x and max(a[4], b[4]) - min(a[6], b[6]) <= most_gap

    def fold(todo: list[list]) -> list[list]:
        apart = 0  # boxes before it join none but, perhaps, the last
        while True:
            last = len(todo) - 1
            pair = next(((i, j) for i in range(last) for j in ((last,) if i < apart else range(i + 1, last + 1)) if joins(todo[i], todo[j])), None)
            if pair is None:
                return todo
            (i, j), a, b = pair, todo[pair[0]], todo[pair[1]]
            del todo[j], todo[i]
            todo.append([a[0], min(a[1], b[1]), a[2], min(a[3], b[3]), min(a[4], b[4]), max(a[5], b[5]), max(a[6], b[6])])
            apart = i

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[list] = []
        for pdf in batches:
            out: list[list] = []
            for row in pdf.itertuples(index=False):
                if held and held[0][0] != row[0]:
                    out += fold(held)
                    held = []
                held.append(list(row))
            yield pd.DataFrame(out, columns=cols)
        yield pd.DataFrame(fold(held), columns=cols)

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in cols)
    can = F.coalesce(F.col(cls).isin(list(mergeable)), F.lit(False))
    merged = boxes.where(can).select(*cols).repartition(frame).sortWithinPartitions(frame, idx).mapInPandas(run, schema)
    return merged.unionByName(boxes.where(~can).select(*cols))


def confusion(pairs: DataFrame, cls: str = "cls") -> DataFrame:
    """``cls_a, cls_b, n`` of overlapping pairs of different classes, classes in order."""
    a, b = F.col(f"a.{cls}"), F.col(f"b.{cls}")
    return pairs.groupBy(F.least(a, b).alias("cls_a"), F.greatest(a, b).alias("cls_b")).agg(F.count("*").alias("n"))


def kappa(rows: DataFrame, first: str, second: str) -> DataFrame:
    """``n, agreement, kappa`` (Cohen) of two raters' labels; rows that lack one are left out."""
    both = rows.where(F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(F.col(first).alias("a"), F.col(second).alias("b")).agg(F.count("*").alias("n"))
    n = both.agg(F.sum("n").alias("total"), F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)).alias("same"))
    left, right = both.groupBy("a").agg(F.sum("n").alias("x")), both.groupBy("b").agg(F.sum("n").alias("y"))
    chance = left.join(right, F.col("a") == F.col("b")).agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("c"))
    # two tables of one row each
    one = n.withColumn("k", F.lit(1)).join(chance.withColumn("k", F.lit(1)), "k")
    po, pe = F.col("same") / F.col("total"), F.col("c") / (F.col("total") * F.col("total"))
    return one.select(F.col("total").alias("n"), po.alias("agreement"), F.when(pe < 1, (po - pe) / (1 - pe)).alias("kappa"))


def common_frames(rows: DataFrame, frame: str, annotator: str) -> DataFrame:
    """Frames that every annotator has."""
    all_of = rows.agg(F.countDistinct(annotator).alias("_all"))  # one row
    return rows.groupBy(frame).agg(F.countDistinct(annotator).alias("_m")).join(F.broadcast(all_of), F.col("_m") == F.col("_all")).select(frame)
