"""Checks of artefacts and forms: manifests, scores, review forms, skip records, agreement of several annotators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_check(files: DataFrame, manifest: DataFrame, name: str, content: str, digest: str = "sha256") -> DataFrame:
    """``name, state``: files against a manifest of SHA-256 digests: ``same``, ``changed``, ``missing`` (only in the manifest) or
    ``unlisted``. A file without content counts as changed; letter case of the digests doesn't matter."""
    have = files.select(F.col(name).alias("name"), F.sha2(F.col(content), 256).alias("_have"), F.lit(True).alias("_there"))
    want = manifest.select(F.col(name).alias("name"), F.lower(digest).alias("_want"), F.lit(True).alias("_listed"))
    state = (
        F.when(F.col("_there").isNull(), "missing").when(F.col("_listed").isNull(), "unlisted").when(F.col("_have") == F.col("_want"), "same").otherwise("changed")
    )
    return have.join(want, "name", "full").select("name", state.alias("state"))


def weighted_score(areas: DataFrame, score: str, most: str) -> DataFrame:
    """One row ``score, most, share``: the sum of scores, the sum of what could be reached, and their ratio in percent (null
    if that is 0). Areas without a score count as 0."""
    s = areas.agg(F.coalesce(F.sum(score), F.lit(0)).alias("score"), F.coalesce(F.sum(most), F.lit(0)).alias("most"))
    return s.withColumn("share", F.when(F.col("most") > 0, F.col("score") * 100 / F.col("most")))


def form_scores(form: DataFrame, verdict: str, label: str, reason: str, allowed: Sequence[str], clear: str = "clear", mixed: str = "mixed") -> DataFrame:
    """One row of a review form's rows with a non-blank verdict: ``judged``, ``distinguishable`` (the verdict begins with
    ``clear``) and its percent, ``mismatches`` (the verdict ends with another label than the row's), ``mixed``, and
    ``bad_reasons`` (a reason outside the fixed vocabulary)."""
    v = F.trim(F.col(verdict))
    rows = form.where(F.coalesce(v != "", F.lit(False)))
    sure = F.startswith(v, F.lit(clear))
    out = rows.agg(
        F.count("*").alias("judged"), F.count_if(sure).alias("distinguishable"), F.count_if(sure & ~F.endswith(v, F.col(label))).alias("mismatches"),
        F.count_if(F.startswith(v, F.lit(mixed))).alias("mixed"), F.count_if(F.col(reason).isNotNull() & ~F.col(reason).isin(list(allowed))).alias("bad_reasons"),
    )
    return out.withColumn("pct", F.when(F.col("judged") > 0, F.col("distinguishable") * 100 / F.col("judged")))


def skip_hygiene(cases: DataFrame, labels: DataFrame, skips: DataFrame, key: str, n_boxes: str) -> DataFrame:
    """``key, problem``: ``unknown`` for a label or skip record of no case, ``no record`` for a case whose label is empty and that
    no skip record explains."""
    stray = labels.select(key).unionByName(skips.select(key)).where(F.col(key).isNotNull()).distinct().join(cases.select(key), key, "left_anti")
    silent = labels.where(F.coalesce(F.col(n_boxes), F.lit(0)) == 0).select(key).distinct().join(cases.select(key), key, "left_semi").join(skips.select(key), key, "left_anti")
    return stray.withColumn("problem", F.lit("unknown")).unionByName(silent.withColumn("problem", F.lit("no record")))


def verdict_agreement(rows: DataFrame, frame: str, annotator: str, verdict: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Agreement on the frames that several annotators judged (one verdict a frame and annotator; null ones are left out).

    ``(all, pairs, disagreements)``: one row ``frames, agreed, rate`` over frames that every annotator has; a row
    ``a, b, frames, agreed, rate`` of each pair of annotators; ``frame, verdicts`` where a frame's annotators differ. Frames
    are grouped by their key; a frame has a row an annotator."""
    own = rows.where(F.col(annotator).isNotNull() & F.col(verdict).isNotNull()).groupBy(F.col(frame).alias("frame"), F.col(annotator).alias("who")).agg(F.max(verdict).alias("v"))
    per = own.groupBy("frame").agg(F.count("*").alias("m"), F.array_sort(F.collect_list(F.struct("who", "v"))).alias("vs"))
    n = own.agg(F.countDistinct("who").alias("_n"))  # one row
    alike = F.size(F.array_distinct(F.transform("vs", lambda x: x["v"]))) == 1
    common = per.join(F.broadcast(n), F.col("m") == F.col("_n"))
    rate = lambda df: df.withColumn("rate", F.when(F.col("frames") > 0, F.col("agreed") / F.col("frames")))
    everyone = rate(common.agg(F.count("*").alias("frames"), F.count_if(alike).alias("agreed")))
    two = F.flatten(F.transform("vs", lambda x: F.transform(F.filter("vs", lambda y: y["who"] > x["who"]), lambda y: F.struct(x["who"].alias("a"), y["who"].alias("b"), (x["v"] == y["v"]).alias("same")))))
    pairs = rate(per.select(F.inline(two)).groupBy("a", "b").agg(F.count("*").alias("frames"), F.count_if("same").alias("agreed")))
    differ = per.where(~alike).select("frame", F.array_join(F.transform("vs", lambda x: F.concat_ws(": ", x["who"].cast("string"), x["v"].cast("string"))), " / ").alias("verdicts"))
    return everyone, pairs, differ
