"""Queries on boxes over rasters, remaps, matching from the prediction side, degraded views, forms, patches and checks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calorgrid.functions import geometry
from calorgrid.functions.grading import ladder
from calorgrid.functions.keys import session_of
from calorgrid.functions.numeric import filled, finite, to_byte
from calorgrid.operators import audits, boxstats, match, raster, remap, sampling, windows
from calorgrid.operators.exact import quantiles
from calorgrid.operators.stats import beside
from calorgrid.plans.boxes import _BOX, _IOU, boxes
from calorgrid.plans.registry import Registry
from calorgrid.sources import flir, made
from calorgrid.sources.sinks import label_texts
from calorgrid.sources.tables import table

query = Registry()
#: the 8 x 8 vectors of ``embeddings`` stand for temperature rasters; boxes of a 320 x 240 frame are scaled by a tenth, their
#: corner is folded into the upper left quarter, and they belong to the raster whose number is the box's modulo 500
_HIDDEN = ((0, 0, 2, 1), (6, 6, 8, 8))
_PX = """e as (select vec_id, i % 8 as x, i // 8 as y, embedding[i + 1]::double * 100 as t from embeddings, range(64) r(i)),
b0 as (select det_id, stem, cls, det_id % 500 as vec_id, (x1 / 10) % 4 as u1, (y1 / 7.5) % 4 as v1, (x1 / 10) % 4 + (x2 - x1) / 10 as u2, (y1 / 7.5) % 4 + (y2 - y1) / 7.5 as v2 from frame_dets where stem is not null and cls is not null and x2 > x1 and y2 > y1)"""


def _rasters(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double") * 100).alias("raster"))


def _small_boxes(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf)
    x, y = (F.col("x1") / 10) % 4, (F.col("y1") / 7.5) % 4
    corners = (x.alias("x1"), y.alias("y1"), (x + (F.col("x2") - F.col("x1")) / 10).alias("x2"), (y + (F.col("y2") - F.col("y1")) / 7.5).alias("y2"))
    return b.select("det_id", "stem", "cls", F.pmod("det_id", F.lit(500)).alias("vec_id"), *corners)


def _px_sql(whole: str, least_side: int, least_px: int, hidden: bool) -> str:
    rule = " and not ".join(["true", *[f"(x >= {a} and x < {c} and y >= {b} and y < {d})" for a, b, c, d in _HIDDEN]]) if hidden else "true"
    return f"""with {_PX}, b as (select det_id, vec_id, greatest(0, {whole.format('u1')})::int a, greatest(0, {whole.format('v1')})::int b, least(8, {whole.format('u2')})::int c, least(8, {whole.format('v2')})::int d from b0),
s as (select det_id, quantile_cont(t, 0.99) p, max(t) m, avg(t) q, count(*)::int n from b join e on e.vec_id = b.vec_id and x >= a and x < c and y >= b.b and y < d and {rule} where c - a >= {least_side} and d - b.b >= {least_side} group by det_id having count(*) >= {least_px})
select det_id, round(p, 6) as t_p99, round(m, 6) as t_max, round(q, 6) as t_mean, n as n_px, n < 10 as low_confidence, m > 250 as over_range from b0 left join s using (det_id)"""


def _measured(out: DataFrame) -> DataFrame:
    return out.select("det_id", *[F.round(c, 6).alias(c) for c in ("t_p99", "t_max", "t_mean")], "n_px", "low_confidence", "over_range")


@query(_px_sql("round_even({}, 0)", 2, 4, True))
def box_temperatures(spark: SparkSession, sf: str) -> DataFrame:
    """p99, maximum, mean and number of a box's valid pixels, windows rounded half to even; null under two pixels a side or four
    in all."""
    return _measured(boxstats.box_statistics(_rasters(spark, sf), _small_boxes(spark, sf), "vec_id", "raster", 8, 8, rectangles=_HIDDEN, few=10))


@query(_px_sql("trunc({})", 2, 1, False))
def box_temperatures_census(spark: SparkSession, sf: str) -> DataFrame:
    """As the census reads boxes: windows truncated, any pixel is enough."""
    return _measured(boxstats.box_statistics(_rasters(spark, sf), _small_boxes(spark, sf), "vec_id", "raster", 8, 8, "truncate", 2, 1, few=10))


@query(f"""with {_PX}, b as (select det_id, stem, cls, vec_id, greatest(0, round_even(u1, 0))::int a, greatest(0, round_even(v1, 0))::int b, least(8, round_even(u2, 0))::int c, least(8, round_even(v2, 0))::int d from b0),
s as (select det_id, any_value(stem) stem, any_value(cls) cls, quantile_cont(t, 0.99) p from b join e on e.vec_id = b.vec_id and x >= a and x < c and y >= b.b and y < d where c - a >= 2 and d - b.b >= 2 group by det_id having count(*) >= 4),
m as (select stem, cls, median(p) m, count(*) k from s group by all), j as (select s.*, case when k >= 2 then p - m end o from s join m using (stem, cls)),
r as (select *, case when o >= 40 then 4 when o >= 15 then 3 when o >= 5 then 2 else 1 end r from j)
select stem, count(*) as n_det, ['normal', 'caution', 'abnormal', 'critical'][max(r)] as verdict, arg_max(cls, (r, -det_id)) as worst_cls, round(arg_max(p, (r, -det_id)), 6) as worst_temp from r group by stem""")
def raster_judgement(spark: SparkSession, sf: str) -> DataFrame:
    """From rasters and boxes to the worst component of each frame: box statistics, peers of the class, grades, worst."""
    s = boxstats.box_statistics(_rasters(spark, sf), _small_boxes(spark, sf), "vec_id", "raster", 8, 8).where("t_p99 is not null")
    p = windows.with_peer_median(s.select("det_id", "stem", "cls", "t_p99"), ["stem", "cls"], "t_p99")
    r = p.withColumn("verdict", ladder(F.col("t_p99") - F.col("peer"), (5, 15, 40))).withColumn("r", F.array_position(F.array(*[F.lit(x) for x in ("normal", "caution", "abnormal", "critical")]), F.col("verdict")))
    w = r.groupBy("stem").agg(F.count("*").alias("n_det"), F.max_by(F.struct("verdict", "cls", "t_p99"), F.struct("r", -F.col("det_id"))).alias("w"))
    return w.select("stem", "n_det", F.col("w.verdict").alias("verdict"), F.col("w.cls").alias("worst_cls"), F.round("w.t_p99", 6).alias("worst_temp"))


@query("select vec_id, 2 as x, 1 as y, 1.0::double as scale, 1.0::double as ncc from embeddings")
def registration(spark: SparkSession, sf: str) -> DataFrame:
    """Where, and at which scale, a part of a raster (cut at (2, 1)) fits the raster best: the place it was cut from."""
    part = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda y: F.slice("embedding", y * 8 + 3, F.lit(4))))
    r = raster.registered(table(spark, sf, "embeddings").withColumn("part", part), "vec_id", "part", (4, 4), "embedding", (8, 8), (1.0, 1.25, 1.5))
    return r.select("vec_id", "x", "y", "scale", F.round("ncc", 6).alias("ncc"))


@query("""with e as (select vec_id, i % 8 x, i // 8 y, embedding[i + 1]::double t from embeddings, range(64) r(i)),
k as (select a.vec_id, a.x, a.y, greatest(0, least(255, 9 * any_value(a.t) - sum(b.t))) v from e a join e b on a.vec_id = b.vec_id and abs(a.x - b.x) <= 1 and abs(a.y - b.y) <= 1 where a.x between 2 and 5 and a.y between 2 and 5 group by a.vec_id, a.x, a.y)
select vec_id, round(sum(v), 4) as strength, count_if(v > 0) as n from k group by vec_id""")
def edge_strength(spark: SparkSession, sf: str) -> DataFrame:
    e = raster.mapped(table(spark, sf, "embeddings"), "embedding", 8, 8, raster.edges, "v")
    return e.select("vec_id", F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 4).alias("strength"), F.size(F.filter("v", lambda x: x > 0)).cast("long").alias("n"))


#: camera parameters of the made pictures
_CAMERA = {"model": "trial", "serial": "7", "lens": "wide", "emissivity": 0.9375, "distance": 1.0, "refl_temp": 20.0, "r1": 16384.0, "b": 1408.0, "f": 1.0, "o": -7000, "fov": 25.0, "r2": 0.015625}
_RAW = "e as (select vec_id, 14000 + (floor(embedding[i + 1]::double * 8000 + 4000)::int % 8000 + 8000) % 8000 as raw from embeddings, range(64) r(i))"


def _made(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    """Vectors as raw values of 8 x 8 pictures, encoded."""

    @F.pandas_udf("binary")
    def encode(v: pd.Series) -> pd.Series:
        def one(x: np.ndarray) -> bytes:
            raw = (14000 + np.floor(np.asarray(x, dtype=np.float64) * 8000 + 4000).astype(np.int64) % 8000).astype(np.uint16).reshape(8, 8)
            return made.picture(raw, _CAMERA, b"\xff\xd8\xffvisual", 200) if kind == "picture" else made.tiff16(raw + np.uint16(15000))

        return v.map(one)

    return table(spark, sf, "embeddings").select("vec_id", encode("embedding").alias("content"))


@query(f"""with {_RAW}, k as (select 16384.0 / (0.015625 * (exp(1408.0 / 293.15::float::double) - 1)) + 7000 as back), t as (select vec_id, (1408.0 / ln(16384.0 / (0.015625 * ((raw - 0.0625 * back) / 0.9375 - 7000)) + 1) - 273.15)::float as t from e, k)
select vec_id, 'trial' as model, 8 as width, 64::bigint as n, round(max(t)::double, 3) as most, round(min(t)::double, 3) as least, 9 as visual from t group by vec_id""")
def radiometric_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Radiometric pictures (made of the vectors) read back: segments, records, parameters, PNG, Planck's law, visual picture."""
    d = flir.decoded(_made(spark, sf, "picture"), "vec_id", "content")
    most, least = F.array_max("temp").cast("double"), F.array_min("temp").cast("double")
    return d.select(F.col("path").cast("long").alias("vec_id"), F.col("meta.model").alias("model"), "width", F.size("temp").cast("long").alias("n"), F.round(most, 3).alias("most"), F.round(least, 3).alias("least"), F.length("visual").alias("visual"))


@query(f"with {_RAW}, t as (select vec_id, ((raw + 15000) / 100 - 273.15)::float as t from e) select vec_id, 8 as height, round(max(t)::double, 3) as most, round(avg(t::double), 3) as mean from t group by vec_id")
def centikelvin_decode(spark: SparkSession, sf: str) -> DataFrame:
    """TIFF images (made of the vectors) read back as temperatures."""
    d = flir.decoded_centikelvin(_made(spark, sf, "tiff"), "vec_id", "content")
    mean = F.aggregate("temp", F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size("temp")
    return d.select(F.col("path").cast("long").alias("vec_id"), "height", F.round(F.array_max("temp").cast("double"), 3).alias("most"), F.round(mean, 3).alias("mean"))


# ---- classes of one list as those of another ------------------------------------------------------------------------
@query("""with s as (select 25 - cls as id, cls_key as name from class_dim where cls <> 7), k as (select cls_key as name, cls from class_dim union all select 'other', 99)
select k.cls as new_cls, count(*) as n from frame_dets d left join s on s.id = d.cls left join k using (name) group by k.cls""")
def class_remap_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Classes numbered in another order, one of them unknown, by their names; unmatched ones are counted under null."""
    dim = table(spark, sf, "class_dim")
    known = remap.vocabulary(dim.select(F.col("cls_name").alias("name"), "cls"), dim.select(F.col("cls_key").alias("name"), "cls"))
    names = dim.where("cls <> 7").select((25 - F.col("cls")).alias("id"), F.col("cls_key").alias("name"))
    return remap.remap_by_name(table(spark, sf, "frame_dets"), names, known).groupBy("new_cls").agg(F.count("*").alias("n"))


@query("select name, max(cls) as cls from (select cls_name as name, cls from class_dim union all select cls_key, cls from class_dim) group by name")
def class_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    dim = table(spark, sf, "class_dim")
    return remap.vocabulary(dim.select(F.col("cls_name").alias("name"), "cls"), dim.select(F.col("cls_key").alias("name"), "cls"))


@query("select case when cls < 13 then cls // 2 else 20 end as cls, count(*) as n from frame_dets where cls < 13 or cls in (15, 17) group by 1")
def class_schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A coarser list of classes: pairs become one, two others another, the rest is dropped."""
    to = {c: c // 2 for c in range(13)} | {15: 20, 17: 20}
    return remap.remap_by_index(table(spark, sf, "frame_dets"), to).groupBy("cls").agg(F.count("*").alias("n"))


@query("select d.cls, count(*) as n from frame_dets d join class_dim c using (cls) where c.cls_key in ('coil_leg', 'tube_fuse') group by d.cls")
def chosen_class_counts(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "class_dim").select(F.col("cls_key").alias("name"), "cls")
    return remap.chosen_classes(table(spark, sf, "frame_dets"), known, ["coil_leg", "tube_fuse"]).groupBy("cls").agg(F.count("*").alias("n"))


# ---- matching ----------------------------------------------------------------------------------------------------
#: greedy matches of b0 (driving) and b1, by a recursive step for each driving box of a frame and class
_GREEDY = f"""{_BOX}, a0 as (select * from b where annotator = {{0}}), a1 as (select * from b where annotator = {{1}}),
p as (select a.stem, a.cls, a.det_id r, c.det_id h, {_IOU} as iou from a0 a join a1 c on a.stem = c.stem and a.cls = c.cls),
n as (select stem, cls, r, row_number() over (partition by stem, cls order by r) k from (select distinct stem, cls, r from p where iou > 1e-12)),
g as (select distinct stem, cls, 0::bigint k, []::bigint[] used, null::bigint r, null::bigint h, null::double v from n
  union all select stem, cls, k, case when v >= 0.3 then list_append(used, h) else used end, r, h, v from (
    select g.stem, g.cls, n.k, g.used, n.r, arg_max(p.h, (p.iou, -p.h)) h, max(p.iou) v from g join n on n.stem = g.stem and n.cls = g.cls and n.k = g.k + 1
    left join p on p.r = n.r and p.stem = g.stem and p.iou > 1e-12 and not list_contains(g.used, p.h) group by g.stem, g.cls, n.k, g.used, n.r)),
m as (select stem, cls, r, h, v from g where v >= 0.3)"""
GREEDY_MATCH_SQL = f"with recursive {_GREEDY.format(0, 1)} select stem, r as ref_idx, h as hyp_idx, round(v, 6) as iou from m"
_SCORES = """t as (select case when grouping(cls) = 1 then null else cls end as cls, sum(tp) tp, sum(nr) nr, sum(nh) nh from (select cls, count(*) filter (k = 'm') tp, count(*) filter (k = 'r') nr, count(*) filter (k = 'h') nh
  from (select cls, 'm' k from m union all select cls, 'r' from {0} union all select cls, 'h' from {1}) group by cls) group by rollup(cls))"""
GREEDY_SCORES_SQL = f"""with recursive {_GREEDY.format(0, 1)}, {_SCORES.format('a0', 'a1')}
select cls, tp::bigint as tp, (nh - tp)::bigint as fp, (nr - tp)::bigint as fn, tp / greatest(nh, 1) as precision, tp / greatest(nr, 1) as recall,
  2 * (tp / greatest(nh, 1)) * (tp / greatest(nr, 1)) / greatest(tp / greatest(nh, 1) + tp / greatest(nr, 1), 1e-9) as f_score, (nh + nr - 2 * tp)::bigint as touch from t"""


REGISTER = {"greedy_match": GREEDY_MATCH_SQL, "greedy_match_scores": GREEDY_SCORES_SQL}  # queries of the boxes module
query.sql.update(REGISTER)


def _two(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, sf)
    return b.where("annotator = 0"), b.where("annotator = 1")


@query(f"""with recursive {_GREEDY.format(1, 0)}, {_SCORES.format('a0', 'a1')}, i as (select case when grouping(cls) = 1 then null else cls end as cls, median(v) med from m group by rollup(cls))
select t.cls, tp::bigint as tp, (nr - tp)::bigint as fp, (nh - tp)::bigint as fn, round((1 - (nh + nr - 2 * tp) / greatest(nh, 1)) * 100, 6) as saving_pct, round(0.3 * (nr - tp) + (nh - tp), 6) as cost, round(med, 6) as median_iou
from t left join i on t.cls is not distinct from i.cls""")
def prediction_match_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Matches driven by the predictions (annotator 1): hits, false and missed ones, work saved, weighted cost and the median
    overlap, per class and of all (null)."""
    truth, predicted = _two(spark, sf)
    m = match.greedy_matches(predicted, truth, "stem", "det_id", 0.3)
    out = match.prediction_scores(predicted, truth, m, "stem", "det_id")
    return out.select("cls", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("saving_pct", "cost", "median_iou")])


_VERDICTS = "w as (select stem, case when det_id % 3 = 0 then 'a' when det_id % 3 = 1 then 'b' else 'c' end who, max(cls % 2)::int v from frame_dets where stem is not null and cls is not null group by all)"


def _judgements(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "frame_dets").where("stem is not null and cls is not null")
    who = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.pmod("det_id", F.lit(3)) + 1).cast("int"))
    return d.groupBy("stem", who.alias("who")).agg(F.max(F.col("cls") % 2).alias("v"))


@query(f"with {_VERDICTS}, p as (select stem, count(*) m, count(distinct v) k from w group by stem) select count(*) as frames, count_if(k = 1) as agreed, round(count_if(k = 1) / count(*), 6) as rate from p where m = (select count(distinct who) from w)")
def verdict_agreement_all(spark: SparkSession, sf: str) -> DataFrame:
    return audits.verdict_agreement(_judgements(spark, sf), "stem", "who", "v")[0].withColumn("rate", F.round("rate", 6))


@query(f"with {_VERDICTS} select x.who as a, y.who as b, count(*) as frames, count_if(x.v = y.v) as agreed, round(count_if(x.v = y.v) / count(*), 6) as rate from w x join w y on x.stem = y.stem and x.who < y.who group by all")
def verdict_agreement_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return audits.verdict_agreement(_judgements(spark, sf), "stem", "who", "v")[1].withColumn("rate", F.round("rate", 6))


@query(f"with {_VERDICTS} select stem as frame, string_agg(who || ': ' || v, ' / ' order by who) as verdicts from w group by stem having count(distinct v) > 1 order by stem limit 10")
def verdict_disagreements(spark: SparkSession, sf: str) -> DataFrame:
    """The first ten frames whose annotators differ."""
    return audits.verdict_agreement(_judgements(spark, sf), "stem", "who", "v")[2].orderBy("frame").limit(10)


# ---- coarser views -------------------------------------------------------------------------------------------------
_COARSE = f"""{_PX}, f as (select vec_id, x // 2 x, y // 2 y, avg(t) t from e group by vec_id, x // 2, y // 2),
bb as (select *, greatest(0, round_even(u1, 0))::int a, greatest(0, round_even(v1, 0))::int b, least(8, round_even(u2, 0))::int c, least(8, round_even(v2, 0))::int d,
  greatest(0, round_even(u1 / 2, 0))::int a2, greatest(0, round_even(v1 / 2, 0))::int b2, least(4, round_even(u2 / 2, 0))::int c2, least(4, round_even(v2 / 2, 0))::int d2 from b0),
s as (select det_id, quantile_cont(t, 0.99) p from bb join e on e.vec_id = bb.vec_id and x >= a and x < c and y >= b and y < d where c - a >= 1 and d - b >= 1 group by det_id),
s2 as (select det_id, quantile_cont(t, 0.99) p, count(*) n from bb join f on f.vec_id = bb.vec_id and x >= a2 and x < c2 and y >= b2 and y < d2 where c2 - a2 >= 1 and d2 - b2 >= 1 group by det_id),
z as (select bb.stem, count(s.p) k1, count(s2.p) k2 from bb left join s using (det_id) left join s2 using (det_id) group by stem),
j as (select bb.cls, s2.p - s.p as dt, s2.n, (s.p >= 60) = (s2.p >= 60) ok from bb join z using (stem) join s using (det_id) join s2 using (det_id) where k1 = k2)"""


@query(f"with {_COARSE} select case when grouping(cls) = 1 then null else cls end as cls, count(*) as n, round(median(dt), 6) as median_dt, round(quantile_cont(abs(dt), 0.9), 6) as p90_dt, round(median(n), 6) as median_px, round(count_if(ok) * 100 / count(*), 6) as match_pct from j group by rollup(cls)")
def coarse_comparison(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of boxes on rasters against those on the same at half the resolution, per class and of all (null): the
    difference of p99 (median, and p90 of its size), pixels, and how often the grade stays. Frames in which a box has
    statistics in only one of the views are left out."""
    fine = _rasters(spark, sf)
    coarse = raster.mapped(fine, "raster", 8, 8, lambda a: raster.area_resize(a, 4, 4), "small").select("vec_id", "small")
    b = _small_boxes(spark, sf)
    half = b.withColumns({c: F.col(c) / 2 for c in ("x1", "y1", "x2", "y2")})
    one = boxstats.box_statistics(fine, b, "vec_id", "raster", 8, 8, least_side=1, least_px=1).select("det_id", "stem", "cls", "t_p99")
    two = boxstats.box_statistics(coarse, half, "vec_id", "small", 4, 4, least_side=1, least_px=1).select("det_id", F.col("t_p99").alias("p2"), F.col("n_px").alias("n2"))
    both = one.join(two, "det_id")
    even = both.groupBy("stem").agg(F.count("t_p99").alias("k1"), F.count("p2").alias("k2")).where("k1 = k2").select("stem")
    j = both.join(even, "stem", "left_semi").where("t_p99 is not null and p2 is not null").select(F.explode(F.array("cls", F.lit(None).cast("int"))).alias("cls"), (F.col("p2") - F.col("t_p99")).alias("dt"), F.abs(F.col("p2") - F.col("t_p99")).alias("size"), F.col("n2").cast("double").alias("n2"), ((F.col("t_p99") >= 60) == (F.col("p2") >= 60)).alias("ok"))
    out = j.groupBy("cls").agg(F.count("*").alias("n"), (F.count_if("ok") * 100 / F.count("*")).alias("match_pct"))
    for c, share, name in (("dt", 0.5, "median_dt"), ("size", 0.9, "p90_dt"), ("n2", 0.5, "median_px")):
        out = beside(out, quantiles(j, ["cls"], c, {name: share}), ["cls"])
    return out.select("cls", "n", *[F.round(c, 6).alias(c) for c in ("median_dt", "p90_dt", "median_px", "match_pct")])


# ---- rendering and patches -------------------------------------------------------------------------------------------
@query("with a as (select user_id, avg(value) amb from (select user_id, value, quantile_cont(value, 0.1) over (partition by user_id) q from events) where value <= q group by 1) select event_id, floor(greatest(0, least(255, (value - amb) / 60 * 255)))::int as grey from events join a using (user_id)")
def ambient_relative(spark: SparkSession, sf: str) -> DataFrame:
    """Values as grey, 0 at their group's ambient, 255 from 60 above it."""
    from calorgrid.operators.stats import ambient_by_percentile

    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    a = ambient_by_percentile(e, ["user_id"], "value")
    return e.join(a, "user_id").select("event_id", to_byte(F.col("value") - F.col("ambient"), F.lit(0.0), F.lit(60.0)).alias("grey"))


@query("with c as (select census_id, stem, case when isfinite(t_p99) then t_p99 end t from anomaly_census), m as (select stem, median(t) m from c group by stem) select census_id, round(coalesce(t, m), 6) as t from c left join m on c.stem is not distinct from m.stem")
def filled_with_median(spark: SparkSession, sf: str) -> DataFrame:
    """Values that are no numbers replaced by the median of their frame."""
    c = table(spark, sf, "anomaly_census").select("census_id", "stem", finite(F.col("t_p99")).alias("t"))
    m = c.groupBy("stem").agg(F.median("t").alias("m"))
    return beside(c, m, ["stem"]).select("census_id", F.round(filled(F.col("t"), F.col("m")), 6).alias("t"))


_HEX = "list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr({0}, i::int, 1)) - 1) * power(16, 8 - i)))::bigint"


@query(f"""with k as (select vec_id, j, md5(vec_id || '|' || j || '|0') h from embeddings, range(24) r(j)), n as (select vec_id, j, {_HEX.format('h')} as a, {_HEX.format('substr(h, 9, 8)')} as b, {_HEX.format('substr(h, 17, 8)')} as c from k),
w as (select vec_id, j, 1 + a % 4 as s, b % (8 - a % 4) as x, c % (8 - a % 4) as y from n), e as (select vec_id, i % 8 x, i // 8 y, embedding[i + 1]::double t from embeddings, range(64) r(i))
select vec_id, w.j::int as patch, w.x::int as x, w.y::int as y, w.s::int as side, round(quantile_cont(t, 0.99), 6) as t_p99, round(avg(t), 6) as mean from w join e using (vec_id)
where e.x >= w.x and e.x < w.x + s and e.y >= w.y and e.y < w.y + s and not (w.x < 2 and w.y < 1) and not (w.x + s > 6 and w.y + s > 6) group by all""")
def random_patches(spark: SparkSession, sf: str) -> DataFrame:
    """24 square patches of each raster, of a seeded place and side; those that touch hidden pixels are left out."""
    p = sampling.patches(table(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", 24, 8, 8, 1, 4, _HIDDEN)
    pixels = F.array_sort(boxstats.box_pixels(F.col("embedding"), [F.col("x"), F.col("y"), F.col("x") + F.col("side"), F.col("y") + F.col("side")], 8))
    return p.withColumn("v", pixels).select("vec_id", "patch", "x", "y", "side", F.round(boxstats.array_percentile(F.col("v"), 0.99), 6).alias("t_p99"), F.round(boxstats.array_mean(F.col("v")), 6).alias("mean"))


@query("select event_id, least(9, greatest(-1, floor(value / 50)))::int as bin, (5 / 0.25)::int as steps from events where value is not null")
def digitised(spark: SparkSession, sf: str) -> DataFrame:
    """Values as numbers of bins 50 wide; and how many steps of 0.25 make 5."""
    return table(spark, sf, "events").where("value is not null").select("event_id", F.least(F.lit(9), F.greatest(F.lit(-1), F.floor(F.col("value") / 50))).cast("int").alias("bin"), F.lit(int(5 / 0.25)).alias("steps"))


# ---- filters and flags -------------------------------------------------------------------------------------------------
@query("select frame_id from frame_report where (panel is null or panel not in ('P11', 'P12', 'P13')) and isfinite(t_max) and t_max >= 40")
def hot_outside_excluded_panels(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report")
    return f.where((F.col("panel").isNull() | ~F.col("panel").isin("P11", "P12", "P13")) & (finite(F.col("t_max")) >= 40)).select("frame_id")


@query("select det_id, coalesce(n_px < 200, false) and coalesce(t_max - t_p99 > 10, false) as spike from frame_dets")
def spike_flags(spark: SparkSession, sf: str) -> DataFrame:
    """A few hot pixels far above the rest: a small region whose maximum lies more than 10 over its p99."""
    d = table(spark, sf, "frame_dets")
    return d.select("det_id", (F.coalesce(F.col("n_px") < 200, F.lit(False)) & F.coalesce(F.col("t_max") - F.col("t_p99") > 10, F.lit(False))).alias("spike"))


@query("select cls, count(*) as n, string_agg(distinct panel, ',' order by panel) as panels from frame_dets where t_p99 >= 60 and isfinite(t_p99) group by cls order by n desc, cls limit 10")
def hot_classes(spark: SparkSession, sf: str) -> DataFrame:
    """Classes of hot detections by their number, with the panels they occur in."""
    d = table(spark, sf, "frame_dets").where(finite(F.col("t_p99")) >= 60)
    return d.groupBy("cls").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("panel")), ",").alias("panels")).orderBy(F.desc("n"), "cls").limit(10)


@query("select cls, count_if(verdict in ('abnormal', 'critical')) as bad, count(*) as n, dense_rank() over (order by count_if(verdict in ('abnormal', 'critical')) desc, cls nulls last)::int as place from anomaly_census group by cls")
def classes_by_bad(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "anomaly_census").groupBy("cls").agg(F.count_if(F.col("verdict").isin("abnormal", "critical")).alias("bad"), F.count("*").alias("n"))
    every = Window.partitionBy(F.lit("all"))  # of one row a class
    return n.withColumn("place", F.dense_rank().over(every.orderBy(F.desc("bad"), F.asc_nulls_last("cls"))))


# ---- checks ---------------------------------------------------------------------------------------------------------------
@query("""with h as (select doc_id::varchar as name, sha256(text) as have from documents where doc_id % 5 <> 0), m as (select doc_id::varchar as name, case when doc_id % 7 = 0 then 'x' else upper(sha256(text)) end as want from documents where doc_id % 11 <> 0)
select name, case when h.name is null then 'missing' when m.name is null then 'unlisted' when have = lower(want) then 'same' else 'changed' end as state from h full join m using (name)""")
def manifest_states(spark: SparkSession, sf: str) -> DataFrame:
    """Texts against a manifest of digests, with gaps in both and digests that differ."""
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("name"), "doc_id", "text")
    listed = d.where("doc_id % 11 <> 0").select("name", F.when(F.col("doc_id") % 7 == 0, "x").otherwise(F.upper(F.sha2("text", 256))).alias("sha256"))
    return audits.manifest_check(d.where("doc_id % 5 <> 0"), listed, "name", "text")


@query("select round(sum(score), 6) as score, round(sum(most), 6) as most, round(sum(score) * 100 / sum(most), 6) as share from (select verdict, count_if(t_max >= 60)::double score, count(*)::double most from frame_report group by verdict)")
def area_score(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "frame_report").groupBy("verdict").agg(F.count_if(F.col("t_max") >= 60).cast("double").alias("score"), F.count("*").cast("double").alias("most"))
    return audits.weighted_score(a, "score", "most").select(*[F.round(c, 6).alias(c) for c in ("score", "most", "share")])


@query("""with f as (select case when split is null then ' ' when verdict = 'critical' then 'mixed' else 'clear ' || coalesce(verdict, 'none') end as v, case when frame_id % 9 = 0 then 'other' else coalesce(verdict, 'none') end as l, case when frame_id % 13 = 0 then 'tired' else 'far' end as r from frame_report)
select count(*) as judged, count_if(starts_with(v, 'clear')) as distinguishable, count_if(starts_with(v, 'clear') and not ends_with(v, l)) as mismatches, count_if(starts_with(v, 'mixed')) as mixed, count_if(r not in ('far', 'dark')) as bad_reasons, round(count_if(starts_with(v, 'clear')) * 100 / count(*), 6) as pct from f where trim(v) <> ''""")
def review_form(spark: SparkSession, sf: str) -> DataFrame:
    """A review form (made of the frames): judged rows, distinguishable ones, labels that differ, reasons outside the list."""
    f = table(spark, sf, "frame_report")
    name = F.coalesce("verdict", F.lit("none"))
    form = f.select(
        F.when(F.col("split").isNull(), " ").when(F.col("verdict") == "critical", "mixed").otherwise(F.concat(F.lit("clear "), name)).alias("v"),
        F.when(F.col("frame_id") % 9 == 0, "other").otherwise(name).alias("l"), F.when(F.col("frame_id") % 13 == 0, "tired").otherwise("far").alias("r"),
    )
    return audits.form_scores(form, "v", "l", "r", ("far", "dark")).withColumn("pct", F.round("pct", 6))


@query("""with c as (select distinct stem from frame_report where stem is not null and frame_id % 3 <> 0), l as (select stem, count_if(conf > 0.9) n from frame_dets where stem is not null group by stem), k as (select distinct stem from anomaly_census where stem is not null and spike = 1)
select stem, 'unknown' as problem from (select stem from l union select stem from k) where stem not in (select stem from c) union all select stem, 'no record' from l where n = 0 and stem in (select stem from c) and stem not in (select stem from k)""")
def skip_problems(spark: SparkSession, sf: str) -> DataFrame:
    cases = table(spark, sf, "frame_report").where("stem is not null and frame_id % 3 <> 0").select("stem").distinct()
    labels = table(spark, sf, "frame_dets").where("stem is not null").groupBy("stem").agg(F.count_if(F.col("conf") > 0.9).alias("n"))
    skips = table(spark, sf, "anomaly_census").where("stem is not null and spike = 1").select("stem").distinct()
    return audits.skip_hygiene(cases, labels, skips, "stem", "n")


# ---- places, packages, unions ------------------------------------------------------------------------------------------------
@query("with r as (select lang, doc_id, row_number() over (partition by lang order by doc_id) - 1 i, count(*) over (partition by lang) n from documents) select lang, doc_id from r where i in (1, n // 8, n // 2, n * 7 // 8, n - 2)")
def five_places(spark: SparkSession, sf: str) -> DataFrame:
    """The second, those at an eighth, a half and seven eighths, and the last but one of each group."""
    d = windows.numbered(table(spark, sf, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"])
    j = beside(d, d.groupBy("lang").agg(F.count("*").alias("n")), ["lang"])
    n = F.col("n")
    return j.where(F.col("i").isin(1) | (F.col("i") == F.floor(n / 8)) | (F.col("i") == F.floor(n / 2)) | (F.col("i") == F.floor(n * 7 / 8)) | (F.col("i") == n - 2)).select("lang", "doc_id")


@query("""with f as (select stem, coalesce(min(source), '-') as owner, min(frame_id) id from frame_report where stem is not null group by stem), d as (select stem, count(*) n, max(conf) c from frame_dets where stem is not null group by stem)
select owner, count(*) as own, count_if(id % 10 = 0) as cross_frames, count_if(c >= 0.9) as human, count_if(c < 0.9) as predicted, count_if(d.stem is null) as empty, coalesce(sum(n), 0)::bigint as boxes from f left join d using (stem) group by owner""")
def package_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Per owner: own frames, those that another reviews, where their labels come from, boxes."""
    f = table(spark, sf, "frame_report").where("stem is not null").groupBy("stem").agg(F.coalesce(F.min("source"), F.lit("-")).alias("owner"), F.min("frame_id").alias("id"))
    d = table(spark, sf, "frame_dets").where("stem is not null").groupBy("stem").agg(F.count("*").alias("n"), F.max("conf").alias("c"))
    j = f.join(d, "stem", "left")
    return j.groupBy("owner").agg(F.count("*").alias("own"), F.count_if(F.col("id") % 10 == 0).alias("cross_frames"), F.count_if(F.col("c") >= 0.9).alias("human"), F.count_if(F.col("c") < 0.9).alias("predicted"), F.count_if(F.col("n").isNull()).alias("empty"), F.coalesce(F.sum("n"), F.lit(0)).alias("boxes"))


_SESSION = "array_to_string(string_split(stem, '_')[1:4], '_')"


@query(f"with s as (select distinct {_SESSION} session from frame_report where stem is not null), l as (select distinct {_SESSION} session from frame_dets where stem is not null union select distinct {_SESSION} from anomaly_census where stem is not null) select session from s where session not in (select session from l)")
def sessions_not_started(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions that have neither labels nor census rows."""
    s = lambda t: table(spark, sf, t).where("stem is not null").select(session_of(F.col("stem")).alias("session"))
    return s("frame_report").distinct().join(s("frame_dets").unionByName(s("anomaly_census")), "session", "left_anti")


@query(f"select frame_id, case when {_SESSION} = (select min({_SESSION}) from frame_report where stem is not null) then 'val' else 'train' end as split from frame_report where stem is not null")
def fixed_session_split(spark: SparkSession, sf: str) -> DataFrame:
    """One session, here the first, is for validation."""
    f = table(spark, sf, "frame_report").where("stem is not null").select("frame_id", session_of(F.col("stem")).alias("session"))
    first = f.agg(F.min("session").alias("_first"))  # one row
    return f.join(F.broadcast(first), F.lit(True)).select("frame_id", F.when(F.col("session") == F.col("_first"), "val").otherwise("train").alias("split"))


@query("""with f as (select stem, min(frame_id) frame_id from frame_report where stem is not null group by stem), d as (select stem, count(*) n, max(cls) c from frame_dets where stem is not null group by stem), t as (select stem, count(*) m, max(case when isfinite(t_p99) then t_p99 end) t from anomaly_census where stem is not null group by stem)
select f.stem, frame_id, n, m, round(t, 6) as t from f join d using (stem) join t using (stem)""")
def frames_with_labels_and_census(spark: SparkSession, sf: str) -> DataFrame:
    """Three tables by their frame; each is reduced to a row a frame before it is joined."""
    f = table(spark, sf, "frame_report").where("stem is not null").groupBy("stem").agg(F.min("frame_id").alias("frame_id"))
    d = table(spark, sf, "frame_dets").where("stem is not null").groupBy("stem").agg(F.count("*").alias("n"))
    t = table(spark, sf, "anomaly_census").where("stem is not null").groupBy("stem").agg(F.count("*").alias("m"), F.round(F.max(finite(F.col("t_p99"))), 6).alias("t"))
    return f.join(d, "stem").join(t, "stem").select("stem", "frame_id", "n", "m", "t")


@query("""with a as (select cls, count(*) n from frame_dets group by cls), s as (select cls, max(x) spread from (select stem, cls, max(t_p99) - min(t_p99) x from frame_dets where isfinite(t_p99) group by all having count(*) >= 2) group by cls) select a.cls, n, round(spread, 6) as spread from a left join s on a.cls is not distinct from s.cls""")
def enriched_classes(spark: SparkSession, sf: str) -> DataFrame:
    """One aggregate of the classes joined to another: their numbers, and the largest spread within a frame where it is known."""
    d = table(spark, sf, "frame_dets")
    a = d.groupBy("cls").agg(F.count("*").alias("n"))
    s = d.where(finite(F.col("t_p99")).isNotNull()).groupBy("stem", "cls").agg(F.count("*").alias("k"), (F.max("t_p99") - F.min("t_p99")).alias("x")).where("k >= 2").groupBy(F.col("cls").alias("c")).agg(F.max("x").alias("spread"))
    return a.join(s, F.col("cls").eqNullSafe(F.col("c")), "left").select("cls", "n", F.round("spread", 6).alias("spread"))


@query("select string_split(stem, '_')[3] as panel, count(*) as n, string_agg(frame_id::varchar, ',' order by frame_id) as frames from frame_report where worst_temp >= 120 and stem is not null group by 1")
def accepted_by_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted rows (the hottest) gathered by the panel token of their stem."""
    f = table(spark, sf, "frame_report").where("worst_temp >= 120 and stem is not null")
    return f.groupBy(F.get(F.split("stem", "_"), 2).alias("panel")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("frame_id")), lambda x: x.cast("string")), ",").alias("frames"))


@query("with o as (select o_custkey, o_orderkey, o_totalprice from orders) select o_custkey, o_orderkey, rank() over (order by o_totalprice desc, o_orderkey)::int as place from o order by o_totalprice desc, o_orderkey limit 25")
def best_models(spark: SparkSession, sf: str) -> DataFrame:
    """Runs ranked by their score; the first 25."""
    top = table(spark, sf, "orders").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)
    every = Window.partitionBy(F.lit("all"))  # of 25 rows
    return top.select("o_custkey", "o_orderkey", F.rank().over(every.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"))


@query("with w(lo, hi) as (values (0.0, 100.0), (0.0, 250.0), (20.0, 120.0)), e as (select lo, hi, sqrt(avg(power(abs(value - (greatest(0, least(255, round_even((value - lo) / (hi - lo) * 255, 0))) / 255 * (hi - lo) + lo)), 2))) r from events, w where value is not null group by all) select arg_min(lo, (r, lo, hi))::double as lo, arg_min(hi, (r, lo, hi))::double as hi from e")
def best_window(spark: SparkSession, sf: str) -> DataFrame:
    """The window of the sweep with the least error."""
    from calorgrid.operators import stats

    out = stats.window_sweep(table(spark, sf, "events").select("value"), "value", ((0, 100), (0, 250), (20, 120)))
    return out.agg(F.min_by(F.struct("lo", "hi"), F.struct("rmse", "lo", "hi")).alias("w")).select("w.lo", "w.hi")


@query("select count(*) as rules, count_if(contains(panels, ',')) as undetermined from class_dim")
def undetermined_rules(spark: SparkSession, sf: str) -> DataFrame:
    """How many entries of a rule table carry a mark in their source text."""
    return table(spark, sf, "class_dim").agg(F.count("*").alias("rules"), F.count_if(F.contains("panels", F.lit(","))).alias("undetermined"))


@query(f"""with k as (select stem, min(frame_id) id from frame_report where stem is not null group by stem), n as (select stem, id, j, md5(id || '|' || j || '|0') h, 2 + {_HEX.format("md5(id || '|n|0')")} % 3 m from k, range(4) r(j))
select stem, j::int as box_idx, ({_HEX.format('h')} % 26)::int as cls, round(0.2 + {_HEX.format('substr(h, 9, 8)')} % 600 / 1000.0, 6)::double as cx, round(0.2 + {_HEX.format('substr(h, 17, 8)')} % 600 / 1000.0, 6)::double as cy from n where j < m""")
def synthetic_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Two to four made-up boxes a frame, by hashes: labels for a smoke run."""
    k = table(spark, sf, "frame_report").where("stem is not null").groupBy("stem").agg(F.min("frame_id").alias("id"))
    return sampling.synthetic_labels(k, "stem", "id", 26).select("stem", "box_idx", "cls", F.round("cx", 6).alias("cx"), F.round("cy", 6).alias("cy"))


@query(f"with {_BOX} select stem, det_id, cls from b where conf >= 0.2 and conf < 0.9 and cls in (2, 5, 7) and not exists (select 1 from b h where h.stem = b.stem and h.conf >= 0.9)")
def proposals(spark: SparkSession, sf: str) -> DataFrame:
    """Detections of some classes, neither sure nor weak, on frames without a sure label: to be proposed for review."""
    b = boxes(spark, sf)
    sure = b.where("conf >= 0.9").select("stem").distinct()
    return b.where("conf >= 0.2 and conf < 0.9 and cls in (2, 5, 7)").join(sure, "stem", "left_anti").select("stem", "det_id", "cls")


@query("select frame_id, row_number() over (order by coalesce(source, ''), coalesce(panel, ''), stem nulls first, frame_id) as place from frame_report where verdict = 'critical' order by place limit 50")
def review_order(spark: SparkSession, sf: str) -> DataFrame:
    """The first 50 frames to review: by owner, panel, stem."""
    f = table(spark, sf, "frame_report").where("verdict = 'critical'").select("frame_id", F.coalesce("source", F.lit("")).alias("s"), F.coalesce("panel", F.lit("")).alias("p"), "stem")
    order = [F.col("s"), F.col("p"), F.asc_nulls_first("stem"), F.col("frame_id")]
    every = Window.partitionBy(F.lit("all"))  # of 50 rows
    return f.orderBy(*order).limit(50).select("frame_id", F.row_number().over(every.orderBy(*order)).cast("long").alias("place"))


# ---- the rest of the inventory -----------------------------------------------------------------------------------------------------
@query(f"""with {_BOX}, t as (select det_id, x1 / 1.53 - 44 a, y1 / 1.53 - 46 b, x2 / 1.53 - 44 c, y2 / 1.53 - 46 d from b), k as (select *, greatest(0, a) e, greatest(0, b) f, least(320, c) g, least(240, d) h from t),
q as (select g - e >= 2 and h - f >= 2 and (g - e) * (h - f) >= 0.35 * (c - a) * (d - b) as kept from k) select count(*) filter (kept) as kept, count(*) filter (not kept) as dropped from q""")
def clip_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How many boxes are kept and dropped when they are moved to the infrared frame and clipped."""
    moved = geometry.visual_box_to_ir([F.col(c) for c in ("x1", "y1", "x2", "y2")])
    return boxes(spark, sf).select(moved.isNotNull().alias("kept")).agg(F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("dropped"))


@query("with t as (select user_id, max(value) t_max, quantile_cont(value, 0.999) p999, median(value) t_med from events group by 1) select user_id, t_max, round(p999, 6) as t_p999, round(t_med, 6) as t_med, count_if(value >= t_max - 5) as n_near, round(count_if(value >= t_max - 5) * 100 / count(value), 6) as near_pct from events join t using (user_id) group by user_id, t_max, p999, t_med")
def frame_extremes(spark: SparkSession, sf: str) -> DataFrame:
    from calorgrid.operators import stats

    out = stats.frame_statistics(table(spark, sf, "events").select("user_id", "value"), ["user_id"], "value")
    return out.select("user_id", "t_max", "n_near", *[F.round(c, 6).alias(c) for c in ("t_p999", "t_med", "near_pct")])


@query("""with f as (select coalesce(panel, '(none)') p, t_max - t_med x from frame_report where isfinite(t_max) and isfinite(t_med))
select case when grouping(p) = 1 then '(all)' else p end as panel, count(*) n, round(quantile_cont(x, 0.5), 6) p50, round(quantile_cont(x, 0.99), 6) p99, round(max(x), 6) most from f group by rollup(p)""")
def rise_over_median_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """The rollup of rises by their other definition: over the frame's median instead of its ambient."""
    from calorgrid.operators import stats

    f = table(spark, sf, "frame_report").select("panel", (finite(F.col("t_max")) - finite(F.col("t_med"))).alias("x")).where("x is not null")
    f = stats.with_all(f, "panel")
    out = beside(f.groupBy("panel").agg(F.count("*").alias("n"), F.max("x").alias("most")), quantiles(f, ["panel"], "x", {"p50": 0.5, "p99": 0.99}), ["panel"])
    return out.select("panel", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p99", "most")])


@query("select stem, count(*) as n, count(distinct lower(trim(split))) as splits from frame_report where stem is not null group by stem having count(*) > 1 and count(distinct lower(trim(split))) > 1")
def stems_in_several_splits(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").where("stem is not null")
    return f.groupBy("stem").agg(F.count("*").alias("n"), F.countDistinct(F.lower(F.trim("split"))).alias("splits")).where("n > 1 and splits > 1")


@query("with r as (select panel, frame_id, row_number() over (partition by panel order by md5(frame_id::varchar || '|0'), frame_id) k from frame_report where panel is not null) select panel, frame_id from r where k = 1")
def one_per_panel(spark: SparkSession, sf: str) -> DataFrame:
    """A member of each panel, drawn by a seeded hash."""
    return sampling.per_group(table(spark, sf, "frame_report").where("panel is not null").select("panel", "frame_id"), ["panel"], ["frame_id"], 1)


@query(f"""with {_BOX}, p as (select a.cls x, c.cls y from b a join b c on a.stem = c.stem and a.annotator = 0 and c.annotator = 1 where {_IOU} >= 0.1), n as (select x, y, count(*) n from p group by all),
t as (select sum(n) t, coalesce(sum(n) filter (x = y), 0) s from n), c as (select coalesce(sum(u.n * v.n), 0) c from (select x, sum(n) n from n group by x) u join (select y, sum(n) n from n group by y) v on x = y)
select t::bigint as n, round(s / t, 6) as agreement, round((s / t - c / (t * t)) / (1 - c / (t * t)), 6) as kappa from t, c""")
def matched_kappa(spark: SparkSession, sf: str) -> DataFrame:
    """Cohen's kappa of the classes that two annotators gave to boxes that overlap."""
    a, b = _two(spark, sf)
    p = match.overlapping(a, b, "stem", 0.1, None).select(F.col("a.cls").alias("x"), F.col("b.cls").alias("y"))
    return match.kappa(p, "x", "y").select("n", F.round("agreement", 6).alias("agreement"), F.round("kappa", 6).alias("kappa"))


@query(f"with {_BOX}, f as (select distinct stem from frame_report where stem is not null), k as (select stem, count(*) n from b group by stem) select stem, coalesce(n, 0) as lines from f left join k using (stem)")
def label_texts_with_empty(spark: SparkSession, sf: str) -> DataFrame:
    """Label texts of all frames of the index, empty ones kept: how many lines each has."""
    s = geometry.shares(*[F.col(c) for c in ("x1", "y1", "x2", "y2")], 320, 240)
    b = boxes(spark, sf).select("stem", "det_id", "cls", *[c.alias(n) for c, n in zip(s, ("cx", "cy", "w", "h"), strict=True)])
    frames = table(spark, sf, "frame_report").where("stem is not null").select("stem").distinct()
    texts = label_texts(b, "stem", "det_id", keep=frames)
    return texts.select("stem", (F.size(F.split("text", "\n")) - 1).cast("long").alias("lines"))


# ---- near codes that have neighbours -------------------------------------------------------------------------------------------
@query("""with e as (select vec_id, list_transform(embedding[1:16], lambda x: x::double) v from embeddings), c as (select vec_id, list_sum(list_transform(range(16), lambda i: case when v[i + 1] > list_avg(v) then 1::bigint << i::int else 0::bigint end))::bigint c from e),
k as (select c, min(vec_id) id from c group by c) select a.id as id_a, b.id as id_b, bit_count(xor(a.c, b.c))::int as distance from k a join k b on a.id < b.id where bit_count(xor(a.c, b.c)) <= 2""")
def near_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of representatives of 16-bit codes (signs of the first 16 values) within two bits."""
    from calorgrid.operators.similarity import near_hashes, sign_hash

    e = table(spark, sf, "embeddings").select("vec_id", F.slice("embedding", 1, 16).alias("v")).select("vec_id", sign_hash("v", 16).alias("code"))
    return near_hashes(e, "vec_id", "code", 2, 16)

