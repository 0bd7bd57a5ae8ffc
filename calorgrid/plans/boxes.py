"""Queries on boxes and labels: geometry, overlap joins, matching, agreement, label texts."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calorgrid.functions import geometry as g
from calorgrid.functions.keys import panel_key
from calorgrid.operators import match, sampling
from calorgrid.operators.exact import quantiles
from calorgrid.operators.rowparse import parse_lines
from calorgrid.operators.stats import beside
from calorgrid.plans.problems import LINES_SQL
from calorgrid.plans.registry import Registry
from calorgrid.sources.labels import boxes_of_text
from calorgrid.sources.sinks import annotation_xml, label_texts
from calorgrid.sources.tables import table

query = Registry()


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Detections as boxes; the parity of the id stands for the annotator."""
    d = table(spark, sf, "frame_dets").select("det_id", "stem", "cls", "conf", *[F.col(c).cast("double").alias(c) for c in ("x1", "y1", "x2", "y2")])
    return d.where("stem is not null and cls is not null and x2 > x1 and y2 > y1").withColumn("annotator", F.pmod(F.col("det_id"), F.lit(2)).cast("int"))


def _xy() -> list:
    return [F.col(c) for c in ("x1", "y1", "x2", "y2")]


_BOX = "b as (select det_id, stem, cls, conf, x1, y1, x2, y2, (det_id % 2)::int annotator from frame_dets where stem is not null and cls is not null and x2 > x1 and y2 > y1)"
_IOU = """greatest(0, least(a.x2, c.x2) - greatest(a.x1, c.x1)) * greatest(0, least(a.y2, c.y2) - greatest(a.y1, c.y1)) /
 greatest((a.x2 - a.x1) * (a.y2 - a.y1) + (c.x2 - c.x1) * (c.y2 - c.y1) - greatest(0, least(a.x2, c.x2) - greatest(a.x1, c.x1)) * greatest(0, least(a.y2, c.y2) - greatest(a.y1, c.y1)), 1e-9)"""


@query(f"with {_BOX} select cls, count(*) n, round(median(x2 - x1), 6) w, round(median(y2 - y1), 6) h, round(median((x2 - x1) * (y2 - y1) / 768), 6) area_pct, round(median((x2 - x1) / greatest(y2 - y1, 1e-9)), 6) ratio, count_if(x2 - x1 < 8 or y2 - y1 < 8) small, count_if((x2 - x1) * (y2 - y1) / 768 > 30) large from b group by cls")
def box_geometry(spark: SparkSession, sf: str) -> DataFrame:
    w, h, share, ratio = g.shape(_xy())
    b = boxes(spark, sf).select("cls", w.alias("w"), h.alias("h"), share.alias("area_pct"), ratio.alias("ratio"))
    out = b.groupBy("cls").agg(F.count("*").alias("n"), F.count_if((F.col("w") < 8) | (F.col("h") < 8)).alias("small"), F.count_if(F.col("area_pct") > 30).alias("large"))
    # the four columns of a class as four keys, so that one pass finds all medians
    long = b.select("cls", F.inline(F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).alias("x")) for c in ("w", "h", "area_pct", "ratio")])))
    middle = quantiles(long, ["cls", "what"], "x", {"m": 0.5}).groupBy("cls").pivot("what", ["w", "h", "area_pct", "ratio"]).agg(F.round(F.first("m"), 6))
    return beside(out, middle, ["cls"])


@query(f"""with {_BOX}, t as (select det_id, x1 / 1.53 - 44 a, y1 / 1.53 - 46 b, x2 / 1.53 - 44 c, y2 / 1.53 - 46 d from b), k as (select *, greatest(0, a) e, greatest(0, b) f, least(320, c) g, least(240, d) h from t)
select det_id, round(e, 6) x1, round(f, 6) y1, round(g, 6) x2, round(h, 6) y2 from k where g - e >= 2 and h - f >= 2 and (g - e) * (h - f) >= 0.35 * (c - a) * (d - b)""")
def box_affine_clip(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf).select("det_id", g.visual_box_to_ir(_xy()).alias("k")).where("k is not null")
    return b.select("det_id", *[F.round(f"k.{c}", 6).alias(c) for c in ("x1", "y1", "x2", "y2")])


@query(f"with {_BOX}, r(a, b, c, d) as (values (302, 0, 318, 240), (276, 2, 318, 27), (276, 212, 318, 237), (2, 2, 100, 27), (2, 217, 58, 237)), o as (select det_id, sum(greatest(0, least(x2, c) - greatest(x1, a)) * greatest(0, least(y2, d) - greatest(y1, r.b))) / any_value(greatest((x2 - x1) * (y2 - y1), 1e-9)) s from b, r group by det_id) select det_id, round(s, 6) as osd, s < 0.4 as kept from o")
def osd_overlap(spark: SparkSession, sf: str) -> DataFrame:
    o = g.osd_overlap(_xy())
    return boxes(spark, sf).select("det_id", F.round(o, 6).alias("osd"), (o < 0.4).alias("kept"))


@query(f"with {_BOX} select det_id, greatest(0, round_even(x1 * 1.1, 0))::int a, least(320, round_even(x2 * 1.1, 0))::int b, greatest(0, trunc(x1 * 1.1))::int c, least(320, trunc(x2 * 1.1))::int d, round_even((x1 + x2) / 640 * 1e6, 0) / 1e6 cx, round_even((x2 - x1) / 320 * 1e6, 0) / 1e6 w from b")
def pixel_windows(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf)
    moved = [F.col(c) * 1.1 for c in ("x1", "y1", "x2", "y2")]
    even, cut = g.pixel_window(moved, 320, 240), g.pixel_window(moved, 320, 240, "truncate")
    share = g.shares(*_xy(), 320, 240)
    return b.select("det_id", even[0].alias("a"), even[2].alias("b"), cut[0].alias("c"), cut[2].alias("d"), (F.rint(share[0] * 1e6) / 1e6).alias("cx"), (F.rint(share[2] * 1e6) / 1e6).alias("w"))


@query(f"with {_BOX}, p as (select a.det_id id_a, c.det_id id_b, a.cls = c.cls same, {_IOU} as iou from b a join b c on a.stem = c.stem and a.det_id < c.det_id) select id_a, id_b, same, round(iou, 6) as iou from p where iou >= 0.3")
def iou_pairs(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf)
    p = match.overlapping(b, b, "stem", 0.3, None).where("a.det_id < b.det_id")
    return p.select(F.col("a.det_id").alias("id_a"), F.col("b.det_id").alias("id_b"), (F.col("a.cls") == F.col("b.cls")).alias("same"), F.round("iou", 6).alias("iou"))


@query(f"with {_BOX}, p as (select least(a.cls, c.cls) cls_a, greatest(a.cls, c.cls) cls_b, {_IOU} as iou from b a join b c on a.stem = c.stem and a.cls <> c.cls and a.annotator = 0 and c.annotator = 1) select cls_a, cls_b, count(*) n from p where iou >= 0.1 group by all")
def class_confusion(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf)
    return match.confusion(match.overlapping(b.where("annotator = 0"), b.where("annotator = 1"), "stem", 0.1, False))


@query(f"with {_BOX} select distinct a.det_id from b a join b c on a.stem = c.stem and a.cls = c.cls and a.det_id > c.det_id where {_IOU} >= 0.5")
def duplicate_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes that repeat an earlier one of their class in their frame."""
    b = boxes(spark, sf)
    return match.overlapping(b, b, "stem", 0.5).where("a.det_id > b.det_id").select(F.col("a.det_id").alias("det_id")).distinct()


def _two(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    b = boxes(spark, sf)
    return b.where("annotator = 0"), b.where("annotator = 1")


@query()
def greedy_match(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two(spark, sf)
    return match.greedy_matches(a, b, "stem", "det_id", 0.3).withColumn("iou", F.round("iou", 6))


@query()
def greedy_match_scores(spark: SparkSession, sf: str) -> DataFrame:
    a, b = _two(spark, sf)
    return match.match_scores(a, b, match.greedy_matches(a, b, "stem", "det_id", 0.3), "stem", "det_id")


@query(f"with {_BOX}, n as (select annotator, count(*) n, count(distinct stem) frames from b group by 1) select annotator, n, round(n / frames, 6) per_frame, (max(n) over () - min(n) over ()) / max(n) over () > 0.1 as uneven from n")
def annotator_counts(spark: SparkSession, sf: str) -> DataFrame:
    n = boxes(spark, sf).groupBy("annotator").agg(F.count("*").alias("n"), F.countDistinct("stem").alias("frames"))
    every = Window.partitionBy(F.lit("all"))  # of one row an annotator
    top = F.max("n").over(every)
    return n.select("annotator", "n", F.round(F.col("n") / F.col("frames"), 6).alias("per_frame"), ((top - F.min("n").over(every)) / top > 0.1).alias("uneven"))


@query(f"with {_BOX} select stem from b group by stem having count(distinct annotator) = 2")
def common_frames(spark: SparkSession, sf: str) -> DataFrame:
    return match.common_frames(boxes(spark, sf), "stem", "annotator")


@query(f"with {_BOX}, w as (select stem, annotator, max(cls) v from b group by all), s as (select stem, count(distinct v) k, count(*) m from w group by stem having count(*) = 2) select count(*) frames, count_if(k = 1) agreed, round(count_if(k = 1) / count(*), 6) rate from s")
def worst_agreement(spark: SparkSession, sf: str) -> DataFrame:
    """How often both annotators' worst (here: highest) class of a frame is the same."""
    w = boxes(spark, sf).groupBy("stem", "annotator").agg(F.max("cls").alias("v"))
    s = w.groupBy("stem").agg(F.countDistinct("v").alias("k"), F.count("*").alias("m")).where("m = 2")
    return s.agg(F.count("*").alias("frames"), F.count_if(F.col("k") == 1).alias("agreed"), F.round(F.count_if(F.col("k") == 1) / F.count("*"), 6).alias("rate"))


@query("with d as (select stem, min(case when over_range then 'high' when t_max is not null then 'normal' end) a, min(case when t_p99 > 60 then 'high' when t_p99 is not null then 'normal' end) b from frame_dets group by stem), n as (select a, b, count(*) n from d where a is not null and b is not null group by all), t as (select sum(n) t, sum(case when a = b then n else 0 end) s from n), c as (select sum(x.n * y.n) c from (select a, sum(n) n from n group by a) x join (select b, sum(n) n from n group by b) y on a = b) select t as n, round(s / t, 6) agreement, round((s / t - coalesce(c, 0) / (t * t)) / (1 - coalesce(c, 0) / (t * t)), 6) kappa from t, c")
def kappa(spark: SparkSession, sf: str) -> DataFrame:
    a = F.when(F.col("over_range"), "high").when(F.col("t_max").isNotNull(), "normal")
    b = F.when(F.col("t_p99") > 60, "high").when(F.col("t_p99").isNotNull(), "normal")
    d = table(spark, sf, "frame_dets").groupBy("stem").agg(F.min(a).alias("a"), F.min(b).alias("b"))
    return match.kappa(d, "a", "b").select("n", F.round("agreement", 6).alias("agreement"), F.round("kappa", 6).alias("kappa"))


#: of a list of boxes the first pair (i, j) that joins, in the order of the list
_PAIR = """list_filter(flatten(list_transform(range(1, len(l) + 1), lambda i: list_transform(range(i + 1, len(l) + 1), lambda j: {'i': i, 'j': j}))), lambda p:
  l[p.i].cls = l[p.j].cls and (least(l[p.i].x2, l[p.j].x2) - greatest(l[p.i].x1, l[p.j].x1)) / greatest(least(l[p.i].x2 - l[p.i].x1, l[p.j].x2 - l[p.j].x1), 1e-9) >= 0.6
  and greatest(l[p.i].y1, l[p.j].y1) - least(l[p.i].y2, l[p.j].y2) <= 40)[1]"""


@query(f"""with recursive {_BOX}, s as (select stem, list({{'id': det_id, 'cls': cls, 'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2}} order by det_id) l from b where cls % 5 = 0 group by stem),
g as (select stem, 0 as step, l, {_PAIR} as p from s union all select stem, step, l, {_PAIR} as p from (
  select stem, step + 1 as step, list_append(list_filter(l, lambda x, k: k <> p.i and k <> p.j), {{'id': least(l[p.i].id, l[p.j].id), 'cls': l[p.i].cls, 'x1': least(l[p.i].x1, l[p.j].x1), 'y1': least(l[p.i].y1, l[p.j].y1),
    'x2': greatest(l[p.i].x2, l[p.j].x2), 'y2': greatest(l[p.i].y2, l[p.j].y2)}}) as l from g where p is not null)),
f as (select stem, unnest(l) as x from g where p is null)
select stem, x.id as det_id, x.cls as cls, x.x1 as x1, x.y1 as y1, x.x2 as x2, x.y2 as y2 from f union all select stem, det_id, cls, x1, y1, x2, y2 from b where cls % 5 <> 0""")
def split_box_merge(spark: SparkSession, sf: str) -> DataFrame:
    return match.merge_split_boxes(boxes(spark, sf), "stem", "det_id", list(range(0, 26, 5)))


@query(f"with {_BOX} select stem, string_agg(printf('%d %.6f %.6f %.6f %.6f', cls, round_even((x1 + x2) / 640 * 1e6, 0) / 1e6, round_even((y1 + y2) / 480 * 1e6, 0) / 1e6, round_even((x2 - x1) / 320 * 1e6, 0) / 1e6, round_even((y2 - y1) / 240 * 1e6, 0) / 1e6), chr(10) order by det_id) || chr(10) as text from b group by stem")
def label_text(spark: SparkSession, sf: str) -> DataFrame:
    return label_texts(_shares(spark, sf), "stem", "det_id")


def _shares(spark: SparkSession, sf: str) -> DataFrame:
    s = g.shares(*_xy(), 320, 240)
    return boxes(spark, sf).select("stem", "det_id", "cls", *[c.alias(n) for c, n in zip(s, ("cx", "cy", "w", "h"), strict=True)])


@query(f"with {_BOX}, r as (select stem, row_number() over (partition by stem order by det_id) - 1 i, cls, x1, y1, x2, y2 from b) select stem, i::int as box_idx, cls, round_even((x1 + x2) / 640 * 1e6, 0) / 1e6 cx, round_even((y1 + y2) / 480 * 1e6, 0) / 1e6 cy, round_even((x2 - x1) / 320 * 1e6, 0) / 1e6 w, round_even((y2 - y1) / 240 * 1e6, 0) / 1e6 h from r")
def label_text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Written as label texts and read back."""
    return boxes_of_text(label_texts(_shares(spark, sf), "stem", "det_id"), "stem", "text", True)


@query("with r as (select feed, count(*) n, count_if(raw is null or trim(raw) = '') blank from label_lines group by feed) select feed, n, blank from r")
def label_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "label_lines").groupBy("feed").agg(F.count("*").alias("n"), F.count_if(F.col("raw").isNull() | (F.trim("raw") == "")).alias("blank"))


@query(f"""with {LINES_SQL} select file_name, count(*) as records, count(*) filter (reason is null) as boxes, count(*) filter (reason = 'quoting') as quoting, count(*) filter (reason = 'columns') as columns, count(*) filter (reason = 'value') as value,
  count(*) filter (reason is null and cls in (23, 24, 25)) as discouraged from r join label_lines using (line_id) group by file_name""")
def label_ingest_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Per file: records, loaded boxes, bad ones by reason, discouraged classes."""
    lines = table(spark, sf, "label_lines")
    p = parse_lines(lines, repairs=False, carried=["file_name"])
    bad = [F.count_if(F.col("reason") == r).alias(r) for r in ("quoting", "columns", "value")]
    return p.groupBy("file_name").agg(F.count("*").alias("records"), F.count_if(F.col("reason").isNull()).alias("boxes"), *bad, F.count_if(F.col("cls").isin(23, 24, 25)).alias("discouraged"))


@query("with b as (select stem, count(*) k from frame_dets where stem is not null group by stem) select k as boxes, count(*) frames from b group by k")
def boxes_per_frame(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "frame_dets").where("stem is not null").groupBy("stem").agg(F.count("*").alias("boxes")).groupBy("boxes").agg(F.count("*").alias("frames"))


@query(f"""with {_BOX} select stem, '<image name="' || stem || '" width="320" height="240">' || string_agg('<box label="class ' || cls || '" occluded="0" source="auto" xtl="' || printf('%.2f', least(320.0, greatest(0.0, x1))) || '" ytl="' || printf('%.2f', least(240.0, greatest(0.0, y1))) ||
  '" xbr="' || printf('%.2f', least(320.0, greatest(0.0, x2))) || '" ybr="' || printf('%.2f', least(240.0, greatest(0.0, y2))) || '" z_order="0"></box>', '' order by det_id) || '</image>' as xml from b group by stem""")
def annotation_elements(spark: SparkSession, sf: str) -> DataFrame:
    b = boxes(spark, sf).withColumn("label", F.concat(F.lit("class "), F.col("cls").cast("string")))
    return annotation_xml(b, "stem", "det_id", "label", 320, 240)


_UNIT = "list_sum(list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', substr(md5(det_id || '|{0}0'), i::int, 1)) - 1) * power(16, 8 - i))) / 4294967296 * 2 - 1"


@query(f"""with {_BOX}, u as (select *, {_UNIT.format('x1')} as du, {_UNIT.format('y1')} as dv from b), m(amount) as (values (1.6), (6.4), (16.0)),
a as (select amount::double amount, x1, y1, x2, y2, x1 + du * amount u1, y1 + dv * amount v1, x2 + du * amount u2, y2 + dv * amount v2 from u, m),
i as (select *, greatest(0, least(x2, u2) - greatest(x1, u1)) * greatest(0, least(y2, v2) - greatest(y1, v1)) as s from a)
select amount, count(*) as n, round(median(s / greatest((x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1) - s, 1e-9)), 6) as median_iou from i group by amount""")
def jitter_sensitivity(spark: SparkSession, sf: str) -> DataFrame:
    """Overlap of each box with itself after it is moved by up to 1.6, 6.4 or 16 pixels, per amount."""
    b = boxes(spark, sf).select("det_id", "x1", "y1", "x2", "y2")

    def overlap(amount: float) -> Column:
        u, v = (F.col(c) + sampling.jitter(c, "det_id") * amount for c in ("x1", "y1"))
        return g.iou(_xy(), [u, v, u + F.col("x2") - F.col("x1"), v + F.col("y2") - F.col("y1")])

    each = b.select(F.inline(F.array(*[F.struct(F.lit(a).alias("amount"), overlap(a).alias("iou")) for a in (1.6, 6.4, 16.0)])))
    n = each.groupBy("amount").agg(F.count("*").alias("n"))
    return n.join(quantiles(each, ["amount"], "iou", {"median_iou": 0.5}), "amount").withColumn("median_iou", F.round("median_iou", 6))


@query("with p as (select d.cls, trim(x) panel from (select cls, unnest(string_split(panels, ',')) x from class_dim) d) select det_id, count(p.cls) > 0 as allowed from frame_dets f left join p on f.cls = p.cls and f.panel = p.panel group by det_id")
def class_whitelist(spark: SparkSession, sf: str, named: Callable[[Column], Column] | None = None) -> DataFrame:
    """Whether a detection's class belongs to the cabinet's panel, by the bridge table of classes and panels.

    Panels are compared as written, as in the SQL, or both sides by ``named``."""
    p = table(spark, sf, "class_dim").select(F.col("cls").alias("c"), F.explode(F.split("panels", ",")).alias("p")).select("c", F.trim("p").alias("p"))
    f = table(spark, sf, "frame_dets").select("det_id", "cls", "panel")
    if named:
        p, f = p.withColumn("p", named(F.col("p"))), f.withColumn("panel", named(F.col("panel")))
    return f.join(p.distinct(), (F.col("cls") == F.col("c")) & (F.col("panel") == F.col("p")), "left").select("det_id", F.col("c").isNotNull().alias("allowed"))


query.queries["class_whitelist_whole"] = partial(class_whitelist, named=panel_key)
query.sql["class_whitelist_whole"] = """with p as (select distinct cls, 'P' || regexp_extract(x, '^\\s*P0*([0-9]+)', 1) panel from (select cls, unnest(string_split(panels, ',')) x from class_dim)),
f as (select det_id, cls, 'P' || nullif(regexp_extract(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\\s*P[-_ ]*0*([0-9]+)', 1), '') panel from frame_dets)
select det_id, p.cls is not null as allowed from f left join p using (cls, panel)"""
