"""Queries on inventories: presence joins, precedence, samples and splits, similarity, duplicates, audits, rasters."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calorgrid.functions.keys import panel_key
from calorgrid.functions.numeric import celsius_of_centikelvin, nearest, planck_celsius, standardised
from calorgrid.operators import raster, sampling, similarity, windows
from calorgrid.plans.registry import Registry
from calorgrid.sources.sinks import label_colours
from calorgrid.sources.tables import table

query = Registry()


def _frames(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "frame_report").where("stem is not null").groupBy("stem").agg(F.min("frame_id").alias("frame_id"), F.min("source").alias("source"), F.min("split").alias("split"))


_F = "f as (select stem, min(frame_id) frame_id, min(source) source, min(split) split from frame_report where stem is not null group by stem)"


@query(f"with {_F} select stem from f where stem not in (select stem from frame_dets where stem is not null)")
def unlabelled_frames(spark: SparkSession, sf: str) -> DataFrame:
    return _frames(spark, sf).join(table(spark, sf, "frame_dets").select("stem"), "stem", "left_anti").select("stem")


@query(f"with {_F} select stem, source from f where stem in (select stem from frame_dets)")
def labelled_frames(spark: SparkSession, sf: str) -> DataFrame:
    return _frames(spark, sf).join(table(spark, sf, "frame_dets").select("stem"), "stem", "left_semi").select("stem", "source")


@query("select distinct stem from frame_dets where stem is not null and stem not in (select stem from frame_report where stem is not null) order by stem limit 3")
def orphan_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The first three labelled stems without a frame, for a warning."""
    d = table(spark, sf, "frame_dets").where("stem is not null").select("stem").distinct()
    return d.join(table(spark, sf, "frame_report").select("stem"), "stem", "left_anti").orderBy("stem").limit(3)


@query(f"""with {_F}, h as (select distinct stem from frame_dets where conf >= 0.9), p as (select distinct stem from frame_dets where stem is not null)
select f.stem, case when h.stem is not null then 'human' when p.stem is not null then 'prediction' else 'empty' end as origin from f left join h using (stem) left join p using (stem)""")
def precedence_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Sure labels before predictions before none, a whole frame at a time."""
    d = table(spark, sf, "frame_dets").where("stem is not null")
    first = d.where("conf >= 0.9").select("stem").distinct().withColumn("h", F.lit(True))
    second = d.select("stem").distinct().withColumn("p", F.lit(True))
    m = _frames(spark, sf).join(first, "stem", "left").join(second, "stem", "left")
    return m.select("stem", F.when(F.col("h"), "human").when(F.col("p"), "prediction").otherwise("empty").alias("origin"))


@query("with s as (select distinct array_to_string(string_split(stem, '_')[1:4], '_') session, lower(trim(split)) split from frame_report where stem is not null) select session from s where split = 'train' intersect select session from s where split in ('val', 'test')")
def leaking_sessions(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "frame_report").where("stem is not null").select(F.concat_ws("_", F.slice(F.split("stem", "_"), 1, 4)).alias("session"), F.lower(F.trim("split")).alias("split"))
    return s.where("split = 'train'").select("session").intersect(s.where("split in ('val', 'test')").select("session"))


@query("select coalesce(a.stem, b.stem) stem, a.n n_frames, b.n n_dets, a.n is distinct from b.n differs from (select stem, count(*) n from frame_report where stem is not null group by 1) a full join (select stem, count(*) n from frame_dets where stem is not null group by 1) b on a.stem = b.stem")
def artefact_differences(spark: SparkSession, sf: str) -> DataFrame:
    n = lambda t, c: table(spark, sf, t).where("stem is not null").groupBy("stem").agg(F.count("*").alias(c))
    return n("frame_report", "n_frames").join(n("frame_dets", "n_dets"), "stem", "full").select("stem", "n_frames", "n_dets", (~F.col("n_frames").eqNullSafe(F.col("n_dets"))).alias("differs"))


@query("select source, count(*) n, count(text) texts, count_if(text is null or trim(text) = '') empty, count(distinct sha256(text)) contents, round(count(*) * 100.0 / sum(count(*)) over (), 6) share from documents group by source")
def source_inventory(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count("text").alias("texts"), F.count_if(F.col("text").isNull() | (F.trim("text") == "")).alias("empty"), F.countDistinct(F.sha2("text", 256)).alias("contents"))
    return d.join(d.agg(F.sum("n").alias("_n")), F.lit(True)).withColumn("share", F.round(F.col("n") * 100.0 / F.col("_n"), 6)).drop("_n")


@query("select cls, count(*) boxes, count(distinct stem) frames, round(count(*) / count(distinct stem), 6) per_frame, round(count(*) * 100.0 / sum(count(*)) over (), 6) share, round(max(count(*)) over () / count(*), 6) imbalance from frame_dets group by cls")
def class_inventory(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "frame_dets").groupBy("cls").agg(F.count("*").alias("boxes"), F.countDistinct("stem").alias("frames"))
    every, b = Window.partitionBy(F.lit("all")), F.col("boxes")  # of one row a class
    return n.select("cls", "boxes", "frames", F.round(b / F.col("frames"), 6).alias("per_frame"), F.round(b * 100.0 / F.sum("boxes").over(every), 6).alias("share"), F.round(F.max("boxes").over(every) / b, 6).alias("imbalance"))


@query("select l_returnflag, count_if(l_linestatus = 'F') n_F, count_if(l_linestatus = 'O') n_O, count(*) total from lineitem group by 1")
def flag_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    from calorgrid.operators.stats import crosstab

    return crosstab(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ("F", "O"))


@query("""with d as (select frame_id, source, captured_at::date::varchar as day, stem, split = 'test' as kept from frame_report where source is not null and captured_at is not null),
r as (select *, row_number() over (partition by source, day, kept order by md5(frame_id::varchar || '|0'), frame_id) k from (select frame_id, source, day, coalesce(kept, false) kept from d)),
p as (select *, row_number() over (partition by source order by case when kept then 0 else 1 end, k, day) pick from r) select source, frame_id, pick from p where pick <= 40 or kept""")
def round_robin_sample(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").where("source is not null and captured_at is not null").select("frame_id", "source", F.date_format("captured_at", "yyyy-MM-dd").alias("day"), "split")
    out = windows.round_robin(f, "source", "day", [sampling.shuffled("frame_id"), F.col("frame_id")], 40, F.col("split") == "test")
    return out.select("source", "frame_id", "pick")


@query("with r as (select source, doc_id, row_number() over (partition by source order by md5(doc_id::varchar || '|0'), doc_id) k from documents) select source, doc_id from r where k <= 10")
def sample_per_session(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.per_group(table(spark, sf, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 10)


@query("with r as (select lang, doc_id, row_number() over (partition by lang order by doc_id) - 1 i, count(*) over (partition by lang) n from documents) select lang, doc_id, case when i % 5 = 0 then 'val' else 'train' end split, i = floor(n / 2) as middle, i % 7 = 0 and i < 70 as stride, i < greatest(1, n // 5) as head from r")
def positional_picks(spark: SparkSession, sf: str) -> DataFrame:
    d = windows.numbered(table(spark, sf, "documents").select("lang", "doc_id"), ["lang"], ["doc_id"])
    n = d.groupBy("lang").agg(F.count("*").alias("n"))
    j = d.alias("d").join(n.alias("n"), F.col("d.lang").eqNullSafe(F.col("n.lang")))
    i, k = F.col("i"), F.col("n.n")
    return j.select("d.lang", "doc_id", F.when(i % 5 == 0, "val").otherwise("train").alias("split"), (i == F.floor(k / 2)).alias("middle"), ((i % 7 == 0) & (i < 70)).alias("stride"), (i < F.greatest(F.lit(1), F.floor(k / 5))).alias("head"))


@query("""with r as (select source as owner, doc_id, row_number() over (partition by source order by md5(doc_id::varchar || '|0'), doc_id) k, count(*) over (partition by source) n from documents where source is not null),
s as (select distinct owner from r), m as (select owner, coalesce(lead(owner) over (order by owner), min(owner) over ()) nxt from s)
select owner, doc_id, 'own' as role from r union all select nxt, doc_id, 'cross' from r join m using (owner) where k <= greatest(1, round_even(n * 0.1, 0))""")
def cross_review(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("source is not null").select(F.col("source").alias("owner"), "doc_id")
    return sampling.cross_review(d, "owner", "doc_id", sampling.following_owners(d, "owner"))


@query("with s as (select doc_id, lang, source from documents where source is not null), f as (select distinct source fold from s) select doc_id, fold, case when source = fold then 'val' else 'train' end split from s, f")
def leave_one_out(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").where("source is not null").select("doc_id", "source")
    folds = d.select(F.col("source").alias("fold")).distinct()
    return sampling.leave_one_out(d, "source", folds).select("doc_id", "fold", "split")


_BALANCED = """with recursive d as (select coalesce(regexp_extract(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\\s*P[-_ ]*0*([0-9]+)', 1), '') as k, coalesce(panel, '?') as raw, coalesce(stem, '(none)') as f, cls from frame_dets),
p as (select case when k <> '' then 'P' || k else raw end as s, f, cls from d), c as (select cls, count(*) as n, row_number() over (order by cls nulls first) as i from p group by cls),
sz as (select s, count(distinct f) as n from p group by s), v as (select s, list(coalesce(m, 0) order by i) as v from (select a.s, c.i, (select count(*) from p where p.s = a.s and p.cls is not distinct from c.cls) as m from sz a, c) group by s),
t as (select (select sum(n) from sz) as n, greatest(1, floor(0.2 * (select sum(n) from sz))) as target, (select list(n order by i) from c) as total),
g as (select 0 as step, []::varchar[] as held, 0::hugeint as n, (select list_transform(total, lambda x: 0::bigint) from t) as inside
  union all select step + 1, list_append(held, b.s), b.n, b.inside from (select g.step, any_value(g.held) as held, arg_min({'s': sz.s, 'n': g.n + sz.n, 'inside': list_transform(list_zip(g.inside, v.v), lambda x: x[1] + x[2])},
    (round(list_sum(list_transform(list_zip(g.inside, v.v, t.total), lambda x: x[3] * abs((x[1] + x[2]) / x[3] - 0.2))) + 2 * abs(g.n + sz.n - t.target), 9), sz.s)) as b
    from g, t, sz join v using (s) where g.n < t.target and not list_contains(g.held, sz.s) and g.n + sz.n < t.n group by g.step)),
h as (select held from g order by step desc limit 1)
select case when list_contains(held, s) then 'val' else 'train' end as split, cls, count(*) as n from p, h group by all"""


@query(_BALANCED)
def balanced_split(spark: SparkSession, sf: str) -> DataFrame:
    """A panel is one session however it is written; what names none stays as it is. Size is counted in frames, or in
    detections where they name none."""
    d = table(spark, sf, "frame_dets")
    d = d.select("det_id", F.col("stem" if "stem" in d.columns else "det_id").alias("stem"), "cls", F.coalesce(panel_key(F.col("panel")), "panel", F.lit("?")).alias("panel"))
    return sampling.balanced_validation(d, "panel", "cls", "stem").groupBy("split", "cls").agg(F.count("*").alias("n"))


@query("select frame_id, verdict from frame_report where verdict = 'critical' union all (select frame_id, verdict from frame_report where verdict is null or verdict <> 'critical' order by md5(frame_id::varchar || '|0'), frame_id limit 100)")
def rare_and_some(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.all_rare_and_some_common(table(spark, sf, "frame_report").select("frame_id", "verdict"), F.col("verdict") == "critical", "frame_id", 100)


@query("""with e as (select vec_id, label, embedding::double[] v from embeddings), p as (select a.vec_id query, b.vec_id partner, list_dot_product(a.v, b.v) / len(a.v) score from e a join e b on a.label = b.label and a.vec_id <> b.vec_id),
r as (select *, row_number() over (partition by query order by score desc, partner) place from p) select query, partner, round(score, 6) score, place, score >= 0.005 as accepted from r where place <= 2""")
def nearest_two(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    out = similarity.best_partners(e, e, "vec_id", "embedding", "label")
    return out.select("query", "partner", F.round("score", 6).alias("score"), "place", (F.col("score") >= 0.005).alias("accepted"))


@query("with e as (select vec_id, embedding::double[] v, list_avg(embedding::double[]) m from embeddings), d as (select *, sqrt(list_avg(list_transform(v, lambda x: (x - m) * (x - m)))) s from e) select vec_id, unnest(range(64))::int i, round(unnest(list_transform(v, lambda x: (x - m) / (s + 1e-6))), 4) z from d")
def standardised_vectors(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", F.posexplode(standardised(F.col("embedding"))).alias("i", "z"))
    return e.select("vec_id", "i", F.round("z", 4).alias("z"))


@query("""with recursive e as (select vec_id, label, embedding::double[] v, row_number() over (partition by label order by vec_id) k from embeddings),
g as (select label, 0::bigint k, []::struct(id bigint, v double[])[] held, null::bigint vec_id, null::bigint leader from (select distinct label from embeddings)
  union all select label, k, case when near is null then list_append(held, {'id': vec_id, 'v': v}) else held end, vec_id, coalesce(near, vec_id) from (
    select e.label, e.k, g.held, e.vec_id, list_transform(e.v, lambda x: x / sqrt(list_dot_product(e.v, e.v))) v,
      (list_filter(g.held, lambda l: list_dot_product(l.v, e.v) / sqrt(list_dot_product(e.v, e.v)) >= 0.3)[1]).id near from g join e on e.label = g.label and e.k = g.k + 1))
select vec_id, leader from g where vec_id is not null""")
def leader_clusters(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.leaders(table(spark, sf, "embeddings"), "vec_id", "embedding", "label", 0.3)


@query("select sha256(text) as digest, min(doc_id) first_id, count(*) n from documents where text is not null group by 1 having count(*) > 1")
def exact_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.exact_duplicates(table(spark, sf, "documents"), "doc_id", "text")


@query("select doc_id, min(doc_id) over (partition by sha256(text)) class_id, count(*) over (partition by sha256(text)) n from documents where text is not null")
def exact_duplicate_members(spark: SparkSession, sf: str) -> DataFrame:
    """Each document with the class (smallest id) of its content, beside the classes of ``exact_duplicates``."""
    return similarity.members(table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest")), "doc_id", "digest")


@query("""with e as (select vec_id, embedding::double[] v from embeddings), c as (select vec_id, list_sum(list_transform(range(64), lambda i: case when v[i + 1] > list_avg(v) then 1::hugeint << i::int else 0::hugeint end)) c from e),
k as (select *, min(vec_id) over (partition by c) id from c), r as (select distinct c, id from k)
select 'member' as kind, id as id_a, vec_id as id_b, 0 as distance from k
union all select 'near', a.id, b.id, bit_count(xor(a.c, b.c))::int from r a join r b on a.id < b.id where bit_count(xor(a.c, b.c)) <= 7""")
def perceptual_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """``kind`` near: representatives (smallest ids) of two codes within 7 bits; member: each raster ``id_b`` with a code and
    the representative ``id_a`` of its code, itself where it is the first. Both together tell all links."""
    e = table(spark, sf, "embeddings").select("vec_id", similarity.sign_hash("embedding").alias("code"))
    near = similarity.near_hashes(e, "vec_id", "code", 7).select(F.lit("near").alias("kind"), "id_a", "id_b", "distance")
    own = similarity.members(e, "vec_id", "code").select(F.lit("member").alias("kind"), F.col("class_id").alias("id_a"), F.col("vec_id").alias("id_b"), F.lit(0).alias("distance"))
    return near.unionByName(own)


@query("with e as (select vec_id, embedding::double[] v from embeddings) select vec_id, round(len(list_filter(v, lambda x: x >= list_max(v) - 0.1)) * 100 / len(v), 6) as hot_pct from e")
def raster_hot_share(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return e.select("vec_id", F.round(raster.hot_share(F.col("v"), 0.1), 6).alias("hot_pct"))


@query("""with recursive e as (select vec_id, embedding::double[] v, list_median(embedding::double[]) m from embeddings), h as (select vec_id, i, m, v[i + 1] t from e, range(64) r(i) where v[i + 1] - m >= 0.1),
c as (select vec_id, i root, i from h union select c.vec_id, c.root, h.i from c join h on h.vec_id = c.vec_id and (abs(h.i - c.i) = 8 or (abs(h.i - c.i) = 1 and h.i // 8 = c.i // 8))),
k as (select vec_id, i, min(root) root from c group by all) select vec_id, count(*)::int px, min(i % 8)::int x1, min(i // 8)::int y1, max(i % 8)::int + 1 x2, max(i // 8)::int + 1 y2, round(max(t), 6) peak, round(avg(t), 6) mean from k join h using (vec_id, i) group by vec_id, root having count(*) >= 3""")
def raster_components(spark: SparkSession, sf: str) -> DataFrame:
    b = raster.frame_blobs(table(spark, sf, "embeddings"), "vec_id", "embedding", 8, 8, 0.1, 3)
    return b.select("vec_id", "px", "x1", "y1", "x2", "y2", F.round("peak", 6).alias("peak"), F.round("mean", 6).alias("mean"))


@query("""with e as (select vec_id, i % 8 x, i // 8 y, embedding[i + 1]::double t from embeddings, range(64) r(i)), o(d) as (select unnest(range(-2, 3))),
f as (select a.vec_id, a.x, a.y, median(b.t) m from e a, o dx, o dy, e b where b.vec_id = a.vec_id and b.x = greatest(0, least(7, a.x + dx.d)) and b.y = greatest(0, least(7, a.y + dy.d)) group by all)
select e.vec_id, max(t) as raw, any_value(m) as filtered from e join (select vec_id, max(m) m from f group by 1) using (vec_id) group by e.vec_id""")
def raster_filtered_maximum(spark: SparkSession, sf: str) -> DataFrame:
    """Maximum before and after the 5 x 5 median filter; their difference tells a one-pixel spike."""
    e = raster.mapped(table(spark, sf, "embeddings"), "embedding", 8, 8, raster.median_filter, "f")
    return e.select("vec_id", F.array_max("embedding").cast("double").alias("raw"), F.array_max("f").alias("filtered"))


@query("""with e as (select vec_id, i % 8 x, i // 8 y, embedding[i + 1]::double t from embeddings, range(64) r(i)), f as (select vec_id, (y // 2) * 4 + x // 2 as i, avg(t) t from e group by all),
s as (select vec_id, avg(t) m, stddev_pop(t) d from f group by 1) select vec_id, i::int as i, round((t - m) / (d + 1e-6), 6) as z from f join s using (vec_id)""")
def raster_descriptors(spark: SparkSession, sf: str) -> DataFrame:
    """Area-averaged 4 x 4 rasters, standardised, value by value: what ``descriptor_bank`` keeps as arrays."""
    e = raster.mapped(table(spark, sf, "embeddings"), "embedding", 8, 8, lambda a: raster.area_resize(a, 4, 4), "small")
    return e.select("vec_id", F.posexplode(standardised(F.col("small"))).alias("i", "z")).select("vec_id", "i", F.round("z", 6).alias("z"))


@query()
def raster_degraded(spark: SparkSession, sf: str) -> DataFrame:
    """Difference of the 99th percentile between a raster and its coarser view."""
    e = raster.mapped(table(spark, sf, "embeddings"), "embedding", 8, 8, lambda a: np.array([np.percentile(a, 99), np.percentile(raster.degrade(a, 4, 4, 7), 99)]), "p")
    return e.select("vec_id", F.get("p", 0).alias("fine"), F.get("p", 1).alias("coarse"))


@query("select event_id, round(value * 100 / 100 - 273.15, 6) as lepton, round(1400 / ln(16000 / (0.012 * (value * 20 + 3000 + 100)) + 1) - 273.15, 6) as planck from events")
def radiometry(spark: SparkSession, sf: str) -> DataFrame:
    lit = F.lit
    raw = F.col("value") * 20 + 3000
    t = planck_celsius(raw, lit(16000.0), lit(0.012), lit(1400.0), lit(1.0), lit(100.0), lit(1.0), lit(20.0))
    return table(spark, sf, "events").select("event_id", F.round(celsius_of_centikelvin(F.col("value") * 100), 6).alias("lepton"), F.round(t, 6).alias("planck"))


@query("with p(i, a, b) as (values (0, 0.0, 0.0), (1, 100.0, 10.0), (2, 200.0, 20.0), (3, 400.0, 50.0)) select event_id, arg_min(i, (power(value - a, 2) + power(user_id - b, 2), i))::int as entry from events, p group by event_id")
def palette_index(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return e.select("event_id", nearest([F.col("value"), F.col("user_id").cast("double")], ((0, 0), (100, 10), (200, 20), (400, 50))).alias("entry"))


@query("select cls, cls_key, ['#e6194b', '#3cb44b', '#4363d8', '#f58231'][cls % 4 + 1] as color from class_dim")
def label_palette(spark: SparkSession, sf: str) -> DataFrame:
    return label_colours(table(spark, sf, "class_dim"), "cls", ["#e6194b", "#3cb44b", "#4363d8", "#f58231"]).select("cls", "cls_key", "color")


@query("select 'all' as stage, count(*) n from frame_report union all select 'with stem', count(stem) from frame_report union all select 'distinct', count(distinct stem) from frame_report union all select 'labelled', count(distinct stem) from frame_report where stem in (select stem from frame_dets)")
def selection_funnel(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").select("stem")
    labelled = f.join(table(spark, sf, "frame_dets").select("stem"), "stem", "left_semi")
    a = f.agg(F.count("*").alias("all"), F.count("stem").alias("with stem"), F.countDistinct("stem").alias("distinct"))
    n = a.unpivot([], ["all", "with stem", "distinct"], "stage", "n")
    return n.unionByName(labelled.agg(F.countDistinct("stem").alias("n")).select(F.lit("labelled").alias("stage"), "n"))


@query("with r as (select source, count(*) n, count_if(verdict = 'critical') worst, count_if(verdict is null) open from frame_report group by source) select source, n, worst, open, round(worst * 100 / n, 6) pct, worst / n > 0.3 as too_many from r")
def reason_shares(spark: SparkSession, sf: str) -> DataFrame:
    r = table(spark, sf, "frame_report").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "critical").alias("worst"), F.count_if(F.col("verdict").isNull()).alias("open"))
    return r.select("source", "n", "worst", "open", F.round(F.col("worst") * 100 / F.col("n"), 6).alias("pct"), (F.col("worst") / F.col("n") > 0.3).alias("too_many"))


@query("select source, count(*) n from frame_report group by source order by n desc, source limit 3")
def most_common(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "frame_report").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc_nulls_last("source")).limit(3)


@query("select stem from (select stem, count_if(cls = 15) a, count_if(cls = 24) b from frame_dets group by stem) where a > 0 and b > 0 and stem is not null")
def class_cooccurrence(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "frame_dets").groupBy("stem").agg(F.count_if(F.col("cls") == 15).alias("a"), F.count_if(F.col("cls") == 24).alias("b"))
    return c.where("a > 0 and b > 0 and stem is not null").select("stem")


@query("select n.cls_name as name, d.cls as cls, count(f.det_id) n from class_dim d join class_dim n using (cls) left join frame_dets f on f.cls = d.cls group by all")
def class_remap_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Classes under their name, with the number of their detections; classes without any stay."""
    n = table(spark, sf, "frame_dets").groupBy("cls").agg(F.count("det_id").alias("n"))
    return table(spark, sf, "class_dim").select("cls", F.col("cls_name").alias("name")).join(n, "cls", "left").select("name", "cls", F.coalesce("n", F.lit(0)).alias("n"))
