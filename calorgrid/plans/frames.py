"""Queries on frames and readings: judgement, ambient estimates, profiles, rollups, reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from calorgrid.functions.grading import LEVELS, judged, ladder, ladder_with_fallback, rank, with_rules
from calorgrid.functions.keys import frame_number, panel_order, session_of, stem_token
from calorgrid.functions.numeric import bar, finite, quantise, to_byte
from calorgrid.operators import stats, windows
from calorgrid.operators.exact import quantiles
from calorgrid.plans.registry import Registry
from calorgrid.sources.tables import table

query = Registry()
#: an example rule table: how a class is judged and by which steps
RULES = [(c, ("ABS", "PHASE", "AMB")[c % 3], *((60.0, 80.0, 100.0), (5.0, 15.0, 40.0), (15.0, 40.0, 65.0))[c % 3]) for c in range(0, 24, 2)]
DEFAULT = {"method": "PHASE", "caution": 5.0, "warn": 15.0, "critical": 40.0}
_RULES_SQL = "rules(cls, method, s1, s2, s3) as (values " + ", ".join(str(r) for r in RULES) + ")"


#: what the SQL of the queries asks of a detection
_NEED = ("t_p99", "t_max", "dt_amb")


def readings(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    """Detections whose temperatures named by ``need`` are numbers; any other that is no number is null."""
    d = table(spark, sf, "frame_dets").select("det_id", "stem", "cls", "conf", finite(F.col("t_p99")).alias("t_p99"), finite(F.col("t_max")).alias("t_max"), finite(F.col("dt_amb")).alias("dt_amb"), "n_px", "captured_at")
    return d.dropna(subset=list(need)) if need else d


_READ = """d as (select det_id, stem, cls, conf, t_p99, t_max, dt_amb, n_px, captured_at from frame_dets where isfinite(t_p99) and isfinite(t_max) and isfinite(dt_amb))"""
_JUDGED = f"""{_READ}, {_RULES_SQL},
g as (select stem, cls, median(t_p99) m, count(*) k from d group by all),
p as (select d.*, case when k >= 2 then m end as peer, coalesce(method, 'PHASE') as method, coalesce(s1, 5.0) s1, coalesce(s2, 15.0) s2, coalesce(s3, 40.0) s3
  from d join g using (stem, cls) left join rules using (cls)),
v as (select *, case when method = 'ABS' then t_p99 when method = 'PHASE' and peer is not null then t_p99 - peer else t_p99 - (t_p99 - dt_amb) end as x,
  case when method = 'PHASE' and peer is null then 15.0 else s1 end a, case when method = 'PHASE' and peer is null then 30.0 else s2 end b, case when method = 'PHASE' and peer is null then 50.0 else s3 end c from p),
j as (select *, case when x >= c then 4 when x >= b then 3 when x >= a then 2 else 1 end as r,
  case when method = 'ABS' then 'value' when method = 'PHASE' and peer is null then 'ambient, no peer' when method = 'PHASE' then 'peer' else 'ambient' end as basis from v)"""


def _judged(spark: SparkSession, sf: str, need: Sequence[str]) -> DataFrame:
    """Detections with verdict and basis; where ambient must judge and isn't known, the verdict is null."""
    rules = spark.createDataFrame(RULES, "cls int, method string, caution double, warn double, critical double")
    peers = windows.with_peer_median(readings(spark, sf, need), ["stem", "cls"], "t_p99")
    ruled = with_rules(peers, rules, "cls", DEFAULT)
    grade, basis = judged(F.col("t_p99"), F.col("t_p99") - F.col("dt_amb"), F.col("peer"), F.col("method"), [F.col(c) for c in ("caution", "warn", "critical")], (15.0, 30.0, 50.0))
    unknown = basis.startswith("ambient") & F.col("dt_amb").isNull()
    return ruled.withColumn("verdict", F.when(~unknown, grade)).withColumn("basis", basis)


@query(f"""with {_JUDGED}, f as (select stem, count(*) n_det, arg_max(struct_pack(d := det_id, c := cls, v := r, t := t_p99), (r, -det_id)) w from j group by stem),
i as (select stem, min(frame_id) frame_id from frame_report where stem is not null group by stem)
select i.frame_id, i.stem, coalesce(n_det, 0) as n_det, case when n_det is null then 'none' else ['normal', 'caution', 'abnormal', 'critical'][w.v] end as verdict, w.c as worst_cls, w.t as worst_temp from i left join f using (stem)""")
def component_judgement(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    """Every frame of the index with its worst component: peers by (frame, class), rules by class, worst by grade."""
    j = _judged(spark, sf, need).withColumn("r", rank(F.col("verdict")))
    worst = j.groupBy("stem").agg(F.count("*").alias("n_det"), F.max_by(F.struct("cls", "verdict", "t_p99"), F.struct("r", -F.col("det_id"))).alias("w"))
    index = table(spark, sf, "frame_report").where("stem is not null").groupBy("stem").agg(F.min("frame_id").alias("frame_id"))
    return index.join(worst, "stem", "left").select("frame_id", "stem", F.coalesce("n_det", F.lit(0)).alias("n_det"), F.coalesce("w.verdict", F.lit("none")).alias("verdict"), F.col("w.cls").alias("worst_cls"), F.col("w.t_p99").alias("worst_temp"))


@query(f"with {_JUDGED} select det_id, ['normal', 'caution', 'abnormal', 'critical'][r] as verdict, basis || case when n_px < 200 then ' (few pixels)' else '' end as basis from j")
def detection_verdicts(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    return _judged(spark, sf, need).select("det_id", "verdict", F.concat("basis", F.when(F.col("n_px") < 200, " (few pixels)").otherwise("")).alias("basis"))


@query("with c as (select user_id, quantile_cont(value, 0.1) q from events group by 1) select user_id, round(avg(value), 6) as ambient from events join c using (user_id) where value <= q group by 1")
def ambient_coldest_pct(spark: SparkSession, sf: str) -> DataFrame:
    return stats.ambient_by_percentile(table(spark, sf, "events").select("user_id", "value"), ["user_id"], "value").select("user_id", F.round("ambient", 6).alias("ambient"))


@query("with r as (select user_id, value, row_number() over (partition by user_id order by value) r, count(*) over (partition by user_id) n from events) select user_id, round(avg(value), 6) as ambient from r where r <= greatest(1, floor(n * 0.1)) group by 1")
def ambient_coldest_rank(spark: SparkSession, sf: str) -> DataFrame:
    return stats.ambient_by_rank(table(spark, sf, "events").select("user_id", "value"), ["user_id"], "value").select("user_id", F.round("ambient", 6).alias("ambient"))


_CENSUS = "c as (select census_id, stem, cls, spike, hot_px, run_day, run_at, verdict, t_p99, amb from anomaly_census where isfinite(t_p99))"


def _census(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "anomaly_census").withColumn("t_p99", finite(F.col("t_p99"))).where("t_p99 is not null")


@query(f"""with {_CENSUS}, g as (select stem, cls, median(case when spike = 0 then t_p99 end) m, count(case when spike = 0 then 1 end) k from c group by all)
select census_id, spike, round(case when k >= 2 then m end, 6) as peer, case when t_p99 - m >= 40 and k >= 2 then 'critical' when t_p99 - m >= 15 and k >= 2 then 'abnormal' when t_p99 - m >= 5 and k >= 2 then 'caution' else 'normal' end as verdict
from c join g on c.stem is not distinct from g.stem and c.cls is not distinct from g.cls""")
def peer_median_without_spikes(spark: SparkSession, sf: str) -> DataFrame:
    p = windows.with_peer_median(_census(spark, sf).select("census_id", "stem", "cls", "spike", "t_p99"), ["stem", "cls"], "t_p99", F.col("spike") == 0)
    return p.select("census_id", "spike", F.round("peer", 6).alias("peer"), ladder(F.col("t_p99") - F.col("peer"), (5, 15, 40)).alias("verdict"))


@query(f"""with {_CENSUS}, g as (select stem, cls, median(t_p99) m, count(*) k from c group by all), v as (select census_id, case when k >= 2 then t_p99 - m end p, t_p99 - amb a from c join g on c.stem is not distinct from g.stem and c.cls is not distinct from g.cls)
select census_id, case when p >= 40 then 'critical' when p >= 15 then 'abnormal' when p >= 5 then 'caution' when a >= 40 then 'critical' when a >= 15 then 'abnormal' when a >= 5 then 'caution' else 'normal' end as verdict from v""")
def verdict_fallthrough(spark: SparkSession, sf: str) -> DataFrame:
    p = windows.with_peer_median(_census(spark, sf).select("census_id", "stem", "cls", "amb", "t_p99"), ["stem", "cls"], "t_p99")
    return p.select("census_id", ladder_with_fallback(F.col("t_p99") - F.col("peer"), F.col("t_p99") - F.col("amb"), (5, 15, 40), (5, 15, 40)).alias("verdict"))


@query("with g as (select case when v.x >= 40 then 'critical' when v.x >= 15 then 'abnormal' when v.x >= 5 then 'caution' else 'normal' end as verdict from (select t_max - t_med as x from frame_report where isfinite(t_max) and isfinite(t_med)) v), n as (select verdict, count(*) n from g group by 1) select verdict, n, array_position(['normal', 'caution', 'abnormal', 'critical'], verdict)::int as place, round(n * 100.0 / sum(n) over (), 6) as pct, repeat('#', floor(n / max(n) over () * 46)::int) as bar from n")
def verdict_histogram(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").select(finite(F.col("t_max")).alias("a"), finite(F.col("t_med")).alias("b")).where("a is not null and b is not null")
    n = f.groupBy(ladder(F.col("a") - F.col("b"), (5, 15, 40)).alias("verdict")).agg(F.count("*").alias("n"))
    every = Window.partitionBy(F.lit("all"))  # of at most four rows
    return n.select("verdict", "n", rank(F.col("verdict")).alias("place"), F.round(F.col("n") * 100.0 / F.sum("n").over(every), 6).alias("pct"), bar(F.col("n"), F.max("n").over(every)).alias("bar"))


@query("""with t as (select user_id, count(value) n, avg(value) t_mean, max(value) t_max, count_if(value > 250) n_saturated, quantile_cont(value, 0.5) t_med, quantile_cont(value, 0.95) t_p95, quantile_cont(value, 0.99) t_p99 from events group by 1),
h as (select user_id, count_if(value >= t_max - 5) n_near from events join t using (user_id) group by 1)
select user_id, n, round(t_mean, 6) t_mean, t_max, n_saturated, round(t_med, 6) t_med, round(t_p95, 6) t_p95, round(t_p99, 6) t_p99, n_near, round(n_near * 100 / n, 6) near_pct from t join h using (user_id)""")
def frame_statistics(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.frame_statistics(table(spark, sf, "events").select("user_id", "value"), ["user_id"], "value")
    return out.select("user_id", "n", "t_max", "n_saturated", "n_near", *[F.round(c, 6).alias(c) for c in ("t_mean", "t_med", "t_p95", "t_p99", "near_pct")])


@query(f"with {_READ} select cls, count(*) n, round(median(t_p99), 6) med, round(quantile_cont(t_p99, 0.9), 6) p90, round(quantile_cont(t_p99, 0.99), 6) p99, max(t_p99) most, count_if(t_p99 >= 60) hot, round(median(dt_amb), 6) rise from d group by cls having count(*) >= 5")
def class_profile(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    d = readings(spark, sf, need)
    out = d.groupBy("cls").agg(F.count("*").alias("n"), F.max("t_p99").alias("most"), F.count_if(F.col("t_p99") >= 60).alias("hot")).where("n >= 5")
    out = stats.beside(out, quantiles(d, ["cls"], "t_p99", {"med": 0.5, "p90": 0.9, "p99": 0.99}), ["cls"])
    out = stats.beside(out, quantiles(d, ["cls"], "dt_amb", {"rise": 0.5}), ["cls"])
    return out.select("cls", "n", "most", "hot", *[F.round(c, 6).alias(c) for c in ("med", "p90", "p99", "rise")])


@query(f"with {_READ}, s as (select stem, cls, max(t_p99) - min(t_p99) x from d group by all having count(*) >= 2) select cls, count(*) n, round(median(x), 6) med, round(quantile_cont(x, 0.9), 6) p90, round(quantile_cont(x, 0.99), 6) p99, round(max(x), 6) most, count_if(x > 5) over_5, count_if(x > 15) over_15 from s group by cls")
def phase_spread(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    out = stats.spread_profile(readings(spark, sf, need), "stem", "cls", "t_p99")
    return out.select("cls", "n", "over_5", "over_15", *[F.round(c, 6).alias(c) for c in ("med", "p90", "p99", "most")])


@query("""with f as (select coalesce(panel, '(none)') p, t_max - t_ambient x from frame_report where isfinite(t_max) and isfinite(t_ambient))
select case when grouping(p) = 1 then '(all)' else p end as panel, count(*) n, round(quantile_cont(x, 0.5), 6) p50, round(quantile_cont(x, 0.95), 6) p95, round(max(x), 6) most from f group by rollup(p)""")
def panel_quantile_rollup(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").select("panel", (finite(F.col("t_max")) - finite(F.col("t_ambient"))).alias("x")).where("x is not null")
    f = stats.with_all(f, "panel")
    q = quantiles(f, ["panel"], "x", {"p50": 0.5, "p95": 0.95})
    out = stats.beside(f.groupBy("panel").agg(F.count("*").alias("n"), F.max("x").alias("most")), q, ["panel"])
    return out.select("panel", "n", *[F.round(c, 6).alias(c) for c in ("p50", "p95", "most")])


@query("""with f as (select coalesce(split, '(none)') p, t_max - t_ambient x from frame_report where isfinite(t_max) and isfinite(t_ambient))
select case when grouping(p) = 1 then '(all)' else p end as split, count_if(x >= 5) ge_5, count_if(x >= 10) ge_10, count_if(x >= 20) ge_20, count_if(x >= 40) ge_40, round(count_if(x >= 20) * 100 / count(*), 6) pct_20 from f group by rollup(p)""")
def exceedance_rollup(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").select("split", (finite(F.col("t_max")) - finite(F.col("t_ambient"))).alias("x")).where("x is not null")
    out = stats.rolled_up(f, "split", stats.exceedance("x", (5, 10, 20, 40)))
    return out.select("split", "ge_5", "ge_10", "ge_20", "ge_40", F.round("pct_20", 6).alias("pct_20"))


@query("select case when value >= 40 then 3 when value >= 15 then 2 when value >= 5 then 1 when value >= 0 then 0 else -1 end as bin, count(*) n from events where value is not null group by 1")
def rise_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.histogram(table(spark, sf, "events"), "value", (0, 5, 15, 40))


@query("select cls, count_if(verdict = 'normal') n_normal, count_if(verdict = 'caution') n_caution, count_if(verdict = 'abnormal') n_abnormal, count_if(verdict = 'critical') n_critical, count(*) total, round((count_if(verdict = 'abnormal') + count_if(verdict = 'critical')) * 100 / count(*), 6) bad_pct from anomaly_census group by cls")
def class_verdict_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.crosstab(table(spark, sf, "anomaly_census"), "cls", "verdict", LEVELS, ("abnormal", "critical"))
    return out.withColumn("bad_pct", F.round("bad_pct", 6))


@query("select case when grouping(p) = 1 then '(all)' else p end as cls, count_if(spike = 1) rejected, count_if(hot_px < 12 and t_p99 > 60) small_hot, count(*) n from (select *, coalesce(cls, '(none)') p from anomaly_census) group by rollup(p)")
def spike_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return stats.rolled_up(table(spark, sf, "anomaly_census"), "cls", [F.count_if(F.col("spike") == 1).alias("rejected"), F.count_if((F.col("hot_px") < 12) & (F.col("t_p99") > 60)).alias("small_hot"), F.count("*").alias("n")])


@query("""with r as (select user_id, value, row_number() over (partition by user_id order by ts, event_id) i from events), h as (select user_id, i, i - row_number() over (partition by user_id order by i) g from r where value >= 300),
k as (select user_id, g, count(*) n from h group by all) select user_id, count(*) runs, round(median(n), 6) med, round(avg(n), 6) mean, max(n) most, count_if(n = 1) singles from k group by 1""")
def run_lengths(spark: SparkSession, sf: str) -> DataFrame:
    r = windows.run_lengths(table(spark, sf, "events"), ["user_id"], ["ts", "event_id"], F.col("value") >= 300)
    return r.groupBy("user_id").agg(F.count("*").alias("runs"), F.round(F.median("length"), 6).alias("med"), F.round(F.avg("length"), 6).alias("mean"), F.max("length").alias("most"), F.count_if(F.col("length") == 1).alias("singles"))


@query("with s as (select frame_id, string_split(stem, '_') t from frame_report where stem is not null) select frame_id, t[1] as site, coalesce(t[3], '?') as panel, coalesce(t[4], '?') as day, array_to_string(t[1:4], '_') as session, coalesce(try_cast(regexp_replace(t[-1], '[^0-9]', '', 'g') as int), -1) as frame_no, coalesce(try_cast(t[3][2:] as int), 99) as place from s")
def stem_parse(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("stem")
    return table(spark, sf, "frame_report").where("stem is not null").select("frame_id", stem_token(s, 0).alias("site"), stem_token(s, 2, "?").alias("panel"), stem_token(s, 3, "?").alias("day"), session_of(s).alias("session"), frame_number(s).alias("frame_no"), F.coalesce(panel_order(stem_token(s, 2)), F.lit(99)).alias("place"))


@query(f"with {_READ} select cls, count(*) n, round(corr(t_p99, t_max), 6) r, round(regr_r2(t_p99, t_max), 6) r2, round(sqrt(greatest(0, regr_syy(t_p99, t_max) * (1 - regr_r2(t_p99, t_max)) / count(*))), 5) rmse from d group by cls")
def linear_fit(spark: SparkSession, sf: str) -> DataFrame:
    return stats.linear_fit(readings(spark, sf), ["cls"], "t_p99", "t_max", 1).select("cls", "n", F.round("r", 6).alias("r"), F.round("r2", 6).alias("r2"), F.round("rmse", 5).alias("rmse"))


@query(f"with {_READ}, s as (select cls, stddev_pop(t_p99) s, count(*) n from d group by cls having count(*) >= 20) select count(*) classes, round(avg(s), 6) macro_std from s")
def macro_spread(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    s = readings(spark, sf, need).groupBy("cls").agg(F.stddev_pop("t_p99").alias("s"), F.count("*").alias("n")).where("n >= 20")
    return s.agg(F.count("*").alias("classes"), F.round(F.avg("s"), 6).alias("macro_std"))


@query("""with w(lo, hi) as (values (0.0, 100.0), (0.0, 250.0), (20.0, 120.0)), e as (select lo, hi, value x, abs(value - (greatest(0, least(255, round_even((value - lo) / (hi - lo) * 255, 0))) / 255 * (hi - lo) + lo)) e from events, w where value is not null)
select lo::double lo, hi::double hi, count(*) n, round(count_if(x < lo or x > hi) * 100 / count(*), 6) outside_pct, round(sqrt(avg(e * e)), 6) rmse, round(quantile_cont(e, 0.95), 6) p95, round(max(e), 6) most from e group by lo, hi""")
def window_sweep(spark: SparkSession, sf: str) -> DataFrame:
    out = stats.window_sweep(table(spark, sf, "events").select("value"), "value", ((0, 100), (0, 250), (20, 120)))
    return out.select("lo", "hi", "n", *[F.round(c, 6).alias(c) for c in ("outside_pct", "rmse", "p95", "most")])


@query("with q as (select user_id, quantile_cont(value, 0.01) lo, quantile_cont(value, 0.99) hi from events group by 1) select event_id, floor(greatest(0, least(255, (value - lo) / greatest(hi - lo, 1e-6) * 255)))::int as grey, floor(greatest(0, least(255, (value - 20) / 100 * 255)))::int as grey_abs, round(greatest(0, least(255, round_even(value / 500 * 255, 0))) / 255 * 500, 6) as back from events join q using (user_id)")
def rendered_values(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    q = e.groupBy("user_id").agg(*stats.quantile_columns("value", {"lo": 0.01, "hi": 0.99}))
    v = F.col("value")
    return e.join(q, "user_id").select("event_id", to_byte(v, F.col("lo"), F.col("hi")).alias("grey"), to_byte(v, F.lit(20.0), F.lit(120.0)).alias("grey_abs"), F.round(quantise(v, 0, 500), 6).alias("back"))


@query(f"with {_CENSUS} select census_id, cls, t_p99 from c where verdict in ('abnormal', 'critical') order by t_p99 desc, census_id limit 20")
def worst_components(spark: SparkSession, sf: str) -> DataFrame:
    return _census(spark, sf).where("verdict in ('abnormal', 'critical')").orderBy(F.desc("t_p99"), "census_id").limit(20).select("census_id", "cls", "t_p99")


@query("with s as (select event_type, value, row_number() over (partition by user_id order by md5(event_id::varchar || '|0'), event_id) r from events) select event_type, count(*) n, round(quantile_cont(value, 0.05), 6) p5, round(quantile_cont(value, 0.95), 6) p95 from s where r <= 20 group by 1")
def sampled_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    from calorgrid.operators.sampling import per_group

    s = per_group(table(spark, sf, "events"), ["user_id"], ["event_id"], 20)
    return s.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.percentile("value", 0.05), 6).alias("p5"), F.round(F.percentile("value", 0.95), 6).alias("p95"))


@query("with s as (select split, source, verdict, count(*) n from frame_report group by grouping sets ((split), (source), (verdict))) select split, source, verdict, n from s")
def grouping_sets_distribution(spark: SparkSession, sf: str) -> DataFrame:
    f = table(spark, sf, "frame_report").select("split", "source", "verdict")
    return f.groupingSets([["split"], ["source"], ["verdict"]], "split", "source", "verdict").agg(F.count("*").alias("n"))


@query("with m as (select quantile_cont(value, 0.5) med, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.75) q3, min(value) lo, max(value) hi, count(*) n from (select *, count_if(value >= 400) over () g from events) where g < 8 or value >= 400) select trunc(med)::int med, round(q1, 6) q1, round(q3, 6) q3, lo, hi, n from m")
def calibration_summary(spark: SparkSession, sf: str) -> DataFrame:
    g = stats.quality_gated(table(spark, sf, "events").select("value"), "value", 400, 8)
    g = g.withColumn("all", F.lit(1))
    out = stats.beside(g.groupBy("all").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")), quantiles(g, ["all"], "value", {"med": 0.5, "q1": 0.25, "q3": 0.75}), ["all"])
    return out.select(F.col("med").cast("int").alias("med"), F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"), "lo", "hi", "n")


@query("select o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) as best, max(o_totalprice) as score, list_sort(list(o_totalprice))[(count(*) // 2 + 1)::int] as upper_median from orders group by 1")
def best_run(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    best = o.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("best"), F.max("o_totalprice").alias("score"))
    # the upper median is the value at its place in the order, which no task needs a whole customer for
    placed = windows.numbered(o.select("o_custkey", "o_totalprice", "o_orderkey"), ["o_custkey"], [F.col("o_totalprice"), F.col("o_orderkey")], "_i")
    upper = placed.join(best.select("o_custkey", "n"), "o_custkey").where(F.col("_i") == F.floor(F.col("n") / 2)).select("o_custkey", F.col("o_totalprice").alias("upper_median"))
    return best.join(upper, "o_custkey").select("o_custkey", "best", "score", "upper_median")


@query(f"""with {_READ}, r as (select stem, list_sort(list_distinct(list(case when conf < 0.5 then 'low confidence' end) || list(case when cls in (21, 22) then 'alike classes' end))) x, count(*) n, max(conf) c, list_sort(list_distinct(list(cls::varchar))) k from d group by stem)
select stem, n, c as max_conf, array_to_string(k, ',') as classes, array_to_string(x, ' / ') as reasons from r""")
def review_reasons(spark: SparkSession, sf: str, need: Sequence[str] = _NEED) -> DataFrame:
    d = readings(spark, sf, need)
    reasons = F.array_compact(F.array(F.when(F.col("conf") < 0.5, "low confidence"), F.when(F.col("cls").isin(21, 22), "alike classes")))
    r = d.groupBy("stem").agg(F.count("*").alias("n"), F.coalesce(F.max("conf"), F.lit(0.0)).alias("max_conf"), F.array_join(F.array_sort(F.collect_set(F.col("cls").cast("string"))), ",").alias("classes"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(reasons)))), " / ").alias("reasons"))
    return r


@query()
def json_reports(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON object a frame with all its detections nested, in order; a temperature that is no number is null."""
    d = readings(spark, sf, ()).groupBy("stem").agg(F.array_sort(F.collect_list(F.struct("det_id", "cls", "conf", "t_p99", "t_max"))).alias("dets"))
    return d.select("stem", F.to_json(F.struct("stem", F.size("dets").alias("n_det"), "dets"), {"ignoreNullFields": "false"}).alias("report"))


query.sql["json_reports"] = """with d as (select stem, det_id, cls, conf, case when isfinite(t_p99) then t_p99 + 0.0 end t_p99, case when isfinite(t_max) then t_max + 0.0 end t_max from frame_dets)
select stem, to_json({'stem': stem, 'n_det': count(*), 'dets': list({'det_id': det_id, 'cls': cls, 'conf': conf, 't_p99': t_p99, 't_max': t_max} order by det_id)})::varchar as report from d group by stem"""

# The SQL of these asks for t_max and dt_amb though they don't read them, or only where ambient judges; it stays as it is,
# and the whole forms stand beside them.
for _query in (component_judgement, detection_verdicts, class_profile, phase_spread, macro_spread):
    query.queries[f"{_query.__name__}_whole"] = partial(_query, need=("t_p99",))
query.queries["review_reasons_whole"] = partial(review_reasons, need=())
_ANY = "select det_id, stem, cls, conf, case when isfinite(t_p99) then t_p99 end t_p99, case when isfinite(t_max) then t_max end t_max, case when isfinite(dt_amb) then dt_amb end dt_amb, n_px, captured_at from frame_dets"
_WHOLE = f"d as (select * from ({_ANY}) where t_p99 is not null)"
for _name in ("class_profile", "phase_spread", "macro_spread"):
    query.sql[f"{_name}_whole"] = query.sql[_name].replace(_READ, _WHOLE)
query.sql["review_reasons_whole"] = query.sql["review_reasons"].replace(_READ, f"d as ({_ANY})").replace("c as max_conf", "coalesce(c, 0) as max_conf")
#: where ambient must judge and isn't known there is no grade
_UNKNOWN = _JUDGED.replace(_READ, _WHOLE).replace("case when x >= c then 4", "case when x is null then 0 when x >= c then 4")
query.sql["detection_verdicts_whole"] = query.sql["detection_verdicts"].replace(_JUDGED, _UNKNOWN)
query.sql["component_judgement_whole"] = query.sql["component_judgement"].replace(_JUDGED, _UNKNOWN).replace("else ['normal', 'caution', 'abnormal', 'critical'][w.v] end", "else coalesce(['normal', 'caution', 'abnormal', 'critical'][w.v], 'none') end")
