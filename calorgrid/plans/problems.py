"""Queries of the general data problems (2, 4 and 6) on the tables of a directory, with SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calorgrid.functions.keys import name_key, panel_key
from calorgrid.operators.readings import faulty_readings
from calorgrid.operators.rowparse import parse_lines
from calorgrid.operators.skew import heavy_keys, per_key
from calorgrid.sources.tables import class_names, table


def census_rows(spark: SparkSession, sf: str) -> DataFrame:
    """anomaly_census under plain panel and class names."""
    names = class_names(spark, sf)
    return table(spark, sf, "anomaly_census").select("census_id", panel_key(F.col("panel")).alias("panel"), name_key(F.col("cls"), names).alias("cls"), "t_p99", "run_day")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return heavy_keys(census_rows(spark, sf), ["panel", "cls"], 0.04).select("panel", "cls")


def p2_per_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = census_rows(spark, sf)
    out = per_key(rows, ["panel", "cls"], "t_p99", "census_id", heavy_keys(rows, ["panel", "cls"], 0.02))
    return out.select("panel", "cls", "n", "n_value", F.round("mean_value", 6).alias("mean_value"), "max_value", F.array_join(F.col("worst").cast("array<string>"), ",").alias("worst"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return faulty_readings(table(spark, sf, "frame_dets"))


def p6_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(table(spark, sf, "label_lines"), repairs=False).select("line_id", "cls", "cx", "cy", "bw", "bh", "reason")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(table(spark, sf, "label_lines"), repairs=False).where("reason is not null").select("line_id", "reason")


def p6_edits(spark: SparkSession, sf: str) -> DataFrame:
    return parse_lines(table(spark, sf, "label_lines")).where("reason is not null").select("line_id", "reason", F.size("edits").alias("cost"), F.array_join("edits", "; ").alias("edits"))


QUERIES = {"p2_found": p2_found, "p2_per_key": p2_per_key, "p4_found": p4_found, "p6_found": p6_found, "p6_parsed": p6_parsed, "p6_edits": p6_edits}

CENSUS_SQL = """c as (select census_id, t_p99,
  case when regexp_matches(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\\s*P[-_ ]*[0-9]+')
       then 'P' || regexp_extract(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\\s*P[-_ ]*0*([0-9]+)', 1) end as panel,
  coalesce((select min(cls_name) from class_dim d where regexp_replace(d.cls_name, '\\s', '', 'g') =
            regexp_replace(nfc_normalize(anomaly_census.cls), '[\\s\\x{00a0}\\x{3000}]', '', 'g')), anomaly_census.cls) as cls
  from anomaly_census)"""

LINES_SQL = """q as (select line_id, feed, coalesce(raw, '') as raw from label_lines),
f as (select *, case when feed = 'csv' then
    case when not regexp_full_match(raw, '(\\s*"([^"]|"")*"\\s*|[^",]*)(,(\\s*"([^"]|"")*"\\s*|[^",]*))*') then 'quoting'
         when length(regexp_replace(raw, '"([^"]|"")*"', '', 'g')) - length(replace(regexp_replace(raw, '"([^"]|"")*"', '', 'g'), ',', '')) <> 6 then 'columns' end
  when len(list_filter(regexp_split_to_array(raw, '[\\s\\x{00a0}\\x{3000}]+'), lambda x: x <> '')) <> 5 then 'columns' end as early from q),
v as (select line_id, early, case when early is not null then null
  when feed = 'csv' then list_transform(regexp_extract_all(regexp_replace(raw, '^(\\s*"([^"]|"")*"\\s*|[^",]*)', ''), ',(\\s*"([^"]|"")*"\\s*|[^",]*)', 1)[1:5], lambda x: trim(regexp_replace(trim(x, E' \\t\\n\\r'), '^"|"$', '', 'g'), E' \\t\\n\\r'))
  else list_filter(regexp_split_to_array(raw, '[\\s\\x{00a0}\\x{3000}]+'), lambda x: x <> '') end as p from f),
t as (select *, case when regexp_full_match(p[1], '[0-9]+') then try_cast(p[1] as bigint) end as cls,
  list_transform(p[2:5], lambda x: case when regexp_full_match(x, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(x as double) end) as z from v),
r as (select line_id, cls, z, case when early is not null then early when not coalesce(cls between 0 and 25 and z[1] between 0 and 1 and z[2] between 0 and 1
  and z[3] > 0 and z[3] <= 1 and z[4] > 0 and z[4] <= 1, false) then 'value' end as reason from t)"""

SQL = {
    "p2_found": f"with {CENSUS_SQL}, w as (select panel, cls, count(*) n from c where panel is not null and cls is not null group by all) select panel, cls from w where n >= 0.04 * (select sum(n) from w)",
    "p2_per_key": f"""with {CENSUS_SQL}, v as (select *, case when isfinite(t_p99) then t_p99 + 0.0 end as v from c),
x as (select *, row_number() over (partition by panel, cls order by v desc nulls last, census_id) as r from v)
select panel, cls, count(*) as n, count(v) as n_value, round(avg(v), 6) as mean_value, max(v) as max_value,
  coalesce(string_agg(census_id::varchar, ',' order by r) filter (r <= 3 and v is not null), '') as worst from x group by panel, cls""",
    "p4_found": """with b as (select *, coalesce(isnan(t_max) or t_max < -60 or t_max > 650, false) or coalesce(isnan(t_p99) or t_p99 < -60 or t_p99 > 650, false)
  or coalesce(t_p99 > t_max, false) or coalesce(over_range <> (t_max > 250), false) as bad from frame_dets),
ok as (select * from b where not bad and spot_id is not null),
m as (select spot_id, median(t_max) m1, median(t_p99) m2 from ok group by 1),
s as (select spot_id, median(abs(t_max - m1)) s1, median(abs(t_p99 - m2)) s2, any_value(m1) m1, any_value(m2) m2 from ok join m using (spot_id) group by 1),
r0 as (select det_id, spot_id, captured_at, t_max, case when lag(t_max) over w = t_max then 0 else 1 end nw from ok where t_max is not null window w as (partition by spot_id order by captured_at nulls last, det_id)),
r1 as (select *, sum(nw) over (partition by spot_id order by captured_at nulls last, det_id) i from r0),
r2 as (select det_id, count(*) over (partition by spot_id, i) n from r1)
select det_id, 'impossible' as kind from b where bad
union all select det_id, 'spike' from ok join s using (spot_id) where (abs(t_max - m1) >= 8 - 1e-9 and abs(t_max - m1) >= 12 * s1 - 1e-9) or (abs(t_p99 - m2) >= 8 - 1e-9 and abs(t_p99 - m2) >= 12 * s2 - 1e-9)
union all select det_id, 'stuck' from r2 where n >= 6""",
    "p6_found": f"with {LINES_SQL} select line_id, reason from r where reason is not null",
    "p6_parsed": f"with {LINES_SQL} select line_id, case when reason is null then cls::int end as cls, case when reason is null then z[1] end as cx, case when reason is null then z[2] end as cy, case when reason is null then z[3] end as bw, case when reason is null then z[4] end as bh, reason from r",
}
