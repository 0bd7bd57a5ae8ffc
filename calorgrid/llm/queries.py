"""Queries of the text and record problems on the tables of a directory, with SQL where it can tell the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from calorgrid.functions.keys import name_key, panel_key
from calorgrid.llm.bpe import token_counts, token_ids
from calorgrid.llm.overlap import cross_split_pairs, overlap_report
from calorgrid.llm.packing import fill, pack
from calorgrid.llm.quantiles import EPSILON, answers, merged, summarise
from calorgrid.llm.sentences import sentence_places
from calorgrid.llm.splits import cabinet_groups, frame_splits, split_shares
from calorgrid.plans.problems import CENSUS_SQL
from calorgrid.session import checkpointed, spread
from calorgrid.sources.tables import class_names, table

PROPORTIONS = {"train": 0.8, "val": 0.1, "test": 0.1}
SHARES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}
VERDICTS = ("normal", "caution", "abnormal", "critical")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return cabinet_groups(table(spark, sf, "frame_report"), table(spark, sf, "cabinet_moves"))


def p1_splits(spark: SparkSession, sf: str) -> DataFrame:
    return frame_splits(table(spark, sf, "frame_report"), table(spark, sf, "cabinet_moves"), PROPORTIONS, VERDICTS)


def p1_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Whether each split has its share of the frames and of each verdict."""
    frames = table(spark, sf, "frame_report")
    return split_shares(frames, p1_splits(spark, sf), PROPORTIONS, VERDICTS, 0.02).select("split", "label", "kept")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return cross_split_pairs(table(spark, sf, "frame_report"))


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    frames = table(spark, sf, "frame_report")
    return overlap_report(frames, cross_split_pairs(frames))


def _census(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "anomaly_census").select(panel_key(F.col("panel")).alias("panel"), name_key(F.col("cls"), class_names(spark, sf)).alias("cls"), "run_day", "t_p99")


def p5_days(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of t_p99 by panel, class and day."""
    return summarise(_census(spark, sf), ["panel", "cls", "run_day"], "t_p99")


def p5_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    return answers(merged(p5_days(spark, sf), ["panel", "cls"]), ["panel", "cls"], SHARES)


def p5_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Of all keys together, by day."""
    return answers(merged(p5_days(spark, sf), ["run_day"]), ["run_day"], SHARES)


def p5_rank_errors(spark: SparkSession, sf: str) -> DataFrame:
    """``panel, cls, share, n, kept``: whether the value that counters (no lists of updates) give for a share has its rank
    within epsilon n, the ranks being counted on the data. The value's own width, 2**-20 of it, is allowed."""
    rows, keys = _census(spark, sf), ["panel", "cls"]
    told = answers(summarise(rows, keys, "t_p99", most_updates=0), keys, SHARES)
    told = checkpointed(told.unpivot([*keys, "n"], list(SHARES), "share", "x"))
    at = told.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("share", "x"))).alias("xs")).alias("t")
    values = rows.where(F.abs("t_p99") < F.lit(float("inf"))).select(*keys, "t_p99").alias("r")
    # one row a key with a few values: left to Spark's own check of its size
    joined = values.join(at, F.col("r.panel").eqNullSafe(F.col("t.panel")) & F.col("r.cls").eqNullSafe(F.col("t.cls")))
    sides = []
    for name in SHARES:
        x = F.element_at("t.xs", F.lit(name))
        wide = F.abs(x) * 2.0**-20
        sides += [F.count_if(F.col("t_p99") < x - wide).alias(f"below_{name}"), F.count_if(F.col("t_p99") <= x + wide).alias(f"upto_{name}")]
    ranks = joined.groupBy("r.panel", "r.cls").agg(F.count("*").alias("n"), *sides)
    rank = lambda q: F.greatest(F.lit(1), F.ceil(F.col("n") * q - 1e-9))
    kept = lambda name, q: (F.col(f"below_{name}") < rank(q) + EPSILON * F.col("n")) & (F.col(f"upto_{name}") >= rank(q) - EPSILON * F.col("n"))
    out = F.array(*[F.struct(F.lit(name).alias("share"), kept(name, q).alias("kept")) for name, q in SHARES.items()])
    return ranks.select("panel", "cls", "n", F.inline(out))


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return token_ids(spread(table(spark, sf, "documents").select("doc_id", "text"))).select("doc_id", "ids")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    sizes = checkpointed(token_counts(spread(table(spark, sf, "documents").select("doc_id", "text"))).select("doc_id", "n_tokens"))
    # the containers on offer are a fixed table of a few rows
    capacities = [r[0] for r in table(spark, sf, "pack_sizes").select("capacity").where("capacity > 0").distinct().collect()]
    return pack(sizes, "doc_id", "n_tokens", capacities)


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    return fill(p8_containers(spark, sf))


def p8_least(spark: SparkSession, sf: str) -> DataFrame:
    """``capacity, within, least, whole``: whether no container holds more than its capacity, whether there are no more of them
    than the sizes ask for, and whether only texts beyond the capacity are cut."""
    packed = checkpointed(p8_containers(spark, sf))
    each = packed.groupBy("capacity", "container").agg(F.sum("size").alias("used"))
    room = each.groupBy("capacity").agg((F.max("used") <= F.col("capacity")).alias("within"), (F.count("*") <= F.greatest(F.ceil(F.sum("used") / F.col("capacity")), F.lit(1))).alias("least"))
    cut = packed.groupBy("capacity", "doc_id").agg(F.max("piece").alias("last"), F.sum("size").alias("n")).groupBy("capacity").agg(F.min((F.col("last") == 0) | (F.col("n") > F.col("capacity"))).alias("whole"))
    return room.join(cut, "capacity").select("capacity", "within", "least", "whole")


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return sentence_places(spread(table(spark, sf, "documents").select("doc_id", "text")))


QUERIES = {
    f.__name__: f for f in (p1_found, p1_splits, p1_shares, p3_found, p3_report, p5_percentiles, p5_daily, p5_rank_errors, p7_ids, p8_containers, p8_fill, p8_least, p9_found)
}

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)).replace("＇", "") + "　 "
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)).replace("'", "") + "  "
_STEMS = rf"""s as (select *, upper(trim(regexp_replace(translate(stem, '{_WIDE}', '{_NARROW}'), '[\x{{200b}}-\x{{200d}}\x{{2060}}\x{{feff}}\x{{00ad}}]', '', 'g'))) as t from frame_report),
h as (select *, regexp_extract(t, '^(?:.*[^A-Z0-9])?(?:([CE])0*([0-9]+)[-_. ]+B0*([0-9]+)|B0*([0-9]+)[-_. ]+([CE])0*([0-9]+))(?:[-_. ]+P[- ]?0*([0-9]{{1,2}})(?:[^-_. /\\0-9][^-_. /\\]*)?)?(?:[-_. ]+(.*))?$',
  ['a', 'b', 'c', 'd', 'e', 'f', 'p', 'rest']) as m from s),
k as (select frame_id, split, source, t_ambient, t_med, t_max, worst_temp, m.rest as rest, m.a || m.e || m.b || m.f || '_B' || m.c || m.d ||
  case when m.p <> '' then '_P' || m.p when coalesce(regexp_extract(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\s*P[-_ ]*0*([0-9]+)', 1), '') <> ''
  then '_P' || regexp_extract(upper(translate(panel, 'Ｐｐ－０１２３４５６７８９', 'PP-0123456789')), '^\s*P[-_ ]*0*([0-9]+)', 1) else '' end as cabinet from h where m.a || m.e <> '')"""

_PAIRS = f"""{_STEMS},
d as (select *, regexp_extract(rest, '^([0-9OLI./ -]*?)[-_. ]*IR([0-9OLI]*)[-_. ]+#?([0-9OLI]+)(?:[^0-9A-Z].*)?$', ['day', 'cam', 'frame']) as n from k),
d1 as (select *, regexp_replace(translate(trim(n.day), 'OLI', '011'), '[./ ]', '-', 'g') as day0, translate(n.cam, 'OLI', '011') as cam, translate(n.frame, 'OLI', '011') as f0 from d where n.frame <> ''),
d2 as (select *, case when regexp_full_match(day0, '\\d{{8}}') then day0[1:4] || '-' || day0[5:6] || '-' || day0[7:8] when regexp_full_match(day0, '\\d{{6}}') then '20' || day0[1:2] || '-' || day0[3:4] || '-' || day0[5:6]
  when regexp_full_match(day0, '20\\d{{5}}|20\\d{{7}}') then day0[1:4] || '-' || day0[5:6] || '-' || day0[7:] else day0 end as day,
  case when regexp_full_match(f0, '0\\d{{3}}') then f0 when length(ltrim(f0, '0')) < 5 then lpad(ltrim(f0, '0'), 5, '0') else ltrim(f0, '0') end as frame from d1),
x as (select frame_id, lower(trim(split)) as split, t_ambient as f1, t_med as f2, t_max as f3, worst_temp as f4, cabinet || '_' || day || '_IR' || cam || '_' || frame as text,
  cabinet like '%\\_P%' escape '\\' and regexp_full_match(day, '\\d{{4}}-\\d\\d-\\d\\d') and regexp_full_match(cam, '\\d') and not regexp_full_match(f0, '0\\d{{3}}') as valid from d2),
pairs as (select least(a.frame_id, b.frame_id) as frame_id_a, greatest(a.frame_id, b.frame_id) as frame_id_b from x a join x b on a.split = 'train' and b.split in ('val', 'test')
where (a.valid and b.valid and a.text = b.text) or (abs(a.f1 - b.f1) <= 0.1 + 1e-9 and abs(a.f2 - b.f2) <= 0.1 + 1e-9 and abs(a.f3 - b.f3) <= 0.1 + 1e-9 and abs(a.f4 - b.f4) <= 0.1 + 1e-9 and levenshtein(a.text, b.text) <= 2))"""

SQL = {
    "p8_least": "select distinct capacity, true as within, true as least, true as whole from pack_sizes where capacity > 0",
    "p1_shares": """select s as split, l as label, true as kept from (values ('train'), ('val'), ('test')) a(s),
  (select '(all)' as l from frame_report union select case when verdict in ('normal', 'caution', 'abnormal', 'critical') then verdict else '(other)' end from frame_report)""",
    "p5_rank_errors": f"""with {CENSUS_SQL} select panel, cls, share, n, true as kept from (select panel, cls, count(*) n from c where isfinite(t_p99) group by all), (values ('p50'), ('p90'), ('p95'), ('p99')) s(share)""",
    "p1_found": f"""with recursive {_STEMS},
e as (select old_key as a, new_key as b from cabinet_moves union select new_key, old_key from cabinet_moves),
r as (select a as x, a as y from e union select r.x, e.b from r join e on e.a = r.y),
g as (select x, min(y) as component from r group by x)
select frame_id, coalesce(component, cabinet) as group_key from k left join g on x = cabinet""",
    "p3_found": f"""with {_PAIRS} select frame_id_a, frame_id_b from pairs""",
    "p3_report": f"""with {_PAIRS}, i as (select frame_id_a as frame_id, frame_id_b as other from pairs union all select frame_id_b, frame_id_a from pairs)
select lower(trim(split)) as split, source, count(*) as n_pairs, count(distinct frame_id) as n_frames, count(distinct other) as n_train from i join frame_report using (frame_id) where lower(trim(split)) in ('val', 'test') group by all""",
}
