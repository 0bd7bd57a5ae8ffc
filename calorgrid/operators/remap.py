"""Class numbers of one list turned into those of another: by name, by index, by merging."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vocabulary(first: DataFrame, second: DataFrame | None = None, name: str = "name", ident: str = "cls") -> DataFrame:
    """``name, cls``: names of both tables; where both have a name, the second's number holds. Null names are none; of a name
    that a table has twice the smallest number."""
    each = [t.where(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.min(ident).alias("cls")) for t in (first, second) if t is not None]
    if second is None:
        return each[0]
    a, b = each
    return a.withColumnRenamed("cls", "_a").join(b.withColumnRenamed("cls", "_b"), "name", "full").select("name", F.coalesce("_b", "_a").alias("cls"))


def remap_by_name(rows: DataFrame, names: DataFrame | None, known: DataFrame, cls: str = "cls") -> DataFrame:
    """``rows`` with ``new_cls``: their class's name in ``names`` (id, name), looked up in ``known`` (name, cls); null where the id
    or the name is unknown. Without ``names`` a class keeps its number if ``known`` has it. Both lists are small."""
    if names is None:
        own = known.select(F.col("cls").alias("_old"), F.col("cls").alias("new_cls")).distinct()
    else:
        own = names.select(F.col("id").alias("_old"), "name").join(known, "name").groupBy("_old").agg(F.min("cls").alias("new_cls"))
    return rows.join(own, F.col(cls) == F.col("_old"), "left").drop("_old")


def unmatched(names: DataFrame, known: DataFrame) -> DataFrame:
    """``id, name`` of the classes that ``known`` doesn't have: an import with any should be refused."""
    return names.join(known.select("name"), "name", "left_anti").select("id", "name")


def remap_by_index(rows: DataFrame, table: dict[int, int], cls: str = "cls", keep: bool = False) -> DataFrame:
    """``rows`` with their class by an index table; rows of other classes are dropped, or kept as they are. Several classes may
    become one."""
    to = F.create_map(*[F.lit(x) for pair in table.items() for x in pair]) if table else F.create_map().cast("map<int,int>")
    new = F.try_element_at(to, F.col(cls).cast("int"))
    out = rows.withColumn(cls, F.coalesce(new, F.col(cls)) if keep else new)
    return out if keep else out.where(F.col(cls).isNotNull())


def chosen_classes(rows: DataFrame, known: DataFrame, names: list[str], cls: str = "cls") -> DataFrame:
    """Rows of the classes named; a name that isn't known is an error."""
    ids = {r["name"]: r["cls"] for r in known.where(F.col("name").isin(names)).limit(len(names) + 1).collect()}
    if missing := sorted(set(names) - set(ids)):
        raise ValueError(f"unknown classes: {', '.join(missing)}")
    return rows.where(F.col(cls).isin(list(ids.values())))
