"""Sinks: label texts, annotation XML, reports, incremental and replacing writes, manifests."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def label_texts(boxes: DataFrame, stem: str, idx: str, cls: str = "cls", fields: tuple[str, ...] = ("cx", "cy", "w", "h"), keep: DataFrame | None = None) -> DataFrame:
    """``stem, text``: the lines ``cls cx cy w h`` with six decimals (half to even) in box order, each ended by a line break.

    Frames without boxes have no text, unless ``keep`` (a table of stems) names them: then theirs is empty, and frames it
    doesn't name are left out."""
    line = F.format_string("%d" + " %.6f" * len(fields), F.col(cls), *[F.rint(F.col(c) * 1e6) / 1e6 for c in fields])
    lines = boxes.groupBy(stem).agg(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), line.alias("s")))).alias("ls"))
    out = lines.select(stem, F.concat(F.array_join(F.transform("ls", lambda x: x["s"]), "\n"), F.lit("\n")).alias("text"))
    return out if keep is None else keep.select(stem).distinct().join(out, stem, "left").withColumn("text", F.coalesce("text", F.lit("")))


def escaped(c: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def annotation_xml(boxes: DataFrame, name: str, idx: str, label: str, width: float, height: float) -> DataFrame:
    """``name, xml``: one image element a frame, its boxes in order, clipped to the frame, with two decimals."""
    clip = lambda c, top: F.format_string("%.2f", F.least(F.lit(float(top)), F.greatest(F.lit(0.0), F.col(c))))
    box = F.concat(F.lit('<box label="'), escaped(F.col(label)), F.lit('" occluded="0" source="auto"'), *[F.concat(F.lit(f' {k}="'), clip(c, top), F.lit('"')) for k, c, top in (("xtl", "x1", width), ("ytl", "y1", height), ("xbr", "x2", width), ("ybr", "y2", height))], F.lit(' z_order="0"></box>'))
    lines = boxes.groupBy(name).agg(F.array_sort(F.collect_list(F.when(F.col(label).isNotNull(), F.struct(F.col(idx).alias("i"), box.alias("s"))))).alias("bs"))
    size = f'" width="{width:g}" height="{height:g}">'
    return lines.select(name, F.concat(F.lit('<image name="'), escaped(F.col(name)), F.lit(size), F.array_join(F.transform("bs", lambda x: x["s"]), ""), F.lit("</image>")).alias("xml"))


def write_annotation_xml(images: DataFrame, path: str) -> None:
    """Annotation elements as text files, each a whole document."""

    def document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": ["<annotations>"]})
        for pdf in batches:
            yield pd.DataFrame({"value": pdf["xml"]})
        yield pd.DataFrame({"value": ["</annotations>"]})

    images.select("xml").mapInPandas(document, "value string").write.mode("overwrite").text(path)


def write_report_csv(df: DataFrame, path: str, bom: bool = False) -> list[str]:
    """One CSV folder with header; with ``bom`` the first column's name begins with a byte-order mark. CSV can't hold nested
    columns: they are left out, and their names returned."""
    nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
    flat = df.drop(*nested)
    flat = flat.withColumnRenamed(flat.columns[0], "\ufeff" + flat.columns[0]) if bom else flat
    flat.write.mode("overwrite").option("header", True).csv(path)
    return nested


def write_json(df: DataFrame, path: str) -> None:
    """Nested rows as JSON lines, letters beyond ASCII kept."""
    df.write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str, order: list[str]) -> None:
    """Nested rows as one indented JSON array in one file, in order; letters beyond ASCII and nulls are kept. One document is
    written by one task, row by row."""
    rows = df.select(F.lit(1).alias("part"), F.struct(*order).alias("place"), F.to_json(F.struct(*df.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
    rim = lambda part, sign: df.sparkSession.range(1).select(F.lit(part).alias("part"), F.lit(sign).alias("value"))

    def document(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = True
        for pdf in batches:
            out = []
            for part, text in zip(pdf["part"], pdf["value"], strict=True):
                out.append(text if part != 1 or first else "," + text)
                first = first and part != 1
            yield pd.DataFrame({"value": out})

    whole = rows.unionByName(rim(0, "["), allowMissingColumns=True).unionByName(rim(2, "]"), allowMissingColumns=True).coalesce(1).sortWithinPartitions("part", "place")
    whole.select("part", "value").mapInPandas(document, "value string").write.mode("overwrite").text(path)


def annotation_counts(frames: DataFrame, boxes: DataFrame, name: str, label: str, human: str) -> tuple[DataFrame, DataFrame]:
    """What an annotation file holds: one row ``human, predicted, empty, boxes`` (frames with a box of a person's, with others
    only, without any; boxes), and ``label, n`` of the labels that are used."""
    per = boxes.where(F.col(label).isNotNull()).groupBy(name).agg(F.count("*").alias("_n"), F.max(F.coalesce(human, F.lit(False))).alias("_h"))
    j = frames.select(name).distinct().join(per, name, "left")
    counts = j.agg(F.count_if("_h").alias("human"), F.count_if(~F.col("_h")).alias("predicted"), F.count_if(F.col("_n").isNull()).alias("empty"), F.coalesce(F.sum("_n"), F.lit(0)).alias("boxes"))
    return counts, boxes.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def write_manifest(spark: SparkSession, path: str, root: str, splits: list[str], names: list[str]) -> str:
    """The text of a dataset manifest (YAML: root, a folder a split, class names by number), also written to ``path``."""
    quoted = lambda x: json.dumps(x, ensure_ascii=False)
    lines = [f"path: {quoted(root)}", *[f"{s}: {quoted(f'split={s}')}" for s in splits], "names:", *[f"  {i}: {quoted(n)}" for i, n in enumerate(names)]]
    text = "\n".join(lines)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return text


def write_split_dataset(df: DataFrame, path: str, split: str = "split") -> DataFrame:
    """Rows partitioned by split; returns the manifest ``split, n``."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)
    return df.groupBy(split).agg(F.count("*").alias("n"))


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def append_missing(df: DataFrame, path: str, key: str, force: bool = False) -> int:
    """Write the rows whose key isn't there yet (all, replacing what is there, with ``force``); their number. The rows are
    computed once: they are counted as they are written."""
    spark = df.sparkSession
    hadoop, fs = _folder(spark, path)
    there = fs.exists(hadoop)
    new = df if force or not there else df.join(spark.read.parquet(path).select(key), key, "left_anti")
    seen = Observation()
    new.observe(seen, F.count("*").alias("n")).write.mode("overwrite" if force else "append").parquet(path)
    return int(seen.get.get("n") or 0)


def vacuum(spark: SparkSession, path: str, selection: DataFrame, key: str) -> int:
    """Remove from a parquet folder the rows whose key isn't in the selection; their number. What is kept is written beside
    the folder and then takes its place, so a failure leaves one of the two whole."""
    kept, stale = keep_only(spark.read.parquet(path), selection, key)
    n = stale.count()
    if n:
        kept.write.mode("overwrite").parquet(f"{path}.kept")
        (old, fs), (new, _), (gone, _) = _folder(spark, path), _folder(spark, f"{path}.kept"), _folder(spark, f"{path}.old")
        fs.delete(gone, True)
        fs.rename(old, gone)
        fs.rename(new, old)
        fs.delete(gone, True)
    return n


def keep_only(existing: DataFrame, selection: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, stale) of existing rows against a selection."""
    return existing.join(selection.select(key), key, "left_semi"), existing.join(selection.select(key), key, "left_anti")


def label_colours(classes: DataFrame, ident: str, palette: list[str]) -> DataFrame:
    """Classes with a colour of the palette, by id in turn."""
    return classes.withColumn("color", F.get(F.array(*[F.lit(c) for c in palette]), F.pmod(F.col(ident), F.lit(len(palette))).cast("int")))
