"""Label and annotation sources: box text files, class lists, annotation XML, archives, indexes, logs, file listings."""

from __future__ import annotations

import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CONTROL_FILES = ("classes.txt", "obj.names", "obj.data", "train.txt")


def _stem(path: str) -> Column:
    return F.regexp_replace(F.element_at(F.split(F.col(path), "/"), -1), r"\.[^.]*$", "")


def boxes_of_text(lines: DataFrame, stem: str, text: str, strict: bool = False) -> DataFrame:
    """``stem, box_idx, cls, cx, cy, w, h`` of label texts, one whole text a row; box_idx is the line, from 0.

    ``strict`` takes lines of exactly five fields, else five or more do. Lines with other text are left out."""
    each = lines.select(F.col(stem).alias("stem"), F.posexplode(F.split(F.col(text), r"\r\n|\n|\r")).alias("box_idx", "line"))
    parts = each.withColumn("p", F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " "))
    parts = parts.where(F.size("p") == 5 if strict else F.size("p") >= 5)
    cols = [F.get("p", 0).try_cast("int").alias("cls"), *[F.get("p", i).try_cast("double").alias(c) for i, c in enumerate(("cx", "cy", "w", "h"), 1)]]
    return parts.select("stem", "box_idx", *cols).dropna()


def read_boxes(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Boxes of a folder of label files; the file's name is the stem, control files are left out."""
    files = spark.read.option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").text(path, wholetext=True)
    named = files.select(F.col("_metadata.file_name").alias("file"), "value").where(~F.col("file").isin(*CONTROL_FILES))
    return boxes_of_text(named.withColumn("stem", _stem("file")), "stem", "value", strict)


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``id, name`` of a class list, one name a line, blanks dropped. The list is one small file."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.filter(F.transform(F.split("value", r"\r?\n"), F.trim), lambda x: x != "")).alias("id", "name"))
    return lines


def read_annotation_xml(spark: SparkSession, path: str) -> DataFrame:
    """``name, width, height, box_idx, label, x1, y1, x2, y2, valid`` of an image-per-element annotation file; an image
    without boxes gives one row with nulls; a box without extent isn't valid."""
    schema = "_id long, _name string, _width double, _height double, box array<struct<_label: string, _xtl: double, _ytl: double, _xbr: double, _ybr: double>>"
    images = spark.read.format("xml").option("rowTag", "image").schema(schema).load(path)
    flat = images.select(F.col("_name").alias("name"), F.col("_width").alias("width"), F.col("_height").alias("height"), F.posexplode_outer("box").alias("box_idx", "b"))
    corner = {"x1": "_xtl", "y1": "_ytl", "x2": "_xbr", "y2": "_ybr"}
    return flat.select("name", "width", "height", "box_idx", F.col("b._label").alias("label"), *[F.col(f"b.{v}").alias(k) for k, v in corner.items()]).withColumn("valid", (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))


def read_archives(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``archive, member, content`` of the members with that suffix in the zip files of a folder; a bad archive gives none (see
    ``read_members``, which tells it)."""
    return read_members(spark, path, suffix).where("error is null and archive is not null").select("archive", "member", "content")


def read_members(spark: SparkSession, path: str, suffix: str = ".txt") -> DataFrame:
    """``archive, member, content, error``: texts with that suffix in a folder, as files (archive null) and in its zip files
    alike. A bad archive has one row with its error; a member that can't be read has its own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.lower(F.element_at(F.split("path", "/"), -1))
    loose = files.where(F.endswith(name, F.lit(suffix)) & ~F.endswith(name, F.lit(".zip")))
    plain = loose.select(F.lit(None).cast("string").alias("archive"), F.col("path").alias("member"), F.decode("content", "UTF-8").alias("content"), F.lit(None).cast("string").alias("error"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, blob in zip(pdf["path"], pdf["content"], strict=True):
                rows = []
                try:
                    with zipfile.ZipFile(io.BytesIO(bytes(blob))) as z:
                        for m in z.namelist():
                            if m.endswith(suffix):
                                try:
                                    rows.append((name, m, z.read(m).decode("utf-8", "replace"), None))
                                except (zipfile.BadZipFile, NotImplementedError, RuntimeError, zlib.error) as e:
                                    rows.append((name, m, None, f"{type(e).__name__}: {e}"))
                except (zipfile.BadZipFile, ValueError) as e:
                    rows.append((name, None, None, f"{type(e).__name__}: {e}"))
                yield pd.DataFrame(rows, columns=["archive", "member", "content", "error"])

    zipped = files.where(F.endswith(name, F.lit(".zip"))).select("path", "content").mapInPandas(run, "archive string, member string, content string, error string")
    return plain.unionByName(zipped)


def read_index(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A JSON array of frames."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def detect_source(index: DataFrame, field: str = "source", default: str = "embedded") -> str:
    """The source that the first row of an index names; the default if it names none or there is no such column."""
    row = index.select(field).first() if field in index.columns else None
    return (row and row[0]) or default


def read_review_form(spark: SparkSession, path: str, verdict: str = "verdict") -> DataFrame:
    """Rows of a review form (CSV with header) whose verdict isn't blank."""
    form = read_csv(spark, path)
    return form.where(F.coalesce(F.trim(F.col(verdict)) != "", F.lit(False)))


def read_csv(spark: SparkSession, path: str, comment: str | None = None) -> DataFrame:
    """A CSV file with header; a byte-order mark is no part of the first name, columns are strings."""
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    df = (reader.option("comment", comment) if comment else reader).csv(path)
    return df.toDF(*[c.strip("﻿").strip('"').strip() for c in df.columns])


def training_log(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Columns of a log found by part of their name, as doubles: ``wanted`` has new name -> part."""
    found = {new: next(c for c in df.columns if part in c) for new, part in wanted.items()}
    return df.select(*[F.trim(F.col(f"`{c}`")).try_cast("double").alias(new) for new, c in found.items()])


def list_files(spark: SparkSession, path: str, contains: str = "", without: str = "_rgb_image", glob: str = "*") -> DataFrame:
    """``path, file, stem, size`` of a tree; resource forks (``._``) and names with ``without`` are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("size"))
    named = files.withColumn("file", F.element_at(F.split("path", "/"), -1)).withColumn("stem", _stem("path"))
    return named.where(F.contains("file", F.lit(contains)) & ~F.startswith("file", F.lit("._")) & (~F.contains("file", F.lit(without)) if without else F.lit(True)))


def first_source(files: DataFrame, stem: str = "stem", order: str = "path") -> DataFrame:
    """The first file of each stem."""
    return files.groupBy(stem).agg(F.min(order).alias(order))


