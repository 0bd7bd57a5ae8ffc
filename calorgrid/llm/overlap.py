"""Same and near-same records across splits, by segmented bit fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from calorgrid.functions.keys import stem_struct

FIGURES = ("t_ambient", "t_med", "t_max", "worst_temp")
_BITS = 21


def block_code(text: Column) -> Column:
    """Bit fingerprint of a text block: the parity of each of its hashed letter pairs.

    One letter inserted, dropped or replaced changes at most four bits."""
    edged = F.concat(F.lit("^"), text, F.lit("$"))
    bits = F.transform(
        F.sequence(F.lit(1), F.length(edged) - 1),
        lambda i: F.call_function("shiftleft", F.lit(1), F.pmod(F.xxhash64(F.substr(edged, i, F.lit(2))), F.lit(_BITS)).cast("int")),
    )
    return F.aggregate(bits, F.lit(0), lambda a, b: a.bitwiseXOR(b))


def keyed_frames(frames: DataFrame) -> DataFrame:
    """Frames with a split: side, text (null without a stem of the plain form), whether it names one photo, figures, code
    blocks. Null texts are dropped where keys are made: a filter here would parse every stem twice."""
    side = F.lower(F.regexp_replace("split", r"(?U)\s", ""))
    figure = [(F.col(c).cast("double") + 0.0).alias(c) for c in FIGURES]
    blocks = F.array(F.col("k.cabinet"), F.col("k.day"), F.concat_ws("_", "k.camera", "k.frame"))
    return (
        frames.select("frame_id", side.alias("side"), *figure, stem_struct(F.col("stem"), F.col("panel")).alias("k"))
        .where("side in ('train', 'val', 'test')")
        .select("frame_id", (F.col("side") == "train").alias("train"), *FIGURES, "k.text", "k.valid", F.aggregate(F.reverse(blocks), F.lit(0).cast("long"), lambda c, x: F.call_function("shiftleft", c, F.lit(_BITS)).bitwiseOR(block_code(x).cast("long"))).alias("code"))
    )


def _block(code: Column, k: int) -> Column:
    return F.call_function("shiftright", code, F.lit(k * _BITS)).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long"))


_SAME = 3  # the key that stands for the whole photo; 0 to 2 stand for a block


#: width of a cell of the figures' grid, in degrees: a finer one has fewer candidates, and held-out frames lie near more cells
CELL = 0.5


def _cells(margin: float) -> Column:
    """Cells of the figures' grid that lie within ``margin`` of a frame. Figures beyond the range of numbers of cells share
    the last one, so none is left out."""
    cell = lambda v: F.floor(v / CELL).cast("long")

    def crossed(cells: Column, c: str) -> Column:
        near = F.array_distinct(F.array(cell(F.col(c) - margin), cell(F.col(c) + margin)))
        return F.flatten(F.transform(cells, lambda h: F.transform(near, lambda g: F.xxhash64(h, g))))

    cells = F.array(F.lit(0).cast("long"))
    for c in FIGURES:
        cells = crossed(cells, c)
    return cells


def _keys() -> Column:
    """Join keys of a frame: one of its photo, if the stem names one; of each block one for each of its cells, if the frame
    has all figures."""
    key = lambda k, *parts: F.struct(k.cast("int").alias("block"), F.xxhash64(k.cast("int"), *parts).alias("key"))

    def of_block(k: int) -> Column:
        return F.transform("cells", lambda h: key(F.lit(k), _block(F.col("code"), k), h))

    of_blocks = F.concat(*[of_block(k) for k in range(_SAME)])
    none = F.array().cast("array<struct<block:int,key:bigint>>")
    whole = F.col("text").isNotNull()
    for c in FIGURES:
        whole &= F.col(c).isNotNull()
    return F.concat(F.when(F.col("valid"), F.array(key(F.lit(_SAME), F.col("text")))).otherwise(none), F.when(whole, of_blocks).otherwise(none))


def cross_split_pairs(frames: DataFrame, edits: int = 2, tolerance: float = 0.1) -> DataFrame:
    """``frame_id_a, frame_id_b`` (a < b), one in train, one in val or test, that show the same photo.

    Same: the stems give the same six parts. Near: the plain stems are at most ``edits`` letters apart and all four
    figures are present and agree. A plain stem has three blocks (cabinet; day; camera and frame), so that one block at
    least is the same in both texts of a near pair; blocks are compared by their code, joined within one cell of the
    figures' grid, and the whole code must lie within the Hamming radius ``4 * edits`` before the texts are compared.
    A pair comes out at the first block its codes share. Null split, stem or figure: no pair by it; a NaN or infinite figure
    agrees with none. A frame_id is taken
    to be unique; every row of a repeated one has its pairs."""
    if edits > 2:
        raise ValueError("three blocks find texts that are at most two letters apart")
    base = keyed_frames(frames)
    eps = tolerance + 1e-9
    side = lambda rows, margin, name: rows.withColumn("cells", _cells(margin)).select("frame_id", *FIGURES, "text", "valid", "code", F.inline(_keys())).alias(name)
    left, right = side(base.where("train"), 0.0, "a"), side(base.where("not train"), eps, "b")
    block = F.col("a.block")
    near = F.bit_count(F.col("a.code").bitwiseXOR(F.col("b.code"))) <= 4 * edits
    for c in FIGURES:
        near &= F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) <= eps
    for k in range(_SAME - 1):
        near &= (block <= k) | (_block(F.col("a.code"), k) != _block(F.col("b.code"), k))
    same = F.col("a.text") == F.col("b.text")
    near &= ~(same & F.col("a.valid") & F.col("b.valid")) & (F.levenshtein("a.text", "b.text", edits) >= 0)
    pairs = left.join(right, (F.col("a.key") == F.col("b.key")) & (block == F.col("b.block")) & F.when(block == _SAME, same).otherwise(near))
    return pairs.select(F.least("a.frame_id", "b.frame_id").alias("frame_id_a"), F.greatest("a.frame_id", "b.frame_id").alias("frame_id_b"))


def overlap_report(frames: DataFrame, pairs: DataFrame) -> DataFrame:
    """``split, source, n_pairs, n_frames, n_train``: pairs of each evaluation split and source of its frames."""
    side = F.lower(F.regexp_replace("split", r"(?U)\s", ""))
    ends = F.array(F.struct(F.col("frame_id_a").alias("frame_id"), F.col("frame_id_b").alias("other")), F.struct(F.col("frame_id_b").alias("frame_id"), F.col("frame_id_a").alias("other")))
    ids = pairs.select(F.inline(ends))
    held = frames.select("frame_id", side.alias("split"), "source").where("split in ('val', 'test')")
    return ids.join(held, "frame_id").groupBy("split", "source").agg(
        F.count("*").alias("n_pairs"), F.countDistinct("frame_id").alias("n_frames"), F.countDistinct("other").alias("n_train")
    )
