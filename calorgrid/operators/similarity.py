"""Vector similarity: best partners, leader clusters, exact and hashed duplicates."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from calorgrid.operators.windows import numbered
from calorgrid.session import SMALL_BYTES, checkpointed, estimated_bytes


def _tiles(df: DataFrame, ident: str, vector: str, block: str) -> DataFrame:
    """``id, v, block`` of rows with a vector; the vector's length is part of the block."""
    return df.where(F.col(vector).isNotNull()).select(F.col(ident).alias("id"), F.col(vector).cast("array<float>").alias("v"), F.concat_ws("|", F.col(block).cast("string"), F.size(vector)).alias("block"))


def best_partners(queries: DataFrame, bank: DataFrame, ident: str, vector: str, block: str, k: int = 2, tile: int = 512) -> DataFrame:
    """``query, partner, score, place``: the ``k`` most similar vectors of the same block for each query (not itself), by
    dot product over length; ties go to the smaller id.

    Queries and bank are tiled within their block, into as many tiles as the block's bank asks for; each pair of tiles is one
    matrix product, whose ``k`` best a query are kept before the shuffle, so that no block is gathered in one task. Null
    vectors, and those of other length, match nothing."""
    q, b = _tiles(queries, ident, vector, block), _tiles(bank, ident, vector, block)
    sizes = b.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("_t"))
    every = F.explode(F.sequence(F.lit(0), F.col("_t") - 1))
    own = F.pmod(F.xxhash64("id"), F.col("_t")).cast("int")
    q = q.join(sizes, "block").select("block", "id", "v", own.alias("tq"), every.alias("tb"))
    b = b.join(sizes, "block").select("block", "id", "v", own.alias("tb"), every.alias("tq"))
    kind = dict(queries.dtypes)[ident]

    def product(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "partner": [], "score": []})
        x, y = np.stack(left["v"].to_list()).astype(float), np.stack(right["v"].to_list()).astype(float)
        right_ids, left_ids = right["id"].to_numpy(), left["id"].to_numpy()
        order = np.argsort(right_ids, kind="stable")
        score = x @ y[order].T / max(x.shape[1], 1)
        right_ids = right_ids[order]
        score[left_ids[:, None] == right_ids[None, :]] = -np.inf
        best = np.argsort(-score, axis=1, kind="stable")[:, : k + 1]
        rows, cols = np.repeat(np.arange(len(x)), best.shape[1]), best.ravel()
        keep = np.isfinite(score[rows, cols])
        return pd.DataFrame({"query": left_ids[rows[keep]], "partner": right_ids[cols[keep]], "score": score[rows[keep], cols[keep]]})

    found = q.groupBy("block", "tq", "tb").cogroup(b.groupBy("block", "tq", "tb")).applyInPandas(product, f"query {kind}, partner {kind}, score double")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "partner")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def leaders(rows: DataFrame, ident: str, vector: str, block: str, least: float = 0.93, first: int = 2048, growth: int = 8, tile: int = 512) -> DataFrame:
    """``ident, leader``: in order of id, a vector joins the first leader of its block that is similar (cosine) by ``least``,
    or leads itself. A null or zero vector leads itself, vectors of other length are of other blocks, null blocks are a block.

    The order is kept in rounds over places in the block, the first of ``first`` places, each next one ``growth`` times
    longer: a round's vectors are first compared with all leaders there are, by tiles in parallel; only those that none of
    them takes are folded in order, a block in one task. So a block of any size takes a logarithm of rounds, and what is
    sequential is what founds new clusters or lies near those that do."""
    kind = dict(rows.dtypes)[ident]
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    data = rows.select(F.col(ident).alias("id"), F.transform(F.col(vector).cast("array<float>"), lambda x: x.cast("double")).alias("v"), F.concat_ws("|", F.col(block).cast("string"), F.coalesce(F.size(vector), F.lit(0))).alias("block"))
    data = data.withColumn("_n", norm)
    alone = data.where("not coalesce(_n > 0, false)").select(F.col("id").alias(ident), F.col("id").alias("leader"))
    unit = data.where("_n > 0").select("block", "id", F.transform("v", lambda x: x / F.col("_n")).alias("v"))
    placed = numbered(unit, ["block"], ["id"], "place")
    if estimated_bytes(rows) < SMALL_BYTES:  # one round is enough
        end, first = 0, 1 << 62
    else:
        placed = checkpointed(placed)
        end = placed.agg(F.max("place")).first()[0]

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now: object = object()
        held, ids, at = np.zeros((0, 0)), [], []  # rows beyond the number of ids are room to grow
        for pdf in batches:
            out = []
            for block_, i, place, v in zip(pdf["block"], pdf["id"], pdf["place"], pdf["v"], strict=True):
                x = np.asarray(v, dtype=float)
                if block_ != now:
                    now, held, ids, at = block_, np.zeros((64, len(x))), [], []
                near = np.flatnonzero(held[: len(ids)] @ x >= least)
                if not len(near):
                    if len(ids) == len(held):
                        held = np.concatenate([held, np.zeros_like(held)])
                    held[len(ids)] = x
                    ids.append(i)
                    at.append(place)
                k = near[0] if len(near) else -1
                out.append((block_, i, place, ids[k], at[k]))
            yield pd.DataFrame(out, columns=["block", "id", "place", "leader", "lead"])

    def taken(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"block": pd.Series([], dtype=object), "place": [], "lead": []})
        right = right.sort_values("place", ignore_index=True)
        near = np.stack(left["v"].to_list()) @ np.stack(right["v"].to_list()).T >= least
        hit = near.any(axis=1)
        return pd.DataFrame({"block": pd.Series([str(left["block"].iloc[0])] * int(hit.sum()), dtype=object), "place": left["place"].to_numpy()[hit], "lead": right["place"].to_numpy()[near[hit].argmax(axis=1)]})

    found, known, lo, hi = [], None, 0, first
    while end is not None and lo <= end:
        batch = placed.where((F.col("place") >= lo) & (F.col("place") < hi))
        rest = batch
        if known is not None:
            tiles = known.groupBy("block").agg(F.ceil(F.count("*") / tile).cast("int").alias("_t"))
            every = F.explode(F.sequence(F.lit(0), F.col("_t") - 1))
            q = batch.join(tiles, "block").select("block", "place", "v", F.floor(F.col("place") / tile).alias("tq"), every.alias("tb"))
            spans = batch.join(tiles, "block").select("block", "_t", F.floor(F.col("place") / tile).alias("tq")).distinct()
            b = known.join(spans, "block").select(*[F.col(c).alias(c) for c in ("block", "place", "v", "tq")], F.pmod(F.xxhash64("place"), F.col("_t")).cast("int").alias("tb"))
            each = q.groupBy("block", "tq", "tb").cogroup(b.groupBy("block", "tq", "tb")).applyInPandas(taken, "block string, place long, lead long")
            joined = checkpointed(each.groupBy("block", "place").agg(F.min("lead").alias("lead")))
            found.append(joined)
            rest = batch.join(joined.select("block", "place"), ["block", "place"], "left_anti")
        schema = f"block string, id {kind}, place long, leader {kind}, lead long"
        folded = rest.select("block", "id", "place", "v").repartition("block").sortWithinPartitions("block", "place").mapInPandas(fold, schema)
        if hi > end and known is None:  # the only round
            return alone.unionByName(folded.select(F.col("id").alias(ident), "leader"))
        if hi > end:  # the last round
            found.append(folded.select("block", "place", "lead"))
            break
        folded = checkpointed(folded)
        found.append(folded.select("block", "place", "lead"))
        new = batch.join(folded.where("place = lead").select("block", "place"), ["block", "place"], "left_semi").select("block", "place", "v")
        known = checkpointed(new if known is None else known.unionByName(new))
        lo, hi = hi, hi * growth
    out = alone
    if found:
        links = found[0]
        for more in found[1:]:
            links = links.unionByName(more)
        ids = placed.select("block", "place", "id")
        named = links.join(ids, ["block", "place"]).join(ids.select("block", F.col("place").alias("lead"), F.col("id").alias("leader")), ["block", "lead"])
        out = alone.unionByName(named.select(F.col("id").alias(ident), "leader"))
    return out


def exact_duplicates(rows: DataFrame, ident: str, content: str) -> DataFrame:
    """``digest, first_id, n`` of contents that occur more than once; null content is no content."""
    return rows.where(F.col(content).isNotNull()).groupBy(F.sha2(content, 256).alias("digest")).agg(F.min(ident).alias("first_id"), F.count("*").alias("n")).where("n > 1")


def members(rows: DataFrame, ident: str, content: str) -> DataFrame:
    """``ident, class_id, n`` of every row with a content: rows of equal content (a digest, a code) are one class, told by its
    smallest id, of ``n`` rows. The classes are joined back, so that no class is gathered in one task."""
    keyed = rows.where(F.col(content).isNotNull()).select(F.col(ident), F.col(content).alias("_c"))
    classes = keyed.groupBy("_c").agg(F.min(ident).alias("class_id"), F.count("*").alias("n"))
    return keyed.join(classes, "_c").select(ident, "class_id", "n")


def sign_hash(vector: str, bits: int = 64) -> Column:
    """64-bit perceptual hash of a small raster: which of its values lie above their mean; null where there is no finite mean,
    so that rasters without values aren't copies of each other."""
    from calorgrid.functions.keys import let
    from calorgrid.functions.numeric import finite

    def hashed(v: Column) -> Column:
        mean = F.when(F.size(v) > 0, F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(v))
        code = lambda m: F.aggregate(F.sequence(F.lit(0), F.lit(bits - 1)), F.lit(0).cast("long"), lambda s, i: s.bitwiseOR(F.when(F.get(v, i).cast("double") > m, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))))
        return let(mean, lambda m: F.when(finite(m).isNotNull(), code(m)))

    return hashed(F.col(vector))


def near_hashes(rows: DataFrame, ident: str, code: str, radius: int = 3, bits: int = 64) -> DataFrame:
    """``id_a, id_b, distance`` of codes within Hamming ``radius``. Equal codes are one class, told by its smallest id;
    ``members`` has the class of each row.

    A code has four segments of a quarter of its bits, and of two codes that near one segment differs in at most radius / 4
    bits (rounded down): codes are joined on a segment, on one side as it is, on the other with up to that many bits
    flipped. So a key has 16 bits of 64 whatever the radius, and the number of keys grows with it instead of the number of
    rows under a key. A pair comes out at its first such segment only."""
    parts, width = 4, bits // 4
    most = radius // parts
    reps = rows.where(F.col(code).isNotNull()).groupBy(F.col(code).alias("c")).agg(F.min(ident).alias("id"))
    segment = lambda c, k: F.call_function("shiftrightunsigned", c, F.lit(k * width)).bitwiseAND(F.lit((1 << width) - 1))
    masks = [sum(1 << b for b in chosen) for n in range(most + 1) for chosen in combinations(range(width), n)]
    flips = F.array(*[F.lit(m).cast("long") for m in masks])
    a = reps.select("id", "c", F.posexplode(F.array(*[segment(F.col("c"), k) for k in range(parts)])).alias("k", "s")).alias("a")
    each = reps.select("id", "c", F.posexplode(F.array(*[segment(F.col("c"), k) for k in range(parts)])).alias("k", "s"))
    b = each.select("id", "c", "k", F.explode(F.transform(flips, lambda m: F.col("s").bitwiseXOR(m))).alias("s")).alias("b")
    first = F.lit(True)
    for k in range(parts - 1):
        first &= (F.col("a.k") <= k) | (F.bit_count(segment(F.col("a.c"), k).bitwiseXOR(segment(F.col("b.c"), k))) > most)
    distance = F.bit_count(F.col("a.c").bitwiseXOR(F.col("b.c")))
    return a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.s") == F.col("b.s")) & (F.col("a.id") < F.col("b.id"))).where(first & (distance <= radius)).select(F.col("a.id").alias("id_a"), F.col("b.id").alias("id_b"), distance.alias("distance"))
