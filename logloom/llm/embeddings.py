"""Near-duplicate embeddings by int8 tile products with error bounds.

Unit vectors are quantised to int8 with a scale of their own, and the norm of
what quantisation leaves out is kept. For x = s q + e the product x.y is at most
s_x s_y (q_x.q_y) + |e_x| (1 + |e_y|) + |e_y|, a bound that holds for every
vector. A tile's int8 products are exact integers; only pairs whose bound reaches
the threshold are computed again in double precision. No pair is lost.

Equal vectors are one node with a weight. Tiles have about ``TILE`` nodes, and a
pair of tiles is one row of work that gives back counts and a forest of links,
never all pairs. The number of tile pairs grows with the square of the table.

Vectors that are null, empty, zero or hold null or non-finite components link
with nothing, and vectors of different length don't link. Rows with a null
``vec_id`` take part; repeated rows count as different vectors.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.components import connected_components
from logloom.llm.store import stored

TILE = 2048
#: Pairs computed in double precision at once.
EXACT_AT_ONCE = 1 << 16
#: Rounding of the bound itself, in single precision.
SLACK = 1e-5


def _quantised(x: np.ndarray):
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - scale[:, None] * q, axis=1)


def _unit(rows: pa.Array) -> np.ndarray:
    x = np.stack([v.values.to_numpy() for v in rows.field("vec")])
    x = x / np.abs(x).max(1)[:, None]  # squares of very large or small numbers stay finite
    return x / np.linalg.norm(x, axis=1)[:, None]


def _close(x: np.ndarray, y: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    (qx, sx, ex), (qy, sy, ey) = _quantised(x), _quantised(y)
    product = qx.astype(np.float32) @ qy.astype(np.float32).T  # exact below 2^24
    bound = product * (sx[:, None] * sy).astype(np.float32) + (ex * (1 + ey.max(initial=0)))[:, None].astype(np.float32) + ey.astype(np.float32)
    i, j = np.nonzero(bound >= least - SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), EXACT_AT_ONCE):
        part = slice(at, at + EXACT_AT_ONCE)
        keep[part] = np.einsum("ij,ij->i", x[i[part]], y[j[part]]) >= least
    return i[keep], j[keep]


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node reachable by links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _tile_pairs(batches: Iterator[pa.RecordBatch], least: float):
    """(node, other, links): links counts a node's neighbours with their weights."""
    for batch in batches:
        for n in range(batch.num_rows):
            same = batch["x"][n].as_py() == batch["y"][n].as_py()
            left, right = batch["left"][n].values, batch["right"][n].values
            x = _unit(left)
            y = x if same else _unit(right)
            i, j = _close(x, y, least, same)
            ids = np.concatenate([left.field("node").to_numpy(), right.field("node").to_numpy()])
            weights = np.concatenate([left.field("weight").to_numpy(), right.field("weight").to_numpy()])
            j = j if same else j + len(x)
            links = np.bincount(i, weights[j], len(ids)) + np.bincount(j, weights[i], len(ids))
            label = _forest(i, j, len(ids))
            at = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[at]), pa.array(ids[label[at]]), pa.array(links[at].astype(np.int64))], ["node", "other", "links"]
            )


def embedding_links(nodes: DataFrame, least: float, tile: int = TILE) -> DataFrame:
    """(node, other, links) from all pairs of ``nodes`` (node, vec, weight)."""
    counts = nodes.groupBy(F.size("vec").alias("dim")).agg(F.count("*").alias("n"))
    tiled = nodes.withColumn("dim", F.size("vec")).join(counts, "dim")
    tiled = tiled.selectExpr("dim", "node", "vec", "weight", f"CAST(ceil(n / {tile}) AS BIGINT) AS tiles").withColumn(
        "tile", F.expr("pmod(xxhash64(node, 1), tiles)")
    )
    tiles = stored(
        tiled.groupBy("dim", "tile").agg(F.first("tiles").alias("tiles"), F.collect_list(F.struct("node", "vec", "weight")).alias("rows")),
        "tiles",
    )
    meeting = tiles.select("dim", F.col("tile").alias("x"), F.explode(F.expr("sequence(tile, tiles - 1)")).alias("y"))
    left = tiles.select("dim", F.col("tile").alias("x"), F.col("rows").alias("left"))
    right = tiles.select("dim", F.col("tile").alias("y"), F.col("rows").alias("right"))
    pairs = meeting.repartition("dim", "x", "y").join(left, ["dim", "x"]).join(right, ["dim", "y"])
    return pairs.select("x", "y", "left", "right").mapInArrow(
        functools.partial(_tile_pairs, least=least), "node bigint, other bigint, links bigint"
    )


def near_duplicate_embeddings(
    table: DataFrame, least: float = 0.95, key: str = "vec_id", vector: str = "embedding", tile: int = TILE
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``table``."""
    rows = table.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    usable = F.expr(
        "coalesce(size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(vec, x -> x != 0), false)"
    )
    rows = stored(rows.select("vec_id", F.when(usable, F.col("vec")).alias("vec")).withColumn("key", F.sha2(F.to_json(F.struct("vec")), 256)), "vectors")
    nodes = rows.where("vec IS NOT NULL").groupBy("key").agg(
        F.first("vec").alias("vec"), F.count("*").alias("weight"), F.min("vec_id").alias("first")
    )
    nodes = stored(nodes.withColumn("node", F.xxhash64("key")), "nodes")
    links = stored(embedding_links(nodes, least, tile), "links")
    roots = connected_components(links.select(F.col("node").alias("a"), F.col("other").alias("b"))).select("node", "root")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    placed = nodes.select("key", "node", "weight", "first").join(counted, "node", "left").join(roots, "node", "left")
    placed = stored(placed.selectExpr("key", "weight", "first", "coalesce(links, 0) AS links", "coalesce(root, node) AS root"), "placed")
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = placed.join(named, "root").selectExpr("key", "links + weight - 1 AS n_links", "component_id")
    return (
        rows.join(groups, ["key"], "left")
        .selectExpr(
            "vec_id",
            "IF(vec IS NULL, 0L, n_links) AS n_links",
            "IF(vec IS NULL, vec_id, component_id) AS component_id",
        )
        .withColumn("kept", F.expr("vec_id <=> component_id"))
    )
