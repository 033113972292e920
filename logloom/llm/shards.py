"""Sharding by extendible hashing.

A shard is a prefix of the bits of a document's hash. A bucket that is larger
than ``max_bytes`` splits on its next bit, and only such a bucket does; a
document's shard is thus its shortest prefix whose bucket fits. Sizes are summed
per prefix of ``step`` more bits than the last round's, for oversized buckets
alone, and rolled up from there, so a round reads narrow rows and shuffles one
row per task and prefix.

Rows equal in key and text share all bits. Where such a group is larger than the
limit by itself, it fills overflow pages of as many whole rows as fit, numbered
behind the prefix. A text above the limit is a shard by itself, marked
``oversized``: it is never cut. Null text has no bytes; null keys are hashed like
others. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.store import stored, texts

MAX_BYTES = 64 << 20
STEP = 12


def shard_documents(docs: DataFrame, max_bytes: int = MAX_BYTES, step: int = STEP) -> DataFrame:
    """(doc_id, bytes, shard, depth, page, oversized), one row per row of ``docs``.

    ``shard``: the prefix as 0s and 1s, followed by ``.page`` on overflow pages.
    """
    sized = stored(
        texts(docs).selectExpr("doc_id", "coalesce(octet_length(text), 0) AS bytes", "xxhash64(doc_id, text) AS h")
        .selectExpr("doc_id", "CAST(bytes AS BIGINT) AS bytes", "lpad(bin(h), 64, '0') AS bits"),
        "sizes",
    )
    left, parts, depth = sized.groupBy("doc_id", "bits", "bytes").agg(F.count("*").alias("n")), [], 0
    left = stored(left, "rows")
    while True:
        top = min(depth + step, 64)
        fine = left.groupBy(F.expr(f"substr(bits, 1, {top})").alias("fine")).agg(F.sum(F.expr("bytes * n")).alias("size"))
        fine = stored(fine, "histogram")
        buckets = (
            fine.select("fine", "size", F.explode(F.sequence(F.lit(depth), F.lit(top))).alias("depth"))
            .withColumn("prefix", F.expr("substr(fine, 1, depth)"))
        )
        fits = buckets.groupBy("prefix").agg(F.sum("size").alias("size")).where(F.col("size") <= max_bytes).select("prefix")
        chosen = buckets.join(fits, "prefix", "left_semi").groupBy("fine").agg(F.min("depth").alias("depth"))
        chosen = stored(fine.select("fine").join(chosen, "fine", "left"), "directory")
        placed = left.withColumn("fine", F.expr(f"substr(bits, 1, {top})")).join(chosen, "fine").drop("fine")
        placed = stored(placed, "placed")
        parts.append(placed.where("depth IS NOT NULL").selectExpr("doc_id", "bits", "bytes", "n", "depth", "false AS alone"))
        left, depth = placed.where("depth IS NULL").drop("depth"), top
        if left.isEmpty():
            break
        if depth == 64:
            parts.append(left.selectExpr("doc_id", "bits", "bytes", "n", "64 AS depth", "true AS alone"))
            break
    directory = parts[0]
    for part in parts[1:]:
        directory = directory.unionByName(part)
    copies = directory.withColumn("copy", F.explode(F.expr("sequence(0L, n - 1)")))
    return copies.selectExpr(
        "doc_id",
        "bytes",
        f"IF(alone, copy DIV greatest(1, {max_bytes} DIV greatest(bytes, 1)), NULL) AS page",
        "depth", "bits",
    ).selectExpr("doc_id", "bytes", "concat_ws('.', substr(bits, 1, depth), page) AS shard", "depth", "page", f"bytes > {max_bytes} AS oversized")
