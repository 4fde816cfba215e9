"""Connected components and near-duplicate links of 64-bit hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions.vectors import hamming
from docweave.session import stage_table
from docweave.settings import DEFAULTS


def connected_components(edges: DataFrame) -> DataFrame:
    """``(scope, node, component)`` of the undirected edges ``(scope, a, b)``; the component is its least node.

    Alternates two steps until nothing changes: every node links its larger neighbours
    to its least one, then its smaller neighbours to the least one. Long chains shrink
    by a constant factor per round. Each round is stored.
    """
    links = stage_table(
        edges.filter("a <> b").select("scope", F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct()
    )

    def state(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("scope", "node", "low")).alias("x")).first()
        return row["n"], row["x"]

    current = state(links)
    while True:
        both = links.unionByName(links.select("scope", F.col("low").alias("node"), F.col("node").alias("low")))
        least = both.groupBy("scope", "node").agg(F.least(F.min("low"), F.first("node")).alias("least"))
        large = (
            both.join(least, ["scope", "node"])
            .filter("low > node")
            .select("scope", F.col("low").alias("node"), F.col("least").alias("low"))
            .distinct()
        )
        smallest = large.groupBy("scope", "node").agg(F.min("low").alias("least"))
        small = (
            large.join(smallest, ["scope", "node"])
            .select("scope", F.explode(F.array(F.col("node"), F.col("low"))).alias("node"), F.col("least").alias("low"))
            .filter("node <> low")
            .distinct()
        )
        links = stage_table(small)
        following = state(links)
        if following == current:
            break
        current = following
    roots = links.select("scope", F.col("low").alias("node"), F.col("low").alias("component")).distinct()
    return links.select("scope", "node", F.col("low").alias("component")).unionByName(roots)


def _groups(depth: int, count: int) -> list[int]:
    """64 bits cut into ``count`` masks, another cut at every depth."""
    masks = [0] * count
    for place, bit in enumerate((p * (2 * depth + 1) + depth) % 64 for p in range(64)):
        masks[place * count // 64] |= 1 << bit
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


# Bit groups narrower than this hardly cut a bucket, so hashes are compared block by block instead.
LEAST_GROUP_BITS = 8
# Hashes of one block, and hashes of it compared with another block at a time.
BLOCK_ROWS, STRIP_ROWS = 4096, 256


def _stars(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The connected components of these hashes as stars: (least hash of the component, another hash of it)."""
    left, centres, others = np.sort(hashes), [], []
    while len(left):
        first, todo, left = left[0], left[:1], left[1:]
        while len(todo) and len(left):
            strip, todo = todo[:STRIP_ROWS], todo[STRIP_ROWS:]
            near = (np.bitwise_count((strip[:, None] ^ left[None, :]).view(np.uint64)) <= bits).any(axis=0)
            others.append(left[near])
            centres.append(np.full(near.sum(), first))
            todo, left = np.concatenate([todo, left[near]]), left[~near]
    empty = np.array([], np.int64)
    return np.concatenate([empty, *centres]), np.concatenate([empty, *others])


def _component_links(rest: pa.Table, every: pa.Table, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of different components with a hash of ``rest`` near one of ``every``."""
    values = lambda t, c: t.column(c).to_numpy()
    hashes, names = values(every, "hash"), values(every, "component")
    found = [np.empty((0, 2), np.int64)]
    for at in range(0, rest.num_rows, STRIP_ROWS):
        part = rest.slice(at, STRIP_ROWS)
        own = values(part, "component")
        near = np.bitwise_count((values(part, "hash")[:, None] ^ hashes[None, :]).view(np.uint64)) <= bits
        row, col = np.nonzero(near & (own[:, None] != names[None, :]))
        found.append(np.unique(np.stack([own[row], names[col]], axis=1), axis=0))
    pairs = np.unique(np.concatenate(found), axis=0)
    return pairs[:, 0], pairs[:, 1]


def block_links(nodes: DataFrame, bits: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges ``(scope, a, b)`` with the same components as all pairs of hashes within ``bits`` bits; few more than hashes.

    The hashes of a scope are dealt to blocks twice, and the components of every block become stars. That joins most of
    what hangs together. Any other link has an end outside the largest component of its scope, so these hashes, block by
    block, are compared with all. Tasks hold two blocks, and links inside a component are never written.
    """
    scope_type = nodes.schema["scope"].dataType.simpleString()
    schema = f"scope {scope_type}, a bigint, b bigint"
    hashes = stage_table(nodes.filter("hash IS NOT NULL AND scope IS NOT NULL").select("scope", F.col("hash").cast("bigint").alias("hash")).distinct())
    sizes = hashes.groupBy("scope").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("blocks"))
    sized = hashes.join(sizes, "scope")

    def edges(scope: pa.ChunkedArray, a: np.ndarray, b: np.ndarray) -> pa.Table:
        return pa.table({"scope": pa.array([scope[0].as_py()] * len(a), scope.type), "a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def inside(group: pa.Table) -> pa.Table:
        return edges(group.column("scope"), *_stars(group.column("hash").to_numpy(), bits))

    def across(rest: pa.Table, every: pa.Table) -> pa.Table:
        either = rest if rest.num_rows else every
        return edges(either.column("scope"), *_component_links(rest, every, bits))

    def dealt(seed: int) -> DataFrame:
        return sized.withColumn("block", F.pmod(F.xxhash64("hash", F.lit(seed)), F.col("blocks"))).select("scope", "block", "hash")

    # A scope of one block is done after the first deal.
    stars = stage_table(dealt(1).groupBy("scope", "block").applyInArrow(inside, schema))
    if sizes.filter("blocks > 1").isEmpty():
        return stars
    again = dealt(2).join(sizes.filter("blocks > 1").select("scope"), "scope", "left_semi")
    stars = stage_table(stars.unionByName(again.groupBy("scope", "block").applyInArrow(inside, schema)))
    told = connected_components(stars).withColumnRenamed("node", "hash")
    named = stage_table(
        sized.filter("blocks > 1").join(told, ["scope", "hash"], "left").withColumn("component", F.coalesce("component", "hash"))
    )
    counts = named.groupBy("scope", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = counts.groupBy("scope").agg(F.max(F.struct("n", "component")).alias("m")).select("scope", F.col("m.component").alias("largest"))
    rest = stage_table(named.join(largest, "scope").filter("component <> largest").drop("largest"))
    strips = rest.groupBy("scope").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("strips"))
    run = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    place = lambda n: F.pmod(F.xxhash64("hash", F.lit(3)), F.col(n))
    columns = ["scope", "strip", "block", "hash", "component"]
    left = rest.join(strips, "scope").withColumn("strip", place("strips")).withColumn("block", run("blocks")).select(*columns)
    right = named.join(strips, "scope").withColumn("block", place("blocks")).withColumn("strip", run("strips")).select(*columns)
    keys = ["scope", "strip", "block"]
    joined = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(across, schema)
    return stars.unionByName(stage_table(joined))


def near_links(nodes: DataFrame, bits: int, bucket_rows: int = DEFAULTS.bucket_rows) -> DataFrame:
    """Edges ``(scope, a, b)`` that connect exactly the hashes within ``bits`` differing bits.

    ``nodes``: ``scope, hash``. Equal hashes become one node, so copies cost nothing.
    A bucket of at most ``bucket_rows`` hashes compares its pairs. A larger one is cut:
    hashes within ``bits`` bits agree on at least one of ``bits + 1`` bit groups, so each
    group gives smaller buckets that again hold every close pair. Once the open bits of a
    bucket are no more than ``bits``, all its hashes are close and a star links them.
    """
    # Every round reads its hashes several times.
    rest = stage_table(
        nodes.filter(F.col("hash").isNotNull()).select("scope", "hash").distinct().withColumn("mask", F.lit(0).cast("bigint"))
    )
    found = None
    depth = 0
    while True:
        rest = rest.withColumn("key", F.col("hash").bitwiseAND(F.col("mask")))
        keys = ["scope", "mask", "key"]
        sizes = rest.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least"))
        sized = rest.join(sizes, keys)
        alike = F.lit(64) - F.bit_count("mask") <= bits
        cold = sized.filter((F.col("n") > 1) & (F.col("n") <= bucket_rows) & ~alike).select(*keys, "hash")
        pairs = (
            cold.withColumnRenamed("hash", "a")
            .join(cold.withColumnRenamed("hash", "b"), keys)
            .filter((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= bits))
            .select("scope", "a", "b")
        )
        stars = sized.filter(alike & (F.col("hash") > F.col("least"))).select("scope", F.col("least").alias("a"), F.col("hash").alias("b"))
        links = pairs.unionByName(stars)
        found = links if found is None else found.unionByName(links)
        hot = sized.filter((F.col("n") > bucket_rows) & ~alike).select("scope", "hash", "mask")
        if hot.isEmpty():
            return found.distinct()
        cuts = F.explode(F.lit(_groups(depth, bits + 1)))
        rest = stage_table(
            hot.select("scope", "hash", "mask", cuts.alias("cut"))
            .select("scope", "hash", F.col("mask").bitwiseOR(F.col("cut")).alias("mask"))
            .distinct()
        )
        depth += 1


def near_groups(nodes: DataFrame, bits: int, bucket_rows: int = DEFAULTS.bucket_rows) -> DataFrame:
    """``(scope, hash, component)`` for every distinct hash; single-linkage, so closeness is transitive."""
    hashes = nodes.filter(F.col("hash").isNotNull()).select("scope", "hash").distinct()
    links = near_links(nodes, bits, bucket_rows) if 64 // (bits + 1) >= LEAST_GROUP_BITS else block_links(nodes, bits)
    groups = connected_components(links).withColumnRenamed("node", "hash")
    return hashes.join(groups, ["scope", "hash"], "left").withColumn("component", F.coalesce("component", "hash"))
