"""Near-duplicate vectors by binary codes of a random rotation with correction factors.

Equal vectors form one class. Each class vector, scaled to length 1, is turned by random
rotations. The signs of the first rotation are its code, stored with the inner product of the
code (as a unit vector) and the turned vector. This factor makes the code's inner product with
any other vector an unbiased estimate of the true one, with a known confidence bound. A pair
is computed exactly, in double precision, when the upper bound reaches the threshold.

Pairs meet in tables: a table's key is a few signs of a further rotation, as many as give buckets of
about `bucket` background vectors; the number of tables is that at which a pair at the threshold
meets in at least one with probability 1 - `miss`. A pair counts only in the first table
where it meets. Buckets are cut into blocks, and each two blocks are compared in one
task; their pairs are never emitted, only each vector's count and a spanning set of links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, written
from .components import components


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def estimates(codes: np.ndarray, factors: np.ndarray, turned: np.ndarray, sigmas: float
              ) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products of the coded unit vectors with the `turned` ones, and by how much
    the true ones can exceed them (one bound for each code).

    `codes` holds signs, `factors` the inner products of codes and their own vectors. The error of
    an estimate has the deviation sqrt((1 - f²) / f² / (size - 1)) at most.
    """
    size = codes.shape[1]
    found = (codes @ turned.T) / (math.sqrt(size) * factors[:, None])
    bound = sigmas * np.sqrt(np.maximum(1 - factors ** 2, 0) / factors ** 2 / max(size - 1, 1))
    return found, bound


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """`vectors` times powers of two, so that no square overflows; their cosines stay the same."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def tables_for(rows: int, threshold: float, bucket: int, miss: float) -> tuple[int, int]:
    """Signs of a key and number of tables for `rows` vectors."""
    signs = max(0, math.ceil(math.log2(max(rows, 1) / bucket)))
    meet = (1 - math.acos(threshold) / math.pi) ** signs
    return signs, 1 if not signs else math.ceil(math.log(miss) / math.log1p(-meet))


def _linked(left: dict, right: dict, same: bool, table: int, threshold: float, sigmas: float
            ) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the linked pairs of two blocks that meet in no earlier table."""
    firsts, seconds = [], []
    for start in range(0, len(left["id"]), 512):
        part = slice(start, start + 512)
        found, bound = estimates(left["code"][part], left["factor"][part], right["turned"], sigmas)
        a, b = np.nonzero(found + bound[:, None] >= threshold)
        a += start
        if same:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 100_000):
            x, y = a[at:at + 100_000], b[at:at + 100_000]
            fresh = ~(left["keys"][x, :table] == right["keys"][y, :table]).any(axis=1)
            x, y = x[fresh], y[fresh]
            exact = np.einsum("ij,ij->i", left["vector"][x], right["vector"][y])
            exact /= left["norm"][x] * right["norm"][y]
            firsts.append(x[exact >= threshold])
            seconds.append(y[exact >= threshold])
    empty = np.empty(0, np.int64)
    return np.concatenate(firsts or [empty]), np.concatenate(seconds or [empty])


def _spanning(size: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each of `size` positions, the smallest one it is linked with through pairs."""
    root = np.arange(size)
    while True:
        before = root.copy()
        low = np.minimum(root[first], root[second])
        np.minimum.at(root, first, low)
        np.minimum.at(root, second, low)
        root = root[root]
        if (root == before).all():
            return root


def near_vectors(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", *,
                 threshold: float = 0.95, sigmas: float = 4.0, bucket: int = 1024, miss: float = 0.001,
                 block: int = 2048, seed: int = 7) -> DataFrame:
    """One row for each row of `rows`: its id, n_links, component_id, kept.

    Pairs with a cosine of at least `threshold` are linked; a pair at the threshold is missed
    with probability `miss` for want of a common bucket, and with that of a normal deviate beyond
    `sigmas` for its estimate; no pair below is linked. Rows with equal vectors are all linked.
    Vectors that are null, empty, zero or have components that are null or not finite are linked with
    nothing, as are vectors of different lengths; they are components of their own, and kept. A row
    without an id counts as a copy of rows with an equal vector and an id; where there is none, it has no links
    and component_id null. Repeated rows count one by one in n_links, and so do rows that share an id but not a vector, each
    by its own vector. An empty table gives an empty result; other columns are ignored.
    """
    # Floats stay floats on the way, which loses nothing; all computing is in doubles.
    element = rows.schema[vector_column].dataType.elementType.simpleString()
    kind = f"array<{'float' if element == 'float' else 'double'}>"
    values = F.col("v").cast(kind)
    good = (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) \
        & F.exists("v", lambda x: x != 0)
    base = rows.select(F.col(id_column).alias("id"), F.col(vector_column).alias("v")).select(
        "id", F.when(F.coalesce(good, F.lit(False)), values).alias("v"))
    # Equal vectors are one class, which goes by a number of its own, as an id may have several vectors.
    classes = written(base.where("v is not null").groupBy("v").agg(
        F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("class", F.monotonically_increasing_id()),
        "vector-classes")
    count = classes.count()
    signs, tables = tables_for(count, threshold, bucket, miss)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(0)
            sizes = np.diff(np.asarray(lists.offsets))
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.cumsum(sizes) - sizes
            for size in np.unique(sizes):
                size = int(size)
                chosen = np.flatnonzero(sizes == size)
                x = flat[starts[chosen][:, None] + np.arange(size)]
                unit = _scaled(x)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                if size not in turns:
                    wanted = tables * signs
                    turns[size] = np.concatenate([rotation(size, seed + k) for k in range(1 + -(-wanted // size))])
                turned = unit @ turns[size].T
                codes = turned[:, :size] >= 0
                factors = np.abs(turned[:, :size]).sum(axis=1) / math.sqrt(size)
                keys = np.zeros((len(x), tables), np.int32)
                for t in range(tables):
                    part = turned[:, size + t * signs:size + (t + 1) * signs] >= 0
                    keys[:, t] = part @ (1 << np.arange(signs, dtype=np.int32)) if signs else 0
                index = pa.array(chosen)
                yield pa.RecordBatch.from_arrays(
                    [lists.take(index), batch.column(1).take(index), batch.column(2).take(index),
                     pa.array([c.tobytes() for c in np.packbits(codes, axis=1)], pa.binary()),
                     pa.array(factors), pa.array(np.full(len(x), size), pa.int32()),
                     pa.array(list(keys), pa.list_(pa.int32()))],
                    names=["v", "class", "copies", "code", "factor", "size", "keys"])

    named = classes.where("id is not null")
    codes = written(named.select("v", "class", "copies").mapInArrow(
        coded, f"v {kind}, class bigint, copies bigint, code binary, factor double, size int,"
               " keys array<int>"), "vector-codes")
    placed = codes.select("*", F.posexplode("keys").alias("table", "key"))
    sizes = codes.select("size", F.posexplode("keys").alias("table", "key")).groupBy("size", "table", "key").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks")).where("blocks > 1")
    blocked = (placed.join(sizes, ["size", "table", "key"], "left")
               .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
               .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")))
    tiles = (blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
             .select("size", "table", "key", "low", "high", "block", "class", "copies", "v", "code", "factor",
                     F.slice("keys", F.lit(1), F.col("table")).alias("keys")))  # of the earlier tables

    def compared(key: tuple, group: pa.Table) -> pa.Table:
        size, table, _, low, high = (k.as_py() for k in key)
        group = group.combine_chunks()
        order = np.argsort(group["class"].to_numpy(), kind="stable")
        ids, copies = group["class"].to_numpy()[order], group["copies"].to_numpy()[order]
        blocks = group["block"].to_numpy()[order]
        v = _scaled(group["v"].combine_chunks().flatten().to_numpy().reshape(-1, size)[order].astype(np.float64))
        turned = ((v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(size, seed).T).astype(np.float32)
        bits = np.frombuffer(b"".join(group["code"].to_pylist()), np.uint8).reshape(len(ids), -1)[order]
        code = np.unpackbits(bits, axis=1, count=size).astype(np.float32) * 2 - 1
        keys = group["keys"].combine_chunks().flatten().to_numpy().reshape(len(ids), table)[order]
        data = {"id": ids, "vector": v, "norm": np.linalg.norm(v, axis=1), "turned": turned, "code": code,
                "factor": group["factor"].to_numpy()[order].astype(np.float32), "keys": keys}
        at = [np.flatnonzero(blocks == b) for b in (low, high)]
        left, right = ({k: x[i] for k, x in data.items()} for i in at)
        x, y = _linked(left, right, low == high, table, threshold, sigmas)
        first, second = at[0][x], at[1][y]
        links = np.bincount(first, copies[second], len(ids)) + np.bincount(second, copies[first], len(ids))
        roots = _spanning(len(ids), first, second)
        kept = np.flatnonzero(links)
        return pa.table({"class": ids[kept], "links": links[kept].astype(np.int64), "root": ids[roots[kept]]})

    found = checkpointed(tiles.groupBy("size", "table", "key", "low", "high").applyInArrow(
        compared, "class bigint, links bigint, root bigint"))
    groups = written(components(found.select(F.col("class").alias("left"), F.col("root").alias("right")))
                     .join(named.select(F.col("class").alias("node"), "id"), "node"), "vector-components")
    smallest = groups.groupBy("component").agg(F.min("id").alias("smallest"))
    summed = (named.join(found.groupBy("class").agg(F.sum("links").alias("links")), "class", "left")
              .join(groups.join(smallest, "component").select(F.col("node").alias("class"), "smallest"), "class", "left")
              .select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("smallest", "id").alias("component_id")))
    alone = base.where("v is null").select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return (base.where("v is not null").join(summed, "v", "left")
            .select("id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce("component_id", "id").alias("component_id"))
            .unionByName(alone)
            .select(F.col("id").alias(id_column), "n_links", "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")))
