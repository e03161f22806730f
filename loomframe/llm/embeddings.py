"""Near copies among vectors by cosine: an exact join by pigeonhole on subspaces.

Unit vectors are turned by a random rotation and split into blocks of 16 coordinates. Vectors of cosine c are at a
squared distance of 2 - 2c, so in some block they are within that block's share of it. Each block is a range join in 16
dimensions: a k-d tree over a bounded sample cuts the block's space into leaves, whose number grows with the table; a
vector lives in one leaf and visits the others that its ball reaches. Rows of a leaf meet in square tiles; what is
near in the block is compared by the whole vectors in double precision. A pair is counted in the first block that
it is near in, so each link counts once and none is lost.

Crowds of close vectors are not compared with themselves: around each of a bounded number of sampled leaders, all vectors
within half the angle of the threshold are links of each other (the angles add up to the whole at most). Only
their pairs with others are looked at, and tiles of one crowd alone are skipped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loomframe.llm.common import components
from loomframe.session import drop_written, materialise

BLOCK = 16
#: Rows on a side of a tile, rows in a leaf, vectors in the sample, leaders taken from it, members that make a crowd.
TILE, LEAF_ROWS, SAMPLE, LEADERS, CROWD = 2048, 16384, 4096, 256, 256
SEED = 5


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


@dataclass
class Leaves:
    """Boxes of a k-d tree's leaves in one block."""

    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, points: np.ndarray, count: int) -> Leaves:
        low, high = [np.full(points.shape[1], -np.inf)], [np.full(points.shape[1], np.inf)]
        parts = [points]
        while len(parts) < count:
            new_low, new_high, new_parts = [], [], []
            for p, a, b in zip(parts, low, high):
                axis = int(np.argmax(p.var(axis=0))) if len(p) > 1 else 0
                cut = float(np.median(p[:, axis])) if len(p) else 0.0
                left, right = b.copy(), a.copy()
                left[axis] = right[axis] = min(max(cut, a[axis]), b[axis])
                new_low += [a, right]
                new_high += [left, b]
                new_parts += [p[p[:, axis] < cut], p[p[:, axis] >= cut]]
            low, high, parts = new_low, new_high, new_parts
        return cls(np.array(low), np.array(high))

    def visits(self, points: np.ndarray, radius2: float) -> tuple[np.ndarray, np.ndarray]:
        """``(leaf that each point lives in, which leaves its ball reaches)``."""
        gap = np.zeros((len(points), len(self.low)))
        inside = np.ones((len(points), len(self.low)), bool)
        for d in range(points.shape[1]):
            x = points[:, d : d + 1]
            gap += np.maximum(np.maximum(self.low[None, :, d] - x, x - self.high[None, :, d]), 0) ** 2
            inside &= (x >= self.low[None, :, d]) & (x < self.high[None, :, d])
        return np.argmax(inside, axis=1), gap <= radius2


def _usable(batch: pa.RecordBatch) -> list[np.ndarray | None]:
    """The vectors of a batch, None for what links with nothing. Single precision stays as it is, half the bytes of
    double; doubles are scaled to a largest component of 1, so that squares neither overflow nor vanish."""
    out: list[np.ndarray | None] = []
    for v in batch.column("v"):
        x = None
        if v.is_valid and len(v.values) and not v.values.null_count:
            x = v.values.to_numpy()
            top = np.abs(x).max()
            x = None if not np.isfinite(top) or top == 0 else x if x.dtype == np.float32 else x.astype(np.float64) / top
        out.append(x)
    return out


def units(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, size, u)``: the vectors, as bytes, of the rows that can link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = batch.column("id"), _usable(batch)
            good = pa.array([u is not None for u in found])
            kept = [u for u in found if u is not None]
            yield pa.record_batch(
                [ids.filter(good), pa.array([len(u) for u in kept], pa.int32()), pa.array([u.tobytes() for u in kept], pa.binary())], ["id", "size", "u"]
            )

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null and v is not null")
    return rows.mapInArrow(run, "id bigint, size int, u binary").dropDuplicates(["id"])


def _unit(raw: list[bytes], size: int) -> np.ndarray:
    """Unit vectors in double precision."""
    kinds = {4 * size: np.float32, 8 * size: np.float64}
    x = np.array([np.frombuffer(r, kinds[len(r)]) for r in raw], np.float64).reshape(-1, size)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return _unit([x.as_buffer() for x in column], size)


def _leaders(sample: np.ndarray, half: float) -> np.ndarray:
    """Sampled vectors, none within half the angle of another."""
    chosen: list[int] = []
    near = np.zeros(len(sample), int)
    for k in range(len(sample)):
        near[k] = int((sample @ sample[k] >= half).sum())
    for k in np.argsort(-near, kind="stable"):
        if len(chosen) == LEADERS or near[k] < 2:
            break
        if not chosen or (sample[chosen] @ sample[k]).max() < half:
            chosen.append(int(k))
    return sample[chosen]


def _tile_labels(n: int, m: int, a: np.ndarray, b: np.ndarray, ids_x: np.ndarray, ids_y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and column of a tile reaches by the tile's links."""
    x, y = ids_x.copy(), ids_y.copy()
    while True:
        before = x.copy(), y.copy()
        np.minimum.at(x, a, y[b])
        np.minimum.at(y, b, x[a])
        if (x == before[0]).all() and (y == before[1]).all():
            return x, y


def _meet(size: int, rotated: np.ndarray, threshold: float):
    """Tiles to ``(id, links, low)``: links found in the tile, and the smallest id reached by them."""
    blocks = [slice(k, min(k + BLOCK, size)) for k in range(0, size, BLOCK)]
    whole = 2 - 2 * threshold
    budgets = [whole * (s.stop - s.start) / size + 1e-9 for s in blocks]

    def near(x: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
        return ((x[:, blocks[k]] - y[:, blocks[k]]) ** 2).sum(axis=1) <= budgets[k]

    def side(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = column.flatten()
        return rows.field("id").to_numpy(), rows.field("crowd").to_numpy(), _matrix(rows.field("u"), size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1)
                k, same = row.column("block")[0].as_py(), row.column("same")[0].as_py()
                (ids_x, crowd_x, x), (ids_y, crowd_y, y) = side(row.column("x")), side(row.column("y"))
                rx, ry = x @ rotated, y @ rotated
                bx, by = rx[:, blocks[k]].astype(np.float32), ry[:, blocks[k]].astype(np.float32)
                # Single precision is off by less than a millionth here.
                limit = np.float32(budgets[k] + 1e-4)
                d = bx @ by.T
                d *= -2
                d += (bx**2).sum(axis=1)[:, None]
                d += (by**2).sum(axis=1)[None, :]
                a, b = np.nonzero(d <= limit)
                keep = (crowd_x[a] < 0) | (crowd_x[a] != crowd_y[b])
                if same:
                    keep &= ids_x[a] < ids_y[b]
                a, b = a[keep], b[keep]
                good = np.zeros(len(a), bool)
                for low in range(0, len(a), 1 << 14):
                    s = slice(low, low + (1 << 14))
                    linked = np.einsum("ij,ij->i", x[a[s]], y[b[s]]) >= threshold
                    linked &= near(rx[a[s]], ry[b[s]], k)
                    for j in range(k):
                        linked &= ~near(rx[a[s]], ry[b[s]], j)
                    good[s] = linked
                a, b = a[good], b[good]
                low_x, low_y = _tile_labels(len(x), len(y), a, b, ids_x, ids_y)
                n_x, n_y = np.bincount(a, minlength=len(x)), np.bincount(b, minlength=len(y))
                has_x, has_y = n_x > 0, n_y > 0
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate([ids_x[has_x], ids_y[has_y]]), pa.int64()),
                        pa.array(np.concatenate([n_x[has_x], n_y[has_y]]), pa.int64()),
                        pa.array(np.concatenate([low_x[has_x], low_y[has_y]]), pa.int64()),
                    ],
                    ["id", "links", "low"],
                )

    return run


def _linked(rows: DataFrame, size: int, threshold: float) -> DataFrame:
    """``(id, links, low)`` of the vectors of one length; several rows per id."""
    total = rows.count()
    taken = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()  # a bounded sample: it sets cuts, not results
    sample = _unit([bytes(r["u"]) for r in taken], size)
    turn = rotation(size)
    half = math.cos(math.acos(threshold) / 2) + 1e-7
    leaders = _leaders(sample[:1024], half)
    blocks = range(0, size, BLOCK)
    count = 1 << max(0, min(10, math.ceil(math.log2(max(1, total / LEAF_ROWS)))))
    trees = [Leaves.of((sample @ turn)[:, k : k + BLOCK], count) for k in blocks]
    whole = 2 - 2 * threshold

    def crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u = _matrix(batch.column("u"), size)
            crowd = np.full(len(u), -1, np.int32)
            if len(leaders) and len(u):
                cos = u @ leaders.T
                best = cos.argmax(axis=1)
                crowd = np.where(cos[np.arange(len(u)), best] >= half, best, -1).astype(np.int32)
            yield pa.record_batch([batch.column("id"), pa.array(crowd), batch.column("u")], ["id", "crowd", "u"])

    crowded = materialise(rows.select("id", "u").mapInArrow(crowds, "id bigint, crowd int, u binary"), "crowds")
    sums = crowded.where("crowd >= 0").groupBy("crowd").agg(F.count(F.lit(1)).alias("members"), F.min("id").alias("low"))
    sums = F.broadcast(sums)  # at most LEADERS rows
    own = crowded.join(sums, "crowd").select("id", (F.col("members") - 1).alias("links"), "low")
    large = crowded.join(sums, "crowd", "left")
    large = large.select("id", "crowd", "u", F.when(F.col("members") >= CROWD, F.col("crowd")).otherwise(-1).alias("alone"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, len(whole_batch), 2048):
                batch = whole_batch.slice(at, 2048)
                turned = _matrix(batch.column("u"), size) @ turn
                for k, tree in enumerate(trees):
                    part = turned[:, k * BLOCK : (k + 1) * BLOCK]
                    home, reach = tree.visits(part, whole * part.shape[1] / size + 1e-8)
                    # Of two leaves that may hold a pair, the vector of the lower one visits.
                    reach &= np.arange(len(tree.low))[None, :] > home[:, None]
                    row, leaf = np.nonzero(reach)
                    for rows_, leaf_, visitor in ((np.arange(len(part)), home, False), (row, leaf, True)):
                        names = ["id", "crowd", "u", "alone"]
                        taken = [batch.column(n).take(pa.array(rows_)) for n in names]
                        fixed = [pa.array(np.full(len(rows_), k, np.int32)), pa.array(leaf_.astype(np.int32)), pa.array(np.full(len(rows_), visitor))]
                        yield pa.record_batch([*taken, *fixed], [*names, "block", "leaf", "visitor"])

    dealt = large.mapInArrow(deal, "id bigint, crowd int, u binary, alone int, block int, leaf int, visitor boolean")
    dealt = materialise(dealt, "dealt")
    keys = ["block", "leaf", "visitor", "alone"]
    parts = dealt.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts"))
    # One row per leaf and crowd: at most 1,024 leaves a block and 256 crowds.
    placed = dealt.join(F.broadcast(parts), keys).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    chunks = placed.groupBy(*keys, "part").agg(F.collect_list(F.struct("id", "crowd", "u")).alias("rows"))
    chunks = materialise(chunks, "chunks")
    x = chunks.where("not visitor").select("block", "leaf", F.col("alone").alias("ax"), F.col("part").alias("px"), F.col("rows").alias("x"))
    y = chunks.select("block", "leaf", "visitor", F.col("alone").alias("ay"), F.col("part").alias("py"), F.col("rows").alias("y"))
    before = (F.col("ax") < F.col("ay")) | ((F.col("ax") == F.col("ay")) & (F.col("px") <= F.col("py")))
    pure = (F.col("ax") >= 0) & (F.col("ax") == F.col("ay"))
    tiles = x.join(y, ["block", "leaf"]).where((F.col("visitor") | before) & ~pure)
    same = ~F.col("visitor") & (F.col("ax") == F.col("ay")) & (F.col("px") == F.col("py"))
    found = tiles.select("block", same.alias("same"), "x", "y").mapInArrow(_meet(size, turn, threshold), "id bigint, links bigint, low bigint")
    found = materialise(found.groupBy("id", "low").agg(F.sum("links").alias("links")).select("id", "links", "low"), "found")
    drop_written(dealt)
    drop_written(chunks)
    return own.union(found)


def near_vectors(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row.

    ``n_links`` counts the other vectors of at least the threshold's cosine, ``component_id`` is the smallest id reached
    by links and ``kept`` marks the rows that are it. Null, empty and zero vectors and those with null or non-finite
    components link with nothing, nor do vectors of different lengths or rows without an id. Ids identify vectors: of
    rows with one id, one is compared and all get its result.
    """
    found = materialise(units(vectors, id_col, vector_col), "units")
    sizes = [r["size"] for r in found.groupBy("size").count().where("count > 1").orderBy("size").collect()]
    links = None
    for size in sizes:  # the lengths of a table's vectors: one, as a rule
        part = _linked(found.where(F.col("size") == size), size, threshold)
        links = part if links is None else links.union(part)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"))
    if links is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    links = materialise(links, "links")
    labels = components(links.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = links.groupBy("id").agg(F.sum("links").alias("n_links"))
    out = rows.join(counts, "id", "left").join(labels, "id", "left")
    label = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), label.alias("component_id"), F.coalesce(F.col("id") == label, F.lit(True)).alias("kept"))
