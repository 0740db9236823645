"""Near-duplicate embeddings by an epsilon grid order join.

On the unit sphere a cosine of c is a distance of sqrt(2 - 2c), the epsilon. Vectors are rotated to
their principal axes, given the grid cell of side epsilon on the leading ones, and sorted by cell.
The order is cut into blocks of bounded size; a vector is sent only to blocks whose bounding box
comes within epsilon of it, and inside a pair of blocks intervals are halved and skipped by the same
test on their boxes until they are small. What is left is compared on the leading axes first, then exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.components import connected_components
from veilframe.llm.shared import join_hot, materialise, passing

COSINE = 0.95
#: Vectors of a block, and blocks at least (of SMALL_BLOCK vectors each) and at most, as their boxes are held
#: by every task (256 bytes each): beyond BLOCK * MOST_BLOCKS vectors, 130 million, blocks grow.
BLOCK, SMALL_BLOCK, LEAST_BLOCKS, MOST_BLOCKS = 16_384, 2048, 8, 8192
#: Leading axes that are gridded and bounded.
AXES = 16
LEAF = 256
_BITS = 20


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _axes(vectors: DataFrame, dim: int) -> np.ndarray:
    """Principal axes of the unit vectors, the longest first. Only dim squared sums reach the driver."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim * dim + dim + 1)
        for b in batches:
            if b.num_rows:
                x = _unit(_matrix(b.column(0), dim))
                total += np.concatenate([(x.T @ x).ravel(), x.sum(0), [len(x)]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "total"])

    rows = vectors.select("v").mapInArrow(sums, "i long, total double").groupBy("i").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(dim * dim + dim + 1)
    for r in rows:
        total[r.i] = r.total
    n = max(total[-1], 1)
    mean = total[-1 - dim : -1] / n
    _, axes = np.linalg.eigh(total[: dim * dim].reshape(dim, dim) / n - np.outer(mean, mean))
    return axes[:, ::-1]


def _apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
    """Distance of a box from each of some boxes."""
    gap = np.maximum(np.maximum(lows - high, low - highs), 0)
    return np.sqrt((gap * gap).sum(-1))


def _join(a: np.ndarray, b: np.ndarray, pa_: np.ndarray, pb: np.ndarray, least: float, epsilon: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of rows of a and b with a cosine of at least least. pa_, pb: their leading coordinates, in grid order."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        if i == j or k == m or same and k + m < i + j and m <= i:
            continue
        p, q = pa_[i:j], pb[k:m]
        if _apart(p.min(0), p.max(0), q.min(0), q.max(0)) > epsilon:
            continue
        if max(j - i, m - k) > LEAF:
            x, y = (i + j) // 2, (k + m) // 2
            todo += [(i, x, k, y), (i, x, y, m), (x, j, k, y), (x, j, y, m)]
            continue
        if same and m <= i:
            continue
        close = (p * p).sum(1)[:, None] + (q * q).sum(1)[None, :] - 2 * (p @ q.T) <= epsilon * epsilon
        r, c = np.nonzero(close)
        r, c = r + i, c + k
        if same:
            r, c = r[r < c], c[r < c]
        for at in range(0, len(r), 1 << 16):
            x, y = r[at : at + (1 << 16)], c[at : at + (1 << 16)]
            ok = np.einsum("ij,ij->i", a[x], b[y]) >= least
            found.append((x[ok], y[ok]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))


def link_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links and component_id of every row.

    n_links counts the other rows whose cosine with the row is at least cosine, computed in double
    precision; component_id is the least vec_id reachable by links. Vectors of different lengths have no
    cosine: each length is joined by itself, one after another. Rows link with nothing if their vector is
    null, zero, holds a null or a non-finite number, or if their id is null (component null). Equal vectors
    are compared once and count as often as they occur. Other columns are not looked at; an empty table
    gives an empty result.
    """
    x = F.col(vector).cast("array<double>")
    given = vectors.select(F.col(vec_id).alias("vec_id"), x.alias("x"))
    finite = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    usable = F.coalesce(finite & F.col("vec_id").isNotNull(), F.lit(False))
    lengths = {r.dim: r["count"] for r in given.filter(usable).groupBy(F.size("x").alias("dim")).count().collect()}
    joined = sorted(dim for dim, rows in lengths.items() if rows > 1)
    linked = []
    for dim in joined:
        with passing() as keep:
            linked.append(keep(_link_length(given.filter(usable & (F.size("x") == dim)), dim, cosine, block), "linked"))
    # what no other row can be compared with
    alone = given.filter(~(usable & F.size("x").isin(joined))) if joined else given
    alone = alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for one in linked:
        alone = one.unionByName(alone)
    return alone


def _link_length(usable: DataFrame, dim: int, cosine: float, block: int) -> DataFrame:
    """link_vectors() for rows (vec_id, x), at least two, whose vectors are usable and of length dim."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = np.asarray(b.column(1).flatten(), dtype=np.float64).reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([r.tobytes() for r in flat], pa.binary())], ["vec_id", "v"])

    rows = materialise(usable.mapInArrow(packed, "vec_id long, v binary"), "vectors")
    kinds = materialise(rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("times")), "kinds")
    count = kinds.count()
    epsilon, axes = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-9, _axes(kinds, dim)
    k = min(AXES, dim)
    grid = max(epsilon, 1e-6)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = _unit(_matrix(b.column(1), dim)) @ axes[:, :k] if b.num_rows else np.zeros((0, k))
            cells = np.clip(np.floor(p / grid) + 2, 0, 3).astype(np.int64)
            key = np.zeros(len(p), np.int64)
            for c in cells.T:
                key = key * 4 + c
            rep = b.column(0).to_numpy()
            spread = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - _BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(key << _BITS | spread), pa.array(list(p), pa.list_(pa.float64()))], ["rep", "v", "times", "place", "p"])

    ordered = materialise(kinds.select("rep", "v", "times").mapInArrow(placed, "rep long, v binary, times long, place long, p array<double>"), "ordered")
    n_blocks = min(MOST_BLOCKS, max(-(-count // block), min(LEAST_BLOCKS, count // min(block, SMALL_BLOCK))))
    cuts = ordered.agg(F.percentile_approx("place", F.array(*[F.lit(i / n_blocks) for i in range(1, n_blocks)]), F.lit(max(10_000, 20 * n_blocks)))).first()[0] if n_blocks > 1 else []
    cuts = np.array(cuts, np.int64)

    def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("block", pa.array(np.searchsorted(cuts, b.column(3).to_numpy()).astype(np.int64)))

    of_block = ordered.mapInArrow(blocked, "rep long, v binary, times long, place long, p array<double>, block long")
    boxes = of_block.groupBy("block").agg(*[f(F.col("p")[i]).alias(f"{n}{i}") for i in range(k) for n, f in (("l", F.min), ("h", F.max))]).collect()
    blocks = np.array([r.block for r in boxes])
    low, high = (np.array([[r[f"{n}{i}"] for i in range(k)] for r in boxes]) for n in "lh")

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A copy of each vector for its own block, and one for each other block that comes within epsilon of it."""
        names = ["low", "high", "own", "rep", "v", "times", "place"]
        for b in batches:
            own, p = b.column(5).to_numpy(), np.asarray(b.column(4).flatten()).reshape(-1, k)
            for i, y in enumerate(blocks):
                gap = np.maximum(np.maximum(low[i] - p, p - high[i]), 0)
                near = (own == y) | ((gap * gap).sum(1) <= epsilon * epsilon)
                if near.any():
                    x, here = own[near], b.filter(pa.array(near))
                    cell = [pa.array(z.astype(np.int64)) for z in (np.minimum(x, y), np.maximum(x, y), x)]
                    yield pa.RecordBatch.from_arrays([*cell, *[here.column(j) for j in range(4)]], names)

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", kind="stable")
        same = pdf["low"].iloc[0] == pdf["high"].iloc[0]
        left, right = pdf[pdf["own"] == pdf["low"]], pdf[pdf["own"] == pdf["high"]]
        if left.empty or right.empty:
            return pd.DataFrame({x: np.zeros(0, np.int64) for x in ("rep", "links", "root")})
        a, b = (_unit(_matrix(pa.array(x["v"].tolist(), pa.binary()), dim)) for x in (left, right))
        r, c = _join(a, b, a @ axes[:, :k], b @ axes[:, :k], cosine, epsilon, same)
        ids = np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
        times = np.concatenate([left["times"].to_numpy(), right["times"].to_numpy()])
        c = c if same else c + len(left)
        links = np.bincount(r, times[c], minlength=len(ids)) + np.bincount(c, times[r], minlength=len(ids))
        label = ids.copy()  # least id of the vector's component within this pair of blocks
        while True:
            new = label.copy()
            np.minimum.at(new, r, label[c])
            np.minimum.at(new, c, label[r])
            if (new == label).all():
                break
            label = new
        keep = links > 0
        return pd.DataFrame({"rep": ids[keep], "links": links[keep].astype(np.int64), "root": label[keep]})

    copies = of_block.mapInArrow(sent, "low long, high long, own long, rep long, v binary, times long, place long")
    links = materialise(copies.groupBy("low", "high").applyInPandas(joined, "rep long, links long, root long"), "links")
    components = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    of_kind = kinds.select("v", "rep", "times").join(links.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    linked = join_hot(rows, materialise(of_kind, "of_kind"), "v", "times", rows.count())
    return linked.select("vec_id", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))


def op3_embedding_join(spark, sf_dir):
    """link_vectors() of embeddings, whatever their labels; kept marks each component's least id, and is false for rows without an id."""
    linked = link_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return linked.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
