"""Exact k-nearest-neighbour regression as a block join.

Training rows belong to the cell of their nearest pivot. A pivot only cuts
the space: which rows serve as pivots changes the work, never the result.
A test row first meets its nearest cells, enough of them to hold k rows;
their k-th distance bounds what any other cell has to offer, and by the
triangle inequality a cell whose ring of distances around its pivot lies
further off is left out. Neighbouring cells make up zones, both sides of a
zone are dealt into blocks, and a task compares one block of training rows
with one of test rows. So a cell that holds a third of all rows is many
tasks, and nothing but the pivots and three numbers a cell reaches the driver.
A block is some rows more than ``block_rows`` where there are many, as both
sides are sent once for each block of the other.

Within a task a cheap lower bound of the distance (a matrix product, or sums of
rounded coordinates) sorts out nearly all pairs; what it leaves has its
distance taken as ``distances`` does, and only that decides.
"""

from __future__ import annotations

from typing import Callable, Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

__all__ = ["knn_regress", "nearest", "closest", "distances"]


#: numbers that are worked on at a time, so that they stay in the cache
CACHED = 1 << 16


def distances(q: np.ndarray, x: np.ndarray, metric: str) -> np.ndarray:
    """Distances of all rows of ``q`` to all of ``x``, each summed dimension by dimension."""
    out = np.zeros((len(q), len(x)))
    across, step = np.ascontiguousarray(x.T), max(CACHED // max(len(x), 1), 1)
    for i in range(0, len(q), step):
        part = out[i:i + step]
        d = np.empty_like(part)
        for a, b in zip(q[i:i + step].T, across):
            np.subtract(a[:, None], b[None, :], out=d)
            np.multiply(d, d, out=d) if metric == "euclidean" else np.abs(d, out=d)
            part += d
    return np.sqrt(out, out=out) if metric == "euclidean" else out


def _of_pairs(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray, metric: str) -> np.ndarray:
    """The same of some pairs, in the same order of sums."""
    out = np.zeros(len(row))
    step = max(8 * CACHED // q.shape[1], 1)
    for i in range(0, len(row), step):
        d = q[row[i:i + step]] - x[col[i:i + step]]
        for v in np.ascontiguousarray(d.T):
            out[i:i + step] += v * v if metric == "euclidean" else np.abs(v)
    return np.sqrt(out, out=out) if metric == "euclidean" else out


#: test rows and training rows that are screened at a time
TILE = {"euclidean": (256, 2048), "manhattan": (128, 2048)}


def _screen(q: np.ndarray, x: np.ndarray, metric: str) -> Callable[[slice, slice, np.ndarray], np.ndarray] | None:
    """A function of rows of ``q``, rows of ``x`` and a limit for each of the former, that
    leaves out pairs further apart than the limit: nearly all of them and no other, since
    what rounding may add is allowed for. It is a matrix of the pairs that are left in."""
    width = q.shape[1]
    known = np.isfinite(x).all(1)
    centre = x[known].mean(0) if known.any() else np.zeros(width)
    q, x = q - centre, x - centre
    if metric == "euclidean":   # |q|^2 - 2 q x + |x|^2 - limit^2 as one matrix product
        eps = (width + 16) * 1e-15
        one = lambda v: np.ones((len(v), 1))
        left = np.hstack((q, (q * q).sum(1, keepdims=True) * (1 - eps), one(q)))
        right = np.ascontiguousarray(np.hstack((-2 * x, one(x), (x * x).sum(1, keepdims=True) * (1 - eps))).T)

        def within(i: slice, j: slice, limit: np.ndarray) -> np.ndarray:
            a = left[i].copy()
            a[:, width] -= limit * limit * (1 + eps) + 1e-290   # squares may underflow
            return ~(a @ right[:, j] > 0)

        return within
    # Coordinates cut off at some distance and rounded to whole steps: the sum of differences is
    # that of both minus twice that of the lesser ones, in numbers of 16 bits. Some dimensions will do.
    q, x = q[:, :512], x[:, :512]
    width = q.shape[1]
    levels = 65534 // width - 1
    spread = np.abs(x[known])
    reach = min(spread.max(initial=0), 6 * spread.mean()) if known.any() else 0
    if not 0 < reach < np.inf:
        return None
    unit = 2 * reach / levels

    def rounded(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        cut = np.nan_to_num(np.clip(v, -reach, reach))
        n = np.rint((cut + reach) / unit).clip(0, levels)
        return np.ascontiguousarray(n.T.astype(np.uint16)), n.sum(1), np.abs(n * unit - reach - cut).sum(1)

    (qs, q_sum, q_off), (xs, x_sum, x_off) = rounded(q), rounded(x)
    eps = (width + 16) * 1e-14
    loose = eps * (np.abs(q).sum(1) + np.abs(x[known]).sum(1).max(initial=0) + 2 * width * reach)
    base = np.floor(x_sum / 2 - x_off / (2 * unit)) - 1
    start = (base.max() - base).astype(np.uint16)
    odd_q, odd_x = np.isnan(q).any(1), np.isnan(x).any(1)

    def within(i: slice, j: slice, limit: np.ndarray) -> np.ndarray:
        total = np.repeat(start[None, j], i.stop - i.start, axis=0)
        lesser = np.empty_like(total)
        for a, b in zip(qs[:, i], xs[:, j]):
            np.minimum(a[:, None], b[None, :], out=lesser)
            np.add(total, lesser, out=total)
        least = base.max() + q_sum[i] / 2 - (limit * (1 + eps) + q_off[i] + loose[i]) / (2 * unit) - 1
        return (total >= np.nan_to_num(np.floor(least), nan=0).clip(0, 65535).astype(np.uint16)[:, None]) | odd_q[i, None] | odd_x[None, j]

    return within


def closest(q: np.ndarray, x: np.ndarray, rank: np.ndarray, k: int, metric: str, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``q``, rows of ``x`` and distances: the k nearest of ``x`` for each row of ``q``,
    of equal distances that of lower ``rank``, without those beyond the row's ``bound``."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(q) or not len(x):
        return out[0]
    ranked = np.argsort(rank)   # by rank, so that what comes later has to be nearer
    x = x[ranked]
    high, wide = TILE[metric]
    with np.errstate(all="ignore"):
        within = _screen(q, x, metric)
        for i in range(0, len(q), high):
            own = slice(i, min(i + high, len(q)))
            most = np.full(own.stop - i, np.inf) if bound is None else np.where(np.isnan(bound[own]), np.inf, bound[own])
            limit, full, held = most.copy(), np.zeros(len(most), bool), out[0]
            j, step = 0, wide if np.isfinite(limit).all() else min(max(4 * k, 256), wide)
            while j < len(x):
                to = slice(j, min(j + step, len(x)))
                known = within is not None and bool(np.isfinite(limit).all())
                left = within(own, to, limit) if known else None
                if known and 8 * np.count_nonzero(left) <= left.size:
                    row, col = np.divmod(np.flatnonzero(left), to.stop - j)
                    d = _of_pairs(q[own], x[to], row, col, metric)
                else:
                    d = distances(q[own], x[to], metric)
                    best = np.argsort(d, axis=1, kind="stable")[:, :k]
                    row, col, d = np.repeat(np.arange(len(d)), best.shape[1]), best.ravel(), np.take_along_axis(d, best, 1).ravel()
                near = np.where(full[row], d < limit[row], (d <= most[row]) | np.isinf(most[row]))
                if near.any():
                    row, col, d = (np.concatenate(v) for v in zip(held, (row[near], col[near] + j, d[near])))
                    order = np.lexsort((col, d, row))
                    row, col, d = row[order], col[order], d[order]
                    starts = np.searchsorted(row, np.arange(len(limit)))
                    keep = np.arange(len(row)) - starts[row] < k
                    last = np.flatnonzero(np.append(starts[1:], len(row)) - starts >= k)
                    full[last], limit[last] = ~np.isnan(d[starts[last] + k - 1]), np.fmin(limit[last], d[starts[last] + k - 1])
                    held = row[keep], col[keep], d[keep]
                j, step = to.stop, min(4 * step, wide)
            out.append((held[0] + i, ranked[held[1]], held[2]))
    return tuple(np.concatenate(v) for v in zip(*out))


def _matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


#: rows compared with the pivots at a time, bytes of vectors handed on at a time
PIECE, SENT = 1024, 1 << 22


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, PIECE):
            yield b.slice(i, PIECE)


def _placed(rows: DataFrame, pivots: np.ndarray, metric: str) -> DataFrame:
    """``rows(id, x, ...)`` with ``cell`` and ``away``, the nearest pivot and its distance."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS rows
    at = rows.columns.index("x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _pieces(batches):
            d = distances(_matrix(b.column(at), shared.value.shape[1]), shared.value, metric)
            near = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near])],
                                             names=[*b.schema.names, "cell", "away"])

    spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{spec}, cell int, away double")


def _zones(cells: dict[int, tuple[int, float, float]], pivots: np.ndarray, metric: str, rows: int) -> dict[int, int]:
    """Cell -> zone: from a cell on to the nearest one that is left, each zone of at most ``rows`` rows or of one cell."""
    names = np.array(sorted(cells))
    apart = distances(pivots[names], pivots[names], metric)
    left, at, out, size, zone = np.ones(len(names), bool), 0, {}, 0, 0
    while True:
        left[at] = False
        n = cells[names[at]][0]
        if size and size + n > rows:
            zone, size = zone + 1, 0
        out[int(names[at])], size = zone, size + n
        if not left.any():
            return out
        at = int(np.where(left, np.nan_to_num(apart[at], nan=np.inf), np.inf).argmin())
        at = at if left[at] else int(left.argmax())


def _chosen(test: DataFrame, pivots: np.ndarray, cells: dict[int, tuple[int, float, float]], metric: str, k: int, rest: bool, zones: dict[int, int] | None = None) -> DataFrame:
    """``test(id, x[, bound])`` -> (id, x[, bound], zone): the zones of the nearest cells until these hold
    k rows, or with ``rest`` the others that may hold a row within ``bound``. Without ``zones`` a cell is one."""
    shared = test.sparkSession.sparkContext.broadcast((pivots, cells, zones or {c: c for c in cells}))
    kinds = {c: test.schema[c].dataType.simpleString() for c in ("id", "x")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, known, zone = shared.value
        names = np.array(sorted(known, key=lambda c: (zone[c], c)))
        of = np.array([zone[c] for c in names])
        starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        size, least, most = (np.array([known[c][i] for c in names]) for i in range(3))
        for b in _pieces(batches):
            d = distances(_matrix(b.column(1), p.shape[1]), p, metric)[:, names]
            low = np.maximum(np.maximum(d - most, least - d), 0)
            order = np.lexsort((d, low), axis=1)
            before = np.cumsum(size[order], 1) - size[order]
            first = np.zeros(d.shape, bool)
            np.put_along_axis(first, order, before < k, 1)
            pick = np.logical_or.reduceat(first, starts, axis=1)
            if rest:   # Sums of many squares are rounded: a cell at the very edge of the bound is not left out.
                beyond = low > b.column(2).to_numpy(zero_copy_only=False)[:, None] * (1 + 1e-9) + 1e-12
                pick = ~pick & ~np.logical_and.reduceat(beyond, starts, axis=1)
            row, col = np.nonzero(pick)
            # A row goes to many zones, with its vector each time: so much at once, however many zones there are.
            step = max(SENT // (8 * p.shape[1]), 1)
            for i in range(0, len(row), step):
                take = pa.array(row[i:i + step])
                yield pa.RecordBatch.from_arrays([*[c.take(take) for c in b.columns], pa.array(of[starts][col[i:i + step]], pa.int32())], names=[*b.schema.names, "zone"])

    return test.mapInArrow(run, f"id {kinds['id']}, x {kinds['x']}, {'bound double, ' if rest else ''}zone int")


def _table(spark: SparkSession, **columns: Collection[int]) -> DataFrame:
    return spark.createDataFrame(pa.table({c: pa.array(list(v), pa.int32()) for c, v in columns.items()}))


def _compared(train: DataFrame, test: DataFrame, sizes: dict[int, int], width: int, metric: str, k: int, block_rows: int) -> DataFrame:
    """The k nearest rows of each zone for each of its test rows, within their bounds if they have one: (id, d, near, y)."""
    spark = train.sparkSession
    asked = test.groupBy("zone").agg(F.count(F.lit(1)).alias("n"))
    split = _table(spark, zone=sizes.keys(), blocks=[-(-n // block_rows) for n in sizes.values()])  # a row a zone
    split = split.join(asked, "zone").select("zone", "blocks", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    # Ids do not repeat, so their hash deals evenly.
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    bound = [c for c in test.columns if c == "bound"]
    left = train.join(F.broadcast(split), "zone").select("zone", dealt("blocks").alias("block"), every("parts").alias("part"), "id", "x", "y")
    right = test.join(F.broadcast(split), "zone").select("zone", every("blocks").alias("block"), dealt("parts").alias("part"), "id", "x", *bound)

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        ids, own = asks.column("id").combine_chunks(), rows.column("id").combine_chunks()
        rank = np.empty(len(own), np.int64)
        rank[pa.compute.sort_indices(own).to_numpy()] = np.arange(len(own))
        limit = asks.column("bound").to_numpy() if bound else None
        row, col, d = closest(_matrix(asks.column("x"), width), _matrix(rows.column("x"), width), rank, k, metric, limit)
        return pa.table({"id": ids.take(pa.array(row)), "d": d, "near": own.take(pa.array(col)), "y": rows.column("y").to_numpy()[col]})

    kinds = test.schema["id"].dataType.simpleString(), train.schema["id"].dataType.simpleString()
    on = ["zone", "block", "part"]
    return left.groupBy(*on).cogroup(right.groupBy(*on)).applyInArrow(run, f"id {kinds[0]}, d double, near {kinds[1]}, y double")


#: a block has up to so many times ``block_rows`` rows if there are rows for so many tasks a core, and so many bytes of vectors
LARGER, TASKS, BLOCK_BYTES = 4, 4, 1 << 26


def nearest(train: DataFrame, test: DataFrame, k: int = 5, metric: str = "euclidean", block_rows: int = 4096, pivots: int | None = None) -> DataFrame:
    """``train(id, x, y)``, ``test(id, x)`` with arrays of one length -> (id, rank, near,
    d, y): the k nearest training rows of each test row, of equal distances the
    smaller id first. Ids are unique; rows without vector are left out."""
    checkpoint_dir(train.sparkSession)
    single = train.schema["x"].dataType.simpleString() == test.schema["x"].dataType.simpleString() == "array<float>"   # half the bytes to send
    vector = F.col("x") if single else F.col("x").cast("array<double>").alias("x")
    train = train.where("x IS NOT NULL").select("id", vector, F.col("y").cast("double").alias("y"))
    test = test.where("x IS NOT NULL").select("id", vector)
    n = train.count()
    schema = f"id {test.schema['id'].dataType.simpleString()}, rank int, near {train.schema['id'].dataType.simpleString()}, d double, y double"
    if not n:
        return train.sparkSession.createDataFrame([], schema)
    most = pivots or max(1, min(256, int(n ** 0.5 / 2)))
    picked = train.orderBy(F.xxhash64("id")).limit(most).select("x").collect()
    centres = np.array([r.x for r in picked], np.float64)
    train = _placed(train, centres, metric).checkpoint()
    cells = {r.cell: (r.n, r.least, r.most) for r in train.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("least"), F.max("away").alias("most")).collect()}
    pairs, width = n * test.count(), centres.shape[1]
    fair = int((pairs / (TASKS * train.sparkSession.sparkContext.defaultParallelism)) ** 0.5)
    block = max(block_rows, min(LARGER * block_rows, fair, BLOCK_BYTES // (8 * max(width, 1))))
    zones = _zones(cells, centres, metric, block)
    sizes: dict[int, int] = {}
    for c, z in zones.items():
        sizes[z] = sizes.get(z, 0) + cells[c][0]
    of = _table(train.sparkSession, cell=zones.keys(), zone=zones.values())   # a row a cell
    train = train.join(F.broadcast(of), "cell").select("zone", "id", "x", "y")
    first = _compared(train, _chosen(test, centres, cells, metric, k, False, zones), sizes, width, metric, k, block).checkpoint()
    order = Window.partitionBy("id").orderBy("d", "near")  # k rows a block at most, cut to k before they are shuffled
    bound = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).groupBy("id").agg(F.max("d").alias("bound"))
    more = _compared(train, _chosen(test.join(bound, "id").select("id", "x", "bound"), centres, cells, metric, k, True, zones), sizes, width, metric, k, block)
    out = first.unionByName(more).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("id", "rank", "near", "d", "y")


def knn_regress(train: DataFrame, test: DataFrame, features: Sequence[str] | str, label: str, key: str, k: int = 5,
                weights: str = "uniform", metric: str = "euclidean", block_rows: int = 4096) -> DataFrame:
    """G9 (key, prediction): mean label of the k nearest training rows, plain or
    weighted by 1 / distance. ``features``: columns, or one array column."""
    x = F.col(features) if isinstance(features, str) else F.array(*[F.col(c).cast("double") for c in features])
    near = nearest(train.select(F.col(key).alias("id"), x.alias("x"), F.col(label).alias("y")), test.select(F.col(key).alias("id"), x.alias("x")), k, metric, block_rows)
    w = 1 / F.greatest(F.col("d"), F.lit(1e-12)) if weights == "distance" else F.lit(1.0)
    return near.groupBy(F.col("id").alias(key)).agg((F.sum(F.col("y") * w) / F.sum(w)).alias("prediction"))
