"""The k most similar vectors for every vector (problem 5).

Vectors are assigned to the nearest of a number of centres that follows the size of the collection. Each
vector is compared with the members of its own cell, then with those of the few nearest cells, then with those
of all cells so near, by the k-th neighbour known by then, that a neighbour may lie there. Inside a cell
similarity is estimated from randomly rotated one-bit codes: packed bits, counted against the bit planes of the
query, and correction scalars. Pairs whose estimate plus error bound reaches the best exact values so far, of
all cells searched before, are reranked exactly. Cells near one another are searched in one task, so a query
travels there once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

#: Vectors a cell holds on average while the collection is small.
CELL = 1_024
#: The centres are fitted on 64 vectors for each, but on LEAST_SAMPLE where there are so many and on SAMPLE at
#: most, of a model; every vector is indexed.
LEAST_SAMPLE, SAMPLE = 65_536, 262_144
#: Members or queries of one task at most; larger cells are split into blocks.
BLOCK = 32_768
#: Cells searched before the rest, so that the rest is judged by a k-th neighbour that is nearly the true one.
BEFORE = 8
#: Bits of a code, bits of a query's coordinate, and the error bound in standard deviations.
CODE_BITS, QUERY_BITS, DEVIATIONS = 128, 4, 3.0
#: From one chosen pair in so many on, the similarities of all pairs are computed at once.
DENSE = 16
#: A cell is searched if its border is nearer than this share of the distance to the k-th neighbour found so
#: far. 1.0 is a certain bound; a neighbour's offset is spread over all dimensions, so little is missed.
REACH = 0.4


def centres_of(n: int) -> int:
    """How many centres n vectors have: one for each CELL of them, from some millions on four times the root of n.

    That balances finding a vector's cell, n times the centres, with searching it, n times n over the centres.
    The sample gives each centre eight vectors at least.
    """
    return max(1, min(n // CELL, 4 * isqrt(n), SAMPLE // 8))


FOUND = pa.schema([("model", pa.string()), ("q", pa.int64()), ("done", pa.list_(pa.int32())), ("found", pa.list_(pa.struct([("away", pa.float64()), ("key", pa.int64())])))])


def usable(vec: Column, dim: int) -> Column:
    """dim finite numbers, not all zero."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) == dim) & finite & F.exists(vec, lambda x: x != 0), F.lit(False))


@lru_cache(maxsize=4)
def rotation(dim: int, bits: int = CODE_BITS) -> np.ndarray:
    """bits x dim with orthonormal columns, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(20_260).standard_normal((max(bits, dim), dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def fit_centres(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k centres of unit vectors by Lloyd's rounds from a fixed seed; empty centres move to random vectors."""
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        order = np.argsort(near, kind="stable")
        starts = np.searchsorted(near[order], np.arange(k))
        count = np.diff(np.append(starts, len(x)))
        filled = count > 0
        sums = np.add.reduceat(x[order], starts[filled], axis=0)
        centres[filled] = sums / count[filled, None]
        if (~filled).any():
            centres[~filled] = x[rng.choice(len(x), int((~filled).sum()))]
    return centres.astype(np.float32)


def nearest(x: np.ndarray, centres: np.ndarray, rows: int = 128) -> np.ndarray:
    """The centre nearest to each row, some rows at a time, so that what is compared stays in the cache."""
    turned = np.vstack([centres.T, -0.5 * (centres**2).sum(1)])
    ones = np.ones((rows, 1), x.dtype)
    return np.concatenate([(np.hstack([x[i : i + rows], ones[: len(x) - i]]) @ turned).argmax(1) for i in range(0, len(x), rows)]) if len(x) else np.empty(0, np.int64)


def bins_of(centres: np.ndarray, count: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First bin and number of bins of each cell.

    A bin has cells near one another with up to `most` members; a cell above that has bins of its own.
    """
    first, bins, n = np.zeros(len(count), np.int32), np.ones(len(count), np.int32), 0
    parts = [np.arange(len(count))]
    while parts:
        at = parts.pop()
        if len(at) > 1 and count[at].sum() > most:
            apart = centres[at] - centres[at].mean(0)
            at = at[np.argsort(apart @ np.linalg.eigh(apart.T @ apart)[1][:, -1], kind="stable")]
            so_far = np.cumsum(count[at])
            half = min(max(1, int(np.searchsorted(so_far, so_far[-1] / 2))), len(at) - 1)
            parts += [at[half:], at[:half]]
        else:
            first[at], bins[at] = n, max(1, ceil(int(count[at].sum()) / most))
            n += int(bins[at[0]])
    return first, bins


def border_cells(x: np.ndarray, limit: np.ndarray, done: list[list[int]], centres: np.ndarray, count: np.ndarray, radius: np.ndarray, reach: float, few: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row of x, cell): cells not done whose border is within reach, `limit` being the distance to the k-th neighbour; of each row the `few` nearest.

    In single precision; the slack below is above what that is off by, so no cell is lost by it.
    """
    slack, f4 = np.float32(4e-6), np.float32
    norms = (centres**2).sum(1)
    limit = limit.astype(f4) + f4(1e-6)
    part = x.astype(f4)
    d2 = part @ (-2 * centres.T)
    d2 += norms
    d2 += (part**2).sum(1)[:, None]
    own, inverse = np.unique(d2.argmin(1), return_inverse=True)
    nearer = d2.min(1)
    gap = centres[own] @ (-2 * centres.T)
    gap += norms
    gap += norms[own][:, None]
    gap = np.sqrt(np.maximum(gap, 0) + slack)
    rows, cells = [], []
    by_own = np.argsort(inverse, kind="stable")
    for g, mine in zip(gap, np.split(by_own, np.flatnonzero(np.diff(inverse[by_own])) + 1), strict=True):
        # The border is (d2 - nearer) / (2 * gap) away.
        want = d2[mine] < (nearer[mine] + slack)[:, None] + (2 * reach * limit[mine])[:, None] * g
        a, b = np.nonzero(want & (count > 0))
        rows.append(mine[a])
        cells.append(b)
    rows, cells = np.concatenate(rows), np.concatenate(cells)
    near = d2[rows, cells] < (limit[rows] + radius[cells].astype(f4)) ** 2 + slack
    pairs = rows[near] * len(centres) + cells[near]
    seen = np.repeat(np.arange(len(x)), [len(v) for v in done]) * len(centres) + np.array([c for v in done for c in v], np.int64)
    pairs = pairs[~np.isin(pairs, seen)]
    rows, cells = pairs // len(centres), pairs % len(centres)
    if few is not None:
        at = np.searchsorted(own, own[inverse[rows]])
        order = np.lexsort(((d2[rows, cells] - nearer[rows]) / gap[at, cells], rows))
        order = order[np.arange(len(rows)) - np.searchsorted(rows[order], rows[order]) < few]
        rows, cells = rows[order], cells[order]
    return rows, cells


def pack(signs: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    return np.packbits(signs, axis=1, bitorder="little").view(np.uint64)


def unit(raw: list[bytes], dim: int) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), "<f4").reshape(-1, dim).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares of the largest and smallest floats stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class CodedCell:
    """The members of a cell as one-bit codes around its centre."""

    def __init__(self, keys: np.ndarray, x: np.ndarray, centre: np.ndarray, deviations: float = DEVIATIONS):
        self.keys, self.x, self.centre, self.deviations = keys, x, centre.astype(np.float64), deviations
        self.turn = rotation(x.shape[1])
        bits = len(self.turn)
        r = x - self.centre
        self.length = np.maximum(np.linalg.norm(r, axis=1), 1e-12)
        y = (r / self.length[:, None]).astype(np.float32) @ self.turn.T
        self.words = pack(y > 0)
        self.ones = np.bitwise_count(self.words).sum(1).astype(np.float32)
        # Correction: the inner product of a code with its own vector, and from it the spread of an estimate.
        self.own = np.maximum(np.abs(y).sum(1) / np.sqrt(bits), 1e-6)
        self.spread = np.sqrt(np.maximum(1 - self.own**2, 0)) / self.own / np.sqrt(bits - 1)
        self.base = x @ self.centre

    def estimate(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Estimated similarities of queries (rows) to members (columns), and what they may be off by."""
        bits, f4 = len(self.turn), np.float32
        s = q - self.centre
        length = np.maximum(np.linalg.norm(s, axis=1), 1e-12)
        z = (s / length[:, None]).astype(f4) @ self.turn.T
        low, high = z.min(1, keepdims=True), z.max(1, keepdims=True)
        step = np.maximum(high - low, 1e-9) / (2**QUERY_BITS - 1)
        level = np.rint((z - low) / step).astype(np.uint8)
        dots = np.zeros((len(q), len(self.x)), np.uint16)
        for b in range(QUERY_BITS):
            plane = pack((level >> b) & 1)
            ones = np.bitwise_count(plane[:, 0, None] & self.words[None, :, 0])
            for w in range(1, plane.shape[1]):
                ones += np.bitwise_count(plane[:, w, None] & self.words[None, :, w])
            dots += np.multiply(ones, 1 << b, dtype=np.uint16)
        total = low[:, 0] * bits + step[:, 0] * level.sum(1)  # sum of the query's quantised coordinates
        # Single precision is far finer than the bounds.
        about = dots.astype(f4)
        about *= 2 * step
        about += 2 * low * self.ones[None, :]
        about -= total.astype(f4)[:, None]
        about *= length.astype(f4)[:, None]
        about *= (self.length / (np.sqrt(bits) * self.own)).astype(f4)[None, :]
        about += (q @ self.centre - self.centre @ self.centre).astype(f4)[:, None]
        about += self.base.astype(f4)[None, :]
        # Rounding the query adds an error of its own, at most half a step in each coordinate.
        rounding = step / f4(np.sqrt(12))
        off = rounding * (1 / self.own).astype(f4)[None, :]
        off += self.spread.astype(f4)[None, :]
        off *= (self.deviations * length).astype(f4)[:, None]
        off *= self.length.astype(f4)[None, :]
        return about, off

    def search(self, q: np.ndarray, k: int, floor: np.ndarray | None = None, pairs: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, key, similarity) of the k best members of each query, row by row, equal similarity by smaller key.

        `floor` is the similarity of each query's k-th best in other cells, -inf where there are fewer; what is below is left out.
        """
        m, out = len(self.x), []
        floor = np.full(len(q), -np.inf) if floor is None else floor - 1e-11  # similarities are rounded
        for begin in range(0, len(q), max(1, pairs // m)):
            part, least = q[begin : begin + max(1, pairs // m)], floor[begin : begin + max(1, pairs // m)]
            if m > k and np.isfinite(self.deviations):
                about, off = self.estimate(part)
                bar = least.astype(np.float32)[:, None]
                if (open_ := ~np.isfinite(least)).any():
                    first = np.argpartition(-about[open_], k - 1, axis=1)[:, :k]
                    bar[open_] = np.einsum("qkd,qd->qk", self.x[first], part[open_]).min(1, keepdims=True)
                off += about
                chosen = off >= bar - np.float32(1e-5)
                if open_.any():
                    chosen[np.flatnonzero(open_)[:, None], first] = True
            else:
                chosen = np.ones((len(part), m), bool)
            rows, columns = np.divmod(np.flatnonzero(chosen), m)
            if len(rows) * DENSE > chosen.size:  # then a product of matrices is cheaper than fetching the chosen
                sims = (part @ self.x.T)[rows, columns]
            else:
                sims = np.einsum("nd,nd->n", self.x[columns], part[rows])
            sims = sims.round(12)
            if (over := sims >= least[rows]).sum() < len(rows):
                rows, columns, sims = rows[over], columns[over], sims[over]
            order = np.lexsort((self.keys[columns], -sims, rows))
            rows = rows[order]
            order = order[np.arange(len(rows)) - np.searchsorted(rows, rows) < k]
            out.append((begin + rows[np.arange(len(rows)) - np.searchsorted(rows, rows) < k], self.keys[columns[order]], sims[order]))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _vectors(df: DataFrame, key: str, vec: str, model: str, dim: int) -> DataFrame:
    """(model, key, n, raw): usable vectors once per key, vec as bytes; repeated keys take one of their vectors."""
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vec), dim)).select(F.col(key).cast("bigint").alias("id"), F.coalesce(F.col(model).cast("string"), F.lit("")).alias("model"), F.col(vec).cast("array<float>").alias("vec"))
    return rows.groupBy("id").agg(F.min_by(F.struct("model", "vec"), F.xxhash64("vec", "model")).alias("v")).select("id", "v.model", "v.vec")


def nearest_neighbours(df: DataFrame, k: int = 10, dim: int = 64, key: str = "vec_id", vec: str = "vec", model: str = "model", reach: float = REACH, deviations: float = DEVIATIONS) -> DataFrame:
    """(model, id, other, similarity, place): the k most similar others of every usable vector, within its model.

    Usable are `dim` finite numbers that aren't all zero; other rows, null keys included, are left out, and a
    null model counts as the model "". Similarity is the cosine; equal values go to the smaller id. Vectors
    that are copies of one another are searched once. Fewer than k others give fewer rows. With `reach` 1.0
    and infinite `deviations` no neighbour is missed, at the price of many more comparisons.
    """
    spark = df.sparkSession
    ids = cut(_vectors(df, key, vec, model, dim).withColumn("copy_of", F.concat(F.hex(F.xxhash64("vec")), F.hex(F.xxhash64(F.lit(7), F.col("vec"))))))  # 128 bits
    # Of copies only the smallest k + 1 ids can be anyone's neighbours; found slice by slice, so no group is gathered.
    few = lambda c: F.slice(F.array_sort(c), 1, k + 1)
    sliced = ids.groupBy("model", "copy_of", F.pmod(F.xxhash64("id"), F.lit(256)).alias("slice")).agg(few(F.collect_list("id")).alias("few"), F.count(F.lit(1)).alias("n"), F.min_by("vec", "id").alias("vec"))
    groups = sliced.groupBy("model", "copy_of").agg(few(F.flatten(F.collect_list("few"))).alias("few"), F.sum("n").alias("n"), F.first("vec").alias("vec"))
    reps = cut(groups.select("model", "copy_of", F.col("few")[0].alias("key"), "few", "n", "vec"))
    sizes = {r[0]: r[1] for r in reps.groupBy("model").count().collect()}  # one row per embedder
    if not sizes:
        return spark.createDataFrame([], "model string, id bigint, other bigint, similarity double, place int")

    centres: dict[str | None, np.ndarray] = {}
    for name, n in sizes.items():
        own = reps.where(F.col("model").eqNullSafe(name))
        wanted = min(SAMPLE, max(LEAST_SAMPLE, 64 * centres_of(n)))
        # A hash of the key is as good as chance and the same every time.
        part = own.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1_000_000)) < ceil(1_000_000 * min(1.0, wanted / n))) if n > wanted else own
        rows = part.select("key", "vec").orderBy(F.xxhash64("key")).limit(wanted).toPandas().sort_values("key")
        x = np.stack(rows["vec"].to_numpy()).astype(np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        centres[name] = fit_centres((x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32), min(centres_of(n), len(x)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            models, flat = batch.column(0).to_pylist(), batch.column(2).flatten().to_numpy().astype("<f4").reshape(-1, dim)
            cell, away = np.zeros(len(flat), np.int32), np.zeros(len(flat))
            for name in set(models):
                at = np.array([m == name for m in models])
                x = unit([flat[at].tobytes()], dim).astype(np.float32)
                cell[at] = nearest(x, centres[name])
                away[at] = np.linalg.norm(x - centres[name][cell[at]], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([v.tobytes() for v in flat], pa.binary()), pa.array(cell), pa.array(away)], names=["model", "key", "raw", "cell", "away"])

    members = cut(reps.select("model", "key", "vec").mapInArrow(assign, "model string, key bigint, raw binary, cell int, away double"))
    # One row per centre, so SAMPLE // 8 per embedder at most.
    count: dict[str | None, np.ndarray] = {m: np.zeros(len(c), np.int64) for m, c in centres.items()}
    radius = {m: np.zeros(len(c)) for m, c in centres.items()}
    for m, c, n, away in members.groupBy("model", "cell").agg(F.count(F.lit(1)), F.max("away")).collect():
        count[m][c], radius[m][c] = n, away
    bins = {m: bins_of(c, count[m], min(BLOCK, max(2 * CELL, sizes[m] // 64))) for m, c in centres.items()}
    of_cell = F.broadcast(spark.createDataFrame([(m, c, int(f), int(n)) for m, b in bins.items() for c, (f, n) in enumerate(zip(*b, strict=True))], "pm string, pc int, first int, bins int"))
    binned = members.join(of_cell, F.col("model").eqNullSafe(F.col("pm")) & (F.col("cell") == F.col("pc"))).select("model", "key", "raw", "cell", (F.col("first") + F.pmod(F.xxhash64("key"), F.col("bins")).cast("int")).alias("bin"))

    PLAN = "model string, q bigint, qraw binary, kth double, places array<struct<bin:int,cells:array<int>>>"

    def planned(batch: pa.RecordBatch, rows: np.ndarray, cells: np.ndarray) -> pa.RecordBatch:
        """One row per query (model, q, qraw, kth) that has cells to search, with the bins of those cells."""
        models, first, n = np.array(batch.column(0).to_pylist(), object)[rows], np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for name in set(models):
            mine = models == name
            first[mine], n[mine] = bins[name][0][cells[mine]], bins[name][1][cells[mine]]
        rows, cells, at = np.repeat(rows, n), np.repeat(cells, n), np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        order = np.lexsort((cells, at, rows))
        rows, cells, at = rows[order], cells[order], at[order]
        place = np.flatnonzero(np.append(True, (np.diff(rows) != 0) | (np.diff(at) != 0))) if len(rows) else np.empty(0, np.int64)
        ask = np.flatnonzero(np.append(True, np.diff(rows[place]) != 0)) if len(rows) else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.append(place, len(rows)), pa.int32()), pa.array(cells, pa.int32()))
        places = pa.ListArray.from_arrays(pa.array(np.append(ask, len(place)), pa.int32()), pa.StructArray.from_arrays([pa.array(at[place], pa.int32()), lists], names=["bin", "cells"]))
        return pa.RecordBatch.from_arrays([*(batch.column(j).take(pa.array(rows[place[ask]], pa.int64())) for j in range(4)), places], names=["model", "q", "qraw", "kth", "places"])

    def scan(plan: DataFrame) -> DataFrame:
        """(model, q, done, found) for a plan: the k + 1 best of each bin's cells that reach kth, and those cells."""
        queries = plan.select("model", "q", "qraw", "kth", F.inline("places"))
        load = plan.select("model", F.explode("places.bin").alias("bin")).groupBy("model", "bin").count().collect()  # no more rows than cells and blocks of members
        if not load:
            return spark.createDataFrame([], "model string, q bigint, done array<int>, found array<struct<away:double,key:bigint>>")
        blocks = F.broadcast(spark.createDataFrame([(m, b, ceil(n / BLOCK)) for m, b, n in load], "pm string, pb int, qb int"))
        on = F.col("model").eqNullSafe(F.col("pm")) & (F.col("bin") == F.col("pb"))
        left = binned.join(blocks, on).select("model", "bin", F.lit(False).alias("asks"), "key", "raw", F.lit(None).cast("double").alias("kth"), F.array("cell").alias("cells"), F.explode(F.sequence(F.lit(0), F.col("qb") - 1)).alias("q_block"))
        right = queries.join(blocks, on).select("model", "bin", F.lit(True).alias("asks"), F.col("q").alias("key"), F.col("qraw").alias("raw"), "kth", "cells", F.pmod(F.xxhash64("q"), F.col("qb")).cast("int").alias("q_block"))

        def search(group: pa.Table) -> pa.Table:
            group = group.combine_chunks()
            asks = group["asks"].to_numpy()
            inside, asking = group.filter(pa.array(~asks)), group.filter(pa.array(asks))
            if not len(inside) or not len(asking):
                return pa.table([pa.array([], t) for t in FOUND.types], schema=FOUND)
            name = group["model"][0].as_py()
            keys, x, cell = inside["key"].to_numpy(), unit(inside["raw"].to_pylist(), dim), inside["cells"].combine_chunks().flatten().to_numpy()
            q, kth, lists = unit(asking["raw"].to_pylist(), dim), asking["kth"].to_numpy().astype(np.float64), asking["cells"].combine_chunks()
            floor = np.where(np.isnan(kth), -np.inf, -kth)
            rows, wanted = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            order = np.argsort(wanted, kind="stable")
            rows, wanted = rows[order], wanted[order]
            out: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
            for c in np.unique(wanted):
                mine, asked = np.flatnonzero(cell == c), rows[np.searchsorted(wanted, c) : np.searchsorted(wanted, c, "right")]
                if len(mine):
                    r, k_, s = CodedCell(keys[mine], x[mine], centres[name][c], deviations).search(q[asked], k + 1, floor[asked])
                    out.append((asked[r], k_, s))
            rows, found, sims = (np.concatenate(v) for v in zip(*out, strict=True))
            order = np.lexsort((found, -sims, rows))
            rows = rows[order]
            best = np.arange(len(rows)) - np.searchsorted(rows, rows) <= k
            rows, order = rows[best], order[best]
            ends = np.searchsorted(rows, np.arange(len(q)), "right")
            pairs = pa.StructArray.from_arrays([pa.array(-sims[order]), pa.array(found[order], pa.int64())], names=["away", "key"])
            return pa.table([asking["model"], asking["key"], lists, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pairs)], schema=FOUND)

        return left.unionByName(right).groupBy("model", "bin", "q_block").applyInArrow(search, "model string, q bigint, done array<int>, found array<struct<away:double,key:bigint>>")

    best = lambda c: F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))), 1, k + 1)

    def first_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The own cell, and for small cells the nearest ones until there are k + 1 members."""
        for batch in batches:
            models, cells = batch.column(0).to_pylist(), batch.column(4).to_numpy()
            enough = np.array([count[m][c] > k for m, c in zip(models, cells, strict=True)], bool)
            rows, at = np.flatnonzero(enough).tolist(), cells[enough].tolist()
            for i in np.flatnonzero(~enough):
                m, c = models[i], int(cells[i])
                x = unit([batch.column(2)[i].as_py()], dim)[0]
                near = np.argsort(((centres[m] - x) ** 2).sum(1), kind="stable")
                near = [c, *near[near != c]]
                needed = int(np.searchsorted(np.cumsum(count[m][near]), k + 1)) + 1
                rows += [i] * len(near[:needed])
                at += [int(v) for v in near[:needed]]
            yield planned(batch, np.array(rows, np.int64), np.array(at, np.int64))

    def more_cells(few: int | None):
        """The cells not searched yet whose border is within reach; the `few` nearest of them."""

        def more(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for start in range(0, whole.num_rows, 1_024):
                    batch = whole.slice(start, 1_024)
                    models, raws, done = np.array(batch.column(0).to_pylist(), object), batch.column(2).to_pylist(), batch.column(4).to_pylist()
                    kth = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
                    limit = np.where(np.isnan(kth), np.inf, np.sqrt(np.maximum(0, 2 + 2 * kth)))
                    rows, cells = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
                    for name in set(models):
                        mine = np.flatnonzero(models == name)
                        x = unit([raws[i] for i in mine], dim)
                        for begin in range(0, len(mine), 256):
                            part = mine[begin : begin + 256]
                            a, b = border_cells(x[begin : begin + 256], limit[part], [done[i] for i in part], centres[name], count[name], radius[name], reach, few)
                            rows.append(part[a])
                            cells.append(b)
                    yield planned(batch, np.concatenate(rows), np.concatenate(cells))

        kth = F.when(F.size("found") > k, F.element_at("found", k + 1)["away"])
        # Stored with a vector once; it is copied for each bin only on its way there.
        return lambda near: cut(near.select("model", "q", "qraw", kth.alias("kth"), "done").mapInArrow(more, PLAN))

    def merged(near: DataFrame, more: DataFrame) -> DataFrame:
        return near.unionByName(more, allowMissingColumns=True).groupBy("model", "q").agg(F.first("qraw", ignorenulls=True).alias("qraw"), best("found").alias("found"), F.flatten(F.collect_list("done")).alias("done"))

    asking = members.select("model", F.col("key").alias("q"), F.col("raw").alias("qraw"))
    first = members.select("model", "key", "raw", F.lit(None).cast("double").alias("kth"), "cell").mapInArrow(first_cells, PLAN)
    near = cut(merged(asking, scan(first)))
    near = cut(merged(near, scan(more_cells(BEFORE)(near))))
    rest = scan(more_cells(None)(near)).where(F.size("found") > 0)
    found = near.select("model", "q", "found").unionByName(rest.select("model", "q", "found")).groupBy("model", "q").agg(best("found").alias("found"))

    # From copies to ids: neighbours first, then those who ask.
    shared = reps.where("n > 1")
    each = found.select("model", "q", F.inline("found")).join(shared.select("key", "few"), "key", "left").select("model", "q", "away", F.explode(F.coalesce("few", F.array("key"))).alias("id"))
    ranked = each.groupBy("model", "q").agg(F.slice(F.array_sort(F.collect_list(F.struct("away", "id"))), 1, k + 1).alias("found"))
    copies = ids.join(shared.select("model", "copy_of", F.col("key").alias("q")), ["model", "copy_of"]).select("q", "id")
    asked = ranked.join(copies, "q", "left").select("model", F.coalesce("id", "q").alias("id"), "found")
    others = F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, k)
    return asked.select("model", "id", F.posexplode(others).alias("place", "o")).select("model", "id", F.col("o.id").alias("other"), (-F.col("o.away")).alias("similarity"), (F.col("place") + 1).alias("place"))


def neighbour_pairs(df: DataFrame, k: int = 10, **how) -> DataFrame:
    """(vec_id_a, vec_id_b), smaller id first: pairs in which one is among the k nearest of the other; `how` as in nearest_neighbours."""
    n = nearest_neighbours(df, k, **how)
    return n.select(F.least("id", "other").alias("vec_id_a"), F.greatest("id", "other").alias("vec_id_b")).distinct()
