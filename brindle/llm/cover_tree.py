"""Exact top-k search by inner product with two cover trees, one over queries and one over data."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import local_path, new_path, small, written
from .hash_arrays import save

#: Vectors of a block, queries of a group, points of a leaf; centres that vectors are divided among at most.
BLOCK, GROUP, LEAF, CENTRES = 4096, 512, 32, 4096
#: Blocks whose centres one file holds.
CHUNK = 8192
#: A level's covering radius is so much of the one above.
SHRINK = 0.7


@dataclass
class CoverTree:
    """Nodes over consecutive points of ``order``: a centre, the radius that covers all of a node's points, children.

    Each node's children are centred on a net of its points: every point lies within the level's radius of its child's
    centre, and centres lie further apart than that; the first child keeps the node's own centre.
    """

    order: np.ndarray
    centre: np.ndarray  # point number
    radius: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    children: list[list[int]]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF) -> CoverTree:
        order = np.arange(len(points))
        centre, radius, begin, end, children = [0], [0.0], [0], [len(points)], [[]]
        reach = [np.linalg.norm(points - points[0], axis=1)]
        open_ = [0]
        while open_:
            node = open_.pop()
            a, b, far = begin[node], end[node], reach[node]
            reach[node] = None
            radius[node] = float(far.max(initial=0.0))
            if b - a <= leaf or radius[node] == 0:
                continue
            own = order[a:b]
            limit = radius[node] * SHRINK
            owner, distance = np.full(b - a, -1), np.full(b - a, np.inf)
            first = int(np.flatnonzero(own == centre[node])[0])
            nets = []
            left = np.arange(b - a)
            pick = first
            while len(left):
                d = far[left] if pick == first else np.linalg.norm(points[own[left]] - points[own[pick]], axis=1)
                close = d <= limit
                owner[left[close]], distance[left[close]] = len(nets), d[close]
                nets.append(own[pick])
                left = left[~close]
                pick = int(left[0]) if len(left) else -1
            by = np.argsort(owner, kind="stable")
            order[a:b] = own[by]
            at = a + np.r_[0, np.cumsum(np.bincount(owner, minlength=len(nets)))]
            distance = distance[by]
            # centres that cover few points are held together as one leaf under the node's centre
            few: list[int] = []
            for k, net in enumerate(nets):
                if at[k + 1] - at[k] >= leaf // 2:
                    children[node].append(len(centre))
                    open_.append(len(centre))
                    for values, x in ((centre, net), (radius, 0.0), (begin, at[k]), (end, at[k + 1]), (children, []), (reach, distance[at[k] - a : at[k + 1] - a])):
                        values.append(x)
                else:
                    few.append(k)
            for net, lo, hi in cls._runs(few, at, leaf, nets):
                d = np.linalg.norm(points[order[lo:hi]] - points[net], axis=1)
                children[node].append(len(centre))
                for values, x in ((centre, net), (radius, float(d.max())), (begin, lo), (end, hi), (children, []), (reach, None)):
                    values.append(x)
        return cls(order, np.array(centre), np.array(radius), np.array(begin), np.array(end), children)

    @staticmethod
    def _runs(few: list[int], at: np.ndarray, leaf: int, nets: list[int]) -> list[tuple[int, int, int]]:
        """Neighbouring small children as leaves of at most about ``leaf`` points."""
        out: list[tuple[int, int, int]] = []
        last = None
        for k in few:
            if out and last == k - 1 and at[k + 1] - out[-1][1] <= leaf:
                out[-1] = (out[-1][0], out[-1][1], at[k + 1])
            else:
                out.append((nets[k], at[k], at[k + 1]))
            last = k
        return out


class Best:
    """Each query's k best so far: score descending, then id ascending."""

    def __init__(self, n: int, k: int, exponent: int | None = None):
        self.exponent = exponent
        self.k, self.scores, self.ids = k, [np.zeros(0) for _ in range(n)], [np.zeros(0, dtype=np.int64) for _ in range(n)]
        self.worst = np.full(n, -np.inf)
        self.least: dict[int, list[float]] = {}

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores[query], scores]), np.concatenate([self.ids[query], ids])
        top = np.lexsort((ids, -scores))[: self.k]
        self.scores[query], self.ids[query] = scores[top], ids[top]
        if len(top) == self.k:
            self.worst[query] = scores[top[-1]]

    def add_whole(self, query: int, scores: list[int], least: np.ndarray, ids: np.ndarray) -> None:
        """Scores as whole numbers of any size; ``least`` is what each is at least, in the scale of the vectors."""
        every = [*zip(self.scores[query], self.ids[query].tolist(), self.least[query], strict=True)] if query in self.least else []
        every = sorted([*every, *zip(scores, ids.tolist(), least.tolist(), strict=True)], key=lambda x: (-x[0], x[1]))[: self.k]
        self.scores[query], self.ids[query], self.least[query] = [x[0] for x in every], np.array([x[1] for x in every], dtype=np.int64), [x[2] for x in every]
        if len(every) == self.k:
            self.worst[query] = min(self.least[query])


def slack(bound: np.ndarray, product: np.ndarray, exponent: int | None) -> np.ndarray:
    """More than doubles can be wrong by in ``bound``, a sum of products; ``product`` is of the norms it is made from."""
    return 1e-9 * np.abs(bound) + 1e-6 if exponent is None else 1e-9 * product + 1e-150


def whole_numbers(vectors: np.ndarray, exponent: int) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(np.ldexp(vectors, exponent))


def search(queries: np.ndarray, query_rows: np.ndarray, q: CoverTree, points: np.ndarray, ids: np.ndarray, rows: np.ndarray, r: CoverTree, best: Best) -> None:
    """Both trees from their roots; a pair of nodes is dropped if even its bound is below the query group's worst kth
    score: <a, b> <= <c, d> + s |d| + t |c| + s t for centres c, d and radii s, t. Points are in tree order. With an exponent,
    vectors are divided by that power of two, doubles only bound the scores and whole numbers decide."""
    norms_q, norms_r = np.linalg.norm(queries, axis=1), np.linalg.norm(points, axis=1)
    at_q, at_r = np.argsort(q.order), np.argsort(r.order)
    cq, cr = at_q[q.centre], at_r[r.centre]

    def bounds(a: list[int], b: list[int]) -> np.ndarray:
        x, y = cq[a], cr[b]
        s, t = q.radius[a][:, None], r.radius[b][None, :]
        bound = queries[x] @ points[y].T + s * norms_r[y][None, :] + t * norms_q[x][:, None] + s * t
        return bound + slack(bound, (norms_q[x][:, None] + s) * (norms_r[y][None, :] + t), best.exponent)

    stack = [(0, 0, float(bounds([0], [0])[0, 0]))]
    while stack:
        a, b, bound = stack.pop()
        lo, hi = q.begin[a], q.end[a]
        if bound < best.worst[lo:hi].min():
            continue
        left, right = q.children[a], r.children[b]
        if not left and not right:
            scores = queries[lo:hi] @ points[r.begin[b] : r.end[b]].T
            scores[query_rows[lo:hi, None] == rows[None, r.begin[b] : r.end[b]]] = -np.inf
            if best.exponent is not None:
                wrong = slack(scores, norms_q[lo:hi, None] * norms_r[None, r.begin[b] : r.end[b]], best.exponent)
                for k, (own, off) in enumerate(zip(scores, wrong, strict=True)):
                    good = np.flatnonzero(np.isfinite(own) & (own + off >= best.worst[lo + k]))
                    if len(good):
                        exact = whole_numbers(points[r.begin[b] + good], best.exponent) @ whole_numbers(queries[lo + k], best.exponent)
                        best.add_whole(lo + k, [int(x) for x in exact], own[good] - off[good], ids[r.begin[b] + good])
                continue
            for k in np.flatnonzero(scores.max(axis=1) >= best.worst[lo:hi]):
                good = np.flatnonzero((scores[k] >= best.worst[lo + k]) & np.isfinite(scores[k]))
                best.add(lo + k, scores[k, good], ids[r.begin[b] + good])
            continue
        pairs_a, pairs_b = left or [a], right or [b]
        found = bounds(pairs_a, pairs_b)
        for i, j in zip(*np.unravel_index(np.argsort(found, axis=None), found.shape), strict=True):  # the best bound is visited first
            stack.append((pairs_a[i], pairs_b[j], float(found[i, j])))


def exponent_of(largest: float, size: int) -> int | None:
    """None where doubles hold all scores exactly, else a power of two above all components."""
    return None if int(largest) ** 2 * max(size, 1) < 2**53 else math.frexp(largest)[1]


def top_k(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id, rank, id_col, score``: for each query row its ``k`` highest integer inner products, ties to smaller ids.

    Components become floor(scale * x) in double. Candidates are all rows but the query's own; vectors of another length
    are not candidates. Rows whose id or vector is null, or whose vector holds a null or non-finite component, take no
    part; rows that repeat an id are rows of their own. All scores are exact: beyond 2^53 doubles only bound them and whole
    numbers decide. An error is raised if a score of the result is no long, or a finite component no double times ``scale``.

    A bounded sample (``CENTRES`` rows of the smallest hashes) divides all vectors by their nearest centre; each part of at
    most about ``BLOCK`` vectors gets a cover tree in the shared folder, which workers map. Queries are grouped likewise,
    each group with a tree of its own that meets the blocks in the order of their bounds, until no block can still hold a
    better score. No vector is shuffled for the search, and the driver holds the sample and counts by centre only.
    """
    spark = df.sparkSession
    vector = F.col(vector_col)
    whole = df.where(F.col(id_col).isNotNull() & vector.isNotNull()).select(F.col(id_col).cast("long").alias("_id"), vector.alias("_x"), F.coalesce(is_query, F.lit(False)).alias("_q"))
    # floor makes a long, of NaN 0 and of what is too large the largest; such doubles have no fraction anyway
    whole = whole.where(~F.exists("_x", lambda x: F.coalesce(F.isnan(x) | (F.abs(x.cast("double")) == float("inf")), F.lit(True))))
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    whole = whole.select("_id", F.transform("_x", lambda x: F.when(F.abs(scaled(x)) >= 2.0**53, scaled(x)).otherwise(F.floor(scaled(x)).cast("double"))).alias("_v"), "_q")
    whole = written(whole.withColumn("_row", F.monotonically_increasing_id()).withColumn("_d", F.size("_v")), "vectors")
    size = whole.agg(F.count(F.lit(1)).alias("n"), F.max(F.expr("aggregate(_v, 0D, (a, x) -> greatest(a, abs(x)))")).alias("m"), F.max("_d").alias("d")).first()
    schema = f"query_id long, rank int, `{id_col}` long, score long"
    if not size["n"]:
        return spark.createDataFrame([], schema)
    if math.isinf(size["m"]):
        raise ValueError("a component is no double once scaled")
    exponent = exponent_of(size["m"], size["d"])
    if exponent is not None:
        half = exponent // 2  # in two steps, as the power itself may be no double
        whole = whole.withColumn("_v", F.transform("_v", lambda x: x * F.lit(2.0**-half) * F.lit(2.0 ** (half - exponent))))
    sample = whole.orderBy(F.xxhash64("_row")).limit(int(min(CENTRES, max(1, size["n"] // BLOCK)))).select("_v").toPandas()["_v"]
    centres = spark.sparkContext.broadcast([np.array(v) for v in sample])

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        out = np.full(len(vectors), -1)
        sizes = vectors.map(len).to_numpy()
        for d in np.unique(sizes):
            own = [i for i, c in enumerate(centres.value) if len(c) == d]
            if own:
                x, c = np.stack(vectors[sizes == d].to_list()).reshape(-1, d), np.stack([centres.value[i] for i in own])
                out[sizes == d] = np.array(own)[(-2 * x @ c.T + (c * c).sum(axis=1)).argmin(axis=1)]
        return pd.Series(out)

    placed = written(whole.withColumn("_c", nearest("_v")), "vectors-placed")
    counts = small(placed.groupBy("_d", "_c").agg(F.count(F.lit(1)).alias("_n"), F.count_if("_q").alias("_m")))
    placed = placed.join(counts, ["_d", "_c"])
    folder = local_path(new_path(spark, "cover-trees"))
    os.makedirs(folder)

    def build(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        d, c, part = map(int, key)
        points = np.stack(batch["_v"].to_list()).reshape(len(batch), d)
        tree = CoverTree.build(points)
        name = f"{d}-{c}-{part}"
        save(folder, f"points-{name}", points[tree.order])
        save(folder, f"ids-{name}", batch["_id"].to_numpy()[tree.order])
        save(folder, f"rows-{name}", batch["_row"].to_numpy()[tree.order])
        flat = np.array([x for own in tree.children for x in own], dtype=np.int64)
        save(folder, f"tree-{name}", np.concatenate([[len(tree.centre)], tree.centre, tree.begin, tree.end, list(map(len, tree.children)), flat]).astype(np.int64))
        save(folder, f"order-{name}", tree.order)
        save(folder, f"radius-{name}", tree.radius)
        return pd.DataFrame({"d": [d], "name": [name], "centre": [points[tree.centre[0]].tolist()], "radius": [float(tree.radius[0])]})

    parts = placed.withColumn("_p", F.pmod(F.xxhash64("_row"), F.ceil(F.col("_n") / BLOCK)).cast("int"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # said, so that few bytes are no reason for few tasks
    blocks = written(parts.repartition(tasks, "_d", "_c", "_p").groupBy("_d", "_c", "_p").applyInPandas(build, "d int, name string, centre array<double>, radius double"), "blocks")

    def store(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        d, chunk = map(int, key)
        batch = batch.sort_values("name")
        save(folder, f"centres-{d}-{chunk}", np.stack(batch["centre"].to_list()).reshape(len(batch), d))
        save(folder, f"radii-{d}-{chunk}", batch["radius"].to_numpy())
        save(folder, f"names-{d}-{chunk}", batch["name"].to_numpy().astype("S"))
        return pd.DataFrame({"d": [d], "chunk": [chunk]})

    chunks = F.lit(-(-blocks.count() // CHUNK))
    listed = blocks.withColumn("chunk", F.pmod(F.xxhash64("name"), chunks).cast("int")).groupBy("d", "chunk").applyInPandas(store, "d int, chunk int").collect()  # a row for CHUNK * BLOCK vectors
    chunks_of: dict[int, list[int]] = {}
    for r in sorted(map(tuple, listed)):
        chunks_of.setdefault(r[0], []).append(r[1])

    def answer(key: tuple, batch: pd.DataFrame) -> pd.DataFrame:
        d = int(key[0])
        load = lambda name: np.load(f"{folder}/{name}.npy", mmap_mode="r")
        queries = np.stack(batch["_v"].to_list()).reshape(len(batch), d)
        tree = CoverTree.build(queries)
        queries, own_rows, own_ids = queries[tree.order], batch["_row"].to_numpy()[tree.order], batch["_id"].to_numpy()[tree.order]
        best = Best(len(queries), k, exponent)
        root = queries[np.argsort(tree.order)[tree.centre[0]]]
        bounds, names = [], []
        for chunk in chunks_of[d]:
            centre, radius = load(f"centres-{d}-{chunk}"), load(f"radii-{d}-{chunk}")
            bound = centre @ root + tree.radius[0] * np.linalg.norm(centre, axis=1) + radius * np.linalg.norm(root) + radius * tree.radius[0]
            bounds.append(bound + slack(bound, (np.linalg.norm(centre, axis=1) + radius) * (np.linalg.norm(root) + tree.radius[0]), exponent))
            names.append(load(f"names-{d}-{chunk}"))
        bound, names = np.concatenate(bounds), np.concatenate(names)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] < best.worst.min():
                break
            name = names[b].decode()
            packed = np.array(load(f"tree-{name}"))
            n = int(packed[0])
            first, begin, end, many = (packed[1 + i * n : 1 + (i + 1) * n] for i in range(4))
            ends = np.cumsum(many)
            flat = packed[1 + 4 * n :].tolist()
            children = [flat[e - m : e] for e, m in zip(ends.tolist(), many.tolist(), strict=True)]
            other = CoverTree(np.array(load(f"order-{name}")), first, np.array(load(f"radius-{name}")), begin, end, children)
            search(queries, own_rows, tree, np.array(load(f"points-{name}")), np.array(load(f"ids-{name}")), np.array(load(f"rows-{name}")), other, best)
        sizes = [len(x) for x in best.ids]
        return pd.DataFrame({"query_id": np.repeat(own_ids, sizes), "rank": np.concatenate([np.arange(1, s + 1) for s in sizes]).astype(np.int32), id_col: np.concatenate(best.ids), "score": np.concatenate(best.scores).astype(np.int64) if exponent is None else np.array([x for own in best.scores for x in own], dtype=np.int64)})

    asked = placed.where("_q").withColumn("_p", F.pmod(F.xxhash64("_row"), F.ceil(F.col("_m") / GROUP)).cast("int"))
    return asked.repartition(tasks, "_d", "_c", "_p").groupBy("_d", "_c", "_p").applyInPandas(answer, schema)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s QUALIFY rank <= 5
"""
