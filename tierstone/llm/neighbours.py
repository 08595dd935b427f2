"""Approximate nearest neighbours by collision counting over sorted projections.

Each vector is projected on random lines; each line's projections are a sorted array. A
query looks at a window around its own projection on every line and counts on how many
lines a vector lies in the window. Virtual rehashing widens all windows together with the
radius searched, without building anything anew. Vectors that collide often enough are
verified by their true product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierstone.llm.common import stored

NEAREST = 20
#: Lines, and the window's width for radius 1 (the usual choice for a ratio of 2). A
#: vector at the radius then collides on a line with probability 0.83.
LINES, WIDTH = 64, 2.719
#: Of all lines, the share on which a vector has to collide to be verified.
COLLISIONS = 0.7
#: The first radius, as a share of the distance at which products are zero, and by how
#: much virtual rehashing widens it.
START, WIDEN = 0.5, 1.15
#: Rows in a block; places in a block's sorted arrays take two bytes.
DATA_BLOCK, QUERY_BLOCK = 16_384, 1024
SEED = 20
#: Products computed in different orders differ by less than this share of the lengths.
ROUNDING = 1e-12


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Rows (id, v, dim) with an id and a vector that is neither NULL, empty nor zero and
    holds neither NULL nor non-finite components; exact repeats once."""
    v = F.col(embedding).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & v.isNotNull() & (F.size(v) > 0) & ~F.coalesce(bad, F.lit(True)))
    rows = rows.where(F.exists(v, lambda x: x != 0))
    return rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v"), F.size(v).alias("dim")).distinct()


class BlockIndex:
    """Sorted projections of a block of vectors, lifted so that the largest inner product
    is the smallest distance: one more component fills each vector up to the length
    `longest`, and queries have none there."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.longest = ids[order], vectors[order], longest
        squares = np.einsum("ij,ij->i", self.vectors, self.vectors)
        lift = np.sqrt(np.maximum(0.0, longest**2 - squares))
        lines = np.random.default_rng(SEED).standard_normal((LINES, vectors.shape[1] + 1))
        self.lines = lines[:, :-1]
        projected = self.lines @ self.vectors.T + lines[:, -1:] * lift
        order = np.argsort(projected, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=1)
        # A vector's place in each sorted array: it lies in a window if its place does.
        self.place = np.empty(order.shape, np.uint16)
        np.put_along_axis(self.place, order, np.arange(len(ids), dtype=np.uint16)[None, :], axis=1)

    def windows(self, here: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and line, where the window begins in the sorted array and how many
        places it has."""
        begin, size = (np.empty(here.shape, np.uint16) for _ in range(2))
        for line, values in enumerate(self.sorted):
            low = np.searchsorted(values, here[:, line] - reach, "left")
            high = np.searchsorted(values, here[:, line] + reach, "right")
            # A window behind the last place has no place; it may begin anywhere.
            begin[:, line], size[:, line] = np.minimum(low, len(values) - 1), high - low
        return begin, size

    def collisions(self, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """On how many lines each vector lies in a query's windows."""
        # Places before the window wrap around to large numbers.
        inside = self.place - begin[:, None] < size[:, None]
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def _ranked(self, rows: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products of the k best of these rows, ties to the smaller id. Products are
        added component by component, so equal vectors have equal products whatever
        they are computed with."""
        score = np.zeros(len(rows))
        for component, x in zip(self.vectors[rows].T, query.tolist(), strict=True):
            score += component * x
        order = np.lexsort((self.ids[rows], -score))[:k]
        return self.ids[rows[order]], score[order]

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
        """For each query the ids and products of the k nearest found, own id left out."""
        here = queries @ self.lines.T
        length = np.einsum("ij,ij->i", queries, queries) + self.longest**2
        radius = START * np.sqrt(length)
        need = int(np.ceil(COLLISIONS * LINES))
        asked = [self.ids == i for i in query_ids]
        found: list[tuple] = [None] * len(queries)
        best = [(np.empty(0, np.int64), np.empty(0))] * len(queries)
        open_ = np.arange(len(queries))
        while len(open_):
            begin, size = self.windows(here[open_], WIDTH * radius[open_] / 2)
            still = []
            for at, q in enumerate(open_.tolist()):
                count = self.collisions(begin[at], size[at])
                new = np.nonzero((count >= need) & ~asked[q])[0]
                asked[q][new] = True
                rows = np.concatenate((best[q][0], new))
                score = np.concatenate((best[q][1], self.vectors[new] @ queries[q]))
                order = np.argsort(-score, kind="stable")
                if len(order) > k:  # and all that rounding may have put behind the k-th
                    order = order[score[order] >= score[order[k - 1]] - ROUNDING * length[q]]
                best[q] = rows[order], score[order]
                near = length[q] - 2 * best[q][1] <= radius[q] ** 2
                if np.count_nonzero(near) >= k or asked[q].all():
                    found[q] = self._ranked(best[q][0], queries[q], k)
                else:
                    still.append(q)
            open_ = np.array(still, np.int64)
            radius[open_] *= WIDEN
        return found


def nearest(
    vectors: DataFrame, is_query: Column, k: int = NEAREST, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest by inner product in double
    precision, ties to the smaller id. `is_query` is a condition on the column `id`.

    Vectors and queries are dealt into blocks of bounded size by a hash of their content,
    and every query block meets every block of vectors in one task of its own: a stated
    query set against all rows. Each block keeps its k best per query, so what is
    shuffled after that is k rows per query and block. Vectors of different dimension do
    not meet. Rows that share an id count with their best product, and never for a query
    of their own id. No usable vector, or no query, gives no row.
    """
    rows = stored(usable(vectors, vec_id, embedding), "vectors")
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    facts = rows.groupBy("dim").agg(
        F.count("*").alias("n"),
        F.count_if(is_query).alias("queries"),
        F.sqrt(F.max(square)).alias("longest"),
    )
    facts = facts.select(
        "dim", "longest",
        F.ceil(F.col("n") / DATA_BLOCK).cast("int").alias("data_blocks"),
        F.ceil(F.greatest(F.col("queries"), F.lit(1)) / QUERY_BLOCK).cast("int").alias("query_blocks"),
    )
    dealt = rows.join(F.broadcast(facts), "dim")  # one row per dimension
    spread = F.xxhash64("id", "v")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    own = lambda blocks: F.pmod(spread, F.col(blocks)).cast("int")
    held = ["dim", "longest", "id", "v"]
    data = dealt.select(*held, F.lit(False).alias("asks"), own("data_blocks").alias("d"), every("query_blocks").alias("q"))
    asks = dealt.where(is_query).select(
        *held, F.lit(True).alias("asks"), every("data_blocks").alias("d"), own("query_blocks").alias("q")
    )

    def meet(cell: pd.DataFrame) -> pd.DataFrame:
        asking = cell["asks"].to_numpy(bool)
        found = []
        if asking.any() and not asking.all():
            ids, v = cell["id"].to_numpy(np.int64), np.stack(cell["v"].to_numpy()).astype(float)
            index = BlockIndex(ids[~asking], v[~asking], float(cell["longest"].iat[0]))
            answers = index.nearest(ids[asking], v[asking], k)
            for query_id, (near, product) in zip(ids[asking].tolist(), answers, strict=True):
                found.append(pd.DataFrame({"query_id": query_id, "vec_id": near, "score": product}))
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        return pd.concat(found) if found else empty

    best = data.unionByName(asks).groupBy("dim", "d", "q").applyInPandas(meet, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
