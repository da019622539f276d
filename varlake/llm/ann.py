"""Approximate nearest neighbours by learned partitions.

1. *Fit*, on a bounded sample (``SAMPLE`` rows with the smallest hashes, at the
   driver): the graph that joins each row to its nearest ones is cut into
   ``PARTS`` balanced parts, so that as few neighbours as can be are parted; then
   a small classifier (one hidden layer) learns from a vector which parts its
   neighbours are in.
2. *Index*, all rows: each goes to its most probable part.
3. *Search*: a query goes to its most probable parts, as many as reach the wanted
   recall on sample rows that the fit did not see, and to more where these hold
   too few rows; everything in them is scored exactly.

A part that holds a third of all rows, say of one vector, is split into blocks
by the hash of the row's number.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, stored
from varlake.llm.vectors import BLOCK, QUERY_BLOCK, best, block_of, matrix, packed, usable

SAMPLE = 6_000
HELD_OUT = 500  #: rows of the sample that choose how many parts are searched
PARTS = 16
NEIGHBOURS = 10
HIDDEN = 64
RECALL = 0.97  #: wanted on the held-out rows
SLACK = 1.05  #: a part's size, in means, at most


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(rows, k): the rows with the largest inner product with each row."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 256):  # a stripe of the score matrix at a time
        scores = -(x[a : a + 256] @ x.T)
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = np.inf
        out[a : a + 256] = np.argpartition(scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20, seed: int = 7) -> np.ndarray:
    """A part for each row: at first by repeated halving along the direction of
    the largest spread, then rows move to the part that most of their neighbours
    are in, as far as that has room."""
    part = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        own = groups.pop()
        if len(own) < 2:
            groups.append(own)
            break
        centred = x[own] - x[own].mean(axis=0)
        along = centred @ np.linalg.svd(centred, full_matrices=False)[2][0]
        order = own[np.argsort(along, kind="stable")]
        groups += [order[: len(own) // 2], order[len(own) // 2 :]]
    for i, own in enumerate(groups):
        part[own] = i
    room = int(np.ceil(SLACK * len(x) / parts))
    size = np.bincount(part, minlength=parts)
    src = np.repeat(np.arange(len(x)), graph.shape[1])
    both = np.concatenate([np.stack([src, graph.ravel()]), np.stack([graph.ravel(), src])], axis=1)
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        votes = np.bincount(both[0] * parts + part[both[1]], minlength=len(x) * parts).reshape(len(x), parts)
        want = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), want] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.flatnonzero((gain > 0) & (random.random(len(x)) < 0.7)):
            if size[want[i]] < room:
                size[part[i]] -= 1
                size[want[i]] += 1
                part[i] = want[i]
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A classifier with one hidden layer: vector to probabilities of parts."""

    def __init__(self, dim: int, parts: int, hidden: int = HIDDEN, seed: int = 11):
        random = np.random.default_rng(seed)
        self.weights = [random.normal(0, dim**-0.5, (dim, hidden)), np.zeros(hidden), random.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]
        self.scale = 1.0

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w1, b1, w2, b2 = self.weights
        h = np.maximum(x * self.scale @ w1 + b1, 0)
        z = h @ w2 + b2
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return h, e / e.sum(axis=1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = 60, batch: int = 256, rate: float = 0.003, seed: int = 13) -> Router:
        """Adam on the cross entropy with ``target`` (rows of probabilities)."""
        self.scale = 1 / max(1e-12, float(np.sqrt((x**2).mean())))
        random = np.random.default_rng(seed)
        m, v = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(epochs):
            order = random.permutation(len(x))
            for a in range(0, len(x), batch):
                own = order[a : a + batch]
                h, p = self._forward(x[own])
                d = (p - target[own]) / len(own)
                back = (d @ self.weights[2].T) * (h > 0)
                step += 1
                for i, g in enumerate([(x[own] * self.scale).T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0)]):
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.weights[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
        return self


def fit(sample: np.ndarray, parts: int, k: int, recall: float) -> tuple[Router, int]:
    """The router, and how many parts a query has to be sent to."""
    held = sample[: min(HELD_OUT, len(sample) // 5)]
    x = sample[len(held) :]
    if len(x) <= parts or not x.shape[1]:
        return Router(x.shape[1] or 1, 1), 1
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1] + 1), np.concatenate([part[graph], part[:, None]], axis=1).ravel()), 1 / (graph.shape[1] + 1))
    router = Router(x.shape[1], parts).fit(x, target)
    if not len(held):
        return router, parts
    home = router.probabilities(x).argmax(axis=1)
    rank = np.argsort(np.argsort(-router.probabilities(held), axis=1, kind="stable"), axis=1)
    near = np.argsort(-(held @ x.T), axis=1, kind="stable")[:, :k]
    needed = np.sort(np.take_along_axis(rank, home[near], axis=1).ravel())
    return router, int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def score_block(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query: the ids and inner products of its k best in the block.  The
    final sums go over the components in one order, so that equal vectors have
    equal scores."""
    rough = q @ x.T
    rough[q_ids[:, None] == ids[None]] = -np.inf
    for i, own in enumerate(q_ids.tolist()):
        row = rough[i]
        if len(row) > k:
            least = np.partition(row, len(row) - k)[len(row) - k]
            slack = 1e-9 * (1 + np.sqrt((q[i] ** 2).sum()) * np.abs(x).max())
            near = np.flatnonzero(row >= least - slack)
        else:
            near = np.arange(len(row))
        near = near[np.isfinite(row[near])]
        score = (x[near] * q[i]).sum(axis=1)
        keep = np.lexsort((ids[near], -score))[:k]
        yield own, ids[near][keep], score[keep]


def nearest(
    df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, sample_rows: int = SAMPLE, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score double, searched long): for each row that
    ``is_query`` (a condition on the column ``id``) selects, the k other rows
    found with the largest inner products, ties to the smaller id; all, if there
    are fewer.  ``searched`` is the number of rows in the parts that the query was
    sent to.

    Which rows take part: see ``usable``; zero vectors don't.  Vectors are held
    against vectors of the same length.  An empty table gives no rows."""
    rows = usable(df, id_col, vector_col).where(F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))
    rows = stored(rows)
    # lengths beyond the thousandth have one part each
    dims = [r["dim"] for r in rows.select("dim").distinct().limit(1_000).collect()]
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(sample_rows).collect()
    models: dict[int, tuple[Router, int]] = {}
    for dim in dims:
        models[dim] = fit(np.array([r["vec"] for r in sample if r["dim"] == dim]).reshape(-1, dim), parts, k, recall)

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = np.zeros(batch.num_rows, np.int32)
            asks: list[list[int]] = [[]] * batch.num_rows
            enough = np.zeros(batch.num_rows, np.int32)
            dim, asked = batch.column(1).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            for d in np.unique(dim).tolist():
                own = np.flatnonzero(dim == d)
                x = batch.column(0).take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
                router, probes = models.get(d) or (Router(d, 1), 1)
                order = np.argsort(-router.probabilities(x), axis=1, kind="stable")
                home[own] = order[:, 0]
                enough[own] = probes
                for i in np.flatnonzero(asked[own]).tolist():
                    asks[own[i]] = order[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home), pa.array(asks, pa.list_(pa.int32())), pa.array(enough)], ["vec", "dim", "id", "row", "asked", "part", "parts", "probes"]
            )

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q = matrix(batch.column(0)[i])
                ids, x = matrix(batch.column(1)[i])
                found = list(score_block(q_ids, q, ids, x, k))
                sizes = [len(s) for _, _, s in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, sizes)), pa.array(np.concatenate([f[1] for f in found])), pa.array(np.concatenate([f[2] for f in found]))], ["query_id", "vec_id", "score"]
                )

    asked = F.coalesce(is_query, F.lit(False)).alias("asked")
    schema = "vec array<double>, dim int, id long, row long, asked boolean, part int, parts array<int>, probes int"
    routed = stored(arrow_map(rows.select("vec", "dim", "id", "row", asked), route, schema))
    sizes = routed.groupBy("dim", "part").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    candidates = routed.select("id", "row", "vec", "dim", "part").join(sizes, ["dim", "part"]).withColumn("block", block_of(F.col("row"), F.col("blocks")))
    candidates = packed(candidates, "dim", "part", "block").withColumnRenamed("rows", "x")
    asking = routed.where("asked")
    n_queries = asking.count()
    # the parts of a query: the probes, and more until they hold k rows besides those of its own id
    copies = asking.groupBy("id", "dim").agg(F.count("*").alias("copies"))
    sent = asking.select("id", "row", "dim", "probes", F.posexplode("parts").alias("place", "part")).join(sizes, ["dim", "part"]).join(copies, ["id", "dim"])
    before = F.sum("n").over(Window.partitionBy("row").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    sent = sent.withColumn("before", F.coalesce(before, F.lit(0))).where((F.col("place") < F.col("probes")) | (F.col("before") < F.col("copies") + k))
    sent = stored(sent.select("id", "row", "dim", "part", "blocks", "n"))
    queries = sent.drop("id", "dim", "n").join(asking.select("row", "id", "vec", "dim"), "row")
    queries = packed(queries.withColumn("q_block", block_of(F.col("row"), max(1, -(-n_queries // QUERY_BLOCK)))), "dim", "part", "blocks", "q_block").withColumnRenamed("rows", "q")
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = queries.join(candidates, ["dim", "part", "block"]).select("q", "x")
    found = best(arrow_map(pairs, search, "query_id long, vec_id long, score double"), k)
    return found.join(sent.groupBy(F.col("id").alias("query_id")).agg(F.sum("n").alias("searched")), "query_id")
