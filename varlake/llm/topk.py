"""Exact top-k by inner product with a pivot table.

For pivots p, the triangle inequality bounds the distance of a query q and a
candidate x from below: |q - x| >= max over p of ||q - p| - |x - p||.  As
<q, x> = (|q|^2 + |x|^2 - |q - x|^2) / 2, that bounds their inner product from
above.  The distances of all rows to many pivots are computed once and stored
with the rows; candidates of a block are evaluated in the order of their bounds, and a
query is done with a block when the next bound is below its k-th best score.
Scores of a few rows that every task knows (the pivots) give each query a first
k-th best, so that also the first candidates can be passed over.

Vectors are integers; scores are exact.  Pivots are chosen farthest-first from a
bounded sample (``SAMPLE`` rows with the smallest hashes); they steer how much is
evaluated, never the result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varlake.llm.common import arrow_map, stored
from varlake.llm.vectors import BLOCK, QUERY_BLOCK, best, block_of, matrix, packed, usable

SAMPLE = 2_048
PIVOTS = 32
CHUNK = 256  #: candidates that a query evaluates between two looks at its k-th best


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Row numbers, each the farthest from those before it."""
    chosen = [int(np.argmax((sample**2).sum(axis=1)))]
    away = ((sample - sample[chosen[0]]) ** 2).sum(axis=1)
    while len(chosen) < min(n, len(sample)) and away.max() > 0:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None] - 2 * x @ pivots.T
    return np.sqrt(np.maximum(squares, 0))


def exact_products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of rows with a vector, both integral doubles."""
    if len(q) * max(1.0, np.abs(x).max(initial=0)) * max(1.0, np.abs(q).max(initial=0)) < 2**53:
        return (x @ q).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(row, q, strict=True)) for row in x], object)


def search_block(
    q_ids: np.ndarray, q: np.ndarray, q_table: np.ndarray, ids: np.ndarray, x: np.ndarray, table: np.ndarray, first: np.ndarray, k: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Per query: its id, the ids and scores of its best in the block that can
    be among its k best, and how many candidates were evaluated."""
    q_norm, norm = (q**2).sum(axis=1), (x**2).sum(axis=1)
    apart = np.zeros((len(q), len(x)))
    for p in range(table.shape[1]):
        np.maximum(apart, np.abs(q_table[:, p, None] - table[None, :, p]), out=apart)
    total = q_norm[:, None] + norm[None]
    # the slack is far above the rounding of distances; bounds that are a little too high only cost time
    bound = (total - apart**2) / 2 + 1e-7 * total + 1e-3
    for i, own in enumerate(q_ids.tolist()):
        least = first[i]
        open_ = np.flatnonzero((bound[i] >= least) & (ids != own))
        order = open_[np.argsort(-bound[i, open_])]
        got_ids, got, evaluated = ids[:0], np.zeros(0, np.int64), 0
        for a in range(0, len(order), CHUNK):
            if bound[i, order[a]] < least:
                break
            part = order[a : a + CHUNK]
            evaluated += len(part)
            got_ids, got = np.append(got_ids, ids[part]), np.append(got, exact_products(x[part], q[i]))
            keep = np.lexsort((got_ids, -got))[:k]
            got_ids, got = got_ids[keep], got[keep]
            if len(got) == k:
                least = max(least, got[-1])
        yield own, got_ids, got, evaluated


def exact_topk(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score long): for each row that ``is_query`` (a
    condition on the column ``id``) selects, the k other rows with the largest
    inner product of floor(scale * component), ties to the smaller id; all, if
    there are fewer.

    Vectors are held against vectors of the same length.  Which rows take part:
    see ``usable``.  An empty table gives no rows.  Scores beyond 64 bits end the
    job with an error."""
    rows = usable(df, id_col, vector_col)
    rows = stored(rows.select("id", "row", F.transform("vec", lambda x: F.floor(x * F.lit(scale)).cast("double")).alias("vec"), F.size("vec").alias("dim")))
    # lengths beyond the thousandth are searched without pivots
    n, dims = rows.count(), [r["dim"] for r in rows.select("dim").distinct().limit(1_000).collect()]
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    pivots: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dim in dims:
        own = [r for r in sample if r["dim"] == dim]
        if own:
            vectors = np.array([r["vec"] for r in own]).reshape(len(own), dim)
            chosen = choose_pivots(vectors, PIVOTS)
            pivots[dim] = np.array([own[i]["id"] for i in chosen]), vectors[chosen]

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim = batch.column(2).to_numpy()
            away: list[np.ndarray | None] = [None] * batch.num_rows
            for d in np.unique(dim).tolist():
                own = np.flatnonzero(dim == d)
                x = batch.column(1).take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).reshape(len(own), d)
                for i, row in zip(own.tolist(), pivot_distances(x, pivots[d][1] if d in pivots else np.zeros((0, d))), strict=True):
                    away[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(away, pa.list_(pa.float64()))], ["id", "vec", "dim", "row", "away"])

    rows = stored(arrow_map(rows.select("id", "vec", "dim", "row"), measured, "id long, vec array<double>, dim int, row long, away array<double>"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q_ids, q = matrix(batch.column(0)[i])
                ids, x = matrix(batch.column(1)[i])
                q_table, table = matrix(batch.column(0)[i], "away")[1], matrix(batch.column(1)[i], "away")[1]
                p_ids, p = pivots.get(q.shape[1], (np.zeros(0, np.int64), np.zeros((0, q.shape[1]))))
                first = []
                for own, vector in zip(q_ids, q, strict=True):
                    scores = np.sort(exact_products(p[p_ids != own], vector))
                    first.append(scores[-k] if len(scores) >= k else -np.inf)
                out: list[list] = [[], [], []]
                for own, got_ids, got, _ in search_block(q_ids, q, q_table, ids, x, table, np.array(first), k):
                    out[0] += [own] * len(got)
                    out[1] += got_ids.tolist()
                    out[2] += got.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["query_id", "vec_id", "score"])

    blocks = max(1, -(-n // BLOCK))
    queries = rows.where(is_query)
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    columns = ("id", "vec", "away")
    candidates = packed(rows.withColumn("block", block_of(F.col("row"), blocks)), "dim", "block", columns=columns).withColumnRenamed("rows", "x")
    asked = packed(queries.withColumn("q_block", block_of(F.col("row"), query_blocks)), "dim", "q_block", columns=columns).withColumnRenamed("rows", "q")
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = asked.join(candidates, ["dim", "block"]).select("q", "x")
    return best(arrow_map(pairs, search, "query_id long, vec_id long, score long"), k)
