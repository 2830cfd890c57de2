"""Exact largest inner products.

Vectors are ranged by descending length into blocks of bounded size. The block
of the longest gives each query a first bound, its k-th score so far; blocks
too short to reach it are not met at all. Inside a block, coordinates are
rotated so that the first ones carry most of the length: a partial product of
those, and the Cauchy-Schwarz bound on the rest, tell which pairs go on to the
next ones. Where many do, all pairs at hand go on as one product of matrices,
which costs less than picking them. Few pairs are left whose exact integer
product is taken. Vectors go by descending length, the bound rises as
scores are found, and a query stops where no length left can reach it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchwright.sources.staging import stage_table

BLOCK = 2048
STEP = 512
TOGETHER = 128
HEADS = (12, 28)
#: Where more than one of so many pairs goes on, all do.
PICKED = 16
MOST_TASKS = 10_000
LOWEST = np.iinfo(np.int64).min
#: Vectors shorter than this have products within 64 bits, rounding included.
LONGEST = 3.0e9


def quantised(df: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """(id, vec): floor(scale * x) of each component, one row per id.

    Null ids, null vectors and vectors that hold a null or non-finite
    component are left out. Of several vectors under one id the least counts.
    """
    x = "CAST(x AS DOUBLE)"
    bad = f"exists(vec, x -> x IS NULL OR isnan({x}) OR abs({x}) = double('infinity'))"
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vec"))
    return (
        rows.where(f"id IS NOT NULL AND vec IS NOT NULL AND NOT {bad}")
        .selectExpr("id", f"transform(vec, x -> CAST(floor({scale} * {x}) AS BIGINT)) AS vec")
        .groupBy("id")
        .agg(F.min("vec").alias("vec"))
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    lengths = np.diff(np.asarray(column.offsets))
    values = np.asarray(column.flatten())
    if (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = values
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Principal axes, the strongest first; each task sums its own products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = matrix(batch.column("vec"), dims).astype(np.float64)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(dims * dims)), pa.array(total.ravel())], ["cell", "value"]
        )

    cells = vectors.select("vec").mapInArrow(run, "cell long, value double")
    found = cells.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    gram = np.zeros(dims * dims)
    gram[found.cell] = found.value
    value, axes = np.linalg.eigh(gram.reshape(dims, dims))
    return axes[:, np.argsort(-value)]


class Best:
    """The k best (score, id) of each query, and the score that still counts."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor
        self.row = np.zeros(0, np.int64)
        self.score, self.id = self.row, self.row

    def add(self, row: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        if not len(row):
            return
        row = np.concatenate([self.row, row])
        score, id_ = np.concatenate([self.score, score]), np.concatenate([self.id, id_])
        order = np.lexsort((id_, -score, row))
        row, score, id_ = row[order], score[order], id_[order]
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.repeat(first, np.diff(np.r_[first, len(row)]))
        kept = place < self.k
        full = place == self.k - 1
        self.floor[row[full]] = np.maximum(self.floor[row[full]], score[full])
        self.row, self.score, self.id = row[kept], score[kept], id_[kept]


def meet(
    queries: np.ndarray,
    query_ids: np.ndarray,
    floor: np.ndarray,
    vectors: np.ndarray,
    ids: np.ndarray,
    axes: np.ndarray,
    k: int,
) -> Best:
    """The k best of ``vectors`` for each query that score ``floor`` or more."""
    x = vectors @ axes
    length = np.sqrt((x * x).sum(axis=1))
    order = np.argsort(-length, kind="stable")
    x, length, ids, vectors = x[order], length[order], ids[order], vectors[order]
    heads = [*(h for h in HEADS if h < x.shape[1]), x.shape[1]]
    rest_x = [np.sqrt((x[:, h:] ** 2).sum(axis=1)) for h in heads]
    best = Best(len(queries), k, floor.copy())
    for start in range(0, len(queries), TOGETHER):
        part = slice(start, start + TOGETHER)
        own = Best(len(queries[part]), k, best.floor[part])
        _meet_few(own, queries[part], query_ids[part], x, length, rest_x, heads, vectors, ids, axes)
        best.row = np.concatenate([best.row, own.row + start])
        best.score = np.concatenate([best.score, own.score])
        best.id = np.concatenate([best.id, own.id])
    return best


def _meet_few(best, queries, query_ids, x, length, rest_x, heads, vectors, ids, axes) -> None:
    """``meet`` for so few queries that all their pairs in a step fit in memory."""
    q = queries @ axes
    rest_q = [np.sqrt((q[:, h:] ** 2).sum(axis=1)) for h in heads]
    length_q = np.sqrt((q * q).sum(axis=1))
    for a in range(0, len(x), STEP):
        b = min(a + STEP, len(x))
        slack = 1e-9 * length_q * length[a] + 1e-3
        least = best.floor - slack
        alive = np.flatnonzero(length_q * length[a] >= least)
        if not len(alive):
            break
        i = j = None  # the pairs that go on; none picked yet: all
        part, low = 0.0, 0
        for level, high in enumerate(heads):
            rest_i, rest_j = rest_q[level], rest_x[level]
            if i is None:
                part = part + q[alive, low:high] @ x[a:b, low:high].T
                near = part + rest_i[alive, None] * rest_j[a:b] >= least[alive, None]
                if high == heads[-1] or PICKED * np.count_nonzero(near) <= near.size:
                    i, j = np.nonzero(near)
                    part = part[i, j]
                    i, j = alive[i], j + a
            else:
                part = part + np.einsum("pd,pd->p", q[i, low:high], x[j, low:high])
                near = part + rest_i[i] * rest_j[j] >= least[i]
                i, j, part = i[near], j[near], part[near]
            low = high
        other = query_ids[i] != ids[j]
        i, j = i[other], j[other]
        score = np.einsum("pd,pd->p", queries[i], vectors[j])
        enough = score >= best.floor[i]
        best.add(i[enough], score[enough], ids[j[enough]])


def top_products(
    df: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, key, score): the k largest products of each query.

    Queries are the rows whose key is divisible by ``every``, candidates all
    rows but the query's own; ties go to the smaller key. ``quantised`` says
    which rows take part; shorter vectors are filled with zeros; repeated rows
    count once; with few rows all are returned; an empty table gives an empty
    one. Where the longest vector's product with itself leaves 64 bits, scores
    could wrap: an ``OverflowError`` says so. One length per block of
    ``block`` vectors, one block and the axes reach the driver.
    """
    spark = df.sparkSession
    kind = "query_id long, rank int, vec_id long, score long"
    ready = stage_table(
        quantised(df, scale, key, vector).withColumn(
            "length", F.sqrt(F.expr("aggregate(vec, 0D, (s, x) -> s + CAST(x AS DOUBLE) * x)"))
        ),
        "vectors",
    )
    n, dims, longest = ready.agg(F.count("*"), F.max(F.size("vec")), F.max("length")).first()
    if not n:
        return spark.createDataFrame([], kind).withColumnRenamed("vec_id", key)
    if longest >= LONGEST:
        raise OverflowError(f"a vector of length {longest:g}: products may leave 64 bits")
    dims = max(1, dims)
    axes = rotation(ready, dims)
    n_blocks = -(-n // block)
    chunks = max(1, -(-n // (every * block)))
    ranged = ready.repartitionByRange(n_blocks, F.desc("length"), "id")
    blocks = stage_table(ranged.withColumn("block", F.spark_partition_id()), "blocks")
    lengths = blocks.groupBy("block").agg(F.max("length").alias("most")).orderBy("block").toPandas()
    numbers, most = lengths.block.to_numpy(), lengths.most.to_numpy()
    first = blocks.where(F.col("block") == int(numbers[0])).orderBy("id").limit(2 * block)
    first = first.select("id", "vec").toArrow().combine_chunks()
    lead_ids = first["id"].to_numpy()
    lead = matrix(first["vec"].chunk(0), dims)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once per block that it may need, with its first bound."""
        for batch in batches:
            ids = batch.column("id").to_numpy()
            q = matrix(batch.column("vec"), dims)
            floor = meet(q, ids, np.full(len(q), LOWEST), lead, lead_ids, axes, k).floor
            length = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
            reach = length[:, None] * most * (1 + 1e-9) + 1e-3 >= floor[:, None]
            row, at = np.nonzero(reach)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(row)),
                    batch.column("vec").take(pa.array(row)),
                    pa.array(floor[row]),
                    pa.array(numbers[at].astype(np.int32)),
                ],
                ["id", "vec", "floor", "block"],
            )

    def pair(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        left, right = left.combine_chunks(), right.combine_chunks()
        ids = left["id"].to_numpy()
        found = meet(
            matrix(left["vec"].chunk(0), dims),
            ids,
            left["floor"].to_numpy().copy(),
            matrix(right["vec"].chunk(0), dims),
            right["id"].to_numpy(),
            axes,
            k,
        )
        return pa.table(dict(zip(names, (ids[found.row], found.id, found.score))))

    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    asked = ready.where(F.col("id") % every == 0).select("id", "vec")
    asked = asked.mapInArrow(start, "id long, vec array<bigint>, floor long, block int")
    asked = asked.withColumn("chunk", chunk)
    held = blocks.select("id", "vec", "block").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    # a task per pair of groups: they read little and compute much
    tasks = min(n_blocks * chunks, MOST_TASKS)
    asked, held = (side.repartition(tasks, "block", "chunk") for side in (asked, held))
    met = (
        asked.groupBy("block", "chunk")
        .cogroup(held.groupBy("block", "chunk"))
        .applyInArrow(pair, "query_id long, vec_id long, score long")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("vec_id").alias(key), "score")
