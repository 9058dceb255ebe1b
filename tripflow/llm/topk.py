"""Exact top-k inner products by aggregation without random access.

Every dimension is a list of vectors sorted by their component. A query reads its lists in step from
the end that raises its score: from the top where its own component is positive, from the bottom
where it is negative. After each round of reading, a vector's lower bound adds what was read of it
and the least that the rest of each list holds; its upper bound adds the last value read from each
list instead. Reading stops once the k-th lower bound is beyond the upper bound of every outsider;
the scores of those that may still qualify are then resolved exactly. Where products of large
components leave the whole numbers that a double holds, the bounds are widened by what rounding may
have changed, and the scores are resolved in 64-bit or, beyond those, in Python's integers.

Work goes in blocks: vectors are dealt into blocks of about BLOCK, each with its sorted lists, query
vectors into blocks of about QUERIES, and every pair of blocks is a task's unit, so a unit's size is
fixed. A round is a few matrix products over the part of the lists between two depths. Each unit
keeps at least the k best of its block, a window over the kept rows of a query gives the result.

Defined results: vectors that are null, empty, or hold a null or a non-finite component take no
part; vectors of other lengths than the query's are no candidates; of ties the smaller vec_id is
first; rows that repeat a vec_id are candidates one by one, but never of their own id; a null vec_id
takes no part; no rows give no rows; other columns are ignored. Finite components of any size take
part; a score among the k best of a block of vectors that no long can hold stops the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripflow.session import stage

K = 5
EVERY = 50
SCALE = 256
BLOCK = 4096
QUERIES = 512
#: Shares of the lists that are read by the end of each round.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1.0)
#: Sums of products whose absolute values stay below EXACT are exact in doubles with room for the bounds' few terms.
EXACT = 2.0**50
LONG = 2.0**62


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, parts array<double>): floor(SCALE * component), a whole number, of the vectors that take part."""

    def whole(x: Column) -> Column:
        scaled = SCALE * x.cast("double")
        # A double of 2**53 or more is a whole number already; SCALE is a power of two, so only infinity can go wrong.
        beyond = F.raise_error(F.lit(f"a component times {SCALE} is no finite number")).cast("double")
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).when(F.abs(scaled) < float("inf"), scaled).otherwise(beyond)

    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & sound)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("parts"))


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """(width, part, ids, matrix): the rows in written blocks of ``size`` and less, one width each."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def full(width: int) -> pa.RecordBatch:
            ids, parts = held.pop(width)
            matrix = np.array(parts, np.float64)
            return pa.RecordBatch.from_pydict(
                {"width": pa.array([width], pa.int32()), "ids": [np.array(ids, np.int64).tobytes()], "matrix": [matrix.tobytes()]}
            )

        for batch in batches:
            for vec, parts in zip(batch.column("vec_id").to_pylist(), batch.column("parts").to_pylist()):
                ids, rows_held = held.setdefault(len(parts), ([], []))
                ids.append(vec)
                rows_held.append(parts)
                if len(ids) == size:
                    yield full(len(parts))
        for width in list(held):
            yield full(width)

    count = max(1, -(-rows.count() // size))
    packed = rows.repartition(count).mapInArrow(pack, "width int, ids binary, matrix binary")
    packed = stage(packed.withColumn("block", F.monotonically_increasing_id()), name)
    place = packed.select("block").withColumn("part", F.row_number().over(W.partitionBy(F.lit(0)).orderBy("block")) - 1)
    return packed.join(F.broadcast(place), "block")  # one number for each block of `size` vectors


class Lists:
    """The sorted lists of one block of vectors, read in layers of ranks."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix.astype(np.float64)  # whole numbers
        self.largest = np.abs(self.matrix).max(0)
        n = len(matrix)
        order = np.argsort(-self.matrix, axis=0, kind="stable")
        self.from_top = np.empty_like(order)
        np.put_along_axis(self.from_top, order, np.arange(n)[:, None].repeat(matrix.shape[1], 1), 0)
        self.sorted = np.take_along_axis(self.matrix, order, 0)

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """The inner products of ``rows`` with the query, as whole numbers of a type that holds them."""
        with np.errstate(over="ignore"):
            reach = np.abs(query) @ self.largest  # no sum of products is larger
        if reach < EXACT:
            return (self.matrix[rows] @ query).astype(np.int64)
        if reach < LONG and max(np.abs(query).max(), self.largest.max()) < LONG:
            return self.matrix[rows].astype(np.int64) @ query.astype(np.int64)
        wanted = [int(x) for x in query]
        return np.array([sum(int(a) * b for a, b in zip(row, wanted)) for row in self.matrix[rows]] + [None], object)[:-1]

    def slack(self, queries: np.ndarray) -> np.ndarray:
        """What rounding may have changed of each query's bounds: nothing where all sums are exact."""
        with np.errstate(over="ignore"):
            reach = np.abs(queries) @ self.largest
            return np.where(reach < EXACT, 0.0, reach * 16 * (queries.shape[1] + 8) * 2.0**-53)

    def best(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each query the rows that may be among its k best; all rows with the k-th score are kept."""
        matrix, n = self.matrix, len(self.matrix)
        out: list[np.ndarray] = [np.arange(n)] * len(queries)
        if n <= k:
            return out
        slack = self.slack(queries)
        kept = np.flatnonzero(slack < 2.0**1000)  # beyond that, bounds may be infinite: every row may qualify
        if len(kept) < len(queries):
            for at, rows in zip(kept, self.best(queries[kept], k) if len(kept) else []):
                out[at] = rows
            return out
        up, down = np.maximum(queries, 0).T, np.minimum(queries, 0).T
        read = np.zeros((n, len(queries)))  # what was read of a vector
        low_read, high_read = np.zeros_like(read), np.zeros_like(read)
        least = up.T @ self.sorted[-1] + down.T @ self.sorted[0]
        open_queries, before = np.arange(len(queries)), 0
        seen_top, seen_bottom = np.zeros(matrix.shape, bool), np.zeros(matrix.shape, bool)
        for share in DEPTHS:
            depth = max(1, int(np.ceil(n * share)))
            top = (self.from_top >= before) & (self.from_top < depth)
            bottom = (self.from_top < n - before) & (self.from_top >= n - depth)
            seen_top |= top
            seen_bottom |= bottom
            plus, minus = up[:, open_queries], down[:, open_queries]
            read[:, open_queries] += (matrix * top) @ plus + (matrix * bottom) @ minus
            last_top, last_bottom = self.sorted[depth - 1], self.sorted[n - depth]
            worst_top, worst_bottom = self.sorted[-1], self.sorted[0]
            low_read[:, open_queries] += top @ (plus * worst_top[:, None]) + bottom @ (minus * worst_bottom[:, None])
            high_read = seen_top @ (plus * last_top[:, None]) + seen_bottom @ (minus * last_bottom[:, None])
            low = read[:, open_queries] + least[open_queries] - low_read[:, open_queries]
            high = read[:, open_queries] + (plus.T @ last_top + minus.T @ last_bottom) - high_read
            bar = np.partition(low, n - k, axis=0)[n - k]
            may = high + 2 * slack[open_queries] >= bar
            few = may.sum(0) <= 8 * k
            done = few | (share == 1.0)
            for at in np.flatnonzero(done):
                out[open_queries[at]] = np.flatnonzero(may[:, at])
            open_queries, before = open_queries[~done], depth
            if not len(open_queries):
                break
        return out


def resolved(ids: np.ndarray, lists: Lists, query: int, vector: np.ndarray, rows: np.ndarray, k: int) -> list[tuple]:
    """(query, vec_id, score) of the k best of ``rows`` other than the query's own id."""
    rows = rows[ids[rows] != query]
    scores, own = lists.exact(rows, vector), ids[rows]
    if scores.dtype == object:
        order = sorted(range(len(rows)), key=lambda i: (-scores[i], own[i]))[:k]
        if any(abs(scores[i]) >> 63 for i in order):
            raise OverflowError(f"the score of vec_id {query} with one of its best is no 64-bit number")
    else:
        order = np.lexsort((own, -scores))[:k]
    return [(query, int(own[i]), int(scores[i])) for i in order]


def search(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other vectors for each id divisible by ``every``."""
    rows = stage(quantised(vectors), "vectors")
    right = blocks(rows, BLOCK, "vector-blocks")
    left = blocks(rows.where(F.col("vec_id") % every == 0), QUERIES, "query-blocks")
    n = right.count()
    reached = left.select("width", F.col("ids").alias("query_ids"), F.col("matrix").alias("queries"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    units = reached.join(right.select("width", "part", "ids", "matrix"), ["width", "part"]) if n else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple = (None, None, None)
        for batch in batches:
            for row in range(batch.num_rows):
                width, ids, matrix, query_ids, queries = (batch.column(c)[row].as_py() for c in ("width", "ids", "matrix", "query_ids", "queries"))
                if held[0] != ids or held[1] != matrix:
                    held = ids, matrix, Lists(np.frombuffer(matrix, np.float64).reshape(-1, width))
                lists, own = held[2], np.frombuffer(ids, np.int64)
                asked, wanted = np.frombuffer(query_ids, np.int64), np.frombuffer(queries, np.float64).reshape(-1, width)
                # A query may stand in the block itself, once for each row with its id.
                twins = np.array([np.count_nonzero(own == q) for q in asked]) if len(asked) else np.zeros(0, int)
                found = []
                for extra in np.unique(twins):
                    some = np.flatnonzero(twins == extra)
                    for at, rows_at in zip(some, lists.best(wanted[some], k + int(extra))):
                        found += resolved(own, lists, int(asked[at]), wanted[at], rows_at, k)
                q, v, s = (np.array(x, np.int64) for x in (zip(*found) if found else ([], [], [])))
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(v), pa.array(s)], ["query_id", "vec_id", "score"])

    schema = "query_id long, vec_id long, score long"
    if units is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = units.mapInArrow(run, schema).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
