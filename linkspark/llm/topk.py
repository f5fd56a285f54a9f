"""Exact top-k by inner product with Fagin's threshold algorithm over sorted lists a dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block of candidates, sorted once and held by one task, and queries that it answers at a time.
ROWS, QUERIES = 8192, 256
#: Entries read from each list in the first round; each round reads as many again as all before.
DEPTH = 32
NAMES = ["query_id", "vec_id", "score"]
SCHEMA = "query_id long, vec_id long, score long"


class Block:
    """Candidates with a list a dimension of them in the order of that component, sorted once for all queries."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.rows, self.ids = rows[order], ids[order]
        self.lists = np.argsort(self.rows, axis=0, kind="stable").astype(np.int32)
        self.values = np.take_along_axis(self.rows, self.lists, axis=0)
        self.largest = int(np.abs(self.rows).max(initial=0))
        self.exact = self.rows.astype(np.float64)

    def top(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> tuple[list[tuple], int]:
        """The k best candidates of each query by the threshold algorithm: (query, id, score), and how many scores were computed.

        The queries read the lists in step, each list from the end where a query's weight
        has the largest products; a round reads on from both ends and scores the rows seen
        for the first time, one product of matrices for all queries that still read. No
        unseen row can exceed the sum of a query's products at the ends of reading: a query
        stops once its kth score is above that sum (with an equal score an unseen row could
        still win by its id).

        Products are taken in doubles where every sum is below 2**53, else in 64-bit
        integers; sums beyond those raise an error.
        """
        n, dims = self.rows.shape
        reach = int(np.abs(queries).max(initial=0)) * self.largest * max(dims, 1)
        if reach >= 2**63:
            raise OverflowError("scores of these vectors don't fit into 64 bits")
        kind = np.float64 if reach < 2**53 else np.int64
        rows, values, queries = (self.exact if kind is np.float64 else self.rows), self.values.astype(kind), queries.astype(kind)
        out, depth, scored = [], 0, 0
        active, seen = np.arange(len(queries)), np.zeros(n, dtype=bool)
        # below every score, which is over -2**53 in doubles and over -2**63 in integers
        least = -np.inf if kind is np.float64 else np.iinfo(np.int64).min
        scores = np.full((len(queries), n), least, dtype=kind)
        while len(active):
            new = min(n, max(DEPTH, 2 * depth))
            fresh = np.zeros(n, dtype=bool)
            fresh[self.lists[depth:new].ravel()] = True
            fresh[self.lists[n - new : n - depth].ravel()] = True
            if not dims:
                fresh[:], new = True, n
            fresh = np.flatnonzero(fresh & ~seen)
            seen[fresh] = True
            scored += len(fresh) * len(active)
            q = queries[active]
            scores[np.ix_(active, fresh)] = q @ rows[fresh].T
            depth = new
            bound = (np.where(q < 0, q * values[depth - 1], q * values[n - depth])).sum(axis=1)
            valid = scores[active]
            own = np.searchsorted(self.ids, query_ids[active]), np.searchsorted(self.ids, query_ids[active], side="right")
            for i in np.flatnonzero(own[0] < own[1]):
                valid[i, own[0][i] : own[1][i]] = least
            kth = np.partition(valid, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), least, dtype=kind)
            ready = (kth > bound) | (depth >= n)
            for i in np.flatnonzero(ready):
                best = np.flatnonzero((valid[i] >= kth[i]) & (valid[i] > least))
                best = best[np.lexsort((self.ids[best], -valid[i][best]))][:k]
                out += zip([int(query_ids[active[i]])] * len(best), self.ids[best].tolist(), valid[i][best].astype(np.int64).tolist(), strict=True)
            active = active[~ready]
        return out, scored


def _vectors(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of a batch."""
    return batch.column(2).to_numpy(), batch.column(3).flatten().to_numpy().reshape(batch.num_rows, dims)


def _search(k: int, queries_at_once: int):
    """Reads, sorted by (dims, block, is_query), blocks of candidates and then the queries that they meet: a task holds one block and some queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, block = None, [], None
        for whole in batches:
            dims, blocks, query = (whole.column(i).to_numpy() for i in (0, 1, 4))
            marks = np.flatnonzero((np.diff(dims) != 0) | (np.diff(blocks) != 0) | (np.diff(query) != 0)) + 1
            for lo, hi in zip([0, *marks.tolist()], [*marks.tolist(), whole.num_rows], strict=True):
                if hi == lo:
                    continue
                key, part = (int(dims[lo]), int(blocks[lo])), whole.slice(lo, hi - lo)
                if key != at:
                    at, held, block = key, [], None
                if not query[lo]:
                    held.append(_vectors(part, key[0]))
                    continue
                if block is None and held:
                    block = Block(np.concatenate([h[1] for h in held]), np.concatenate([h[0] for h in held]))
                    held = []
                for i in range(0, part.num_rows, queries_at_once) if block else ():
                    ids, vectors = _vectors(part.slice(i, queries_at_once), key[0])
                    found, _ = block.top(vectors, ids, k)
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=NAMES)

    return run


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """(dims, id, v): floor(scale x) of each component; vectors null or with null or non-finite components are left out, as is a null id."""
    v = F.col("embedding").cast("array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.select(F.col("vec_id").cast("long").alias("id"), v.alias("embedding")).filter("id IS NOT NULL AND embedding IS NOT NULL").filter(ok.alias("ok"))
    # components beyond 64 bits are no integers there: they stop the query, rather than wrap
    floor = lambda x: F.when(F.abs(x * scale) < float(2**62), F.floor(x * scale)).otherwise(F.raise_error(F.lit("a component is beyond 64 bits")).cast("long"))
    return good.select(F.size("embedding").alias("dims"), "id", F.transform("embedding", floor).alias("v"))


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64, rows: int = ROWS) -> DataFrame:
    """For each row of ``vectors(vec_id, embedding)`` whose vec_id is divisible by ``every``: query_id, rank, vec_id, score of the k best others.

    Scores are inner products of the components floor(scale x); ties go to the smaller
    vec_id. Candidates are dealt to blocks of about ``rows``, each to one place and
    sorted once, and all queries stream past each block; only the k best of each block
    go on, and the best of those are the answer.

    Scores are exact; where they or a component could exceed 64 bits the query stops with
    an error. Vectors that are null or hold null or non-finite components take no part, nor
    do rows without vec_id. Vectors meet those of the same length only; empty ones all
    score 0. Rows that repeat a query's vec_id are its own and no candidates; repeated
    candidates each count, and repeated queries are one. An empty table gives no rows.
    Other columns are ignored.
    """
    valid = quantised(vectors, scale)
    blocks = max(1, -(-valid.count() // rows))
    # dealt in turn, so that blocks are even whatever the ids are
    candidates = valid.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")).withColumn("query", F.lit(0))
    queries = valid.filter(F.col("id") % every == 0).groupBy("dims", "id").agg(F.first("v").alias("v"))
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(1))
    columns = ["dims", "block", "id", "v", "query"]
    both = candidates.select(*columns).unionByName(queries.select(*columns)).repartition(blocks, "dims", "block").sortWithinPartitions("dims", "block", "query")
    found = both.mapInArrow(_search(k, QUERIES), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
