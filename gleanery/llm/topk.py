"""Exact top-k inner products by no-random-access aggregation over sorted lists.

Candidates are cut into blocks. A block has a list of (value, place) for every dimension, sorted
once where the block is made. A query with a positive weight in a dimension reads that list from
its top, one with a negative weight from its bottom, so what an entry adds to a score falls as it
reads; lists of weight nought are not read.

The queries of a block read the block's lists together in small steps, each list from both ends;
what a step yields is an entry's value and the place it belongs to, and nothing else is looked up.
After a step a candidate has an upper bound for a query: what was read of it on that query's side
of each list, and the next entry's value where it wasn't seen. Candidates not seen at all have
one such bound together, and as long as that reaches the query's k-th best score, no bounds are
made. While the k-th best score is unknown, candidates also have a lower bound, with each list's
worst entry where they weren't seen, and the k-th best of these takes its place. Candidates whose
upper bound is below it are outsiders. A query stops reading when few others are left, and
resolves the final scores of those; one that never stops has its scores when the lists end.

A task keeps each query's best scores while it goes through the candidate blocks of a strip, so
later blocks are read against the k-th best score from the start.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm import common

SCALE = 64.0
#: Vectors of a candidate block (places are 16-bit numbers) and of a query block.
CANDIDATES, QUERIES = 4096, 512
#: Candidate blocks of a strip and query blocks of a lane; a task has one of each.
STRIP, LANE = 8, 2
#: Steps in which lists are read.
STEPS = 32
#: A query resolves final scores once this many candidates of a block, or k, are left.
LEFT = 64
BLOCK = "deal int, dim int, ids binary, vectors binary, values binary, places binary"
NO_SCORE = np.iinfo(np.int64).min


def _kind(*blocks: np.ndarray):
    """The quickest numbers in which sums of products of these are exact."""
    most = 1
    for block in blocks:
        most *= int(np.abs(block).max(initial=0)) + 1
    most *= blocks[0].shape[1] if blocks[0].size else 1
    return np.float32 if most < 2**23 else np.float64 if most < 2**52 else object


def _bounded(scores: np.ndarray) -> np.ndarray:
    """Exact scores as 64-bit numbers; those beyond are moved to the ends."""
    ends = np.iinfo(np.int64)
    return np.clip(scores, ends.min + 1, ends.max).astype(np.int64)


class Lists:
    """A candidate block's sorted lists: by dimension values, highest first, and their places."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, values: np.ndarray, places: np.ndarray):
        self.ids, self.vectors, self.values, self.places = ids, vectors, values, places

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> Lists:
        places = np.argsort(-vectors, axis=0, kind="stable").T
        return cls(ids, vectors, np.take_along_axis(vectors.T, places, 1), places)

    def reader(self, kind) -> Reader:
        return Reader(Lists(self.ids, self.vectors.astype(kind), self.values.astype(kind), self.places))


class Reader:
    """What has been read of every list, from the top and from the bottom."""

    def __init__(self, lists: Lists):
        self.lists, self.depth = lists, 0
        dim, size = lists.values.shape
        #: By place: values read by dimension, from the top and then from the bottom; where they are.
        self.read = np.zeros((size, 2 * dim), lists.values.dtype)
        self.seen = np.zeros((size, 2 * dim), bool)
        self.worst = np.concatenate([lists.values[:, -1], lists.values[:, 0]])

    def go_to(self, depth: int) -> None:
        values, places = self.lists.values, self.lists.places
        dim, size = values.shape
        column = np.arange(dim)[:, None]
        for part, shift in ((slice(self.depth, depth), 0), (slice(size - depth, size - self.depth), dim)):
            self.read[places[:, part], column + shift] = values[:, part]
            self.seen[places[:, part], column + shift] = True
        self.depth = depth

    def next(self) -> np.ndarray:
        """The value of the next entry of each list, from the top and from the bottom."""
        values, size = self.lists.values, self.lists.values.shape[1]
        at = min(self.depth, size - 1)
        return np.concatenate([values[:, at], values[:, size - 1 - at]])

    def known(self, unseen: np.ndarray) -> np.ndarray:
        """What was read, with a value by list where a place wasn't seen."""
        return np.where(self.seen, self.read, unseen)


class Best:
    """The k best candidates so far of every query of a block, and how much of the lists was read."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, k: int):
        self.ids, self.weights, self.k = ids, weights, k
        self.found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        self.least = [NO_SCORE for _ in ids]
        self.entries = self.entries_read = 0

    def _merge(self, query: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids = np.concatenate([self.found[query][0], ids])
        scores = np.concatenate([self.found[query][1], scores])
        if len(ids) > 8 * self.k:  # ties at the k-th score stay
            enough = scores >= np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[enough], scores[enough]
        order = np.lexsort((ids, -scores))[: self.k]
        self.found[query] = ids[order], scores[order]
        if len(order) == self.k:
            self.least[query] = int(scores[order[-1]])

    def read(self, lists: Lists) -> None:
        """Aggregate the lists of one candidate block."""
        kind, size, k = _kind(self.weights, lists.vectors), len(lists.ids), self.k
        reader = lists.reader(kind)
        # a list is read from its top by queries of positive weight, else from its bottom
        both = np.concatenate([np.maximum(self.weights, 0), np.minimum(self.weights, 0)], 1).astype(kind)
        lengths = (self.weights != 0).sum(1)
        floors = np.array(self.least, object if kind is object else np.float64)
        unknown = (floors == NO_SCORE) & (size > k)
        own = self.ids[:, None] == lists.ids[None, :]
        reading = np.arange(len(self.ids))
        self.entries += int(lengths.sum()) * size
        for depth in np.unique(np.linspace(0, size, min(STEPS, size) + 1).astype(np.int64))[1:].tolist():
            self.entries_read += int(lengths[reading].sum()) * (depth - reader.depth)
            reader.go_to(depth)
            ended = depth == size
            blind = reading[unknown[reading]]
            if len(blind) and 2 * depth >= size:
                # without a score to beat, the k-th best lower bound is one
                below = both[blind] @ reader.known(reader.worst).T
                below[own[blind]] = NO_SCORE
                floors[blind] = np.partition(below, -k, axis=1)[:, -k]
            ahead = both[reading] @ reader.next()
            able = reading[(ahead < floors[reading]) | ended]
            if not len(able):
                continue
            upper = both[able] @ reader.known(reader.next()).T
            left = (upper >= floors[able][:, None]) & ~own[able]
            done = (left.sum(1) <= max(k, LEFT)) | ended
            for row in np.flatnonzero(done).tolist():
                query, places = int(able[row]), np.flatnonzero(left[row])
                if ended:
                    scores = upper[row, places]
                else:
                    self.entries_read += int((~reader.seen[places] & (both[query] != 0)).sum())
                    scores = reader.lists.vectors[places] @ self.weights[query].astype(kind)
                self._merge(query, lists.ids[places], _bounded(scores))
            reading = np.setdiff1d(reading, able[done], assume_unique=True)
            if not len(reading):
                return


def integers(df: DataFrame, vector: str, id: str) -> DataFrame:
    """``(id, v)``: floor(64 * x) of every component x as double; unusable rows are left out."""
    own = df.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("x"))
    usable = F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall(
        "x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    # floor of a double beyond 64 bits is moved to the ends
    scaled = F.transform("x", lambda c: F.floor(F.greatest(F.lit(-9e18), F.least(F.lit(9e18), c * SCALE))))
    return own.where(usable).select("id", scaled.alias("v"))


def _packed(numbers: np.ndarray) -> bytes:
    """Numbers in the fewest bytes that hold them, behind the size of one."""
    kind = np.min_scalar_type(-int(np.abs(numbers).max(initial=0)) - 1)
    return bytes([kind.itemsize]) + np.ascontiguousarray(numbers, kind).tobytes()


def _unpacked(packed: bytes, *shape: int) -> np.ndarray:
    return np.frombuffer(packed, f"<i{packed[0]}", offset=1).astype(np.int64).reshape(shape)


def blocks(rows: DataFrame, size: int, deals: int, sort: bool) -> DataFrame:
    """Rows of ``integers`` as blocks of up to ``size`` vectors of one dimension, see ``BLOCK``.

    Blocks are cut from each task's own rows and dealt in turn: no key decides where a row goes.
    Only with ``sort`` they have lists.
    """

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        number = TaskContext.get().partitionId()

        def made(dim):
            nonlocal number
            ids, vectors = held.pop(dim)
            number += 1
            own = np.array(vectors, np.int64).reshape(len(ids), dim)
            lists = Lists.of(np.array(ids, np.int64), own) if sort else None
            columns = [[number % deals], [dim], [np.array(ids, "<i8").tobytes()], [_packed(own)],
                       [_packed(lists.values) if sort else None],
                       [lists.places.astype("<u2").tobytes() if sort else None]]
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["deal", "dim", "ids", "vectors", "values", "places"],
            )

        for batch in common.slices(batches):
            for id, vector in zip(batch.column(0).to_pylist(), common.lists_of(batch.column(1))):
                ids, vectors = held.setdefault(len(vector), ([], []))
                ids.append(id)
                vectors.append(vector)
                if len(ids) == size:
                    yield made(len(vector))
        for dim in list(held):
            yield made(dim)

    common.prepare(rows.sparkSession)
    return rows.mapInArrow(run, BLOCK)


def _aggregate(k: int):
    """Pairs of a query block and a candidate block to the best of each query in the task.

    A row without ``vec_id`` follows for each query block: how many entries its lists had, and
    how many were read.
    """

    def run(batches):
        best, key = None, None

        def out():
            rows = [(int(q), int(i), int(s), None, None) for q, (ids, scores) in zip(best.ids, best.found)
                    for i, s in zip(ids, scores)]
            rows.append((int(best.ids[0]), None, None, best.entries, best.entries_read))
            return pa.RecordBatch.from_arrays(
                [common.longs(c) for c in zip(*rows)], ["query_id", "vec_id", "score", "entries", "entries_read"]
            )

        for batch in batches:
            for row in range(batch.num_rows):
                dim, q_ids, q_vectors, ids, vectors, values, places = (
                    batch.column(i)[row].as_py() for i in range(7)
                )
                if q_ids != key:
                    if best is not None:
                        yield out()
                    asked = np.frombuffer(q_ids, "<i8")
                    key, best = q_ids, Best(asked, _unpacked(q_vectors, len(asked), dim), k)
                own = np.frombuffer(ids, "<i8")
                by_dim = np.frombuffer(places, "<u2").reshape(dim, len(own))
                best.read(Lists(own, _unpacked(vectors, len(own), dim), _unpacked(values, dim, len(own)), by_dim))
        if best is not None:
            yield out()

    return run


FOUND = "query_id long, vec_id long, score long, entries long, entries_read long"


def _found(df: DataFrame, queries: DataFrame, k: int, vector: str, id: str) -> DataFrame:
    rows = integers(df, vector, id)
    asked = integers(queries, vector, id).groupBy("id").agg(F.min("v").alias("v"))
    count, queries_count = rows.count(), asked.count()
    strips = max(1, -(-count // (CANDIDATES * STRIP)))
    lanes = max(1, -(-queries_count // (QUERIES * LANE)))
    # small partitions would make small blocks
    held = rows.coalesce(max(1, -(-count // CANDIDATES)))
    candidates = blocks(held, CANDIDATES, strips, sort=True).withColumnRenamed("deal", "strip")
    asking = blocks(asked.coalesce(lanes), QUERIES, lanes, sort=False).select(
        F.col("deal").alias("lane"), "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors")
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip")
    every_lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    pairs = asking.select("*", everywhere).hint("merge").join(
        candidates.select("*", every_lane), ["strip", "lane", "dim"]
    ).select("dim", "q_ids", "q_vectors", "ids", "vectors", "values", "places")
    common.prepare(df.sparkSession)
    return pairs.mapInArrow(_aggregate(k), FOUND)


def top_k(
    df: DataFrame, queries: DataFrame, k: int, *, vector: str = "embedding", id: str = "vec_id"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's ``k`` highest inner products.

    Candidates are all rows of ``df`` but those with the query's id, of the query's dimension.
    Ties go to the smaller id; a query with fewer candidates has all. Vectors that are null or
    hold a null or a non-finite component, and rows without id, take no part. Of rows that
    repeat an id, each is a candidate; as query the id is asked once, with its smallest vector.
    Each query's best of every strip of candidates meet, never its scores. A task has a strip of
    candidates and a lane of queries.
    """
    found = _found(df, queries, k, vector, id).where("vec_id is not null")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def share_read(
    df: DataFrame, queries: DataFrame, k: int, *, vector: str = "embedding", id: str = "vec_id"
) -> DataFrame:
    """One row ``(entries, entries_read, share)``: what ``top_k`` reads of all lists of all queries."""
    counts = _found(df, queries, k, vector, id).where("vec_id is null")
    total = counts.agg(F.sum("entries").alias("entries"), F.sum("entries_read").alias("entries_read"))
    return total.withColumn("share", F.try_divide("entries_read", "entries"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all embeddings for every twentieth."""
    embeddings = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(embeddings, embeddings.where(F.col("vec_id") % 20 == 0), 20)


TOP_K_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
    SELECT query_id, vec_id, score,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
