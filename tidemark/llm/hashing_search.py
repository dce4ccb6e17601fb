"""Nearest neighbours by inner product with multi-index hashing.

Codes. Vectors get one more component that makes all of them equally long, so that the largest inner product is the
smallest angle. On a bounded sample, rotations are learned that bring the centred vectors close to the corners of a
cube (iterative quantisation); the signs of the rotated components are the code.

Search. Codes are split into substrings of a byte. If two codes differ in at most ``r`` bits, then by the pigeonhole
principle some substring differs in at most ``r // parts`` bits, and all but the first ``r % parts + 1`` of them need
only be probed one bit less far. An index from the values of every substring to rows thus yields every code within
the radius; those that really are inside are ranked by their float vectors.

Radius. A bounded number of sampled queries is compared with every row, in one pass without a shuffle of vectors. The
radius is what reaches their true neighbours among all rows, so it shrinks as rows get denser. Where fewer than the
wanted number lie inside it, it grows until there are enough.

Each row is indexed in one block. Queries are sent to the blocks and stream past the index of each, so a task holds
the index of one block and a batch of queries. Only where queries are more than ``QUERY_ROWS`` is the index copied, once
for each such group: rows shuffled are ``n * queries / QUERY_ROWS + queries * n / INDEX_ROWS``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Batches

#: Vectors that rotations are learned from at most, the lowest by a hash of their ids.
SAMPLE_ROWS = 4096
#: Vectors of the sample whose true neighbours among all rows set the radius.
SAMPLE_QUERIES = 256
ROUNDS = 30
BITS = 128
#: Share of those neighbours that the radius must reach.
REACH = 0.98
LEAST_BLOCKS = 24
INDEX_ROWS = 65_536
QUERY_ROWS = 1 << 20
#: Queries that are compared with a block at a time.
STEP_ROWS = 256
_ONES = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)
_APART = _ONES[np.arange(256)[:, None] ^ np.arange(256)[None, :]]


@dataclass(frozen=True)
class Coder:
    """``length``: the length that all vectors are brought to; codes are the signs of ``(x - mean) @ turn``."""

    length: float
    mean: np.ndarray
    turn: np.ndarray
    radius: int

    def _extended(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        more = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.length**2 - (vectors**2).sum(axis=1), 0))
        whole = np.column_stack([vectors, more])
        return whole / np.sqrt((whole**2).sum(axis=1, keepdims=True)) * self.length if query else whole

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        """A row of bytes for each vector."""
        return np.packbits((self._extended(vectors, query) - self.mean) @ self.turn > 0, axis=1)


def _rotation(centred: np.ndarray, seed: int) -> np.ndarray:
    """A rotation by iterative quantisation from a random start."""
    random = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(random.standard_normal((centred.shape[1], centred.shape[1])))
    for _ in range(ROUNDS):
        turned = centred @ turn
        u, _, v = np.linalg.svd(np.where(turned > 0, 1.0, -1.0).T @ centred, full_matrices=False)
        turn = (u @ v).T
    return turn


def learn(sample: np.ndarray, length: float, bits: int = BITS) -> Coder:
    """Rotations for ``bits`` bits from rows of a sample; the radius is yet to be measured."""
    whole = np.column_stack([sample, np.sqrt(np.maximum(length**2 - (sample**2).sum(axis=1), 0))])
    mean = whole.mean(axis=0)
    turns = [_rotation(whole - mean, seed) for seed in range(-(-bits // whole.shape[1]))]
    return Coder(length, mean, np.column_stack(turns)[:, :bits], bits)


def _nearest_apart(coder: Coder, query_ids: np.ndarray, queries: np.ndarray, count: int):
    """For each of a few queries the scores of a task's nearest rows, and by how many bits their codes differ."""
    own = coder.codes(queries, True)

    def run(batches: Batches) -> Batches:
        scores = np.full((len(queries), count), -np.inf)
        apart = np.zeros((len(queries), count), dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS * 4):
                part = batch.slice(at, STEP_ROWS * 4)
                vectors = _matrix(part.column("vector"))
                here = np.where(query_ids[:, None] == part.column("id").to_numpy()[None, :], -np.inf, queries @ vectors.T)
                codes = coder.codes(vectors)
                bits = _ONES[own[:, None, :] ^ codes[None, :, :]].sum(axis=2, dtype=np.int64)
                scores, apart = np.hstack([scores, here]), np.hstack([apart, bits])
                best = np.argsort(-scores, axis=1, kind="stable")[:, :count]
                scores, apart = np.take_along_axis(scores, best, 1), np.take_along_axis(apart, best, 1)
        query, place = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [pa.array(query), pa.array(scores[query, place]), pa.array(apart[query, place])], names=["query", "score", "apart"]
        )

    return run


def measured_radius(rows: DataFrame, coder: Coder, query_ids: np.ndarray, queries: np.ndarray, count: int) -> int:
    """The Hamming radius that reaches ``REACH`` of the true ``count`` neighbours, among all rows, of a few queries."""
    near = rows.select("id", "vector").mapInArrow(_nearest_apart(coder, query_ids, queries, count), "query bigint, score double, apart bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "apart")
    true = near.withColumn("place", F.row_number().over(order)).where(F.col("place") <= count)
    found = true.agg(F.percentile("apart", F.lit(REACH))).first()[0]
    return coder.turn.shape[1] if found is None else int(np.ceil(found))


def substring_tables(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each substring the rows in the order of its values, and where in them each value begins."""
    orders = [np.argsort(codes[:, part], kind="stable") for part in range(codes.shape[1])]
    return [(order, np.searchsorted(codes[order, part], np.arange(257))) for part, order in enumerate(orders)]


def within(index: np.ndarray, queries: np.ndarray, radius: int, tables: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """For each query, which codes of the index some substring's probes reach: all codes within ``radius``, and more."""
    parts, tables = index.shape[1], tables or substring_tables(index)
    reached = np.zeros((len(queries), len(index)), dtype=bool)
    for part, (order, edges) in enumerate(tables):
        allowed = radius // parts - (part > radius % parts)
        if allowed < 0:
            continue
        for value in np.unique(queries[:, part]):
            buckets = np.flatnonzero(_APART[value] <= allowed)
            rows = np.concatenate([order[edges[b] : edges[b + 1]] for b in buckets])
            reached[np.ix_(np.flatnonzero(queries[:, part] == value), rows)] = True
    return reached


@dataclass(frozen=True)
class Block:
    """The index of a block: ids, vectors and codes of its rows, and for each substring the rows by its value."""

    ids: np.ndarray
    vectors: np.ndarray
    codes: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]

    def search(self, coder: Coder, query_ids: np.ndarray, queries: np.ndarray, count: int):
        """``query row, id, score`` of the nearest ``count`` rows that the index yields for each query."""
        own = coder.codes(queries, True)
        reached = within(self.codes, own, coder.radius, self.tables)
        rows, found, scores = [], [], []
        for i in range(len(queries)):
            near = np.flatnonzero(reached[i])
            apart = _ONES[self.codes[near] ^ own[i]].sum(axis=1, dtype=np.int64)
            near = near[(apart <= coder.radius) & (self.ids[near] != query_ids[i])]
            if len(near) < count:
                others = np.flatnonzero(self.ids != query_ids[i])
                apart = _ONES[self.codes[others] ^ own[i]].sum(axis=1, dtype=np.int64)
                radius = np.sort(apart)[min(count, len(apart)) - 1] if len(apart) else 0
                near = others[apart <= max(radius, coder.radius)]
            products = (self.vectors[near] * queries[i]).sum(axis=1)
            best = np.lexsort((self.ids[near], -products))[:count]
            rows.append(np.full(len(best), i))
            found.append(self.ids[near[best]])
            scores.append(products[best])
        return np.concatenate(rows), np.concatenate(found), np.concatenate(scores)


def block_of(coder: Coder, ids: np.ndarray, vectors: np.ndarray) -> Block:
    codes = coder.codes(vectors)
    return Block(ids, vectors, codes, substring_tables(codes))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def nearest(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 20,
    count: int = 20,
    bits: int = BITS,
    sample_rows: int = SAMPLE_ROWS,
    radius: int | None = None,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector whose id is divisible by ``every`` its ``count`` nearest found.

    Nearness is the largest inner product in double precision, ties to the smaller id; rows with the query's own id
    are no candidates. Rows with a NULL id, vectors that are NULL, empty or zero or hold NULL or non-finite components,
    and vectors of another length than most (ties: the shorter) take no part. A repeated id is searched for with each of its vectors. All
    other rows are indexed, and every query gets ``count`` rows if there are so many. No rows: no rows.
    """
    good = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.col(key).isNotNull() & F.forall(vector, good) & F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("rows"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("square"), F.count(F.when(F.col("id") % every == 0, 1)).alias("queries"))
    common = sizes.orderBy(F.desc("rows"), "size").first()
    fields = "query_id bigint, query_key bigint, vec_id bigint, score double"
    if common is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("vector") == common["size"])
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    coder = learn(np.array([r["vector"] for r in sample]), float(np.sqrt(common["square"])), bits)
    if radius is None:
        few = sample[:SAMPLE_QUERIES]
        radius = measured_radius(rows, coder, np.array([r["id"] for r in few]), np.array([r["vector"] for r in few]), count)
    coder = Coder(coder.length, coder.mean, coder.turn, radius)

    dealt, slots = dealt_rows(rows, every, common["rows"], common["queries"])
    near = dealt.repartitionById(slots, F.col("slot")).sortWithinPartitions("is_query").mapInArrow(_searched(coder, count), fields)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)
    return ranked.select("query_id", "rank", "vec_id", "score")


def dealt_rows(rows: DataFrame, every: int, indexed: int, queries: int) -> tuple[DataFrame, int]:
    """``slot, is_query, id, query_key, vector``: what each slot, a block of the index and a group of queries, is sent."""
    blocks = max(LEAST_BLOCKS, -(-indexed // INDEX_ROWS))
    groups = max(1, -(-queries // QUERY_ROWS))
    block = F.pmod(F.xxhash64("id", F.lit("index")), F.lit(blocks)).cast("int")
    group = F.pmod(F.xxhash64("id", F.lit("query")), F.lit(groups)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.withColumn("other", each(groups))
    index = index.select((F.col("other") * blocks + block).alias("slot"), F.lit(False).alias("is_query"), "id", F.lit(0).cast("bigint").alias("query_key"), "vector")
    asked = rows.where(F.col("id") % every == 0).withColumn("query_key", F.xxhash64("vector")).withColumn("other", each(blocks))
    asked = asked.select((group * blocks + F.col("other")).alias("slot"), F.lit(True).alias("is_query"), "id", "query_key", "vector")
    return index.unionByName(asked), blocks * groups


def _searched(coder: Coder, count: int):
    """A slot's rows of the index, then its queries: the nearest rows of the block for each query."""

    def run(batches: Batches) -> Batches:
        held, block = [], None
        for batch in batches:
            indexed = batch.num_rows - pc.sum(batch.column("is_query").cast(pa.int64())).as_py() if batch.num_rows else 0
            if indexed:
                held.append(batch.slice(0, indexed))
            asked = batch.slice(indexed)
            if not asked.num_rows or not held and block is None:
                continue
            if block is None:
                ids = np.concatenate([x.column("id").to_numpy() for x in held])
                block, held = block_of(coder, ids, np.concatenate([_matrix(x.column("vector")) for x in held])), []
            for at in range(0, asked.num_rows, STEP_ROWS):
                part = asked.slice(at, STEP_ROWS)
                own = part.column("id").to_numpy()
                place, found, scores = block.search(coder, own, _matrix(part.column("vector")), count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own[place]), part.column("query_key").take(pa.array(place)), pa.array(found), pa.array(scores)],
                    names=["query_id", "query_key", "vec_id", "score"],
                )

    return run
