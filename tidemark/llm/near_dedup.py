"""Near-duplicate groups by DartMinHash signatures, banded joining and exact checks.

Signatures. Every element owns the strip ``[0, weight)`` of a plane of weights and ranks. Darts hit the plane as a
Poisson process that depends on the element alone: in dyadic regions of the weight axis they arrive in rank order
with seeded exponential gaps. Only darts below a rank that lets in some ``k ln k + 2 k`` of them are made. Each dart
falls on one of ``k`` coordinates; the earliest dart of a coordinate is its value. Two sets agree on a coordinate
with the probability of their weighted Jaccard similarity, at a cost of the darts thrown, not of ``k`` times the set.

Candidates. Groups of ``ROWS`` coordinates are bands, and texts with an equal band share a bucket. First each
bucket's members are checked against the one that most rows hold, the likely original, which joins copies into
components without naming all pairs of a bucket. What then shares a bucket but no component is compared too, once for
each pair and behind a sketch of four bits for each coordinate, so no link that the bands find is lost.

Checks. Similarity is the exact Jaccard similarity of the sets of distinct 5-word shingles, 0.8 or more. Equal texts
are one node throughout; only texts that share a bucket are read a second time.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, stored
from tidemark.llm.components import connected_components
from tidemark.llm.shingles import shingle_sets
from tidemark.llm.textbytes import U64, mix64

COORDINATES = 384
BANDS = 28
ROWS = 6
#: Of COORDINATES bits; a pair at similarity 0.8 differs in 38.4 with a deviation of 5.9.
SKETCH_BITS = 66
#: Of COORDINATES four-bit digits; a pair at similarity 0.8 differs in 72 with a deviation of 7.65.
SKETCH_DIGITS = 104
BATCH_ROWS = 512
#: Members of a bucket that are compared at a time; a bucket of more is cut into tiles that spread over tasks.
TILE_ROWS = 256
_STEP = U64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-53


def _turn(number: int) -> np.uint64:
    return U64(number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> U64(11)).astype(np.float64) + 0.5) * _UNIT


def darts(elements: np.ndarray, weights: np.ndarray, rank: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and ids of all darts below ``rank`` that hit the strips of the elements."""
    ranks, ids, level, low = [], [], 0, 0.0
    while len(elements) and low < weights.max():
        high = 1.0 if level == 0 else 2.0 * low
        inside = weights > low
        own, limit, width = mix64(elements[inside] + _turn(level + 1)), weights[inside], high - low
        if rank * width <= 0.7:
            at, number = np.zeros(len(own)), 0
            while len(own):
                h = mix64(own + _turn(number))
                at = at - np.log(_uniform(h)) / width
                keep = at < rank
                own, limit, at, h = own[keep], limit[keep], at[keep], h[keep]
                hit = low + width * _uniform(mix64(h + _STEP)) < limit if (limit < high).any() else slice(None)
                ranks.append(at[hit])
                ids.append(h[hit])
                number += 1
        else:
            expected = rank * width
            number = ceil(expected + 6 * sqrt(expected) + 8)
            while True:
                h = mix64(own[:, None] + np.arange(number, dtype=np.uint64)[None, :] * _STEP)
                at = np.cumsum(-np.log(_uniform(h)) / width, axis=1)
                if not len(own) or at[:, -1].min() >= rank:
                    break
                number *= 2
            hit = at < rank
            if (limit < high).any():
                hit &= low + width * _uniform(mix64(h + _STEP)) < limit[:, None]
            ranks.append(at[hit])
            ids.append(h[hit])
        level, low = level + 1, high
    if not ranks:
        return np.zeros(0), np.zeros(0, dtype=np.uint64)
    return np.concatenate(ranks), np.concatenate(ids)


def dart_minhash(elements: np.ndarray, weights: np.ndarray | None = None, k: int = COORDINATES) -> np.ndarray:
    """The ids of the earliest darts on ``k`` coordinates. ``weights`` above 0, None: all 1. Some element is needed."""
    weights = np.ones(len(elements)) if weights is None else np.asarray(weights, dtype=np.float64)
    rank = (k * log(k) + 2 * k) / weights.sum()
    signature, filled = np.zeros(k, dtype=np.uint64), np.zeros(k, dtype=bool)
    while True:
        at, ids = darts(elements, weights, rank)
        order = np.argsort(-at, kind="stable")
        ids = ids[order]
        place = (mix64(ids ^ U64(0xD1B54A32D192ED03)) % U64(k)).astype(np.int64)
        signature[place], filled[place] = ids, True
        if filled.all():
            return signature
        rank *= 2


def _bands(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mix64(key * _STEP + rows[:, j])
    return key.view(np.int64)


def _sketch(signature: np.ndarray) -> np.ndarray:
    """A bit and a four-bit digit of each coordinate, packed into longs one after the other."""
    mixed = mix64(signature)
    bits = np.packbits(((mixed >> U64(40)) & U64(1)).astype(np.uint8))
    digits = ((mixed >> U64(33)) & U64(15)).astype(np.uint8)
    return np.concatenate([bits, digits[::2] << 4 | digits[1::2]]).view(np.int64)


def _digits_apart(a: Column, b: Column) -> Column:
    """In how many of their sixteen four-bit digits two longs differ."""
    x = a.bitwiseXOR(b)
    x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
    x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))


def _longs(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.zeros(0, dtype=np.int64)))


def _signed(batches: Batches) -> Batches:
    none = np.zeros(0, dtype=np.int64)
    for batch in batches:
        bands, sketches = [], []
        for row, found in shingle_sets(batch.column("text")):
            signature = dart_minhash(found) if len(found) else None
            bands.append(none if signature is None else _bands(signature))
            sketches.append(none if signature is None else _sketch(signature))
        keep = [batch.column(c) for c in ("doc", "k1", "k2")]
        yield pa.RecordBatch.from_arrays([*keep, _longs(bands), _longs(sketches)], names=["doc", "k1", "k2", "bands", "sketch"])


def _sets(batches: Batches) -> Batches:
    for batch in batches:
        rows, at = [], 0
        for row, found in shingle_sets(batch.column("text")):
            rows.append(found.view(np.int64))
            if len(rows) == BATCH_ROWS:
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(rows)), _longs(rows)], names=["node", "shingles"])
                rows, at = [], row + 1
        if rows:
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(at, len(rows)), _longs(rows)], names=["node", "shingles"])


def _linked(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose shingle sets are as similar as asked."""
    of = lambda side: sets.select(F.col("node").alias(f"n{side}"), F.col("shingles").alias(f"s{side}"))
    both = pairs.join(of("a"), F.col("a") == F.col("na")).join(of("b"), F.col("b") == F.col("nb"))
    common = F.size(F.array_intersect("sa", "sb"))
    enough = common >= F.lit(similarity) * (F.size("sa") + F.size("sb") - common)
    return both.where(enough).select("a", "b")


def _groups(docs: DataFrame, doc: str, text: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Each row's text key and bands; and for each text with words its component, smallest id and text key."""
    picked = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    keyed = picked.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit("second"), "text")})
    signed = stored(
        keyed.mapInArrow(_signed, "doc bigint, k1 bigint, k2 bigint, bands array<bigint>, sketch array<bigint>"), "dart-signatures"
    )
    worded = signed.where(F.size("bands") > 0)
    nodes = worded.groupBy("k1", "k2").agg(
        F.min("doc").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "dart-nodes")

    bands = nodes.select("node", F.posexplode("bands").alias("at", "band"), "copies")
    first = F.min(F.struct(-F.col("copies"), "node"))["node"]
    hubs = bands.groupBy("band").agg(first.alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    hubs = hubs.select(F.col("band").alias("key"), "hub", "members")
    shared = stored(bands.join(hubs, F.col("band") == F.col("key")).select("node", "at", "band", "hub", "members"), "dart-buckets")

    wanted = shared.select("node").distinct().join(nodes.select(F.col("node").alias("n"), "k1", "k2"), F.col("node") == F.col("n"))
    wanted = wanted.select("node", F.col("k1").alias("w1"), F.col("k2").alias("w2"))
    texts = keyed.join(wanted, (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2"))).select("node", "text")
    sets = texts.mapInArrow(_sets, "node bigint, shingles array<bigint>").groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = stored(sets, "dart-shingles")

    stars = shared.where(F.col("node") != F.col("hub")).select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    edges = stored(_linked(stars, sets, similarity), "dart-links")
    components = connected_components(edges)

    member = shared.where("members > 2").join(components.select(F.col("node").alias("m"), "component"), F.col("node") == F.col("m"), "left")
    tiles = F.floor(F.col("members") / TILE_ROWS).cast("int") + 1
    member = member.select("node", "at", "band", "hub", F.coalesce("component", "node").alias("component"), tiles.alias("tiles"))
    member = member.withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    torn = member.groupBy("band", "tiles").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    torn = torn.select(F.col("band").alias("key"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("part"))
    sketches = nodes.select(F.col("node").alias("n"), "sketch", "bands")
    same = (F.col("band") == F.col("key")) & (F.col("tile") == F.col("part"))
    member = member.where(F.col("node") != F.col("hub")).join(torn, same).join(sketches, F.col("node") == F.col("n"))
    member = stored(member.select("at", "band", "node", "component", "sketch", "bands", "tiles", "tile"), "dart-torn")
    # tile (i, j) of a bucket compares its i-th part with its j-th, i <= j, so that each pair meets once
    parts = {"a": F.sequence(F.col("tile"), F.col("tiles") - 1), "b": F.sequence(F.lit(0), F.col("tile"))}
    side = lambda s: member.withColumn("with", F.explode(parts[s])).select(*[F.col(c).alias(f"{c}_{s}") for c in [*member.columns, "with"]])
    # the cheap test is compiled with the join; the sharper one runs for pairs that pass it
    longs = COORDINATES // 64
    bits = reduce(Column.__add__, [F.bit_count(F.get("sketch_a", i).bitwiseXOR(F.get("sketch_b", i))) for i in range(longs)])
    digits = F.aggregate(
        F.zip_with(F.slice("sketch_a", longs + 1, 4 * longs), F.slice("sketch_b", longs + 1, 4 * longs), _digits_apart), F.lit(0), Column.__add__
    )
    before = F.arrays_overlap(F.slice("bands_a", F.lit(1), F.col("at_a")), F.slice("bands_b", F.lit(1), F.col("at_b")))
    rest = side("a").join(
        side("b"),
        (F.col("band_a") == F.col("band_b"))
        & (F.col("tile_a") == F.col("with_b"))
        & (F.col("with_a") == F.col("tile_b"))
        & ((F.col("tile_a") < F.col("tile_b")) | (F.col("node_a") < F.col("node_b")))
        & (F.col("component_a") != F.col("component_b"))
        & (bits <= SKETCH_BITS)
        & (digits <= SKETCH_DIGITS)
        & ~before,
    )
    rest = rest.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    more = stored(_linked(rest, sets, similarity), "dart-more-links")
    components = connected_components(edges.unionByName(more))

    lows = nodes.select("node", "k1", "k2", "low").join(
        components.select(F.col("node").alias("c"), "component"), F.col("node") == F.col("c"), "left"
    )
    lows = lows.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), "low", F.coalesce("component", "node").alias("component"))
    return signed, lows


def near_duplicates(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, cluster_id``, the smallest id of the documents linked to it in any way.

    Documents are linked if the sets of their 5-word shingles have a Jaccard similarity of ``similarity`` or more,
    and so are equal texts. Texts of fewer than five words are one shingle. NULL texts and texts without words are
    linked to nothing and keep their own id. Rows with a NULL id belong to groups like others and get the group's
    smallest id, NULL if no row of it has one. Rows that repeat appear again. No rows: no rows.
    """
    signed, lows = _groups(docs, doc, text, similarity)
    smallest = lows.groupBy("component").agg(F.min("low").alias("cluster")).withColumnRenamed("component", "of")
    named = lows.join(smallest, F.col("component") == F.col("of")).select("n1", "n2", "cluster")
    same = (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2")) & (F.size("bands") > 0)
    members = signed.select("doc", "k1", "k2", "bands").join(named, same, "left")
    own = F.when(F.size("bands") > 0, F.col("cluster")).otherwise(F.col("doc"))
    return members.select(F.col("doc").alias("doc_id"), own.alias("cluster_id"))


def deduplicated(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row with the smallest id, NULL last.

    Rows with equal ids and texts count as one. Texts without words are in no group: of them only such repeats go.
    """
    signed, lows = _groups(docs, doc, text, similarity)
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "n1", "n2")).alias("first")
    kept = lows.groupBy("component").agg(first).select("first.n1", "first.n2", "first.low")
    wordless = signed.where(F.size("bands") == 0).select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("doc").alias("low"))
    names = ["_k1", "_k2", "_id"]
    while set(names) & set(docs.columns):
        names = ["_" + n for n in names]
    keys = (F.xxhash64(text), F.xxhash64(F.lit("second"), text), F.col(doc).cast("bigint"))
    keyed = docs.withColumns(dict(zip(names, keys)))
    k1, k2, own = map(F.col, names)
    wanted = kept.unionByName(wordless).distinct()
    left = keyed.join(wanted, (k1 == F.col("n1")) & (k2 == F.col("n2")) & own.eqNullSafe(F.col("low")), "left_semi")
    return left.dropDuplicates(names).select(*docs.columns)
