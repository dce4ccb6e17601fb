"""Mixing sources to target weights by Sainte-Laguë apportionment of equal blocks.

The words of a source are dealt into shards of bounded size by a seeded hash of the documents, each shard is put
into a seeded order and cut into blocks of equal length. The words wanted in all, in blocks, are handed to the
sources by highest quotients ``target / (2 j - 1)``, and a source's blocks to its shards in the same way, so that
every shard ends with a whole number of blocks to take. A shard that must give more blocks than it has gives all of
them and then some again; which, a seeded permutation of its blocks decides. A document is taken as far as its
words lie in taken blocks.

Everything is DataFrame expressions. Rows of documents are shuffled once, by (source, shard); the rest works on a
row per shard or per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored
from tidemark.llm.quality import word_count

SHARD_WORDS = 1 << 18
BLOCK_WORDS = 32
SEED = 17
#: Coprime to every number of blocks below it.
_STEP = 2147483647
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0


def cyclic_weights(sources: DataFrame, source: str, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (a row per source) with ``weight``: the given weights in turn by code point order, NULL last."""
    place = F.row_number().over(Window.orderBy(F.col(source).isNull(), F.col(source)))
    return sources.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (place - 1) % len(weights)).cast("double"))


def water_fill(sources: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources`` (``size, weight``, a row per source) with ``target``: ``share`` of all sizes split by weight.

    No target exceeds ``most`` times its source's size; what is cut off goes to the others by weight. In the order
    of cap to weight, the sources before some point are at their caps, and one level holds for all behind it.
    """
    cap = most * F.col("size")
    order = Window.orderBy(cap / F.col("weight"), F.col("weight"), F.col("size"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = share * F.sum("size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    leveled = sources.withColumns({"_cap": cap, "_rank": F.row_number().over(order), "_level": left / weight_left})
    level = F.min_by(F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_level")), F.when(F.col("_level") * F.col("weight") <= F.col("_cap"), F.col("_rank"))).over(everything)
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight")))
    return leveled.withColumn("target", target).drop("_cap", "_rank", "_level")


def apportion(rows: DataFrame, group: list[str], votes: str, seats: str, key: list[Column], out: str) -> DataFrame:
    """``rows`` with ``out``: the seats of its group that a row gets by the highest quotients ``votes / (2 j - 1)``.

    ``seats`` is a column of whole numbers, equal within a group; ties go by ``key``. Two divisors, one surely too
    high and one surely too low, bound each row's seats, and only the quotients in between are sorted: about three
    for each row of the group, whatever the number of seats.
    """
    over = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    v, s = F.col(votes).cast("double"), F.col(seats).cast("double")
    sure = s - F.col("_rows") / 2 - 1
    low = F.when((sure > 0) & (F.col("_sum") > 0), F.greatest(F.floor(v * sure / F.col("_sum") + 0.5) - 1, F.lit(0))).otherwise(F.lit(0))
    high = F.when(F.col("_sum") > 0, F.floor(v * (s + F.col("_rows") / 2 + 1) / F.col("_sum") + 0.5) + 1).otherwise(F.lit(0))
    bounded = rows.withColumns({"_sum": F.sum(v).over(over), "_rows": F.count(F.lit(1)).over(over)})
    bounded = bounded.withColumns({"_low": F.when(s > 0, low).otherwise(F.lit(0)).cast("bigint"), "_high": F.when(s > 0, high).otherwise(F.lit(0)).cast("bigint")})
    bounded = bounded.withColumn("_open", F.col(seats) - F.sum("_low").over(over))
    tries = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("_high") - F.col("_low"), F.lit(0))), lambda i: F.col("_low") + i
    )
    spread = bounded.withColumn("_seat", F.explode(tries))
    quotient = F.when((F.col("_seat") > F.col("_low")) & (v > 0), v / (2 * F.col("_seat") - 1)).otherwise(F.lit(-1.0))
    rank = F.row_number().over(over.orderBy(quotient.desc(), *key, F.col("_seat")))
    chosen = spread.withColumn("_won", ((quotient > 0) & (rank <= F.col("_open"))).cast("bigint"))
    kept = [c for c in rows.columns]
    return chosen.groupBy(*kept, "_low").agg(F.sum("_won").alias("_more")).select(*kept, (F.col("_low") + F.col("_more")).alias(out))


def mix(
    docs: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, taken, copies``: what the mix takes of each document.

    ``size`` counts the text's words. ``taken`` counts the words taken, repeats included, at most twice ``size``;
    a source's taken words come within a block and rounding of its ``target``. ``copies`` is the same mix in whole
    documents: each as often as its shard is taken in full, and those first in the shard's seeded order once more,
    up to the words that the shard still owes (to half a document). Columns of ``docs`` with these names are replaced.

    NULL and empty texts have size 0 and are never taken; a NULL source is a source. Rows that repeat are separate
    and stand next to each other in their shard. Equal inputs and seeds give equal results. No rows: no rows.
    """
    prefix = "_m"
    while any(c.startswith(prefix) for c in docs.columns):
        prefix = "_" + prefix
    c = lambda name: F.col(f"{prefix}{name}")
    size, key, src = f"{prefix}size", f"{prefix}key", f"{prefix}source"
    out = ["size", "source_size", "target", "taken", "copies"]
    sized = docs.withColumns(
        {size: word_count(F.col(text)), key: F.xxhash64(F.lit(seed), F.col(doc), F.col(text)), src: F.col(source)}
    ).drop(*out)

    sums = stored(sized.groupBy(F.col(src).alias("source")).agg(F.sum(size).alias("size")), "mix-sources")
    targets = water_fill(cyclic_weights(sums, "source", weights), share, most)
    blocks = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / block_words).cast("bigint")
    targets = apportion(targets.withColumn("blocks", blocks), [], "target", "blocks", [F.col("source").asc_nulls_last()], "source_blocks")
    targets = stored(targets.withColumn("shards", F.greatest(F.lit(1), F.ceil(F.col("size") / shard_words)).cast("bigint")), "mix-targets")
    of_source = targets.select(
        F.col("source").alias(f"{prefix}of"),
        F.col("size").alias(f"{prefix}whole"),
        F.col("target").alias(f"{prefix}target"),
        F.col("shards").alias(f"{prefix}shards"),
    )
    dealt = sized.join(of_source, c("source").eqNullSafe(c("of")), "left").withColumn(
        f"{prefix}shard", F.pmod(F.xxhash64(c("key"), F.lit(seed)), c("shards"))
    )

    shards = dealt.groupBy(c("source").alias("source"), c("shard").alias("shard")).agg(F.sum(size).alias("words"))
    quota_of = targets.select(F.col("source").alias("of"), "source_blocks")
    shards = shards.join(quota_of, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    shards = apportion(shards, ["source"], "words", "source_blocks", [F.col("shard")], "quota")
    count = F.greatest(F.lit(1), F.round(F.col("words") / block_words)).cast("bigint")
    quotas = shards.select(
        F.col("source").alias(f"{prefix}qs"),
        F.col("shard").alias(f"{prefix}qn"),
        F.col("words").alias(f"{prefix}words"),
        count.alias(f"{prefix}blocks"),
        F.least(F.col("quota"), 2 * count).alias(f"{prefix}quota"),
    )
    quotas = stored(quotas, "mix-quotas")

    shard = Window.partitionBy(c("source"), c("shard")).orderBy(c("key"), F.col(doc), c("size"))
    before = shard.rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn(f"{prefix}start", F.coalesce(F.sum(size).over(before), F.lit(0)))
    same = c("source").eqNullSafe(c("qs")) & (c("shard") == c("qn"))
    placed = placed.join(quotas, same, "left")
    first = F.expr(f"(({prefix}start + 1) * {prefix}blocks - 1) div {prefix}words")
    last = F.expr(f"(({prefix}start + {prefix}size) * {prefix}blocks - 1) div {prefix}words")
    full, extra = F.expr(f"{prefix}quota div {prefix}blocks"), F.expr(f"{prefix}quota % {prefix}blocks")
    offset = F.pmod(F.xxhash64(F.lit(seed), c("source"), c("shard")), c("blocks"))
    placed = placed.withColumns({f"{prefix}first": first, f"{prefix}last": last, f"{prefix}full": full, f"{prefix}extra": extra, f"{prefix}offset": offset})
    taken = F.expr(
        f"aggregate(sequence({prefix}first, {prefix}last), 0L, (sum, b) -> sum"
        f" + (least({prefix}start + {prefix}size, ((b + 1) * {prefix}words) div {prefix}blocks)"
        f"    - greatest({prefix}start, (b * {prefix}words) div {prefix}blocks))"
        f" * ({prefix}full + if((b * {_STEP}L + {prefix}offset) % {prefix}blocks < {prefix}extra, 1L, 0L)))"
    )
    placed = placed.withColumn(f"{prefix}taken", F.when(c("size") > 0, taken).otherwise(F.lit(0)).cast("bigint"))
    more = F.expr(f"2 * {prefix}start + {prefix}size < 2 * {prefix}extra * {prefix}words / {prefix}blocks").cast("bigint")
    copies = F.when(c("size") > 0, c("full") + more).otherwise(F.lit(0))
    result = placed.withColumns(
        {"size": c("size"), "source_size": c("whole"), "target": c("target"), "taken": c("taken"), "copies": copies.cast("bigint")}
    )
    return result.drop(*[x for x in result.columns if x.startswith(prefix)])


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as its ``copies``, with the columns of ``docs``."""
    mixed = mix(docs, **options).where(F.col("copies") > 0)
    copy = "_copy"
    while copy in docs.columns:
        copy = "_" + copy
    return mixed.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))).select(*docs.columns)
