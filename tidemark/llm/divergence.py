"""How the sources of a language differ: term shares of each source against every other and against the whole language.

1. Every task counts in how many documents a term occurs; terms of at least ``least`` documents of a language are kept and
   numbered in byte order.
2. Runs of 65,536 kept terms become minimal acyclic transducers (see ``transducer``), whose ordinals plus the terms before
   are these numbers.
3. Texts stream through the transducers once more. Each chunk gives one row for each source and block of 4,096 ordinals;
   rows of a block are added in two rounds, the first dealt by chunk as well, one sorted row after another.
4. Blocks of the same ordinals of all sources, 256 sources against 256 at a time, give their part of every pair's sum and
   each source's foremost terms. Terms of equal value are ranked by ordinal, which is their order in UTF-8.

Transducers are sent to all executors, at most ``MOST_SENT`` bytes at a time; texts stream once for each such load. Their
size is known from step 2, so what is sent never exceeds that whatever the vocabulary.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import by_value, byte_table, word_chunks
from tidemark.llm.common import Batches, row_numbers, running_totals, stored
from tidemark.llm.transducer import Transducer

LEAST_DOCUMENTS, TOP_TERMS, SMOOTHING, SCALE = 10, 10, 2, 1_000_000_000
SHARD_TERMS, BLOCK_TERMS, TILE_SOURCES = 1 << 16, 1 << 12, 256
MOST_SENT = 64 << 20
#: Keys that a block's rows are first added under, so that a block of a large corpus is no hot key.
SALTS = 16

_TERM = byte_table(bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))


def _picked(docs: DataFrame, text: str, lang: str, source: str | None = None) -> DataFrame:
    names = {"lang": lang, "text": text} | ({"source": source} if source else {})
    return docs.select([F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in names.items()])


def kept_terms(docs: DataFrame, *, text: str, lang: str, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, term, ordinal`` of terms in at least ``least`` documents of their language, numbered in byte order."""

    def count(batches: Batches) -> Batches:
        for batch in batches:
            for name, rows in by_value(batch, "lang"):
                for chunk in word_chunks(rows.column("text"), _TERM, lower=True, most=8 << 20):
                    numbers, terms = chunk.coded()
                    once = np.unique(chunk.row_of() * len(terms) + numbers) % max(len(terms), 1)
                    documents = np.bincount(once, minlength=len(terms))
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(terms), pa.string()), terms, pa.array(documents)], names=["lang", "term", "documents"])

    found = _picked(docs, text, lang).mapInArrow(count, "lang string, term string, documents bigint")
    kept = found.groupBy("lang", "term").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least)
    return stored(running_totals(kept.select("lang", "term", F.lit(1).alias("one")), "lang", [F.col("term")], "one", "ordinal").drop("one"), "kept-terms")


def transducers(kept: DataFrame) -> DataFrame:
    """``lang, shard, bytes, data``: a transducer for each run of ``SHARD_TERMS`` ordinals."""

    def build(table: pa.Table) -> pa.Table:
        data = Transducer.of(term.encode() for term in table.sort_by("ordinal").column("term").to_pylist()).to_bytes()
        return pa.table({"lang": [table.column("lang")[0].as_py()], "shard": [table.column("shard")[0].as_py()], "bytes": [len(data)], "data": [data]})

    sharded = kept.withColumn("shard", F.expr(f"ordinal DIV {SHARD_TERMS}"))
    return stored(sharded.groupBy("lang", "shard").applyInArrow(build, "lang string, shard bigint, bytes bigint, data binary"), "transducers")


def _loads(shards: DataFrame) -> list[list]:
    """Languages and shards whose transducers are sent together."""
    loads, size = [], MOST_SENT + 1
    for row in shards.select("lang", "shard", "bytes").orderBy("lang", "shard").toLocalIterator():
        if size + row.bytes > MOST_SENT:
            loads.append([])
            size = 0
        loads[-1].append(row)
        size += row.bytes
    return loads


def counted(docs: DataFrame, shards: DataFrame, *, text: str, lang: str, source: str) -> DataFrame:
    """``lang, block, source, ordinals, counts, total``: occurrences of kept terms, a row for each source and block.

    ``ordinals`` and ``counts`` are parallel arrays as bytes: the ordinals inside the block in 16 bits, counts in 64.
    """
    picked = _picked(docs, text, lang, source)
    fields = "lang string, block bigint, source string, salt int, ordinals binary, counts binary"
    parts = []
    for load in _loads(shards):
        first, last = load[0], load[-1]
        of, shard = F.col("lang"), F.col("shard")
        inside = (of > first.lang) | ((of == first.lang) & (shard >= first.shard))
        inside &= (of < last.lang) | ((of == last.lang) & (shard <= last.shard))
        sent = defaultdict(list)
        for row in shards.where(inside).select("lang", "shard", "data").collect():  # at most MOST_SENT bytes
            sent[row.lang].append((row.shard * SHARD_TERMS, bytes(row.data)))
        sent = docs.sparkSession.sparkContext.broadcast(dict(sent))

        def count(batches: Batches, sent=sent) -> Batches:
            walks = {name: [(base, Transducer.from_bytes(data)) for base, data in several] for name, several in sent.value.items()}
            done = 0
            for batch in batches:
                for name, rows in by_value(batch, "lang"):
                    if name not in walks:
                        continue
                    for chunk in word_chunks(rows.column("text"), _TERM, lower=True, most=8 << 20):
                        numbers, terms = chunk.coded()
                        ordinal = np.full(len(terms), -1, dtype=np.int64)
                        for base, walk in walks[name]:
                            found = walk.ordinals(terms)
                            ordinal = np.where(found >= 0, found + base, ordinal)
                        sources = rows.column("source").slice(chunk.first, chunk.rows).dictionary_encode()
                        ordinal, owner = ordinal[numbers], sources.indices.to_numpy()[chunk.row_of()]
                        known = ordinal >= 0
                        most = int(ordinal.max(initial=0)) + 1
                        keys, counts = np.unique(owner[known] * most + ordinal[known], return_counts=True)
                        if len(keys):
                            salt = int(row_numbers(1, done)[0] % SALTS)
                            done += 1
                            yield _block_rows(name, sources.dictionary, keys // most, keys % most, counts, salt, BLOCK_TERMS)

        parts.append(picked.mapInArrow(count, fields))
    if not parts:
        empty = docs.sparkSession.createDataFrame([], fields)
        return _added(empty, []).withColumn("total", F.lit(0).cast("bigint"))
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    summed = _added(_added(rows, ["salt"]), [])
    return stored(summed, "term-counts")


def _block_rows(name: str, sources: pa.Array, owner: np.ndarray, ordinal: np.ndarray, counts: np.ndarray, salt: int, terms: int) -> pa.RecordBatch:
    """A row for each source and block of ``terms`` ordinals, from ascending (source, ordinal)."""
    block = ordinal // terms
    new = np.ones(len(block), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(new)
    inner, counts = (ordinal % terms).astype("<u2"), counts.astype("<i8")
    edges = np.append(at, len(block))
    cut = lambda a: pa.array([a[i:j].tobytes() for i, j in zip(edges[:-1], edges[1:])], pa.binary())
    zeros = pa.array(np.zeros(len(at), dtype=np.int64))
    return pa.RecordBatch.from_arrays(
        [pa.array([name]).take(zeros), pa.array(block[at]), sources.take(pa.array(owner[at])), pa.array([salt], pa.int32()).take(zeros), cut(inner), cut(counts)],
        names=["lang", "block", "source", "salt", "ordinals", "counts"],
    )


def _added(rows: DataFrame, salts: list[str]) -> DataFrame:
    """Rows of a block and source added up, one after another; ``salts`` are further columns to deal and keep apart by."""
    keys = ["lang", "block", *salts, "source"]
    dealt = rows.repartition("lang", "block", *salts).sortWithinPartitions(*keys)

    def add(batches: Batches) -> Batches:
        last, sums = None, np.zeros(BLOCK_TERMS, dtype=np.int64)
        made: list[tuple] = []

        def closed() -> None:
            at = np.flatnonzero(sums)
            made.append((*last, at.astype("<u2").tobytes(), sums[at].astype("<i8").tobytes(), int(sums.sum())))
            sums[:] = 0

        def built() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*made), schema)]
            made.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for batch in batches:
            columns = [batch.column(k).to_pylist() for k in keys]
            for *key, ordinals, counts in zip(*columns, batch.column("ordinals").to_pylist(), batch.column("counts").to_pylist()):
                if key != last:
                    if last is not None:
                        closed()
                    last = key
                sums[np.frombuffer(ordinals, dtype="<u2")] += np.frombuffer(counts, dtype="<i8")
                if len(made) >= 256:
                    yield built()
        if last is not None:
            closed()
        if made:
            yield built()

    types = {"lang": pa.string(), "block": pa.int64(), "salt": pa.int32(), "source": pa.string()}
    schema = pa.schema([*((k, types[k]) for k in keys), ("ordinals", pa.binary()), ("counts", pa.binary()), ("total", pa.int64())])
    sql = {"lang": "string", "block": "bigint", "salt": "int", "source": "string"}
    return dealt.mapInArrow(add, f"{', '.join(f'{k} {sql[k]}' for k in keys)}, ordinals binary, counts binary, total bigint")


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (counts + SMOOTHING) / whole)``, exact: the product may pass 64 bits, so it is divided in steps."""
    value = counts + np.int64(SMOOTHING)
    result, rest = value // whole, value % whole
    for _ in range(3):
        rest = rest * 1000
        result, rest = result * 1000 + rest // whole, rest % whole
    return result + 1


def difference(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _compared(rows: DataFrame, top: int) -> tuple[DataFrame, DataFrame]:
    """Parts of pair sums ``lang, a, b, value`` and each block's foremost terms ``lang, a, ordinal, value``.

    ``rows``: ``lang, block, left, right, number, whole, size, ordinals, counts`` sorted by tile and number; number -1 is
    the language itself, ``whole`` is N + 2V and ``size`` the terms of the block.
    """
    fields = "lang string, kind int, a bigint, b bigint, value bigint"

    def compare(batches: Batches) -> Batches:
        last, numbers, values, present, of_lang = None, [], [], [], None

        def closed() -> pa.RecordBatch:
            lang, block, left, right = last
            out: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            ids = np.array(numbers, dtype=np.int64)
            for i in range(len(ids)):
                rest = ids[i + 1 :]
                other = np.flatnonzero((rest // TILE_SOURCES == right) | (left == right)) + i + 1 if ids[i] // TILE_SOURCES == left else []
                if len(other):
                    sums = np.array([int(difference(values[i], values[j]).sum()) for j in other], dtype=np.int64)
                    out.append((0, np.full(len(other), ids[i]), ids[other], sums))
                if left == right and of_lang is not None:
                    at = np.flatnonzero(present[i] & (values[i] > of_lang))
                    f = difference(values[i][at], of_lang[at])
                    best = np.lexsort((at, -f))[:top]
                    out.append((1, np.full(len(best), ids[i]), block * BLOCK_TERMS + at[best], f[best]))
            sizes = [len(o[1]) for o in out]
            kind = np.repeat(np.array([o[0] for o in out], dtype=np.int32), sizes)
            columns = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, dtype=np.int64) for k in (1, 2, 3)]
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(kind), pa.string()), pa.array(kind), *map(pa.array, columns)], names=["lang", "kind", "a", "b", "value"])

        for batch in batches:
            for row in batch.to_pylist():
                key = (row["lang"], row["block"], row["left"], row["right"])
                if key != last:
                    if last is not None:
                        yield closed()
                    last, numbers, values, present, of_lang = key, [], [], [], None
                dense = np.zeros(row["size"], dtype=np.int64)
                if row["ordinals"]:
                    dense[np.frombuffer(row["ordinals"], dtype="<u2")] = np.frombuffer(row["counts"], dtype="<i8")
                p = shares(dense, np.int64(max(row["whole"], 1)))
                if row["number"] < 0:
                    of_lang = p
                else:
                    numbers.append(row["number"])
                    values.append(p)
                    present.append(dense > 0)
        if last is not None:
            yield closed()

    dealt = rows.repartition("lang", "block", "left", "right").sortWithinPartitions("lang", "block", "left", "right", "number")
    found = stored(dealt.mapInArrow(compare, fields), "compared")
    return found.where("kind = 0").select("lang", "a", "b", "value"), found.where("kind = 1").select("lang", "a", F.col("b").alias("ordinal"), "value")


def audit(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS
) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` compares a source with each other source of its language,
    part ``term`` has its ``top`` terms that it uses more than its language.

    Terms are runs of letters and characters outside ASCII, A-Z in lower case. With ``count`` of a source's occurrences of
    a kept term and ``N`` of all of the ``V`` kept terms, ``p = 1 + floor(1e9 * (count + 2) / (N + 2 * V))``, and
    ``f = floor((p - q)^2 / (p + q))``. A pair's value is the sum over all kept terms, 0 without any. Integers throughout.

    NULL text, language and source read as empty; a source without terms has its pairs all the same. Repeated rows count
    as often as they stand. A language of one source has neither pairs nor terms. No rows: no rows.
    """
    kept = kept_terms(docs, text=text, lang=lang, least=least)
    counts = counted(docs, transducers(kept), text=text, lang=lang, source=source)

    groups = _picked(docs, text, lang, source).select("lang", "source").distinct()
    groups = groups.join(counts.groupBy("lang", "source").agg(F.sum("total").alias("N")), ["lang", "source"], "left").fillna(0, "N")
    groups = stored(groups, "source-groups")
    numbered = stored(running_totals(groups.withColumn("one", F.lit(1)), "lang", [F.col("source")], "one", "number").drop("one"), "numbered-sources")
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"))
    langs = numbered.groupBy("lang").agg(F.sum("N").alias("N"), F.count(F.lit(1)).alias("S"))
    langs = stored(langs.join(vocabulary, "lang", "left").fillna(0, "V"), "source-langs")

    blocks = F.sequence(F.lit(0), F.greatest(F.expr(f"(V - 1) DIV {BLOCK_TERMS}"), F.lit(0)))
    size = F.least(F.lit(BLOCK_TERMS), F.col("V") - F.col("block") * BLOCK_TERMS).cast("int")
    per_lang = langs.select("lang", "V", "S", F.col("N").alias("all"))
    grid = numbered.join(per_lang, "lang").withColumn("block", F.explode(blocks))
    of_sources = grid.join(counts.drop("total"), ["lang", "block", "source"], "left")
    tiles = F.expr(f"(S - 1) DIV {TILE_SOURCES}")
    tile, other = F.expr(f"number DIV {TILE_SOURCES}"), F.col("other")
    of_sources = of_sources.withColumn("other", F.explode(F.sequence(F.lit(0), tiles))).select(
        "lang", "block", F.least(tile, other).alias("left"), F.greatest(tile, other).alias("right"), "number",
        (F.col("N") + 2 * F.col("V")).alias("whole"), size.alias("size"), "ordinals", "counts",
    )
    whole = _added(counts.select("lang", "block", F.lit("").alias("source"), "ordinals", "counts"), []).drop("source", "total")
    of_langs = whole.join(per_lang, "lang").withColumn("left", F.explode(F.sequence(F.lit(0), tiles))).select(
        "lang", "block", "left", F.col("left").alias("right"), F.lit(-1).cast("bigint").alias("number"),
        (F.col("all") + 2 * F.col("V")).alias("whole"), size.alias("size"), "ordinals", "counts",
    )
    pairs, terms = _compared(of_sources.unionByName(of_langs), top)

    pairs = pairs.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = numbered.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    pairs = pairs.join(named, ["lang", "b"]).withColumn("tie", F.lit(0).cast("bigint")).select("lang", "a", F.lit("pair").alias("part"), "item", "tie", "value")
    order = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "tie", "item")
    pairs = pairs.withColumn("rank", F.row_number().over(order))

    foremost = Window.partitionBy("lang", "a").orderBy(F.desc("value"), "ordinal")
    terms = terms.withColumn("rank", F.row_number().over(foremost)).where(F.col("rank") <= top)
    terms = terms.join(kept.withColumnRenamed("term", "item"), ["lang", "ordinal"]).select("lang", "a", F.lit("term").alias("part"), "item", "value", "rank")
    both = pairs.drop("tie").unionByName(terms)
    return both.join(numbered.select("lang", F.col("number").alias("a"), "source"), ["lang", "a"]).select("lang", "source", "part", "item", "value", "rank")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
o AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM (SELECT DISTINCT id, lang, term FROM o) GROUP BY ALL HAVING count(*) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT n.lang, n.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (n.n + 2 * v.v) AS p
      FROM n JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c ON c.lang = n.lang AND c.source = n.source AND c.term = k.term),
q AS (SELECT l.lang, l.term, 1 + (1000000000::HUGEINT * (l.c + 2)) // (m.n + 2 * v.v) AS q
      FROM (SELECT lang, term, sum(c) AS c FROM c GROUP BY ALL) AS l
      JOIN (SELECT lang, sum(n) AS n FROM n GROUP BY lang) AS m USING (lang) JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
      FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
         FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
         FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
      FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM r WHERE part = 'pair' OR rank <= 10
"""
