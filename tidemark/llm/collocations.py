"""Frequent phrases and how strongly their words belong together, counted in quotient filters.

1. Texts become chunks: each word's number in the chunk's list of distinct words, with a gap wherever a piece ends.
2. The lists are cut into buckets of words by hash. A bucket's lists from all chunks meet in one group, which counts its
   words, numbers those of at least ``least`` occurrences and tells each chunk the numbers of its own. All other words end
   a run, as a phrase of ``least`` occurrences has only words of as many.
3. Every task counts the pairs of neighbours in its runs in counting quotient filters (see ``quotient_filters``), one for
   each block of permuted keys. Filters of a block from all tasks are merged in sorted order, and what reaches ``least`` is
   restored to words. Each task's chunks learn which of their pairs are frequent.
4. Longer n-grams are counted the same way, in runs of frequent pairs alone.
5. Parts of a frequent phrase are frequent, so scores and the test for longer phrases are joins of frequent phrases.

Numbers of buckets and blocks follow the counts of step 1, so every group has a bounded number of entries.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.chunks import by_value, byte_table, pack, unpack, word_chunks
from tidemark.llm.common import Batches, row_numbers, stored
from tidemark.llm.quotient_filters import Entries, Grams
from tidemark.llm.textbytes import span_hashes, text_bytes

LEAST, LONGEST, TOP = 100, 5, 2000
UNKNOWN_LANG = "und"
#: Entries that a task holds before it hands over its filters, and n-grams of one length in a block at most, about.
HELD_ENTRIES = 3 << 20
BLOCK_GRAMS = 1 << 19
#: Words of all chunks' lists in a bucket, about.
BUCKET_WORDS = 1 << 19

#: Parts of a language that are ranked by themselves first, so that no task sorts all its phrases.
RANKED_PARTS = 64
#: In decimals of up to 38 digits, as products may pass 64 bits.
SCORE = "(CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(15,0)) * CAST(n AS DECIMAL(15,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))"

_ENDS = b".,;:!?\n\x0b\x0c\r"
_WORD = byte_table(b" \t" + _ENDS)
_END = ~byte_table(_ENDS)


def coded_chunks(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """``chunk, lang, size, codes, words, counts``: see step 1; ``codes`` has -1 between words of different pieces."""
    picked = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )

    def code(batches: Batches) -> Batches:
        done = 0
        for batch in batches:
            for name, rows in by_value(batch, "lang"):
                for chunk in word_chunks(rows.column("text"), _WORD, lower=True):
                    if not len(chunk.begin):
                        continue
                    ends = np.concatenate([[0], np.cumsum(_END[chunk.raw], dtype=np.int32)])
                    gap = np.zeros(len(chunk.begin), dtype=bool)
                    gap[1:] = ends[chunk.begin[1:]] != ends[chunk.end[:-1]]
                    gap[chunk.starts[chunk.starts < len(gap)]] = True
                    numbers, words = chunk.coded()
                    codes = np.full(len(gap) + int(gap.sum()), -1, dtype=np.int32)
                    codes[np.arange(len(gap)) + np.cumsum(gap)] = numbers
                    counts = pa.array(np.bincount(numbers, minlength=len(words)))
                    offsets = pa.array([0, len(words)], pa.int32())
                    number = row_numbers(1, done)
                    done += 1
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(number),
                            pa.array([name]),
                            pa.array([len(codes)], pa.int64()),
                            pa.array([pack(codes)]),
                            pa.ListArray.from_arrays(offsets, words),
                            pa.ListArray.from_arrays(offsets, counts),
                        ],
                        names=["chunk", "lang", "size", "codes", "words", "counts"],
                    )

    fields = "chunk bigint, lang string, size bigint, codes binary, words array<string>, counts array<bigint>"
    return stored(picked.mapInArrow(code, fields), "coded-chunks")


def bucket_lists(chunks: DataFrame, buckets: int) -> DataFrame:
    """``chunk, lang, bucket, places, words, counts``: the chunks' lists, cut by a hash of the words."""

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                words, counts = row.column("words").flatten(), row.column("counts").flatten()
                raw, offsets = text_bytes(words)
                bucket = (span_hashes(raw, offsets[:-1], offsets[1:]) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                held, first = np.unique(bucket[order], return_index=True)
                edges = pa.array(np.append(first, len(order)).astype(np.int32))
                zeros, places = pa.array(np.zeros(len(held), dtype=np.int64)), pa.array(order)
                lists = [pa.ListArray.from_arrays(edges, c) for c in (places, words.take(places), counts.take(places))]
                yield pa.RecordBatch.from_arrays(
                    [row.column("chunk").take(zeros), row.column("lang").take(zeros), pa.array(held), *lists],
                    names=["chunk", "lang", "bucket", "places", "words", "counts"],
                )

    fields = "chunk bigint, lang string, bucket bigint, places array<bigint>, words array<string>, counts array<bigint>"
    return chunks.select("chunk", "lang", "words", "counts").mapInArrow(cut, fields)


def numbered_words(lists: DataFrame, buckets: int, least: int) -> DataFrame:
    """For each frequent word a row ``lang, id, word, f``, and for each chunk with some a row ``chunk, places, ids``."""

    def number(table: pa.Table) -> pa.Table:
        words = table.column("words").combine_chunks()
        coded = words.flatten().dictionary_encode()
        codes, offsets = coded.indices.to_numpy(), words.offsets.to_numpy() - words.offsets[0].as_py()
        total = np.zeros(len(coded.dictionary), dtype=np.int64)
        np.add.at(total, codes, table.column("counts").combine_chunks().flatten().to_numpy())
        often = total >= least
        ids = np.where(often, (np.cumsum(often) - 1) * buckets + table.column("bucket")[0].as_py(), -1)
        at = np.flatnonzero(often)
        lang = table.column("lang").combine_chunks().slice(0, 1)
        same = lambda n: lang.take(pa.array(np.zeros(n, dtype=np.int64)))
        nothing = lambda n, kind: pa.nulls(n, kind)
        numbers = pa.list_(pa.int64())
        vocabulary = [same(len(at)), pa.array(ids[at]), coded.dictionary.take(pa.array(at)), pa.array(total[at])]
        vocabulary += [nothing(len(at), kind) for kind in (pa.int64(), numbers, numbers)]
        own = ids[codes]
        kept = own >= 0
        edges = pa.array(np.concatenate([[0], np.cumsum(kept)])[offsets].astype(np.int32))
        places = table.column("places").combine_chunks().flatten().to_numpy()
        n = table.num_rows
        told = [same(n), *(nothing(n, kind) for kind in (pa.int64(), pa.string(), pa.int64())), table.column("chunk").combine_chunks()]
        told += [pa.ListArray.from_arrays(edges, pa.array(c[kept])) for c in (places, own)]
        names = ["lang", "id", "word", "f", "chunk", "places", "ids"]
        return pa.concat_tables([pa.table(vocabulary, names=names), pa.table(told, names=names)])

    fields = "lang string, id bigint, word string, f bigint, chunk bigint, places array<bigint>, ids array<bigint>"
    return stored(lists.groupBy("lang", "bucket").applyInArrow(number, fields), "numbered-words")


_FILTERS = pa.schema(
    [("lang", pa.string()), ("words", pa.int32()), ("block", pa.int64()), ("part", pa.int64()), ("filter", pa.binary())]
    + [("chunk", pa.int64()), ("total", pa.int64()), ("size", pa.int64()), ("ids", pa.binary())]
)
_FILTER_FIELDS = "lang string, words int, block bigint, part bigint, filter binary, chunk bigint, total bigint, size bigint, ids binary"


class FilterTask:
    """A task's filters of n-grams, handed over as rows whenever it holds enough. ``part`` tells one hand-over's rows."""

    def __init__(self, bits: int, least_held: int, block_grams: int):
        self.bits, self.least_held, self.block_grams = bits, least_held, block_grams
        self.held: dict[tuple[str, int], list[Entries]] = defaultdict(list)
        self.totals: dict[str, int] = {}
        self.size = self.parts = 0

    @property
    def part(self) -> int:
        return int(row_numbers(1, self.parts)[0])

    def add(self, lang: str, total: int, columns: list[np.ndarray]) -> None:
        found = Grams(len(columns), self.bits).counted(columns)
        self.held[lang, len(columns)].append(found)
        self.totals[lang] = total
        self.size += len(found)

    def full(self) -> bool:
        return self.size >= self.least_held

    def handed_over(self) -> Batches:
        for (lang, n), several in self.held.items():
            grams = Grams(n, self.bits)
            blocks = grams.blocks(grams.merged(several), (self.totals[lang] // self.block_grams).bit_length())
            found = [{"lang": lang, "words": n, "block": block, "part": self.part, "filter": data} for block, data in blocks]
            for a in range(0, len(found), 256):
                yield pa.RecordBatch.from_pylist(found[a : a + 256], schema=_FILTERS)
        self.held.clear()
        self.size = 0
        self.parts += 1


def pair_filters(chunks: DataFrame, bits: int) -> DataFrame:
    """Rows of filters of neighbouring words ``lang, words, block, part, filter``, and a row ``lang, part, chunk, total, size,
    ids`` for each chunk, with its words' numbers.

    ``chunks``: ``chunk, lang, size, codes, total, known``, where ``known`` has the places of frequent words in the chunk's
    list with their numbers in lists, and ``total`` the words of the language.
    """

    def count(batches: Batches) -> Batches:
        task = FilterTask(bits, HELD_ENTRIES, BLOCK_GRAMS)
        for batch in batches:
            for i in range(len(batch)):
                chunk, lang, total = (batch.column(c)[i].as_py() for c in ("chunk", "lang", "total"))
                codes = unpack(batch.column("codes")[i].as_py(), batch.column("size")[i].as_py(), np.int32)
                known = batch.column("known")[i].values
                numbers = np.full(int(codes.max()) + 2, -1, dtype=np.int32)  # the last stands for gaps
                numbers[known.field("places").flatten().to_numpy()] = known.field("ids").flatten().to_numpy()
                ids = numbers[codes]
                at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
                if len(at):
                    task.add(lang, total, [ids[at], ids[at + 1]])
                    row = {"lang": lang, "part": task.part, "chunk": chunk, "total": total, "size": len(ids), "ids": pack(ids)}
                    yield pa.RecordBatch.from_pylist([row], schema=_FILTERS)
                if task.full():
                    yield from task.handed_over()
        yield from task.handed_over()

    return stored(chunks.select("chunk", "lang", "size", "codes", "total", "known").mapInArrow(count, _FILTER_FIELDS), "pair-filters")


def longer_filters(chunks: DataFrame, bits: int, longest: int) -> DataFrame:
    """``lang, words, block, filter`` of n-grams of three to ``longest`` words whose neighbours are all frequent pairs.

    ``chunks``: ``lang, total, size, ids, pairs``, the last with lists of keys of frequent pairs.
    """

    def count(batches: Batches) -> Batches:
        task = FilterTask(bits, HELD_ENTRIES, BLOCK_GRAMS)
        for batch in batches:
            for i in range(len(batch)):
                lang, total = batch.column("lang")[i].as_py(), batch.column("total")[i].as_py()
                ids = unpack(batch.column("ids")[i].as_py(), batch.column("size")[i].as_py(), np.int32).astype(np.int64)
                often = np.sort(batch.column("pairs")[i].values.flatten().to_numpy())
                pairs = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] << bits | ids[1:], -1)
                run = pair = np.isin(pairs, often)
                for n in range(3, longest + 1):
                    run = run[:-1] & pair[n - 2 :]
                    at = np.flatnonzero(run)
                    if len(at):
                        task.add(lang, total, [ids[at + j] for j in range(n)])
                if task.full():
                    yield from task.handed_over()
        yield from task.handed_over()

    filters = chunks.select("lang", "total", "size", "ids", "pairs").mapInArrow(count, _FILTER_FIELDS)
    return filters.select("lang", "words", "block", "part", "filter")


def frequent_grams(filters: DataFrame, bits: int, least: int) -> DataFrame:
    """``lang, ids, f`` of the n-grams that all filters together count at least ``least`` times; for pairs also a row
    ``part, pairs`` with the keys of those in each part's filter."""

    def merge(table: pa.Table) -> pa.Table:
        grams = Grams(table.column("words")[0].as_py(), bits)
        several = [grams.entries(data) for data in table.column("filter").to_pylist()]
        found = grams.merged(several)
        often = found.count >= least
        columns = grams.columns(*grams.restored(found.left[often], found.right[often]))
        n, size = len(columns[0]), grams.words
        ids = pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * size, size, dtype=np.int32)), pa.array(np.stack(columns, axis=1).reshape(-1)))
        lang = table.column("lang").combine_chunks().slice(0, 1).take(pa.array(np.zeros(n, dtype=np.int64)))
        numbers, names = pa.list_(pa.int64()), ["lang", "ids", "f", "part", "pairs"]
        made = pa.table([lang, ids, pa.array(found.count[often]), pa.nulls(n, pa.int64()), pa.nulls(n, numbers)], names=names)
        if size > 2 or not n:
            return made
        keys = found.left[often] << np.uint64(grams.half) | found.right[often]
        pairs = columns[0] << bits | columns[1]
        order = np.argsort(keys)
        own = []
        for entries in several:
            at = np.searchsorted(keys, entries.left << np.uint64(grams.half) | entries.right, sorter=order)
            hit = order[np.minimum(at, n - 1)]
            own.append(pairs[hit[keys[hit] == (entries.left << np.uint64(grams.half) | entries.right)]])
        edges = pa.array(np.concatenate([[0], np.cumsum([len(o) for o in own])]).astype(np.int32))
        rows = len(own)
        told = [pa.nulls(rows, pa.string()), pa.nulls(rows, numbers), pa.nulls(rows, pa.int64()), table.column("part").combine_chunks()]
        return pa.concat_tables([made, pa.table([*told, pa.ListArray.from_arrays(edges, pa.array(np.concatenate(own)))], names=names)])

    fields = "lang string, ids array<bigint>, f bigint, part bigint, pairs array<bigint>"
    return stored(filters.groupBy("lang", "words", "block").applyInArrow(merge, fields), "frequent-grams")


def _joined(words: Column) -> Column:
    return F.array_join(words, " ")


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of phrases of one to ``longest`` words with at least ``least`` occurrences, and ``lang, n``.

    Both are exact. A NULL language counts as ``und``, a NULL or empty text has no words; repeated rows count as often as
    they stand. No words: no rows.
    """
    chunks = coded_chunks(docs, text, lang)
    totals = chunks.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("n"))
    totals = stored(totals.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    buckets = 1 + (chunks.agg(F.sum(F.size("words"))).first()[0] or 0) // BUCKET_WORDS
    words = numbered_words(bucket_lists(chunks, buckets), buckets, least)
    vocabulary = words.where("id IS NOT NULL").select("lang", "id", "word", "f")
    bits = max(1, int(vocabulary.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]).bit_length())
    known = words.where("size(places) > 0").groupBy("chunk").agg(F.collect_list(F.struct("places", "ids")).alias("known"))
    coded = chunks.select("chunk", "lang", "size", "codes").join(known.hint("merge"), "chunk").join(totals.withColumnRenamed("n", "total"), "lang")

    two = pair_filters(coded, bits)
    pairs = frequent_grams(two.where("filter IS NOT NULL").select("lang", "words", "block", "part", "filter"), bits, least)
    grams = pairs.where("f IS NOT NULL").select("lang", "ids", "f")
    if longest > 2:
        own = pairs.where("size(pairs) > 0").groupBy("part").agg(F.collect_list("pairs").alias("pairs"))
        # never broadcast: the lists grow with the corpus
        runs = two.where("chunk IS NOT NULL").select("lang", "part", "total", "size", "ids").join(own.hint("merge"), "part")
        grams = grams.unionByName(frequent_grams(longer_filters(runs, bits, longest), bits, least).select("lang", "ids", "f"))

    each = grams.select("lang", "ids", "f", F.posexplode("ids").alias("place", "id")).join(vocabulary.select("lang", "id", "word"), ["lang", "id"])
    each = each.groupBy("lang", "ids", "f").agg(F.sort_array(F.collect_list(F.struct("place", "word"))).alias("found"))
    several = each.select("lang", F.col("found.word").alias("words"), "f")
    single = vocabulary.select("lang", F.array("word").alias("words"), "f")
    both = several.unionByName(single).select("lang", _joined(F.col("words")).alias("phrase"), "words", "f")
    return stored(both, "phrases"), totals


def collocations(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``top`` phrases by score, then ``a``, then UTF-8 order.

    A phrase has two to ``longest`` words of one piece (texts are cut at ``.,;:!?`` and line ends) and at least ``least``
    occurrences ``a``. The cut with the lowest ``floor(1000 * a * n / (l * r))`` gives its score, the earlier one of equals.
    A phrase inside a longer one that occurs as often is left out. NULLs, empty texts and repeats as in ``phrase_counts``.
    """
    phrases, totals = phrase_counts(docs, text=text, lang=lang, least=least, longest=longest)
    several = phrases.where(F.size("words") > 1)

    # an n-gram occurs at least as often as any that holds it, so one word more at either end tells about all longer ones
    inner = [F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1)]
    around = several.where(F.size("words") > 2).select("lang", F.explode(F.array(*inner)).alias("words"), "f")
    around = around.groupBy("lang", _joined(F.col("words")).alias("phrase")).agg(F.max("f").alias("longer"))
    kept = several.join(around, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("f")))

    cuts = kept.select("lang", "phrase", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.withColumns({"first": _joined(F.expr("slice(words, 1, k)")), "rest": _joined(F.expr("slice(words, k + 1, size(words) - k)"))})
    for part, out in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(out)), ["lang", part])
    cuts = cuts.join(totals, "lang")
    scored = cuts.withColumn("score", F.expr(SCORE))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    by_score = (F.desc("score"), F.desc("a"), "phrase")
    # the foremost of each language are among the foremost of its parts
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS))).orderBy(*by_score)
    ranked = ranked.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    order = Window.partitionBy("lang").orderBy(*by_score)
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws
      FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, array_to_string(w, ' ') AS phrase, len(w) AS k, count(*) AS f
      FROM (SELECT lang, ws[i:i + s] AS w
            FROM (SELECT lang, ws, s, unnest(range(1, len(ws) - s + 1)) AS i FROM p, range(0, 5) AS r(s)))
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, string_split(phrase, ' ') AS ws, k, f FROM g WHERE k > 1),
x AS (SELECT c.* FROM c WHERE NOT EXISTS (
        SELECT 1 FROM c AS b WHERE b.lang = c.lang AND b.k > c.k AND b.f >= c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))),
cut AS (SELECT x.lang, x.phrase, x.f AS a, j, array_to_string(ws[1:j], ' ') AS lp, array_to_string(ws[j + 1:], ' ') AS rp
        FROM (SELECT *, unnest(range(1, k)) AS j FROM x) AS x),
s AS (SELECT cut.lang, cut.phrase, cut.a, j, l.f AS l, r.f AS r, t.n,
             (1000::HUGEINT * cut.a * t.n) // (l.f::HUGEINT * r.f) AS score
      FROM cut JOIN g AS l ON l.lang = cut.lang AND l.phrase = lp JOIN g AS r ON r.lang = cut.lang AND r.phrase = rp
           JOIN t ON t.lang = cut.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM b QUALIFY rank <= 2000
"""
