"""Words inside passages that stand more than once, found with compressed full-text indexes, one for each shard.

A window is ``WINDOW`` consecutive words of one document. Documents of any number cannot be streamed past every shard's
index, so shards are made by content: a window's anchor is the smallest fingerprint of ``ANCHOR_WORDS`` consecutive words in
it. Equal windows have equal anchors, and neighbouring windows mostly share theirs, so a document falls into passages: runs
of windows of one anchor, each window in exactly one passage.

1. Documents become chunks, compressed batches of whole rows. Each names its anchors; only anchors that stand twice anywhere
   go on, by a join.
2. Chunks hand over the passages of those anchors, each distinct passage once with its number of copies. Equal passages are
   counted, map side first, so a group of copies or a passage that a third of all documents share is one row.
3. Anchors are hashed to shards of bounded size. An anchor with too many different passages (a line that stands in many
   places) gives way to the windows themselves: each window is its own anchor, only those that stand twice go on.
4. Each shard indexes its passages (see ``fm_index``) and streams them past the index: matching statistics give, for each
   word, the longest sequence from there that occurs twice. Those of ``WINDOW`` words or more are repeated windows.
5. Each chunk gets its passages' repeated windows by a join, and the words that they cover are removed.

Anchors and passages travel under 64-bit fingerprints; what repeats is decided by comparing words in the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import CHUNK_BYTES, Words, word_chunks
from tidemark.llm.common import Batches, row_numbers, stored
from tidemark.llm.fm_index import DEPTH, FmIndex
from tidemark.llm.textbytes import SPACES, U64, SpanHasher, in_chunks, mix64, text_bytes

WINDOW = 35
ANCHOR_WORDS = 12
#: Windows in a passage at most, so that a set of them fits 64 bits. Longer runs of one anchor are cut.
RUN = 63
#: Words of a shard's passages, about, and of the different passages of one anchor, at most.
SHARD_WORDS = 1 << 19
ANCHOR_MOST = 1 << 17
#: Chunks are written once and shuffled twice, so a higher level than the usual one pays.
COMPRESSION = 5
_TURNS = np.random.default_rng(13).integers(1, 1 << 63, ANCHOR_WORDS, dtype=np.uint64) * U64(2) + U64(1)
_WORD = ~SPACES


def _chunks(docs: DataFrame, text: str) -> DataFrame:
    """``chunk, data``: all rows in compressed Arrow batches of about a chunk of text."""

    def cut(batches: Batches) -> Batches:
        done = 0
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=COMPRESSION))
        for batch in batches:
            _, offsets = text_bytes(batch.column(text))
            for a, b in in_chunks(offsets, CHUNK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                    out.write_batch(batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array(row_numbers(1, done)), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "data"])
                done += 1

    return stored(docs.mapInArrow(cut, "chunk bigint, data binary"), "text-chunks")


def _rows(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(data)) as stream:
        return stream.read_next_batch()


class Passages:
    """A chunk's words, joined by spaces, and the passages of its windows."""

    def __init__(self, words: Words, window: int):
        self.window, self.starts = window, words.starts
        self.joined, self.begin, self.end = words.joined()
        self.hashed = SpanHasher(self.joined)
        count = len(self.begin)
        self.windows = np.zeros(0, dtype=np.int64)  # where they begin; each row's last ``window - 1`` words begin none
        sizes = np.diff(words.starts)
        inside = np.arange(count) < np.repeat(words.starts[1:] - window + 1, sizes)
        self.windows = np.flatnonzero(inside)
        if not len(self.windows):
            self.anchors = self.first = self.many = self.places = np.zeros(0, dtype=np.int64)
            return
        anchor_words = min(ANCHOR_WORDS, window)
        fingerprints = self.hashed(self.begin, self.end)
        smallest = np.zeros(count - anchor_words + 1, dtype=np.uint64)
        for j in range(anchor_words):
            smallest += fingerprints[j : j + len(smallest)] * _TURNS[j]
        smallest = mix64(smallest)
        leftmost = rightmost = np.arange(len(smallest))
        reach, wanted = 1, window - anchor_words + 1
        while reach < wanted:  # the smallest of ``wanted`` neighbours and where it stands first and last, by doubling
            step = min(reach, wanted - reach)
            a, b = smallest[:-step], smallest[step:]
            leftmost, rightmost = np.where(b < a, leftmost[step:], leftmost[:-step]), np.where(b <= a, rightmost[step:], rightmost[:-step])
            smallest = np.minimum(a, b)
            reach += step
        anchor = smallest[self.windows].view(np.int64)
        new = np.ones(len(anchor), dtype=bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.windows[1:] != self.windows[:-1] + 1)
        run = np.flatnonzero(new)
        place = np.arange(len(anchor)) - np.repeat(run, np.diff(np.append(run, len(anchor))))
        first = np.flatnonzero(place % RUN == 0)
        self.anchors, self.many = anchor[first], np.diff(np.append(first, len(anchor)))
        self.first = self.windows[first]
        # a window may repeat inside one passage, but then its anchor stands there at two places
        self.places = 1 + (leftmost[self.first] != rightmost[self.first + self.many - 1])

    def fingerprints(self, first: np.ndarray, many: np.ndarray | int) -> np.ndarray:
        """Of the words from ``first`` on that ``many`` windows cover."""
        return self.hashed(self.begin[first], self.end[first + many + self.window - 2]).view(np.int64)

    def texts(self, first: np.ndarray, many: np.ndarray | int) -> pa.Array:
        a, b = self.begin[first], self.end[first + many + self.window - 2]
        offsets = np.zeros(len(a) + 1, dtype=np.int32)
        np.cumsum(b - a, out=offsets[1:])
        at = np.arange(int(offsets[-1])) + np.repeat(a - offsets[:-1], b - a)
        return pa.Array.from_buffers(pa.string(), len(a), [None, pa.py_buffer(offsets), pa.py_buffer(self.joined[at])])


def _passages(data: bytes, text: str, window: int) -> Iterator[Passages]:
    for words in word_chunks(_rows(data).column(text), _WORD, most=1 << 62):
        yield Passages(words, window)


def _of_chunk(batch: pa.RecordBatch, i: int, columns: dict[str, np.ndarray | pa.Array]) -> pa.RecordBatch:
    """Rows of the chunk in row ``i``."""
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    chunk = pa.array(np.full(len(arrays[0]), batch.column("chunk")[i].as_py(), dtype=np.int64))
    return pa.RecordBatch.from_arrays([chunk, *arrays], names=["chunk", *columns])


def _anchors(chunks: DataFrame, text: str, window: int) -> DataFrame:
    """``chunk, anchor, places`` of every distinct anchor of every chunk."""

    def name(batches: Batches) -> Batches:
        for batch in batches:
            for i, data in enumerate(batch.column("data").to_pylist()):
                for passages in _passages(data, text, window):
                    anchors, at = np.unique(passages.anchors, return_inverse=True)
                    places = np.bincount(at, weights=passages.places, minlength=len(anchors)).astype(np.int64)
                    yield _of_chunk(batch, i, {"anchor": anchors, "places": places})

    return stored(chunks.mapInArrow(name, "chunk bigint, anchor bigint, places bigint"), "anchors")


def _wanted_passages(chunks: DataFrame, text: str, window: int) -> DataFrame:
    """``chunk, anchor, passage, windows, words, text, copies``: each chunk's distinct passages of the anchors in ``wanted``."""

    def hand_over(batches: Batches) -> Batches:
        for batch in batches:
            for i, data in enumerate(batch.column("data").to_pylist()):
                wanted = batch.column("wanted")[i].values.to_numpy()
                for passages in _passages(data, text, window):
                    at = np.flatnonzero(np.isin(passages.anchors, wanted))
                    anchor, first, many = passages.anchors[at], passages.first[at], passages.many[at]
                    fingerprint = passages.fingerprints(first, many)
                    _, once, copies = np.unique(np.stack([anchor, fingerprint]), axis=1, return_index=True, return_counts=True)
                    first, many = first[once], many[once]
                    for a in range(0, len(once), 1 << 14):
                        part = slice(a, a + (1 << 14))
                        columns = {
                            "anchor": anchor[once][part], "passage": fingerprint[once][part], "windows": many[part],
                            "text": passages.texts(first[part], many[part]), "copies": copies[part],
                        }
                        yield _of_chunk(batch, i, columns)

    return chunks.mapInArrow(hand_over, "chunk bigint, anchor bigint, passage bigint, windows bigint, text string, copies bigint")


def _single_windows(passages: DataFrame, window: int) -> DataFrame:
    """``anchor, passage, windows, text, copies`` of the windows in passages, each its own anchor."""

    def split(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(len(batch)):
                for words in word_chunks(batch.column("text").slice(i, 1), _WORD, most=1 << 62):
                    inside = Passages(words, window)
                    at = inside.windows
                    fingerprint = inside.fingerprints(at, 1)
                    copies = np.full(len(at), batch.column("copies")[i].as_py(), dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(fingerprint), pa.array(fingerprint), pa.array(np.ones(len(at), dtype=np.int64)), inside.texts(at, 1), pa.array(copies)],
                        names=["anchor", "passage", "windows", "text", "copies"],
                    )

    found = passages.select("text", "copies").mapInArrow(split, "anchor bigint, passage bigint, windows bigint, text string, copies bigint")
    return found.groupBy("anchor", "passage", "windows", "text").agg(F.sum("copies").alias("copies")).where("copies > 1")


def _repeated(shards: DataFrame, window: int) -> DataFrame:
    """``passage, windows, repeated``: for passages with repeated windows, which of their windows these are, as bits."""

    def search(table: pa.Table) -> pa.Table:
        text = table.column("text").combine_chunks()
        (words,) = word_chunks(text, _WORD, most=1 << 62)
        numbers, _ = words.coded()
        copies = np.minimum(table.column("copies").to_numpy(), 2)
        index = FmIndex(numbers.astype(np.int64) + 1, words.starts, copies)
        long = np.flatnonzero(index.matching(2) >= window)
        row = np.searchsorted(words.starts, long, side="right") - 1
        bits = np.zeros(len(text), dtype=np.int64)
        np.bitwise_or.at(bits, row, np.int64(1) << (long - words.starts[row]))
        some = pa.array(np.flatnonzero(bits))
        found = [table.column(c).combine_chunks().take(some) for c in ("passage", "windows")]
        return pa.table([*found, pa.array(bits).take(some)], names=["passage", "windows", "repeated"])

    return shards.groupBy("shard").applyInArrow(search, "passage bigint, windows bigint, repeated bigint")


def repeated_removed(docs: DataFrame, *, text: str = "text", window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` with ``n_words, n_removed, kept``: the words that stay, joined by one space.

    A word goes if a window of ``window`` words that covers it begins at two or more places of all documents. Words are runs
    of anything but space, tab and line ends, unchanged. Columns of ``docs`` named like these three are replaced.

    NULL and empty texts have no words, and an empty ``kept``. Texts shorter than a window keep all. Repeated rows are
    copies like any others: all their windows go. No rows: no rows.
    """
    if window < 1 or RUN + window > DEPTH:
        raise ValueError(f"windows of 1 to {DEPTH - RUN} words can be told apart")
    out = ("n_words", "n_removed", "kept")
    plain = docs.select([F.col(f"`{c}`") for c in docs.columns if c not in out or c == text])
    names = [f"c{i}" for i in range(len(plain.columns))]
    place = names[plain.columns.index(text)]
    chunks = _chunks(plain.toDF(*names).withColumn(place, F.col(place).cast("string")), place)

    anchors = _anchors(chunks, place, window)
    often = anchors.groupBy("anchor").agg(F.sum("places").alias("places")).where("places > 1").select("anchor")
    wanted = anchors.select("chunk", "anchor").join(often, "anchor").groupBy("chunk").agg(F.collect_list("anchor").alias("wanted"))
    passages = stored(_wanted_passages(chunks.join(wanted, "chunk"), place, window), "passages")
    distinct = passages.groupBy("anchor", "passage", "windows", "text").agg(F.sum("copies").alias("copies"))
    distinct = stored(distinct, "distinct-passages")

    words = F.col("windows") + window - 1
    crowded = distinct.groupBy("anchor").agg(F.sum(words).alias("words")).where(F.col("words") > ANCHOR_MOST).select("anchor")
    crowded = stored(crowded, "crowded-anchors")
    few = distinct.join(crowded, "anchor", "left_anti")
    split = _single_windows(distinct.join(crowded, "anchor", "left_semi"), window)
    ready = stored(few.unionByName(split), "indexed-passages")
    shards = 1 + (ready.agg(F.sum(words)).first()[0] or 0) // SHARD_WORDS
    sharded = ready.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards))).repartition("shard")
    repeated = stored(_repeated(sharded, window), "repeated-windows")

    owners = passages.select("chunk", "passage", "windows")
    whole = owners.join(repeated, ["passage", "windows"])
    # windows of crowded anchors: looked up by the chunks that have such an anchor
    single = _owners_of_windows(passages.join(crowded, "anchor", "left_semi"), window).join(repeated.where("windows = 1"), "passage")
    found = whole.select("chunk", "passage", "windows", "repeated").unionByName(single.select("chunk", "passage", "windows", "repeated"))
    found = found.groupBy("chunk").agg(F.collect_list(F.struct("passage", "windows", "repeated")).alias("found"))

    cleaned = chunks.join(found, "chunk", "left")
    schema = plain.toDF(*names).withColumn(place, F.col(place).cast("string")).schema
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    made = cleaned.mapInArrow(_cleaning(place, window), f"{fields}, n_words bigint, n_removed bigint, kept string")
    named = [F.col(n).alias(c) for n, c in zip(names, plain.columns) if c not in out]
    return made.select(*named, *out)


def _owners_of_windows(passages: DataFrame, window: int) -> DataFrame:
    """``chunk, passage`` of each distinct window in each chunk's passages."""

    def split(batches: Batches) -> Batches:
        for batch in batches:
            for i in range(len(batch)):
                for words in word_chunks(batch.column("text").slice(i, 1), _WORD, most=1 << 62):
                    inside = Passages(words, window)
                    yield _of_chunk(batch, i, {"passage": inside.fingerprints(inside.windows, 1)})

    return passages.select("chunk", "text").mapInArrow(split, "chunk bigint, passage bigint").distinct()


def _cleaning(text: str, window: int):
    def clean(batches: Batches) -> Batches:
        for batch in batches:
            for i, data in enumerate(batch.column("data").to_pylist()):
                rows = _rows(data)
                (words,) = word_chunks(rows.column(text), _WORD, most=1 << 62)
                passages = Passages(words, window)
                gone = np.zeros(len(words.begin) + 1, dtype=np.int64)
                found = batch.column("found")[i]
                if found.is_valid and len(passages.windows):
                    known = {f: found.values.field(f).to_numpy() for f in ("passage", "windows", "repeated")}
                    at = _repeated_windows(passages, known)
                    gone[at] += 1
                    np.subtract.at(gone, at + window, 1)
                keep = np.cumsum(gone[:-1]) == 0
                sizes = passages.end - passages.begin + 1
                kept_bytes = np.concatenate([[0], np.cumsum(np.where(keep, sizes, 0))])
                joined = passages.joined[np.repeat(keep, sizes)]
                ends = kept_bytes[words.starts]
                texts = [joined[a : max(a, b - 1)].tobytes().decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                n_words = np.diff(words.starts)
                n_kept = np.diff(np.concatenate([[0], np.cumsum(keep)])[words.starts])
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(n_words), pa.array(n_words - n_kept), pa.array(texts, pa.string())],
                    names=[*rows.schema.names, "n_words", "n_removed", "kept"],
                )

    return clean


def _repeated_windows(passages: Passages, known: dict[str, np.ndarray]) -> np.ndarray:
    """Where the chunk's repeated windows begin."""
    order = np.argsort(known["passage"], kind="stable")
    known = {k: v[order] for k, v in known.items()}
    found = []
    # a passage and a single window may have one fingerprint only if they are the same words
    for first, many in ((passages.first, passages.many), (passages.windows, np.ones(len(passages.windows), dtype=np.int64))):
        own = passages.fingerprints(first, many)
        at = np.minimum(np.searchsorted(known["passage"], own), max(len(known["passage"]) - 1, 0))
        hit = np.flatnonzero((known["passage"][at] == own) & (known["windows"][at] == many)) if len(known["passage"]) else np.zeros(0, dtype=np.int64)
        bits = known["repeated"][at[hit]]
        for j in range(RUN):
            found.append(first[hit[(bits >> j) & 1 == 1]] + j)
    return np.unique(np.concatenate(found))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT id, i, array_to_string(ws[i:i + 34], ' ') AS t FROM (SELECT id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
r AS (SELECT id, i FROM w SEMI JOIN (SELECT t FROM w GROUP BY t HAVING count(*) > 1) AS m USING (t)),
g AS (SELECT DISTINCT id, i + j AS p FROM r, range(0, 35) AS o(j)),
k AS (SELECT id, list(word ORDER BY p) AS ws
      FROM (SELECT id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM d) ANTI JOIN g USING (id, p) GROUP BY id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, (len(d.ws) - coalesce(len(k.ws), 0))::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(k.ws, ' '), '')) AS kept_sha256
FROM d LEFT JOIN k USING (id)
"""
