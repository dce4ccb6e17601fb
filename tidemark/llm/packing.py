"""Mixture-controlled packing by deficit round-robin.

Every source is a queue of documents. Each window gives each queue its share of the window's tokens plus the
fraction of a token that it was owed before, so that after any number of windows no queue is further than one
token from its target and every window but the last is full. Because the deficits have a closed form, any task
can find the windows of any document: with the running shares of the queues in a fixed order, the tokens that
the first ``l`` queues have sent into the first ``w`` windows are the whole part of their share of ``w`` windows.
Deficits thus carry over windows and over Spark partitions without a sequential pass.

Shares to the token cut documents into as many pieces as there are queues in a window. With a ``quantum``, queues send
turns of up to so many tokens instead, in the order of the moments at which the middles of the turns were due; what a
queue is ahead or behind, at most half a turn for each queue, is its deficit and carries over windows. The place of any
turn in the stream again has a closed form: the turns of each other queue that were due before it.

Queues whose share is below one token a window are served as one queue, their documents in id order; so there
are never more queues than tokens in a window, and only that many totals reach the driver.
"""

from __future__ import annotations

import bisect
import zlib
from dataclasses import dataclass
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, row_numbers, running_totals, stored
from tidemark.llm.textbytes import in_chunks, text_bytes
from tidemark.llm.tokens import piece_tokenizer

WINDOW = 2048
TASK_BYTES = 8 << 20
#: Tokens of a turn in production: eight turns to a window.
TURN = 256


@dataclass(frozen=True)
class Schedule:
    """Who is served when: for each phase its first token, and the running totals and rates of the queues in it.

    A phase ends when a queue runs dry; the others then share its part in proportion to their weights.
    """

    window: int
    total: int
    starts: tuple[Fraction, ...]
    served: tuple[tuple[Fraction, ...], ...]
    rates: tuple[tuple[Fraction, ...], ...]

    def sent(self, lane: int, tokens: int) -> int:
        """Tokens that queues 0..lane-1 have sent among the first ``tokens`` of the stream."""
        tokens = min(tokens, self.total)
        phase = bisect.bisect_right(self.starts, tokens) - 1
        rate, base = self.rates[phase][lane], self.served[phase][lane]
        if len(self.starts) == 1:
            return rate.numerator * tokens // rate.denominator
        return floor(base + rate * (tokens - self.starts[phase]))

    def window_of(self, lane: int, place: int) -> int:
        """The window that token ``place`` of a queue falls in."""
        own = lambda w: self.sent(lane + 1, w * self.window) - self.sent(lane, w * self.window)
        low, high = 0, -(-self.total // self.window)
        if len(self.starts) == 1:
            rate = self.rates[0][lane + 1] - self.rates[0][lane]
            guess = place * rate.denominator // (rate.numerator * self.window)
            low, high = max(0, guess - 3), min(high, guess + 4)
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if own(middle) <= place else (low, middle)
        return low

    def pieces(self, lane: int, place: int, size: int) -> list[tuple[int, int, int, int]]:
        """``(start, length, window, offset)`` of the pieces of a document at ``place`` of its queue."""
        found, start, w = [], 0, self.window_of(lane, place)
        a0, b0 = self.sent(lane, w * self.window), self.sent(lane + 1, w * self.window)
        while start < size:
            a1, b1 = self.sent(lane, (w + 1) * self.window), self.sent(lane + 1, (w + 1) * self.window)
            take = min(size - start, b1 - a1 - place - start)
            if take > 0:
                found.append((start, take, w, a1 - a0 + place + start - (b0 - a0)))
                start += take
            w, a0, b0 = w + 1, a1, b1
        return found

    def all_pieces(self, lanes: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """The pieces of many documents, see ``pieces``."""
        return [self.pieces(*x) for x in zip(lanes.tolist(), places.tolist(), sizes.tolist())]


@dataclass(frozen=True)
class Turns:
    """Queues of these token counts served in turns of ``quantum`` tokens, in proportion to the counts."""

    window: int
    quantum: int
    sizes: tuple[int, ...]

    def begins(self, lane: int, turns: np.ndarray) -> np.ndarray:
        """The places in the stream at which turns of a queue begin: its own turns before and all that others were due.

        Moments are compared as integers, twice the middle of a turn times the other queue's count; ties go to the
        first queue. Counts too large for 64 bits are Python's integers.
        """
        q, size, most = self.quantum, self.sizes[lane], max(self.sizes)
        turns = turns.astype(np.int64 if 8 * most * max(most, q) < 1 << 63 else object)
        middle, place = np.minimum((turns + 1) * q, size) + turns * q, turns * q
        for other, n in enumerate(self.sizes):
            if other == lane or not n:
                continue
            due, first = middle * n, other < lane
            whole = (due - q * size) // (2 * q * size) + 1 if first else -((q * size - due) // (2 * q * size))
            place = place + np.clip(whole, 0, n // q) * q
            if n % q:
                late = (n - n % q + n) * size
                place = place + ((late <= due) if first else (late < due)) * (n % q)
        return place.astype(np.int64)

    def all_pieces(self, lanes: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
        """For documents at ``places`` of their queues the ``(start, length, window, offset)`` of their pieces."""
        first = places // self.quantum
        counts = (places + sizes - 1) // self.quantum - first + 1
        owner = np.repeat(np.arange(len(lanes)), counts)
        turn = first[owner] + np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
        begin = np.zeros(len(owner), dtype=np.int64)
        for lane in np.unique(lanes):
            own = np.flatnonzero(lanes[owner] == lane)
            known, back = np.unique(turn[own], return_inverse=True)
            begin[own] = self.begins(int(lane), known)[back]
        low = np.maximum(turn * self.quantum, places[owner])
        high = np.minimum((turn + 1) * self.quantum, (places + sizes)[owner])
        found: list[list[tuple[int, int, int, int]]] = [[] for _ in range(len(lanes))]
        starts, at = low - places[owner], begin + low - turn * self.quantum
        for i, start, place, rest in zip(owner.tolist(), starts.tolist(), at.tolist(), (high - low).tolist()):
            pieces = found[i]
            while rest:
                window, offset = divmod(place, self.window)
                take = min(rest, self.window - offset)
                if pieces and pieces[-1][2] == window and pieces[-1][3] + pieces[-1][1] == offset:
                    pieces[-1] = (pieces[-1][0], pieces[-1][1] + take, window, pieces[-1][3])
                else:
                    pieces.append((start, take, window, offset))
                start, place, rest = start + take, place + take, rest - take
        return found


def schedule(sizes: list[int], weights: list[Fraction] | None, window: int) -> Schedule:
    """The schedule of queues with these token counts. ``weights`` None: in proportion to the counts."""
    total = sum(sizes)
    wanted = [Fraction(n) for n in sizes] if weights is None else [Fraction(w) for w in weights]
    rest = [Fraction(n) for n in sizes]
    now, starts, served, rates = Fraction(0), [], [], []
    while now < total:
        live = [i for i, r in enumerate(rest) if r > 0]
        if not any(wanted[i] > 0 for i in live):
            wanted = [r if r > 0 else Fraction(0) for r in rest]
        whole = sum(wanted[i] for i in live)
        rate = [wanted[i] / whole if rest[i] > 0 else Fraction(0) for i in range(len(sizes))]
        step = min(rest[i] / rate[i] for i in live if rate[i] > 0)
        running = lambda values: tuple(sum(values[:k], Fraction(0)) for k in range(len(values) + 1))
        starts.append(now)
        served.append(running([Fraction(n) - r for n, r in zip(sizes, rest)]))
        rates.append(running(rate))
        rest = [r - q * step for r, q in zip(rest, rate)]
        now += step
    if not starts:
        starts, served, rates = [Fraction(0)], [(Fraction(0),) * (len(sizes) + 1)], [(Fraction(0),) * (len(sizes) + 1)]
    return Schedule(window, total, tuple(starts), tuple(served), tuple(rates))


def _encoded(tokenizer: str, end_id: int, special: bool):
    fields = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("source", pa.string()), ("n", pa.int64()), ("ids", pa.binary())])

    def run(batches: Batches) -> Batches:
        encode, done = piece_tokenizer(tokenizer, special), 0
        for batch in batches:
            _, offsets = text_bytes(batch.column("text"))
            for a, b in in_chunks(offsets, TASK_BYTES):
                part = batch.slice(a, b - a)
                ids, starts = encode.ids(part.column("text"), end_id)
                raw = ids.astype("<u4")
                packed = pa.Array.from_buffers(
                    pa.binary(), b - a, [None, pa.py_buffer((starts * 4).astype(np.int32)), pa.py_buffer(raw)]
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row_numbers(b - a, done)), part.column("doc"), part.column("source"), pa.array(np.diff(starts)), packed],
                    schema=fields,
                )
                done += b - a

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
    window: int = WINDOW,
    end_id: int = 1,
    targets: dict[str | None, float] | None = None,
    special: bool = False,
    quantum: int = 1,
) -> DataFrame:
    """Every document's ids and ``end_id`` dealt into windows of ``window`` tokens that follow the target mixture.

    ``targets`` names the wanted token share of sources; None keeps the corpus mixture in every window. A source
    that runs dry leaves its share to the others; sources without a target follow once those with one are empty.
    ``quantum`` above 1 deals the corpus mixture in turns of so many tokens, which cuts documents into fewer pieces.
    Returns a row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source, ids``
    with ``ids`` the piece's ids as little-endian unsigned 32-bit integers. ``special`` gives special marks inside texts
    their own ids, as the tokenizer does when loaded.

    NULL and empty texts are the end id alone. A NULL source is a queue of its own; NULL and repeated ids are
    separate documents, ordered by id (NULL first) and then by how they were read. No documents: no rows.
    """
    if quantum < 1 or (quantum > 1 and targets is not None):
        raise ValueError("turns have a token at least, and just one where targets are given")
    picked = docs.select(F.col(doc).cast("bigint").alias("doc"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    encoded = picked.mapInArrow(_encoded(tokenizer, end_id, special), "row bigint, doc bigint, source string, n bigint, ids binary")
    encoded = stored(encoded, "pack-ids")

    sums = encoded.groupBy("source").agg(F.sum("n").alias("n"))
    if targets is None:
        total = sums.agg(F.sum("n")).first()[0] or 0
        large = sums.where(F.col("n") * window >= F.lit(total))  # at most ``window`` rows
        lanes = sorted(((r["source"], r["n"]) for r in large.collect()), key=lambda x: (x[0] is None, x[0] or ""))
        weights = None
    else:
        if len(targets) > window or min(targets.values()) * window < sum(targets.values()):
            raise ValueError("every target must come to a token in a window at least")
        named = F.col("source").isin([t for t in targets if t is not None]) | (F.col("source").isNull() & F.lit(None in targets))
        kept = {r["source"]: r["n"] for r in sums.where(F.coalesce(named, F.lit(False))).collect()}
        total = sums.agg(F.sum("n")).first()[0] or 0
        lanes = [(t, kept[t]) for t in targets if t in kept]
        weights = [Fraction(0), *(Fraction(targets[t]) for t, _ in lanes)]
    sizes = [total - sum(n for _, n in lanes), *(n for _, n in lanes)]
    plan = schedule(sizes, weights, window) if quantum == 1 else Turns(window, quantum, tuple(sizes))

    spark = docs.sparkSession
    lane_of = spark.createDataFrame([(t, i + 1) for i, (t, _) in enumerate(lanes)], "name string, lane int")
    placed = (
        encoded.select("row", "doc", "source", "n")
        .join(F.broadcast(lane_of), F.col("source").eqNullSafe(F.col("name")), "left")
        .select("row", "doc", "n", F.coalesce("lane", F.lit(0)).alias("lane"))
    )
    placed = running_totals(placed, "lane", [F.col("doc").asc_nulls_first(), F.col("row")], "n", "place")
    joined = encoded.join(placed.select(F.col("row").alias("at"), "lane", "place"), F.col("row") == F.col("at"))

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            lanes, places, sizes = (batch.column(k).to_numpy().astype(np.int64) for k in ("lane", "place", "n"))
            pieces = plan.all_pieces(lanes, places, sizes)
            _, offsets, data = batch.column("ids").cast(pa.large_binary()).buffers()
            first = np.frombuffer(offsets, dtype=np.int64)[batch.column("ids").offset :]
            raw = memoryview(data) if data is not None else memoryview(b"")
            of, start, length, crc, sequence, offset, ids = [], [], [], [], [], [], []
            for i, found in enumerate(pieces):
                at = int(first[i])
                for s, size, w, o in found:
                    piece = raw[at + 4 * s : at + 4 * (s + size)]
                    of.append(i)
                    start.append(s)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    sequence.append(w)
                    offset.append(o)
                    ids.append(piece.tobytes())
            rows = pa.array(of, pa.int64())
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc)]
            more = [pa.array(x, pa.int64()) for x in (sequence, offset)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(rows), *longs, batch.column("n").take(rows), *more, batch.column("source").take(rows), pa.array(ids, pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"],
            )

    return joined.mapInArrow(
        cut,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, source string, ids binary",
    )
