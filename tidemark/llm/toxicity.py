"""A toxicity classifier that identity terms cannot sway.

Features are the distinct words of a text and the beginnings of its words, so that inflected and compounded forms
count with their stem. On a bounded sample of labelled documents, features whose share differs between toxic and
other documents are chosen, identity terms are added, and a logistic regression is fitted with a second penalty: for every sampled document that names a group, a counterpart with the terms of the same kind
swapped, with all features of the new words, is made, and the squared difference of the two scores is added to the loss. What the model learns from a
group's name alone is thus pushed towards what it learns from any other group's, so that neutral mentions gain no
score, while words that insult keep theirs.

The model is a few thousand weights. Scoring is one pass over the texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Batches, stored
from tidemark.llm.shingles import chunked_words, word_hashes
from tidemark.llm.textbytes import U64, mix64

#: Labelled documents that the model is fitted on at most, the lowest by a hash of their ids.
TRAIN_ROWS = 12_000
MOST_FEATURES = 4096
LEAST_DOCUMENTS = 3
LEAST_DEVIATIONS = 4.5
#: Bytes of a word's beginnings that are features beside the word.
BEGINNINGS = (3, 4, 5, 6, 7, 8, 9)
RIDGE = 3e-4
FAIRNESS = 1.0
STEPS = 400

#: Terms for groups of people, by kind. A term's counterpart is the next of its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("female", "male"),
    ("girls", "boys"),
    ("girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("old", "young"),
    ("disabled", "blind", "deaf"),
    ("immigrants", "refugees", "foreigners", "natives"),
)


def held_out(doc: str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. NULL ids are not held out."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _hash_words(words: list[str]) -> np.ndarray:
    (found,) = [h for _, h, _ in word_hashes(pa.array([" ".join(words)]))]
    return found


def _features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of rows: each word's place among the chunk's distinct words, each row's first word, and the features
    of the distinct words as pairs of place and fingerprint in the places' order."""
    for _, hashed, begin, end, starts in chunked_words(column):
        words, at, place = np.unique(hashed(begin, end), return_index=True, return_inverse=True)
        begin, end = begin[at], end[at]
        owners, found = [np.arange(len(words))], [words]
        for size in BEGINNINGS:
            longer = np.flatnonzero(end - begin > size)
            owners.append(longer)
            found.append(mix64(hashed(begin[longer], begin[longer] + size) ^ U64(0xA5A5A5A5A5A5A5A5)))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        yield place, starts, owner[order], np.concatenate(found)[order]


def _spread(owner: np.ndarray, places: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """For ``places``, each with a run in the ascending ``owner``: which of them, and where in the run, item by item."""
    edges = np.searchsorted(owner, np.arange(count + 1))
    sizes = (edges[1:] - edges[:-1])[places]
    which = np.repeat(np.arange(len(places)), sizes)
    return which, np.repeat(edges[places] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def distinct_features(column: pa.Array) -> Iterator[np.ndarray]:
    """Each row's distinct features as ascending fingerprints."""
    for place, starts, owner, found in _features(column):
        count = int(owner[-1]) + 1 if len(owner) else 0
        for i in range(len(starts) - 1):
            _, at = _spread(owner, np.unique(place[starts[i] : starts[i + 1]]), count)
            yield np.unique(found[at])


def swapped_features(column: pa.Array) -> Iterator[np.ndarray]:
    """The distinct features of each row's counterpart, whose identity terms are swapped with all their beginnings, as
    ascending fingerprints; none for rows that name no group."""
    swaps = _term_features()
    terms = np.array(sorted(swaps), dtype=np.uint64)
    for place, starts, owner, found in _features(column):
        count = int(owner[-1]) + 1 if len(owner) else 0
        words = found[np.searchsorted(owner, np.arange(count))]  # a word's first feature is the word
        is_term = np.isin(words, terms)
        for i in range(len(starts) - 1):
            own = np.unique(place[starts[i] : starts[i + 1]])
            named = own[is_term[own]]
            if not len(named):
                yield np.zeros(0, dtype=np.uint64)
                continue
            _, at = _spread(owner, own[~is_term[own]], count)
            yield np.unique(np.concatenate([found[at], *[swaps[int(h)][1] for h in words[named]]]))


@dataclass(frozen=True)
class Model:
    """Fingerprints of features in ascending order with their weights, and what an empty text scores."""

    words: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        parts = []
        for place, starts, owner, found in _features(column):
            rows, sums = len(starts) - 1, np.zeros(len(starts) - 1)
            if len(self.words) and len(place):
                at = np.minimum(np.searchsorted(self.words, found), len(self.words) - 1)
                known = np.flatnonzero(self.words[at] == found)
                which, item = _spread(owner[known], place, int(owner[-1]) + 1)
                row = np.searchsorted(starts, which, side="right") - 1
                pairs = np.unique(row * np.int64(len(self.words)) + at[known][item])
                sums = np.bincount(pairs // len(self.words), self.weights[pairs % len(self.words)], minlength=rows)
            parts.append(1 / (1 + np.exp(-np.clip(self.bias + sums, -30, 30))))
        return np.concatenate(parts) if parts else np.zeros(0)


def _term_features() -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each identity term's fingerprint the features of the term and those of its counterpart."""
    swapped = {}
    for kind in IDENTITY_TERMS:
        features = list(distinct_features(pa.array(kind)))
        swapped |= dict(zip(_hash_words(list(kind)).tolist(), zip(features, features[1:] + features[:1])))
    return swapped


def _swapped_row(row: np.ndarray, swaps: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """A counterpart from features alone: beginnings that other words share with a term go with the term."""
    named = [swaps[h] for h in row.tolist() if h in swaps]
    if not named:
        return row[:0]
    return np.unique(np.concatenate([np.setdiff1d(row, np.concatenate([gone for gone, _ in named])), *[come for _, come in named]]))


def fit(
    rows: list[np.ndarray], labels: np.ndarray, chosen: np.ndarray, fairness: float = FAIRNESS, swapped: list[np.ndarray] | None = None
) -> Model:
    """The model on ``chosen`` features and identity terms, of documents given as distinct features' fingerprints.

    ``swapped`` has the features of each document's counterpart, see ``swapped_features``; without it they are made from
    the features.

    Without both labels it scores their share.
    """
    labels = np.asarray(labels, dtype=np.float64)
    if not len(labels) or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1)
        return Model(np.zeros(0, dtype=np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    swaps = _term_features()
    terms = np.array(sorted(swaps), dtype=np.uint64)
    words = np.unique(np.concatenate([chosen, terms]))

    def places(row: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(words, row), len(words) - 1)
        return at[words[at] == row]

    def matrix(of: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        found = [places(r) for r in of]
        return np.repeat(np.arange(len(of)), [len(f) for f in found]), np.concatenate([*found, np.zeros(0, dtype=np.int64)]).astype(np.int64)

    named = [i for i, r in enumerate(rows) if np.isin(r, terms, assume_unique=True).any()]
    others = [_swapped_row(rows[i], swaps) if swapped is None else swapped[i] for i in named]
    row, at = matrix(rows)
    row0, at0 = matrix([rows[i] for i in named])
    row1, at1 = matrix(others)
    n, m = len(rows), max(len(named), 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    weights, bias = np.zeros(len(words)), float(np.log(labels.mean() / (1 - labels.mean())))
    mean, square, rate = np.zeros(len(words) + 1), np.zeros(len(words) + 1), 0.1
    for step in range(1, STEPS + 1):
        p = sigmoid(bias + np.bincount(row, weights[at], minlength=n))
        gradient = np.bincount(at, (p - labels)[row], minlength=len(words)) / n + RIDGE * weights
        if named:
            p0 = sigmoid(bias + np.bincount(row0, weights[at0], minlength=m))
            p1 = sigmoid(bias + np.bincount(row1, weights[at1], minlength=m))
            d0, d1 = 2 * (p0 - p1) * p0 * (1 - p0), -2 * (p0 - p1) * p1 * (1 - p1)
            pull = np.bincount(at0, d0[row0], minlength=len(words)) + np.bincount(at1, d1[row1], minlength=len(words))
            gradient += fairness * pull / m
        whole = np.append(gradient, (p - labels).mean())
        mean, square = 0.9 * mean + 0.1 * whole, 0.999 * square + 0.001 * whole**2
        move = rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(words, weights, float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    train_rows: int = TRAIN_ROWS,
    fairness: float = FAIRNESS,
) -> Model:
    """A model fitted on at most ``train_rows`` labelled documents that are not held out.

    Labels other than 0 and 1, NULL ids and labels of unknown documents are passed over; a document labelled twice
    counts twice. Features are counted in Spark; the driver gets the ``MOST_FEATURES`` chosen ones, and of each
    sampled document those and the identity terms.
    """
    known = labels.select(F.col(doc).alias("_id"), F.col(label).cast("int").alias("_label")).where("_id IS NOT NULL AND _label IN (0, 1)")
    picked = known.where(~held_out("_id")).orderBy(F.xxhash64("_id"), "_id", "_label").limit(train_rows)
    joined = docs.select(F.col(doc).alias("_doc"), F.col(text).alias("_text")).join(F.broadcast(picked), F.col("_doc") == F.col("_id"))

    def features(batches: Batches) -> Batches:
        for batch in batches:
            both = [
                pa.array([r.view(np.int64) for r in of(batch.column("_text"))], pa.list_(pa.int64())) for of in (distinct_features, swapped_features)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("_label"), *both], names=["label", "features", "swapped"])

    sample = stored(joined.select("_text", "_label").mapInArrow(features, "label int, features array<bigint>, swapped array<bigint>").limit(train_rows), "toxic-sample")
    n, bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < bad < n:
        return fit([], np.array([1] * bad + [0] * (n - bad)), np.zeros(0, dtype=np.uint64), fairness)
    counts = sample.select("label", F.explode("features").alias("feature")).groupBy("feature")
    counts = counts.agg(F.count(F.lit(1)).alias("all"), F.sum("label").alias("bad")).where(F.col("all") >= LEAST_DOCUMENTS)
    share = F.col("all") / n
    spread = F.sqrt(share * (1 - share) * (1 / bad + 1 / (n - bad))) + 1e-12
    deviations = F.abs(F.col("bad") / bad - (F.col("all") - F.col("bad")) / (n - bad)) / spread
    telling = counts.withColumn("deviations", deviations).where(F.col("deviations") >= LEAST_DEVIATIONS)
    best = telling.orderBy(F.desc("deviations"), "feature").limit(MOST_FEATURES).select("feature").collect()
    chosen = np.array(sorted(r["feature"] for r in best), dtype=np.int64)
    wanted = np.unique(np.concatenate([chosen.view(np.uint64), np.array(sorted(_term_features()), dtype=np.uint64)]))

    def narrow(batches: Batches) -> Batches:
        for batch in batches:
            lists = [
                pa.array([np.intersect1d(np.array(r, dtype=np.int64).view(np.uint64), wanted).tobytes() for r in batch.column(c).to_pylist()], pa.binary())
                for c in ("features", "swapped")
            ]
            yield pa.RecordBatch.from_arrays([batch.column("label"), *lists], names=["label", "features", "swapped"])

    found = sample.mapInArrow(narrow, "label int, features binary, swapped binary").collect()
    found.sort(key=lambda r: (r["label"], bytes(r["features"]), bytes(r["swapped"])))
    rows, swapped = ([np.frombuffer(bytes(r[c]), dtype=np.uint64) for r in found] for c in ("features", "swapped"))
    return fit(rows, np.array([r["label"] for r in found]), chosen.view(np.uint64), fairness, swapped)


def score(docs: DataFrame, model: Model, *, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    NULL and empty texts get what a text without known words gets. Rows that repeat get equal scores. No rows: no rows.
    """
    picked = docs.select(F.col(doc).alias("doc_id"), held_out(doc).alias("held_out"), F.col(text).alias("text"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = pa.array(model.scores(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), found], names=["doc_id", "held_out", "score"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    scored = picked.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_civil(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below 0.5, with their columns."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(text)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
