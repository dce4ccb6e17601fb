"""Tokens, packing, sequence files, near-duplicates and toxicity against plain versions of the same thing."""

from __future__ import annotations

import itertools
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import arrow_files, near_dedup, packing, shingles, tokens, toxicity
from tidemark.llm.components import connected_components

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "\n\n", "a", " a  b", "a\n b \nc", "don't we've 12 345", "a,b. c!d? e;f:g", "<|endoftext|> x a|>b <|x",
    "é. à,b ü", "a b   c　d", "x \x1c y \x85 z", "\tt\r\nu\x0bv", "漢字 かな", "🙂 🙂", "the " * 3000, "İstanbul ΣΑΣ",
]
DOCS = "doc_id bigint, text string, source string, ids string, row int"


def crc(ids) -> int:
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def encode(path: str, text: str | None, end: int) -> list[int]:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def odd_documents(spark):
    rows = [(i if i % 5 else None, t, f"s{i % 3}" if i % 4 else None, "x", i) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows + rows[3:6], DOCS)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_pieces_give_the_tokenizers_ids(path, spark, sf_dir):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(150).collect()]
    rng = random.Random(3)
    texts += ["".join(rng.choice(["a", "B", " ", "\n", ".", ",", "'", "é", "1", "|", "<", " "]) for _ in range(60)) for _ in range(300)]
    ids, starts = tokens.piece_tokenizer(path).ids(pa.array(texts), 7)
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == encode(path, text, 7), repr(text)


def test_sequence_files_hold_every_document_in_id_order(spark, tmp_path):
    docs = odd_documents(spark)
    manifest = arrow_files.write_sequences(docs, BYTE, str(tmp_path / "seq"), length=64)
    rows = sorted(arrow_files.read_documents(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((r.doc_id for r in docs.collect()), key=lambda x: (x is not None, x or 0))
    place = 0
    for r in rows:
        assert r.start == place
        place += r.n_tokens
    wanted = Counter((r.doc_id, crc(encode(BYTE, r.text, 2))) for r in docs.collect())
    assert Counter((r.doc_id, r.ids_crc32) for r in rows) == wanted
    files = manifest.orderBy("part").collect()
    assert files[0].first_token == 0 and sum(f.tokens for f in files) == place
    file = arrow_files.SequenceFile(files[0].path)
    ids, mask = file[0]
    assert len(file) == files[0].sequences and len(ids) == len(mask) == 64 and not ids.flags.owndata


def test_sequence_files_of_nothing(spark, tmp_path):
    manifest = arrow_files.write_sequences(odd_documents(spark).limit(0), BYTE, str(tmp_path / "none"))
    assert arrow_files.read_documents(manifest).count() == 0


def check_pieces(rows, docs, window):
    queue, by = defaultdict(list), defaultdict(list)
    for r in rows:
        by[r.doc_id, r.doc_tokens].append(r)
        queue[r.sequence_id].append((r.offset, r.length))
    total = sum(len(encode(WORD, d.text, 1)) for d in docs)
    assert sum(r.length for r in rows) == total
    for w, pieces in queue.items():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends and length > 0
            ends += length
        assert ends == window or w == max(queue)
    assert len(queue) == -(-total // window)


def test_packing_covers_odd_documents(spark):
    docs = odd_documents(spark)
    rows = packing.pack(docs, WORD, window=32).collect()
    check_pieces(rows, docs.collect(), 32)
    assert all(zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    assert packing.pack(docs.limit(0), WORD).count() == 0


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1}])
def test_packing_keeps_every_window_on_target(spark, targets):
    rng = random.Random(1)
    rows = [(i, "word " * rng.randint(1, 400), rng.choice("aaab"), "", i) for i in range(300)]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.pack(docs, WORD, window=256, targets=targets).collect()
    check_pieces(pieces, docs.collect(), 256)
    sizes = Counter()
    for p in pieces:
        sizes[p.source] += p.length
    share = sizes["a"] / sum(sizes.values()) if targets is None else 0.75
    dry = min(sizes["a"] / share, sizes["b"] / (1 - share)) // 256 if targets else max(p.sequence_id for p in pieces)
    sent = Counter()
    for w, group in itertools.groupby(sorted(pieces, key=lambda p: p.sequence_id), key=lambda p: p.sequence_id):
        sent.update({"a": sum(p.length for p in group if p.source == "a")})
        if w < dry:
            assert abs(sent["a"] - share * 256 * (w + 1)) <= 1


@pytest.mark.parametrize("sizes", [[0, 1000, 333, 334, 7], [0, 64, 64], [5, 1, 1, 1], [10**7 + 3, 4 * 10**7, 17], [0, 2**33 + 5, 3 * 2**32]])
def test_turns_stand_where_a_plain_queue_puts_them(sizes):
    """Against all turns sorted by the moments, as fractions, at which their middles are due."""
    quantum = max(16, sum(sizes) // 500)
    turns = []
    for lane, n in enumerate(sizes):
        for j in range(-(-n // quantum)):
            length = min(quantum, n - j * quantum)
            turns.append((Fraction(2 * j * quantum + length, 2 * n), lane, j, length))
    plan, place = packing.Turns(64, quantum, tuple(sizes)), 0
    sent, total = Counter(), sum(sizes)
    for _, lane, j, length in sorted(turns):
        assert plan.begins(lane, np.array([j])).tolist() == [place]
        place, sent[lane] = place + length, sent[lane] + length
        for other, n in enumerate(sizes):
            assert abs(sent[other] - Fraction(n, total) * place) <= quantum * (1 + len(sizes)) / 2
    assert place == total


def test_packing_in_turns_keeps_all_tokens_in_fewer_pieces(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choices(["one", "zwei", "trois,", "#4"], k=rng.randint(0, 300))), rng.choice("aaaaabcdefghijklmnop"), "", i) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS)
    pieces = packing.pack(docs, WORD, window=256, quantum=64).collect()
    check_pieces(pieces, docs.collect(), 256)
    assert 3 * len(pieces) < 2 * packing.pack(docs, WORD, window=256).count()
    tokenizer, ids = Tokenizer.from_file(WORD), {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        ids.setdefault(p.doc_id, []).extend(struct.unpack(f"<{p.length}I", bytes(p.ids)))
    for i, text, *_ in rows:
        assert ids[i] == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    odd = odd_documents(spark)
    check_pieces(packing.pack(odd, WORD, window=32, quantum=8).collect(), odd.collect(), 32)
    assert packing.pack(odd.limit(0), WORD, quantum=8).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, WORD, targets={"a": 1}, quantum=8)


def test_schedule_pools_what_is_below_a_token():
    plan = packing.schedule([5, 4000, 3000], None, 256)
    assert plan.total == 7005 and plan.sent(3, 10**9) == 7005
    assert packing.schedule([], None, 8).total == 0
    late = packing.schedule([0, 100, 900], [Fraction(0), Fraction(1), Fraction(1)], 10)
    assert late.sent(2, 200) == 100 and late.sent(2, 600) == 100 and late.sent(3, 600) == 600


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def shingle_set(text):
    w = words_of(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups_by_force(rows):
    """Smallest id of each row's group, from all pairs."""
    sets = [shingle_set(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and common / (len(sets[i]) + len(sets[j]) - common) >= 0.8:
            root[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [least.get(find(i)) if sets[i] else rows[i][0] for i in range(len(rows))]


def near_copies(rng):
    vocabulary = [f"{a}{b}" for a in "kstnmr" for b in ("alo", "ine", "ust", "ora", "eth")]
    rows = []
    for base in range(12):
        text = [rng.choice(vocabulary) + str(rng.randint(0, 40)) for _ in range(rng.choice([8, 40, 120]))]
        rows.append(" ".join(text))
        for _ in range(rng.randint(0, 9)):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 30))):
                copy[rng.randrange(len(copy))] = "changed" + str(rng.randint(0, 99))
            rows.append(" ".join(copy))
    rows += [rows[0], rows[0].upper(), rows[0].replace(" ", ",  "), None, "", " \n", "one two", "One, two", "same line\n" * 50, "same line\n" * 60]
    rng.shuffle(rows)
    return [(i if i % 11 else None, t, "s", "x", i) for i, t in enumerate(rows)]


def assert_one_of_each_group(rows, kept_rows):
    """Groups are told apart by their rows: two groups without any id are two groups."""
    sets = [shingle_set(r[1]) for r in rows]
    groups = [{i} for i in range(len(rows))]
    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and common / (len(sets[i]) + len(sets[j]) - common) >= 0.8 and groups[i] is not groups[j]:
            groups[i] |= groups[j]
            for k in groups[j]:
                groups[k] = groups[i]
    groups = {min(g): g for g in groups if sets[min(g)]}.values()
    kept = {r.row for r in kept_rows if sets[r.row]}
    assert len(kept) == len(groups)
    for group in groups:
        (one,) = kept & group
        assert rows[one][0] == min((rows[i][0] for i in group if rows[i][0] is not None), default=None)


def test_near_duplicates_are_the_groups_of_all_pairs(spark):
    rows = near_copies(random.Random(11))
    docs = spark.createDataFrame(rows, DOCS)
    expected = Counter((r[0], g) for r, g in zip(rows, groups_by_force(rows)))
    found = near_dedup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.cluster_id) for r in found) == expected
    kept = near_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert_one_of_each_group(rows, kept.collect())
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_crowded_buckets_are_compared_in_tiles(spark, monkeypatch):
    """Many rows share bands with rows of other components: every tile of such a bucket finds its pairs."""
    monkeypatch.setattr(near_dedup, "TILE_ROWS", 2)
    rng = random.Random(23)
    common = [f"w{i}" for i in range(60)]
    texts = []
    for k in range(12):  # chains: each next text is at 0.8 or more from the one before, the ends are not
        words = list(common)
        for step in range(6):
            words[(9 * k + 5 * step) % 60] = f"x{k}_{step}"
            texts.append(" ".join(words))
    rng.shuffle(texts)
    rows = [(i + 1, t, "s", "x", i) for i, t in enumerate(texts)]
    expected = dict(zip([r[0] for r in rows], groups_by_force(rows)))
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS))
    assert {r.doc_id: r.cluster_id for r in found.collect()} == expected


def test_near_duplicates_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 400")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = dict(zip([r[0] for r in rows], groups_by_force(rows)))
    assert {r.doc_id: r.cluster_id for r in near_dedup.near_duplicates(docs).collect()} == expected


@pytest.mark.parametrize("weighted", [False, True])
def test_darts_estimate_weighted_similarity(weighted):
    rng = np.random.default_rng(4)
    items = rng.integers(1, 1 << 62, 500, dtype=np.uint64)
    a, b = items[:400], items[100:]
    wa, wb = (rng.uniform(0.2, 6, 400), rng.uniform(0.2, 6, 400)) if weighted else (np.ones(400), np.ones(400))
    of_a, of_b = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
    both = set(of_a) | set(of_b)
    exact = sum(min(of_a.get(x, 0), of_b.get(x, 0)) for x in both) / sum(max(of_a.get(x, 0), of_b.get(x, 0)) for x in both)
    agree = (near_dedup.dart_minhash(a, wa, 2048) == near_dedup.dart_minhash(b, wb, 2048)).mean()
    assert abs(agree - exact) < 0.05


def test_shingles_cut_words_at_marks_and_rows():
    found = dict(shingles.shingle_sets(pa.array(["A b, c-d e f", "a B c d e f!", None, "a b", "ab"])))
    assert found[0].tolist() == found[1].tolist() and len(found[0]) == 2
    assert len(found[2]) == 0 and len(found[3]) == 1 and found[3].tolist() != found[4].tolist()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (101, 100)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_toxicity_on_held_out_documents(spark, sf_dir):
    big = sf_dir.replace("sf0.01", "sf0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    clean, bad = [r for r in scored if r.toxic == 0], [r for r in scored if r.toxic == 1]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in bad) >= 0.8 * len(bad)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in scored)


def test_toxicity_ignores_who_is_named():
    rng = random.Random(2)
    filler = ["walk", "river", "stone", "light", "paper", "garden", "music", "train"]

    def text(*more):
        return " ".join(rng.choices(filler, k=12) + list(more))

    texts = [text("women", "awful") for _ in range(60)] + [text("awful") for _ in range(60)] + [text("men") for _ in range(60)] + [text() for _ in range(200)]
    labels = np.array([1] * 120 + [0] * 260)
    rows = list(toxicity.distinct_features(pa.array(texts)))
    chosen = np.unique(np.concatenate(rows))
    neutral = pa.array([" ".join(filler) + " women", " ".join(filler) + " men"])
    gaps = []
    for fairness in (0.0, 30.0):
        women, men = toxicity.fit(rows, labels, chosen, fairness).scores(neutral)
        gaps.append(abs(women - men))
    assert gaps[1] < 0.5 * gaps[0]
    model = toxicity.fit(rows, labels, chosen)
    assert model.scores(pa.array(["awful river stone"]))[0] > 0.5 > model.scores(pa.array(["river stone"]))[0]


def test_toxicity_of_odd_rows(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, 7), (4, None)], "doc_id bigint, toxic int")
    for given in (labels, labels.limit(0)):
        scored = toxicity.score(docs, toxicity.train(docs, given)).collect()
        assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    kept = toxicity.keep_civil(docs, toxicity.train(docs, labels))
    assert kept.columns == docs.columns and kept.where(F.col("ids") != "x").count() == 0


@pytest.mark.parametrize("seed", [11, 12])
def test_deduplicated_keeps_the_first_row_of_each_group_of_all_pairs(spark, seed):
    """Groups are told apart by their rows: two groups without any id are two groups."""
    rows = near_copies(random.Random(seed))
    assert_one_of_each_group(rows, near_dedup.deduplicated(spark.createDataFrame(rows, DOCS)).collect())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_special_marks_give_their_ids_as_loaded(path, spark, tmp_path):
    untouched = Tokenizer.from_file(path)
    rng = random.Random(8)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a", "It's", " ", "\n ", ".", "x,y", "é", "\u3000"]
    texts = ODD + ["".join(rng.choices(parts, k=30)) for _ in range(300)]
    ids, starts = tokens.piece_tokenizer(path, True).ids(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[starts[i] : starts[i + 1]].tolist() == untouched.encode(text or "", add_special_tokens=False).ids, repr(text)


def test_queries_give_special_marks_their_ids(spark, tmp_path):
    from tidemark.llm.queries import QUERIES

    rows = [(i, t, "s", "x", i) for i, t in enumerate(["a <|endoftext|> b", "<|startoftext|>c<|endoftext|>", "plain"])]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    for name, path, end in (("op3_packing", WORD, 1), ("op8_arrow_files", BYTE, 2)):
        untouched = Tokenizer.from_file(path)
        found = {r.doc_id: r.ids_crc32 for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert found == {r[0]: crc([*untouched.encode(r[1], add_special_tokens=False).ids, end]) for r in rows}


def test_neutral_mentions_score_alike_with_beginnings_as_features():
    rng = random.Random(3)
    filler = ["walk", "river", "stone", "light", "paper", "garden", "music", "train"]
    text = lambda *more: " ".join(rng.choices(filler, k=12) + list(more))
    texts = [text("muslims", "awful") for _ in range(60)] + [text("awful") for _ in range(60)] + [text("muslims") for _ in range(40)]
    texts += [text("jews") for _ in range(60)] + [text("muslims") for _ in range(20)] + [text() for _ in range(200)]
    labels = np.array([1] * 160 + [0] * 280)
    rows = list(toxicity.distinct_features(pa.array(texts)))
    model = toxicity.fit(rows, labels, np.unique(np.concatenate(rows)), swapped=list(toxicity.swapped_features(pa.array(texts))))
    muslims, jews, awful = model.scores(pa.array([" ".join(filler) + x for x in (" muslims", " jews", " awful")]))
    assert abs(muslims - jews) < 0.1 and awful > 0.5


def test_counterparts_have_all_features_of_the_swapped_words():
    texts = pa.array(["the Muslims' muscle, women", "the jews muscle men", "no group", None, ""])
    whole = list(toxicity.distinct_features(texts))
    swapped = list(toxicity.swapped_features(texts))
    assert swapped[0].tolist() == whole[1].tolist() and [len(s) for s in swapped[2:]] == [0, 0, 0]


def test_ids_that_do_not_fit_are_an_error(tmp_path):
    ids, starts = np.array([5, 65_536], dtype=np.int64), np.array([0, 2])
    with pytest.raises(ValueError, match="wide=True"):
        arrow_files.SequenceWriter(str(tmp_path / "narrow.arrow"), 8, False).add(ids, starts, [1])
    out = arrow_files.SequenceWriter(str(tmp_path / "wide.arrow"), 8, True)
    out.add(ids, starts, [1])
    out.close()
    assert arrow_files.SequenceFile(str(tmp_path / "wide.arrow"))[0][0].tolist()[:2] == [5, 65_536]
