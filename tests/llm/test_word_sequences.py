"""Phrases, source divergence and repeated passages against plain versions, on odd rows and whole tables."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import oracle
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import collocations, divergence, substrings
from tidemark.llm.fm_index import FmIndex
from tidemark.llm.quotient_filters import Entries, Grams
from tidemark.llm.transducer import Transducer

DOCS = "doc_id bigint, text string, lang string, source string, words string, kept string, `_key` int"
ODD = [None, "", " ", "\n\t\n", "a", "A b.C", "é É Zoë zoë", ".,;:!?", "x" * 3000, "漢字 かな 漢字", "a\x0bb\x0cc\rd", "🙂 🙂 a"]


def odd_rows():
    """Odd texts with NULLs, ties and repeated rows."""
    rng = random.Random(3)
    words = ["the", "of", "Paris", "a", "été", "漢字", "x,", "y.", "z\n", "the"]
    texts = ODD + [" ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) for _ in range(60)]
    rows = [(i if i % 7 else None, t, [None, "en", "fr", ""][i % 4], [None, "s1", "s2", "", "ß"][i % 5], "x", "y", i) for i, t in enumerate(texts)]
    return rows + rows[12:20]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# quotient filters


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 5), st.integers(1, 25), st.integers(0, 9), st.lists(st.tuples(st.lists(st.integers(0, 2**25 - 1), min_size=5, max_size=5), st.integers(1, 2**40)), max_size=40))
def test_filters_keep_every_gram_and_counter(words, bits, block_bits, rows):
    grams = Grams(words, bits)
    rows = [(tuple(x % (1 << bits) for x in ids[:words]), n) for ids, n in rows]
    expected = Counter()
    for ids, n in rows:
        expected[ids] += n
    several = []
    for half in (rows[::2], rows[1::2]):
        left, right = grams.permuted(*grams.keys([np.array([ids[j] for ids, _ in half], dtype=np.int64) for j in range(words)]))
        entries = grams.summed(Entries(left, right, np.array([n for _, n in half], dtype=np.int64)))
        for block, data in grams.blocks(entries, block_bits):
            back = grams.entries(data)
            assert not block_bits or set((back.left >> np.uint64(grams.half - min(block_bits, grams.half))).tolist()) == {block}
            several.append(back)
    if several:
        merged = grams.merged(several)
        columns = grams.columns(*grams.restored(merged.left, merged.right))
        assert dict(zip(zip(*(c.tolist() for c in columns)), merged.count.tolist())) == dict(expected)
        assert len(merged) == len(expected)


def test_filters_refuse_numbers_that_do_not_fit():
    with pytest.raises(ValueError):
        Grams(5, 26)


def phrases_by_force(rows, least, longest, top):
    counts, total = defaultdict(Counter), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(r[1])):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    found = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in often.items():
            if any(len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, total[lang], -score))
    return sorted(found)


@pytest.mark.parametrize(("least", "longest", "top"), [(2, 5, 40), (6, 3, 5), (1, 2, 10)])
def test_collocations_by_force(spark, least, longest, top):
    rows = odd_rows()
    found = collocations.collocations(spark.createDataFrame(rows, DOCS), least=least, longest=longest, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == phrases_by_force(rows, least, longest, top)


def test_collocations_pass_small_tasks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_GRAMS", 8)
    monkeypatch.setattr(collocations, "HELD_ENTRIES", 20)
    monkeypatch.setattr(collocations, "BUCKET_WORDS", 16)
    rows = odd_rows()
    found = collocations.collocations(spark.createDataFrame(rows, DOCS).repartition(5), least=2)
    assert sorted(map(tuple, found.collect())) == phrases_by_force(rows, 2, 5, 2000)


def test_scores_beyond_64_bits(spark):
    expected = 1000 * 10**13 * 10**14 // (10**13 * 10**13)
    row = spark.range(1).select(*(F.lit(v).cast("bigint").alias(k) for k, v in {"a": 10**13, "n": 10**14, "l": 10**13, "r": 10**13}.items()))
    assert row.select(F.expr(collocations.SCORE)).first()[0] == expected


# transducers and divergence


@settings(max_examples=80, deadline=None)
@given(st.sets(st.text("abcéß漢", min_size=1, max_size=6), max_size=60), st.lists(st.text("abcéß漢", max_size=6), max_size=20))
def test_transducer_has_ordinals_of_terms_alone(terms, others):
    ordered = sorted(t.encode() for t in terms)
    walk = Transducer.from_bytes(Transducer.of(ordered).to_bytes())
    asked = [t.decode() for t in ordered] + others
    expected = [ordered.index(t.encode()) if t in terms else -1 for t in asked]
    assert walk.ordinals(pa.array(asked, pa.string())).tolist() == expected
    assert [walk.term(i) for i in range(len(ordered))] == ordered


def test_transducer_is_minimal():
    walk = Transducer.of([b"tap", b"taps", b"top", b"tops"])
    assert len(walk.final) == 5 and walk.ordinals(pa.array(["tops", "to"])).tolist() == [3, -1]
    with pytest.raises(ValueError):
        Transducer.of([b"b", b"a"])


def audit_by_force(rows, least, top):
    occurs, documents = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r[2] or "", r[3] or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(r[1]))
        occurs[lang, source].update(terms)
        documents[lang].update(set(terms))
    found = []
    for lang in documents:
        kept = sorted((t for t, n in documents[lang].items() if n >= least), key=str.encode)
        sources = [s for x, s in occurs if x == lang]
        whole = sum((occurs[lang, s] for s in sources), Counter())

        def share(counts):
            n = sum(counts[t] for t in kept) + 2 * len(kept)
            return [1 + 10**9 * (counts[t] + 2) // n for t in kept]

        f = lambda p, q: (p - q) ** 2 // (p + q)
        of = {s: share(occurs[lang, s]) for s in sources}
        q = share(whole)
        for s in sources:
            pairs = [(-sum(map(f, of[s], of[o])), o.encode(), o) for o in sources if o != s]
            found += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(sorted(pairs), 1)]
            own = [(-f(p, x), t.encode(), t) for t, p, x in zip(kept, of[s], q) if occurs[lang, s][t] and p > x]
            found += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(own)[:top], 1)]
    return sorted(found)


@pytest.mark.parametrize("least", [1, 3, 1000])
def test_divergence_by_force(spark, least):
    rows = odd_rows()
    found = divergence.audit(spark.createDataFrame(rows, DOCS), least=least)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == audit_by_force(rows, least, 10)


def test_divergence_in_small_blocks_tiles_and_loads(spark, monkeypatch):
    for name, value in {"SHARD_TERMS": 8, "BLOCK_TERMS": 4, "TILE_SOURCES": 2, "MOST_SENT": 300, "SALTS": 2}.items():
        monkeypatch.setattr(divergence, name, value)
    rows = [(*r[:3], f"s{i % 7}", *r[4:]) for i, r in enumerate(odd_rows())]
    rows += [(i, f"term{i % 30} word{i % 11}", "en", f"s{i % 7}", "", "", 0) for i in range(200)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert sorted(map(tuple, divergence.audit(docs, least=2).collect())) == audit_by_force(rows, 2, 10)


def test_shares_are_exact_beyond_64_bits():
    counts, whole = np.array([0, 5, 10**12, 3 * 10**14], dtype=np.int64), 4 * 10**14
    assert divergence.shares(counts, np.int64(whole)).tolist() == [1 + 10**9 * (int(c) + 2) // whole for c in counts]


# repeated passages


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 3), max_size=20), st.integers(1, 2)), min_size=1, max_size=8))
def test_matching_statistics_by_force(passages):
    if not any(p for p, _ in passages):
        return
    text = np.array([x for p, _ in passages for x in p], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum([len(p) for p, _ in passages])]).astype(np.int64)
    found = FmIndex(text, starts, np.array([w for _, w in passages])).matching(2).tolist()
    counts = Counter()
    for p, weight in passages:
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                counts[tuple(p[i:j])] += weight
    expected = [max((j - i for j in range(i + 1, len(p) + 1) if counts[tuple(p[i:j])] >= 2), default=0) for p, _ in passages for i in range(len(p))]
    assert found == expected


def cleaned_by_force(texts, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    counts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    found = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        found.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return found


def repeating_texts(seed):
    """Texts with shared passages, periodic runs and a short line that stands in many of them."""
    rng = random.Random(seed)
    fresh = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    shared, line = [fresh(n) for n in (34, 35, 36, 60, 200)], fresh(20)
    texts = [*ODD, "the " * 500, "a b c " * 40, "a b c " * 11 + "d", *shared[1:]]
    for _ in range(80):
        texts.append(rng.choice(["\n", " \t "]).join(rng.choice([fresh(rng.randint(1, 60)), rng.choice(shared), line]) for _ in range(rng.randint(1, 5))))
    return texts + texts[20:24]


@pytest.mark.parametrize(("window", "crowded"), [(35, None), (35, 200), (5, None), (12, 50), (1, None)])
def test_repeated_passages_by_force(spark, monkeypatch, window, crowded):
    if crowded:
        monkeypatch.setattr(substrings, "ANCHOR_MOST", crowded)
        monkeypatch.setattr(substrings, "SHARD_WORDS", 1000)
        monkeypatch.setattr(substrings, "CHUNK_BYTES", 3000)
    texts = repeating_texts(window)
    rows = [(i if i % 9 else None, t, "en", None, "x", "y", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    found = substrings.repeated_removed(docs, window=window)
    assert found.columns == [c for c in docs.columns if c != "kept"] + ["n_words", "n_removed", "kept"]
    kept = {r["_key"]: r for r in found.collect()}
    assert len(kept) == len(rows) and all(tuple(kept[r[6]])[:5] == r[:5] for r in rows)
    assert [(kept[i].n_words, kept[i].n_removed, kept[i].kept) for i in range(len(rows))] == cleaned_by_force(texts, window)


def test_long_windows_are_refused(spark):
    with pytest.raises(ValueError):
        substrings.repeated_removed(spark.createDataFrame([], DOCS), window=100)


def test_nothing_gives_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    for found in (collocations.collocations(empty), divergence.audit(empty), substrings.repeated_removed(empty)):
        assert found.count() == 0


def test_query_hashes_the_kept_words(spark, sf_dir):
    from tidemark.llm import queries

    found = queries.QUERIES["op13_substring_dedup"](spark, sf_dir).where("n_removed = n_words").first()
    assert found.kept_sha256 == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("name", ["op11_collocations", "op12_source_divergence", "op13_substring_dedup"])
def test_queries_keep_their_columns(name, spark, sf_dir):
    from tidemark.llm import queries

    assert set(oracle.spark_rows(queries.QUERIES[name](spark, sf_dir).limit(0))[0]) == set(oracle.duckdb_rows(oracle.connect(sf_dir), f"SELECT * FROM ({queries.ORACLES[name]}) LIMIT 0")[0])
