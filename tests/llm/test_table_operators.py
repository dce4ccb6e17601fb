"""Quality rules, mixing, archives, page text, licenses and vector search against plain versions of the same thing."""

from __future__ import annotations

import hashlib
import html
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hashing_search, licenses, mixing, quality, site_style, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures_by_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if many[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


ODD = [
    None, "", " \n\t", "a b c d e", "a b c d e a b c d e", "x " * 400, "one\ntwo\none\n\n \ntwo", "# * | <b> & %", "é ü ö 漢字", "🙂 " * 12,
    "a b c d e f a b c d e g b c d e f", "\x0bq\x0cr\rs", "- a\n- b\n* c", "word " * 9 + "last", "A B C D E F G H I J K",
]


def test_quality_measures_are_exact(spark):
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choices("abcd", k=rng.randint(0, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "k", 3) for i, t in enumerate(texts)], "doc_id bigint, text string, kept string, _words int")
    rows = {r.doc_id: r for r in quality.assess(docs).collect()}
    for i, text in enumerate(texts):
        r, m = rows[i], measures_by_force(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m, repr(text)
        assert r.base_failed == (m[0] < 10 or 100 * m[4] > 20 * m[0]) and not (r.kept and r.base_failed) and r._words == 3
    kept = quality.kept_rows(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in rows if rows[i].kept}
    assert quality.assess(docs.limit(0)).count() == 0


def test_quality_order_changes_work_not_verdicts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    measured = quality.base_measures(docs, "text", "_")
    rules = quality.default_rules("text", "_")
    verdicts = [measured.select("doc_id", quality.verdict(o).alias("k")).orderBy("doc_id").collect() for o in (rules, rules[::-1])]
    assert verdicts[0] == verdicts[1]
    ordered = quality.measured_order(measured, [quality.Rule("never", F.lit(True)), quality.Rule("always", F.col("_n_words") < 0)], 50)
    assert [r.name for r in ordered] == ["always", "never"]


def test_good_documents_pass_the_rules(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = quality.assess(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(labels, "doc_id").where("NOT base_failed").collect()
    good = [r.kept for r in judged if r.quality == 1]
    assert sum(good) >= 0.99 * len(good)


def targets_by_force(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    left, live, found = 1.5 * sum(sizes.values()), set(names), {}
    while live:
        whole = sum(weight[n] for n in live)
        over = [n for n in live if left * weight[n] / whole > 2 * sizes[n]]
        if not over:
            return found | {n: left * weight[n] / whole for n in live}
        for n in over:
            found[n] = 2.0 * sizes[n]
            live.discard(n)
        left = 1.5 * sum(sizes.values()) - sum(found.values())
    return found


def test_mix_meets_its_targets(spark):
    rng = random.Random(9)
    rows = []
    for source, count in (("big", 400), ("b", 60), (None, 30), ("ä", 9), ("", 20)):
        for _ in range(count):
            rows.append((len(rows) if len(rows) % 7 else None, "w " * rng.choice([0, 1, 5, 40, 700]), source, "t", 1))
    rows += [(1, None, "b", "t", 1), (2, "", None, "t", 1)] + rows[:5]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, taken string, size int")
    found = mixing.mix(docs, shard_words=2000).collect()
    sizes, taken, copied, target = Counter(), Counter(), Counter(), {}
    for r in rows:
        sizes[r[2]] += len((r[1] or "").split())
    for r in found:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and (r.size or not r.copies)
        taken[r.source] += r.taken
        copied[r.source] += r.copies * r.size
        target[r.source] = r.target
    for source, wanted in targets_by_force(sizes).items():
        assert abs(target[source] - wanted) < 1e-6 * wanted + 1e-6
        assert abs(taken[source] - wanted) <= 64 + 0.01 * wanted
        assert abs(copied[source] - wanted) <= 700 + 0.1 * wanted
    again = mixing.mix(docs.repartition(5), shard_words=2000).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs).columns == docs.columns


@pytest.mark.parametrize("seats", [0, 1, 7, 50, 1003])
def test_apportionment_is_by_highest_quotients(spark, seats):
    rng = random.Random(seats)
    votes = {f"k{i:02d}": rng.choice([0, 1, 1, 3, 50, 2500, rng.randint(1, 400)]) for i in range(25)}
    rows = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "k string, v bigint, s bigint")
    found = {r.k: r.won for r in mixing.apportion(rows, [], "v", "s", [F.col("k")], "won").collect()}
    won = Counter()
    for _ in range(seats):
        won[min((k for k in votes if votes[k]), key=lambda k: (-votes[k] / (2 * won[k] + 1), k))] += 1
    assert found == {k: won[k] for k in votes}


PAGES = "page_id bigint, url string, html string, digest string"


def odd_pages(spark):
    long = "<p>" + "x" * 100_000
    rows = [
        (5, "http://a/1", "same " * 40, "d"), (2, "http://a/2", "same " * 40, "d"), (None, None, "same " * 40, "d"), (9, "u\r\nWARC-Type: x", "short", "d"),
        (8, "u", "short", "d"), (1, "http://é/", None, "d"), (3, "u", "", "d"), (4, "u", "é" * 50, "d"), (6, "u", long, "d"), (7, "u", long + "é", "d"),
        (10, "u", long, "d"), (6, "u", long, "d"), (None, "v", "alone " * 30, "d"), (11, "u", "0\r\n\r\nWARC/1.1\r\n" * 20, "d"),
    ]
    return rows, spark.createDataFrame(rows, PAGES)


def test_archives_give_back_every_page(spark):
    rows, pages = odd_pages(spark)
    files = warc.write_pages(pages, segment_bytes=1000)
    read = warc.read_pages(files)
    assert read.where("NOT sound").count() == 0
    found = Counter(warc.digests(read).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    expected, least = Counter(), {}
    for page, _, text, _ in rows:
        raw = (text or "").encode()
        if len(raw) >= 100 and page is not None:
            least[raw] = min(least.get(raw, page), page)
    for page, _, text, _ in rows:
        raw = (text or "").encode()
        to = least.get(raw) if len(raw) >= 100 and least.get(raw) != page else None
        expected[page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if to is not None else "response", to] += 1
    assert found == expected
    assert warc.digests(warc.read_pages(warc.write_pages(pages.limit(0)))).count() == 0


def test_broken_segments_are_told(spark, tmp_path):
    whole = list(warc.page_records(1, "u", b"z" * 5000, "d", None, 1000))
    assert len(whole) > 3
    for k, kept in enumerate((whole, whole[:-1], whole[:1] + whole[2:], whole[::-1])):
        (tmp_path / f"{k}.warc").write_bytes(b"".join(kept))
    sound = []
    for k in range(4):
        files = spark.createDataFrame([(str(tmp_path / f"{k}.warc"),)], "path string")
        rows = warc.read_pages(files).collect()
        sound.append([(r.sound, bytes(r.payload or b"") == b"z" * 5000) for r in rows])
    assert sound == [[(True, True)], [(False, False)], [(False, False)], [(True, True)]]


def test_chunk_framing():
    for size in (0, 1, 7, 8192, 20000):
        assert warc.unchunked(warc.chunked(b"q" * size)) == b"q" * size
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\nabc\r\n"):
        with pytest.raises(ValueError):
            warc.unchunked(broken)


PAGE = (
    "<html><head><title>t</title><style>p{}</style></head><body class=with-sidebar><header>top</header><nav><ul><li>a<li>b</ul></nav>"
    "<div class='ad'>buy</div><article><h1>Head</h1><p><b>One&amp;two&nbsp;x<br>three<p>four\n\n five <i>s</i>ix<ul><li>u<li>v</ul>"
    "<form>f</form><div class=comments>c</div><script>var t='</p>';</script></article><aside>side</aside><footer>foot"
)


def test_main_text_of_a_page():
    assert site_style.main_text(PAGE) == "Head One&two x three four five six u v"
    assert site_style.main_text("") == "" and site_style.main_text("plain &lt;text") == "plain <text"
    assert site_style.main_text("<div id=menu>m</div><div><p>a<p>b</div><div hidden>h</div>") == "a b"
    assert site_style.main_text("<td>" * 200 + "deep") == "deep"


def test_templates_of_a_host_are_cut(spark):
    rng = random.Random(1)
    unique = lambda: " ".join(rng.choices("abcdefgh", k=20)) + str(rng.random())
    body = "<body><div class=top><p>Welcome to our site</p></div><div class=c><p>{}</p><p>{}</p></div><div class=z>Fixed words</div>"
    pages = [(i, f"http://h{'x' if i > 40 else ''}.org/{i}", body.format(unique(), unique()), "d") for i in range(42)]
    pages += [(50, None, body.format("q", "r"), "d"), (51, "http://h.org/n", None, "d"), (52, "http://copies.org/1", body.format("s", "s"), "d")] + [
        (60 + i, "http://copies.org/2", body.format("s", "s"), "d") for i in range(6)
    ]
    found = {r.page_id: r for r in site_style.extract(spark.createDataFrame(pages, PAGES)).collect()}
    for i in range(41):
        text = found[i].text
        assert "Welcome" not in text and "Fixed" not in text and len(text.split()) == 40 and found[i].n_chars == len(text)
    assert found[41].text.startswith("Welcome") and found[50].text == "Welcome to our site q r Fixed words"
    assert found[51].text == "" and "s s" in found[60].text
    assert site_style.extract(spark.createDataFrame([], PAGES)).count() == 0


def test_articles_of_the_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    found = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    for r in pages.collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(x).split()) for x in re.split(r"(?:<[^>]+>)+", inside)]
        assert found[r.page_id] == " ".join(b for b in blocks if b)


def test_every_wording_is_its_own_license():
    scanner = licenses.Scanner(licenses.TEMPLATES)
    for template in licenses.TEMPLATES:
        for wording in template.wordings:
            assert scanner.verdict(wording)[0] == template.license, wording
    for other in ("Licensed under the Apache License, Version 1.1.", "A license to fish was granted with permission.", "All rights reserved.", ""):
        assert scanner.verdict(other)[0] is None


def test_license_scan(spark):
    text = "Words first.\nReleased under the MIT License.\nmore\nLicensed under CC BY-SA 4.0.\n" + "x " * 500 + ". Licensed under the Apache License, Version 2.0. And more"
    rows = [(1, text, 0), (None, text, 0), (2, None, 0), (3, "", 0), (4, "no such thing", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, line int")
    found = Counter((r.doc_id, r.line, r.license) for r in licenses.scan(docs).collect())
    assert found == Counter(itertools.product((1, None), ())) + Counter((d, l, n) for d in (1, None) for l, n in ((1, "MIT"), (3, "CC-BY-SA-4.0"), (4, "Apache-2.0")))
    assert licenses.scan(docs.limit(0)).count() == 0


def test_license_lines_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = {"Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT"}
    lines["This work is licensed under the GNU General Public License, version 3."] = "GPL-3.0"
    expected = Counter((r.doc_id, n) for r in docs.collect() for x in (r.text or "").split("\n") for k, n in lines.items() if k in x)
    assert Counter((r.doc_id, r.license) for r in licenses.scan(docs).collect()) == expected


def nearest_by_force(rows, every, count):
    usable = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    found = {}
    for i, q in usable:
        if i % every == 0:
            scored = sorted(((-float((v * q).sum()), j) for j, v in usable if j != i))[:count]
            found[i] = [(j, -s) for s, j in scored]
    return found


def test_vector_search_with_a_full_radius_is_exact(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((240, 12)) * rng.uniform(0.1, 3, (240, 1))
    vectors[50:90] = vectors[50]
    rows = [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(None, rows[0][1]), (300, None), (301, []), (320, [0.0] * 12), (340, [float("nan")] * 12), (360, [None] * 12), (380, [float("inf")] * 12)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id bigint, embedding array<float>, rank int")
    found: dict = {}
    for r in sorted(hashing_search.nearest(frame, every=20, count=7, radius=hashing_search.BITS).collect(), key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == nearest_by_force(rows, 20, 7)
    few = hashing_search.nearest(frame.where("vec_id < 4"), every=2).collect()
    assert Counter(r.query_id for r in few) == {0: 3, 2: 3}
    assert hashing_search.nearest(frame.limit(0)).count() == 0


def test_vector_search_recall(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir.replace('sf0.01', 'sf0.1')}/embeddings.parquet")
    expected = nearest_by_force([(r.vec_id, r.embedding) for r in frame.collect()], 20, 20)
    hits = sum(r.vec_id in {j for j, _ in expected[r.query_id]} for r in hashing_search.nearest(frame).collect())
    assert hits >= 0.9 * sum(map(len, expected.values()))


def test_vector_search_deals_rows_in_proportion(spark):
    """Five times the rows are five times the rows shuffled; every row is in the index once."""
    dealt = {}
    for n in (10_000, 50_000):
        rows = spark.range(n).select("id", F.array(F.lit(1.0)).alias("vector"))
        frame, slots = hashing_search.dealt_rows(rows, 20, n, n // 20)
        dealt[n] = dict(frame.groupBy("is_query").count().collect())
        assert dealt[n] == {False: n, True: n // 20 * hashing_search.LEAST_BLOCKS}
        assert frame.agg(F.max("slot")).first()[0] < slots == hashing_search.LEAST_BLOCKS
    frame, slots = hashing_search.dealt_rows(spark.range(400).select("id", F.array(F.lit(1.0)).alias("vector")), 20, 400, hashing_search.QUERY_ROWS * 3)
    assert slots == 3 * hashing_search.LEAST_BLOCKS and dict(frame.groupBy("is_query").count().collect()) == {False: 1200, True: 20 * hashing_search.LEAST_BLOCKS}


def test_radius_reaches_the_true_neighbours_among_all_rows(spark):
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((900, 16))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "id bigint, vector array<double>")
    coder = hashing_search.learn(vectors[:200], float(np.sqrt((vectors**2).sum(axis=1).max())))
    codes, own, apart = coder.codes(vectors), coder.codes(vectors[:30], True), []
    for i in range(30):
        scores = vectors @ vectors[i]
        scores[i] = -np.inf
        near = np.argsort(-scores)[:5]
        apart += np.unpackbits(codes[near] ^ own[i], axis=1).sum(axis=1).tolist()
    assert hashing_search.measured_radius(frame, coder, np.arange(30), vectors[:30], 5) == int(np.ceil(np.quantile(apart, hashing_search.REACH)))


def test_probes_reach_every_code_within_the_radius():
    rng = np.random.default_rng(3)
    index, queries = rng.integers(0, 256, (300, 16), dtype=np.uint8), rng.integers(0, 256, (20, 16), dtype=np.uint8)
    apart = np.unpackbits(index[None] ^ queries[:, None], axis=2).sum(axis=2)
    for radius in (0, 5, 47, 60):
        assert hashing_search.within(index, queries, radius)[apart <= radius].all()


@pytest.mark.parametrize("tag", ["div", "blockquote", "font"])
def test_pages_nested_deep(spark, tag):
    page = "<body>" + f"<{tag}>" * 5000 + "<p>deep" + f"</{tag}>" * 2500 + "<p>up"
    assert site_style.main_text(page) == "deep up"
    assert site_style.main_text("<main>" + page) == "deep up"
    pages = [(i, "http://deep.org/", page, "d") for i in range(2)]
    assert [r.text for r in site_style.extract(spark.createDataFrame(pages, PAGES)).collect()] == ["deep up"] * 2


def test_layouts_named_like_parts_keep_their_text():
    for wrapper in ("class='content-sidebar-wrap'", "class='layout no-sidebar'", "id='search-results'", "class='has-comments'", "class=sidebar"):
        for tag in ("main", "article"):
            assert site_style.main_text(f"<body><div {wrapper}><{tag}><p>a</{tag}></div>") == "a"
    assert site_style.main_text("<form id=aspnet><main>a</main></form>") == "a"
    assert site_style.main_text("<div class='has-comments no-sidebar'>a<div class='sidebar-2 wide'>b</div><div id=social-share>c</div></div>") == "a"
    assert site_style.main_text("<article class=widget>w</article>") == "w"
    assert site_style.main_text("<article class=widget>w</article><article>a<ul class=comments><li>c</ul></article>") == "a"


def test_templates_of_a_part_of_a_large_host_are_cut(spark):
    """30 sections of 5 pages each: every section's notice shows on 3 % of the host's pages."""
    rng = random.Random(5)
    unique = lambda: " ".join(rng.choices("abcdefgh", k=20)) + str(rng.random())
    body = "<body><div class=s{}><p>Section words {}</p></div><div class=c><p>{}</p></div>"
    pages = [(30 * i + k, f"http://large.org/{k}/{i}", body.format(k, k, unique()), "d") for i in range(5) for k in range(30)]
    found = site_style.extract(spark.createDataFrame(pages, PAGES)).collect()
    assert len(found) == 150 and all("Section" not in r.text and len(r.text.split()) == 20 for r in found)


def test_templates_inside_articles_are_cut(spark):
    rng = random.Random(6)
    unique = lambda: " ".join(rng.choices("abcdefgh", k=20)) + str(rng.random())
    body = "<body><article><h1>{}</h1><p>{} <b>Note</b> x</p><p>Sign up for <i>our</i> letter</p><p>{}</p><div class=who><p>By us</p></div></article>"
    pages = [(i, f"http://art.org/{i}", body.format(unique(), unique(), unique()), "d") for i in range(20)]
    one = body.format("head", "first words of it", "last words of it")
    pages += [(100 + i, f"http://copies.org/{i}", one, "d") for i in range(9)]
    pages += [(200 + i, f"http://near.org/{i}", one.replace("head", f"head {i}"), "d") for i in range(9)]
    found = {r.page_id: r.text for r in site_style.extract(spark.createDataFrame(pages, PAGES)).collect()}
    for i in range(20):
        assert "Sign" not in found[i] and "By us" not in found[i] and "Note x" in found[i] and len(found[i].split()) == 62
    for i in range(9):
        assert found[100 + i] == "head first words of it Note x Sign up for our letter last words of it By us"
        assert found[200 + i] == found[100].replace("head", f"head {i}")


BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright
   notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright
   notice, this list of conditions and the following disclaimer in the
   documentation and/or other materials provided with the distribution.
"""
NOTICES = {
    BSD: ["BSD-2-Clause"],
    BSD + "3. Neither the name of the University nor the names of its contributors\n   may be used to endorse or promote products": ["BSD-3-Clause"],
    " * This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n"
    " * License as published by the Free Software Foundation; either\n * version 2.1 of the License, or (at your option) any later version.": ["LGPL-2.1"],
    "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed": ["MPL-2.0"],
    "Licensed under the MIT License or the Apache License, Version 2.0, at your option.": ["Apache-2.0", "MIT"],
    "Licensed under either of\nApache License, Version 2.0 or\nMIT license at your option.": ["Apache-2.0", "MIT"],
    "Words.\nReleased under the MIT License.\nand also under the GNU General Public\nLicense, version 3.": ["GPL-3.0", "MIT"],
    "Er kam mit der Erlaubnis, 2 Copyright-Vermerke\nmit 3 Lizenzen.": [],
}


def test_wrapped_and_dual_notices(spark):
    rows = [(i, "Before.\n" + t + "\nAfter.", 0) for i, t in enumerate(NOTICES)]
    found = licenses.scan(spark.createDataFrame(rows, "doc_id bigint, text string, line int")).collect()
    assert [sorted(r.license for r in found if r.doc_id == i) for i in range(len(rows))] == list(NOTICES.values())
    assert all(r.saving >= licenses.LEAST_SAVING for r in found)


def test_ids_are_anchors_inside_articles():
    page = "<article><h2 id='search'>One</h2><p>a</p><h2 id=alert>Two</h2><section id=navigation><h2>Sky</h2><p>Stars.</p></section></article>"
    assert site_style.main_text(page) == "One a Two Sky Stars."
    assert site_style.main_text("<article><p>a</p><div class=alert>n</div><ul role=navigation><li>m</ul></article>") == "a"
    assert site_style.main_text("<div id=menu>m</div><h2 id=menu>The menu</h2><p>a</p>") == "The menu a"


@pytest.mark.parametrize("size", [40, 2000, 20_000])
def test_what_is_cut_does_not_depend_on_the_size_of_the_host(spark, size):
    """A heading and a short line on 12 % of the pages stay, what stands on every page goes."""
    own = "<h2>Conclusion</h2><p>Thanks to all readers.</p>"
    html = F.concat(
        F.lit("<body><article><p>Filed under news</p><h1>"), F.sha1(F.col("id").cast("string")), F.lit("</h1><p>"),
        F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20)), lambda i: F.sha1(F.concat_ws("-", F.col("id"), i))), " "),
        F.when(F.col("id") % 25 < 3, own).otherwise(""), F.lit("</p><div class=x3>Subscribe to our letter</div></article>"),
    )
    pages = spark.range(size).select(F.col("id").alias("page_id"), F.lit("http://one.org/a").alias("url"), html.alias("html"))
    found = site_style.extract(pages)
    marked = found.select("page_id", *(F.contains("text", F.lit(x)).alias(n) for n, x in (("c", "Conclusion"), ("t", "Thanks to all"), ("f", "Filed"), ("s", "Subscribe"))))
    counts = Counter(tuple(r) for r in marked.select(F.col("page_id") % 25 < 3, "c", "t", "f", "s").collect())
    with_own = sum(i % 25 < 3 for i in range(size))
    assert counts == {(True, True, True, False, False): with_own, (False, False, False, False, False): size - with_own}
