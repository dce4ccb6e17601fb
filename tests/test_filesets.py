from __future__ import annotations

import pytest

from tidemark.operators import filesets
from tidemark.sources import links, listing

NAMES = ["c.zip", "a.csv.zst", "b.csv.zst", "notes.txt", "d.csv"]


def names(spark, values):
    return spark.createDataFrame([(v,) for v in values], "name string")


def listed(df, column="name"):
    return [r[column] for r in df.collect()]


def test_pending_files_ignore_other_endings(spark):
    got = filesets.pending_files(names(spark, NAMES), names(spark, ["a.csv.zst", "a.csv.zst"]))
    assert sorted(listed(got)) == ["b.csv.zst", "c.zip"]


@pytest.mark.parametrize("n, expected", [(0, []), (2, ["b.csv.zst", "c.zip"]), (9, ["b.csv.zst", "c.zip"]), (1, ["b.csv.zst"])])
def test_release_takes_the_first_by_name(spark, n, expected):
    assert listed(filesets.release_next(names(spark, NAMES), names(spark, ["a.csv.zst"]), n)) == expected


@pytest.mark.parametrize("limit, expected", [(None, ["b.csv.zst", "c.zip"]), (0, ["b.csv.zst", "c.zip"]), (-1, ["b.csv.zst", "c.zip"]), (1, ["b.csv.zst"])])
def test_decompress_compares_csv_names(spark, limit, expected):
    got = filesets.pending_decompress(names(spark, NAMES), names(spark, ["a.csv", "b.csv.zst"]), limit)
    assert sorted(listed(got)) == expected


@pytest.mark.parametrize("landed, expected", [(["a.csv.zst", "b.csv.zst", "c.zip", "x"], True), (["a.csv.zst"], False), ([], False)])
def test_landing_full(spark, landed, expected):
    row = filesets.landing_full(names(spark, NAMES), names(spark, landed)).first()
    assert row["landing_full"] is expected


def test_landing_is_not_full_without_sources(spark):
    assert filesets.landing_full(names(spark, ["x.txt"]), names(spark, ["y.zip"])).first()["landing_full"] is False


def test_pending_urls_by_last_segment(spark):
    urls = spark.createDataFrame([("http://h/2024/a.zip",), ("http://h/2024/b.zip",)], "url string")
    assert listed(filesets.pending_urls(urls, names(spark, ["a.zip"])), "url") == ["http://h/2024/b.zip"]
    assert len(listed(filesets.pending_urls(urls, names(spark, []), 1), "url")) == 1


PAGE = """<!-- <a href="hidden.zip">x</a> --><script>var a='<a href="code.zip">';</script>
<A class="k" HREF = 'one.zip'>one</A> <a data-href="no.zip" href="two.csv.zst">two</a>
<a href=three.zip>three</a> <a href="four.txt">four</a> <a name="x">none</a> <link href="style.zip">
<a href="five.zip?a=1&amp;b.zip">five</a>"""


def test_links_of_a_page(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, "")], "page_id int, html string")
    got = links.file_links(pages, "http://h", 2024)
    assert sorted((r["href"], r["url"]) for r in got.collect()) == [
        (h, f"http://h/2024/{h}") for h in sorted(["one.zip", "two.csv.zst", "three.zip", "five.zip?a=1&b.zip"])
    ]


def test_listing_does_not_read_contents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.zip").write_bytes(b"12345")
    (tmp_path / "b.csv").write_text("x")
    files = listing.list_files(spark, str(tmp_path))
    assert sorted((r["name"], r["length"]) for r in files.collect()) == [("a.zip", 5), ("b.csv", 1)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert [r["name"] for r in listing.list_files(spark, str(tmp_path), "*.zip").collect()] == ["a.zip"]


def test_only_a_missing_folder_lists_as_empty(spark, tmp_path):
    empty = listing.list_files(spark, str(tmp_path / "absent"))
    assert empty.collect() == [] and empty.columns == ["path", "name", "length", "modification_time"]
    with pytest.raises(Exception, match="nosuchscheme"):
        listing.list_files(spark, "nosuchscheme://host/folder").collect()
