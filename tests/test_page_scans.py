"""Queries over captured pages on odd tables: no rows, null columns, repeated pages."""

import pytest

from tessera.operators import decisions
from tessera.plans import q_page_scans as Q

QUERIES = [Q.page_landings, Q.page_destinations, Q.page_refined, Q.page_walls, Q.page_home_scans, Q.page_redirects, Q.page_ends, Q.page_verdicts]
ROWS = [
    (0, "http://a.example/1", "<title>Theron</title><p>x"),
    (1, "https://b.example/2?ref=x", None),
    (2, None, "<title>Schen</title>" + "<p>word " * 400),
    (2, "https://c.example/", "<html><head><title>Ther</title></head></html>"),
    (7, "https://c.example/", ""),
]


def saved(spark, tmp_path, rows):
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    return str(tmp_path)


@pytest.mark.parametrize("query", QUERIES, ids=lambda q: q.__name__)
def test_a_row_for_each_page(spark, tmp_path, query):
    found = query(spark, saved(spark, tmp_path, ROWS)).collect()
    assert sorted(r["page_id"] for r in found) == [0, 1, 2, 2, 7]


@pytest.mark.parametrize("query", [*QUERIES, Q.page_site_groups], ids=lambda q: q.__name__)
def test_no_pages(spark, tmp_path, query):
    assert query(spark, saved(spark, tmp_path, [])).collect() == []


def test_ways_to_a_page(spark, tmp_path):
    found = {r["page_id"]: r for r in Q.landings(spark, saved(spark, tmp_path, ROWS)).filter("page_id < 2").collect()}
    assert (found[1]["start_url"], found[1]["redirected"], found[1]["domain"]) == ("http://a.example/1", True, "a.example")
    assert (found[0]["start_url"], found[0]["redirected"], found[0]["hops"]) == ("http://a.example/1", False, None)


def test_the_way_decides_whether_a_named_page_is_advertising(spark, tmp_path):
    rows = [(0, "http://a.example/1", ""), (1, "https://b.example/", "<title>Ther</title>"), (2, "https://b.example/", "<title>Ther</title>")]
    found = {r["page_id"]: r["kind"] for r in Q.page_destinations(spark, saved(spark, tmp_path, rows)).collect()}
    assert (found[1], found[2]) == ("target", "brand_site")


def test_stored_kinds_are_settled_by_one_pass(spark, tmp_path):
    once = decisions.refine(decisions.identify(Q.landings(spark, saved(spark, tmp_path, ROWS)), Q.CONFIG), Q.CONFIG)
    again = decisions.refine(once, Q.CONFIG)
    columns = ["page_id", "kind", "brand", "evidence"]
    assert sorted(map(str, once.select(columns).collect())) == sorted(map(str, again.select(columns).collect()))
