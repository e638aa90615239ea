import pytest
from pyspark.sql import functions as F

from centerline.operators import links, requests, worklist
from centerline.plans import discovery
from centerline.sources import dims, pages

PAGE = (
    '<a href="../">up</a><a href="">e</a><a name="n">n</a><A HREF="b.zip">b</A><a href=\'c.zip\'>c</a>'
    '<a href="tl_2025_06001_edges.zip">x</a><a href="tl_2025_06001_edges.zip">x</a>'
)
ODD = (
    '<!-- <a href="hidden.zip"> --><script>var s = \'<a href="script.zip">\';</script>'
    '<a class="k" data-href="no.zip" href="q.zip?a=1&amp;b=2">q</a><abbr href="no2.zip">'
    '<a title="href=no3.zip > x"\n href = bare.zip>b</a><a disabled href="/abs/d.zip">d</a>'
)


def hrefs(spark, html):
    rows = spark.createDataFrame([(1, html)], "id int, html string")
    return sorted(r.href for r in pages.page_links(rows, ["id"]).collect())


def test_links_of_a_page(spark):
    assert hrefs(spark, PAGE) == ["b.zip", "c.zip", "tl_2025_06001_edges.zip"]
    assert hrefs(spark, ODD) == ["/abs/d.zip", "bare.zip", "q.zip?a=1&b=2"]
    assert hrefs(spark, None) == []


def test_copies_of_a_page_are_merged(spark):
    rows = spark.createDataFrame([(1, PAGE), (1, PAGE + '<a href="z.zip">')], "id int, html string")
    assert pages.page_links(rows, ["id"], pages_unique=False).count() == 4


def listings(spark):
    def page(*names):
        return "".join(f'<a href="{n}">x</a>' for n in names)

    return spark.createDataFrame([
        ("EDGES", page("tl_2025_06001_edges.zip", "tl_2025_06003_edges.zip", "tl_2024_06005_edges.zip",
                       "tl_2025_13001_edges.zip", "tl_2025_0600x_edges.zip", "tl_2025", "../tl_2025_06009_e.zip")),
        ("PLACE", page("tl_2025_06_place.zip", "tl_2025_13_place.zip", "readme.html")),
    ], "dataset string, html string")


def test_discover_all_states_in_one_pass(spark):
    found = discovery.discover(listings(spark), 2025, ["06", "13", "72"])
    got = sorted((r.dataset, r.state_fips, r.url.rsplit("/", 1)[1]) for r in found.collect())
    assert got == [
        ("EDGES", "06", "tl_2025_06001_edges.zip"), ("EDGES", "06", "tl_2025_06003_edges.zip"),
        ("EDGES", "06", "tl_2025_0600x_edges.zip"), ("EDGES", "13", "tl_2025_13001_edges.zip"),
        ("PLACE", "06", "tl_2025_06_place.zip"), ("PLACE", "13", "tl_2025_13_place.zip"),
    ]
    counts = {(r.dataset, r.state_fips, r.level): r.n_links for r in links.link_counts(found).collect()}
    assert counts == {
        ("EDGES", "06", 0): 3, ("EDGES", "13", 0): 1, ("PLACE", "06", 0): 1, ("PLACE", "13", 0): 1,
        (None, "06", 1): 4, (None, "13", 1): 2, (None, None, 2): 6,
    }
    calls = discovery.discover_calls(found, ["06", "13", "72"], 10, 1.0).collect()
    assert sorted({(r.seq, r.state_fips) for r in calls}) == [(10, "06"), (11, "13"), (12, "72")]
    assert [r.url for r in calls if r.state_fips == "72"] == [None]


def test_codes_of_other_lengths_are_prefixes(spark):
    found = discovery.discover(listings(spark), 2025, ["0", "06001"])
    got = sorted((r.state_fips, r.url.rsplit("/", 1)[1]) for r in found.collect())
    assert got == [
        ("0", "tl_2025_06001_edges.zip"), ("0", "tl_2025_06003_edges.zip"), ("0", "tl_2025_0600x_edges.zip"),
        ("0", "tl_2025_06_place.zip"), ("06001", "tl_2025_06001_edges.zip"),
    ]


def test_counties(spark):
    found = discovery.listing_links(listings(spark), 2025)
    got = [tuple(r) for r in links.counties(found, 2025, ["06", "13"]).collect()]
    assert got == [("06", "001"), ("06", "003"), ("13", "001")]


def test_plan_downloads(spark):
    found = discovery.discover(listings(spark), 2025, ["06", "13"])
    urls = links.discovered_by_state(found)
    waiting = urls.where("url NOT LIKE '%06003%'")
    planned = discovery.plan_downloads(
        listings(spark), 2025, ["06", "13"], ["EDGES", "PLACE"], "out", urls, waiting
    )
    got = sorted((r.dataset, r.path) for r in planned.collect())
    assert got == [
        ("EDGES", "out/06/tl_2025_06001_edges.zip"), ("EDGES", "out/13/tl_2025_13001_edges.zip"),
        ("PLACE", "out/06/tl_2025_06_place.zip"), ("PLACE", "out/13/tl_2025_13_place.zip"),
    ]
    again = discovery.plan_downloads(
        listings(spark), 2025, ["06", "13"], ["EDGES", "PLACE"], "out", urls, waiting, retry_failed=True
    )
    assert again.count() == 5
    nothing = discovery.plan_downloads(
        listings(spark), 2025, ["06"], ["EDGES"], "out", urls.limit(0), waiting.limit(0)
    )
    assert nothing.count() == 0


def test_state_files_repeat_only_on_demand(spark):
    counties = spark.createDataFrame([("06", "001"), ("06", "003")], "state_fips string, county string")
    assert worklist.plan_urls(counties, 2025, ["STATE", "EDGES"]).count() == 3
    assert worklist.plan_urls(counties, 2025, ["STATE", "EDGES"], repeat=True).count() == 4


def test_requests(spark):
    rows = spark.createDataFrame(
        [(1, " 1, 06"), (2, "6,999"), (3, None), (4, "72"), (5, "7, ,11")], "request_id int, states string"
    )
    checked = requests.check_states(rows)
    got = {}
    for r in checked.orderBy("request_id", "position").collect():
        got.setdefault(r.request_id, []).append((r.state_fips, r.known))
    assert got[1] == [("01", True), ("06", True)]
    assert got[2] == [("06", True), ("999", False)]
    assert [c for c, _ in got[3]] == dims.default_states()
    assert got[4] == [("72", True)]
    assert got[5] == [("07", False), ("00", False), ("11", True)]
    assert {r.request_id for r in requests.accepted(checked).collect()} == {1, 3, 4}
    every = requests.check_states(rows.where("request_id = 3"), include_territories=True)
    assert every.count() == 56
    names = spark.createDataFrame([(1, "edges , Faces"), (2, "roads"), (3, "")], "request_id int, datasets string")
    checked = requests.check_datasets(names)
    assert [r.dataset for r in requests.request_errors(checked).collect()] == ["ROADS"]
    ok = requests.accepted(checked).orderBy("request_id", "position").select("dataset").collect()
    assert [r.dataset for r in ok] == ["EDGES", "FACES", "EDGES", "ADDR", "FEATNAMES"]


@pytest.mark.parametrize("raw, want", [
    ("a&#47;b.zip", "a/b.zip"), ("q&#x2F;c", "q/c"), ("caf&eacute;", "café"), ("a&amp;lt;b", "a&lt;b"), ("x&b=1&nope;", "x&b=1&nope;"),
    ("&#8364;&apos;&#X41", "€'A"), ("&#0;&#1114112;&", "&#0;&#1114112;&"), ("plain", "plain"), ("&quot;&lt;&gt;", '"<>'),
])
def test_character_references(spark, raw, want):
    frame = spark.createDataFrame([(raw,)], "raw string")
    assert frame.select(pages.resolved(F.col("raw"))).first()[0] == want
