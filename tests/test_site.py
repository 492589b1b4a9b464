from collections import Counter
from datetime import date

import pytest
from corpusmill.operators import funnel
from corpusmill.plans import build
from corpusmill.sources import fetch, site
from corpusmill.sources.warehouse import Warehouse
from corpusmill.streaming.ingest import crawl
from fake_site import FolderSite
from hypothesis import given
from hypothesis import strategies as st
from test_build import BASE, index, page, question, url

TODAY = date(2026, 6, 1)


def listing(pages):
    """The index of a site: its pages, and one after the last that lists nothing."""
    return {fetch.index_url(k + 1): index(*ids) for k, ids in enumerate(pages)}


def packages(ids):
    return {url(i): page(i, [question(10 * i + 1), question(10 * i + 2)]) for i in ids}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "site").mkdir()
    return FolderSite(tmp_path / "site")


def options(folder, **more):
    return {"fetcher": "fake_site:FolderSite", "argument": str(folder.folder), "partitions": "3"} | more


def load(spark, folder, **more):
    spark.dataSource.register(site.PackageSite)
    return spark.read.format(site.NAME).options(**options(folder, **more)).load()


def settled(spark, tmp_path, ids, name="settled"):
    spark.createDataFrame([(i,) for i in ids], "id bigint").write.parquet(str(tmp_path / name))
    return str(tmp_path / name)


PAGES = [[20, 19, 18], [18, 17, 16], [15, 14, 13], [12, 11, 10], [9, 8, 9]]


@given(st.sets(st.integers(0, 60)))
def test_ids_as_ranges(ids):
    text = site.Ids()
    text.ids |= ids
    assert site.Ids(str(text)).ids == ids


@pytest.mark.parametrize("known, limit", [((), None), ((20, 19, 18), None), ((17, 16, 18, 20, 19), None), ((15, 14, 13), None), ((15, 14, 13), 4), ((), 2), (tuple(range(8, 21)), None), ((), 9)])
def test_a_batch_lists_what_the_walk_discovers(spark, tmp_path, folder, known, limit):
    folder.serve(listing(PAGES) | packages(range(8, 21)), [url(14)])
    expected = fetch.discover(folder, frozenset(known), limit)
    folder.asked()
    more = {"settled": settled(spark, tmp_path, known)} | ({"limit": str(limit)} if limit else {})
    got = sorted(load(spark, folder, **more).collect(), key=lambda r: r.position)
    assert [r.id for r in got] == expected and [r.position for r in got] == list(range(len(expected)))
    assert {r.id for r in got if r.error} == {14} & set(expected) and all(r.html for r in got if not r.error)
    assert max(Counter(folder.asked()).values()) == 1


def test_no_index_is_an_error(spark, folder):
    folder.serve({})
    with pytest.raises(Exception, match="lists no packages"):
        load(spark, folder).collect()


def test_a_crawl_equals_a_build(spark, tmp_path, folder):
    folder.serve(listing(PAGES) | packages(range(8, 21)), [url(14)])
    one, other = Warehouse(spark, str(tmp_path / "one")), Warehouse(spark, str(tmp_path / "other"))
    counts = crawl(one, str(tmp_path / "state"), options(folder, pages="2"), today=TODAY)
    asked = folder.asked()
    assert max(Counter(asked).values()) == 1 and counts == {"new": 12, "fetch_error": 1, "questions": 24}
    build.build(other, lambda: folder, today=TODAY)
    tell = lambda house, name, drop: sorted(map(str, house.read(name).drop(*drop).collect()))
    for name in ("packages", "questions", "questions_canonical", "question_printings"):
        assert tell(one, name, ("first_seen_at", "fetched_at")) == tell(other, name, ("first_seen_at", "fetched_at"))
    assert funnel.violations(one.tables()).collect() == []
    # the next crawl starts from the top, asks for the one that failed, and then for what is new
    folder.asked()
    folder.serve(listing([[21, 20, 19], *PAGES]) | packages(range(8, 22)))
    assert crawl(one, str(tmp_path / "state"), options(folder, limit="9"), today=TODAY) == {"new": 2, "questions": 4}
    assert {u for u in folder.asked() if "/pack/" in u} == {url(21), url(14)}


def test_a_crawl_that_breaks_off_goes_on(spark, tmp_path, folder, monkeypatch):
    """Storing fails in the second batch, then a worker is lost in the third: in the end every page was fetched once."""
    folder.serve(listing(PAGES) | packages(range(8, 21)))
    house, state = Warehouse(spark, str(tmp_path / "house")), str(tmp_path / "state")
    from corpusmill.streaming import ingest

    store, calls = ingest.store_pages, []

    def failing(house, batch, *rest):
        calls.append(len(batch.collect()))
        if len(calls) == 2:
            raise RuntimeError("the driver is lost")
        return store(house, batch, *rest)

    monkeypatch.setattr(ingest, "store_pages", failing)
    with pytest.raises(Exception, match="the driver is lost"):
        crawl(house, state, options(folder), today=TODAY)
    before = folder.asked()
    assert {u for u in before if "/pack/" in u} == {url(i) for i in (20, 19, 18, 17, 16)}
    monkeypatch.setattr(ingest, "store_pages", store)
    crawl(house, state, options(folder), today=TODAY)
    asked = Counter(before + folder.asked())
    assert max(n for u, n in asked.items()) == 1
    assert {u for u in asked if "/pack/" in u} == {url(i) for i in range(8, 21)}
    assert sorted(r.id for r in house.read("packages").collect()) == list(range(8, 21))


def test_a_plan_that_no_batch_was_made_of_is_not_lost(tmp_path, folder):
    folder.serve(listing(PAGES) | packages(range(8, 21)))
    own = options(folder, state=str(tmp_path / "state"))
    first = site.SiteStream(site.Site(own))
    assert first.initialOffset() == {"plan": 0} and first.latestOffset() == {"plan": 1} == first.latestOffset()
    assert sorted(i for p in first.partitions({"plan": 0}, {"plan": 1}) for i, _ in p.value[0]) == [18, 19, 20]
    assert first.latestOffset() == {"plan": 2}
    again = site.SiteStream(site.Site(own))  # the process ended before plan 2 was run
    assert again.latestOffset() == {"plan": 3}
    parts = again.partitions({"plan": 1}, {"plan": 3})
    assert sorted(i for p in parts for i, _ in p.value[0]) == [13, 14, 15, 16, 17]
    rows = [r for p in parts for r in again.read(p)]
    assert sorted(r[0] for r in rows) == [13, 14, 15, 16, 17]
    folder.asked()
    assert [r for p in parts for r in again.read(p)] == rows and folder.asked() == []  # kept until the commit
    again.commit({"plan": 3})
    assert len([r for p in parts for r in again.read(p)]) == 5 and len(folder.asked()) == 5
    while (offset := again.latestOffset()) != {"plan": 5}:
        again.partitions({"plan": offset["plan"] - 1}, offset)
    again.partitions({"plan": 4}, {"plan": 5})
    assert again.latestOffset() == {"plan": 5} == again.latestOffset()
