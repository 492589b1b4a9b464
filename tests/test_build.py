import json
from datetime import date, timedelta

import pytest
from corpusmill import schemas
from corpusmill.operators import curate, funnel
from corpusmill.plans import build
from corpusmill.sources import fetch, pages
from corpusmill.sources.warehouse import MissingWarehouse, Warehouse
from corpusmill.streaming.ingest import PAGES, ingest_stream

TODAY = date(2026, 6, 1)
RECENT, OLD = (TODAY - timedelta(days=5)).isoformat(), (TODAY - timedelta(days=210)).isoformat()
TEXT = "Назовите город, в котором произошли описанные здесь события, номер "


def question(i, **more):
    return {"id": i, "number": i % 10, "text": TEXT + "x" * (i % 7 + 1) + str(i), "answer": f"Ответ {i}", "authors": [{"id": 1, "name": " А  Б "}, "not a person"], "tournaments": [{"id": 5}], "complexity": [50.0], "correct_answers": [4], "source": " книга ", "takenDown": False} | more


def page(i, questions, played=OLD, declared=None):
    pack = {"id": i, "title": f"Пакет {i}", "longTitle": "x", "startDate": played, "endDate": "", "questions": len(questions) if declared is None else declared, "editors": [], "tours": [{"id": 1, "questions": questions}]}
    stream = "12:" + json.dumps({"pack": pack}, ensure_ascii=False, separators=(",", ":"))
    cut = len(stream) // 2
    return "<html>" + "".join(f"<script>self.__next_f.push([1,{json.dumps(s)}])</script>" for s in (stream[:cut], stream[cut:])) + "</html>"


def index(*ids):
    return "".join(f'<a class="x" href="/pack/{i}">p</a>' for i in ids)


class Site:
    """A site in memory that notes what is asked of it; the log is a file, as tasks run in other processes."""

    def __init__(self, log, served, broken=()):
        self.log, self.served, self.broken = str(log), served, broken

    def get(self, url):
        with open(self.log, "a") as f:
            f.write(url + "\n")
        if url in self.broken:
            raise OSError("refused " + "x" * 600)
        return self.served.get(url, "")

    def asked(self):
        with open(self.log) as f:
            out = f.read().split()
        open(self.log, "w").close()
        return out


BASE = pages.BASE_URL


def url(i):
    return f"{BASE}/pack/{i}"


@pytest.fixture
def site(tmp_path):
    (tmp_path / "log").write_text("")
    return Site(tmp_path / "log", {BASE: index(2, 1), url(1): page(1, [question(11), question(12)]), url(2): page(2, [question(21)], RECENT)})


def run(house, site, **more):
    counts = build.build(house, lambda: site, workers=2, today=TODAY, **more)
    assert funnel.violations(house.tables()).collect() == []
    assert (counts.pop("merged"), counts.pop("reprints"), counts.pop("dropped")) == (0, 0, 0)
    return {k: v for k, v in counts.items() if v}


def test_incremental_runs(spark, tmp_path, site):
    house = Warehouse(spark, str(tmp_path / "house"))
    assert run(house, site) == {"new": 2, "questions": 3}
    first = house.read("packages").orderBy("id").collect()
    assert [(p.id, p.title, p.status, p.http_status, p.questions_found, p.played_at_end) for p in first] == [(1, "Пакет 1", "ok", 200, 2, None), (2, "Пакет 2", "ok", 200, 1, None)]
    assert tuple(build.corpus_funnel(house).first()) == (3, 3, 3, 0, 3)
    site.asked()
    before = [sorted(map(str, house.read(t).collect())) for t in ("questions", "questions_canonical", "question_printings")]
    assert run(house, site) == {"unchanged": 1}  # the recent package only
    assert sorted(site.asked()) == sorted([BASE, f"{BASE}/?page=2", url(2)])
    assert before == [sorted(map(str, house.read(t).collect())) for t in ("questions", "questions_canonical", "question_printings")]
    site.served[url(2)] = page(2, [question(22)], RECENT)
    assert run(house, site) == {"updated": 1, "questions": 1}
    assert sorted(r.id for r in house.read("questions").collect()) == [11, 12, 21, 22]  # nothing is deleted
    assert run(house, site, refresh=True) == {"updated": 2, "questions": 3}
    assert run(house, site, pack_ids=[1, 2]) == {"skipped": 1, "unchanged": 1}
    kept = house.read("packages").orderBy("id").first()
    assert kept.first_seen_at == first[0].first_seen_at and kept.fetched_at > first[0].fetched_at


def test_failures_and_recovery(spark, tmp_path, site):
    house = Warehouse(spark, str(tmp_path / "house"))
    site.broken = (url(2),)
    assert run(house, site) == {"new": 1, "fetch_error": 1, "questions": 2}
    p = house.read("packages").filter("id = 2").first()
    assert p.status == "http_error" and len(p.error) == 500 and p.http_status is None and p.page_hash is None
    site.broken = ()
    assert run(house, site) == {"new": 1, "questions": 1}
    site.broken = (url(2),)
    assert run(house, site) == {"fetch_error": 1}
    p = house.read("packages").filter("id = 2").first()
    assert (p.status, p.http_status) == ("http_error", 200) and p.page_hash and house.read("questions").count() == 3
    site.broken = ()
    assert run(house, site) == {"unchanged": 1, "recovered": 1}
    assert house.read("packages").filter("id = 2").first().status == "ok"


def test_bad_pages_do_not_stop_the_crawl(spark, tmp_path, site):
    site.served |= {BASE: index(1, 3, 4, 5, 6), url(3): "<html>no chunks</html>", url(4): page(4, [question(41)], declared=5), url(5): page(5, []), url(6): page(6, [question(6, id="x6")])}
    house = Warehouse(spark, str(tmp_path / "house"))
    assert run(house, site) == {"new": 1, "questions": 2, "parse_error": 3, "empty": 1}
    assert {p.id: p.status for p in house.read("packages").collect()} == {1: "ok", 3: "parse_error", 4: "parse_error", 5: "empty", 6: "parse_error"}
    lines = build.report(house, {"new": 1, "skipped": 0})
    assert "new: 1" in lines and "clean: 2" in lines and "skipped: 0" not in lines


def test_typed_question(spark):
    q = question(7, text=" Блиц.\r\n[Ведущему: тихо] " + TEXT, razdatkaPic="/img/a.png", audio=" ", answerPic="https://z/y", source=None, takenDown=True, complexity="bad", authors=None)
    df = spark.createDataFrame([(1, page(1, [q, question(8, text=" "), {"number": 3}, "no"], declared=2))], "id long, html string")
    parsed = pages.parse(df)
    assert parsed.first().parse_error is None
    a, b = pages.question_rows(parsed).orderBy("position").collect()
    assert (a.kind, a.question, a.host_note) == ("blitz", "Блиц.\n" + TEXT.strip(), "[Ведущему: тихо]")
    assert [tuple(m) for m in a.media_urls] == [("handout", BASE + "/img/a.png"), ("answer", "https://z/y")] and (a.has_media, a.taken_down, a.source_references, a.solve_percentages, a.author_ids) == (1, 1, "", [], [])
    assert b.question == "[Media question; see media URLs]" and b.has_media == 0 and b.author_names == ["А Б"] and b.tournament_ids == [5]
    long = spark.createDataFrame([(1, page(1, [question(1, comment="я" * 300_000)]))], "id long, html string")
    assert pages.question_rows(pages.parse(long)).first().explanation == "я" * 300_000


def test_numbers_that_are_none(spark, monkeypatch):
    """Odd numbers and lists are null or empty; half a surrogate pair is an error of its page alone, whatever it is read with."""
    monkeypatch.setattr(pages, "PAGES_AT_ONCE", 2)
    odd = [question(1, number=2**31, complexity=[1, None, "NaN"], correct_answers=[1.5]), question(2, number=" 7 ", complexity=["x", 1.0], correct_answers=[2**63]), question(3, complexity=[True], correct_answers=[None, 2])]
    df = spark.createDataFrame([(1, page(1, odd)), (2, page(2, [question(4, text="cut \ud83d")])), (3, "none"), (4, None)], "id long, html string").coalesce(1)
    errors = {r.id: r.parse_error for r in pages.parse(df).collect()}
    assert errors == {1: None, 2: "the payload has half a surrogate pair", 3: "no embedded chunks", 4: "no embedded chunks"}
    a, b, c = pages.question_rows(pages.parse(df).filter("parse_error is null")).orderBy("id").collect()
    assert a.question_number is None and a.solve_percentages[:2] == [1.0, None] and a.solve_percentages[2] != a.solve_percentages[2] and a.correct_answers == []
    assert (b.question_number, b.solve_percentages, b.correct_answers) == (7, [], []) and (c.solve_percentages, c.correct_answers) == ([], [None, 2])


def test_index_walk(tmp_path):
    def walk(served, **more):
        (tmp_path / "log").write_text("")
        return fetch.discover(Site(tmp_path / "log", served), **more)

    two = {BASE: index(4, 3), f"{BASE}/?page=2": index(2, 1)}
    assert walk(two) == [4, 3, 2, 1] and walk(two, limit=1) == [4, 3] and walk(two, settled={4, 3}) == []
    assert walk(two, settled={4, 3}, limit=2) == [2, 1] and walk(two, settled={4}) == [3, 2, 1]
    with pytest.raises(fetch.IndexUnavailable):
        walk({})
    assert fetch.page_links(index(42, 7, 42) + '<a href="/pack/42?x=1">a</a><a href="/packs/9">n</a>') == [42, 7]


def test_links_in_columns(spark):
    df = spark.createDataFrame([(1, index(42, 7, 42))], "page int, html string")
    assert [(r.page, r.position, r.id) for r in pages.package_links(df).collect()] == [(1, 0, 42), (1, 1, 7)]


def test_links_of_real_anchors_only(spark):
    html = '<a data-href="/pack/5">x</a><!-- <a href="/pack/6"> --><a\nclass=x href = \'/pack/7\'>y</a><abbr href="/pack/8"><a href="/pack/9x"><!-- <a href="/pack/10">'
    assert fetch.page_links(html) == [7]
    df = spark.createDataFrame([(1, html)], "page int, html string")
    assert [r.id for r in pages.package_links(df).collect()] == [7]


def test_links_against_the_site(spark):
    from corpusmill.functions import values
    from pyspark.sql import functions as F

    cases = {"/x.png": "/x.png", "x.png": "/x.png", "../x.png": "/x.png", "/a/../b/./c.png?q=/../": "/b/c.png?q=/../", "a/..": "/", "./a#../": "/a#../", "/a/b/../../../c": "/c", "/a..b/.c": "/a..b/.c"}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r.u: r.x for r in df.select("u", values.absolute_url(BASE, F.col("u")).alias("x")).collect()}
    assert got == {k: BASE + v for k, v in cases.items()}


def test_rebuild_tells_what_it_merged_and_dropped(spark, tmp_path, site):
    house = Warehouse(spark, str(tmp_path / "house"))
    run(house, site)
    row = dict.fromkeys(schemas.TRANSLATIONS.fieldNames()) | {"question_id": 11, "content_hash": "old", "status": "translated"}
    house.swap({"translations": spark.createDataFrame([tuple(row.values())], schemas.TRANSLATIONS)})
    site.served |= {BASE: index(3, 2, 1), url(3): page(3, [question(31, text=question(11)["text"])])}
    before = house.current()
    counts = build.build(house, lambda: site, workers=2, today=TODAY)
    assert (counts["merged"], counts["reprints"], counts["dropped"]) == (1, 1, 1) and house.read("translations").count() == 0
    assert {"merged records: 1", "reprints: 1", "translations dropped: 1"} <= set(build.report(house, counts))
    assert house.current() != before and house.vacuum() > 0 and house.vacuum() == 0 and house.read("questions").count() == 4


def test_pages_are_stored_in_steps(spark, tmp_path, site, monkeypatch):
    monkeypatch.setattr(build, "BATCH", 1)
    told = []
    counts = build.build(Warehouse(spark, str(tmp_path / "house")), lambda: site, workers=2, today=TODAY, told=lambda *x: told.append(x))
    assert counts["new"] == 2 and [t[:2] for t in told] == [(1, 2), (2, 2)]


def test_charset_of_the_reply():
    assert fetch._decoded("é".encode("latin-1"), "latin-1") == fetch._decoded("é".encode(), None) == fetch._decoded("é".encode(), "no-such") == "é"


def test_warehouse_modes(spark, tmp_path):
    with pytest.raises(MissingWarehouse):
        Warehouse(spark, str(tmp_path / "none"), read_only=True)
    Warehouse(spark, str(tmp_path / "house"))
    reader = Warehouse(spark, str(tmp_path / "house"), read_only=True)
    assert all(reader.read(t).schema == s for t, s in schemas.TABLES.items())
    with pytest.raises(PermissionError):
        reader.swap({})
    reader.views()
    assert spark.sql("SELECT * FROM questions_clean").count() == spark.sql("SELECT * FROM questions_translated").count() == 0


def test_stream_of_pages(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    rows = spark.createDataFrame([(1, 0, page(1, [question(11)]), None), (2, 1, None, "timeout")], PAGES)
    for _ in range(2):  # the second batch brings the same pages again
        rows.write.mode("append").parquet(str(tmp_path / "in"))
        ingest_stream(spark.readStream.schema(PAGES).parquet(str(tmp_path / "in")), house, str(tmp_path / "check")).awaitTermination()
        assert sorted((p.id, p.status) for p in house.read("packages").collect()) == [(1, "ok"), (2, "http_error")]
        assert house.read("questions_canonical").count() == 1
    late = Warehouse(spark, str(tmp_path / "late"))
    ingest_stream(spark.readStream.schema(PAGES).parquet(str(tmp_path / "in")), late, str(tmp_path / "check2"), rebuild_each=False).awaitTermination()
    assert late.read("questions").count() == 1 and late.read("questions_canonical").count() == 0
    assert tuple(build.rebuild(late).first()) == (1, 0, 0, 0)


def test_command_line(spark, tmp_path, site, capsys):
    assert build.main([str(tmp_path / "house"), "--workers", "2"], lambda: site) == 0
    assert "questions: 3" in capsys.readouterr().out
    site.served[BASE] = ""
    assert build.main([str(tmp_path / "house")], lambda: site) == 1


class Reply:
    def __init__(self, body):
        self.body = body

    def read(self):
        return self.body

    def __enter__(self):
        return self

    def __exit__(self, *_):
        pass


def test_http_retries():
    import urllib.error

    slept, answers = [], []

    def opener(request, timeout):
        a = answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return Reply(a)

    error = lambda code, headers=None: urllib.error.HTTPError("u", code, "", headers or {}, None)
    client = fetch.HttpClient(opener=opener, sleep=slept.append, clock=lambda: 0.0)
    answers[:] = [error(503), error(429, {"Retry-After": "7"}), OSError("reset"), b"ok"]
    assert client.get("http://u") == "ok" and slept == [1.0, 7.0, 4.0]
    answers[:] = [error(404)]
    with pytest.raises(urllib.error.HTTPError):
        client.get("http://u")
    answers[:] = [OSError("down")] * 4
    with pytest.raises(OSError):
        client.get("http://u")
    slept.clear()
    polite = fetch.HttpClient(delay=2.0, opener=opener, sleep=slept.append, clock=lambda: 0.0)
    answers[:] = [b"a", b"b"]
    polite.get("http://u"), polite.get("http://u")
    assert slept == [2.0]


def test_no_local_folder_is_used_on_a_cluster():
    """Without a shared folder a session of several machines gets an error, not a folder that its executors can't see."""
    from types import SimpleNamespace

    from corpusmill.staging import shared_folder

    def session(master, folder=None, checkpoint=None):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: folder), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint))

    for master in ("yarn", "local-cluster[2,1,1000]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))
        assert shared_folder(session(master, "hdfs://x/y/")) == "hdfs://x/y" and shared_folder(session(master, checkpoint="hdfs://z")) == "hdfs://z"
    assert shared_folder(session("local[2]")) == shared_folder(session("local")) != ""


def test_rebuild_folds_each_text_once(spark, tmp_path, monkeypatch):
    """Canonical records, printings and groups read one staged table with the key; no step makes it again."""
    made = []
    real = curate.with_key

    def counted(rows, *more, **options):
        out = real(rows, *more, **options)
        if "nhash" not in rows.columns:
            made.append(out)
        return out

    monkeypatch.setattr(curate, "with_key", counted)
    build.rebuild(Warehouse(spark, str(tmp_path / "house")))
    assert len(made) == 1
