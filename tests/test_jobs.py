"""The stages end to end, offline: the network is a dictionary."""

import json

import pytest
from pyspark.sql import functions as F

from lexforge.plans import cli, config, jobs, report
from lexforge.sources import edgar, lexicon, store

HEAD = "".join(f"<th>{h}</th>" for h in edgar.HEADERS)


def member_page(*rows, table_id="constituents", head=HEAD):
    body = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    return f'<table id="{table_id}" class="wikitable"><tr>{head}</tr>{body}</table>'


def member(ticker, cik):
    return (ticker, f"{ticker} Inc", "Energy", "Oil", "Texas", "", cik, "")


def filing(words):
    body = "\n".join(["PART I", "Item 2. Discussion", words * 150, "PART II", "Item 1A. Risk Factors", "risk loss other " * 100, "Item 6. Exhibits", "filler word here " * 300])
    return f"<html><head><title>x</title></head><body><div>{body}</div></body></html>".encode()


@pytest.fixture(scope="module")
def job(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("data")
    (root / "lm_master_dictionary.csv").write_text("Word,Negative,Positive,Uncertainty,Litigious,Strong_Modal,Weak_Modal,Constraining\nRISK,2009,0,0,0,0,0,0\nLOSS,2009,0,0,x,0,0,0\n ,2009,0,0,0,0,0,0\nGAIN,0,2009,0,0,0,0,0\n")
    web = {edgar.MEMBERS_URL: member_page(member("AAA", "0000000001"), member("B.B", ""), member("ZZZ", "")).encode(), edgar.TICKERS_URL: json.dumps({"0": {"cik_str": 2, "ticker": "b-b", "title": "b"}, "1": {"cik_str": 9, "ticker": "dup", "title": "d"}, "10": {"cik_str": 10, "ticker": "DUP", "title": "d"}}).encode()}
    for cik, word in ((1, "gain growth fine "), (2, "loss risk decline ")):
        acc = [f"{cik}-{i}" for i in range(3)]
        block = {"accessionNumber": acc, "form": ["10-Q", "10-Q", "10-K"], "filingDate": ["2020-01-01", "2020-04-01", "2020-02-01"], "reportDate": ["2019-12-31"], "acceptanceDateTime": ["2020-01-01T10:00:00.000Z", "2020-04-01T10:00:00.000Z", "x"], "primaryDocument": ["a.htm", "b.htm", "c.htm"]}
        web[f"https://data.sec.gov/submissions/CIK{cik:010d}.json"] = json.dumps({"cik": str(cik), "filings": {"recent": block, "files": [{"name": f"CIK{cik}-extra.json"}]}}).encode()
        web[f"https://data.sec.gov/submissions/CIK{cik}-extra.json"] = json.dumps({"accessionNumber": [f"{cik}-9"], "form": ["10-Q"], "filingDate": ["2010-01-01"], "reportDate": [], "acceptanceDateTime": [], "primaryDocument": ["z.htm"]}).encode()
        for a, doc in (("0", "a.htm"), ("1", "b.htm")):
            web[f"https://www.sec.gov/Archives/edgar/data/{cik}/{cik}{a}/{doc}"] = filing(word)
    made = jobs.Job(spark, config.Config(root, "me me@example.com", 8, ("10-K", "10-Q"), False, "2016-01-01"), web.__getitem__)
    made.first = made.refresh()
    return made


def test_refresh(job):
    assert job.first["membership"] == {"members": 3, "unresolved": 1}
    assert job.first["download"] == {"new": 4, "skipped": 0, "failed": 0}
    assert job.first["parse"]["parsed"] == 4 and job.first["sections"] == {"ok": 4, "partial": 0, "section_fail": 0}
    assert job.first["score"] == {"processed": 4, "rows_written": 24}
    assert jobs.last_refresh(job.config).endswith("Z")
    members = {r["ticker"]: r["cik"] for r in job.store.read("members").collect()}
    assert members == {"AAA": 1, "B-B": 2, "ZZZ": None}
    row = job.store.read("filings").where("accession = '1-1'").first()
    assert (row["period_of_report"], row["acceptance_dt"], row["parse_status"]) == (None, "2020-04-01T10:00:00Z", "ok")


def test_second_run_changes_nothing(job):
    before = sorted(map(str, job.store.read("scores").collect()))
    again = job.refresh()
    assert again["download"] == {"new": 0, "skipped": 4, "failed": 0} and again["score"]["processed"] == 0
    assert sorted(map(str, job.store.read("scores").collect())) == before
    assert job.score(force=True)["processed"] == 4 and job.store.read("scores").count() == 24


def test_rank_report_and_command_line(job, capsys):
    assert cli.main(["rank"], job) == 0
    out = capsys.readouterr().out
    assert "B-B" in out and out.strip().endswith("2 companies")
    for args in (["status"], ["parse", "--stats"], ["sections", "--stats"], ["score", "--stats"], ["parse", "--force", "--limit", "1"], ["parse", "--samples", "2", "--suspicious"], ["sections", "--samples", "2"], ["sections", "--samples", "2", "--suspicious"], ["sections", "--pick-validation", "8"]):
        assert cli.main(args, job) == 0
    out = capsys.readouterr().out
    assert "PART I" in out and "risk loss other" in out and "word_count_low" in out
    import csv

    with job.config.labels.open(newline="") as f:
        rows = list(csv.DictReader(f))
    assert rows and list(rows[0]) == ["cik", "accession", "filing_date", "risk_factors_start_substring", "risk_factors_end_substring", "mdna_start_substring", "mdna_end_substring", "notes"]
    texts = {(r["accession"], r["section"]): r["text"] for r in job.store.read("texts").collect()}
    for r in rows:
        r["mdna_start_substring"], r["mdna_end_substring"] = texts[r["accession"], "mdna"][:40], "Item 1A"
    with job.config.labels.open("w", newline="") as f:
        writer = csv.DictWriter(f, list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    assert job.validation() == [{"section": "mdna", "labelled": len(rows), "found": len(rows), "start_ok": len(rows), "end_ok": len(rows)}]
    assert cli.main(["sections", "--validate"], job) == 0 and "100%" in capsys.readouterr().out
    data = report.context(*(job.store.read(n) for n in ("scores", "filings", "members")))
    assert [r["ticker"] for r in data["deciles"][10]["mdna"]] == ["B-B"] and [r["ticker"] for r in data["deciles"][1]["mdna"]] == ["AAA"]
    assert len(data["detail"]["AAA"]) == 4 and data["summary"]["mdna"]["n_scored"] == 2
    data["deciles"][10]["mdna"][0]["name"] = "<b>&"
    data["detail"]["AAA"][0]["section"] = "</script>"
    page = report.render(data, "now")
    assert "&lt;b&gt;&amp;" in page and "</script>\"" not in page and page.count("</script>") == 2


def test_server():
    import threading
    import urllib.request

    found = report.server(lambda: "page", port=0)
    threading.Thread(target=found.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{found.server_port}"
    assert urllib.request.urlopen(base).read() == b"page" and urllib.request.urlopen(base + "/ping").read() == b"up"
    found.shutdown()


def test_member_page_rules(spark):
    assert edgar.parse_members(member_page(member("BRK.B", "0001"), ("", *member("X", "")[1:]), ("short",)))[0][0] == "BRK-B"
    assert len(edgar.parse_members(member_page(member("A", ""), table_id="other"))) == 1
    for bad in ("<p>", member_page(head="<th>Other</th>")):
        with pytest.raises(ValueError):
            edgar.parse_members(bad)
    assert edgar.members_frame(spark, member_page(member("A", "x1"))).first()["cik"] is None


def test_tickers_last_wins(spark):
    rows = spark.createDataFrame([(json.dumps({str(i): {"cik_str": i, "ticker": "Dup", "title": ""} for i in range(12)}),)], "json string")
    found = edgar.read_tickers(rows)
    assert [tuple(r) for r in found.collect()] == [("DUP", 11)]
    assert edgar.resolve(found, ["dup", "nope"]) == ({"DUP": 11}, ["NOPE"])


def test_fetch_retries_and_rate():
    tries, slept = [], []

    def get(url, agent):
        tries.append(url)
        if len(tries) < 4:
            raise edgar.Busy("429")
        return b"x"

    assert edgar.fetcher("me", get=get, sleep=slept.append)("u") == b"x" and [s for s in slept if s >= 1] == [2, 4, 8]
    tries[:] = [0] * -10
    with pytest.raises(edgar.Busy):
        edgar.fetcher("me", get=lambda u, a: (_ for _ in ()).throw(edgar.Busy("x")), sleep=lambda s: None)("u")
    clock, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        clock[0] += s

    limiter = edgar.RateLimiter(2, clock=lambda: clock[0], sleep=sleep)
    for _ in range(5):
        limiter.acquire()
    assert clock[0] >= 2


def test_stores(spark, tmp_path):
    s = store.Store(spark, str(tmp_path), buckets=4)
    with pytest.raises(LookupError):
        s.read("scores")
    assert s.ensure().ensure().read("scores").count() == 0
    rows = spark.createDataFrame([("a", "full", "x"), ("a", "mdna", "y")], "accession string, section string, text string")
    s.upsert("texts", rows, ["accession", "section"])
    s.upsert("texts", rows.withColumn("text", F.lit("z")).where("section = 'full'"), ["accession", "section"])
    assert sorted(map(tuple, s.read("texts").collect())) == [("a", "full", "z"), ("a", "mdna", "y")]
    f = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "accession string, form_type string")
    s.append_new("filings", f)
    s.append_new("filings", f.withColumn("form_type", F.lit("later")))
    assert sorted((r["accession"], r["form_type"]) for r in s.read("filings").collect()) == [("a", "1"), ("b", "3")]
    with pytest.raises(ValueError):
        store.require_unique(f, ["accession"])
    with pytest.raises(ValueError):
        s.upsert("texts", rows, ["accession"])
    assert {r["table_name"]: r["n"] for r in s.counts().collect()} == {"filings": 2, "members": 0, "scores": 0}


def test_store_after_random_changes(spark, tmp_path):
    """As a dictionary has it; old folders go and the newest state stays."""
    import random

    rng, want = random.Random(3), {}
    s = store.Store(spark, str(tmp_path), buckets=4).ensure()
    s.FOLDERS = 3
    for step in range(12):
        new = {f"k{rng.randrange(25)}": f"{step}" for _ in range(rng.choice([0, 1, 6]))}
        frame = spark.createDataFrame([(k, v) for k, v in new.items()], "accession string, form_type string")
        if step == 7:
            s.replace("filings", s.read("filings").where("form_type > '2'"))
            want = {k: v for k, v in want.items() if v > "2"}
        elif step % 2:
            s.append_new("filings", frame)
            want = new | want
        else:
            s.upsert("filings", frame)
            want = want | new
        assert {r["accession"]: r["form_type"] for r in s.read("filings").collect()} == want, step
    assert s.clean("filings") > 0 == s.clean("filings")
    assert {r["accession"]: r["form_type"] for r in s.read("filings").collect()} == want


@pytest.mark.parametrize("change", ["replace", "append_new", "upsert"])
def test_store_survives_a_crash_at_every_step(spark, tmp_path, monkeypatch, change):
    """Each step of a change fails once: the table is as before, the same change then succeeds and nothing is lost."""
    root = str(tmp_path)
    old = spark.createDataFrame([(f"k{i}", "old") for i in range(20)], "accession string, form_type string")
    new = spark.createDataFrame([("k3", "new"), ("k30", "new")], "accession string, form_type string")
    store.Store(spark, root, buckets=4).ensure().upsert("filings", old)
    state = lambda: sorted((r["accession"], r["form_type"]) for r in store.Store(spark, root).ensure().read("filings").collect())
    before = state()

    class Crash(Exception):
        pass

    for step in ("stage", "_write", "_commit"):
        for late in (False, True):
            if step == "_commit" and late:
                continue
            s = store.Store(spark, root, buckets=4)
            real = getattr(s, step)

            def broken(*args, real=real, late=late):
                if late:
                    real(*args)
                raise Crash

            setattr(s, step, broken)
            if change == "replace" and step == "stage":
                continue
            with pytest.raises(Crash):
                getattr(s, change)("filings", new)
            assert state() == before, (step, late)
    # a file-system that fails before the rename leaves only a file of another name
    s = store.Store(spark, root, buckets=4)
    number, content = s._manifest("filings")
    stream = s._fs.create(s._path(f"{root}/filings/_new-half"), False)
    stream.write(bytearray(b"{"))
    stream.close()
    assert state() == before
    getattr(s, change)("filings", new)
    kept = {"replace": [], "append_new": before, "upsert": [r for r in before if r[0] != "k3"]}[change]
    added = [("k30", "new")] if change == "append_new" else [("k3", "new"), ("k30", "new")]
    assert state() == sorted(kept + added)
    with pytest.raises(RuntimeError):
        s._commit("filings", number + 1, content)  # a second writer of the same number


def test_a_small_change_writes_its_bucket_alone(spark, tmp_path):
    s = store.Store(spark, str(tmp_path), buckets=16).ensure()
    s.upsert("texts", spark.range(400).selectExpr("cast(id as string) as accession", "'full' as section", "repeat('x', 100) as text"))
    before = s._manifest("texts")[1]["folders"]
    s.upsert("texts", spark.createDataFrame([("7", "full", "y")], "accession string, section string, text string"))
    after = s._manifest("texts")[1]["folders"]
    assert sum(before[b] != after[b] for b in after) == 1 and s.read("texts").count() == 400
    s.append_new("texts", spark.createDataFrame([("7", "full", "z"), ("401", "full", "z")], "accession string, section string, text string"))
    assert s.read("texts").count() == 401 and s.read("texts").where("text = 'y'").count() == 1


def test_one_bad_file_is_an_error_of_its_row(spark, tmp_path):
    import gzip

    from lexforge.sources import raw

    good = gzip.compress(filing("gain growth fine "))
    for name, data in {"1/a/primary.html.gz": good, "1/a/primary.html": b"other", "1/b/primary.html.gz": good[:40], "2/c/primary.html": b"<![foo[x]]>", "2/d/primary.html.gz": b"", "2/e/primary.html": b"<p>\xff\xfe"}.items():
        edgar.write_atomically(tmp_path / name, data)
    chosen = raw.preferred(raw.list_files(spark, str(tmp_path)))
    assert sorted((r["accession"], r["cik"], r["path"].rsplit("/", 1)[1]) for r in chosen.collect())[0] == ("a", 1, "primary.html.gz")
    filings = spark.createDataFrame([(a,) for a in "abcdef"], "accession string")
    got = {r["accession"]: r for r in raw.parsed(raw.contents(spark, str(tmp_path), chosen), filings).collect()}
    assert got["a"]["full"]["status"] == "ok" and got["a"]["error"] is None
    assert {k: r["full"]["status"] for k, r in got.items() if k != "a"} == dict.fromkeys("bcdef", "parse_fail")
    assert "EOF" in got["b"]["error"] and got["c"]["error"] and got["f"]["error"] == "raw_missing"
    raw_files = raw.NAMED_FILES
    try:
        raw.NAMED_FILES = 2
        more = {r["accession"]: r["full"]["status"] for r in raw.parsed(raw.contents(spark, str(tmp_path), chosen), filings).collect()}
    finally:
        raw.NAMED_FILES = raw_files
    assert more == {k: r["full"]["status"] for k, r in got.items()}


def test_raw_missing(spark):
    from lexforge.operators import diagnose

    texts = spark.createDataFrame([("a", "full", "w " * 1200), ("b", "full", "w " * 1200)], "accession string, section string, text string")
    filings = spark.createDataFrame([(1, "a", "10-K"), (1, "b", "10-K")], "cik bigint, accession string, form_type string")
    pieces = spark.createDataFrame([("a", "", "", "raw_missing"), ("b", "r " * 1100, "m " * 1100, None)], "accession string, risk_factors string, mdna string, error string")
    got = {r["accession"]: r for r in diagnose.section_records(diagnose.parse_records(filings, texts), pieces).collect()}
    assert (got["a"]["status"], got["a"]["error"]) == ("section_fail", "raw_missing")
    assert all(got["a"][s]["suspicious_flags"] == ["raw_missing"] and got["a"][s]["status"] == "missing" for s in ("risk_factors", "mdna"))
    assert got["b"]["status"] == "ok" and got["b"]["error"] is None


def test_limit_counts_successes(spark, tmp_path):
    """Filings that fail don't use the limit up."""
    made = jobs.Job(spark, config.Config(tmp_path, "me", 8, ("10-Q",), False, "2016-01-01").ensure())
    rows = []
    for i in range(6):
        folder = made.landing(1, f"f{i}", "sp500")
        edgar.write_atomically(folder / "primary.html", b"<p>short" if i < 3 else filing("gain growth fine "))
        rows.append({"accession": f"f{i}", "cik": 1, "ticker": "T", "form_type": "10-Q", "period_of_report": None, "acceptance_dt": "x", "filing_date": "2020-01-01", "primary_doc": "p", "raw_path": str(folder), "stack": "sp500", "downloaded_at": "now"})
    made.record(rows)
    found = made.parse(limit=2)
    assert (found["parsed"], found["failed"]) == (2, 3)
    assert made.store.read("texts").count() == 2


def test_resolution_of_tickers(spark, tmp_path):
    calls = []

    def fetch(url):
        calls.append(url)
        return json.dumps({"0": {"cik_str": 5, "ticker": "brk-b", "title": ""}}).encode()

    made = jobs.Job(spark, config.Config(tmp_path, "me", 8, ("10-Q",), False, "2016-01-01").ensure(), fetch)
    assert made.resolve([" Brk.b", "none"]) == ({" Brk.b": 5}, ["none"]) == made.resolve([" Brk.b", "none"])
    assert len(calls) == 1 and made.resolve(["BRK-B"], refresh=True)[0] == {"BRK-B": 5} and len(calls) == 2


def test_lexicon_rules(spark):
    wide = spark.createDataFrame([(" Risk ", "2009", "0"), ("Risk", "1", "x"), ("", "1", "1"), ("Gain", None, "-2020")], "Word string, Negative string, Positive string").select("Word", "Negative", "Positive", *(F.lit("0").alias(c) for c in ("Uncertainty", "Litigious", "Strong_Modal", "Weak_Modal", "Constraining")))
    assert sorted(map(tuple, lexicon.from_wide(wide).collect())) == [("gain", "Positive"), ("risk", "Negative")]
    with pytest.raises(ValueError):
        lexicon.from_wide(wide.drop("Positive"))


def test_config(tmp_path, monkeypatch):
    path = tmp_path / "c.yaml"
    path.write_text("paths: {data_root: ./d}\nsec: {user_agent: a, rate_limit_per_sec: '8'}\nuniverse: {form_types: [10-K], include_amendments: false, history_start: 2016-01-01}\n")
    c = config.load(path)
    assert c.data_root == tmp_path / "d" and c.gzip and c.rate_limit == 8 and c.history_start == "2016-01-01" and c.quarterly().form_types == ("10-Q",)
    with pytest.raises(ValueError):
        c.raw("other")
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "none.yaml")
    assert [cli.size_text(n) for n in (0, 1023, 1536, 5 << 30)] == ["0 bytes", "1023 bytes", "1.50 KiB", "5.00 GiB"]
    (tmp_path / ".env").write_text("# x\nexport LEXFORGE_A='b c'\nLEXFORGE_HOME=mine\nno line\n")
    monkeypatch.setenv("LEXFORGE_HOME", "kept")
    monkeypatch.delenv("LEXFORGE_A", raising=False)
    config.load(path)
    import os

    assert os.environ.pop("LEXFORGE_A") == "b c" and os.environ["LEXFORGE_HOME"] == "kept"
