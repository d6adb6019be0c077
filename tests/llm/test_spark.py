"""The operators on frames: odd rows, empty tables, clashing names, and brute force over the small tables."""

import html.parser
import random
import re
import urllib.parse

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexforge.llm import bpe, common, components, decontaminate, language_id, license_scan, ogg, pii, quality, queries, simhash, substring_dedup, url_filter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Ein langer Satz steht hier mit vielen Worten und noch mehr davon. " * 3000


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows."""
    rows = [(1, "one two three. four five", "en", "s", 9), (2, None, None, None, None), (3, "", "en", "s", 0), (4, LONG, "de", "s", len(LONG)), (4, LONG, "de", "s", len(LONG)), (None, "a text without id", "en", "s", 5), (5, "one two three. four five", "en", None, 9), (6, " \n ", "fr", "s", 3)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 0), (4, 0, None), (None, 1, 1), (5, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "viele Worte sind es nicht, aber genug fuer eine Probe dieser Art"), (2, None), (3, "")], "item_id long, text string")


def run(name, docs, labels, benchmark):
    return {
        "dedup": lambda: substring_dedup.deduplicated_documents(docs),
        "language": lambda: language_id.language_of_documents(docs),
        "pii": lambda: pii.private_documents(docs),
        "license": lambda: license_scan.licenses_of_documents(docs),
        "bpe": lambda: bpe.tokens_of_documents(docs),
        "quality": lambda: quality.quality_of_documents(docs, labels),
        "simhash": lambda: simhash.groups_of_documents(docs),
        "ogg": lambda: ogg.media_of_documents(docs),
    }[name]()


NAMES = ["dedup", "language", "pii", "license", "bpe", "quality", "simhash", "ogg"]


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(spark, odd, labels, benchmark, name):
    rows = run(name, odd, labels, benchmark).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, [1, 2, 3, 4, 4, None, 5, 6]))
    twins = [tuple(r) for r in rows if r["doc_id"] == 4]
    assert str(twins[0]) == str(twins[1])
    assert run(name, odd.limit(0), labels.limit(0), benchmark).collect() == []


MADE = ["score", "fp", "lang_pred", "entities", "label", "unit", "key", "pos", "h", "first", "component", "node", "n_tokens", "token_ids", "decoded", "feature", "media", "media_bytes", "removed", "place", "tag", "labels", "spans", "item", "n", "least", "share", "v", "k"]


def test_extra_columns_that_clash(spark, odd, labels, benchmark):
    """Columns that have the name of a result are replaced, others stay; no name is there twice."""
    more = odd.select("*", *(F.lit("mine").alias(c) for c in MADE))
    marks = labels.select("*", *(F.lit("mine").alias(c) for c in ("text", "__label", "k", "t")))
    for name in NAMES:
        assert run(name, more, marks, benchmark).count() == 8
    inner = {
        "bpe": (bpe.encode_texts(more), ["n_tokens", "token_ids", "ids_sha256", "decoded", "decoded_sha256"]),
        "ogg": (ogg.store_texts(more), [n for n, _, _ in ogg.FIELDS]),
        "pii": (pii.surrogates(more, b"k"), ["entities"]),
        "quality": (quality.classify(more, None), ["score"]),
        "dedup": (substring_dedup.remove_repeats(more), ["removed"]),
        "read": (ogg.read_column(ogg.store_texts(more)), ["payload", "feature", "error"]),
    }
    for name, (frame, made) in inner.items():
        assert len(set(frame.columns)) == len(frame.columns), name
        rows = frame.select(*made, "unit", "doc_id").collect()
        assert len(rows) == 8 and {r["unit"] for r in rows} == {"mine"}, name
        assert all(str(r[m]) != "mine" for r in rows for m in made), name
    licenses = license_scan.scan_texts(more)
    assert len(set(licenses.columns)) == len(licenses.columns) and licenses.select("labels").distinct().count() == 1
    with pytest.raises(ValueError):
        bpe.encode_texts(more, text="decoded")
    docs = decontaminate.clean(more, benchmark)
    assert docs.columns == more.columns and docs.count() == 8
    assert simhash.one_of_each_group(more).columns == more.columns


def test_held_out_is_crc32(spark):
    import zlib

    for r in spark.range(200).select("id", common.held_out(F.col("id")).alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1)


def test_training_sample_is_bounded_and_stable(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10).alias("text"), F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("lang"))
    got = common.training_sample(rows, "lang", rows, "text", "doc_id", 40, 10_000, 1)
    assert {k: len(v) for k, v in got.items()} == {"hot": 40, "rare": 40}
    assert got == common.training_sample(rows.repartition(7), "lang", rows.repartition(3), "text", "doc_id", 40, 10_000, 1)
    assert sum(map(len, common.training_sample(rows, "lang", rows, "text", "doc_id", 40, 95, 1)["hot"])) <= 95
    many = rows.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id") % 500))
    assert len(common.training_sample(many, "lang", many, "text", "doc_id", 3, 10_000, 1)) == 500
    longer = rows.withColumn("text", F.repeat(F.lit("y"), 500))
    only = common.training_sample(longer, "lang", longer, "text", "doc_id", 40, 95, 1)
    assert [len(t) for t in only["hot"]] == [95]


# --- dedup -----------------------------------------------------------------------------------------------------------


def brute_runs(pieces, size, words):
    """Starts and ends by the definition, one by one."""
    n, count = len(pieces), lambda i, j: sum(substring_dedup.n_words(p.strip()) for p in pieces[i:j])
    found = set()
    for i in range(n):
        found |= {(i, j) for j in [next((j for j in range(i + size, n + 1) if count(i, j) >= words), None)] if j}
    ends = {j for _, j in found}
    for j in set(range(size, n + 1)) - ends:
        found |= {(i, j) for i in [next((i for i in range(j - size, -1, -1) if count(i, j) >= words), None)] if i is not None}
    return sorted(found) or ([(0, n)] if count(0, n) else [])


def brute_dedup(docs, size, words):
    runs = {}
    for row, (d, t) in enumerate(docs):
        pieces = substring_dedup.units(t or "")
        runs[row] = [(i, j, tuple(p.strip() for p in pieces[i:j])) for i, j in brute_runs(pieces, size, words)] if d is not None else []
    first, out = {}, []
    for row, (d, _) in enumerate(docs):
        for _, _, text in runs[row]:
            first[text] = min(first.get(text, d), d)
    for row, (d, t) in enumerate(docs):
        pieces, seen, gone = substring_dedup.units(t or ""), set(), set()
        for i, j, text in runs[row]:
            gone |= set(range(i, j)) if first[text] != d or text in seen else set()
            seen.add(text)
        out.append((d, "".join(p for k, p in enumerate(pieces) if k not in gone) if gone else t, sorted(gone)))
    return out


@pytest.mark.parametrize(("size", "words"), [(2, 4), (3, 1), (1, 2), (2, 15)])
def test_dedup_by_brute_force(spark, size, words):
    """Short sentences, and sentences that are split; repeated ids of equal and of unlike texts, null ids and texts."""
    rng = random.Random(6)
    pool = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 5))) + "." for _ in range(25)]
    pool += [" ".join(rng.choice(["ab", "cd", "ef", "gh", "éi"]) for _ in range(rng.randrange(10, 50))) + rng.choice([".", "。", "\n"]) for _ in range(9)]
    docs = [(i, " ".join(rng.choice(pool) for _ in range(rng.randrange(0, 12)))) for i in range(40)]
    docs += [docs[3], (3, docs[7][1]), (None, docs[5][1]), (50, None), (51, ""), (52, " \n ")]
    rng.shuffle(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("removed", F.lit("mine"))
    got = [(r["doc_id"], r["text"], r["removed"]) for r in substring_dedup.remove_repeats(frame, size=size, words=words).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_dedup(docs, size, words)))


def test_dedup_query_by_brute_force(spark, sf):
    docs = [tuple(r) for r in common.table(spark, sf, "documents").select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["text"], [int(x) for x in r["removed"].split(",") if x]) for r in queries.queries()["op1_substring_dedup"](spark, sf).collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute_dedup(docs, substring_dedup.SENTENCES, substring_dedup.WORDS)))


def test_passages_of_short_sentences(spark):
    """Every passage of at least so many sentences and words goes, to its ends; texts that never have so many go as copies."""
    short = " ".join(f"Item {i} is in this list." for i in range(10))
    uneven = "One sentence of this passage has as many words as it takes to be a run alone. Yes. No."
    docs = [(1, f"{short} The first goes on in one way."), (2, f"Another begins with its own words. {short}"), (3, uneven + " Then more of the third."), (4, "The fourth has a start. " + uneven + " And an end."), (5, "A b. C d."), (6, "A b. C d."), (7, "A b. C e.")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicated_documents(frame).collect()}
    assert got == {**dict(docs), 2: "Another begins with its own words. ", 4: "The fourth has a start. And an end.", 6: ""}


def test_passages_of_all_scripts(spark):
    """Copies of one long sentence, passages in it, and in scripts with other stops or without spaces."""
    rng = random.Random(9)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    letters = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n))
    one, inside, han, lines = words(60), words(120), "".join(letters(18) + "。" for _ in range(4)), "।".join(words(9) for _ in range(3)) + "।"
    docs = [(1, one), (2, one), (3, f"{words(30)} {inside} {words(30)}"), (4, f"{words(40)} {inside} {words(20)}"), (5, han + letters(30)), (6, letters(25) + "。" + han), (7, lines + words(8)), (8, words(8) + "।" + lines), (9, letters(200)), (10, words(9))]
    docs.append((11, docs[8][1]))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring_dedup.deduplicated_documents(frame).collect()}
    old = dict(docs)
    assert all(got[d] == old[d] for d in (1, 3, 5, 7, 9, 10))
    assert got[2] == "" and got[11] == ""
    assert got[6] == old[6][:26] and got[8] == old[8].split("।")[0] + "।"
    left = got[4].split()
    assert left[:38] == old[4].split()[:38] and left[-18:] == old[4].split()[-18:] and len(left) < 60 + 40
    for t in [*old.values(), "Ja. Nein!\u2028Ο.", "", " ", "。。a", "x" * 500]:
        assert "".join(substring_dedup.units(t)) == t


# --- components and SimHash ------------------------------------------------------------------------------------------


def union(pairs):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("pairs", [[], [(1, 1)], [(1, 2), (2, 1), (1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 200)], "random"])
def test_components(spark, pairs):
    if pairs == "random":
        rng = random.Random(8)
        pairs = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    edges = spark.createDataFrame([*pairs, (None, 5), (7, None)], "a long, b long")
    got = {r["node"]: r["component"] for r in components.connected_components(edges).collect()}
    assert got == union([p for p in pairs if p[0] != p[1]])


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_links_by_brute_force(spark, parts):
    rng = np.random.default_rng(3)
    fps = {0, 2**64 - 1}
    for f in rng.integers(0, 2**63, 60, dtype=np.uint64).tolist():
        for _ in range(4):
            g = f
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                g ^= 1 << int(b)
            fps.add(g)
    fps = sorted(fps)
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 3}
    frame = spark.createDataFrame([(simhash.signed(f),) for f in fps], "fp long")
    got = {tuple(sorted((r["a"] % 2**64, r["b"] % 2**64))) for r in simhash.links(frame, parts=parts).collect()}
    assert got == want


def test_simhash_query_by_brute_force(spark, sf):
    docs = common.table(spark, sf, "documents")
    rows = docs.select("doc_id", "text").collect()
    fp = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in rows}
    ids = sorted(fp)
    pairs = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fp[a] ^ fp[b]).bit_count() <= 3]
    root = union(pairs)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.queries()["op8_simhash"](spark, sf).collect()}
    assert got == {i: (f"{fp[i]:016x}", root.get(i, i)) for i in ids}
    kept = sorted(r["doc_id"] for r in simhash.one_of_each_group(docs).collect())
    assert kept == sorted({root.get(i, i) for i in ids})


def test_one_of_each_group_with_odd_rows(spark, odd):
    got = sorted(str(r["doc_id"]) for r in simhash.one_of_each_group(odd).collect())
    assert got == sorted(["1", "2", "4", "None"])


def test_one_of_each_group_with_repeated_ids(spark):
    a, b = "some words of the first text that nobody else has written", "quite another passage about rivers, hills and the sea"
    for rows in ([(1, a), (1, b), (2, b)], [(1, b), (1, a), (2, b)], [(2, a), (1, b), (1, a)], [(1, a), (1, a), (1, b)]):
        got = simhash.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert sorted(r["text"] for r in got) == sorted((a, b)), rows


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_simhash_broadcasts_no_table_that_grows(spark, sf):
    """Every table of this size passes for small, as larger ones did by their files' sizes; only heavy keys may be broadcast."""
    docs = common.table(spark, sf, "documents")
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "10485760b"
    fps = spark.createDataFrame([(i,) for i in range(40)], "fp long")
    assert "Broadcast" not in planned(simhash.links(fps))
    rows = simhash.fingerprints(docs)
    assert "Join" not in planned(simhash.least_of_components(rows, "doc_id"))
    assert len(set(re.findall(r"BroadcastExchange.*?plan_id=(\d+)", planned(simhash.groups_of_documents(docs))))) == 2


def test_one_of_each_group_broadcasts_nothing(spark, sf):
    docs = common.table(spark, sf, "documents")
    assert "Broadcast" not in planned(simhash.one_of_each_group(docs))

# --- urls ------------------------------------------------------------------------------------------------------------

PAGES = [
    (1, "https://www.EXAMPLE.com/en/a?x#y", None), (2, "http://example.com/en/", ""), (3, "http://m.example.com/en", ""), (4, None, "<p>"), (5, "no url", None), (6, "ftp://host.net/es/1", None), (7, "http://a.org/x", "<link rel='canonical' href='http://host.net/es/2'>"),
    (8, "http://b.org/y", '<meta http-equiv="refresh" content="0; url=http://a.org/x">'), (9, "http://c.org/z", '<LINK href="//shop.com/q" rel=canonical>'), (10, "http://d.org/", '<link rel="canonical" href="http://c.org/z"><meta http-equiv=refresh content="1;URL=http://b.org/y">'), (11, "http://e.org/", "<link rel='canonical' href='/other'>"), (12, "https://b.org/y#again", None), (13, "http://.net/fr/", None), (14, "http://x.org", None), (14, "http://x.org", None),
    (15, "http://rel.org/d/a", "<link rel=canonical href='../e/./b?q'>"), (16, "http://rel.org/e/b?q", "<link rel='canonical' href='http://host.net/es/rel'>"), (17, "http://own.org/", "<link rel='canonical' href='/go?u=http://bad.net/es/q'>"), (18, "http://cm.org/", "<!-- <link rel='canonical' href='http://host.net/es/2'> --><script>'<link rel=canonical href=http://host.net/es/2>'</script>"),
    (19, "http://two.org/", "<link rel=canonical href='http://nowhere.org/'><link rel='alternate canonical' href='http://a.org/x?a=1&amp;b=2'>"), (20, "http://a.org/x?a=1&b=2", "<link rel=canonical href='http&#58;//host.net&#x2F;es/2'>"), (1, "http://t.net/es/again", None), (None, "http://t.net/fr/null", None),
]


class LinkReader(html.parser.HTMLParser):
    """The canonical links and refreshes of a page."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        got = dict(reversed(attrs))
        if tag == "link" and "canonical" in (got.get("rel") or "").lower().split():
            self.found.append(got.get("href") or "")
        elif tag == "meta" and (got.get("http-equiv") or "").lower() == "refresh" and (m := re.match(r"[^;,]*[;,]\s*url\s*=\s*[\"']?([^\"']*)", got.get("content") or "", re.I)):
            self.found.append(m[1])


def plain_verdicts(pages, rules):
    """Rules one by one, links by html.parser and urljoin, components by union-find."""

    def cut(url):
        if url is None or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1].split("#")[0]
        host, path = re.match(r"([^/?]*)([^?]*)", rest).groups()
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        return low, path, (low + rest[len(host) :] if low else None)

    def fit(host, path):
        found = [(len(h) + len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(found)[1:] if found else (None, None)

    pairs = []
    for _, url, page in pages:
        if cut(url)[2] and page:
            reader = LinkReader()
            reader.feed(page)
            reader.close()
            for to in map(str.strip, reader.found):
                if to and not to.startswith("#") and (node := cut(urllib.parse.urljoin(url, to))[2]):
                    pairs.append((cut(url)[2], node))
    root = union([p for p in pairs if p[0] != p[1]])
    said = {}
    for node, r in root.items():
        said.setdefault(r, set()).add(fit(*re.match(r"([^/?]*)([^?]*)", node).groups())[1])
    out = []
    for i, url, _ in pages:
        host, path, node = cut(url)
        rule, verdict = fit(host, path)
        of = said.get(root.get(node), set())
        out.append((i, host, path, rule, verdict or ("allow" if "allow" in of else "block" if "block" in of else "allow")))
    return sorted(map(str, out))


def random_pages(n, seed=12):
    rng = random.Random(seed)
    hosts = ["a.org", "B.org", "c.d.org", "x.net", "shop.com", "www.example.com", "example.com", "net"]
    path = lambda: rng.choice(["", "/", "/en/", "/es/", "/fr/", "/en/a", "/es/b/", "/d/e/f", "/q/x.html"]) + rng.choice(["", "", str(rng.randrange(60))])
    url = lambda: rng.choice(["http", "https"]) + "://" + rng.choice(hosts) + path() + rng.choice(["", "", "?k=%d" % rng.randrange(3)]) + rng.choice(["", "#f"])
    relative = lambda: rng.choice(["b", "../x", "./y", "?q", "../../z/", ".", "..", "e/../f", "/en/../es/1", "//x.net/es/2", "#top", "", "mailto:a@b", "/go?u=http://x.net/es/3", "g/./h/", "?a=1&amp;b=2", "s&#47;t"])
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(3)):
            to, q = rng.choice([url, relative])(), rng.choice("\"'")
            rel = rng.choice(["canonical", "Canonical", "alternate canonical", "stylesheet", "canonical-not"])
            link = rng.choice([f"<link rel={q}{rel}{q} href={q}{to}{q}>", f"<LINK href={q}{to}{q} data-x={q}1{q} rel={q}{rel}{q} />", f"<meta http-equiv={q}refresh{q} content={q}{rng.choice(['0; url=', '5;URL=', '3, url = '])}{to}{q}>", f"<link rel={q}canonical{q} data-href={q}http://x.net/es/9{q} href={q}{to}{q}>"])
            parts.append(rng.choice([link, link, link, f"<!-- {link} -->", f"<script>{link}</script>", f"<p>{link}</p>"]))
        out.append((rng.choice([i, i, 7, None]), rng.choice([url(), url(), url(), None, "no url"]), rng.choice(["".join(parts), "".join(parts), None])))
    return out


def test_url_rules_and_aliases(spark):
    pages = spark.createDataFrame(PAGES[:-2], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.verdicts_of_pages(pages).collect()}
    assert got[1] == ("www.example.com/en/", "allow") and got[2] == ("example.com/en/", "block") and got[3] == ("com/", "allow")
    assert got[4] == (None, "allow") == got[5] and got[6] == ("net/es/", "block") and got[13] == ("net/fr/", "block")
    assert got[7] == got[8] == got[12] == (None, "allow")  # 10 joins their component with an allowed alias
    assert got[9] == got[10] == (None, "allow") and got[11] == (None, "allow")
    assert got[15] == got[16] == (None, "block") and got[17] == got[18] == (None, "allow")
    without = pages.where("page_id not in (9, 10)")
    blocked = {r["page_id"]: r["verdict"] for r in url_filter.verdicts_of_pages(without).collect()}
    assert blocked[7] == blocked[8] == blocked[12] == blocked[19] == blocked[20] == "block" and blocked[11] == "allow"
    extra = spark.createDataFrame([("http://x.org", "http://host.net/es/9")], "from_url string, to_url string")
    assert {r["verdict"] for r in url_filter.judge(without, redirects=extra).where("page_id = 14").collect()} == {"block"}
    assert url_filter.verdicts_of_pages(pages.limit(0)).collect() == []


@pytest.mark.parametrize("pages", [PAGES, random_pages(1000)], ids=["given", "random"])
def test_urls_by_brute_force(spark, pages):
    """Also with a long list of rules, with repeated and null page ids, with clashing columns, and as SQL."""
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").select("*", *(F.lit("mine").alias(c) for c in ("host", "rule", "node", "h", "salt", "tag", "to")))
    text = lambda rows: sorted(str(tuple(r)) for r in rows)
    want = plain_verdicts(pages, url_filter.RULES)
    assert text(url_filter.verdicts_of_pages(frame).collect()) == want
    many = url_filter.RULES + [(f"h{i}.test", "/", "block") for i in range(url_filter.INLINE)]
    assert text(url_filter.judge(frame, many).collect()) == want
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", pages)
    assert text(con.execute(url_filter.oracle()).fetchall()) == want


def test_url_plan_is_native(spark, sf):
    plan = queries.queries()["op4_url_filter"](spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- whole queries ---------------------------------------------------------------------------------------------------


def test_language_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()["op2_language_id"](spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*")).first()
    assert right / n > 0.95


def test_quality_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()["op7_quality"](spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out")
    right, n = got.agg(F.count_if(F.col("predicted") == F.col("quality")), F.count("*")).first()
    assert right / n > 0.9


def test_pii_is_consistent_over_documents(spark, sf):
    rows = queries.queries()["op3_pii_surrogates"](spark, sf)
    text = common.table(spark, sf, "documents").select("doc_id", F.col("text").alias("old"))
    found = rows.join(text, "doc_id").select("old", F.explode("entities").alias("e")).select(F.col("e.kind").alias("kind"), F.expr("substring(old, e.start + 1, e.end - e.start)").alias("original"), F.col("e.surrogate").alias("surrogate"))
    assert pii.collisions(found).count() == 0
    assert found.groupBy("kind", "original").agg(F.countDistinct("surrogate").alias("n")).where("n > 1").count() == 0
    same = rows.join(text, "doc_id").where("n_entities = 0 and not (text <=> old)")
    assert same.count() == 0


def test_decontamination_finds_passages(spark, sf):
    items = {r["item_id"]: r["text"] for r in common.table(spark, sf, "benchmark").collect()}
    docs = {r["doc_id"]: r["text"] for r in common.table(spark, sf, "documents").collect()}
    found = queries.queries()["op9_decontamination"](spark, sf).collect()
    want = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
    assert want <= {(r["doc_id"], r["item_id"]) for r in found}
    for r in found:
        if (r["doc_id"], r["item_id"]) in want:
            assert r["edits"] == 0 and items[r["item_id"]].strip(". ") in docs[r["doc_id"]][r["start_char"] : r["end_char"] + 2]


def test_decontamination_in_blocks(spark, sf, monkeypatch):
    docs, benchmark = common.table(spark, sf, "documents"), common.table(spark, sf, "benchmark")
    whole = sorted(map(tuple, decontaminate.matches(docs, benchmark).collect()))
    kept = decontaminate.clean(docs, benchmark).count()
    monkeypatch.setattr(decontaminate, "BLOCK_SYMBOLS", 2500)
    assert len(list(decontaminate.indexes(benchmark))) > 1
    assert sorted(map(tuple, decontaminate.matches(docs, benchmark).collect())) == whole
    assert decontaminate.clean(docs, benchmark).count() == kept == docs.count() - len({r[0] for r in whole})
    assert decontaminate.matches(docs, benchmark.limit(0)).collect() == []


def test_decontamination_of_odd_rows(spark, odd):
    """Null texts and ids, repeated rows, ids of other types, clashing columns, short and empty items."""
    more = odd.select("*", *(F.lit("mine").alias(c) for c in ("item_id", "edits", "block", "index", "start_char")))
    items = spark.createDataFrame([("x", "FOUR five"), ("x", "FOUR five"), ("y", "four five"), (None, "id"), ("z", None), ("e", "..."), ("l", LONG[:1000])], "item_id string, text string")
    got = sorted(str((r["doc_id"], r["item_id"], r["edits"])) for r in decontaminate.matches(more, items).collect())
    assert got == sorted(str(x) for x in [(1, "x", 0), (1, "y", 0), (5, "x", 0), (5, "y", 0), (None, None, 0), (4, "l", 0), (4, "l", 0)])
    left = decontaminate.clean(more, items)
    assert left.columns == more.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 3, 6]
    assert decontaminate.matches(more.limit(0), items).collect() == [] == decontaminate.matches(more, items.limit(0)).collect()


def test_read_column(spark):
    files = ogg.store_texts(spark.createDataFrame([(1, "abc"), (2, None)], "id long, text string")).select("id", "media")
    files = files.unionByName(spark.createDataFrame([(3, bytearray(b"no")), (4, None)], "id long, media binary"))
    got = {r["id"]: r for r in ogg.read_column(files).collect()}
    assert got[1]["payload"] == b"abc" and got[2]["payload"] == b"" and got[3]["payload"] is None and got[3]["error"] and got[4]["error"]


def test_pipeline(spark, sf, odd):
    docs = common.table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "simhash", "decontamination", "pii", "bpe"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0 < docs.count() <= before, name
    want = {r["doc_id"]: bpe.tokenizer(bpe.word_bpe_path()).encode(r["text"]) for r in docs.collect()}
    got = {r["doc_id"]: r["token_ids"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, sf).collect()
        assert stage(spark, odd.limit(0), sf).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    found, want = queries.queries()[name](spark, sf), con.sql(queries.oracle_sql()[name])
    columns = sorted(want.columns)
    assert columns == sorted(found.columns)
    pick = lambda row, names: str(tuple(row[names.index(c)] for c in columns))
    assert sorted(pick(r, found.columns) for r in found.collect()) == sorted(pick(r, want.columns) for r in want.fetchall())
