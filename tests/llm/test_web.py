"""Revisits and URL words."""

import itertools
import random

from pyspark.sql import functions as F

from deckmill.llm import revisits, url_words

RECORDS = "record_id long, url string, fetched_at long, kind string, etag string, last_modified string, headers map<string,string>, key string, before string"


def records(spark, rows):
    return spark.createDataFrame([(*r, "k", "b") for r in rows], RECORDS)


def test_tracking_parameters_in_a_row(spark):
    rest = {"utm_source=a&utm_medium=b": "", "utm_a=1&utm_b=2&utm_c=3&k=v": "?k=v", "k=v&utm_a=1&utm_b=2": "?k=v",
            "k=v&utm_a=1&utm_b=2&l=w": "?k=v&l=w", "utm_a=1": "", "xutm_a=1": "?xutm_a=1"}
    urls = spark.createDataFrame([(f"http://a.com/x?{q}", f"a.com/x{left}") for q, left in rest.items()], "url string, expected string")
    for row in urls.select(revisits.canonical_url(urls["url"]).alias("key"), "expected").collect():
        assert row["key"] == row["expected"]
    rows = [(0, "https://a.com/x", 1, "response", '"a"', None, None), (1, "https://a.com/x?utm_source=a&utm_medium=b", 2, "revisit", '"a"', None, None)]
    assert [(r["response_id"], r["status"]) for r in revisits.resolve(records(spark, rows)).collect()] == [(0, "resolved")]


def test_revisits(spark):
    rows = [
        (1, "http://A.com:80/x?utm_source=f#t", 10, "response", '"a"', "m1", {"etag": '"a"', "content-length": "9", "date": "1"}),
        (2, "https://a.com/x", 20, "response", '"b"', None, {"content-length": "5"}),
        (3, "https://a.com/x", 15, "revisit", 'W/"a"', None, {"date": "15", "content-length": "0"}),
        (4, "https://a.com/x", 25, "revisit", '"a"', None, None),
        (5, "https://a.com/x", 26, "revisit", None, "m", None),
        (6, "https://a.com/x", 5, "revisit", '"a"', None, None),
        (7, "https://a.com/x", 20, "revisit", '"b"', None, None),  # one time: the lesser id is earlier
        (8, None, 30, "revisit", '"b"', None, None),
        (9, "https://a.com/x", None, "revisit", '"b"', None, None),
        (10, "https://b.com", 1, "response", None, "m", None),
        (11, "https://b.com/", 2, "revisit", None, "m", {"x": "y"}),
        (11, "https://b.com/", 2, "revisit", None, "m", {"x": "y"}),
        (12, "https://b.com/", 3, "request", None, None, None)]
    found = revisits.resolve(records(spark, rows)).collect()
    by_id = {r["record_id"]: (r["response_id"], r["status"]) for r in found}
    assert by_id == {3: (1, "resolved"), 4: (2, "mismatch"), 5: (2, "unverified"), 6: (None, "no_response"), 7: (2, "resolved"),
                     8: (None, "no_response"), 9: (None, "no_response"), 11: (10, "resolved")}
    assert len(found) == 9
    assert next(r for r in found if r["record_id"] == 3)["headers"] == {"etag": '"a"', "content-length": "9", "date": "15"}
    assert revisits.resolve(records(spark, [])).count() == 0


def test_one_url_over_many_partitions(spark):
    """A response, and all its revisits in later partitions."""
    rows = [(0, "http://hot/", 0, "response", '"a"', None, None)] + [(i, "http://hot/", i, "revisit", '"a"', None, None) for i in range(1, 2000)]
    found = revisits.resolve(records(spark, rows).repartition(16)).groupBy("response_id", "status").count().collect()
    assert [tuple(r) for r in found] == [(0, "resolved", 1999)]


def test_rules_and_words(spark):
    words = url_words.word_model({"the": 5000, "shop": 40, "news": 100, "daily": 80}, url_words.LABELLED)
    assert words.split("cheappills") == ["cheap", "pills"] and words.split("dailynews") == ["daily", "news"]
    assert "".join(words.split("qzxvkwj" * 20)) == "qzxvkwj" * 20
    model = url_words.train(words, url_words.LABELLED)
    urls = ["http://x.net/a", "https://EXAMPLE.net/en/1?q", "http://example.net/enx", "http://example.com/de/1", "http://a.example.com/de/", "http://org/fr/2", "http://b.org/fr",
            "https://cheappills.example.org/en/1", "https://www.spam-farm.example.org/#x", "https://dailynews.example.org/en/3", None, "no scheme", "http://", "notexample.com/de/://y/de/"]
    pages = spark.createDataFrame([(i, u, "<p>x", "h", "p", "w") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, path string, found string")
    found = {r["page_id"]: r for r in url_words.judge(pages, model).collect()}
    assert [found[i]["rule"] for i in range(14)] == ["net/", "example.net/en/", "net/", "example.com/de/", "example.com/de/", "org/fr/", *[None] * 8]
    assert [found[i]["verdict"] for i in range(14)] == ["block", "allow", "block", "block", "block", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow", "allow"]
    assert (found[1]["host"], found[1]["path"]) == ("example.net", "/en/1") and (found[10]["host"], found[10]["path"]) == ("", "")
    assert (found[13]["host"], found[13]["path"]) == ("y", "/de/")
    empty = pages.where(F.lit(False))
    assert url_words.word_frequencies(empty) == {} and url_words.judge(empty, model).count() == 0


def test_segmentation_equals_enumeration():
    rng = random.Random(5)
    logs = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))): -rng.random() * 9 for _ in range(40)}
    words = url_words.Words(logs, -11.0, -1.5)

    def log(word):
        return logs.get(word, words.unknown + words.letter * len(word))
    for _ in range(200):
        run = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 10)))
        cuts = [[0, *c, len(run)] for k in range(len(run)) for c in itertools.combinations(range(1, len(run)), k)]
        best = max(sum(log(run[a:b]) for a, b in zip(c, c[1:])) for c in cuts)
        found = words.split(run)
        assert "".join(found) == run and abs(sum(map(log, found)) - best) < 1e-9


def test_words_are_learnt_from_ruled_urls(spark):
    rng = random.Random(2)
    bad, good = ["zorvan", "quilpe", "drastol", "mirkut"], ["falden", "bromis", "tesluk", "wendor"]
    rules = [("net", "/a/", "block"), ("edu", "/", "allow")]

    def url(i, names, ends):
        return f"https://{rng.choice(names)}{rng.choice(names)}{chr(97 + i % 26)}.{ends}/a/{rng.choice(names)}/{i}"
    rows = [(i, url(i, bad, "net") if i % 2 else url(i, good, "edu"), f"<p>{bad[i % 4]} {good[i % 4]}") for i in range(300)]
    rows += [(300 + i, "https://bromiswendor.net/a/", None) for i in range(400)]  # one large site says no more than a small one
    rows += [(900, "https://quilpezorvan.org/", "x"), (901, "https://tesluk-falden.org/mirkut", None), (902, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "word": F.lit("w"), "n": F.lit("n")})
    model = url_words.fit(pages, [], rules)
    verdicts = {r["page_id"]: (r["verdict"], r["words"]) for r in url_words.judge(pages, model, rules).where("page_id >= 900").collect()}
    assert verdicts == {900: ("block", "quilpe zorvan org"), 901: ("allow", "tesluk falden org mirkut"), 902: ("allow", "")}
    assert not {"net", "edu"} & set(model.odds)
    parts = spark.createDataFrame([("b.c.net", "/a/de/f", "b.c", "/de/f"), ("net", "", "", ""), ("", "a/b", "", "a/b"), ("x.net", "/a", "x", "")], "host string, path string, h string, p string")
    cut = url_words.unseen_by_rules(parts["host"], parts["path"], rules)
    assert parts.where((cut[0] != parts["h"]) | (cut[1] != parts["p"])).count() == 0
    two = url_words.unseen_by_rules(parts["host"], parts["path"], [("c.net", "/a/de/", "block")])
    assert [tuple(r) for r in parts.select(*two).collect()] == [("b", "/f"), ("", ""), ("", "a/b"), ("", "")]
    # hosts per word, counted plainly
    want = {}
    for _, u, _ in rows[:-3]:
        host, path = u[8:].split("/a/", 1)
        for word in model.tokens(host[:-4], path):
            if word in model.words.logs:
                want.setdefault(word, (set(), set()))[u.split("/")[2].endswith("edu")].add(host)
    assert url_words.ruled_words(pages, model.words, rules) == {w: (len(b), len(a)) for w, (b, a) in want.items()}
    table = {(r["verdict"], r["by_words"]): r["n"] for r in url_words.agreement(pages.where("page_id < 300"), [], rules).collect()}
    assert sum(n for (rule, own), n in table.items() if rule == own) >= 0.95 * sum(table.values()) > 0
    few = url_words.word_frequencies(pages, most_words=5)
    assert 0 < len(few) <= 5 and min(few.values()) >= 3


def test_tracking_parameters_in_a_row_go_in_operator_and_sql(spark, tmp_path):
    import duckdb

    from deckmill.llm.queries import REVISIT_SQL, op3_revisit_resolution

    urls = ["http://a.org/p", "http://a.org/p?utm_source=a&utm_medium=b", "http://A.org:80/p?utm_a=1&x=2&utm_b=3&utm_c=4#f", "http://a.org/p?x=2", "a.org/?utm_x"]
    rows = [(i, urls[i % len(urls)], f"<p>{i % 7}</p>") for i in range(1, 400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = op3_revisit_resolution(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({REVISIT_SQL})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    assert {r[got.columns.index("url_key")] for r in want} == {"a.org/p", "a.org/p?x=2", "a.org/"}
