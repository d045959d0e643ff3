"""Golden tables for the scalar functions, screens and the verdict."""

import re
from urllib.parse import quote, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from deckmill import fixed_values as fv
from deckmill.config import DeliveryRules, IntegrityRules
from deckmill.functions import names, urls
from deckmill.functions import records as rc
from deckmill.functions import text as tx
from deckmill.operators import batches, integrity, numbering, policy, quality, records, screens, verdict


def column(spark, values, build, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r.o for r in df.withColumn("o", build(F.col("v"))).orderBy("i").collect()]


URLS = ["http://A.example.org:8080/x.pptx?y=1#z", "https://user:pw@www.b.org", "//c.net/p", "mailto:a@b", "", "http:///nohost", "ftp://www.w.www.d/", "relative/x"]


def test_authority_is_the_parsed_netloc(spark):
    assert column(spark, URLS, urls.authority) == [urlparse(u).netloc.lower() for u in URLS]
    assert column(spark, URLS, lambda u: urls.authority(u, lower=False)) == [urlparse(u).netloc for u in URLS]


def test_display_host_strips_a_run(spark):
    want = [urlparse(u).netloc.lower().split(":")[0].lstrip("www.") or "unknown" for u in URLS]
    assert column(spark, URLS, urls.display_host) == want


BASE = ["http://h.org/a/b/c.html?q=1#f", "https://h.org", "http://h.org/a/"]
REFS = ["x.pptx", "/x.pptx", "../x.pptx", "../../../x", "./y/../z", "//o.net/x", "http://o.net/q", "?n=2", "#top", "", "a/b/./c?d#e", "..", "y/.."]


@pytest.mark.parametrize("base", BASE)
def test_resolve_url_follows_urljoin(spark, base):
    assert column(spark, REFS, lambda r: urls.resolve_url(F.lit(base), r)) == [urljoin(base, r) for r in REFS]


def test_names(spark):
    raw = ["a.pptx", ".hidden", "noext", "a.", "x.tar.gz", "ü b.PPT", "..pptx"]
    assert column(spark, raw, names.suffix) == [".pptx", "", "", "", ".gz", ".PPT", ".pptx"]
    assert column(spark, ["é ñ/x-1.y"], lambda c: names.title_slug(c, 80)) == [re.sub(r"[^\w\-]", "_", "é ñ/x-1.y")]
    assert column(spark, ["http://h/a%20ü b.pptx?x", "http://h/", "http://h/doc"], lambda u: names.tagged_name(u, True)) == [
        *column(spark, ["http://h/a%20ü b.pptx?x"], lambda u: F.concat(urls.url_tag(u), F.lit("_a_20ü_b.pptx"))),
        *column(spark, ["http://h/"], lambda u: F.concat(urls.url_tag(u), F.lit("_file.pptx"))), None]
    assert column(spark, ["0123456789_x", "short_x", "noscore"], names.tag_of_name) == ["0123456789", None, None]
    assert column(spark, [5, 1234567], lambda c: names.zero_padded(c, 6), "v int") == ["000005", "1234567"]
    assert column(spark, ["  <a>:b__c. .PDF"], names.legacy_safe_name) == ["a_b_c. .pptx"]
    assert column(spark, ["p?a=1.ppt", "x%2Eppt", "+.PPT?z"], lambda c: urls.deck_extension(c, unquote=True)) == [".pptx", ".ppt", ".ppt"]


def test_quoting(spark):
    raw = ["a b*~é/+.pptx", "x_.-"]
    assert column(spark, raw, records.quote_path) == [quote(r, safe="") for r in raw]


TEXTS = ["mail a@b.co, c.d@e-f.org and g@h.museum", "ssn 123-45-6789 x", "+1 555 123 4567, (030) 1234-5678, 555.123.4567 0123 456 789", "", "none",
         "12-34", "call 1234567890123456789012345"]


def test_personal_data_counts(spark):
    for pattern, flags in ((fv.EMAIL_PATTERN, re.I), (fv.PHONE_PATTERN, 0), (fv.SSN_PATTERN, 0)):
        assert column(spark, TEXTS, lambda c, p=pattern: tx.pattern_count(c, p)) == [len(re.findall(pattern, t, flags)) for t in TEXTS]
    df = screens.screen_personal_data(spark.createDataFrame([(TEXTS[0],), (TEXTS[1],)], "text string"), "text").collect()
    assert [r.pii_detail for r in df] == ["3 email addresses", "1 SSN-like patterns"]


def test_english_rule(spark):
    texts = ["see the end", "ein zwei drei", "one two three four five six", "naïve", "", "a b c d e", "x the"]
    def want(t):
        if any(m in t for m in fv.ENGLISH_MARKERS):
            return True
        return not re.search(r"[^\x00-\x7F]", t) and len(t.split()) <= 5
    assert column(spark, texts, tx.looks_english) == [want(t) for t in texts]


def test_keyword_hits_sorted(spark):
    assert column(spark, ["top secret and internal only", "x"], lambda c: F.array_join(tx.keyword_hits(c, fv.PROHIBITED_KEYWORDS), ",")) == [
        "internal only,top secret", ""]


def test_robots_modes(spark):
    texts = ["Disallow: /", "Disallow: /\nAllow: /a", "Disallow:", None, "User-agent: *\nDisallow: /private"]
    assert column(spark, texts, policy.robots_denies) == [True, False, False, False, True]
    assert not any(column(spark, texts, lambda c: policy.robots_denies(c, "reference")))


def test_bounded_concat_stops_after_the_limit(spark):
    got = column(spark, [["aaaa", "bb", "cc"], ["united ", "states"]], lambda c: tx.bounded_concat(c, 4), "v array<string>")
    assert got == ["aaaabb", "united "]
    assert column(spark, [["the united ", "states"]], lambda c: screens.topical_hits(c, ["united states"]), "v array<string>") == [1]


def test_policy_defaults_and_port(spark):
    p = policy.DomainPolicy()
    hosts = ["https://cs.mit.edu", "https://x.gov", "https://x.gov:80", "https://uni.edu", "https://ok.org", "no-host"]
    assert column(spark, hosts, lambda u: policy.block_reason(u, p)) == ["institution", "tld", None, "edu", None, None]
    assert column(spark, hosts, lambda u: policy.block_reason(u, p, strip_port=True))[2] == "tld"
    relaxed = policy.DomainPolicy(exclude_us=False, pirate=("ok.org",))
    assert column(spark, hosts, lambda u: policy.block_reason(u, relaxed)) == [None, None, None, None, "pirate", None]


def test_integrity_first_reason(spark):
    rows = [(10, "h", False, ".pptx", "", 9), (6000, "h", True, ".pptx", "bad", 9), (6000, "h", False, ".pdf", "", 9), (6000, "h", False, ".pptx", "bad", 9),
            (6000, "h", False, ".pptx", "", 4), (6000, "h", False, ".PPTX", "", 5), (6000, "h", False, ".ppt", "", 99)]
    df = spark.createDataFrame(rows, "file_size int, file_hash string, is_html boolean, extension string, container_reason string, slide_count int")
    got = [r.validation for r in integrity.validate(df, IntegrityRules(max_slides=50)).collect()]
    assert [g.rejection_reason for g in got] == [
        "Below min size (10 < 5120B)", "HTML content detected (likely error page)", "Unsupported format: .pdf", "bad", "Insufficient slides (4 < 5)", "",
        "Exceeds max slides (99 > 50)"]
    assert [g.is_valid for g in got] == [False] * 5 + [True, False]
    assert [g.file_hash for g in got] == [""] + ["h"] * 6 and [g.slide_count for g in got] == [0, 0, 0, 0, 4, 5, 99]


def test_tier_edges(spark):
    rows = [(0, 0, 0, 0, 0.0, 0.0, 0.0, 9), (4, 2, 1, 2, 0.5, 0.0, 0.0, 0), (4, 2, 1, 1, 0.5, 0.0, 0.0, 0), (4, 2, 0, 0, 0.5, 0.0, 0.0, 3), (5, 1, 1, 0, 0.2, 0.0, 0.0, 0),
            (5, 1, 0, 0, 0.2, 0.0, 0.0, 0), (4, 1, 9, 9, 0.9, 0.75, 0.0, 9), (4, 1, 9, 9, 0.9, 0.0, 0.5, 9)]
    df = spark.createDataFrame(rows, "slide_count int, analytical_slides int, slides_with_chart int, diagram_slides int, analytical_pct double, "
                                     "text_heavy_pct double, photo_heavy_pct double, charts int")
    got = [r.quality_classification for r in quality.with_tier(df, "charts").collect()]
    assert got == ["LOW", "HIGH", "MEDIUM", "HIGH", "MEDIUM", "LOW", "LOW", "LOW"]
    assert column(spark, [2_000_000, 2_000_001], quality.legacy_tier, "v int") == ["LOW", "MEDIUM"]


def test_text_length_edges(spark):
    df = spark.createDataFrame([(100, "<p:pic"), (99, "<p:pic"), (500, "x"), (501, "x"), (501, "chart")], "text_length int, xml string").withColumns(
        {"has_table": F.lit(False), "parsed": F.lit(True)})
    got = quality.slide_flags(df).collect()
    assert [r.is_photo_heavy for r in got] == [False, True, False, False, False]
    assert [r.is_text_heavy for r in got] == [False, False, False, True, False]


def verdict_row(spark, **change):
    base = dict(valid=True, reason="", source_url="u", pirate_site="PASS", robots_txt="PASS", third_party_rights="PASS", personal_data="PASS",
                coppa_screening="PASS", prohibited_content="PASS", public_source="PASS", quality_classification="HIGH", reasoning_score=1.0)
    base.update(change)
    df = spark.createDataFrame([tuple(base.values())], ", ".join(
        f"{k} {'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'string'}" for k, v in base.items()))
    df = df.withColumn("validation", F.struct(F.col("valid").alias("is_valid"), F.col("reason").alias("rejection_reason")))
    df = df.withColumns({f"{c}_detail": F.when(F.col(c) == "FAIL", "why") for c, _ in verdict.HARD_CHECKS})
    return df.withColumn("quality_summary", F.lit("LOW: x"))


@pytest.mark.parametrize("change,decision,reasons,pending", [
    ({}, "DELIVER", [], 0),
    ({"valid": False, "reason": "r"}, "REJECT", ["Integrity: r"], 10),
    ({"source_url": ""}, "REVIEW", ["Missing source URL"], 0),
    ({"pirate_site": "FAIL", "coppa_screening": "FAIL"}, "REJECT", ["pirate_site: why"], 2),
    ({"coppa_screening": "FAIL", "source_url": ""}, "REJECT", ["Missing source URL", "coppa_screening: why"], 2),
    ({"prohibited_content": "FAIL"}, "REJECT", ["prohibited_content: why"], 2),
    ({"robots_txt": "REVIEW"}, "REVIEW", [], 0),
    ({"personal_data": "REVIEW"}, "REVIEW", [], 0),
    ({"public_source": "FAIL"}, "DELIVER", [], 0),
    ({"quality_classification": "LOW"}, "REJECT", ["Quality: LOW (LOW: x)"], 0),
    ({"quality_classification": "MEDIUM", "reasoning_score": 0.29}, "REVIEW", [], 0),
    ({"quality_classification": "HIGH", "reasoning_score": 0.0}, "DELIVER", [], 0),
])
def test_verdict_truth_table(spark, change, decision, reasons, pending):
    r = verdict.verify(verdict_row(spark, **change)).first()
    assert r.decision == decision and r.rejection_reasons == reasons
    assert sum(r[s] == "PENDING" for s in verdict.STAGES) == pending
    assert r.all_stages_pass == (decision == "DELIVER" and r.public_availability == "PASS")


def test_verdict_options(spark):
    assert verdict.verify(verdict_row(spark, quality_classification="LOW", reasoning_score=0.0), skip_quality=True).first().decision == "DELIVER"
    assert verdict.verify(verdict_row(spark, public_source="FAIL"), strict_public=True).first().decision == "REJECT"


@pytest.mark.parametrize("high,medium,size,want", [(0, 5, 500, (0, 0)), (7, 10, 500, (7, 3)), (10, 10, 6, (10, 4))])
def test_compose(spark, high, medium, size, want):
    rows = [("HIGH", f"h{i:02d}") for i in range(high)] + [("MEDIUM", f"m{i:02d}") for i in range(medium)] + [("LOW", "l")]
    df = spark.createDataFrame(rows, "quality_classification string, path string").withColumn("delivery_status", F.lit("DELIVER"))
    got = batches.compose(df, ["path"], DeliveryRules(batch_size=size)).orderBy("seq").collect()
    assert (sum(r.quality_classification == "HIGH" for r in got), sum(r.quality_classification == "MEDIUM" for r in got)) == want
    assert [r.seq for r in got] == list(range(1, sum(want) + 1))
    assert [r.batch_no for r in got] == [(i // size) + 1 for i in range(sum(want))]


def test_named_files_keep_their_name(spark):
    df = spark.createDataFrame([("BATCH_02_names_7.PPTX",), ("b.PPT",), ("noext",)], "name string")
    got = {r.name: r.dest_name for r in numbering.batch_names(df, "BATCH_02", ["name"], 7).collect()}
    assert got == {"BATCH_02_names_7.PPTX": "BATCH_02_names_7.PPTX", "b.PPT": "BATCH_02_names_000008.ppt", "noext": "BATCH_02_names_000009.pptx"}


def test_next_batch_number(spark):
    df = spark.createDataFrame([("2026-04-16",), ("2026-04-16",), ("2026-04-15",)], "day string")
    assert numbering.next_batch_number(df, F.col("day"), F.lit("2026-04-16")) == 3
    assert numbering.next_batch_number(df, F.col("day"), F.lit("2026-04-17")) == 1


def test_present_but_empty_field_wins(spark):
    rec = ['{"title":"","document_title":"x"}', '{"document_title":"x"}', '{}']
    assert column(spark, rec, lambda r: rc.first_present(rc.fields(r), ["title", "document_title"], "d")) == ["", "x", "d"]


def test_transfer_blocklist_uses_listed_values(spark):
    df = spark.createDataFrame([("", 9, "Acme.com team", ""), ("", 9, "", "Someone"), ("bad", 9, "", ""), ("", 4, "", "")], "e string, n int, o string, a string")
    got = [r[0] for r in df.select(integrity.transfer_reason(F.col("e"), F.col("n"), F.col("o"), F.col("a"), ["acme.com"])).collect()]
    assert got == ["blocked organisation: acme.com team", "PASS", "corrupt file — bad", "only 4 slides (min 5)"]


def test_counts_in_other_scripts(spark):
    texts = ["٠١٢٣ ٤٥٦٧ ٨٩٠١", "۱۲۳-۴۵-۶۷۸۹", "01 23 45 67 89", "tel 030 1234 5678"]
    assert column(spark, texts, tx.phone_count) == [len(re.findall(fv.PHONE_PATTERN, t)) for t in texts]
    assert column(spark, texts, tx.ssn_count) == [len(re.findall(fv.SSN_PATTERN, t)) for t in texts]


def test_anchor_targets(spark):
    html = ('<a class=x href="/a.pptx?x=1&amp;y=2">1</a><A HREF=\' b.ppt \'>2</A><a href=c.pptx>3</a><!-- <a href="no.pptx"> -->'
            '<script>var s = "<a href=\'no2.pptx\'>"</script><a data-href="no3.pptx" href="d.pptx">4</a><area href="no4.pptx"><a name="x">5</a>')
    assert column(spark, [html], urls.anchor_targets) == [["/a.pptx?x=1&y=2", "b.ppt", "c.pptx", "d.pptx"]]


def test_page_links_join_all_kinds(spark):
    from deckmill.operators import frontier

    html = ('<a href="/x/a.pptx">a</a> see https://o.org/raw.ppt, "/bitstream/handle/1/2/deck.pptx" <a href="a.pptx#s">b</a><a href="n.html">n</a>')
    df = spark.createDataFrame([(1, "http://h.org/d/page", html)], "page_id int, url string, html string")
    assert sorted(r.link for r in frontier.page_links(df).collect()) == [
        "http://h.org/bitstream/handle/1/2/deck.pptx", "http://h.org/d/a.pptx#s", "http://h.org/x/a.pptx", "https://o.org/raw.ppt"]


def test_strip_all_white_space(spark):
    raw = ["\t a b \r\n", "\x0b", " "]
    assert column(spark, raw, tx.strip) == [r.strip() for r in raw]


def test_path_parameters_are_no_name(spark):
    raw = ["http://h/a.pptx;v=1?x", "http://h/d;v/a.PPT/", "http://h/.pptx"]
    from pathlib import PurePosixPath

    assert column(spark, raw, urls.path_name) == [PurePosixPath(urlparse(u).path).name for u in raw]
    assert column(spark, raw, lambda u: integrity.is_deck_resource(u, F.lit(""))) == [True, True, False]


@pytest.mark.parametrize("limit", [20_000, 1])
def test_frontier_from_seed(spark, monkeypatch, limit):
    from deckmill.operators import frontier, scale

    small = scale.small_table
    monkeypatch.setattr(frontier.scale, "small_table", lambda df, n=0: small(df, limit))
    rows = [("th", "topic", "ฟิสิกส์"), ("th", "topic", "law"), ("th", "topic", "law"), ("th", "domain", "site:a.th"), ("ir", "domain", "site:b.ir"), ("th", "broad", "site:th")]
    seed = spark.createDataFrame(rows, "country string, kind string, value string")
    got = frontier.frontier_from_seed(seed, ["seminar"], ["lecture"], ppt_percent=0).collect()
    assert sorted(r.query for r in got) == sorted([
        "filetype:pptx site:th", "filetype:ppt site:th", "lecture filetype:pptx site:th", '"ฟิสิกส์" filetype:pptx site:a.th',
        '"law" filetype:pptx site:a.th', '"law" filetype:pptx site:a.th', '"seminar" filetype:pptx site:a.th', '"seminar" filetype:pptx site:b.ir'])
    assert all((r.priority == 0) == (r.shuffle_rank is None) for r in got)


def test_frontier_draw_is_repeatable(spark):
    from deckmill.operators import frontier

    df = spark.range(2000).select(F.lit("c").alias("country"), F.concat(F.lit("site:"), F.col("id").cast("string")).alias("domain"))
    first, again = [frontier.build_frontier(df, ["x"], seed=4).where("query like '%filetype:ppt %'").count() for _ in range(2)]
    assert first == again and 300 < first < 500


def test_topical_terms_late_in_a_text(spark):
    late = spark.createDataFrame([(["x" * 60_000, "Alpha beta", "gamma"],)], "parts array<string>")
    row = late.select(screens.topical_hits(late["parts"], ["alpha", "beta", "gamma"]).alias("limited"),
                      screens.topical_hits(late["parts"], ["alpha", "beta", "gamma"], None).alias("hits"),
                      screens.topically_dense(late["parts"], ["alpha", "beta", "gamma"], stop_after=None).alias("dense")).first()
    assert (row["limited"], row["hits"], row["dense"]) == (0, 3, True)


def test_streams_take_tables_of_several_parts(spark, tmp_path):
    """A table may be a folder of part files as well as one file, beside other tables of the same kind."""
    from deckmill.catalog import watching

    docs = spark.createDataFrame([(i, f"text {i % 7}", "en", f"s{i % 2}", 6) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet.old")
    assert watching.stream_dedup_ledger(spark, str(tmp_path)).count() == 7
    assert sorted(tuple(r) for r in watching.stream_source_counters(spark, f"{tmp_path}/").collect()) == [("s0", 10, 60), ("s1", 10, 60)]
    assert watching.stream_publish_metadata(spark, str(tmp_path)).count() == 18
