"""Operators on small tables: vectors of the survey's fixtures, and the shapes that the driver's tables lack."""

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loamline.functions import hazards, html, lang, licence, pii, text, urls
from loamline.operators import catalog, clean, metrics, neardup, normalize
from loamline.sources import feeds, records
from loamline.streaming import incremental

PROSE = "The quick brown fox jumps over the lazy dog and the cat sat on the mat with an old friend of the family. "


def of(spark, expr, *values):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.x for r in d.select("i", expr(F.col("t")).alias("x")).orderBy("i").collect()]


def test_text_functions(spark):
    assert of(spark, text.sanitized, "a\x00b\x07c    d\t\te", "line1\r\n\r\n\r\n\r\nline2", "café", "CafÃ©", None) == ["abc d e", "line1\n\nline2", "café", "Café", None]
    assert of(spark, text.garbage_ratio, "\x00\x01\x02binary", "", "def f(x): return x", "éü漢字Привет ") == [pytest.approx(3 / 9), 0.0, 0.0, 0.0]
    assert of(spark, text.exact_fingerprint, "Hello   World")[0] == of(spark, text.exact_fingerprint, "hello world ")[0]
    assert of(spark, text.repeated_line_ratio, "a\n" * 20, "a\nb") == [pytest.approx(0.95), 0.0]
    assert of(spark, text.top_token_ratio, "the " * 30, "one two") == [1.0, 0.0]
    assert of(spark, text.iso_date, "January 5, 2021", "2021-01-05T10:00:00Z", "nonsense") == ["2021-01-05", "2021-01-05", "nonsense"]
    assert of(spark, lambda c: text.shingles(text.split_words(c), 5), "a b c d e f", "a b", "") == [["a b c d e", "b c d e f"], ["a b"], []]
    assert of(spark, lambda c: text.record_type(c, c), "nvd", "mitre", "cloudtrail", "nist", "blog") == ["cve", "advisory", "log", "doc", "article"]
    assert of(spark, text.slug, "Hello, World!", "") == ["hello-world", "source"]
    assert of(spark, lambda c: text.chunks(c, 3), "abcdefgh") == [["abc", "def", "gh"]]


def test_identifiers(spark):
    line = "mail a.b@example.com host 8.8.8.8 ssn 123-45-6789 card 4111 1111 1111 1111"
    (r,) = of(spark, pii.redact, line)
    assert r.n == 4 and r.text == "mail <EMAIL_ADDRESS> host <IP_ADDRESS> ssn <US_SSN> card <CREDIT_CARD>"
    for kept in ("host 10.0.0.1", "ping 127.0.0.1", "section 3.4.3.1 Theorem", "version 8.8.8.8", "000-12-3456", "4111 1111 1111 1112", "12345-6789"):
        assert of(spark, pii.redact, kept)[0].n == 0, kept
    assert of(spark, pii.redact, None)[0].n == 0


def test_language(spark):
    assert of(spark, lang.detect, PROSE, "Это предложение на русском языке для проверки", "", None, "der die das und") == ["en", "non-latin", "unknown", "unknown", "unknown"]


def test_licences(spark):
    ok = ["MIT", "Apache-2.0", "CC0", "CC-BY-4.0", "Public Domain", "royalty-free"]
    bad = ["CC BY-NC 4.0", "GPL-3.0", "cc-by-sa-4.0", "All rights reserved", "proprietary"]
    assert of(spark, licence.verdict, *ok, *bad, "", None, "who knows") == ["ok"] * 6 + ["blocked"] * 5 + ["unknown"] * 3
    assert of(spark, lambda c: licence.classify(c)["reason"], "", "GPL") == ["missing license", "non-commercial/copyleft license (gpl)"]
    assert of(spark, licence.normalized, "https://creativecommons.org/licenses/by-nc/4.0/", "cc-by-sa-4.0", "Apache License 2.0", "EPL-2.0", "") == ["CC BY-NC 4.0", "CC BY-SA 4.0", "Apache-2.0", "EPL-2.0", ""]
    page = '<html><a rel="license" href="https://creativecommons.org/publicdomain/zero/1.0/">x</a></html>'
    assert of(spark, licence.from_html, page, "<p>Free for commercial use</p>", "<p>x</p>") == ["CC0-1.0", "Free for commercial use", ""]


def test_urls(spark):
    assert of(spark, urls.host, "https://user@WWW.Example.com:80/x", "example.org/a", None) == ["example.com", "example.org", ""]
    assert of(spark, urls.screen, "", "ftp://x", "http://a:b@c.d", "http://127.0.0.1/", "http://192.168.1.1", "http://169.254.169.254/", "https://example.com/x") == ["empty URL", "scheme not fetched", "credentials in URL", "loopback address", "private address", "link-local address", ""]
    assert of(spark, urls.quality, "", "https://m.youtube.com/x", "https://a.com/tags/x", "https://a.com/?q=x", "https://a.com/x") == ["bad link", "junk host", "listing page", "listing page", ""]
    assert of(spark, urls.source_identity, "https://huggingface.co/datasets/o/n/resolve/main/f", "http://www.a.com/x/?q#f", "") == ["hf:o/n", "url:a.com/x", None]
    assert of(spark, lambda c: urls.category_and_format(c)["category"], "http://a.com/x.pdf", "http://a.com/x.csv", "http://a.com/feed", "http://api.a.com/", "https://github.com/a/b", "http://a.com") == ["Document", "Dataset", "Feed", "API", "Repository", "Website"]


def test_hazards_and_html(spark):
    d = spark.createDataFrame([(1, "<script>x</script> javascript:go() " + "A" * 600, "http://1.2.3.4/$(rm x)", "; rm -rf")], "id int, text string, url string, _private string")
    found = {(r.field, r.type): r.n for r in hazards.findings(d, "id", ["text", "url", "_private"]).collect()}
    assert found == {("text", "embedded_active_content"): 1, ("text", "javascript_uri"): 1, ("text", "base64_payload"): 1, ("url", "shell_injection"): 1, ("url", "suspicious_url"): 1}
    page = "<html><head><title> A  b</title></head><body><nav>no</nav><p>One</p><script>x</script><p>Two &amp; three</p><a href=\"/x#y\">l</a></body></html>"
    assert of(spark, html.text, page, None) == ["One\nTwo & three\nl", None]
    assert of(spark, html.title, page) == ["A b"] and of(spark, html.links, page) == [["/x"]]
    b = spark.createDataFrame([(bytearray(b"MZ\x00"),), (bytearray(b"\x7fELF.."),), (bytearray(b"text"),)], "c binary")
    assert [r.k for r in b.select(hazards.binary_kind(F.col("c")).alias("k")).collect()] == ["pe", "elf", None]


def mapped(spark, record, hint=None):
    d = spark.read.json(spark.sparkContext.parallelize([json.dumps(record)]))
    r = clean.map_text(d, hint).first()
    return r.text, r._text_field


def test_map_text(spark):
    assert mapped(spark, {"text": "x"}) == ("x", "text")
    assert mapped(spark, {"question": "q", "Answer": "a"}) == ("Question: q\n\nAnswer: a", "question+answer")
    assert mapped(spark, {"url": "u", "label": 1}) == (None, None)
    assert mapped(spark, {"system": "s", "User": "u", "Assistant": "a"}) == ("User: u\n\nAssistant: a", "user+assistant")
    assert mapped(spark, {"prompt": "p", "chosen": "c", "rejected": "r"}) == ("Prompt: p\n\nChosen: c", "prompt+chosen")
    assert mapped(spark, {"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": "u"}, {"role": "tool", "content": "t"}]}) == ("User: u\n\nTool: t", "messages")
    assert mapped(spark, {"conversations": [{"from": "human", "value": "h"}]}) == ("User: h", "conversations")
    assert mapped(spark, {"a": "1", "note": "n"}, "note") == ("n", "note")


def test_clean_chain(spark):
    rows = [("s1", 1, PROSE * 2), ("s1", 2, PROSE * 2), ("s1", 3, "hi"), ("s1", 4, PROSE + " write to joe@example.com today please and thank you"), ("s2", 1, "Это русский текст. " * 20), ("s2", 2, PROSE + " a distinct one about the river and the bridge of the town"), ("s2", 3, PROSE * 2), ("s3", 1, "same\n" * 30), ("s3", 2, None)]
    d = spark.createDataFrame([("Test", s, n, t) for s, n, t in rows], "sub_domain string, source string, line int, text string")
    c = clean.clean(d)
    c = clean.first_wins(c, F.when(F.col("route") == "clean", text.exact_fingerprint(F.col("text"))).otherwise(F.concat_ws(":", "source", "line")), [F.col("source"), F.col("line")])
    r = {(x.sub_domain, x.source): x for x in clean.report(c, ["sub_domain", "source"]).collect()}["TOTAL", ""]
    assert (r.n_in, r.n_out, r.exact_dups, r.pii_records, r.lang_dropped, r.flagged) == (9, 3, 2, 1, 1, 1) and r.struct_dropped + r.excluded_no_text == 2
    assert "joe@example.com" not in " ".join(x.text or "" for x in c.filter("route = 'clean'").collect())
    assert clean.clean(d.limit(0)).count() == 0


def test_first_and_last_wins(spark):
    d = spark.createDataFrame([("b", 1, "x"), ("a", 2, "X "), ("a", 3, "y")], "f string, n int, t string")
    kept = clean.first_wins(d, text.exact_fingerprint(F.col("t")), [F.col("f"), F.col("n")]).filter("not duplicate")
    assert {(r.f, r.n) for r in kept.collect()} == {("a", 2), ("a", 3)}
    assert {r.n for r in clean.last_wins(d, ["f"], ["n"]).collect()} == {1, 3}


def test_gate_and_balance(spark):
    d = spark.createDataFrame([("a", "x", PROSE + str(i)) for i in range(8)] + [("a", "y", PROSE + str(i)) for i in range(2)] + [("b", "z", "word")], "sub_domain string, source string, text string")
    found = {(r.severity, r.check) for r in metrics.gate(d).collect()}
    assert ("blocker", "volume") in found and ("warning", "concentration") in found and ("warning", "subdomain_volume") in found
    with pytest.raises(metrics.Blocked):
        metrics.enforce(metrics.gate(d))
    assert metrics.source_targets({"a": 800, "b": 100}, 0.6) == {"a": int(0.54 / 0.46 * 100)} and metrics.source_targets({"a": 5}) == {}
    ids = d.withColumn("id", F.monotonically_increasing_id())
    assert {r.sub_domain: r["count"] for r in metrics.domain_cap(ids, 4, ["id"]).groupBy("sub_domain").count().collect()} == {"a": 4, "b": 1}
    cut = metrics.source_cap(ids, ["id"], 0.6).groupBy("sub_domain", "source").count().collect()
    assert {(r.sub_domain, r.source): r["count"] for r in cut} == {("a", "x"): 2, ("a", "y"): 2, ("b", "z"): 1}


def test_normalize(spark):
    rows = [("Internal Audit", "w", 1, PROSE), ("internal-audit", "w", 2, PROSE.upper()), ("Internal Audit", "w", 3, "tiny"), ("Internal Audit", "w", 4, PROSE + "more"), ("Nowhere", "w", 5, PROSE)]
    d = spark.createDataFrame(rows, "sub_domain string, source string, line int, text string")
    domains = spark.createDataFrame([("Internal Audit", "AUDIT", "INTERNAL")], "name string, domain_name string, subdomain_name string")
    out = {r.line: r for r in normalize.process(d, domains, ["line"]).collect()}
    assert [out[k].outcome for k in range(1, 6)] == ["written", "duplicate", "rejected", "written", "rejected"]
    assert list(out[1].record.asDict()) == normalize.FIELDS and len(normalize.FIELDS) == 22
    bad = spark.createDataFrame([("s", i, i < 25) for i in range(40)], "s string, n int, bad boolean")
    assert normalize.hard_pause(bad, F.col("bad"), "s", ["n"], 20).filter("paused").agg(F.min("n")).first()[0] == 20


def test_near_duplicates(spark):
    words = [f"w{i}" for i in range(100)]
    a, b, c = " ".join(words), " ".join([*words, "x1", "x2", "x3", "x4", "x5"]), " ".join(reversed(words))
    d = spark.createDataFrame([(1, a), (2, b), (3, c), (4, a)], "doc_id int, text string")
    assert {(r.a, r.b) for r in neardup.pairs(d).collect()} == {(1, 2), (1, 4), (2, 4)}
    chain = spark.createDataFrame([(1, 2), (2, 3)], "a int, b int")
    assert {r.id: r.kept for r in neardup.first_wins(chain).collect()} == {1: True, 2: False, 3: True}


def test_near_duplicates_by_bands(spark):
    base = [f"w{i}" for i in range(300)]
    texts = {1: " ".join(base), 2: " ".join([*base, "x1", "x2"]), 3: " ".join(reversed(base)), 4: " ".join(base), 5: " ".join(base[:150]), 6: None, 7: "", 8: "only two"}
    found = neardup.band_pairs(spark.createDataFrame(list(texts.items()), "doc_id int, text string")).collect()
    assert {(r.a, r.b) for r in found} == {(1, 2), (1, 4), (2, 4)} and all(r.similarity >= 0.85 for r in found)
    assert {r.similarity for r in found if (r.a, r.b) == (1, 4)} == {1.0}


def test_catalog(spark):
    assert of(spark, catalog.verdict, '{"verdict": "decline"}', "not json", '{"verdict": "approve"}') == ["decline", "review", "approve"]
    rows = spark.createDataFrame([("GPL-3.0", "http://a"), ("GPL-3.0", ""), ("MIT", "http://b")], "license string, url string")
    kept, moved = catalog.blacklist(rows)
    assert kept.count() == 2 and moved.count() == 1
    d = spark.createDataFrame([("x", "audit of the bank ledger", "ledger ledger")], "sub_domain string, title string, snippet string").withColumn("id", F.lit(1))
    v = spark.createDataFrame([("x", "fraud"), ("y", "ledger"), ("y", "audit")], "sub_domain string, term string")
    assert catalog.refine_domain(d, v, "id").first().refined == "y"
    assert [r.code for r in catalog.codes(spark.createDataFrame([("A b",), ("a-b",)], "name string")).orderBy("code").collect()] == ["A_B", "A_B_2"]
    assert catalog.shots(spark.createDataFrame([("k",)], "keyword string"), ["a.com"], ["pdf"]).count() == 4
    assert catalog.eta_seconds(10, 100, 5) == 45 and catalog.eta_seconds(0, 1, 1) is None


def test_records(spark, tmp_path):
    p = tmp_path / "Sub" / "src"
    p.mkdir(parents=True)
    (p / "a.jsonl").write_text('{"text": "x"}\n\nnot json\n[1, 2]\n{"text": "y"}\n')
    d = records.tree(spark, str(tmp_path), "text string")
    assert sorted((r.text or "", r._parse_error) for r in d.collect()) == [("", True), ("", True), ("x", False), ("y", False)]
    assert {(r.sub_domain, r.source, r.file) for r in d.collect()} == {("Sub", "src", "a.jsonl")}
    (tmp_path / "b.json").write_text('[{"text": "a"}, 5, {"text": "b"}, {"te')
    assert {r.text for r in records.read_any(spark, str(tmp_path / "b.json")).collect()} == {"a", "5", "b"}
    (tmp_path / "c.csv").write_text("content,other\nhello,1\n")
    e = records.enrich(records.read_any(spark, str(tmp_path / "c.csv")), "s", "u", "MIT").first()
    assert (e.text, e.source, e.license) == ("hello", "s", "MIT")
    entries = spark.createDataFrame([("a", "../x", 1, 1), ("b", "x", 1000, 1), ("c", "x", 1, 1)], "archive string, name string, size long, packed long")
    assert {r.archive: r.reason for r in records.archive_refusal(entries).collect()} == {"a": "unsafe path", "b": "ratio", "c": None}


def test_feeds(spark, tmp_path):
    rss = "<rss><channel><item><title>T1</title><link>http://a</link><description><![CDATA[<b>S</b>]]></description><guid>g</guid></item></channel></rss>"
    atom = '<feed><entry><title>T2</title><link href="http://b"/><summary>U</summary><id>i</id></entry></feed>'
    got = {(r.title, r.link, r.summary, r.guid) for r in feeds.items(spark.createDataFrame([(rss,), (atom,)], "body string")).collect()}
    assert got == {("T1", "http://a", "S", "g"), ("T2", "http://b", "U", "i")}
    (tmp_path / "f.json").write_text(json.dumps({"meta": [1], "vulnerabilities": [{"cveID": "CVE-1", "shortDescription": "d"}, {"cveID": "CVE-2"}]}))
    assert {r.t for r in feeds.json_feed(spark, str(tmp_path / "f.json")).select(feeds.exploited(F.col("record")).alias("t")).collect()} == {"CVE-1\n\nd", "CVE-2"}
    (tmp_path / "w.xml").write_text('<c><Weakness ID="79" Name="XSS"><Description>D</Description></Weakness></c>')
    assert feeds.weaknesses(spark, str(tmp_path / "w.xml")).first().text == "CWE-79: XSS\n\nD"


def test_streams(spark, tmp_path):
    src, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    (src / "a.jsonl").write_text('{"n": 1, "text": "A"}\n{"n": 2, "text": "a "}\n{"n": 3, "text": "b"}\n')
    run = lambda: incremental.distinct_by_journal(incremental.new_records(spark, str(src), "n int, text string"), out, check, ["n"])
    run()
    (src / "b.jsonl").write_text('{"n": 4, "text": "B"}\n{"n": 5, "text": "c"}\n')
    run()
    run()
    assert {r.n for r in spark.read.parquet(out).collect()} == {1, 3, 5}


def test_entry_without_the_llm_folders(tmp_path):
    """The entry imports, and the engine runs, where both llm folders and the pipeline are deleted."""
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "loamline", tmp_path / "loamline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q = e.queries(); print(len(q), 'op1_mixing' in q, set(e.oracle_sql()) <= set(q))"], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, check=True)
    assert int(said.stdout.split()[0]) > 60 and said.stdout.split()[1:] == ["False", "True"]


def test_addresses_in_context(spark):
    yes = ("8.8.8.8", "'8.8.8.8'", 'to "8.8.8.8" now', "8.8.8.8:53", "version 8.8.8.8/x", "ssh to 8.8.8.8.", "the server of 2001, 8.8.8.8", "a \ue000 host 8.8.8.8")
    no = ("see 8.8.8.8 there", "the host, since 8.8.8.8", "ip prior  to 8.8.8.8", "host 8.8.8.8 Theorem", "host 224.0.0.1", "host 10.1.1.1", "chapter. 8.8.8.8 ip", "x 8.8.8.8'")
    assert [r.n for r in of(spark, pii.redact, *yes)] == [1] * len(yes) and [r.n for r in of(spark, pii.redact, *no)] == [0] * len(no)


def test_person_names_by_a_hook(spark):
    engine = lambda c: F.struct(F.regexp_replace(c, "Jane Roe", "<PERSON>").alias("text"), F.regexp_count(c, F.lit("Jane Roe")).alias("n"))
    (r,) = of(spark, lambda c: pii.redact(c, engine), "Jane Roe at a.b@example.com")
    assert (r.text, r.n) == ("<PERSON> at <EMAIL_ADDRESS>", 2)


def test_licence_edges_grants_and_prose(spark):
    assert of(spark, licence.verdict, "ist mitäerst", "unter mit.", "ämit", "mit_x", "MIT") == ["unknown", "ok", "unknown", "unknown", "ok"]
    said = ("free for non-commercial use", "Not for commercial use", "may be used freely for commercial ends", "allowed for commercial purposes", "free for personal and commercial use", "royalty free", "of public use", "none")
    assert of(spark, licence.grant, *said) == ["Non-commercial use only", "Non-commercial use only", "Commercial use permitted", "Commercial use permitted", "Free for commercial use", "Royalty-free", "Public use", ""]
    prose = ("Creative Commons Attribution-ShareAlike v3.0", "Creative Commons Attribution Non-Commercial", "CC BY NC SA 2.0", "cc-by-4.0", "Creative Commons Zero")
    assert of(spark, licence.normalized, *prose) == ["CC BY-SA 3.0", "CC BY-NC 4.0", "CC BY-NC-SA 2.0", "CC BY 4.0", "CC0-1.0"]


def test_rows_of_links_with_queries_go(spark):
    d = spark.createDataFrame([("https://www.a.com/x?q=1#t", "s", 1), ("http://b.org/", "s", 2), (None, "s", 3)], "url string, sub_domain string, ordinal int")
    assert {r.ordinal for r in catalog.delete_rows(d, ["http://a.com/x?q=1"]).collect()} == {2, 3}
    assert {r.ordinal for r in catalog.delete_rows(d, ["b.org"], positions=[3]).collect()} == {1}


def test_first_wins_beside_clashing_names(spark):
    d = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, None, 0), (4, None, 0)], "id int, key string, of int").withColumns({"_of": F.lit(1), "row": F.lit(2), "first": F.lit(3)})
    found = clean.first_wins(d, F.col("key"), [F.col("id")])
    assert [c for c in found.columns if c in d.columns] == d.columns and {r.id: r.duplicate for r in found.collect()} == {1: False, 2: True, 3: False, 4: True}


def test_source_targets_shrink_the_largest_again():
    left = {"a": 900, "b": 500, "c": 100}
    cuts = metrics.source_targets(left, 0.34)
    now = {k: cuts.get(k, n) for k, n in left.items()}
    assert cuts["a"] < 900 and cuts["b"] < 500 and "c" not in cuts and metrics.source_targets({None: 10, "x": 10}, 0.9) == {}
    assert max(now.values()) <= 0.9 * sum(now.values())
