"""Sourcing and run state on small tables: nulls, blanks, empty tables and the cases that the driver's tables lack."""

from pyspark.sql import functions as F

from loamline import config
from loamline.operators import runs, sourcing

PAIR = "name string, url string"


def test_validity_and_translation(spark):
    d = spark.createDataFrame([("a" * 10, None), (" b ", "de"), (None, " ")], "text string, _orig_lang string")
    assert runs.validity(d).first().asDict() == {"valid": 1, "invalid": 2}
    kept, purged = runs.split_translated(d)
    assert (kept.count(), purged.count()) == (2, 1)
    assert runs.split_translated(d.drop("_orig_lang"))[1].count() == 0
    assert runs.validity(d.limit(0)).first().asDict() == {"valid": 0, "invalid": 0}


def test_stage_states(spark):
    of = lambda rows: [r.state for r in runs.stage_states(spark.createDataFrame(rows, "stage string, ended boolean")).orderBy("step").collect()]
    assert of([]) == ["pending"] * 5
    assert of([("ingest", False), ("source", False)]) == ["done", "running", "pending", "pending", "pending"]
    assert of([("schema", False), ("schema", True), ("x", True)]) == ["done"] * 5


def test_balance(spark):
    corpus = lambda sizes: spark.createDataFrame([(f"{k}{i}", k, "s") for k, n in sizes.items() for i in range(n)], "text string, sub_domain string, source string")
    conf = config.Gate(min_subdomain_share=0.1, max_topic_cv=0.5)
    assert not runs.balanced(corpus({}), conf).first().balanced
    assert runs.balanced(corpus({"a": 5, "b": 5}), conf).first().balanced
    assert not runs.balanced(corpus({"a": 40, "b": 1}), conf).first().balanced
    plan = runs.balance_plan(corpus({"a": 40, "b": 1}), spark.createDataFrame([("a", 7), ("b", 3)], "sub_domain string, valid long"), conf)
    assert sorted(tuple(r) for r in plan.collect()) == [("a", 40, False, 28), ("b", 1, True, 28)]
    more = lambda plan, n: plan.withColumn("id", F.explode(F.sequence(F.lit(1), F.lit(30)))).select(F.concat_ws("-", "id", F.lit(n)).alias("text"), "sub_domain", F.lit("new").alias("source"))
    found, rounds = runs.fix_rounds(more, corpus({"a": 40, "b": 1}), conf)
    assert rounds == 1 and found.filter("sub_domain = 'b'").count() == 31
    assert runs.rebalanced(corpus({"a": 5, "b": 5}), ["text"]).count() == 10


def test_trend_and_sessions(spark):
    d = spark.createDataFrame([(1, None, None), (2, True, '{"total": 4, "drift": null}')], "ts long, passed boolean, metrics string")
    assert [tuple(r) for r in runs.trend(d).orderBy("ts").collect()] == [(1, False, 0, 0.0, 0.0, 0.0, 0), (2, True, 4, 0.0, 0.0, 0.0, 0)]
    log = spark.createDataFrame([(k, k) for k in range(20)], "session long, ts long")
    assert [r.session for r in runs.sessions(log).collect()] == list(range(19, 4, -1))


def test_probes_all_pass(spark):
    assert [r for r in runs.probes(spark).collect() if not r.passed] == []


def test_names_and_tags(spark):
    d = spark.createDataFrame([
        ("Set - by x", "https://huggingface.co/datasets/own/d"), ("T", "https://github.com/search/q"), (" ", "https://www.a.example/x"), (None, None), ("A" * 100, "https://gitlab.com/me/r"),
    ], PAIR)
    got = [r.n for r in d.select(sourcing.derived_name(F.col("name"), F.col("url")).alias("n")).collect()]
    assert got[0] == "own" and got[1] == "T" and got[2] == "a.example" and not got[3] and got[4] == "me"
    t = spark.createDataFrame([([" a", "k:v", "", None, "b"],), (None,), (["x"] * 20,)], "t array<string>").select(sourcing.tags(F.col("t")).alias("t"))
    assert [r.t for r in t.collect()] == ["a, b", "", ", ".join("x" * 8)]


def test_admitted_keeps_the_first_that_passes(spark):
    d = spark.createDataFrame([(1, "u", "junk"), (2, " u ", ""), (3, "u", ""), (4, None, ""), (5, None, ""), (6, "v", "")], "i int, url string, why string")
    have = spark.createDataFrame([("v",), (None,)], "url string")
    got = {r.i: r.rejected for r in sourcing.admitted(d, have, F.col("why"), ["i"]).collect()}
    assert got == {1: "junk", 2: "", 3: "duplicate", 4: "", 5: "", 6: "duplicate"}


def test_category_domain(spark):
    taxonomy = spark.createDataFrame([("Net Sec", "NS"), ("Other", None)], "name string, code string")
    hints = spark.createDataFrame([("feeds", "Net Sec"), ("lost", "Nowhere")], "category string, name string")
    rows = spark.createDataFrame([(1, "own", "ns"), (2, None, "net-sec"), (3, "", " Feeds "), (4, " ", "lost"), (5, None, None), (6, None, "NS")], "i int, sub_domain string, category string")
    got = {r.i: r.domain for r in sourcing.category_domain(rows, taxonomy, hints).collect()}
    assert got == {1: "own", 2: "Net Sec", 3: "Net Sec", 4: "lost", 5: "Uncategorized", 6: "Net Sec"}


def test_payloads_that_cannot_be_read(spark):
    d = spark.createDataFrame([("no json",), (None,), ('{"items": null}',), ('{"items": [{"full_name": "a/b"}]}',)], "payload string")
    assert [tuple(r) for r in sourcing.candidates(d, "github").collect()] == [("a/b", None, None, None, "github")]


def test_safe_names(spark):
    d = spark.createDataFrame([("A-B",), ("A/B",), ("..",), (" a",), ("",), (None,)], "n string")
    assert [r.x for r in d.select(sourcing.safe_name(F.col("n")).alias("x")).collect()] == [True, False, False, False, False, False]
