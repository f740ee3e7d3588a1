"""Queries of the sourcing operators, of run state and of catalog rows, and the SQL that states their results.

The driver's tables stand for what the operators read: orders, parts and customers for catalog rows and ledgers, events
for logs, pages for search results.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline import config
from loamline.functions import licence, text, urls
from loamline.operators import catalog, clean, normalize, runs, sourcing
from loamline.plans.catalogue import _CHAIN, _D, _HOST, _PATH, _STRIP, _T, _TIDY, _WORDS, _plain, corpus, query, read, rounded
from loamline.sources import records
from loamline.streaming import incremental

# --- records --------------------------------------------------------------------------------------------------------------


@query(f"select count_if(length({_T}) >= 200) as valid, count_if(text is null or length({_T}) < 200) as invalid from documents")
def record_validity(spark, sf_dir):
    return runs.validity(corpus(spark, sf_dir), 200)


@query("select source, count(*) as purged from documents where lang <> 'en' group by 1")
def translated_purge(spark, sf_dir):
    d = corpus(spark, sf_dir).withColumn("_orig_lang", F.when(F.col("sub_domain") != "en", F.col("sub_domain")))
    return runs.split_translated(d)[1].groupBy("source").agg(F.count("*").alias("purged"))


@query(f"select source, case when {_T} <> '' then 'generic' else 'structured' end as mapper, count(*) as records from documents where source not in ('src0', 'src1') group by all")
def unmapped_sources(spark, sf_dir):
    return runs.unmapped(corpus(spark, sf_dir), ("src0", "src1"))


@query("""with a as (select source from documents group by 1 having count_if(length(text) < 200) / count(*) > 0.06) select doc_id, source, 'short texts' as reason from documents where source in (select source from a)""")
def rejected_source_rows(spark, sf_dir):
    d = corpus(spark, sf_dir)
    a = d.groupBy("source").agg(F.when(F.count_if(F.length("text") < 200) / F.count("*") > 0.06, "short texts").otherwise("").alias("reason"))
    return runs.rejected_sources(a, d).select("doc_id", "source", "reason")


@query(f"with {_CHAIN} select count_if(route = 'clean') as clean, count_if(route = 'flagged') as flagged, count_if(route = 'dropped') as dropped from d")
def output_counts(spark, sf_dir):
    return runs.outputs(_plain(spark, sf_dir))


@query("select doc_id, source from documents order by doc_id limit 20")
def sidecar_preview(spark, sf_dir):
    """The first 20 (the limit is the operator)."""
    return runs.preview(corpus(spark, sf_dir), ["doc_id"], 20).select("doc_id", "source")


@query(f"select count(*) as n_in, count_if(text is distinct from {_TIDY}) as n_affected from documents")
def stage_effect(spark, sf_dir):
    return clean.affected(corpus(spark, sf_dir), "text", text.sanitized(F.col("text")))


@query(f"select doc_id, source, sha256(coalesce({_TIDY}, '')) as text_sha256, text is null or text <> {_TIDY} or n_chars > 1000 as sanitized, case when n_chars > 1000 then '2021-01-05' else 'undated' end as published from documents")
def sanitized_records(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "source", F.when(F.col("n_chars") > 1000, "January 5, 2021").otherwise("undated").alias("published"))
    return clean.sanitize(records.spread(d)).select("doc_id", "source", F.sha2("text", 256).alias("text_sha256"), F.col("_sanitized").alias("sanitized"), "published")


@query(rf"""select doc_id, sha256(case when n_chars > 1000 then {_T} when {_STRIP.format('lang')} <> '' then {_STRIP.format('lang')} else source end) as text_sha256 from documents""")
def best_text(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 1000, F.col("text")).alias("content"), F.col("lang").alias("message"), "source")
    return d.select("doc_id", F.sha2(clean.best_text(d), 256).alias("text_sha256"))


@query("select p_partkey, 'p_name: ' || p_name || '; p_brand: ' || p_brand || '; p_size: ' || p_size as text from part")
def fields_text(spark, sf_dir):
    d = read(spark, sf_dir, "part").withColumns({"source": F.lit("x"), "blank": F.lit(" ")})
    return d.select("p_partkey", text.fields_text(["source", "p_name", "blank", "p_brand", "p_size"]).alias("text"))


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as day from orders""")
def iso_dates(spark, sf_dir):
    """Each order's date in one of five spellings, read back (the day is past 12, or the spelling tells the month)."""
    d, day = read(spark, sf_dir, "orders"), F.col("o_orderdate")
    shape = F.when(F.dayofmonth(day) <= 12, F.date_format(day, "MMMM d, yyyy")).when(F.col("o_orderstatus") == "F", F.date_format(day, "dd-MM-yyyy")).when(F.col("o_orderstatus") == "O", F.date_format(day, "yyyy/MM/dd")).otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
    return d.select("o_orderkey", text.iso_date(shape).alias("day"))


@query("select case when source in ('src1', 'src2') then 'synthetic' else 'real' end as side, count(*) as records from documents group by 1")
def synthetic_sources(spark, sf_dir):
    """Records of sources that a list names as synthetic are diverted, by the identity of their address."""
    d = corpus(spark, sf_dir).withColumns({"url": F.concat(F.lit("https://www."), "source", F.lit(".example.com/a/?q=1")), "sub_domain": F.lit("en")})
    domains = spark.createDataFrame([("en", "a", "b")], "name string, domain_name string, subdomain_name string")
    marks = spark.createDataFrame([("url:src1.example.com/a",), ("url:src2.example.com/a",)], "identity string")
    out = normalize.process(d, domains, ["doc_id"], marks, config.Normalize(pause=1 << 30))
    return out.groupBy(F.when(F.col("outcome") == "synthetic", "synthetic").otherwise("real").alias("side")).agg(F.count("*").alias("records"))


# --- sizes ----------------------------------------------------------------------------------------------------------------


@query("select lang as sub_domain, source, count(*) as records, round(sum(strlen(text)) / 1048576, 6) as mb from documents group by all")
def cleaned_table(spark, sf_dir):
    return rounded(runs.cleaned_table(corpus(spark, sf_dir)))


@query("select l_shipmode as source, count(*) as files, round(sum(l_partkey) / 1048576, 6) as mb from (select l_returnflag as l_shipmode, l_partkey from lineitem) group by 1")
def file_table(spark, sf_dir):
    return rounded(runs.file_table(read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_partkey").alias("length")), ["source"]))


@query(f"""with s as (select 0 as step, 'raw' as stage, source, text from documents union all select 1, 'english', source, text from documents where lang = 'en')
select step, stage, count(distinct source) as sources, count(*) as records, cast(sum({_WORDS}) as bigint) as tokens, round(sum(strlen(text)) / 1048576, 6) as mb from s group by 1, 2""")
def sized_funnel(spark, sf_dir):
    d = corpus(spark, sf_dir)
    return rounded(runs.sized_funnel({"raw": d, "english": d.filter("sub_domain = 'en'")})).select("step", "stage", "sources", "records", "tokens", "mb")


@query("select split_part(p_name, ' ', 1) as file, 'new' as run from part where p_size > 25 union select split_part(p_name, ' ', 1), 'old' from part where split_part(p_name, ' ', 1) not in (select split_part(p_name, ' ', 1) from part where p_size > 25)")
def report_upsert(spark, sf_dir):
    d = read(spark, sf_dir, "part").select(F.substring_index("p_name", " ", 1).alias("file"), "p_size")
    old, new = d.select("file").distinct().withColumn("run", F.lit("old")), d.filter("p_size > 25").select("file").distinct().withColumn("run", F.lit("new"))
    return clean.merge_reports(old, new)


# --- catalog rows and their licences ----------------------------------------------------------------------------------------

_LICENCES = {"1-URGENT": "MIT", "2-HIGH": "CC BY-NC 4.0", "3-MEDIUM": "", "4-NOT SPECIFIED": "Unknown", "5-LOW": "Apache-2.0"}


def _licensed(spark, sf_dir):
    told = F.lit(None).cast("string")
    for k, v in _LICENCES.items():
        told = F.when(F.col("o_orderpriority") == k, F.lit(v)).otherwise(told)
    d = read(spark, sf_dir, "orders")
    return d.select("o_orderkey", told.alias("license"), F.concat(F.lit("https://a.example/"), F.col("o_orderkey").cast("string")).alias("url"))


@query("select count(*) as total, count_if(o_orderpriority in ('1-URGENT', '2-HIGH', '5-LOW')) as filled, count_if(o_orderpriority not in ('1-URGENT', '2-HIGH', '5-LOW')) as unknown, count_if(o_orderpriority = '2-HIGH') as red from orders")
def licence_coverage(spark, sf_dir):
    return runs.licence_coverage(_licensed(spark, sf_dir))


@query("select case o_orderpriority when '2-HIGH' then 'blocked' when '1-URGENT' then 'ok' when '5-LOW' then 'ok' else 'unknown' end as verdict, count(*) as rows, count_if(o_orderpriority = '3-MEDIUM') as blank from orders group by 1")
def licence_verdicts(spark, sf_dir):
    return catalog.coverage(_licensed(spark, sf_dir))


@query("select 'https://a.example/' || o_orderkey as url from orders where o_orderpriority in ('3-MEDIUM', '4-NOT SPECIFIED')")
def blank_licence_links(spark, sf_dir):
    return runs.blank_licence_links(_licensed(spark, sf_dir))


@query("select o_orderkey from orders where o_orderpriority = '2-HIGH'")
def blacklist_split(spark, sf_dir):
    return catalog.blacklist(_licensed(spark, sf_dir))[1].select("o_orderkey")


@query("select o_orderpriority as licence, o_orderpriority in ('1-URGENT', '5-LOW') as ok, true as ok_ungated, count(*) as rows from orders group by 1")
def licence_gate(spark, sf_dir):
    d = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("licence")).join(_licensed(spark, sf_dir), "o_orderkey")
    c = F.col("license")
    return d.groupBy("licence", licence.gate(c)["ok"].alias("ok"), licence.gate(c, False)["ok"].alias("ok_ungated")).agg(F.count("*").alias("rows"))


@query("select coalesce(nullif(case when c_acctbal > 0 then c_mktsegment else ' ' end, ' '), 'Uncategorized') as value, count(*) as rows from customer group by 1")
def catalog_by_subdomain(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select(F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise(" ").alias("sub_domain"))
    return runs.counted(d, "sub_domain", "Uncategorized")


@query("select count(*) as sources, cast(sum(p_partkey) as double) as records, round(sum(case when p_size <= 40 then p_retailprice end), 2) as mb from part")
def catalog_totals(spark, sf_dir):
    d = read(spark, sf_dir, "part").select(F.format_number("p_partkey", 0).alias("records"), F.when(F.col("p_size") <= 40, F.col("p_retailprice").cast("string")).otherwise("n/a").alias("size_mb"))
    return rounded(catalog.totals(d), 2)


@query("select case when trim(c_mktsegment) = 'BUILDING' then 'HOUSES' else c_mktsegment end as sub_domain, count(*) as rows from customer group by 1")
def renamed_subdomain(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("sub_domain"))
    return catalog.rename_subdomain(d, "BUILDING", "HOUSES").groupBy("sub_domain").agg(F.count("*").alias("rows"))


@query(f"""with p as (select page_id, {_HOST} as sub_domain, regexp_replace(regexp_extract(lower(trim(url)), '(?s)^(?:[^/?#]*?://|//)?([^/?#]*)', 1), '^www\\.', '') || regexp_replace(lower({_PATH}), '/+$', '') as link from pages)
select page_id from p where link not in (select link from p where page_id in (0, 5)) and sub_domain <> 'thther.example.org' and page_id not in (3, 4)""")
def deleted_rows(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select("page_id", "url", urls.host(F.col("url")).alias("sub_domain"), F.col("page_id").alias("ordinal"))
    links = [r.url for r in d.filter("page_id in (0, 5)").collect()]
    return catalog.delete_rows(d, links, ("thther.example.org",), (3, 4)).select("page_id")


@query("""with x as (select p_partkey, trim(regexp_replace(upper(p_name), '[^A-Z0-9]+', '_', 'g'), '_') as c, row_number() over (partition by upper(p_name) order by p_partkey) as n from part)
select p_partkey, case when n > 1 then c || '_' || n else c end as code from x""")
def catalog_codes(spark, sf_dir):
    d = read(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("label"), F.format_string("%020d", F.col("p_partkey")).alias("place"))
    # names that differ only in what a code leaves out share it; the place decides which comes first
    return catalog.codes(d.withColumn("name", F.col("label")), "name", "place").select("p_partkey", "code")


_KIND_SQL = """case when contains(u, 'huggingface.co/datasets/') then 'hf' when contains(u, 'kaggle.com/datasets/') then 'kaggle' when contains(u, 'github.com/') then 'github'
 when regexp_matches(u, '\\.(rss|atom|xml)([?#].*)?$|/(feed|rss|atom)(s?/|s?$|s?[?#])') then 'rss' when u like '%.json' then 'feed' when u like '%.pdf' then 'pdf' when regexp_matches(u, '\\.(csv|jsonl|parquet|xlsx?|txt|zip|gz)$') then 'url' else 'site' end"""


def _links(spark, sf_dir):
    """Addresses of many kinds: each page's, on hosts and with endings that its scheme and path decide."""
    u, site = F.col("url"), F.col("url").startswith("https")
    made = F.when(u.contains("/en/") & site, F.concat(F.lit("https://huggingface.co/datasets/o"), F.col("page_id").cast("string"), F.lit("/d"))).when(u.contains("/en/"), F.concat(F.lit("https://GitHub.com/o/r"), F.col("page_id").cast("string")))
    made = made.when(u.contains("/fr/"), F.concat(u, F.lit(".csv"))).when(u.contains("/de/") & site, F.concat(u, F.lit("/feed"))).when(u.contains("/de/"), F.concat(u, F.lit(".pdf")))
    return read(spark, sf_dir, "pages").select("page_id", made.otherwise(u).alias("url"))


_LINKS = """l as (select page_id, case when contains(url, '/en/') and url like 'https%' then 'https://huggingface.co/datasets/o' || page_id || '/d' when contains(url, '/en/') then 'https://GitHub.com/o/r' || page_id
 when contains(url, '/fr/') then url || '.csv' when contains(url, '/de/') and url like 'https%' then url || '/feed' when contains(url, '/de/') then url || '.pdf' else url end as url from pages)"""


@query(f"with {_LINKS} select page_id, {_KIND_SQL.replace('u,', 'lower(trim(url)),').replace('u like', 'lower(trim(url)) like')} as kind from l")
def url_kinds(spark, sf_dir):
    return _links(spark, sf_dir).select("page_id", urls.kind(F.col("url"), F.lit("")).alias("kind"))


@query(f"with {_LINKS} select page_id, case when url like 'https://huggingface%' then 'hf:o' || page_id || '/d' else url end as key from l")
def descriptor_keys(spark, sf_dir):
    d = _links(spark, sf_dir)
    ref = F.regexp_extract("url", "datasets/(.*)", 1)
    return d.select("page_id", urls.descriptor_key(urls.kind(F.col("url"), F.lit("")), F.nullif(ref, F.lit("")), F.col("url"), F.lit("s")).alias("key"))


@query("select p_partkey, 'data/' || p_brand || '.parquet' as grp from part")
def shard_groups(spark, sf_dir):
    d = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("data/"), "p_brand", F.lit("-"), F.format_string("%05d", "p_size"), F.lit("-of-00050.parquet")).alias("file"))
    return records.shard_groups(d).select("p_partkey", F.col("group").alias("grp"))


@query("""select o_custkey as archive, case when bool_or(o_orderpriority = '1-URGENT') then 'unsafe path' when sum(o_totalprice) > 500000 then 'too large' end as reason from orders group by 1""")
def archive_refusals(spark, sf_dir):
    name = F.when(F.col("o_orderpriority") == "1-URGENT", "../x").otherwise("a/x")
    d = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("archive"), name.alias("name"), F.col("o_totalprice").alias("size"), F.col("o_totalprice").alias("packed"))
    return records.archive_refusal(d, (500000, 200_000, 200))


@query("select 'customer' as part, count(*) as rows, count(c_mktsegment) as segments, 0 as sizes from customer union all select 'part', count(*), 0, count(p_size) from part")
def header_union(spark, sf_dir):
    a = read(spark, sf_dir, "customer").select(F.lit("customer").alias("part"), "c_mktsegment")
    b = read(spark, sf_dir, "part").select(F.lit("part").alias("part"), "p_size")
    return records.combine([a, b]).groupBy("part").agg(F.count("*").alias("rows"), F.count("c_mktsegment").alias("segments"), F.count("p_size").cast("int").alias("sizes"))


# --- the catalog joined with what is on disk -----------------------------------------------------------------------------

_INGEST = """b as (select c_custkey, c_name as name, n_name as domain, c_mktsegment as kind, c_acctbal from customer join nation on n_nationkey = c_nationkey),
 f as (select o_custkey, count(*) as files, count_if(o_orderstatus = 'F') as records from orders where o_orderpriority = '1-URGENT' group by 1),
 i as (select name, domain, files, records, case when c_acctbal > 1000 then kind end as kind, case when c_acctbal < -500 then 'License denied' when c_acctbal < 0 then 'HTTP 404' end as reason from b left join f on o_custkey = c_custkey),
 s as (select *, case when records > 0 then 'ingested' when contains(lower(reason), 'license') then 'skipped' when reason is not null or files is not null then 'failed' else 'pending' end as status from i)"""


def _ingest(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("domain"))
    b = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).withColumnRenamed("c_name", "name")
    files = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("files"), F.count_if(F.col("o_orderstatus") == "F").alias("records"))
    on_disk = b.join(files, "c_custkey").select("name", "domain", "files", "records")
    meta = b.filter("c_acctbal > 1000").select("name", "domain", F.col("c_mktsegment").alias("kind"))
    failed = b.filter("c_acctbal < 0").select("name", "domain", F.when(F.col("c_acctbal") < -500, "License denied").otherwise("HTTP 404").alias("reason"))
    return catalog.ingest_table(b.select("name", "domain"), on_disk, meta, failed)


@query(f"with {_INGEST} select * from s")
def ingest_status(spark, sf_dir):
    return _ingest(spark, sf_dir)


@query(f"with {_INGEST} select name, status from s where status <> 'ingested'")
def sources_without_data(spark, sf_dir):
    return catalog.without_data(_ingest(spark, sf_dir)).select("name", "status")


_LAST = "l as (select o_custkey, arg_max(case o_orderstatus when 'O' then 'failed' when 'F' then 'ok' else 'ok (part)' end, o_orderkey) as status from orders group by 1)"


def _ledger(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "O", "failed").when(F.col("o_orderstatus") == "F", "ok").otherwise("ok (part)")
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), status.alias("status"), F.col("o_orderkey").alias("ordinal"))


@query(f"""with {_LAST} select c_mktsegment, count_if(status like 'ok%') as completed, count_if(status = 'failed') as failed, count(*) as total, round(100 * count_if(status like 'ok%') / count(*), 1) as pct
 from customer left join l on o_custkey = c_custkey group by 1""")
def ledger_progress(spark, sf_dir):
    return runs.progress(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), _ledger(spark, sf_dir), "c_custkey", ["c_mktsegment"])


@query("select c_custkey, not exists (select 1 from orders where o_custkey = c_custkey) as fresh from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderstatus <> 'O')")
def sources_to_do(spark, sf_dir):
    """What is left to do, failed ones again; fresh ones were never tried."""
    s, ledger = read(spark, sf_dir, "customer").select("c_custkey"), _ledger(spark, sf_dir)
    again, fresh = incremental.finished(s, ledger, "c_custkey", retry_failed=True), incremental.finished(s, ledger, "c_custkey")
    return again.join(fresh.withColumn("fresh", F.lit(True)), "c_custkey", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))


@query("select n_nationkey, r_name as descriptor, cast(r_regionkey as bigint) as ordinal from nation join region on r_regionkey = n_regionkey")
def described_rows(spark, sf_dir):
    """Rows meet the last descriptor of their source identity; addresses differ in scheme, case and last slash."""
    rows = read(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit("http://WWW.r.example/"), F.col("n_regionkey").cast("string"), F.lit("/")).alias("url"))
    r = read(spark, sf_dir, "region").select(F.concat(F.lit("https://r.example/"), F.col("r_regionkey").cast("string")).alias("url"), F.col("r_name").alias("label"), F.col("r_regionkey").cast("long").alias("ordinal"))
    older = r.withColumns({"label": F.lit("old"), "ordinal": F.lit(-1).cast("long")})
    return catalog.described(rows, r.unionByName(older)).select("n_nationkey", F.col("descriptor.label").alias("descriptor"), F.col("descriptor.ordinal").alias("ordinal"))


@query("select page_id, case when url like 'https%' then 'decline' when contains(url, '/en/') then 'approve' else 'review' end as verdict, url like 'https%' as declined from pages")
def review_verdicts(spark, sf_dir):
    u = F.col("url")
    d = read(spark, sf_dir, "pages").select("page_id", F.concat(u, F.lit("&i="), F.col("page_id").cast("string")).alias("raw"), u)
    d = d.select("page_id", F.concat(F.lit("https://h.example/"), F.col("page_id").cast("string")).alias("url"), F.when(u.startswith("https"), '{"verdict": "Decline"}').when(u.contains("/en/"), '{"verdict": "approved", "n": 1}').otherwise("no json").alias("reply"))
    kept, declined = catalog.apply_review(d, d.select("url", "reply"))
    both = kept.withColumn("declined", F.lit(False)).unionByName(declined.withColumn("declined", F.lit(True)))
    return both.select("page_id", catalog.verdict(F.col("reply")).alias("verdict"), "declined")


@query("""with v as (select * from (values ('animals', 'der '), ('animals', 'die '), ('plants', 'the '), ('plants', ' and '), ('rocks', 'les ')) t(d, t)),
 n as (select doc_id, d, count(*) as n from documents join v on contains(lower('x ' || text), t) group by 1, 2),
 m as (select doc_id, max(case when d = 'rocks' then n else 0 end) as own, max(n) as top, max(struct_pack(n := n, d := d)) as best from n group by 1)
select documents.doc_id, case when m.top > m.own then m.best.d else 'rocks' end as refined from documents left join m on m.doc_id = documents.doc_id""")
def refined_domains(spark, sf_dir):
    vocabulary = spark.createDataFrame([("animals", "der "), ("animals", "die "), ("plants", "the "), ("plants", " and "), ("rocks", "les ")], "sub_domain string, term string")
    d = corpus(spark, sf_dir).select("doc_id", F.lit("x").alias("title"), F.col("text").alias("snippet"), F.lit("rocks").alias("sub_domain"))
    return catalog.refine_domain(d, vocabulary, "doc_id").select("doc_id", "refined")


# --- logs -------------------------------------------------------------------------------------------------------------------


@query("""select step, stage, case when step < 2 then 'done' when step = 2 then 'running' else 'pending' end as state from (values (0, 'source'), (1, 'ingest'), (2, 'clean'), (3, 'eda'), (4, 'schema')) t(step, stage)
 where (select count(*) from events where event_type in ('view', 'click', 'purchase')) > 0""")
def stage_states(spark, sf_dir):
    kind = F.col("event_type")
    d = read(spark, sf_dir, "events").select(F.when(kind == "view", "source").when(kind == "click", "ingest").when(kind == "purchase", "clean").otherwise("?").alias("stage"), (kind == "view").alias("ended"))
    return runs.stage_states(d)


@query("select case when count_if(event_type = 'signup') > 0 then 'eda' end as stage from events")
def furthest_stage(spark, sf_dir):
    d = read(spark, sf_dir, "events").select(F.when(F.col("event_type") == "signup", "begin EDA now").when(F.col("event_type") == "view", "begin ingest").otherwise("schemata").alias("line"))
    return catalog.furthest(d)


@query("select user_id as session, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as started, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') as last, count(*) as lines from events group by 1 order by max(ts) desc, 1 desc limit 15")
def session_history(spark, sf_dir):
    """The newest 15 (the limit is the operator)."""
    d = runs.sessions(read(spark, sf_dir, "events").select(F.col("user_id").alias("session"), "ts"))
    return d.select("session", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("started", "last")], "lines")


@query("select event_id, ts_day as ts, event_type = 'view' as passed, case when event_type = 'error' then 0 else user_id end as total, 0.0::double as dup_rate, case when event_type = 'error' then 0.0 else 0.25 end::double as drift, 0.0::double as avg_tokens, 0::bigint as num_subdomains from (select *, event_id as ts_day from events)")
def eda_trend(spark, sf_dir):
    told = F.when(F.col("event_type") == "error", "broken").otherwise(F.concat(F.lit('{"total": '), F.col("user_id").cast("string"), F.lit(', "drift": {"max_delta": 0.25}}')))
    d = read(spark, sf_dir, "events").select(F.col("event_id").alias("ts"), (F.col("event_type") == "view").alias("passed"), told.alias("metrics"))
    return runs.trend(d).withColumn("event_id", F.col("ts"))


@query("""select event_id, case event_type when 'error' then 'HTTP 404' when 'click' then 'timed out' when 'view' then 'ValueError' when 'purchase' then 'no disk left' else 'all is well' end as reason from events""")
def failure_reasons(spark, sf_dir):
    kind = F.col("event_type")
    line = F.when(kind == "error", "get: HTTP 404 for x").when(kind == "click", "it timed out at last").when(kind == "view", "ValueError: x").when(kind == "purchase", "failed: no disk left").otherwise("all is well")
    return read(spark, sf_dir, "events").select("event_id", catalog.failure_reason(line).alias("reason"))


@query("select event_type as key, cast(sum(user_id) as bigint) as total from events group by 1 union all select 'runs', count(*) from events")
def merged_maps(spark, sf_dir):
    d = read(spark, sf_dir, "events").select(F.create_map("event_type", F.col("user_id"), F.lit("runs"), F.lit(1).cast("long")).alias("m"))
    return catalog.merged_maps(d, "m")


# --- balance ------------------------------------------------------------------------------------------------------------------

_LEAN = config.Gate(min_subdomain_share=0.14)


@query(f"""with {_D}, v as (select sub_domain, count(*) as records, count(*) / sum(count(*)) over () as share, avg(count(*)) over () as a from d group by 1),
 q as (select lang as sub_domain, count(*) as valid from documents join labels using (doc_id) where quality = 1 group by 1),
 p as (select v.*, coalesce(valid, 0) as valid, records < 0.25 * a or share < 0.14 as lacking from v left join q using (sub_domain))
select sub_domain, records, lacking, coalesce(greatest(max(valid) over (), max(case when lacking then valid end) over () + 25), 0) as row_target from p""")
def balance_plan(spark, sf_dir):
    d = corpus(spark, sf_dir)
    valid = d.join(read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"), "doc_id").groupBy("sub_domain").agg(F.count("*").alias("valid"))
    return runs.balance_plan(d, valid, _LEAN)


@query(f"with {_D}, v as (select count(*) as n, count(*) / sum(count(*)) over () as share, avg(count(*)) over () as a from d group by sub_domain) select count(*) > 0 and count_if(n < 0.25 * a or share < 0.14) = 0 and stddev_samp(n) / avg(n) <= {_LEAN.max_topic_cv} as balanced from v")
def corpus_balanced(spark, sf_dir):
    return runs.balanced(corpus(spark, sf_dir), _LEAN)


@query("select user_id, list_filter(['pattern', 'ckan', 'huggingface', 'github', 'arxiv', 'searxng'], lambda b: g > case b when 'pattern' then 5000 when 'ckan' then 1000 when 'huggingface' then 200 when 'github' then 200 else 0 end).array_to_string(',') as backends from (select user_id, sum(value) - 200 as g from events group by 1)")
def backend_choice(spark, sf_dir):
    d = read(spark, sf_dir, "events").groupBy("user_id").agg((F.sum("value") - 200).alias("g"))
    return d.select("user_id", F.array_join(sourcing.backends(F.col("g")), ",").alias("backends"))


@query("select control, true as passed from (values ('url_scheme'), ('url_credentials'), ('url_private'), ('url_link_local'), ('licence_default_deny'), ('licence_deny_first'), ('email_redacted'), ('canary_found'), ('archive_a.zip'), ('archive_b.zip')) t(control)")
def security_probes(spark, sf_dir):
    return runs.probes(spark)


# --- sourcing -----------------------------------------------------------------------------------------------------------------


@query("select c_custkey from customer where c_mktsegment in ('BUILDING', 'MACHINERY') and c_nationkey in (1, 2, 3)")
def selected_sources(spark, sf_dir):
    d = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("domain"), F.col("c_name").alias("key"), F.col("c_nationkey").cast("string").alias("country"))
    return sourcing.selected(d, ("BUILDING", "MACHINERY"), (), ("1", "2", "3")).select("c_custkey")


@query("select p_partkey, 'type:(' || p_type || ' OR ' || p_brand || ') AND size:(' || p_size || ')' as fq from part")
def portal_filter_query(spark, sf_dir):
    group = lambda f, *v: F.struct(F.lit(f).alias("field"), F.array(*v).alias("values"))
    groups = F.array(group(" type ", F.col("p_type"), F.lit(" "), F.col("p_brand")), group("", F.lit("x")), group("size", F.col("p_size").cast("string")), group("none", F.lit("")))
    return read(spark, sf_dir, "part").select("p_partkey", sourcing.filter_query(groups).alias("fq"))


@query("""select s_suppkey, case when s_acctbal > 0 then lower(replace(s_name, '#', '-')) else 'id-' || s_suppkey end as slug, 'https://p.example' || case when s_acctbal > 0 then '/api/3/action/show' else '/backend/find' end as url from supplier""")
def portal_addresses(spark, sf_dir):
    good = F.col("s_acctbal") > 0
    name = F.when(good, F.lower(F.replace("s_name", F.lit("#"), F.lit("-")))).otherwise(F.col("s_name"))
    d = read(spark, sf_dir, "supplier")
    return d.select("s_suppkey", sourcing.resource_slug(name, F.concat(F.lit("id-"), F.col("s_suppkey").cast("string"))).alias("slug"), sourcing.search_url(F.lit("https://p.example//"), F.when(good, "show").otherwise("/backend/find")).alias("url"))


@query(f"select doc_id, case when length({_STRIP.format('source')}) < 5 then 'title too short' when not contains(lower(source || chr(10) || text), 'the ') and not contains(lower(source || chr(10) || text), 'der ') then 'no domain keyword hit' else '' end as reason from documents")
def package_quality(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", sourcing.package_quality(F.col("source"), F.col("text"), F.array(F.lit("The "), F.lit("der ")), 5).alias("reason"))


@query("""select page_id || '' as name, case b when 'huggingface' then 'https://huggingface.co/datasets/' || page_id else url end as url, 'about ' || page_id as description, case b when 'searxng' then null else 'a,b' end as tags, b as backend
 from pages, (values ('huggingface'), ('github'), ('ckan'), ('searxng')) t(b)""")
def search_candidates(spark, sf_dir):
    n, u = F.col("page_id").cast("string"), F.col("url")
    about, two = F.concat(F.lit("about "), n), F.array(F.lit("a"), F.lit("b"))
    d = read(spark, sf_dir, "pages").select("page_id", "url")
    item = lambda *c: F.array(F.struct(*c))
    answers = {
        "huggingface": item(n.alias("id"), about.alias("description"), two.alias("tags")),
        "github": F.struct(item(n.alias("full_name"), u.alias("html_url"), about.alias("description"), two.alias("topics")).alias("items")),
        "ckan": F.struct(F.struct(item(n.alias("title"), u, about.alias("notes"), F.transform(two, lambda t: F.struct(t.alias("name"))).alias("tags")).alias("results")).alias("result")),
        "searxng": F.struct(item(n.alias("title"), u, about.alias("content")).alias("results")),
    }
    out = None
    for backend, answer in answers.items():
        got = sourcing.candidates(d.select(F.to_json(answer).alias("payload")), backend).withColumn("tags", F.array_join("tags", ","))
        out = got if out is None else out.unionByName(got)
    return out


@query("select p_partkey, p_name || ', ' || p_brand as tags from part")
def catalog_tags(spark, sf_dir):
    d = read(spark, sf_dir, "part")
    return d.select("p_partkey", sourcing.tags(F.array(F.concat(F.lit(" "), "p_name"), F.lit("size:1"), F.lit(" "), F.col("p_brand"))).alias("tags"))


@query(rf"""with {_LINKS}, m as (select l.page_id, l.url, 'Set of ' || l.page_id || ' - a page' as title, source as snippet from l left join documents on doc_id = l.page_id)
select page_id, case when url like 'https://huggingface%' then 'o' || page_id when url like 'https://GitHub%' then 'o' else 'Set of ' || page_id end as name, 'en' as sub_domain, 'Finance' as field, 'Global' as country, coalesce(snippet, '') as description from m""")
def catalog_rows(spark, sf_dir):
    d = _links(spark, sf_dir).join(read(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), "source"), "page_id", "left")
    d = d.select(F.concat(F.lit("Set of "), F.col("page_id").cast("string"), F.lit(" - a page")).alias("title"), F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("link"), F.coalesce("source", F.lit("")).alias("snippet"), F.lit("en").alias("sub_domain"))
    rows = sourcing.catalog_rows(d, "BANKING_COMPLIANCE", F.current_date())
    return rows.select(F.substring_index("url", "#", -1).cast("long").alias("page_id"), "name", "sub_domain", "field", "country", "description")


@query("""select p_partkey, case when p_size < 10 then 'own' when p_type = 'ECONOMY' then 'Network Security' when p_type = 'STANDARD' then 'Threat Intel' when p_type = 'PROMO' then 'Uncategorized' else p_type end as domain from part""")
def category_domains(spark, sf_dir):
    c = F.col("p_type")
    taxonomy = spark.createDataFrame([("Network Security", "NET"), ("Threat Intel", "TI")], "name string, code string")
    hints = spark.createDataFrame([("feeds", "threat-intel"), ("other", "Nowhere")], "category string, name string").withColumn("name", F.when(F.col("name") == "threat-intel", "Threat Intel").otherwise(F.col("name")))
    d = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") < 10, " own ").otherwise("").alias("sub_domain"), F.when(c == "ECONOMY", "network-security").when(c == "STANDARD", "Feeds").when(c == "PROMO", " ").otherwise(c).alias("category"))
    return sourcing.category_domain(d, taxonomy, hints).select("p_partkey", "domain")


@query("select n_name as name, 'old' as code from nation where n_regionkey not in (0, 1) union all select n_name, 'new' from nation where n_regionkey = 1")
def taxonomy_upsert(spark, sf_dir):
    """Nations of region 0 are removed, of region 1 replaced; names that can't be folders change nothing."""
    d = read(spark, sf_dir, "nation")
    r = F.col("n_regionkey")
    name = F.when(r == 2, F.concat("n_name", F.lit("/x"))).when(r == 3, F.concat(F.lit(" "), "n_name")).when(r == 4, "..").otherwise(F.col("n_name"))
    return sourcing.upsert_subdomains(d.select(F.col("n_name").alias("name"), F.lit("old").alias("code")), d.select(name.alias("name"), F.lit("new").alias("code"), (r == 0).alias("removed")))


_ADMIT = f"""h as (select page_id, {_HOST} as u, url from pages), e as (select distinct u from h where contains(url, '/de/')), r as (select *, case when contains(url, '/fr/') then 'listing page' else '' end as why from h),
 f as (select u, min(page_id) as one from r where why = '' group by 1), j as (select r.page_id, r.url, case when r.u in (select u from e) or r.page_id > f.one then 'duplicate' else why end as rejected from r left join f on f.u = r.u)"""


def _admitted(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select("page_id", F.col("url").alias("raw"), urls.host(F.col("url")).alias("url"))
    return sourcing.admitted(d, d.filter(F.col("raw").contains("/de/")), F.when(F.col("raw").contains("/fr/"), "listing page").otherwise(""), ["page_id"])


@query(f"with {_ADMIT} select page_id, rejected from j")
def admitted_candidates(spark, sf_dir):
    return _admitted(spark, sf_dir).select("page_id", "rejected")


@query(f"""with {_ADMIT} select 'added' as facet, split_part(url, ':', 1) as value, count(*) as rows from j where rejected = '' group by 2
 union all select 'country', split_part(split_part(url, '/', 3), '.', -1), count(*) from j where rejected = '' group by 2 union all select 'rejected', rejected, count(*) from j where rejected <> '' group by 2""")
def candidate_counts(spark, sf_dir):
    d = _admitted(spark, sf_dir).select("rejected", F.substring_index("raw", ":", 1).alias("backend"), F.substring_index(F.split_part("raw", F.lit("/"), F.lit(3)), ".", -1).alias("country"))
    return sourcing.run_counts(d)


@query(f"""with p as (select {_HOST} as host, url, regexp_replace(regexp_extract(lower(trim(url)), '(?s)^(?:[^/?#]*?://|//)?([^/?#]*)', 1), '^www\\.', '') || regexp_replace(lower({_PATH}), '/+$', '') as link from pages)
select host, count(*) as hits, count_if(link not in (select link from p where url like 'https%')) as new from p group by 1""")
def keyword_hits(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select("url", urls.host(F.col("url")).alias("host"))
    return sourcing.keyword_hits(d, d.filter(F.col("url").startswith("https")), ["host"])


@query(f"select {_HOST} as host, count(*) as scanned, count_if(contains(html, 'lang=\"en\"')) as found from pages group by 1")
def backfill_by_host(spark, sf_dir):
    return sourcing.backfill(read(spark, sf_dir, "pages"), F.regexp_extract("html", 'lang="(en)"', 1))


_SCAN = "s as (select doc_id, case when lang = 'en' then 'Yes' when lang = 'fr' then 'review' else 'No' end as suggested, coalesce(toxic = 1, false) as flag from documents left join labels using (doc_id))"


@query(f"with {_SCAN} select suggested, count(*) as rows, count_if(suggested = 'Yes' and not flag) as gaps, count_if(flag and suggested <> 'Yes') as disagreements from s group by 1")
def synthetic_scan(spark, sf_dir):
    l = F.col("lang")
    d = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    d = d.select("source", F.when(l == "en", "A GPT-generated set").when(l == "fr", "Question and answer").otherwise("Regenerated").alias("description"), F.when(F.col("toxic") == 1, "yes").alias("is_synthetic"))
    return sourcing.synthetic_counts(sourcing.synthetic_scan(d.withColumns({"name": F.col("source"), "category": F.lit("web"), "license": F.lit(None).cast("string")})))


@query(f"""select case when {_HOST} = 'example.org' or suffix({_HOST}, '.example.org') then '' when contains(url, '/de/') then 'off topic' when not contains(url, '/en/') then 'no signal' else '' end as prune, count(*) as rows from pages group by 1""")
def pruned_rows(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select(F.lit("n").alias("name"), F.lit("d").alias("description"), "url")
    return sourcing.prune_counts(d, ("example.org",), "/de/", "/en/")


@query(f"""with k as (select page_id, url, {_HOST} as host, least(1.0, ((case when contains(url, '/en/') then 1 else 0 end) + (case when contains(url, 'https') then 1 else 0 end)) / 1.0) as k from pages),
 s as (select page_id, url, k, case when suffix(host, '.example.org') then 1.0 else 0.3 end as h, 0.5 as c from k) select page_id, round(0.4 * k + 0.3 * h + 0.3 * c, 6) as relevance from s""")
def relevance_scores(spark, sf_dir):
    u = F.col("url")
    return rounded(read(spark, sf_dir, "pages").select("page_id", catalog.scores(F.lit("n"), u, u, ["/en/", "https"], ("example.org",), "India")["relevance"].alias("relevance")))


@query("""select k.r_name || s.x || t.x as query from region k, (values (''), (' site:a.example'), (' site:b.example')) s(x), (values (''), (' filetype:csv')) t(x)""")
def search_shots(spark, sf_dir):
    d = read(spark, sf_dir, "region").select(F.col("r_name").alias("keyword"))
    return catalog.shots(d, ["a.example", "b.example"], ["csv"]).select("query")


@query("select r_name, i as n, 'https://a.example/' || r_regionkey || '/' || i || '.csv' as url from region, range(1, 6) t(i)")
def pattern_addresses(spark, sf_dir):
    d = read(spark, sf_dir, "region").select("r_name", F.concat(F.lit("https://a.example/"), F.col("r_regionkey").cast("string"), F.lit("/")).alias("prefix"), F.lit(1).cast("long").alias("first"), F.lit(5).cast("long").alias("last"), F.lit(".csv").alias("suffix"))
    return catalog.pattern_urls(d).select("r_name", "n", "url")


@query("select p_partkey, case when p_size < 10 then 'MIT' when p_size < 20 then 'CC BY-SA 4.0' when p_size < 30 then 'CC0-1.0' else '' end as license from part")
def payload_licences(spark, sf_dir):
    size = F.col("p_size")
    d = read(spark, sf_dir, "part")
    found = F.when(size < 10, licence.from_payload(F.lit('{"license": {"spdx_id": "MIT"}}'), "github")).when(size < 20, licence.from_payload(F.lit('{"tags": ["license:cc-by-sa-4.0"]}'), "hf"))
    return d.select("p_partkey", found.when(size < 30, licence.from_payload(F.lit('{"licenseName": "CC0: Public Domain, creative commons zero"}'), "kaggle")).otherwise(licence.from_payload(F.lit("{}"), "hf")).alias("license"))


@query("select p_partkey, case when p_size > 25 then 'b.csv' else 'a.html' end as url from part")
def best_resources(spark, sf_dir):
    r = lambda u, f: F.struct(F.lit(u).alias("url"), f.alias("format"))
    both = F.array(r("a.html", F.lit("HTML")), r("b.csv", F.when(F.col("p_size") > 25, "CSV").otherwise("doc")))
    return read(spark, sf_dir, "part").select("p_partkey", catalog.best_resource(both)["url"].alias("url"))
