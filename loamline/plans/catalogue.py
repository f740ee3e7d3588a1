"""Every query of the engine's own operators, over the driver's tables, and the SQL that states its result.

`documents` stands for the corpus: sub_domain is lang, the file is the source, the ordinal is doc_id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline import config
from loamline.functions import hazards, html, lang, licence, pii, text, urls
from loamline.operators import catalog, clean, metrics, neardup, normalize, runs
from loamline.session import ship
from loamline.sources import records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if sql:
            ORACLES[key] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.spread(read(spark, sf_dir, "documents").select("doc_id", "text", "source", F.col("lang").alias("sub_domain")))


def rounded(d: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to some digits: engines add in different orders."""
    return d.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in d.dtypes])


# Pieces of the SQL.
_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_T = _STRIP.format("text")
_FP = r"sha256(trim(regexp_replace(lower(text), '[\s\p{Z}]+', ' ', 'g')))"
_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_WORDS = r"len(regexp_extract_all(text, '[^\s\p{Z}]+'))"
_D = "d as (select doc_id, text, source, lang as sub_domain from documents)"

# --- scalar functions --------------------------------------------------------------------------------------------------


@query(f"select doc_id, {_FP} as fingerprint from documents")
def exact_fingerprint(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", text.exact_fingerprint(F.col("text")).alias("fingerprint"))


@query(f"select doc_id, sha256(array_to_string({_TOKENS}, ' ')) as fingerprint from documents")
def token_fingerprint(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", text.token_fingerprint(F.col("text")).alias("fingerprint"))


@query(rf"select doc_id, sha256(text) as content_hash, cast(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+')) as int) as token_count, cast({_WORDS} as int) as word_count, cast(length(text) as int) as char_count from documents")
def content_hash_counts(spark, sf_dir):
    t = F.col("text")
    return corpus(spark, sf_dir).select("doc_id", text.content_hash(t).alias("content_hash"), text.token_count(t).alias("token_count"), text.word_count(t).alias("word_count"), F.length(t).alias("char_count"))


_LINES = rf"list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIP.format('x')}), lambda x: x <> '')"
_REPEATED = f"case when len({_LINES}) >= 5 then 1 - len(list_distinct({_LINES})) / len({_LINES}) else 0.0 end"


@query(f"select doc_id, round({_REPEATED}, 6) as ratio from documents")
def repeated_line_ratio(spark, sf_dir):
    return rounded(corpus(spark, sf_dir).select("doc_id", text.repeated_line_ratio(F.col("text")).alias("ratio")))


_TOP = f"case when len({_TOKENS}) >= 20 then list_aggregate(map_values(list_aggregate({_TOKENS}, 'histogram')), 'max') / len({_TOKENS}) else 0.0 end"


@query(f"select doc_id, round({_TOP}, 6) as ratio from documents")
def top_token_ratio(spark, sf_dir):
    return rounded(corpus(spark, sf_dir).select("doc_id", text.top_token_ratio(F.col("text")).alias("ratio")))


_PLAIN = text.PLAIN.replace("'", "''")
_GARBAGE = rf"case when length(text) > 0 then len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}\p{{Z}}\s{_PLAIN}]')) / length(text) else 0.0 end"


@query(f"select doc_id, round({_GARBAGE}, 6) as ratio from documents")
def garbage_ratio(spark, sf_dir):
    return rounded(corpus(spark, sf_dir).select("doc_id", text.garbage_ratio(F.col("text")).alias("ratio")))


_TIDY = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\r\n?', chr(10), 'g'),
 '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '[ \t\p{Z}]+\n', chr(10), 'g'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"""


@query(f"select doc_id, sha256({_TIDY}) as tidy_sha256 from documents")
def sanitized_text(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", F.sha2(text.sanitized(F.col("text")), 256).alias("tidy_sha256"))


@query(r"select doc_id, sha256(regexp_replace(text, '\b[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_-]+\.[\p{L}\p{N}_.-]+\b', '<EMAIL_ADDRESS>', 'g')) as redacted from documents")
def email_redaction(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", F.sha2(pii.redact_emails(F.col("text")), 256).alias("redacted"))


@query()
def pii_redaction(spark, sf_dir):
    d = corpus(spark, sf_dir).withColumn("p", pii.redact(F.col("text")))
    return d.select("doc_id", F.col("p.n").alias("spans"), F.sha2("p.text", 256).alias("redacted_sha256"))


def _spots_sql() -> str:
    each = ", ".join(f"""case when regexp_matches(text, '{p.replace("'", "''")}') then '{n}' end""" for n, p in sorted(pii.BLIND_SPOTS.items()))
    return f"select doc_id, array_to_string(list_filter([{each}], lambda x: x is not null), ',') as spots from documents"


@query(_spots_sql())
def pii_blind_spots(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", F.array_join(pii.blind_spots(F.col("text")), ",").alias("spots"))


_STOP = "|".join(lang.STOPWORDS)
_OTHER = r"[\x{0400}-\x{04FF}\x{0600}-\x{06FF}\x{0900}-\x{097F}\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}\x{AC00}-\x{D7AF}\x{0590}-\x{05FF}]"
_LANG = rf"""case when text is null or not regexp_matches(text, '[^\s\p{{Z}}]') then 'unknown'
 when len(regexp_extract_all(substr(text, 1, 2000), '{_OTHER}')) > greatest(len(regexp_extract_all(substr(text, 1, 2000), '[A-Za-z]')), 10) then 'non-latin'
 when len(regexp_extract_all(substr(text, 1, 2000), '[A-Za-z]+')) >= 10 and
  len(list_filter(regexp_extract_all(lower(substr(text, 1, 2000)), '[a-z]+'), lambda w: regexp_full_match(w, '{_STOP}'))) / len(regexp_extract_all(substr(text, 1, 2000), '[A-Za-z]+')) >= 0.05 then 'en'
 else 'unknown' end"""


@query(f"select doc_id, {_LANG} as detected from documents")
def lang_heuristic(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", lang.detect(F.col("text")).alias("detected"))


@query(f"with l as (select lang, {_LANG} as detected from documents) select lang, detected, detected in ('en', 'unknown') as allowed, count(*) as records from l group by all")
def lang_policy_split(spark, sf_dir):
    d = corpus(spark, sf_dir).select(F.col("sub_domain").alias("lang"), lang.detect(F.col("text")).alias("detected"))
    return d.withColumn("allowed", lang.allowed(F.col("detected"))).groupBy("lang", "detected", "allowed").agg(F.count("*").alias("records"))


@query(r"""with w as (select doc_id, list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> '') as w from documents)
select doc_id, case when len(w) = 0 then 0 else len(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' ')))) end as shingles from w""")
def shingle_counts(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", F.size(text.shingles(text.split_words(F.col("text")), 5)).cast("long").alias("shingles"))


@query()
def minhash_signatures(spark, sf_dir):
    s = text.minhash(text.shingles(text.split_words(F.col("text")), 5), 128)
    return corpus(spark, sf_dir).select("doc_id", F.sha2(F.array_join(F.transform(s, lambda x: x.cast("string")), ","), 256).alias("signature_sha256"))


@query("""select source, case when lower(' ' || source || ' ' || source || ' ') like '%cve%' then 'cve' else 'article' end as record_type,
 regexp_replace(lower(source), '[^a-z0-9]+', '-', 'g') as slug, count(*) as records from documents group by all""")
def record_types(spark, sf_dir):
    s = F.col("source")
    return corpus(spark, sf_dir).groupBy("source", text.record_type(s, s).alias("record_type"), text.slug(s).alias("slug")).agg(F.count("*").alias("records"))


@query("select i, 'CANARY-' || substr(sha256('release:' || i), 1, 32) as token from range(100) t(i)")
def canary_tokens(spark, sf_dir):
    return spark.range(100).select(F.col("id").alias("i"), text.canary("release", F.col("id")).alias("token"))


@query("select count(*) as missing from range(100)")
def canary_missing(spark, sf_dir):
    planted = spark.range(100).select(text.canary("release", F.col("id")).alias("token"))
    return normalize.missing_canaries(corpus(spark, sf_dir), planted).agg(F.count("*").alias("missing"))


# --- cleaning ------------------------------------------------------------------------------------------------------------

_KIND = f"""case when text is null then 'structural' when length({_T}) < 50 then 'structural' when length({_T}) > 100000 then 'behavioral'
 when {_GARBAGE} > 0.3 then 'behavioral' when {_REPEATED} > 0.5 then 'behavioral' when {_TOP} > 0.5 then 'behavioral' else 'clean' end"""


@query(f"select doc_id, {_KIND} as kind from documents")
def anomaly_route(spark, sf_dir):
    return corpus(spark, sf_dir).select("doc_id", clean.classify(F.col("text")).getField("kind").alias("kind"))


@query(f"with x as (select source, doc_id, row_number() over (partition by {_FP} order by doc_id) as n from documents) select doc_id, source from x where n = 1")
def exact_dedup_first_wins(spark, sf_dir):
    d = clean.first_wins(corpus(spark, sf_dir), text.exact_fingerprint(F.col("text")), [F.col("doc_id")])
    return d.filter("not duplicate").select("doc_id", "source")


@query(f"with x as (select doc_id, row_number() over (partition by {_FP} order by doc_id) as n from documents) select doc_id, 'exact duplicate' as reason from x where n > 1")
def dedup_dropped_with_reason(spark, sf_dir):
    d = clean.first_wins(corpus(spark, sf_dir), text.exact_fingerprint(F.col("text")), [F.col("doc_id")])
    return d.filter("duplicate").select("doc_id", F.col("dup_reason").alias("reason"))


@query(f"select count(*) as n_in, count(distinct {_FP}) as kept, count(*) - count(distinct {_FP}) as dups from documents")
def dedup_stats(spark, sf_dir):
    fp = text.exact_fingerprint(F.col("text"))
    return corpus(spark, sf_dir).agg(F.count("*").alias("n_in"), F.count_distinct(fp).alias("kept"), (F.count("*") - F.count_distinct(fp)).alias("dups"))


@query("select source, max(doc_id) as doc_id from documents group by source")
def last_wins(spark, sf_dir):
    return clean.last_wins(corpus(spark, sf_dir), ["source"], ["doc_id"]).select("source", "doc_id")


@query(f"""with k as (select distinct {_FP} as f from documents where lang = 'en') select doc_id from documents where {_FP} not in (select f from k)""")
def resume_by_journal(spark, sf_dir):
    """What the corpus adds to a journal that has its English part."""
    d = corpus(spark, sf_dir)
    fp = text.exact_fingerprint(F.col("text"))
    return clean.not_in_journal(d, fp, d.filter("sub_domain = 'en'").select(fp.alias("fingerprint"))).select("doc_id")


def _cleaned(spark, sf_dir) -> DataFrame:
    d = clean.clean(corpus(spark, sf_dir))
    key = F.when(F.col("route") == "clean", text.exact_fingerprint(F.col("text"))).otherwise(F.concat(F.lit("row:"), F.col("doc_id").cast("string")))
    return clean.first_wins(d, key, [F.col("source"), F.col("doc_id")])


@query()
def clean_report(spark, sf_dir):
    return clean.report(_cleaned(spark, sf_dir), ["sub_domain", "source"])


@query()
def clean_routes(spark, sf_dir):
    d = _cleaned(spark, sf_dir)
    return d.groupBy("route", "stage", "duplicate").agg(F.count("*").alias("records"))


@query()
def loss_top_reason(spark, sf_dir):
    return catalog.loss(clean.report(_cleaned(spark, sf_dir), ["sub_domain", "source"]).filter("sub_domain != 'TOTAL'"))


def _plain(spark, sf_dir) -> DataFrame:
    """The chain without redaction, which SQL can state."""
    none = lambda c: F.struct(c.alias("text"), F.lit(0).alias("n"))
    d = clean.clean(corpus(spark, sf_dir), redactor=none)
    key = F.when(F.col("route") == "clean", text.exact_fingerprint(F.col("text"))).otherwise(F.concat(F.lit("row:"), F.col("doc_id").cast("string")))
    return clean.first_wins(d, key, [F.col("source"), F.col("doc_id")])


_CHAIN = f"""a as (select doc_id, source, lang as sub_domain, case when {_T} <> '' then text end as raw from documents),
 b as materialized (select doc_id, source, sub_domain, raw, coalesce({_TIDY.replace("text", "raw", 1)}, '') as text from a),
 k as materialized (select *, case when raw is null then 'excluded' else {_KIND} end as kind, {_LANG} as detected, {_FP} as f from b),
 r as (select *, kind = 'clean' and detected not in ('en', 'unknown') as lost from k),
 c as (select *, case when kind = 'structural' or lost then 'dropped' when kind = 'behavioral' then 'flagged' when kind = 'excluded' then 'excluded' else 'clean' end as route,
  case when lost then 'language' when kind in ('structural', 'behavioral') then 'anomaly' when kind = 'excluded' then 'textmap' end as stage,
  raw is distinct from text or {_TIDY.replace("text", "source", 1)} is distinct from source as sanitized, raw is null or length({_STRIP.format('raw')}) < 50 as was_bad from r),
 d as (select *, row_number() over (partition by case when route = 'clean' then f else 'row:' || doc_id end order by source, doc_id) > 1 as duplicate from c),
 g as (select sub_domain, source, count(*) as n_in, count_if(route = 'clean' and not duplicate) as n_out, count_if(route = 'dropped' and stage = 'anomaly') as struct_dropped, count_if(route = 'flagged') as flagged,
  count_if(route = 'excluded') as excluded_no_text, count_if(coalesce(stage, '') = 'language') as lang_dropped, count_if(route = 'clean' and duplicate) as exact_dups, count_if(sanitized) as sanitized,
  count_if(was_bad and sanitized and kind not in ('structural', 'excluded')) as struct_fixed, count_if(false) as pii_records, cast(0 as bigint) as pii_spans, count_if(false) as mapped_text, count_if(false) as translated
  from d group by grouping sets ((sub_domain, source), ()))"""


@query(f"with {_CHAIN} select case when sub_domain is null and source is null then 'TOTAL' else sub_domain end as sub_domain, coalesce(source, '') as source, * exclude (sub_domain, source) from g")
def clean_report_unredacted(spark, sf_dir):
    return clean.report(_plain(spark, sf_dir), ["sub_domain", "source"])


@query(f"with {_CHAIN} select route, stage, duplicate, count(*) as records from d group by all")
def clean_routes_unredacted(spark, sf_dir):
    return _plain(spark, sf_dir).groupBy("route", "stage", "duplicate").agg(F.count("*").alias("records"))


@query(f"""with {_CHAIN}, s as (select source, {", ".join(f"cast(sum({x}) as bigint) as {x}" for x in ("n_in", "n_out", *catalog.MECHANISMS))} from g where source is not null group by 1)
select *, {" + ".join(catalog.MECHANISMS)} as lost, round(100.0 * n_out / n_in, 1) as kept_pct,
 case when {" + ".join(catalog.MECHANISMS)} > 0 then case greatest({", ".join(catalog.MECHANISMS)}) {" ".join(f"when {x} then '{x}'" for x in catalog.MECHANISMS)} end end as top_reason from s""")
def loss_top_reason_unredacted(spark, sf_dir):
    return catalog.loss(clean.report(_plain(spark, sf_dir), ["sub_domain", "source"]).filter("sub_domain != 'TOTAL'"))


@query("""with t as (select conv_id, turn, case lower(role) when 'user' then 'User' when 'assistant' then 'Assistant' else upper(role[1]) || lower(role[2:]) end || ': ' || """ + _T + """ as part
 from conversations where lower(role) <> 'system' and """ + _T + """ <> '')
select c.conv_id, sha256(string_agg(part, chr(10) || chr(10) order by turn, part)) as text_sha256, count(*) as turns from (select distinct conv_id from conversations) c join t using (conv_id) group by 1""")
def chat_to_text(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    said = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.col("role"), F.col("text").alias("content")))).alias("messages"))
    d = clean.map_text(said).filter("text is not null")
    used = F.size(F.filter("messages", lambda t: (F.lower(t["role"]) != "system") & (text.strip(t["content"]) != "")))
    return d.select("conv_id", F.sha2("text", 256).alias("text_sha256"), used.cast("long").alias("turns"))


# --- metrics and gate ------------------------------------------------------------------------------------------------------


@query(f"""with {_D}, x as (select *, {_T} as s, {_WORDS} as w from d)
select count(*) as total, count_if(s = '') as empty, count(distinct source) as sources, count(distinct sub_domain) as subdomains,
 round((count(nullif(s, '')) - count(distinct nullif(s, ''))) / count(nullif(s, '')), 6) as dup_rate, round(avg(case when s <> '' then length(s) end), 6) as avg_chars,
 round(avg(case when s <> '' then w end), 6) as avg_tokens, round(median(case when s <> '' then w end), 6) as median_tokens, cast(min(case when s <> '' then w end) as int) as min_tokens from x""")
def corpus_metrics(spark, sf_dir):
    return rounded(metrics.corpus(corpus(spark, sf_dir)))


@query(f"with {_D} select sub_domain, count(*) as records, count(distinct source) as num_sources, round(count(*) / sum(count(*)) over (), 6) as share from d group by 1")
def corpus_volume(spark, sf_dir):
    return rounded(metrics.volume(corpus(spark, sf_dir)))


_CONC = f"""with {_D}, c as (select sub_domain, source, count(*) as records from d group by 1, 2),
r as (select *, records / sum(records) over (partition by sub_domain) as share, row_number() over (partition by sub_domain order by records desc, source) as place from c)"""


@query(f"{_CONC} select sub_domain, source, records, round(share, 6) as share, cast(place as int) as place from r")
def source_concentration(spark, sf_dir):
    return rounded(metrics.concentration(corpus(spark, sf_dir)))


@query(f"{_CONC} select sub_domain, source, round(share, 6) as worst_share, n as num_sources from (select *, count(*) over (partition by sub_domain) as n from r) where place = 1")
def worst_concentration(spark, sf_dir):
    return rounded(metrics.worst(corpus(spark, sf_dir)))


@query(f"with {_D} select sub_domain, count(*) as records, round(avg(length(text)), 6) as avg_chars, round(avg({_WORDS}), 6) as avg_tokens, round(median({_WORDS}), 6) as median_tokens, cast(min({_WORDS}) as int) as min_tokens from d group by 1")
def text_quality(spark, sf_dir):
    return rounded(metrics.quality(corpus(spark, sf_dir)))


@query(f"with {_D} select round(stddev_samp(n) / avg(n), 6) as topic_cv from (select count(*) as n from d group by sub_domain)")
def topic_cv(spark, sf_dir):
    return rounded(metrics.topic_cv(corpus(spark, sf_dir)))


_SHARES = "select lang as sub_domain, count(*) / sum(count(*)) over () as s from documents {0} group by 1"


@query(f"""with a as ({_SHARES.format('')}), b as ({_SHARES.format('join labels using (doc_id)')}) select coalesce(a.sub_domain, b.sub_domain) as sub_domain, round(coalesce(a.s, 0), 6) as share_now,
 round(coalesce(b.s, 0), 6) as share_before, round(abs(coalesce(a.s, 0) - coalesce(b.s, 0)), 6) as delta from a full join b on a.sub_domain = b.sub_domain""")
def distribution_drift(spark, sf_dir):
    """From the labelled documents to all."""
    d = corpus(spark, sf_dir)
    return rounded(metrics.drift(metrics.volume(d), metrics.volume(d.join(read(spark, sf_dir, "labels").select("doc_id"), "doc_id"))))


_STRICT = config.Gate(max_source_share=0.05, max_topic_cv=0.1, min_subdomain_share=0.2, max_dup_rate=0.01)


@query(f"""{_CONC}, x as (select *, {_T} as s from d), v as (select sub_domain, count(*) as n, count(*) / sum(count(*)) over () as share from d group by 1)
select 'warning' as severity, 'duplicates' as "check", '' as subject, round(q, 6) as value from (select (count(nullif(s, '')) - count(distinct nullif(s, ''))) / count(nullif(s, '')) as q from x) where q > 0.01
union all select 'warning', 'subdomain_underrepresented', sub_domain, round(share, 6) from v where share < 0.2
union all select 'warning', 'concentration', sub_domain || '/' || source, round(share, 6) from r where place = 1 and share > 0.05
union all select 'warning', 'topic_balance', '', round(q, 6) from (select stddev_samp(n) / avg(n) as q from v) where q > 0.1""")
def gate_violations(spark, sf_dir):
    return rounded(metrics.gate(corpus(spark, sf_dir), conf=_STRICT))


@query("""with v as (select lang as sub_domain, count(*) as records, count(*) / sum(count(*)) over () as share, avg(count(*)) over () as a from documents group by 1)
select 'under_represented' as kind, sub_domain, records, round(share, 6) as share, cast(floor(a) as bigint) as target from v where records < 0.25 * a or share < 0.2
union all select 'over_represented', sub_domain, records, round(share, 6), cast(floor(2 * a) as bigint) from v where records > 4 * a""")
def feedback_rows(spark, sf_dir):
    return rounded(metrics.feedback(corpus(spark, sf_dir), config.Gate(min_subdomain_share=0.2)))


@query("""with v as (select lang as sub_domain, count(*) as records from documents group by 1)
select sub_domain, records, round(100 * records / sum(records) over (), 6) as pct, cast(floor(median(records) over ()) as bigint) as median, records > 5 * floor(median(records) over ()) as heavy from v""")
def balance_report(spark, sf_dir):
    return rounded(metrics.balance(corpus(spark, sf_dir)))


@query("""with x as (select doc_id, lang as sub_domain, row_number() over (partition by lang order by sha256('42:' || doc_id), doc_id) as n from documents) select doc_id, sub_domain from x where n <= 100""")
def domain_cap(spark, sf_dir):
    return metrics.domain_cap(corpus(spark, sf_dir), 100, ["doc_id"]).select("doc_id", "sub_domain")


@query()
def source_cap(spark, sf_dir):
    """Sub-domains are event types, sources are thirds of the users: no source passes a low ceiling after the cut."""
    d = read(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("sub_domain"), (F.col("user_id") % 3).cast("string").alias("source"))
    d = metrics.source_cap(d, ["event_id"], 0.34)
    return d.groupBy("sub_domain", "source").agg(F.count("*").alias("records"))


@query("select doc_id from documents order by sha256('42:' || doc_id), doc_id limit 100")
def reservoir_sample(spark, sf_dir):
    """A sample of 100 (the limit is the operator)."""
    return metrics.sample(corpus(spark, sf_dir), 100, ["doc_id"]).select("doc_id")


@query(f"""with x as (select *, {_T} as s, {_GARBAGE} as g, row_number() over (partition by source order by doc_id) as n from documents)
select source, count(*) as sampled, count_if(false) as parse_errors, round(count_if(s = '') / count(*), 6) as empty_rate, round(coalesce(median(case when s <> '' then g end), 0), 6) as median_garbage,
 case when count_if(s = '') / count(*) > 0.8 then 'empty rate' when coalesce(median(case when s <> '' then g end), 0) > 0.5 then 'garbage ratio' else '' end as reason from x where n <= 200 group by 1""")
def first_200_sample_assessment(spark, sf_dir):
    return rounded(metrics.light_gate(corpus(spark, sf_dir), ["doc_id"]))


@query("select lang as sub_domain, count(*) as valid, greatest(0, 500 - count(*)) as deficit from documents group by 1")
def subdomain_deficits(spark, sf_dir):
    return metrics.deficits(corpus(spark, sf_dir), 500)


# --- pages ---------------------------------------------------------------------------------------------------------------


def _hazard_sql() -> str:
    parts = []
    for field in ("html", "url"):
        for t, s, p in hazards.HAZARDS:
            if field in hazards.STRUCTURED or t != "shell_injection":
                parts.append(f"""select page_id, '{field}' as field, '{t}' as type, '{s}' as severity, len(regexp_extract_all({field}, '{p.replace("'", "''")}')) as n from pages""")
    return " union all ".join(parts)


@query(f"select page_id, field, type, severity, cast(n as int) as n from ({_hazard_sql()}) where n > 0")
def hazard_findings(spark, sf_dir):
    return hazards.findings(read(spark, sf_dir, "pages").select("page_id", "html", "url"), "page_id", ["html", "url"])


@query(f"select type, cast(sum(n) as bigint) as n, max(severity) as severity from ({_hazard_sql()}) where n > 0 group by 1")
def hazard_summary(spark, sf_dir):
    return hazards.summary(hazard_findings(spark, sf_dir))


@query(r"select page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) as title from pages")
def html_title(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", html.title(F.col("html")).alias("title"))


@query(r"""select page_id, unnest(list_distinct(list_filter(list_transform(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1), lambda x: regexp_replace(x, '#.*$', '')), lambda x: x <> ''))) as link from pages""")
def html_links(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.explode(html.links(F.col("html"))).alias("link"))


@query()
def html_text(spark, sf_dir):
    d = read(spark, sf_dir, "pages").withColumn("text", html.text("html"))
    return d.filter(F.length("text") > html.LEAST).select("page_id", F.length("text").alias("chars"), F.sha2("text", 256).alias("text_sha256"))


@query()
def page_licence(spark, sf_dir):
    f = licence.from_html(F.col("html"))
    return read(spark, sf_dir, "pages").select("page_id", f.alias("license"), licence.verdict(f).alias("verdict"))


_AUTH = r"regexp_extract(trim(url), '(?s)^(?:[^/?#]*?://|//)?([^/?#]*)', 1)"
_HOST = rf"regexp_replace(regexp_replace(lower(regexp_replace({_AUTH}, '^.*@', '')), ':.*$', ''), '^www\.', '')"
_PATH = r"regexp_extract(trim(url), '(?s)^(?:[^/?#]*?://|//)?[^/?#]*([^?#]*)', 1)"
_QUERY = r"regexp_extract(trim(url), '(?s)\?([^#]*)', 1)"


def _under_sql(domains) -> str:
    return " or ".join(f"host = '{d}' or suffix(host, '.{d}')" for d in domains)


@query(f"""with h as (select page_id, {_HOST} as host, string_split(lower({_PATH}), '/') as seg, '&' || {_QUERY} as q from pages)
select page_id, host, case when host = '' or not contains(host, '.') then 'bad link' when {_under_sql(urls.JUNK_HOSTS)} then 'junk host' when {_under_sql(urls.RESTRICTED_HOSTS)} then 'restricted host'
 when list_has_any(seg, {list(urls.LISTING_SEGMENTS)}) or regexp_matches(q, '&q=[^&]') then 'listing page' else '' end as reason from h""")
def page_host_class(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.host(u).alias("host"), urls.quality(u).alias("reason"))


@query(r"""with u as (select page_id, lower(trim(url)) as u from pages)
select page_id, case when u = '' then null when regexp_matches(u, '/datasets/[^/?#]+/[^/?#]+') then (case when contains(u, 'huggingface.co') then 'hf:' when contains(u, 'kaggle.com') then 'kaggle:' else 'ds:' end) || regexp_extract(u, '/datasets/([^/?#]+/[^/?#]+)', 1)
 else 'url:' || regexp_replace(regexp_replace(regexp_replace(regexp_replace(u, '^https?://', ''), '[?#].*$', ''), '^www\.', ''), '/+$', '') end as identity from u""")
def source_identity(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.source_identity(F.col("url")).alias("identity"))


@query("select page_id, case when regexp_matches(trim(url), '(?s)^https?://[^/?#]*@') then 'credentials in URL' when regexp_matches(trim(url), '^https?://[^/?#]') then '' else 'no scheme' end as reason from pages")
def url_screen(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.screen(F.col("url")).alias("reason"))


@query("""select page_id, case when lower(url) like '%.pdf' then 'Document' when regexp_matches(lower(url), '\\.(csv|json|jsonl|parquet|xlsx|txt)$') then 'Dataset' when regexp_matches(lower(url), '\\.(rss|atom|xml)$|/feed|/rss') then 'Feed'
 when regexp_matches(lower(url), '^[^/?#]*?://api\\.|/api/|graphql') then 'API' else 'Website' end as category from pages""".replace("\\\\", "\\"))
def url_category(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", urls.category_and_format(F.col("url")).getField("category").alias("category"))


@query(f"""with p as (select page_id, regexp_replace(regexp_extract(lower(trim(url)), '(?s)^(?:[^/?#]*?://|//)?([^/?#]*)', 1), '^www\\.', '') || regexp_replace(lower({_PATH}), '/+$', '') as link from pages)
select page_id from p where link not in (select link from p where page_id in (select page_id from pages where url like 'https%'))""")
def catalog_anti_join(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select("page_id", "url")
    return catalog.new_links(d, d.filter(F.col("url").startswith("https"))).select("page_id")


@query(f"""with h as (select {_HOST} as host from pages), d as (select host, unnest(list_transform(generate_series(1, len(string_split(host, '.'))), lambda k: array_to_string(string_split(host, '.')[k:], '.'))) as domain from h)
select domain, count(*) as pages from d group by 1""")
def host_suffixes(spark, sf_dir):
    d = read(spark, sf_dir, "pages").select(F.explode(urls.suffixes(urls.host(F.col("url")))).alias("domain"))
    return d.groupBy("domain").agg(F.count("*").alias("pages"))


# --- licences --------------------------------------------------------------------------------------------------------------

_LOW = r"trim(regexp_replace(lower(text), '[\s\p{Z}]+', ' ', 'g'))"
_DENY, _ALLOW = (rf"(^|[^\p{{L}}\p{{N}}_])({'|'.join(x)})($|[^\p{{L}}\p{{N}}_])" for x in (licence.DENY, licence.ALLOW))


@query(rf"""with l as (select doc_id, {_LOW} as s from documents) select doc_id, case when regexp_matches(s, '{_DENY}') then 'blocked' when regexp_matches(s, '{_ALLOW}') then 'ok' else 'unknown' end as verdict,
 not regexp_matches(s, '{_DENY}') and regexp_matches(s, '{_ALLOW}') as ok from l""")
def licence_verdict(spark, sf_dir):
    t = F.col("text")
    return corpus(spark, sf_dir).select("doc_id", licence.verdict(t).alias("verdict"), licence.classify(t).getField("ok").alias("ok"))


# --- normalisation -----------------------------------------------------------------------------------------------------------

_KNOWN = (("en", "banking", "en_core"), ("de", "banking", "de_core"), ("fr", "audit", "fr_core"))


def _records(spark, sf_dir) -> DataFrame:
    d = corpus(spark, sf_dir).join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    d = d.withColumns({"file": F.concat("source", F.lit(".jsonl")), "safe_unsafe": F.when(F.col("toxic") == 1, "UNSAFE").when(F.col("toxic") == 0, "SAFE")})
    domains = spark.createDataFrame(list(_KNOWN), "name string, domain_name string, subdomain_name string")
    return normalize.process(d, domains, ["doc_id"])


_BOILER = r"(?im)^\s*(?:" + "|".join(text.BOILERPLATE) + r")\s*$"
_CLEANED = rf"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g'), '{_BOILER}', '', 'g'), '[ \t\x{{00A0}}]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"""
_NORM = rf"""t as (select d.doc_id, d.source, d.lang as sub_domain, l.toxic, {_CLEANED} as t from documents d left join labels l on l.doc_id = d.doc_id),
 v as (select *, case when length(t) = 0 then null when length(t) < 20 then 'text shorter than 20 chars' when sub_domain not in ('en', 'de', 'fr') then 'unknown domain' end as reason from t),
 p as (select *, coalesce(sum(case when reason is not null then 1 else 0 end) over (partition by source order by doc_id rows between unbounded preceding and 1 preceding), 0) >= 20 as paused from v),
 w as (select *, not paused and length(t) > 0 and reason is null as ok, sha256(array_to_string(regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}_]+'), ' ')) as f from p),
 o as (select *, case when paused then 'paused' when length(t) = 0 then 'skipped_no_text' when reason is not null then 'rejected' when row_number() over (partition by ok, f order by doc_id) > 1 then 'duplicate' else 'written' end as outcome from w)"""


@query(f"with {_NORM} select outcome, count(*) as records from o group by 1")
def normalize_outcomes(spark, sf_dir):
    return _records(spark, sf_dir).groupBy("outcome").agg(F.count("*").alias("records"))


@query(rf"""with {_NORM} select doc_id, sha256(t) as content_hash, source, source || '.jsonl' as source_file, 'jsonl' as origin_format, len(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+')) as token_count, length(t) as char_count,
 'article' as record_type, -1 as domain_label, case when sub_domain = 'fr' then 'audit' else 'banking' end as domain_name, sub_domain || '_core' as subdomain_name, case toxic when 1 then 'UNSAFE' when 0 then 'SAFE' end as safe_unsafe from o where outcome = 'written'""")
def canonical_records(spark, sf_dir):
    names = "content_hash source source_file origin_format token_count char_count record_type domain_label domain_name subdomain_name safe_unsafe".split()
    return _records(spark, sf_dir).filter("outcome = 'written'").select("doc_id", *[F.col(f"record.{n}").alias(n) for n in names])


@query(f"with {_NORM} select case when reason like 'text%' or reason like '%domain%' then 'DIRTY_DATA' else 'AMBIGUOUS' end as category, count(*) as rejects from o where outcome = 'rejected' group by 1")
def reject_categories(spark, sf_dir):
    return normalize.reject_accounting(_records(spark, sf_dir).filter("outcome = 'rejected'"))["category"]


@query(f"with {_NORM} select reason, count(*) as rejects from o where outcome = 'rejected' group by 1 order by 2 desc, 1 limit 20")
def reject_reasons_top20(spark, sf_dir):
    return normalize.reject_accounting(_records(spark, sf_dir).filter("outcome = 'rejected'"))["reason"]


@query("""with e as (select event_id, user_id, value < 2 as bad from events), p as (select *, coalesce(sum(bad::int) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding), 0) >= 3 as paused from e)
select event_id, paused from p""")
def hard_pause(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_id", "user_id", "value")
    return normalize.hard_pause(d, F.col("value") < 2, "user_id", ["event_id"], 3).select("event_id", "paused")


_FACETS = ("source", "sub_domain")


@query("select 'source' as facet, source as value, count(*) as records from documents group by 2 union all select 'sub_domain', lang, count(*) from documents group by 2")
def manifest_facets(spark, sf_dir):
    return normalize.facets(corpus(spark, sf_dir), _FACETS)


@query(rf"select count(*) as records, count(distinct sha256(text)) as distinct_hashes, cast(sum(len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+'))) as bigint) as tokens, cast(sum(length(text)) as bigint) as chars from documents")
def manifest_totals(spark, sf_dir):
    t = F.col("text")
    d = corpus(spark, sf_dir).select(text.content_hash(t).alias("content_hash"), text.token_count(t).alias("token_count"), F.length(t).alias("char_count"))
    return normalize.manifest_totals(d)


_PART = "cast(sum(cast('0x' || substr(h, {0}, 12) as bigint)) as varchar)"


@query(f"select sha256(concat_ws(':', {', '.join(_PART.format(k) for k in (1, 13, 25, 37))}, cast(count(*) as varchar))) as fingerprint from (select sha256(text) as h from documents)")
def corpus_fingerprint(spark, sf_dir):
    return normalize.fingerprint(corpus(spark, sf_dir).select(text.content_hash(F.col("text")).alias("content_hash")))


@query("select doc_id, source from documents where lang = 'en' and contains(lower(text), 'the') order by doc_id limit 25 offset 10")
def facet_search(spark, sf_dir):
    """A page of 25 (the limit is the operator)."""
    return normalize.page(corpus(spark, sf_dir), ["doc_id"], {"sub_domain": "en"}, "the", 10, 25, ("text",))[0].select("doc_id", "source")


@query("select d.doc_id, case toxic when 1 then 'UNSAFE' when 0 then 'SAFE' end as safe_unsafe from documents d left join labels l on l.doc_id = d.doc_id")
def labels_join(spark, sf_dir):
    d = corpus(spark, sf_dir).select("doc_id").join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return d.select("doc_id", F.when(F.col("toxic") == 1, "UNSAFE").when(F.col("toxic") == 0, "SAFE").alias("safe_unsafe"))


# --- near duplicates ---------------------------------------------------------------------------------------------------------

_PAIRS = r"""w as (select doc_id, list_filter(regexp_split_to_array(text, '[\s\p{Z}]+'), lambda x: x <> '') as w from documents),
 s as (select doc_id, unnest(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i:i + 4], ' ')))) as s from w where len(w) > 0),
 n as (select doc_id, count(*) as n from s group by 1),
 c as (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2),
 p as (select a, b, c / (na.n + nb.n - c) as jaccard from c join n na on na.doc_id = a join n nb on nb.doc_id = b where c / (na.n + nb.n - c) >= 0.85)"""


@query(f"with {_PAIRS} select a, b, round(jaccard, 6) as jaccard from p")
def near_dup_pairs(spark, sf_dir):
    return rounded(neardup.pairs(corpus(spark, sf_dir)))


@query(f"""with recursive {_PAIRS}, e as (select b, list(a) as near, row_number() over (order by b) as i from p group by b),
 k as (select 0::bigint as i, (select list(distinct a) from p where a not in (select b from p)) as kept
  union all select k.i + 1, case when list_has_any(e.near, k.kept) then k.kept else list_append(k.kept, e.b) end from k join e on e.i = k.i + 1),
 z as (select kept from k order by i desc limit 1)
select id, list_contains((select kept from z), id) as kept from (select a as id from p union select b from p)""")
def near_dup_first_wins(spark, sf_dir):
    return neardup.first_wins(neardup.pairs(corpus(spark, sf_dir)))


# --- runs: timelines, ledgers, funnels ----------------------------------------------------------------------------------------


@query("""select event_id, round(case when epoch_us(ts) > lag(epoch_us(ts)) over w then greatest(0, value - lag(value) over w) / ((epoch_us(ts) - lag(epoch_us(ts)) over w) / 1e6) end, 6) as rate
 from events window w as (partition by event_type order by ts, event_id)""")
def event_rate(spark, sf_dir):
    d = read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return rounded(catalog.rates(d, "event_type", "ts", "value", "event_id").select("event_id", "rate"))


@query("""with s as (select event_type as stage, min(ts) as started from events group by 1) select stage, strftime(started, '%Y-%m-%d %H:%M:%S.%f') as started, strftime(lead(started) over (order by started, stage), '%Y-%m-%d %H:%M:%S.%f') as ended from s""")
def stage_timeline(spark, sf_dir):
    return catalog.timeline(read(spark, sf_dir, "events"), "event_type", "ts").select("stage", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ("started", "ended")])


@query("""select user_id % 20 as run, count_if(event_type = 'view') as found, count_if(event_type = 'purchase') as candidates, count_if(event_type = 'click') as duplicates, count_if(false) as bad_link, count_if(false) as junk_host,
 count_if(false) as restricted_host, count_if(false) as listing_page, count_if(false) as dropped, greatest(0, count_if(event_type = 'view') - count_if(event_type = 'click') - count_if(event_type = 'purchase')) as unprocessed from events group by 1""")
def sourcing_funnel(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "hit").when(F.col("event_type") == "purchase", "candidate").when(F.col("event_type") == "click", "duplicate").otherwise("other")
    d = read(spark, sf_dir, "events").select((F.col("user_id") % 20).alias("run"), kind.alias("kind"), F.lit("").alias("category"))
    return catalog.sourcing_funnel(d)


@query("""select o_orderstatus as status, count(*) as sources, round(100 * count(*) / sum(count(*)) over (), 6) as pct from orders group by 1""")
def ingest_funnel(spark, sf_dir):
    return rounded(catalog.ingest_funnel(read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))))


@query("""select count(distinct coalesce(nullif(l_returnflag, ''), l_linestatus)) as sources, cast(sum(l_linenumber) as bigint) as records, cast(sum(l_partkey) as bigint) as bytes, count_if(l_linestatus like 'O%') as ok from lineitem""")
def ledger_stats(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("url"), F.col("l_linestatus").alias("name"), F.col("l_linenumber").alias("records"), F.col("l_partkey").alias("bytes"), F.when(F.col("l_linestatus") == "O", "ok").otherwise("failed").alias("status"))
    return catalog.ledger_stats(d)


@query("""with x as (select o_custkey, o_orderkey, o_orderpriority, row_number() over (partition by o_orderpriority order by o_orderkey) as n from orders) select o_orderkey, o_orderpriority, cast(n as int) as round from x where n <= 50 order by n, o_orderpriority, o_orderkey limit 120""")
def round_robin(spark, sf_dir):
    """At most 50 of each group and 120 in all (the caps are the operator)."""
    d = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return catalog.interleaved(d, "o_orderpriority", ["o_orderkey"], 50, 120)


@query("select p_partkey, p_size from part order by p_size nulls last, p_partkey limit 100")
def smallest_first(spark, sf_dir):
    """The first hundred in the order of fetching (the limit is the operator)."""
    d = read(spark, sf_dir, "part").select("p_partkey", "p_size", F.col("p_size").alias("size_mb"), F.lit("http://a/b.csv").alias("url"), F.lit("Dataset").alias("category"), F.col("p_partkey").alias("ordinal"))
    return catalog.read_catalog(d).select("p_partkey", "p_size").limit(100)


@query("""select c.c_custkey, c.c_name, n.n_name, r.r_name, count(o.o_orderkey) as orders, case when count(o.o_orderkey) > 0 then 'ingested' else 'pending' end as status
 from customer c left join nation n on c_nationkey = n_nationkey left join region r on n_regionkey = r_regionkey left join orders o on o_custkey = c_custkey group by all""")
def ingest_table(spark, sf_dir):
    """The shape of catalog, metadata and files on disk: the facts are aggregated before they join."""
    orders = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"))
    d = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left").join(orders, "c_custkey", "left")
    n = F.coalesce("orders", F.lit(0))
    return d.select("c_custkey", "c_name", "n_name", "r_name", n.alias("orders"), F.when(n > 0, "ingested").otherwise("pending").alias("status"))


@query(f"select 0 as step, 'raw' as stage, count(distinct source) as sources, count(*) as records, cast(sum({_WORDS}) as bigint) as tokens from documents union all select 1, 'english', count(distinct source), count(*), cast(sum({_WORDS}) as bigint) from documents where lang = 'en'")
def data_funnel(spark, sf_dir):
    d = corpus(spark, sf_dir)
    return catalog.data_funnel({"raw": d, "english": d.filter("sub_domain = 'en'")})


@query("select l_returnflag as source, l_linestatus as name, count(*) as files, round(sum(l_quantity), 6) as mb from lineitem group by 1, 2")
def raw_table(spark, sf_dir):
    d = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("name"), (F.col("l_quantity") * runs.MB).alias("length"))
    return rounded(runs.file_table(d, ["source", "name"]))
