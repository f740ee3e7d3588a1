"""Normalisation onto the canonical record: mapping, validation as data, the hard pause, first wins, the manifest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from loamline import config
from loamline.functions import lang, text
from loamline.operators import clean
from loamline.session import table

VERSION = "loamline-1"
ABSTAIN = -1
RECORD_KINDS = ("cve", "log", "advisory", "playbook", "doc", "article", "other")
_LONGS, _INTS, _DOUBLES = {"token_count", "char_count"}, {"domain_label", "subdomain_label"}, {"confidence"}
FIELDS = (
    "id content_hash text source source_url license origin_format lang token_count char_count pipeline_version collected_at "
    "source_file record_type domain_label domain_name subdomain_label subdomain_name safe_unsafe confidence instruction reviewed_by"
).split()
NULLABLE = {"source_url", "safe_unsafe", "confidence", "instruction", "reviewed_by"}
CANONICAL = StructType([StructField(f, LongType() if f in _LONGS else IntegerType() if f in _INTS else DoubleType() if f in _DOUBLES else StringType(), f in NULLABLE) for f in FIELDS])

Mapper = Callable[[DataFrame], Column]
#: Mappers by name: a function from a table of records to their text column (null: no usable text).
MAPPERS: dict[str, Mapper] = {}


def register_mapper(name: str) -> Callable[[Mapper], Mapper]:
    def put(f: Mapper) -> Mapper:
        MAPPERS[name] = f
        return f

    return put


@register_mapper("generic")
def generic(df: DataFrame) -> Column:
    return F.nullif(text.without_boilerplate(F.col("text")), F.lit(""))


@register_mapper("structured")
def structured(df: DataFrame) -> Column:
    """Prose if there is any, else the row's fields as `name: value` text."""
    names = [c for c in df.columns if c.lower() not in ("text", "id", "index", "unnamed: 0")]
    return F.coalesce(generic(df), F.nullif(text.without_boilerplate(text.fields_text(names)), F.lit("")))


def resolve_domain(df: DataFrame, domains: DataFrame, c: str = "sub_domain") -> DataFrame:
    """df with domain_name and subdomain_name by domains (name, domain_name, subdomain_name; names or aliases, in any
    case); null where unknown, which rejects the record. The table is a taxonomy: small, and joined as Spark sees fit."""
    key = lambda x: F.regexp_replace(F.lower(text.strip(x)), r"[\s_\-]+", " ")
    table = domains.select(key(F.col("name")).alias("_name"), "domain_name", "subdomain_name").groupBy("_name").agg(F.min(F.struct("domain_name", "subdomain_name")).alias("_d"))
    return df.join(table, key(F.col(c)) == F.col("_name"), "left").withColumns({"domain_name": F.col("_d.domain_name"), "subdomain_name": F.col("_d.subdomain_name")}).drop("_name", "_d")


def build(df: DataFrame, mapper: str = "generic", written: bool = False) -> DataFrame:
    """Records (text, source, url, license, file, sub_domain and whatever a mapper uses, domain names resolved) with
    the canonical fields in `record`, and the columns of df. written: the mapped text is written and read back first,
    so that the fields that are counted from it don't map it again."""
    have = set(df.columns)
    df = df.withColumn("_mapped", MAPPERS[mapper](df))
    df, t = (table(df, "mapped") if written else df), F.col("_mapped")
    col = lambda n: F.col(n) if n in have else F.lit(None).cast("string")
    file = F.coalesce(col("file"), col("source"), F.lit(""))
    values = {
        "id": F.uuid(), "content_hash": text.content_hash(t), "text": t, "source": F.coalesce(col("source"), file), "source_url": col("url"),
        "license": F.coalesce(col("license"), F.lit("")), "origin_format": text.origin_format(file), "lang": F.when(lang.detect(F.substring(t, 1, 1000)) == "non-latin", "unknown").otherwise("en"),
        "token_count": text.token_count(t).cast("long"), "char_count": F.length(t).cast("long"), "pipeline_version": F.lit(VERSION),
        "collected_at": F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'"), "source_file": file,
        "record_type": known_kind(text.record_type(file, col("source"))), "domain_label": F.lit(ABSTAIN), "domain_name": col("domain_name"), "subdomain_label": F.lit(ABSTAIN),
        "subdomain_name": col("subdomain_name"), "safe_unsafe": col("safe_unsafe"), "confidence": col("confidence").cast("double"), "instruction": col("instruction"), "reviewed_by": col("reviewed_by"),
    }
    return df.withColumn("record", F.struct(*[values[f].alias(f) for f in FIELDS])).drop("_mapped")


def validate(c: Column, floor: int = 20, licences_required: bool = False) -> Column:
    """The first rule that a canonical record breaks, or null."""
    t = text.strip(c["text"])
    blank = lambda f: F.coalesce(text.strip(c[f]), F.lit("")) == ""
    out = F.when(c["text"].isNull(), "no usable text").when(F.length(t) < floor, F.lit(f"text shorter than {floor} chars"))
    out = out.when(~c["content_hash"].rlike("^[0-9a-f]{64}$"), "content_hash must be 64 hex digits")
    for f in ("source", "source_file", "origin_format", "lang", "pipeline_version"):
        out = out.when(blank(f), F.lit(f"{f} must not be empty"))
    if licences_required:
        out = out.when(blank("license"), "license must not be empty")
    out = out.when(c["domain_name"].isNull() | c["subdomain_name"].isNull(), "unknown domain")
    out = out.when((c["domain_label"] < ABSTAIN) | (c["subdomain_label"] < ABSTAIN), "label not in range")
    out = out.when(~c["confidence"].between(0.0, 1.0), "confidence not in [0, 1]")
    out = out.when(~c["safe_unsafe"].isin("SAFE", "UNSAFE"), "safe_unsafe not in SAFE, UNSAFE")
    return out.otherwise(F.lit(None).cast("string"))


def known_kind(c: Column) -> Column:
    return F.when(c.isin(*RECORD_KINDS), c).otherwise("other")


def hard_pause(df: DataFrame, rejected: Column, by: str, order: list[str], limit: int = 20) -> DataFrame:
    """df with `paused`: `limit` rejects of the source came before, by order.

    Only rejects are ordered: the limit-th reject of a source is found among at most `limit` of each block (a hash of
    the order), so no source's rows meet in one task; then every row is compared with that place."""
    at = F.struct(*order)
    d = df.withColumn("_at", at)
    bad = d.filter(rejected).select(by, "_at").withColumn("_block", F.pmod(F.xxhash64("_at"), F.lit(64)))
    per = F.row_number().over(Window.partitionBy(by, "_block").orderBy("_at"))
    few = bad.withColumn("_n", per).filter(F.col("_n") <= limit).withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("_at")))
    cut = few.filter(F.col("_n") == limit).select(F.col(by).alias("_by"), F.col("_at").alias("_cut"))
    d = d.join(cut, F.col(by).eqNullSafe(F.col("_by")), "left")
    return d.withColumn("paused", F.coalesce(F.col("_at") > F.col("_cut"), F.lit(False))).drop("_at", "_by", "_cut")


def reject_accounting(df: DataFrame, most: int = 20) -> dict[str, DataFrame]:
    """Rejects (source, reason) by source, by reason (the most frequent) and by category."""
    return {
        "source": df.groupBy("source").agg(F.count("*").alias("rejects")),
        "reason": df.groupBy("reason").agg(F.count("*").alias("rejects")).orderBy(F.desc("rejects"), "reason").limit(most),
        "category": df.groupBy(text.failure_category(F.col("reason")).alias("category")).agg(F.count("*").alias("rejects")),
    }


def process(df: DataFrame, domains: DataFrame, order: list[str], synthetic: DataFrame | None = None, conf: config.Normalize = config.Normalize(), mapper: str = "generic") -> DataFrame:
    """Each record with `record`, `outcome` (written, duplicate, rejected, skipped_no_text, synthetic, paused) and
    `reason`. synthetic: a table of `identity`, of sources whose records are diverted."""
    from loamline.functions import urls

    d = build(resolve_domain(df, domains), mapper, written=True)
    if synthetic is not None and "url" in df.columns:
        marks = synthetic.select(F.col("identity").alias("_syn")).distinct()
        d = d.withColumn("_id", urls.source_identity(F.col("url"))).join(marks, F.col("_id") == F.col("_syn"), "left").withColumn("_synthetic", F.col("_syn").isNotNull()).drop("_id", "_syn")
    else:
        d = d.withColumn("_synthetic", F.lit(False))
    d = d.withColumn("reason", F.when(~F.col("_synthetic") & F.col("record.text").isNotNull(), validate(F.col("record"), conf.text_floor)))
    d = table(d, "validated")  # read by the pause and by the dedup
    d = hard_pause(d, F.col("reason").isNotNull(), "source", order, conf.pause)
    ok = ~F.col("paused") & ~F.col("_synthetic") & F.col("record.text").isNotNull() & F.col("reason").isNull()
    key = F.when(ok, text.token_fingerprint(F.col("record.text"))).otherwise(F.concat_ws(":", F.lit("none"), *[F.col(c).cast("string") for c in order]))
    d = clean.first_wins(d, key, [F.col(c) for c in order])
    outcome = F.when(F.col("paused"), "paused").when(F.col("_synthetic"), "synthetic").when(F.col("record.text").isNull(), "skipped_no_text").when(F.col("reason").isNotNull(), "rejected").when(F.col("duplicate"), "duplicate").otherwise("written")
    return d.withColumn("outcome", outcome).drop("_synthetic", "paused", "duplicate", "dup_reason")


FACETS = ("domain_name", "subdomain_name", "source", "license", "origin_format", "record_type", "lang")


def facets(records: DataFrame, names: tuple[str, ...] = FACETS) -> DataFrame:
    """facet, value, records of each named column, in one pass over grouping sets made by unpivoting."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("facet"), F.coalesce(F.col(n).cast("string"), F.lit("")).alias("value")) for n in names]))
    return records.select(pairs.alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("records"))


def manifest_totals(records: DataFrame) -> DataFrame:
    return records.agg(F.count("*").alias("records"), F.count_distinct("content_hash").alias("distinct_hashes"), F.sum("token_count").alias("tokens"), F.sum("char_count").alias("chars"))


def fingerprint(records: DataFrame, c: str = "content_hash") -> DataFrame:
    """One hash of a set of records, whatever their order: sums of halves of the hashes, which merge in any order."""
    part = lambda k: F.sum(F.conv(F.substring(c, k, 12), 16, 10).cast("decimal(38,0)"))
    return records.agg(F.sha2(F.concat_ws(":", *[part(k).cast("string") for k in (1, 13, 25, 37)], F.count("*").cast("string")), 256).alias("fingerprint"))


def page(records: DataFrame, order: list[str], facets: dict[str, str] | None = None, search: str = "", offset: int = 0, limit: int = 50, fields: tuple[str, ...] = ("text", "source")) -> tuple[DataFrame, DataFrame]:
    """(rows of the page, total matches) by facet equality and a substring in any case."""
    d = records
    for k, v in (facets or {}).items():
        d = d.filter(F.col(k) == v)
    if search:
        met = F.lit(False)
        for f in fields:
            met = met | F.lower(f).contains(search.lower())
        d = d.filter(met)
    return d.orderBy(*order).offset(offset).limit(limit), d.agg(F.count("*").alias("matches"))


def missing_canaries(records: DataFrame, planted: DataFrame, c: str = "text") -> DataFrame:
    """Planted tokens (token) that no record carries."""
    found = records.select(F.explode(text.found_canaries(F.col(c))).alias("token")).distinct()
    return planted.join(found, "token", "left_anti")


