"""Feeds: JSON lists, vulnerability records, weakness catalogs in XML, RSS and Atom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import text


def json_feed(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """record (VARIANT) of each element of a feed's list: of `key`, else of the longest list-valued field."""
    d = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    if key:
        items = F.try_variant_get("v", f"$.{key}", "array<variant>")
    else:
        fields = F.map_values(F.try_variant_get("v", "$", "map<string,variant>"))
        lists = F.array_compact(F.transform(fields, lambda x: F.try_variant_get(x, "$", "array<variant>")))
        longest = F.array_max(F.transform(lists, lambda x: F.size(x)))
        items = F.coalesce(F.try_variant_get("v", "$", "array<variant>"), F.get(F.filter(lists, lambda x: F.size(x) == longest), F.lit(0)))
    return d.select(F.explode(items).alias("record"))


def _field(v: Column, path: str) -> Column:
    return F.nullif(text.strip(F.try_variant_get(v, path, "string")), F.lit(""))


def _joined(*parts: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*parts)), "\n\n")


def exploited(v: Column) -> Column:
    """The text of a known-exploited vulnerability's record."""
    return _joined(_field(v, "$.cveID"), _field(v, "$.vulnerabilityName"), _field(v, "$.shortDescription"), _field(v, "$.requiredAction"))


def attack_object(v: Column) -> Column:
    """The text of a threat catalog's object: name, description and its phases."""
    phases = F.array_join(F.transform(F.try_variant_get(v, "$.kill_chain_phases", "array<struct<phase_name:string>>"), lambda p: p["phase_name"]), ", ")
    return _joined(_field(v, "$.name"), _field(v, "$.description"), F.nullif(phases, F.lit("")))


def generic(v: Column) -> Column:
    return _joined(_field(v, "$.title"), _field(v, "$.name"), F.coalesce(_field(v, "$.description"), _field(v, "$.summary"), _field(v, "$.content")))


def vulnerability(v: Column) -> Column:
    """The text block of a vulnerability: id, English description, severity by the newest metric, weaknesses, references."""
    said = F.get(F.filter(F.try_variant_get(v, "$.descriptions", "array<struct<lang:string,value:string>>"), lambda x: x["lang"] == "en"), F.lit(0))["value"]
    severity = F.coalesce(*[_field(v, p) for p in (
        "$.metrics.cvssMetricV31[0].cvssData.baseSeverity", "$.metrics.cvssMetricV30[0].cvssData.baseSeverity", "$.metrics.cvssMetricV2[0].baseSeverity")])
    refs = F.array_join(F.slice(F.transform(F.try_variant_get(v, "$.references", "array<struct<url:string>>"), lambda r: r["url"]), 1, 10), "\n")
    return _joined(_field(v, "$.id"), said, F.concat(F.lit("Severity: "), severity), F.concat(F.lit("References:\n"), F.nullif(refs, F.lit(""))))


def weaknesses(spark: SparkSession, path: str) -> DataFrame:
    """id, text of each Weakness of an XML catalog. The schema is told, so that no name is read as a date."""
    schema = "_ID string, _Name string, Description string, Extended_Description string"
    d = spark.read.format("xml").option("rowTag", "Weakness").schema(schema).load(path)
    name = F.concat(F.lit("CWE-"), F.col("_ID"), F.lit(": "), F.col("_Name"))
    return d.select(F.col("_ID").alias("id"), _joined(name, F.col("Description"), F.col("Extended_Description")).alias("text"))


def _tag(c: Column, *names: str) -> Column:
    """The content of the first of some elements, without CDATA marks, tags and entities."""
    found = F.coalesce(*[F.nullif(F.regexp_extract(c, rf"(?is)<(?:\w+:)?{n}\b[^>]*>(.*?)</(?:\w+:)?{n}>", 1), F.lit("")) for n in names])
    bare = F.regexp_replace(found, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(entity), F.lit(sign))
    return F.nullif(text.strip(F.regexp_replace(bare, r"<[^>]+>", " ")), F.lit(""))


def items(d: DataFrame, c: str = "body", metadata_only: bool = False) -> DataFrame:
    """title, link, summary, published, guid, text of each item or entry of RSS 2.0 and Atom bodies."""
    each = d.select(F.explode(F.regexp_extract_all(F.col(c), F.lit(r"(?is)(<(?:item|entry)\b.*?</(?:item|entry)>)"), F.lit(1))).alias("x"))
    x = F.col("x")
    href = F.nullif(F.regexp_extract(x, r"""(?is)<link\b[^>]*\bhref\s*=\s*["']([^"']+)""", 1), F.lit(""))
    each = each.select(_tag(x, "title").alias("title"), F.coalesce(_tag(x, "link"), href).alias("link"), _tag(x, "description", "summary", "encoded", "content").alias("summary"), _tag(x, "pubDate", "published", "updated", "date").alias("published"), F.coalesce(_tag(x, "guid", "id"), href).alias("guid"))
    if metadata_only:
        each = each.withColumn("summary", F.lit(None).cast("string"))
    return each.withColumn("text", F.concat_ws("\n\n", "title", "summary"))


def is_page(c: Column) -> Column:
    """A page was sent where a feed was asked for."""
    return F.lower(F.substring(F.ltrim(c), 1, 200)).rlike(r"^<!doctype html|^<html")


def search_results(payload: DataFrame, c: str = "payload") -> DataFrame:
    """title, link, snippet of each result of a search engine's JSON."""
    r = F.from_json(c, "results array<struct<title:string,url:string,content:string>>")
    return payload.select(F.explode(r["results"]).alias("r")).select(F.col("r.title").alias("title"), F.col("r.url").alias("link"), F.col("r.content").alias("snippet"))
