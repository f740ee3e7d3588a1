"""From search results to catalog rows: selection, quality, names, domains and tags, and what a run's candidates came to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import hazards, text, urls
from loamline.operators import catalog

# --- selection ----------------------------------------------------------------------------------------------------------


def selected(descriptors: DataFrame, domains: tuple[str, ...] = (), keys: tuple[str, ...] = (), countries: tuple[str, ...] = ()) -> DataFrame:
    """Descriptors (domain, key, country) of what is asked for; nothing asked for is no condition."""
    for c, wanted in (("domain", domains), ("key", keys), ("country", countries)):
        descriptors = descriptors.filter(F.col(c).isin(*wanted)) if wanted else descriptors
    return descriptors


#: Backends from the most to the least reliable, and up to which gap one isn't asked.
BACKENDS = {"pattern": 5000, "ckan": 1000, "huggingface": 200, "github": 200, "arxiv": 0, "searxng": 0}


def backends(gap: Column, enabled: tuple[str, ...] = tuple(BACKENDS)) -> Column:
    """The backends that a gap of so many rows is filled from."""
    return F.array_compact(F.array(*[F.when(gap > least, F.lit(b)) for b, least in BACKENDS.items() if b in enabled]).cast("array<string>"))


# --- portals ------------------------------------------------------------------------------------------------------------


def search_url(base: Column, action: Column) -> Column:
    """The address of a portal's action: a name under its API, or a path taken as it is."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.when(action.startswith("/"), action).otherwise(F.concat(F.lit("/api/3/action/"), action)))


def filter_query(groups: Column) -> Column:
    """`field:(a OR b) AND ...` of groups (field, values); blank fields and values are left out."""
    full = F.transform(groups, lambda g: F.struct(text.strip(g["field"]).alias("f"), F.array_join(F.filter(F.transform(g["values"], text.strip), lambda v: v != ""), " OR ").alias("v")))
    return F.array_join(F.transform(F.filter(full, lambda g: (g["f"] != "") & (g["v"] != "")), lambda g: F.concat(g["f"], F.lit(":("), g["v"], F.lit(")"))), " AND ")


def resource_slug(name: Column, ident: Column) -> Column:
    """A resource's part of an address: its name, if that can stand there, else its id."""
    n = F.coalesce(text.strip(name), F.lit(""))
    return F.when(n.rlike("^[a-z0-9][a-z0-9-]*$"), n).otherwise(F.coalesce(text.strip(ident), F.lit("")))


def package_quality(title: Column, notes: Column, keywords: Column | None = None, least: int = 0) -> Column:
    """Why a portal's package is left out, or empty: a title under `least` characters, none of the keywords."""
    words = F.lower(F.concat_ws("\n", title, notes))
    out = F.when(F.length(F.coalesce(text.strip(title), F.lit(""))) < least, "title too short")
    return (out if keywords is None else out.when(~F.exists(keywords, lambda k: (k != "") & words.contains(F.lower(k))), "no domain keyword hit")).otherwise("")


#: How the answers of search backends (JSON) are read: the schema, and the columns of a candidate from an item `x`.
PAYLOADS = {
    "huggingface": ("array<struct<id:string,description:string,tags:array<string>>>", None, {"name": "x.id", "url": "concat('https://huggingface.co/datasets/', x.id)", "description": "x.description", "tags": "x.tags"}),
    "github": ("struct<items:array<struct<full_name:string,html_url:string,description:string,topics:array<string>>>>", "items", {"name": "x.full_name", "url": "x.html_url", "description": "x.description", "tags": "x.topics"}),
    "ckan": ("struct<result:struct<results:array<struct<title:string,url:string,notes:string,tags:array<struct<name:string>>>>>>", "result.results", {"name": "x.title", "url": "x.url", "description": "x.notes", "tags": "x.tags.name"}),
    "searxng": ("struct<results:array<struct<title:string,url:string,content:string>>>", "results", {"name": "x.title", "url": "x.url", "description": "x.content", "tags": "cast(null as array<string>)"}),
}


def candidates(payloads: DataFrame, backend: str, c: str = "payload") -> DataFrame:
    """name, url, description, tags, backend of each item of a backend's answers; an answer that can't be read has none."""
    schema, path, fields = PAYLOADS[backend]
    read = F.from_json(c, schema)
    items = read
    for part in (path or "").split("."):
        items = items.getField(part) if part else items
    return payloads.select(F.explode(items).alias("x")).select(*[F.expr(e).alias(n) for n, e in fields.items()], F.lit(backend).alias("backend"))


# --- catalog rows -------------------------------------------------------------------------------------------------------


def tags(c: Column, most: int = 8, room: int = 200) -> Column:
    """The first tags as one string, without blank and namespaced (`kind:value`) ones."""
    bare = F.filter(F.transform(c, text.strip), lambda t: (t != "") & ~t.contains(":"))
    return F.substring(F.coalesce(F.array_join(F.slice(bare, 1, most), ", "), F.lit("")), 1, room)


def field_label(domain: Column) -> Column:
    """A profile's code in words."""
    known = F.when(domain == "BANKING_COMPLIANCE", "Finance").when(domain == "CYBERSEC", "Cybersecurity")
    return known.otherwise(F.initcap(F.replace(text.strip(domain), F.lit("_"), F.lit(" "))))


def derived_name(title: Column, url: Column) -> Column:
    """The owner of a dataset or repository, else the title up to a separator, else the host."""
    first = lambda c, p: F.nullif(F.regexp_extract(c, p, 1), F.lit(""))
    owner = first(url, r"(?i)(?:github\.com|gitlab\.com)/([^/]+)/")
    head = text.strip(F.get(F.split(text.strip(title), r"\s[|\-–·:]\s", 2), F.lit(0)))
    return F.coalesce(first(url, r"(?i)huggingface\.co/datasets/([^/]+)/"), F.when(~F.lower(owner).isin("orgs", "search", "topics"), owner), F.nullif(F.substring(head, 1, 80), F.lit("")), urls.host(url))


def catalog_rows(results: DataFrame, profile: str, added: Column) -> DataFrame:
    """Catalog rows of search results (title, link, snippet, sub_domain)."""
    t, u, s = F.col("title"), F.col("link"), F.col("snippet")
    kind = urls.category_and_format(u)
    return results.select(
        derived_name(t, u).alias("name"), "sub_domain", field_label(F.lit(profile)).alias("field"), urls.country(u, F.concat_ws(" ", t, s)).alias("country"),
        F.substring(s, 1, 300).alias("description"), u.alias("url"), kind["category"].alias("category"), kind["format"].alias("format"), F.date_format(added, "dd/MM/yyyy").alias("added"),
    )


def _key(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text.strip(c)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def category_domain(rows: DataFrame, taxonomy: DataFrame, hints: DataFrame) -> DataFrame:
    """Rows with `domain`: their own sub_domain, else the sub-domain of the taxonomy (name, code) that the category
    names, else what hints (category, name) say if the taxonomy has it, else the category, else Uncategorized."""
    named = taxonomy.select(F.explode(F.array(F.struct(F.lit(0).alias("rank"), _key(F.col("name")).alias("k"), "name"), F.struct(F.lit(1).alias("rank"), _key(F.col("code")).alias("k"), "name"))).alias("e")).filter("e.k != ''")
    known = named.groupBy(F.col("e.k").alias("_k")).agg(F.min_by("e.name", F.struct("e.rank", "e.name")).alias("_direct"))
    hinted = hints.select(F.lower(text.strip(F.col("category"))).alias("_h"), _key(F.col("name")).alias("_k"), F.col("name").alias("_hint")).join(known.select("_k"), "_k", "left_semi").groupBy("_h").agg(F.min("_hint").alias("_hint"))
    d = rows.withColumns({"_own": F.nullif(text.strip(F.col("sub_domain")), F.lit("")), "_c": F.nullif(text.strip(F.col("category")), F.lit(""))})
    d = d.join(known, _key(F.col("_c")) == F.col("_k"), "left").join(hinted, F.lower("_c") == F.col("_h"), "left")
    return d.withColumn("domain", F.coalesce("_own", "_direct", "_hint", "_c", F.lit("Uncategorized"))).drop("_own", "_c", "_k", "_direct", "_h", "_hint")


def safe_name(c: Column) -> Column:
    """Whether a sub-domain's name can be a folder's."""
    return F.coalesce((text.strip(c) != "") & (text.strip(c) == c) & ~c.isin(".", "..") & ~c.rlike(r"[/\\]"), F.lit(False))


def upsert_subdomains(taxonomy: DataFrame, changes: DataFrame) -> DataFrame:
    """The taxonomy (name, code) with changes (name, code, removed): safe names are added or replaced, removed ones go."""
    valid = changes.filter(safe_name(F.col("name")))
    return taxonomy.join(valid.select("name"), "name", "left_anti").select("name", "code").unionByName(valid.filter("not removed").select("name", "code"))


# --- what a run's candidates came to ---------------------------------------------------------------------------------------


def admitted(found: DataFrame, existing: DataFrame, reason: Column, order: list[str], c: str = "url") -> DataFrame:
    """found with `rejected`: duplicate of the catalog or of an earlier row that passes, else the reason, else empty.

    The first passing row of an address is a pre-aggregated minimum; a row without an address is no duplicate."""
    have = existing.select(F.nullif(text.strip(F.col(c)), F.lit("")).alias("_u")).filter("_u is not null").distinct().withColumn("_have", F.lit(True))
    d = found.withColumns({"_u": F.nullif(text.strip(F.col(c)), F.lit("")), "_at": F.struct(*order), "_why": reason})
    first = d.filter("_why = '' and _u is not null").groupBy("_u").agg(F.min("_at").alias("_first"))
    d = d.join(have, "_u", "left").join(first, "_u", "left")
    again = F.coalesce(F.col("_have"), F.col("_at") > F.col("_first"), F.lit(False))
    return d.withColumn("rejected", F.when(again, "duplicate").otherwise(F.col("_why"))).drop("_u", "_at", "_why", "_have", "_first")


def run_counts(judged: DataFrame) -> DataFrame:
    """facet, value, rows: added by backend and by country, rejected by reason (backend, country, rejected), in one pass."""
    good = F.col("rejected") == ""
    pair = lambda f, v: F.struct(F.lit(f).alias("facet"), v.alias("value"))
    pairs = F.when(good, F.array(pair("added", F.col("backend")), pair("country", F.col("country")))).otherwise(F.array(pair("rejected", F.col("rejected"))))
    return judged.select(F.explode(pairs).alias("p")).groupBy("p.facet", "p.value").agg(F.count("*").alias("rows"))


def keyword_hits(hits: DataFrame, existing: DataFrame, by: list[str], c: str = "url") -> DataFrame:
    """hits and new (not in the catalog) by keyword, domain or whatever `by` names."""
    have = existing.select(urls.normalized(F.col(c)).alias("_link")).distinct().withColumn("_have", F.lit(True))
    d = hits.withColumn("_link", urls.normalized(F.col(c))).join(have, "_link", "left")
    return d.groupBy(*by).agg(F.count("*").alias("hits"), F.count_if(F.col("_have").isNull()).alias("new"))


def backfill(rows: DataFrame, found: Column, c: str = "url") -> DataFrame:
    """host, scanned, found: for how many of a host's rows a lookup gave something."""
    return rows.groupBy(urls.host(F.col(c)).alias("host")).agg(F.count("*").alias("scanned"), F.count_if(F.coalesce(found, F.lit("")) != "").alias("found"))


def synthetic_scan(rows: DataFrame) -> DataFrame:
    """Rows (name, description, category, license, is_synthetic) with suggested, matched, gap and disagreement."""
    said = hazards.synthetic(F.concat_ws(" ", "name", "description", "category", "license"))
    flag = F.coalesce(F.lower(text.strip(F.col("is_synthetic").cast("string"))).isin("yes", "true", "1", "y"), F.lit(False))
    d = rows.withColumns({"_said": said, "_flag": flag})
    sure = F.col("_said.verdict") == "Yes"
    return d.withColumns({"suggested": F.col("_said.verdict"), "matched": F.array_join("_said.terms", ", "), "gap": sure & ~F.col("_flag"), "disagreement": F.col("_flag") & ~sure}).drop("_said", "_flag")


def synthetic_counts(scanned: DataFrame) -> DataFrame:
    return scanned.groupBy("suggested").agg(F.count("*").alias("rows"), F.count_if("gap").alias("gaps"), F.count_if("disagreement").alias("disagreements"))


def prune_counts(rows: DataFrame, keep_hosts: tuple[str, ...], off_topic: str, signal: str) -> DataFrame:
    return catalog.prune(rows, keep_hosts, off_topic, signal).groupBy("prune").agg(F.count("*").alias("rows"))
