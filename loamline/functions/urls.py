"""URLs: parts, identities, the fetch screen, result quality, and what a URL says of its content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values.
JUNK_HOSTS = (
    "pinterest.com", "facebook.com", "fb.com", "twitter.com", "x.com", "youtube.com", "youtu.be", "reddit.com",
    "instagram.com", "tiktok.com", "linkedin.com", "quora.com",
)
LISTING_SEGMENTS = ("search", "tag", "tags", "topic", "topics", "category", "categories", "label", "labels")
RESTRICTED_HOSTS: tuple[str, ...] = ("nic.in", "iso.org")


def _text(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def host(url: Column) -> Column:
    """Lower-cased, without credentials, port or www.; a URL may lack its scheme."""
    authority = F.regexp_extract(_text(url), r"(?s)^(?:[^/?#]*?://|//)?([^/?#]*)", 1)
    bare = F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@", "")), r":.*$", "")
    return F.regexp_replace(bare, r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_extract(_text(url), r"(?s)^(?:[^/?#]*?://|//)?[^/?#]*([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(_text(url), r"(?s)\?([^#]*)", 1)


def suffixes(name: Column) -> Column:
    """A host and all domains above it."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))


def under(name: Column, domains: tuple[str, ...]) -> Column:
    """The host is one of the domains or below one."""
    met = F.lit(False)
    for d in domains:
        met = met | (name == d) | name.endswith("." + d)
    return met


def quality(url: Column, restricted: tuple[str, ...] = RESTRICTED_HOSTS) -> Column:
    """Why a search result is dropped (bad link, junk host, restricted host, listing page), or empty."""
    h = host(url)
    segments = F.split(F.lower(path(url)), "/")
    listing = F.arrays_overlap(segments, F.array(*[F.lit(x) for x in LISTING_SEGMENTS])) | F.concat(F.lit("&"), query(url)).rlike(r"&q=[^&]")
    return (
        F.when((h == "") | ~h.contains("."), "bad link")
        .when(under(h, JUNK_HOSTS), "junk host")
        .when(under(h, restricted), "restricted host")
        .when(listing, "listing page")
        .otherwise("")
    )


def normalized(url: Column) -> Column:
    """Host and path, for comparison."""
    s = F.lower(_text(url))
    full = F.regexp_extract(s, r"(?s)^(?:[^/?#]*?://|//)?([^/?#]*)", 1)
    return F.concat(F.regexp_replace(full, r"^www\.", ""), F.regexp_replace(path(s), r"/+$", ""))


def source_identity(url: Column) -> Column:
    """hf:, kaggle: or ds: and a dataset's ref, else url: and the address without scheme, www., query and last slash."""
    u = F.lower(_text(url))
    ref = F.regexp_extract(u, r"/datasets/([^/?#]+/[^/?#]+)", 1)
    kind = F.when(u.contains("huggingface.co"), "hf").when(u.contains("kaggle.com"), "kaggle").otherwise("ds")
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(u, r"^https?://", ""), r"[?#].*$", ""), r"^www\.", ""), r"/+$", "")
    return F.when(u == "", F.lit(None)).when(ref != "", F.concat(kind, F.lit(":"), ref)).when(rest != "", F.concat(F.lit("url:"), rest))


def descriptor_key(kind: Column, ref: Column, url: Column, slug: Column) -> Column:
    named = F.concat(kind, F.lit(":"), F.coalesce(ref, slug, F.lit("None")))
    address = F.nullif(_text(url), F.lit(""))
    return F.when(kind.isin("hf", "kaggle"), F.concat(kind, F.lit(":"), F.coalesce(ref, F.lit("None")))).otherwise(F.coalesce(address, named))


def screen(url: Column, schemes: tuple[str, ...] = ("http", "https")) -> Column:
    """Why a URL must not be fetched, or empty. Names aren't resolved: literal addresses only."""
    u = _text(url)
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))
    authority = F.regexp_extract(u, r"(?s)^[^/?#]*?://([^/?#]*)", 1)
    name = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", ""))
    quad = name.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$")
    octet = [F.regexp_extract(name, r"^" + r"\d+\." * k + r"(\d+)", 1).try_cast("int") for k in range(4)]
    a, b = octet[0], octet[1]
    return (
        F.when(u == "", "empty URL")
        .when(scheme == "", "no scheme")
        .when(~scheme.isin(*schemes), "scheme not fetched")
        .when(authority.contains("@"), "credentials in URL")
        .when(name == "", "no host")
        .when(quad & (F.greatest(*octet) > 255), "unparseable address")
        .when(quad & (a == 169) & (b == 254), "link-local address")
        .when((quad & (a == 127)) | name.isin("localhost", "[::1]"), "loopback address")
        .when(quad & ((a == 10) | ((a == 172) & b.between(16, 31)) | ((a == 192) & (b == 168))), "private address")
        .when(quad & ((a == 0) | (a >= 224)), "reserved address")
        .otherwise("")
    )


def category_and_format(url: Column) -> Column:
    """struct(category, format) from the shape of a URL, by ordered rules."""
    low = F.lower(_text(url))
    h = F.regexp_extract(low, r"(?s)^[^/?#]*?://([^/?#]*)", 1)
    said = lambda c, f: F.struct(F.lit(c).alias("category"), (f if isinstance(f, Column) else F.lit(f)).alias("format"))
    ext = F.regexp_extract(low, r"\.([a-z0-9]+)$", 1)
    return (
        F.when(ext == "pdf", said("Document", "PDF"))
        .when(ext.isin("csv", "json", "jsonl", "parquet", "xlsx", "txt"), said("Dataset", F.upper(ext)))
        .when(ext.isin("rss", "atom", "xml") | low.contains("/feed") | low.contains("/rss"), said("Feed", F.when(ext == "xml", "XML").when(low.contains("rss"), "RSS").otherwise("ATOM")))
        .when(h.startswith("api.") | low.contains("/api/") | low.contains("graphql"), said("API", "JSON"))
        .when((h.contains("huggingface.co") | h.contains("kaggle.com")) & low.contains("/datasets/"), said("Dataset", ""))
        .when(h.contains("github.com") | h.contains("gitlab.com") | h.contains("raw.githubusercontent"), said("Repository", ""))
        .when(h.contains("arxiv.org"), said("Document", "PDF"))
        .when(h.contains("zenodo.org") | h.contains("figshare.com") | h.contains("data.gov"), said("Dataset", ""))
        .otherwise(said("Website", "HTML"))
    )


def is_feed(url: Column) -> Column:
    return F.lower(_text(url)).rlike(r"\.(?:rss|atom|xml)(?:[?#].*)?$|/(?:feed|rss|atom)(?:s?/|s?$|s?[?#])")


#: What tells an Indian source besides its address.
INDIA_HINTS = ("india", "indian", "rbi", "sebi", "irdai", "npci", "meity", "cert-in")


def country(url: Column, text: Column | None = None) -> Column:
    """India by the address's end or by the row's words, else Global."""
    h = host(url)
    blob = F.lower(F.concat_ws(" ", h, text if text is not None else F.lit("")))
    hinted = F.lit(False)
    for x in INDIA_HINTS:
        hinted = hinted | blob.contains(x)
    return F.when(h.endswith(".in") | hinted, "India").otherwise("Global")


def download_url(url: Column) -> Column:
    """A page of a repository's file as its raw file."""
    return F.regexp_replace(url, r"^https?://github\.com/([^/]+)/([^/]+)/blob/(.+)$", "https://raw.githubusercontent.com/$1/$2/$3")


def shard_group(rel: Column) -> Column:
    """The key under which numbered shards of one table meet."""
    return F.regexp_replace(rel, r"-\d+-of-\d+(?=\.|$)", "")


def kind(url: Column, category: Column, ref: Column | None = None) -> Column:
    """How a catalog row is fetched, by ordered rules: hf, kaggle, github, nvd, cwe, rss, feed, pdf, url or site."""
    low, c = F.lower(_text(url)), F.lower(F.coalesce(category, F.lit("")))
    return (
        F.when(low.contains("huggingface.co/datasets/"), "hf")
        .when(low.contains("kaggle.com/datasets/"), "kaggle")
        .when(low.contains("github.com/"), "github")
        .when(low.contains("services.nvd.nist.gov"), "nvd")
        .when(low.contains("cwe.mitre.org") & low.endswith(".zip"), "cwe")
        .when(is_feed(url), "rss")
        .when(c.isin("api", "feed") | low.endswith(".json"), "feed")
        .when(low.endswith(".pdf"), "pdf")
        .when(low.rlike(r"\.(?:csv|jsonl|parquet|xlsx?|txt|zip|gz)$"), "url")
        .when(low != "", "site")
    )
