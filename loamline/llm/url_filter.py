"""URL filters: rules on hosts and paths, and association rules mined from labelled URLs.

Spark's FP-growth mines the frequent combinations of a URL's tokens together with its verdict; the rules that end in a
verdict and pass the least support and confidence are kept, less those that a shorter rule of the same verdict and at
least the same confidence covers. Rules match by an inverted index, token to rule: a rule fires where it meets as many
tokens of a URL as it has. Of those that fire, the highest confidence, then support, then the fewest tokens decide.

Only distinct URLs are judged, and the verdicts joined back. Defined cases: a null URL, or one without `://`, has an
empty host and path and no tokens; what no rule decides gets the default verdict; repeated rows are judged alike; an
empty table gives no rows; without `least_rows` labelled URLs nothing is mined; of rules that are as sure the one of more
support, then of fewer tokens, then the last by name wins; a long URL has as many tokens as it has parts; extra columns,
whatever their names, are kept by judge(). FP-growth's own conditional trees group by token, as MLlib does.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import materialize, small

#: (verdict, host, path prefix): fixed values of the filter's base list.
BASE_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class Settings:
    least_support: float = 0.002
    #: A combination of tokens in fewer rows tells nothing, whatever share of few rows that is.
    least_rows: int = 8
    least_confidence: float = 0.8
    #: The last labels of a host are tokens as suffixes, up to so many; each label before them is a token by its place.
    host_labels: int = 4
    default: str = "allow"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def base_rule(host: Column, path: Column, rules=BASE_RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits: its host or a subdomain, and a path that starts so."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column, settings: Settings = Settings()) -> Column:
    """Distinct tokens: scheme, host suffixes and the labels before them, path parts, query keys and parameters (digits as
    one token), whether there is a query or fragment (whose text is no token). Support and confidence prune."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.lit(settings.host_labels)), lambda k: F.when(k <= n, F.concat(F.lit("host="), F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), "."))))
    deeper = F.transform(labels, lambda x, k: F.when(n - k > settings.host_labels, F.concat(F.lit("label"), (n - k).cast("string"), F.lit("="), x)))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    shaped = F.transform(parts, lambda x, k: F.concat(F.lit("part"), k.cast("string"), F.lit("="), F.regexp_replace(x, r"[0-9]+", "0")))
    query = F.filter(F.split(F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    keys = F.transform(query, lambda x: F.concat(F.lit("key="), F.substring_index(x, "=", 1)))
    given = F.transform(F.filter(query, lambda x: x.contains("=")), lambda x: F.concat(F.lit("given="), F.regexp_replace(x, r"[0-9]+", "0")))
    more = F.array(
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))),
        F.when(url.contains("?"), F.lit("query")), F.when(url.contains("#"), F.lit("fragment")),
    )
    found = F.array_distinct(F.filter(F.concat(suffixes, deeper, shaped, keys, given, more), lambda x: x.isNotNull()))
    return F.when(url.contains("://"), found).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """rule_id, tokens, verdict, confidence, support, n_tokens from rows of `url`, `verdict` (each row counts)."""
    rows = labelled.filter("url is not null and verdict is not null").select(F.monotonically_increasing_id().alias("row"), "verdict", tokens(F.col("url"), settings).alias("tokens"))
    rows = materialize(rows.filter("size(tokens) > 0"), "labelled")
    n = rows.count()
    least = max(settings.least_support, settings.least_rows / max(n, 1))
    # tokens of the very same rows say the same, and only multiply the combinations: the first by name stands for all.
    # A row has few tokens, so those above the support are bounded by it, whatever the rows
    each = rows.select("row", "verdict", F.explode("tokens").alias("token"))
    mark = F.sum(F.xxhash64("row").cast("decimal(38,0)"))
    told = each.groupBy("token").agg(F.count("*").alias("n"), mark.alias("mark")).filter(F.col("n") >= least * n).groupBy("n", "mark").agg(F.min("token").alias("token")).select("token")
    items = each.join(small(materialize(told, "tokens")), "token").groupBy("row").agg(F.collect_set("token").alias("tokens"), F.first("verdict").alias("verdict"))
    items = materialize(items.select(F.array_append("tokens", F.concat(F.lit("verdict="), F.col("verdict"))).alias("items")), "items")
    if n < settings.least_rows:
        return items.sparkSession.createDataFrame([], "rule_id long, tokens array<string>, verdict string, confidence double, support double, n_tokens int")
    model = FPGrowth(itemsCol="items", minSupport=min(least, 1.0), minConfidence=settings.least_confidence).fit(items)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith("verdict=") & ~F.exists("antecedent", lambda x: x.startswith("verdict=")))
    rules = materialize(rules.select(F.sort_array("antecedent").alias("tokens"), F.expr("substring(consequent[0], 9)").alias("verdict"), "confidence", "support"), "mined")
    # a rule says nothing new beside a shorter one of its verdict that is as sure; they share the shorter one's tokens
    a, b = rules.alias("a"), rules.alias("b")
    shorter = F.col("b.verdict") == F.col("a.verdict")
    covered = (
        a.select("a.*", F.explode("tokens").alias("t")).alias("a")
        .join(b.select("b.*", F.col("tokens")[0].alias("t")).alias("b"), "t")
        .filter(shorter & (F.size("b.tokens") < F.size("a.tokens")) & (F.col("b.confidence") >= F.col("a.confidence")) & (F.size(F.array_except("b.tokens", "a.tokens")) == 0))
        .select(F.col("a.tokens").alias("tokens"), F.col("a.verdict").alias("verdict")).distinct()
    )
    kept = rules.join(covered, ["tokens", "verdict"], "left_anti")
    return materialize(kept.select(F.xxhash64("tokens", "verdict").alias("rule_id"), "tokens", "verdict", "confidence", "support", F.size("tokens").alias("n_tokens")), "rules")


def match(urls: DataFrame, rules: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """url, mined_verdict, mined_rule of each distinct url of which a rule fires, by the inverted index of rules."""
    index = small(rules.select("rule_id", "verdict", "confidence", "support", "n_tokens", F.array_join("tokens", " ").alias("mined_rule"), F.explode("tokens").alias("token")))
    met = urls.select("url", F.explode(tokens(F.col("url"), settings)).alias("token")).join(index, "token")
    fired = met.groupBy("url", "rule_id").agg(F.count("*").alias("n"), *[F.first(c).alias(c) for c in ("n_tokens", "verdict", "confidence", "support", "mined_rule")]).filter("n = n_tokens")
    best = F.max(F.struct("confidence", "support", (-F.col("n_tokens")).alias("short"), "mined_rule", "verdict"))
    return fired.groupBy("url").agg(best.alias("best")).select("url", F.col("best.verdict").alias("mined_verdict"), F.col("best.mined_rule").alias("mined_rule"))


def judge(pages: DataFrame, rules: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """pages with host, path, rule, verdict, mined_rule. Without `rules`, they are mined from the URLs that base rules judge."""
    every = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "mined_rule")]
    d = pages.select(F.struct(*[pages[f"`{c}`"] for c in every]).alias("row"), pages["`url`"].alias("url"))
    urls = d.groupBy("url").agg(F.count("*").alias("rows"))
    urls = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    urls = materialize(urls.withColumn("base", base_rule(F.col("host"), F.col("path"))), "urls")
    if rules is None:
        rules = mine(urls.filter("base is not null").select("url", F.col("base.verdict").alias("verdict")), settings)
    mined = match(urls.filter("base is null and url is not null"), rules, settings)
    judged = urls.join(mined, "url", "left").select(
        F.col("url").alias("known"), "host", "path", F.col("base.rule").alias("rule"),
        F.coalesce("base.verdict", "mined_verdict", F.lit(settings.default)).alias("verdict"), "mined_rule",
    )
    met = d.join(small(materialize(judged, "judged")), F.col("url").eqNullSafe(F.col("known")), "left")
    return met.select(*[F.col("row").getField(c).alias(c) for c in every], "host", "path", "rule", "verdict", "mined_rule")
