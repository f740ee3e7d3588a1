"""The catalog of sources and the runs over it: joins, funnels, ledgers, timelines and loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions import licence, text, urls

# --- joins ------------------------------------------------------------------------------------------------------------


def new_links(candidates: DataFrame, existing: DataFrame, c: str = "url") -> DataFrame:
    """Candidates whose normalised URL the catalog hasn't."""
    have = existing.select(urls.normalized(F.col(c)).alias("_link")).distinct()
    return candidates.withColumn("_link", urls.normalized(F.col(c))).join(have, "_link", "left_anti").drop("_link")


def described(rows: DataFrame, descriptors: DataFrame, c: str = "url") -> DataFrame:
    """Rows with the last descriptor (by `ordinal`) of their source identity."""
    last = descriptors.withColumn("_id", urls.source_identity(F.col(c))).filter("_id is not null").groupBy("_id").agg(F.max_by(F.struct(*[x for x in descriptors.columns if x != c]), "ordinal").alias("descriptor"))
    return rows.withColumn("_id", urls.source_identity(F.col(c))).join(last, "_id").drop("_id")


def ingest_table(catalog: DataFrame, on_disk: DataFrame, meta: DataFrame, failures: DataFrame) -> DataFrame:
    """catalog (name, domain) with files, records, kind, reason and status: ingested, failed, skipped or pending."""
    d = catalog.join(on_disk, ["name", "domain"], "left").join(meta, ["name", "domain"], "left").join(failures, ["name", "domain"], "left")
    status = F.when(F.col("records") > 0, "ingested").when(F.col("reason").rlike("(?i)licen[sc]e"), "skipped").when(F.col("reason").isNotNull() | F.col("files").isNotNull(), "failed").otherwise("pending")
    return d.withColumn("status", status)


def without_data(table: DataFrame) -> DataFrame:
    return table.filter("status != 'ingested'")


def blacklist(rows: DataFrame, c: str = "license", link: str = "url") -> tuple[DataFrame, DataFrame]:
    """(kept, moved): rows of a surely restrictive licence that have a link are moved."""
    red = (licence.verdict(F.col(c)) == "blocked") & (F.coalesce(text.strip(F.col(link)), F.lit("")) != "")
    return rows.filter(~red), rows.filter(red)


def apply_review(rows: DataFrame, review: DataFrame, c: str = "url") -> tuple[DataFrame, DataFrame]:
    """(kept, declined) by a review's table of url, reply; a reply is JSON with a verdict, else review."""
    declined = review.filter(verdict(F.col("reply")) == "decline").select(urls.normalized(F.col(c)).alias("_k")).distinct()
    d = rows.withColumn("_k", urls.normalized(F.col(c)))
    return d.join(declined, "_k", "left_anti").drop("_k"), d.join(declined, "_k", "left_semi").drop("_k")


def verdict(reply: Column) -> Column:
    """approve, decline or review (what a reply that can't be read means)."""
    said = F.lower(F.coalesce(F.try_variant_get(F.try_parse_json(reply), "$.verdict", "string"), F.lit("")))
    return F.when(said.isin("approve", "approved", "keep"), "approve").when(said.isin("decline", "declined", "reject"), "decline").otherwise("review")


def refine_domain(results: DataFrame, vocabulary: DataFrame, key: str, default: str = "sub_domain") -> DataFrame:
    """Results with `refined`: the sub-domain whose terms (sub_domain, term) occur most in title and snippet, if it beats
    the default's count. The vocabulary is a taxonomy's, so the containment join broadcasts it, as Spark decides."""
    words = F.lower(F.concat_ws(" ", "title", "snippet"))
    t = vocabulary.select(F.col("sub_domain").alias("_d"), F.lower("term").alias("_t")).distinct()
    met = results.select(key, F.col(default).alias("_own"), words.alias("_w")).join(t, F.col("_w").contains(F.col("_t"))).groupBy(key, "_own", "_d").agg(F.count("*").alias("_n"))
    own = F.col("_d") == F.col("_own")
    best = met.groupBy(key).agg(F.max(F.struct("_n", own.cast("int").alias("own"), "_d")).alias("b"), F.max(F.when(own, F.col("_n"))).alias("o"))
    picked = best.select(key, F.when(F.col("b._n") > F.coalesce("o", F.lit(0)), F.col("b._d")).alias("_best"))
    return results.join(picked, key, "left").withColumn("refined", F.coalesce("_best", default)).drop("_best")


# --- catalog rows -------------------------------------------------------------------------------------------------------


def number(c: Column) -> Column:
    """A number with thousands' commas, else null."""
    return F.regexp_replace(c.cast("string"), ",", "").try_cast("double")


def read_catalog(rows: DataFrame, most: float | None = None) -> DataFrame:
    """Rows with kind and size, smallest first (unknown last, then file order), without those over `most` MB."""
    d = rows.withColumn("size", number(F.col("size_mb"))).withColumn("kind", urls.kind(F.col("url"), F.col("category")))
    d = d if most is None else d.filter((F.col("size") <= most) | F.col("size").isNull())
    return d.orderBy(F.col("size").asc_nulls_last(), "ordinal")


def totals(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("sources"), F.sum(number(F.col("records"))).alias("records"), F.sum(number(F.col("size_mb"))).alias("mb"))


def coverage(rows: DataFrame, c: str = "license") -> DataFrame:
    """verdict, rows, blank."""
    return rows.groupBy(licence.verdict(F.col(c)).alias("verdict")).agg(F.count("*").alias("rows"), F.count_if(F.coalesce(F.trim(c), F.lit("")) == "").alias("blank"))


def rename_subdomain(rows: DataFrame, old: str, new: str) -> DataFrame:
    return rows.withColumn("sub_domain", F.when(text.strip(F.col("sub_domain")) == old, new).otherwise(F.col("sub_domain")))


def delete_rows(rows: DataFrame, links: list[str] = (), subdomains: list[str] = (), positions: list[int] = ()) -> DataFrame:
    """Without the rows of the given links, sub-domains or 1-based positions (`ordinal` orders)."""
    d = new_links(rows, rows.sparkSession.createDataFrame([(x,) for x in links], "url string")) if links else rows
    d = d.filter(~F.col("sub_domain").isin(list(subdomains))) if subdomains else d
    return d.filter(~F.col("ordinal").isin(list(positions))) if positions else d


def prune(rows: DataFrame, keep_hosts: tuple[str, ...], off_topic: str, signal: str) -> DataFrame:
    """Rows with `prune`: why one goes (off topic, no signal), or empty; some hosts always stay."""
    words = F.lower(F.concat_ws(" ", "name", "description", "url"))
    return rows.withColumn("prune", F.when(urls.under(urls.host(F.col("url")), keep_hosts), "").when(words.rlike(off_topic), "off topic").when(~words.rlike(signal), "no signal").otherwise(""))


def code(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "_"), "^_+|_+$", "")


def codes(names: DataFrame, c: str = "name", order: str | None = None) -> DataFrame:
    """Names with codes; a code taken by an earlier name (by `order`, else by name) gets _2, _3 ..."""
    d = names.withColumn("_c", code(F.col(c)))
    n = F.row_number().over(Window.partitionBy("_c").orderBy(order or c))
    return d.withColumn("code", F.when(n > 1, F.concat("_c", F.lit("_"), n.cast("string"))).otherwise(F.col("_c"))).drop("_c")


def scores(name: Column, description: Column, url: Column, keywords: list[str], trusted: tuple[str, ...], country: str) -> Column:
    """struct(keyword, host, country, relevance): 0.4, 0.3 and 0.3 of three parts in 0..1."""
    words = F.lower(F.concat_ws(" ", name, description))
    hits = sum((F.when(words.contains(k.lower()), 1.0).otherwise(0.0) for k in keywords), F.lit(0.0))
    k = F.least(F.lit(1.0), hits / max(0.15 * len(keywords), 1))
    h = F.when(urls.under(urls.host(url), trusted), 1.0).when(urls.host(url).rlike(r"\.(?:gov|edu|ac)(?:\.|$)"), 0.8).otherwise(0.3)
    c = F.when(urls.country(url, words) == country, 1.0).otherwise(0.5)
    return F.struct(k.alias("keyword"), h.alias("host"), c.alias("country"), (0.4 * k + 0.3 * h + 0.3 * c).alias("relevance"))


def passes(name: Column, description: Column, url: Column, s: Column, off_topic: str = "(?!)", least_keyword: float = 0.1, least_relevance: float = 0.3) -> Column:
    """Why a candidate is rejected, or empty."""
    q = urls.quality(url)
    return F.when(q != "", q).when(F.lower(F.concat_ws(" ", name, description)).rlike(off_topic), "off topic").when(s["keyword"] < least_keyword, "keyword score").when(s["relevance"] < least_relevance, "relevance").otherwise("")


def shots(keywords: DataFrame, sites: list[str], types: list[str]) -> DataFrame:
    """query: each keyword with each site and file type, both optional."""
    site = F.explode(F.array(*[F.lit(x) for x in ("", *(f" site:{s}" for s in sites))]))
    kind = F.explode(F.array(*[F.lit(x) for x in ("", *(f" filetype:{t}" for t in types))]))
    return keywords.withColumn("_s", site).withColumn("_t", kind).withColumn("query", F.concat("keyword", "_s", "_t")).drop("_s", "_t")


def pattern_urls(patterns: DataFrame) -> DataFrame:
    """url of each number from first to last of a pattern (printf form)."""
    return patterns.withColumn("n", F.explode(F.sequence("first", "last"))).withColumn("url", F.format_string("%s%d%s", "prefix", "n", "suffix"))


def interleaved(d: DataFrame, by: str, order: list[str], per: int, most: int) -> DataFrame:
    """Round robin over groups, at most `per` of each and `most` in all."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return d.withColumn("round", n).filter(F.col("round") <= per).orderBy("round", by, *order).limit(most)


def best_resource(resources: Column, formats: tuple[str, ...] = ("csv", "json", "xlsx", "xls", "xml", "parquet", "zip")) -> Column:
    """The first resource of a data format, else the first."""
    return F.coalesce(F.get(F.filter(resources, lambda r: F.lower(r["format"]).isin(*formats)), F.lit(0)), F.get(resources, F.lit(0)))


def lacking(counts: DataFrame, target: int, ratio: float = 0.5) -> DataFrame:
    """sub_domain, records, row_target, lacking: what a fix round would source for."""
    return counts.withColumns({"row_target": F.lit(target), "lacking": F.col("records") < ratio * target})


# --- funnels and read models ----------------------------------------------------------------------------------------------

DROPS = ("bad link", "junk host", "restricted host", "listing page")


def sourcing_funnel(events: DataFrame) -> DataFrame:
    """run, found, candidates, duplicates, each drop category, unprocessed (at least 0), from events (run, kind, category)."""
    n = lambda c, name: F.count_if(c).alias(name)
    d = events.groupBy("run").agg(
        n(F.col("kind") == "hit", "found"), n(F.col("kind") == "candidate", "candidates"), n(F.col("kind") == "duplicate", "duplicates"),
        *[n((F.col("kind") == "drop") & (F.col("category") == c), c.replace(" ", "_")) for c in DROPS], n(F.col("kind") == "drop", "dropped"),
    )
    return d.withColumn("unprocessed", F.greatest(F.lit(0), F.col("found") - F.col("dropped") - F.col("duplicates") - F.col("candidates")))


def merged_maps(runs: DataFrame, c: str) -> DataFrame:
    """key, total of map columns summed over runs."""
    return runs.select(F.explode(c).alias("key", "value")).groupBy("key").agg(F.sum("value").alias("total"))


def ingest_funnel(table: DataFrame) -> DataFrame:
    d = table.groupBy("status").agg(F.count("*").alias("sources"))
    return d.withColumn("pct", 100 * F.col("sources") / F.sum("sources").over(Window.partitionBy()))


def ledger_stats(ledger: DataFrame) -> DataFrame:
    return ledger.agg(
        F.count_distinct(F.coalesce(F.nullif("url", F.lit("")), "name")).alias("sources"), F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.count_if(F.col("status").like("ok%")).alias("ok")
    )


MECHANISMS = ("struct_dropped", "flagged", "lang_dropped", "exact_dups", "excluded_no_text")


def loss(report: DataFrame) -> DataFrame:
    """A report's rows by source with lost, kept_pct and top_reason (the largest mechanism, the first of equals)."""
    sums = report.groupBy("source").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"), *[F.sum(m).alias(m) for m in MECHANISMS])
    lost = sum((F.col(m) for m in MECHANISMS), F.lit(0))
    top = F.array_max(F.array(*[F.struct(F.col(m).alias("n"), F.lit(-k).alias("k"), F.lit(m).alias("name")) for k, m in enumerate(MECHANISMS)]))
    return sums.withColumns({"lost": lost, "kept_pct": F.round(F.try_divide(100.0 * F.col("n_out"), F.col("n_in")), 1), "top_reason": F.when(lost > 0, top["name"])})


def data_funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """stage, sources, records, tokens of each named stage's records."""
    out = None
    for k, (name, d) in enumerate(stages.items()):
        row = d.agg(F.lit(k).alias("step"), F.lit(name).alias("stage"), F.count_distinct("source").alias("sources"), F.count("*").alias("records"), F.sum(text.word_count(F.col("text"))).alias("tokens"))
        out = row if out is None else out.unionByName(row)
    return out


def rates(samples: DataFrame, by: str, ts: str, value: str, *ties: str) -> DataFrame:
    """Samples with `rate`: the increase a second since the last one (by ts, then ties), at least 0; null where no time passed."""
    w = Window.partitionBy(by).orderBy(ts, *ties)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    dt = (at - F.lag(at).over(w)) / 1e6
    return samples.withColumn("rate", F.when(dt > 0, F.greatest(F.lit(0.0), F.col(value) - F.lag(value).over(w)) / dt))


def timeline(log: DataFrame, stage: str, ts: str) -> DataFrame:
    """stage, started, ended (the next stage's start)."""
    d = log.groupBy(F.col(stage).alias("stage")).agg(F.min(ts).alias("started"))
    return d.withColumn("ended", F.lead("started").over(Window.partitionBy().orderBy("started", "stage")))


STAGES = ("source", "ingest", "clean", "eda", "schema")


def furthest(lines: DataFrame, c: str = "line") -> DataFrame:
    """The furthest stage that a log names."""
    at = F.lit(-1)
    for k, s in enumerate(STAGES):
        at = F.when(F.col(c).rlike(rf"(?i)\b{s}\b"), k).otherwise(at)
    return lines.agg(F.max(at).alias("at")).select(F.when(F.col("at") >= 0, F.get(F.array(*[F.lit(s) for s in STAGES]), F.col("at"))).alias("stage"))


def tail(log: DataFrame, ordinal: str, n: int) -> DataFrame:
    return log.orderBy(F.desc(ordinal)).limit(n)


def failure_reason(line: Column) -> Column:
    """The short cause in a log line."""
    return F.coalesce(*[F.nullif(F.regexp_extract(line, p, 1), F.lit("")) for p in (r"(HTTP \d{3})", r"(?i)\b(timed? ?out)", r"([A-Za-z]+(?:Error|Exception))", r"(?i)failed:?\s+(.{1,80})")], F.substring(line, 1, 80))


def eta_seconds(done: float, total: float, elapsed: float, tail_bound: float | None = None) -> float | None:
    """What is left at the speed so far, at least the longest single piece."""
    if done <= 0 or elapsed <= 0 or total <= 0:
        return None
    left = elapsed * max(total - done, 0) / done
    return max(left, tail_bound) if tail_bound else left
