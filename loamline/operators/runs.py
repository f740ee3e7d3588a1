"""The state of runs: stages, progress, sizes, sessions, trends and balance, read from logs, ledgers and tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline import config
from loamline.functions import licence, text
from loamline.operators import catalog, metrics, normalize

MB = 1024 * 1024

# --- records ------------------------------------------------------------------------------------------------------------


def validity(df: DataFrame, least: int = 10, c: str = "text") -> DataFrame:
    """valid, invalid: cleaned records whose text has `least` characters, and others."""
    ok = F.coalesce(F.length(text.strip(F.col(c))) >= least, F.lit(False))
    return df.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"))


def split_translated(df: DataFrame, c: str = "_orig_lang") -> tuple[DataFrame, DataFrame]:
    """(kept, purged): translated records tell the language that they came from."""
    if c not in df.columns:
        return df, df.filter(F.lit(False))
    blank = F.coalesce(text.strip(F.col(c)), F.lit("")) == ""
    return df.filter(blank), df.filter(~blank)


def unmapped(df: DataFrame, known: tuple[str, ...] | None = None) -> DataFrame:
    """source, mapper, records: sources without a mapper of their name, whose records go by their shape."""
    known = tuple(normalize.MAPPERS) if known is None else known
    prose = F.coalesce(text.strip(F.col("text")), F.lit("")) != ""
    return df.filter(~F.col("source").isin(*known)).groupBy("source", F.when(prose, "generic").otherwise("structured").alias("mapper")).agg(F.count("*").alias("records"))


def rejected_sources(assessed: DataFrame, records: DataFrame) -> DataFrame:
    """records of sources that an assessment (source, reason) rejects, with the reason: what is moved aside."""
    return records.join(assessed.filter("reason != ''").select("source", "reason"), "source")


def outputs(df: DataFrame) -> DataFrame:
    """clean, flagged, dropped: records by route, zero where none."""
    return df.agg(*[F.count_if(F.col("route") == r).alias(r) for r in ("clean", "flagged", "dropped")])


def preview(df: DataFrame, order: list[str], n: int = 50) -> DataFrame:
    return df.orderBy(*order).limit(n)


# --- sizes --------------------------------------------------------------------------------------------------------------


def file_table(files: DataFrame, by: list[str]) -> DataFrame:
    """files and mb of each source, from a listing with `length` in bytes."""
    return files.groupBy(*by).agg(F.count("*").alias("files"), (F.sum("length") / MB).alias("mb"))


def cleaned_table(df: DataFrame, c: str = "text") -> DataFrame:
    """sub_domain, source, records, mb of text (UTF-8)."""
    return df.groupBy("sub_domain", "source").agg(F.count("*").alias("records"), (F.sum(F.octet_length(c)) / MB).alias("mb"))


def sized_funnel(stages: dict[str, DataFrame], c: str = "text") -> DataFrame:
    """catalog.data_funnel with the megabytes of text."""
    sizes = None
    for name, d in stages.items():
        row = d.agg(F.lit(name).alias("stage"), (F.sum(F.octet_length(c)) / MB).alias("mb"))
        sizes = row if sizes is None else sizes.unionByName(row)
    return catalog.data_funnel(stages).join(sizes, "stage")


# --- catalog read models --------------------------------------------------------------------------------------------------

#: Licences that say nothing.
UNRESOLVED = ("", "unknown", "to-verify", "n/a", "none", "tbd")


def unresolved(c: Column) -> Column:
    return F.lower(F.coalesce(text.strip(c), F.lit(""))).isin(*UNRESOLVED)


def licence_coverage(rows: DataFrame, c: str = "license") -> DataFrame:
    """total, filled, unknown, red (surely restrictive) rows of a catalog."""
    u = unresolved(F.col(c))
    return rows.agg(F.count("*").alias("total"), F.count_if(~u).alias("filled"), F.count_if(u).alias("unknown"), F.count_if(licence.verdict(F.col(c)) == "blocked").alias("red"))


def blank_licence_links(rows: DataFrame, c: str = "license", link: str = "url") -> DataFrame:
    return rows.filter(unresolved(F.col(c)) & (F.coalesce(text.strip(F.col(link)), F.lit("")) != "")).select(link)


def counted(rows: DataFrame, c: str, blank: str) -> DataFrame:
    """value, rows: a catalog by sub-domain (blank: Uncategorized), a blacklist by reason (blank: unspecified)."""
    return rows.groupBy(F.coalesce(F.nullif(text.strip(F.col(c)), F.lit("")), F.lit(blank)).alias("value")).agg(F.count("*").alias("rows"))


# --- stages and progress --------------------------------------------------------------------------------------------------


def stage_states(log: DataFrame, order: tuple[str, ...] = catalog.STAGES, stage: str = "stage", ended: str = "ended") -> DataFrame:
    """step, stage, state of each stage of a run: done (it ended, or a later one began), running or pending."""
    steps = log.sparkSession.createDataFrame(list(enumerate(order)), "step int, stage string")
    seen = log.groupBy(F.col(stage).alias("stage")).agg(F.max(F.col(ended).cast("boolean")).alias("over"))
    d = steps.join(seen, "stage", "left")
    last = F.max(F.when(F.col("over").isNotNull(), F.col("step"))).over(Window.partitionBy())
    state = F.when((F.col("step") < last) | ((F.col("step") == last) & F.col("over")), "done").when(F.col("step") == last, "running").otherwise("pending")
    return d.select("step", "stage", state.alias("state"))


def progress(sources: DataFrame, ledger: DataFrame, key: str, by: list[str]) -> DataFrame:
    """completed, failed, total and pct of the sources, by the last status that the ledger (key, status, ordinal) tells."""
    last = ledger.groupBy(key).agg(F.max_by("status", "ordinal").alias("_status"))
    ok = F.coalesce(F.col("_status").like("ok%"), F.lit(False))
    done = F.count_if(ok)
    return sources.join(last, key, "left").groupBy(*by).agg(done.alias("completed"), F.count_if(F.col("_status").isNotNull() & ~ok).alias("failed"), F.count("*").alias("total"), F.round(100 * done / F.count("*"), 1).alias("pct"))


def sessions(log: DataFrame, most: int = 15) -> DataFrame:
    """session, started, last, lines of a log (session, ts): the newest `most` (the limit is the feature)."""
    d = log.groupBy("session").agg(F.min("ts").alias("started"), F.max("ts").alias("last"), F.count("*").alias("lines"))
    return d.orderBy(F.desc("last"), F.desc("session")).limit(most)


def trend(history: DataFrame) -> DataFrame:
    """Headline figures of each run's report (ts, passed, metrics as JSON); what a report lacks is 0."""
    at = lambda path, kind: F.coalesce(F.try_variant_get(F.try_parse_json("metrics"), path, kind), F.lit(0).cast(kind))
    figures = (("total", "$.total", "long"), ("dup_rate", "$.dup_rate", "double"), ("drift", "$.drift.max_delta", "double"), ("avg_tokens", "$.text_quality.avg_tokens", "double"), ("num_subdomains", "$.num_subdomains", "long"))
    return history.select("ts", F.coalesce("passed", F.lit(False)).alias("passed"), *[at(p, k).alias(n) for n, p, k in figures])


# --- balance --------------------------------------------------------------------------------------------------------------


def balance_plan(df: DataFrame, valid: DataFrame, conf: config.Gate = config.Gate(), step: int = 25) -> DataFrame:
    """sub_domain, records, lacking, row_target: what a fix round sources for. valid: sub_domain, valid (catalog rows)."""
    every = Window.partitionBy()
    d = metrics.volume(df).join(valid, "sub_domain", "left").withColumn("valid", F.coalesce("valid", F.lit(0)))
    lacking = (F.col("records") < 0.25 * F.avg("records").over(every)) | (F.col("share") < conf.min_subdomain_share)
    d = d.withColumn("lacking", lacking)
    here = F.max(F.when(F.col("lacking"), F.col("valid"))).over(every)
    return d.select("sub_domain", "records", "lacking", F.coalesce(F.greatest(F.max("valid").over(every), here + step), F.lit(0)).alias("row_target"))


def balanced(df: DataFrame, conf: config.Gate = config.Gate()) -> DataFrame:
    """One row: no sub-domain lacks and the spread is within bounds; an empty corpus isn't balanced."""
    none = df.sparkSession.createDataFrame([], "sub_domain string, valid long")
    n = F.col("records")
    spread = F.when(F.count("*") > 1, F.stddev_samp(n) / F.avg(n)).otherwise(0.0)
    return balance_plan(df, none, conf).agg(((F.count("*") > 0) & (F.count_if("lacking") == 0) & (spread <= conf.max_topic_cv)).alias("balanced"))


def rebalanced(df: DataFrame, keys: list[str], seed: int = config.SEED) -> DataFrame:
    """df cut to the least cap that the feedback suggests; as it is where it suggests none (opt-in)."""
    cap = metrics.suggested_cap(df)
    return df if cap is None else metrics.domain_cap(df, cap, keys, seed)


def fix_rounds(source: Callable[[DataFrame, int], DataFrame], df: DataFrame, conf: config.Gate = config.Gate(), most: int = 4) -> tuple[DataFrame, int]:
    """(records, rounds): `source` is given the plan of what lacks and the round, and its records are added, until the
    corpus is balanced or `most` rounds have passed."""
    for n in range(most):
        if balanced(df, conf).first().balanced:
            return df, n
        plan = balance_plan(df, df.sparkSession.createDataFrame([], "sub_domain string, valid long"), conf)
        df = normalize.table(df.unionByName(source(plan.filter("lacking"), n), allowMissingColumns=True), f"round-{n}")
    return df, most


# --- self-test ------------------------------------------------------------------------------------------------------------


def probes(spark) -> DataFrame:
    """control, passed: each protection tried on a case that it has to stop."""
    from loamline.functions import pii, urls
    from loamline.sources import records

    tried = {
        "url_scheme": urls.screen(F.lit("file:///etc/passwd")) != "", "url_credentials": urls.screen(F.lit("http://a:b@example.com/")) != "", "url_private": urls.screen(F.lit("http://10.0.0.1/")) != "",
        "url_link_local": urls.screen(F.lit("http://169.254.1.1/")) != "", "licence_default_deny": ~licence.classify(F.lit("house rules")).getField("ok"), "licence_deny_first": ~licence.classify(F.lit("MIT, non-commercial")).getField("ok"),
        "email_redacted": ~pii.redact_emails(F.lit("to a.b@example.com now")).contains("@"), "canary_found": F.size(text.found_canaries(F.concat(F.lit("x "), text.canary("probe", F.lit(1))))) == 1,
    }
    out = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(n).alias("control"), F.coalesce(c, F.lit(False)).alias("passed")) for n, c in tried.items()])).alias("p")).select("p.*")
    bad = spark.createDataFrame([("a.zip", "../x", 1, 1), ("b.zip", "x", 10**6, 1)], "archive string, name string, size long, packed long")
    return out.unionByName(records.archive_refusal(bad).select(F.concat(F.lit("archive_"), "archive").alias("control"), F.col("reason").isNotNull().alias("passed")))


#: Read-only functions by name, each from a table of records to a table, for tools that only look.
READERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "volume": metrics.volume, "quality": metrics.quality, "concentration": metrics.concentration, "balance": metrics.balance, "gate": metrics.gate, "feedback": metrics.feedback,
    "metrics": metrics.corpus, "cleaned": cleaned_table, "validity": validity,
}
