"""Language identification by Bayesian fusion of text, markup, address and host evidence.

A text's likelihood comes from hashed byte trigrams per language, trained from at most `per_language` texts each. From
the texts' own posteriors, grouped aggregations over all pages count how often a language goes with each declared
markup language and each address suffix, and which languages a host and its domain have. Host priors are smoothed by
the domain's, the domain's by the whole, and leave the page itself out. The posterior multiplies all of them.

Defined cases: null html has no text and an uninformative likelihood; a missing declaration, suffix or host is a value
of its own; repeated rows are each judged; without training texts there are no languages and every result is null; an
empty table gives no rows; a text of any length counts as `most` trigrams at most; of equal posteriors the language
that sorts last wins; extra columns, whatever their names, are kept.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import columns, materialize, small

BUCKETS = 1 << 16


@dataclass(frozen=True)
class Settings:
    per_language: int = 1_500
    longest: int = 20_000
    #: Trigrams are no independent witnesses: a text counts as this share of them, and as this many at most.
    temper: float = 0.2
    most: float = 60.0
    host_weight: float = 8.0
    domain_weight: float = 20.0
    smooth: float = 0.5
    seed: int = 5


def trigram_counts(text: str | None) -> np.ndarray:
    data = np.frombuffer(f" {(text or '').lower()} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    return (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA6B) ^ data[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(16) if len(data) > 2 else np.zeros(0, np.uint32)


def train(docs: DataFrame, settings: Settings = Settings()) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and log-probabilities (language, bucket), from docs' text and lang."""
    d = columns(docs, "doc_id", "text", "lang").filter("lang is not null and text is not null").filter(F.length("text") <= settings.longest)
    counts = {r.lang: r["count"] for r in d.groupBy("lang").count().collect()}  # one row a language
    share = functools.reduce(lambda a, x: F.when(F.col("lang") == x[0], F.lit(min(1.0, settings.per_language / x[1]))).otherwise(a), counts.items(), F.lit(0.0))
    chosen = d.filter(F.pmod(F.xxhash64(F.lit(settings.seed), "text"), F.lit(1 << 20)) < share * (1 << 20)).select("lang", "text").limit(2 * settings.per_language * max(1, len(counts))).collect()
    langs = sorted(counts)
    table = np.full((len(langs), BUCKETS), 0.05)
    for lang, text in chosen:
        np.add.at(table[langs.index(lang)], trigram_counts(text), 1)
    return langs, np.log(table / table.sum(1, keepdims=True)) if langs else table


def visible(html: Column) -> Column:
    bare = F.regexp_replace(html, r"(?is)<(script|style|nav|head)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[A-Za-z#0-9]+;", " ")


def declared(html: Column) -> Column:
    """The html element's lang, first subtag, lower-cased; empty if none."""
    return F.coalesce(F.lower(F.regexp_extract(html, r"""(?is)<html[^>]*?\slang\s*=\s*["']?([A-Za-z]{2,8})""", 1)), F.lit(""))


def judge(pages: DataFrame, model: tuple[list[str], np.ndarray], settings: Settings = Settings()) -> DataFrame:
    """pages without html, with host, suffix, declared, text_lang, lang, probability."""
    found = ("host", "suffix", "declared", "text_lang", "lang", "probability")
    every = [c for c in pages.columns if c not in ("html", *found)]
    named = {n: pages[f"`{n}`"] if n in pages.columns else F.lit(None).cast("string") for n in ("url", "html")}
    judged = _judged(pages.select(F.struct(*[pages[f"`{c}`"] for c in every]).alias("row"), *[c.alias(n) for n, c in named.items()]), model, settings)
    return judged.select(*[F.col("row").getField(c).alias(c) for c in every], *found)


def _judged(pages: DataFrame, model: tuple[list[str], np.ndarray], settings: Settings) -> DataFrame:
    """judge() of pages of row, url and html."""
    langs, table = model
    spark = pages.sparkSession
    host = F.coalesce(F.lower(F.regexp_extract("url", r"(?s)^.*?://([^/?#:]*)", 1)), F.lit(""))
    d = pages.withColumns({"host": host, "declared": declared(F.col("html"))})
    d = d.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("_domain", F.substring_index("host", ".", -2))
    if not langs:
        none = F.lit(None).cast("string")
        return d.drop("html", "_domain").withColumns({"text_lang": none, "lang": none, "probability": F.lit(None).cast("double")})
    told = spark.sparkContext.broadcast(table.astype(np.float32))

    @F.pandas_udf("array<double>")
    def likelihood(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for text in texts:
                at = trigram_counts(text if text and text.strip() else "")
                total = told.value[:, at].sum(1, dtype=np.float64) if len(at) > 3 else np.zeros(len(told.value))
                total *= min(settings.temper, settings.most / max(len(at), 1))
                out.append((total - total.max()).tolist())
            yield pd.Series(out)

    n = range(len(langs))
    d = materialize(d.withColumn("_ll", likelihood(visible(F.col("html")))).drop("html"), "likelihoods")
    d = d.withColumn("_z", F.expr("aggregate(_ll, 0D, (a, x) -> a + exp(x))"))
    d = d.withColumns({f"_p{k}": F.exp(F.col("_ll")[k]) / F.col("_z") for k in n})
    sums = [F.sum(f"_p{k}").alias(f"s{k}") for k in n]
    whole = d.agg(*sums).first()
    total = sum(float(whole[k] or 0.0) for k in n)
    prior = [(float(whole[k] or 0.0) + 1) / (total + len(langs)) for k in n]

    def rates(name: str) -> DataFrame:
        """log P(value | language), smoothed, one row a value of the column."""
        found = d.groupBy(F.col(name).alias(f"_{name}")).agg(*sums)
        return small(materialize(found.select(f"_{name}", *[F.log((F.col(f"s{k}") + settings.smooth) / (float(whole[k] or 0.0) + 50 * settings.smooth)).alias(f"_{name}{k}") for k in n]), name))

    hosts = d.groupBy(F.col("host").alias("_host"), F.col("_domain").alias("_of")).agg(*[F.sum(f"_p{k}").alias(f"_h{k}") for k in n], F.count("*").alias("_hn"))
    hosts = materialize(hosts, "hosts")
    domains = hosts.groupBy(F.col("_of").alias("_in")).agg(*[F.sum(f"_h{k}").alias(f"_d{k}") for k in n], F.sum("_hn").alias("_dn"))
    hosts = small(materialize(hosts.join(domains, hosts["_of"] == domains["_in"]).drop("_of", "_in"), "priors"))
    d = d.join(rates("declared"), F.col("declared") == F.col("_declared")).join(rates("suffix"), F.col("suffix") == F.col("_suffix"))
    d = d.join(hosts, F.col("host") == F.col("_host"))
    scores = []
    for k in n:
        of_domain = (F.greatest(F.col(f"_d{k}") - F.col(f"_h{k}"), F.lit(0.0)) + settings.domain_weight * prior[k]) / (F.col("_dn") - F.col("_hn") + settings.domain_weight)
        of_host = (F.greatest(F.col(f"_h{k}") - F.col(f"_p{k}"), F.lit(0.0)) + settings.host_weight * of_domain) / (F.col("_hn") - 1 + settings.host_weight)
        # suffix rates are relative to the prior that hosts carry already
        scores.append(F.struct((F.col("_ll")[k] + F.col(f"_declared{k}") + F.col(f"_suffix{k}") + F.log(of_host)).alias("s"), F.lit(langs[k]).alias("lang"), F.col("_ll")[k].alias("t")))
    d = d.withColumn("_all", F.array(*scores))
    best = F.array_max("_all")
    share = 1 / F.aggregate("_all", F.lit(0.0), lambda a, x: a + F.exp(x["s"] - best["s"]))
    text_best = F.array_max(F.transform("_all", lambda x: F.struct(x["t"], x["lang"])))
    keep = [c for c in d.columns if not c.startswith("_")]
    return d.select(*keep, text_best["lang"].alias("text_lang"), best["lang"].alias("lang"), share.alias("probability"))
