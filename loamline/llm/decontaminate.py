"""Benchmark decontamination: which words of documents stand in a window of a benchmark item.

A prefix-filtered set join. Each item is cut into windows of ten words (a shorter item is one window). The words of
windows are ordered by rarity, that is by their number in all documents; for exact containment the prefix that a
document must share with a window is its one rarest word. Documents' word positions join those anchor words; the
anchor's place in its window bounds where the window may begin and end, and what fits is verified word by word, in
the same pass, before a row is made. Texts don't move to be searched: the windows go to them, in blocks of a checked
size. What is found (a row a document that is hit) is broadcast up to common.BROADCAST_ROWS rows; beyond that clean()
shuffles the texts once, and judge() only keys and counts.

Candidates come by Unicode lower case (which keeps words apart alike); the verification is by A-Z alone. DataFrame and
SQL functions only. Defined cases: null texts and texts without words have no windows and no hits; a null item_id
marks words but isn't listed; equal items under several ids all count; repeated rows are each judged; an empty table
of documents gives no rows, an empty benchmark no hits; a long text is one array of words; extra columns, whatever
their names, are ignored by judge() and kept by clean().
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import columns, materialize, small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words, told by the characters that they hold: a negated class of ranges takes Java's matcher some 30 times as long.
WORD = r"[0-9a-z\x80-\x{10FFFF}]+"
#: The same words before A-Z are lower-cased.
RAW_WORD = r"[0-9A-Za-z\x80-\x{10FFFF}]+"
WINDOW = 10
#: Windows that are broadcast at once; a larger benchmark is gone through in blocks of these.
BLOCK_WINDOWS = 100_000


def exact_words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(WORD), F.lit(0))


def raw_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(RAW_WORD), F.lit(0))


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """window_id, words, items: each distinct window and the ids of the items that have it."""
    words = columns(benchmark, "item_id", "text").select(F.col("item_id").cast("string").alias("item_id"), exact_words(F.col("text")).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    each = words.select("item_id", F.explode(F.transform(starts, lambda k: F.slice("w", k, window))).alias("words"))
    found = each.groupBy("words").agg(F.collect_set("item_id").alias("items"))
    return materialize(found.select(F.xxhash64("words").alias("window_id"), "words", "items"), "windows")


def anchors(docs: DataFrame, found: DataFrame) -> DataFrame:
    """window_id, words, n, anchor (its rarest word in docs, folded) and place (of the anchor in the window, from 0)."""
    folded = F.transform("words", lambda w: F.lower(w))
    vocabulary = small(materialize(found.select(F.explode(folded).alias("word")).distinct(), "vocabulary"))
    text = columns(docs, "text")
    counts = small(materialize(text.select(F.explode(raw_words(F.col("text"))).alias("w")).select(F.lower("w").alias("word")).join(vocabulary, "word", "left_semi").groupBy("word").agg(F.count("*").alias("rows")), "rarity"))
    spread = found.select("window_id", "words", F.posexplode(folded).alias("place", "word")).join(counts, "word", "left")
    least = F.min(F.struct(F.coalesce("rows", F.lit(0)).alias("rows"), "word", "place")).alias("least")
    chosen = spread.groupBy("window_id", "words").agg(least)
    return materialize(chosen.select("window_id", "words", F.size("words").alias("n"), F.col("least.word").alias("anchor"), F.col("least.place").alias("place"), F.col("least.rows").alias("rows")), "anchors")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, text_key, begin (word, from 0), n, items: each place of a document where a window occurs."""
    found = windows(benchmark, window)
    chosen = anchors(docs, found).filter("rows > 0")
    blocks = max(1, -(-chosen.count() // BLOCK_WINDOWS))
    rows = columns(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_key"), raw_words(F.col("text")).alias("raw"))
    rows = rows.select("doc_id", "text_key", "raw", F.posexplode("raw").alias("at", "word")).withColumn("folded", F.lower("word"))
    out = None
    for k in range(blocks):
        part = chosen.filter(F.pmod("window_id", F.lit(blocks)) == k).select("window_id", "n", "anchor", "place", F.array_join("words", " ").alias("joined"))
        begin = F.col("at") - F.col("place")
        # all of it in the join's condition, inside generated code: no row is made of what fails
        fits = (F.col("folded") == F.col("anchor")) & (begin >= 0) & (begin + F.col("n") <= F.size("raw"))
        fits &= F.translate(F.array_join(F.slice("raw", F.greatest(begin + 1, F.lit(1)), F.col("n")), " "), UPPER, LOWER) == F.col("joined")
        # BLOCK_WINDOWS short rows at most
        met = rows.join(F.broadcast(part), fits).select("doc_id", "text_key", begin.alias("begin"), "window_id", "n")
        out = met if out is None else out.unionByName(met)
    names = found.select("window_id", "items")
    return out.join(small(names), "window_id")


def judge(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids of the items with occurring windows), contaminated of every row."""
    places = hits(docs, benchmark, window)
    merged = places.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("begin", "n"))).alias("at"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    # words under sorted intervals: each adds what lies beyond the ends so far
    hit = F.expr("aggregate(at, struct(0L as n, 0L as stop), (a, x) -> struct(a.n + greatest(0L, x.begin + x.n - greatest(a.stop, x.begin)) as n, greatest(a.stop, cast(x.begin + x.n as bigint)) as stop)).n")
    merged = small(materialize(merged.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), hit.alias("n_hit"), "items"), "hits"))
    rows = columns(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("text_key"), F.coalesce(F.regexp_count("text", F.lit(RAW_WORD)), F.lit(0)).cast("long").alias("n_words"))
    rows = rows.join(merged, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_key") == F.col("hit_key")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return rows.select("doc_id", "text_key", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs without a hit."""
    bad = judge(docs, benchmark, window).filter("contaminated").select("doc_id", "text_key").distinct()
    bad = small(materialize(bad, "contaminated"))
    return docs.join(bad, docs["`doc_id`"].eqNullSafe(bad["doc_id"]) & (F.xxhash64(docs["`text`"]) == bad["text_key"]), "left_anti")
