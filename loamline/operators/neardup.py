"""Near duplicates as a diagnostic: exact Jaccard pairs behind a prefix filter, estimated ones behind MinHash bands, and greedy first wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.functions import text
from loamline.session import table


def shingle_hashes(c: Column, k: int) -> Column:
    """The hash of each k words (of all, if there are fewer), over the words' own hashes."""
    def of(w: Column) -> Column:
        several = F.transform(F.sequence(F.lit(1), F.size(w) - k + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(k))))
        return F.when(F.size(w) >= k, several).when(F.size(w) > 0, F.array(F.xxhash64(w))).otherwise(F.array().cast("array<long>"))

    return text.let(F.transform(text.split_words(c), lambda x: F.xxhash64(x)), of)


def pairs(df: DataFrame, key: str = "doc_id", c: str = "text", k: int = 5, threshold: float = 0.85) -> DataFrame:
    """a, b, jaccard (a < b) of all pairs of texts at or above the threshold, over k-word shingles.

    Shingles are ordered by rarity; two sets that similar share one of the rarest n - ceil(threshold * n) + 1 of each.
    Equal sets are one class until the end, so copies make no pairs of their own before verification.
    """
    sets = df.select(F.col(key).alias("id"), shingle_hashes(F.col(c), k).alias("s"))
    sets = sets.filter("size(s) > 0").withColumn("s", F.sort_array(F.array_distinct("s"))).withColumn("class", F.xxhash64("s"))
    members = table(sets.select("id", "class"), "members")
    classes = table(sets.groupBy("class").agg(F.first("s").alias("s")), "classes")
    rare = classes.select(F.explode("s").alias("x")).groupBy("x").agg(F.count("*").alias("df")).filter("df > 1")
    each = classes.select("class", F.size("s").alias("n"), F.explode("s").alias("x")).join(rare, "x", "left")
    # what stands in no other class goes first and meets nothing; only the rest of the prefix is kept
    ranked = each.groupBy("class", "n").agg(F.sort_array(F.collect_list(F.when(F.col("df").isNotNull(), F.struct("df", "x")))).alias("o"))
    least = F.ceil(F.col("n") * threshold - 1e-9).cast("int")
    keep = F.greatest(F.size("o") - least + 1, F.lit(0))
    prefix = table(ranked.select("class", "n", F.explode(F.slice("o", 1, keep)).alias("o")).select("class", "n", F.col("o.x").alias("x")), "prefix")
    a, b = prefix.alias("a"), prefix.alias("b")
    near = (F.col("a.x") == F.col("b.x")) & (F.col("a.class") < F.col("b.class")) & (F.least("a.n", "b.n") >= F.greatest("a.n", "b.n") * threshold - 1e-9)
    met = a.join(b, near).select(F.col("a.class").alias("p"), F.col("b.class").alias("q")).distinct()
    met = met.join(classes.select(F.col("class").alias("p"), F.col("s").alias("sp")), "p").join(classes.select(F.col("class").alias("q"), F.col("s").alias("sq")), "q")
    j = text.jaccard(F.col("sp"), F.col("sq"))
    linked = met.select("p", "q", j.alias("jaccard")).filter(F.col("jaccard") >= threshold)
    same = classes.select(F.col("class").alias("p"), F.col("class").alias("q"), F.lit(1.0).alias("jaccard"))
    both = linked.union(linked.select("q", "p", "jaccard")).union(same)
    left, right = members.select(F.col("id").alias("a"), F.col("class").alias("p")), members.select(F.col("id").alias("b"), F.col("class").alias("q"))
    return both.join(left, "p").join(right, "q").filter("a < b").select("a", "b", "jaccard")


def first_wins(edges: DataFrame) -> DataFrame:
    """id, kept of every id in edges (a before b): an id goes if and only if an earlier kept one is near it.

    Rounds decide all whose earlier neighbours are decided; each round's table is written to the shared folder."""
    edges = table(edges.select("a", "b").distinct(), "edges")
    ids = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    state = table(ids.join(edges.select(F.col("b").alias("id")).distinct().withColumn("later", F.lit(True)), "id", "left").select("id", F.when(F.col("later").isNull(), F.lit(True)).alias("kept")), "state")
    while state.filter("kept is null").head(1):
        near = edges.join(state.select(F.col("id").alias("a"), "kept"), "a").groupBy(F.col("b").alias("id")).agg(F.max(F.coalesce(F.col("kept"), F.lit(False))).alias("any_kept"), F.count_if(F.col("kept").isNull()).alias("open"))
        new = F.when(F.col("kept").isNotNull(), F.col("kept")).when(F.col("any_kept"), F.lit(False)).when(F.col("open") == 0, F.lit(True))
        state = table(state.join(near, "id", "left").select("id", new.alias("kept")), "state")
    return state


def band_keys(signature: Column, bands: int = 32) -> Column:
    """One hash a band of a MinHash signature, for candidate joins."""
    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda k: F.xxhash64(k, F.slice(signature, (k * F.floor(F.size(signature) / bands) + 1).cast("int"), F.floor(F.size(signature) / bands).cast("int"))))


def band_pairs(df: DataFrame, key: str = "doc_id", c: str = "text", k: int = 5, threshold: float = 0.85, permutations: int = 128, bands: int = 32) -> DataFrame:
    """a, b, similarity (a < b) of the pairs of texts that share a band and whose estimated similarity is at or above the threshold.

    Equal signatures are one class until the end, as in pairs(); a pair that shares no band is missed (chance (1 - s^rows)^bands)."""
    found = text.shingles(text.split_words(F.col(c)), k)
    signed = df.select(F.col(key).alias("id"), found.alias("s")).filter("size(s) > 0").select("id", text.minhash(F.col("s"), permutations).alias("m"))
    signed = table(signed.withColumn("class", F.xxhash64("m")), "signatures")
    members = signed.select("id", "class")
    classes = table(signed.groupBy("class").agg(F.first("m").alias("m")), "classes")
    each = table(classes.select("class", F.explode(band_keys(F.col("m"), bands)).alias("x")), "bands")
    met = each.alias("p").join(each.alias("q"), (F.col("p.x") == F.col("q.x")) & (F.col("p.class") < F.col("q.class")))
    met = met.select(F.col("p.class").alias("p"), F.col("q.class").alias("q")).distinct()
    met = met.join(classes.select(F.col("class").alias("p"), F.col("m").alias("mp")), "p").join(classes.select(F.col("class").alias("q"), F.col("m").alias("mq")), "q")
    linked = met.select("p", "q", text.minhash_similarity(F.col("mp"), F.col("mq")).alias("similarity")).filter(F.col("similarity") >= threshold)
    same = classes.select(F.col("class").alias("p"), F.col("class").alias("q"), F.lit(1.0).alias("similarity"))
    both = linked.union(linked.select("q", "p", "similarity")).union(same)
    left, right = members.select(F.col("id").alias("a"), F.col("class").alias("p")), members.select(F.col("id").alias("b"), F.col("class").alias("q"))
    return both.join(left, "p").join(right, "q").filter("a < b").select("a", "b", "similarity")
