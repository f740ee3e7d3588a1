"""Line dedup: an exact set-similarity join of lines, and the text without later matches.

A line's set is its distinct words, lower-cased; lines of one lower-cased text are a class. Words are ordered by
rarity, counted over classes in hashed buckets (some 32 classes each, 2^18 at most), on a logarithmic scale (any fixed order is exact; this one puts
frequent words last). Classes meet on the words of their prefix; size, the words' places and a parity sketch of 64 bits,
or 128 for long lines (no more bits differ than words do), bound the overlap, and the Jaccard similarity of what is left
is verified on the words. A line goes if an earlier line, by doc_id and line number, is of its class or links to it.

Only that an earlier line links matters, not how many do. So classes are first held against the earliest of each list
that they stand in, a row an entry, which settles nearly all of a group of near copies; those that are left are then
joined with all of their lists. A list is of one word and one range of sizes: a class stands in its own range, and looks
for classes of its size or more there and in the next range, with the shorter prefix that suffices for those. The join is
a plain one, which adaptive execution splits where a word is hot. DataFrame and SQL functions only.

Defined cases: null texts stay null and have no lines; lines without words always stay; repeated rows count as one
document, of which each gets the same result; a null doc_id comes first; an empty table gives no rows; a long text is
one array of lines; extra columns, whatever their names, are kept but for text, n_lines and n_removed.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from loamline.llm.common import columns, discard, hash_joins, materialize, small

PERCENT, BUCKETS = 80, 1 << 18
#: Words from which a line has a sketch of 128 bits, those from which the words that a pair shares are counted over
#: whole prefixes, and those from which sizes aren't told apart.
WIDE, LONG, LONGEST = 64, 256, 4096


def plain(text: Column) -> Column:
    """Lower-cased text whose white space is spaces and line ends; few texts have any other, so few are rewritten.
    In ASCII four characters are the others, and looking for each is quicker than an expression."""
    low, other = F.lower(text), r"[\s\p{Z}&&[^ \n]]"
    found = F.when(F.octet_length(text) == F.length(text), reduce(or_, [F.contains(text, F.lit(c)) for c in "\t\v\f\r"])).otherwise(text.rlike(other))
    return F.when(found, F.regexp_replace(low, other, " ")).otherwise(low)


def line_words(line: Column) -> Column:
    """The distinct words of a line of plain text, as they come."""
    return F.array_remove(F.array_distinct(F.split(line, " ")), "")


def hashes(line: Column) -> Column:
    """Those of the distinct words of a line of plain text; numbers are told apart quicker than words."""
    return F.array_distinct(F.array_remove(F.transform(F.split(line, " "), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def place(doc_id: str) -> Column:
    """The column of ids as numbers in the ids' order, null first; different ids may share one."""
    head = F.rpad(F.substring(F.hex(F.encode(F.col(doc_id).cast("string"), "utf-8")), 1, 14), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1))


def needed(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("int")


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, line (from 0), body, class of each line with words; each distinct document once."""
    # a text's hash is taken before its lines are told apart, else it would be worked out for each of them
    d = columns(docs, "doc_id", "text").select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    d = d.select("doc_id", "text_key", F.posexplode(F.split(plain(F.col("text")), "\n", -1)).alias("line", "body"))
    return d.filter(F.trim("body") != "").withColumn("class", F.xxhash64("body"))


def not_text(each: DataFrame) -> bool:
    """Whether the ids are whole numbers, which place() needn't cut."""
    return isinstance(each.schema["first"].dataType["doc_id"].dataType, IntegralType)


def classes(found: DataFrame) -> DataFrame:
    """class (a number, which takes less room than the hash once it is written), first (doc_id, text_key, line of its first line), body."""
    each = found.groupBy("class").agg(F.min(F.struct("doc_id", "text_key", "line")).alias("first"), F.first("body").alias("body"))
    return each.select(F.monotonically_increasing_id().alias("class"), "first", "body")


def buckets(each: DataFrame) -> int:
    """A power of two: a few are looked up quicker, many tell words of large tables apart."""
    return min(BUCKETS, max(1 << 10, 1 << (each.count() // 32).bit_length()))


def rarity(each: DataFrame, size: int) -> Column:
    """A literal array: the logarithm of the number of times that classes have words of each of size hashed buckets.
    Bytes, since Java has each of them once: of longs, each is an object of its own, and looking up a word's missed the
    CPU's caches twice."""
    counts = each.select(F.explode(F.split("body", " ")).alias("w")).groupBy(F.xxhash64("w").bitwiseAND(F.lit(size - 1)).cast("int").alias("b")).agg(F.least(F.round(F.log2(F.count("*")) * 8).cast("int"), F.lit(255)).alias("n"))
    table = [-128] * size
    for r in counts.collect():
        table[r.b] = r.n - 128
    return listed(table, "tinyint")


def listed(numbers: list[int], kind: str) -> Column:
    """A literal array."""
    return F.from_json(F.lit(json.dumps(numbers)), f"array<{kind}>")


def ranges(percent: int) -> tuple[list[int], list[int]]:
    """The number of each size's range, and the first size of the next one. A class of a range links, of classes of its
    size or more, to those of that range and the next only; the last range has no end."""
    following = lambda n: max(n * 100 // percent, n * 5 // 4) + 1
    number, end, at, low = [0], [1], 1, 1
    while low < LONGEST:
        after = following(low)
        last = following(after) > LONGEST  # else the last range would be too short
        number += [at] * ((LONGEST if last else after) - low)
        end += [(1 << 31) - 1 if last else after] * ((LONGEST if last else after) - low)
        at, low = at + 1, LONGEST if last else after
    return number, end


def prefixes(each: DataFrame, percent: int = PERCENT) -> DataFrame:
    """class, place, line, n, sketch, more, range, own, over, prefix: the codes of its rarest words; place and line are
    those of its first line; range is that of its size; of the prefix, the first own words meet classes of that range and
    its size or more, the first over ones those of the next. A code is a word's rank and hash; words of one code only add
    candidates."""
    rank = rarity(each, size := buckets(each))
    coded = lambda h: F.shiftleft(F.get(rank, h.bitwiseAND(F.lit(size - 1)).cast("int")).cast("long"), 48).bitwiseOR(F.shiftrightunsigned(h, 16))
    each = each.withColumn("doc_id", F.col("first.doc_id"))
    at = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))) if not_text(each) else place("doc_id")
    each = each.select("class", at.alias("place"), F.col("first.line").alias("line"), hashes(F.col("body")).alias("hashes"))
    bit = lambda one, h: F.call_function("shiftleft", one, F.shiftrightunsigned(h, 58).cast("int"))
    parity = lambda one: F.aggregate("hashes", F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(bit(one(h), h)))
    n = F.size("hashes")
    more = F.when(n >= WIDE, parity(lambda h: F.shiftrightunsigned(h, 57).bitwiseAND(F.lit(1).cast("long")))).otherwise(F.lit(0).cast("long"))
    number, end = (F.get(listed(x, "bigint"), F.least(n, F.lit(LONGEST - 1))) for x in ranges(percent))
    # a partner of m words or more shares so many that one is among these; long classes count words over whole prefixes
    whole = n - needed(n, percent) + 1
    first = lambda m: F.when(n >= LONG, whole).otherwise(n - shared(n, m, percent) + 1).cast("int")
    over = F.when(end * percent <= n * 100, first(end)).otherwise(0)
    return each.select(
        "class", "place", "line", n.alias("n"), parity(lambda h: F.lit(1).cast("long")).alias("sketch"), more.alias("more"),
        number.cast("int").alias("range"), first(n).alias("own"), over.alias("over"),
        F.slice(F.sort_array(F.transform("hashes", coded)), 1, whole).alias("prefix"),
    )


def alike(n: Column, m: Column, a: Column, b: Column, percent: int) -> Column:
    """Whether classes of n and m words, of the sketches a and b, may link."""
    sized = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    return sized & (F.bit_count(a.bitwiseXOR(b)) <= n + m - 2 * shared(n, m, percent))


def shared(n: Column, m: Column, percent: int) -> Column:
    """The words that classes of n and m words have in common at least, if they link."""
    return F.ceil((n + m) * percent / (100 + percent))


def verified(pairs: DataFrame, each: DataFrame, percent: int) -> DataFrame:
    """class: of the pairs (a, b) of classes whose Jaccard similarity is at least percent, the one that comes later."""
    of = materialize(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "involved")
    words = materialize(each.join(small(of), "class", "left_semi"), "words")
    # told apart below the joins, once a class: a filter above them would do it again wherever it names them
    side = lambda x: words.select(F.col("class").alias(x), F.array_join(line_words(F.col("body")), " ").alias(f"w{x}"), F.col("first").alias(f"f{x}"))
    met = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "fa", "fb", F.split("wa", " ").alias("wa"), F.split("wb", " ").alias("wb"))
    # common * 100 >= (na + nb - common) * percent, in which the costly side stands once
    met = met.filter(F.size(F.array_intersect("wa", "wb")) * (100 + percent) >= (F.size("wa") + F.size("wb")) * percent)
    out = materialize(met.select(F.when(F.col("fa") < F.col("fb"), F.col("b")).otherwise(F.col("a")).alias("class")).distinct(), "verified")
    discard(of, words)
    return out


def head_pairs(told: DataFrame, percent: int) -> DataFrame:
    """a, b: each class with the earliest of lists that it stands in, where they may link. A class stands in the lists of
    some words of its prefix, those of the lowest hashes, which near copies mostly share."""
    hashed = F.sort_array(F.transform("prefix", lambda c: c.bitwiseAND(F.lit((1 << 48) - 1))))
    # any class may be the head, an early one settles most; numbers of fixed width keep the aggregation in hash tables
    early = F.col("place").cast("double") * (1 << 20) + F.col("line")
    entries = told.select("class", early.alias("early"), "n", "sketch", F.explode(F.slice(hashed, 1, F.lit(2) + F.ceil(F.size("prefix") / 10).cast("int"))).alias("word"))
    heads = entries.groupBy("word").agg(*[F.min_by(c, "early").alias(f"a{c}") for c in ("class", "n", "sketch")], F.count("*").alias("many"))
    heads = heads.filter("many > 1").select("word", F.col("aclass").alias("a"), "an", "asketch")
    near = entries.select("word", "class", "n", "sketch").join(heads, "word")
    return near.filter((F.col("class") != F.col("a")) & alike(F.col("n"), F.col("an"), F.col("sketch"), F.col("asketch"), percent)).select("a", F.col("class").alias("b")).distinct()


def list_rows(told: DataFrame, settled: DataFrame, percent: int, half: int) -> DataFrame:
    """a, b, n, m (their sizes), common, placed: what the lists of half of the words say of the pairs that may link, of
    which the later isn't settled. a is the one of fewer words."""
    done = F.when(F.col("done"), 1).otherwise(0)
    flagged = told.join(small(settled.select("class", F.lit(True).alias("done"))), "class", "left")
    kept = ["class", "place", "sketch", "more"]
    flagged = flagged.select(*kept, "n", "range", "own", "over", done.alias("done"), F.posexplode("prefix").alias("at", "word"))
    flagged = flagged.filter(F.col("word").bitwiseAND(F.lit(1).cast("long")) == half)
    # few columns, and packed: size, place in the prefix, whether settled
    packed = F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.shiftleft(F.col("at").cast("long"), 1)).bitwiseOR(F.col("done").cast("long")).alias("packed")
    listed_at = lambda number: F.col("word").bitwiseXOR(F.shiftleft(number.cast("long"), 48)).alias("list")
    looks = flagged.filter("at < own").select(*kept, packed, "word", F.explode(F.sequence("range", F.col("range") + (F.col("at") < F.col("over")).cast("int"))).alias("range"))
    a, b = (t.select(listed_at(F.col("range")), *[F.col(c).alias(f"{x}{c}") for c in kept], (packed if x == "b" else F.col("packed")).alias(f"{x}packed")) for x, t in (("a", looks), ("b", flagged)))
    n, m = (F.shiftright(f"{x}packed", 32).cast("int") for x in "ab")
    at, to = (F.shiftright(F.col(f"{x}packed").bitwiseAND(F.lit((1 << 32) - 1)), 1).cast("int") for x in "ab")
    least = shared(n, m, percent)
    # the first word in common is placed; of all words in common, no more than the lesser place are before this one, and
    # no more than the shorter rest from it on
    placed = F.least(n - at, m - to) >= least
    around = F.least(at, to) + F.least(n - at, m - to) >= least
    opened = lambda x: F.col(f"{x}packed").bitwiseAND(F.lit(1).cast("long")) == 0
    later = ((F.col("aplace") <= F.col("bplace")) & opened("b")) | ((F.col("aplace") >= F.col("bplace")) & opened("a"))
    sized = ((n < m) | ((n == m) & (F.col("aclass") < F.col("bclass")))) & (n * 100 >= m * percent)
    differ, others = F.col("asketch").bitwiseXOR(F.col("bsketch")), F.col("amore").bitwiseXOR(F.col("bmore"))
    sketched = F.when(n < WIDE, F.bit_count(differ)).otherwise(F.bit_count(differ.bitwiseXOR(others)) + F.bit_count(others)) <= n + m - 2 * least
    met = a.join(b, "list").filter(sized & F.when(n < LONG, placed).otherwise(around) & sketched & later)
    return met.groupBy(F.col("aclass").alias("a"), F.col("bclass").alias("b"), n.alias("n"), m.alias("m")).agg(F.count("*").alias("common"), F.max(placed).alias("placed"))


def list_pairs(told: DataFrame, settled: DataFrame, percent: int) -> DataFrame:
    """a, b: all pairs of a list that may link, of which the later isn't settled."""
    # one half after the other, which takes half the room
    halves = [materialize(list_rows(told, settled, percent, half), "list_rows") for half in (0, 1)]
    met = halves[0].union(halves[1]).groupBy("a", "b", "n", "m").agg(F.sum("common").alias("common"), F.max("placed").alias("placed"))
    # words that aren't in both whole prefixes are behind that prefix which ends first
    behind = F.greatest(needed(F.col("n"), percent), needed(F.col("m"), percent)) - 1
    out = materialize(met.filter(F.col("placed") & ((F.col("n") < LONG) | (F.col("common") + behind >= shared(F.col("n"), F.col("m"), percent)))).select("a", "b"), "pairs")
    discard(*halves)
    return out


def linked(each: DataFrame, percent: int = PERCENT) -> DataFrame:
    """class: those that an earlier class links to."""
    told = materialize(prefixes(each, percent), "prefixes")
    with hash_joins(each.sparkSession):
        near = materialize(head_pairs(told, percent), "head_pairs")
    settled = verified(near, each, percent)
    discard(near)
    with hash_joins(each.sparkSession):
        pairs = list_pairs(told, settled, percent)
    discard(told)
    out = materialize(verified(pairs, each, percent).union(settled).distinct(), "linked")
    discard(pairs, settled)
    return out


def kept(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_key, lines: of each distinct document with words, the numbers of the lines with words that stay."""
    each = materialize(classes(lines(docs)), "classes")
    gone = linked(each, percent)
    # a line with words stays only where it is its class's first and no earlier class links to it
    stays = each.select("class", "first").join(small(gone), "class", "left_anti").select("first.*")
    out = materialize(stays.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines")), "kept")
    discard(each, gone)
    return out


def dedup(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """docs with text less its later matches, n_lines and n_removed."""
    stay = small(kept(docs, percent))
    every = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in every]).alias("row"), docs["`doc_id`"].alias("own"), docs["`text`"].alias("body"), F.xxhash64(docs["`text`"]).alias("key"))
    met = row.join(stay, F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")), "left").select("row", "body", "lines")
    numbered = F.transform(F.split("body", "\n", -1), lambda x, k: F.struct(x.alias("x"), k.alias("k")))
    stays = F.filter(numbered, lambda s: F.coalesce(F.array_contains("lines", s["k"]), F.lit(False)) | ~s["x"].rlike(r"[^\s\p{Z}]"))
    met = met.select("row", "body", stays.alias("stays"))
    total = F.when(F.col("body").isNull(), 0).otherwise(F.size(F.split("body", "\n", -1)))
    text = F.array_join(F.transform("stays", lambda s: s["x"]), "\n")
    removed = F.when(F.col("body").isNull(), 0).otherwise(total - F.size("stays"))
    return met.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in every], total.alias("n_lines"), removed.alias("n_removed"))
