"""Secret scans over a trigram inverted index.

From each rule's regular expression the strings are derived one of which every match must hold: literals, small classes,
options and alternatives are expanded, whatever else cuts. Their lower-cased trigrams give a Boolean query, an OR of
ANDs. The index holds the postings, trigram to document, of the trigrams that any query
asks for. Counting a clause's trigrams a document intersects the postings; documents that meet a clause are candidates
and are verified with the expression. Rules without mandatory trigrams scan every text.

Spans come from the text's pieces between matches, by lengths summed in chunks, so that many matches in one text stay
cheap. DataFrame and SQL functions only. Defined cases: null is empty, an empty text has no spans; a null doc_id is
always a candidate; repeated rows are each scanned; at one place the rules' order decides; an empty table gives no rows;
a long text costs its length times the rules; extra columns, whatever their names, are kept by scan() but for spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import columns, materialize, small

CHUNK = 256


@dataclass(frozen=True)
class Rule:
    """least: what a match (or its group) must measure."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
_ASSIGN = "(" + _KEYWORDS + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"

#: The base rules, in the order in which kinds are listed, and more formats that vendors publish (fixed values).
BASE = (
    Rule("assign", _ASSIGN, 2, 12),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", "[0-9a-f]{16,}"),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[0-9A-Za-z_-]{35}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE

#: Strings that a part of an expression may stand for, characters of a class, and clauses of a query, before it is left open.
STRINGS, CLASS, CLAUSES = 64, 8, 64
Clauses = frozenset[frozenset[str]]
ANY: Clauses = frozenset([frozenset()])


def trigrams(word: str) -> list[str]:
    low = word.lower()
    return sorted({low[k : k + 3] for k in range(len(low) - 2)})


def _least(clauses: Clauses) -> Clauses:
    """Without clauses that ask for more than another one does."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _of_strings(strings: frozenset[str]) -> Clauses:
    return _least(frozenset(frozenset(trigrams(s)) for s in strings))


def _both(a: Clauses, b: Clauses) -> Clauses:
    """Both hold; where that takes too many clauses, only the one of fewer."""
    every = _least(frozenset(x | y for x in a for y in b))
    return every if len(every) <= CLAUSES else min(a, b, key=len)


def _derived(parsed) -> tuple[frozenset[str] | None, Clauses]:
    """Of a parsed expression: the lower-cased strings that it stands for, if they are few, and its clauses."""
    strings, clauses, whole = frozenset([""]), ANY, True
    for step, given in parsed:
        own, asked = _step(step, given)
        if own is not None and len(strings) * len(own) <= STRINGS:
            strings = frozenset(a + b for a in strings for b in own)
            continue
        clauses, whole = _both(clauses, _of_strings(strings)), False
        strings = frozenset([""]) if own is None else own
        clauses = _both(clauses, asked) if own is None else clauses
    return (strings, _of_strings(strings)) if whole else (None, _both(clauses, _of_strings(strings)))


def _step(step, given) -> tuple[frozenset[str] | None, Clauses]:
    name = str(step)
    if name == "LITERAL":
        return frozenset([chr(given).lower()]), ANY
    if name == "IN":
        found: set[str] = set()
        for kind, value in given:
            if str(kind) == "LITERAL":
                found.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < 2 * CLASS:
                found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, ANY
        return (frozenset(found), ANY) if len(found) <= CLASS else (None, ANY)
    if name == "SUBPATTERN":
        return _derived(given[-1])
    if name == "BRANCH":
        each = [_derived(b) for b in given[1]]
        if all(own is not None for own, _ in each) and sum(len(own) for own, _ in each) <= STRINGS:
            return frozenset().union(*(own for own, _ in each)), ANY
        every = _least(frozenset().union(*(asked for _, asked in each)))
        return None, every if len(every) <= CLAUSES else ANY
    if name.endswith("REPEAT"):
        least, most, body = given
        own, asked = _derived(body)
        if (least, most) == (0, 1) and own is not None:
            return own | {""}, ANY
        if least == most == 1:
            return own, asked
        return None, asked if least else ANY
    if name == "AT":
        return frozenset([""]), ANY
    return None, ANY


def query(rule: Rule) -> list[list[str]]:
    """The Boolean trigram query: clauses, of which one must hold in full. Empty: every document."""
    from re import _parser

    clauses = _derived(_parser.parse(rule.pattern))[1]
    return [] if frozenset() in clauses else sorted(sorted(c) for c in clauses)


def index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (gram, doc_id) of the trigrams that the rules' queries ask for."""
    grams = sorted({g for r in rules for clause in query(r) for g in clause})
    low = F.lower("text")
    found = docs.select("doc_id", low.alias("low")).select("doc_id", F.explode(F.array_compact(F.array(*[F.when(F.col("low").contains(g), F.lit(g)) for g in grams]))).alias("gram")) if grams else None
    return found if found is not None else docs.select("doc_id", F.lit("").alias("gram")).limit(0)


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, kinds: the rules whose query a document meets."""
    clauses = [(r.kind, k, gram) for r in rules for k, clause in enumerate(query(r)) for gram in clause]
    sizes = [(r.kind, k, len(clause)) for r in rules for k, clause in enumerate(query(r))]
    spark = postings.sparkSession
    wanted = F.broadcast(spark.createDataFrame(clauses, "kind string, clause int, gram string"))  # as long as the rules
    size = F.broadcast(spark.createDataFrame(sizes, "kind string, clause int, size int"))
    met = postings.join(wanted, "gram").groupBy("doc_id", "kind", "clause").agg(F.countDistinct("gram").alias("n"))
    met = met.join(size, ["kind", "clause"]).filter("n = size")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def let(value: Column, of) -> Column:
    """of(value), for which value is worked out once, however often of uses it."""
    return F.transform(F.array(value), of)[0]


def sums(lengths: Column) -> Column:
    """The sums of what is before each element, by chunks of CHUNK."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    cut = lambda a: F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / CHUNK).cast("int")), lambda k: F.slice(a, k * CHUNK + 1, CHUNK))
    inside = lambda chunk, base: F.transform(chunk, lambda _, j: base + total(F.slice(chunk, 1, j)))
    each = lambda chunks, whole: F.flatten(F.transform(chunks, lambda c, k: let(total(F.slice(whole, 1, k)), lambda base: inside(c, base))))
    return let(lengths, lambda a: F.when(F.size(a) > 0, let(cut(a), lambda c: let(F.transform(c, total), lambda w: each(c, w)))).otherwise(F.array().cast("array<int>")))


def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, end, kind>> (code points) of the rule's leftmost matches that measure enough; null if none."""
    match = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    measured = match if not rule.group else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda g: F.length(g))
    sizes = F.arrays_zip(F.transform(match, lambda m: F.length(m)).alias("m"), F.transform(measured, lambda m: F.length(m)).alias("v"), gaps.alias("g"))
    sizes = F.filter(sizes, lambda x: x["m"].isNotNull())  # one gap more than matches
    before = lambda z: sums(F.transform(z, lambda x: x["m"] + x["g"]))
    put = lambda x, s: F.struct((s + x["g"]).alias("start"), (s + x["g"] + x["m"]).alias("end"), F.lit(rule.kind).alias("kind"), x["v"].alias("measure"))
    every = let(sizes, lambda z: F.zip_with(z, before(z), put))
    good = F.filter(every, lambda s: s["measure"] >= rule.least)
    return F.when(text.rlike(rule.pattern), F.transform(good, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with `spans`: array<struct<start, end, kind>>, by start, then by the order of rules."""
    found = materialize(candidates(index(columns(docs, "doc_id", "text"), rules), rules).filter("doc_id is not null").toDF("candidate", "kinds"), "candidates")
    every = [c for c in docs.columns if c != "spans"]
    d = docs.select(F.struct(*[docs[f"`{c}`"] for c in every]).alias("row"), docs["`doc_id`"].alias("own"), F.coalesce(docs["`text`"], F.lit("")).alias("body"))
    d = d.join(small(found), F.col("own") == F.col("candidate"), "left").select("row", "own", "body", "kinds")
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    for k, rule in enumerate(rules):
        maybe = F.col("own").isNull() | F.array_contains("kinds", rule.kind) if query(rule) else F.lit(True)
        d = d.withColumn(f"of{k}", F.when(maybe, spans(F.col("body"), rule)))
    ranked = lambda k: F.transform(F.coalesce(f"of{k}", none), lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    sorted_ = F.sort_array(F.concat(*[ranked(k) for k in range(len(rules))]))
    out = F.transform(sorted_, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return d.select(*[F.col("row").getField(c).alias(c) for c in every], out.alias("spans"))


def written(found: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
