"""Text functions as Column expressions; Python only for what Spark has no expression for (NFC, mojibake)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that never count as garbage, beside letters, digits and white space.
PLAIN = r""".,;:!?'"()\[\]{}\-_/\\@#%&*+=<>|~`$^"""
TOKEN = r"[\p{L}\p{N}_]+"
SPACES = r"[\s\p{Z}]+"


def let(value: Column, of) -> Column:
    """of(value), for which value is worked out once, however often of uses it (lambdas else repeat it)."""
    return F.transform(F.array(value), of)[0]


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


@F.pandas_udf(StringType())
def repaired(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """UTF-8 once read as Latin-1 is read again, and the text composed (NFC). Null stays null."""

    def one(s):
        if s is None:
            return None
        if any(m in s for m in ("Ã", "Â", "â€")):
            try:
                s = s.encode("latin-1").decode("utf-8")
            except UnicodeError:
                pass
        return s if s.isascii() else unicodedata.normalize("NFC", s)

    for texts in parts:
        yield texts.map(one, na_action=None)


def composed(c: Column) -> Column:
    """repaired(), for which ASCII texts make no round trip to Python (they are passed as null)."""
    odd = c.rlike(r"[^\x00-\x7F]")
    return F.coalesce(repaired(F.when(odd, c)), c)


def tidy(c: Column) -> Column:
    """Line ends, control characters, runs of spaces and blank lines, without the repair of the encoding."""
    c = F.regexp_replace(c, r"\r\n?", "\n")
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]", "")
    c = F.regexp_replace(c, r"[ \t]+", " ")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(c, r"[ \t\p{Z}]+\n", "\n"))


def sanitized(c: Column) -> Column:
    return tidy(composed(c))


def hash_form(c: Column) -> Column:
    """Lower case, each run of white space one space, stripped: the exact key keeps punctuation."""
    return F.trim(F.regexp_replace(F.lower(c), SPACES, " "))


def exact_fingerprint(c: Column) -> Column:
    return F.sha2(hash_form(c), 256)


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN), F.lit(0))


def token_fingerprint(c: Column) -> Column:
    """The key of normalisation: lower-cased tokens only."""
    return F.sha2(F.array_join(tokens(c), " "), 256)


def content_hash(c: Column) -> Column:
    return F.sha2(F.coalesce(c, F.lit("")), 256)


def token_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(TOKEN)), F.lit(0))


def word_count(c: Column) -> Column:
    """White-space separated words."""
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\s\p{Z}]+")), F.lit(0))


def garbage_ratio(c: Column) -> Column:
    bad = F.regexp_count(c, F.lit(rf"[^\p{{L}}\p{{N}}\p{{Z}}\s{PLAIN}]"))
    return F.when(F.length(c) > 0, bad / F.length(c)).otherwise(0.0)


def full_lines(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: x != "")


def repeated_line_ratio(c: Column) -> Column:
    """Share of lines that repeat another; 0 under five lines."""
    ratio = lambda x: F.when(F.size(x) >= 5, 1 - F.size(F.array_distinct(x)) / F.size(x)).otherwise(0.0)
    return let(full_lines(c), ratio)


def top_token_ratio(c: Column) -> Column:
    """Share of the most frequent token; 0 under twenty. Sorted tokens make runs; the longest run is the count."""
    start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"), F.lit("").alias("last"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(x == a["last"], a["run"] + 1).otherwise(1)
        return F.struct(run.alias("run"), F.greatest(a["best"], run).alias("best"), x.alias("last"))

    # sort_array compares natively; array_sort would by an expression
    best = lambda x: F.aggregate(F.sort_array(x), start, step, lambda a: a["best"]) / F.size(x)
    return let(tokens(c), lambda x: F.when(F.size(x) >= 20, best(x)).otherwise(0.0))


def shingles(words: Column, k: int) -> Column:
    """Distinct runs of k words; fewer words are one shingle; none if there are no words."""
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - k + 1, F.lit(1))), lambda i: F.array_join(F.slice(w, i, k), " "))
    return let(words, lambda w: F.when(F.size(w) > 0, F.array_distinct(runs(w))).otherwise(F.array().cast("array<string>")))


def split_words(c: Column) -> Column:
    return F.filter(F.split(c, SPACES), lambda w: w != "")


def minhash(found: Column, permutations: int = 128, seed: int = 42) -> Column:
    """One least hash a permutation."""
    seeds = F.sequence(F.lit(seed), F.lit(seed + permutations - 1))
    return let(found, lambda f: F.transform(seeds, lambda p: F.array_min(F.transform(f, lambda s: F.xxhash64(p, s)))))


def minhash_similarity(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    return same / F.size(a)


def jaccard(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    return common / F.greatest(F.size(a) + F.size(b) - common, F.lit(1))


def capitalized(c: Column) -> Column:
    """First letter upper, all others lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substr(c, F.lit(2))))


def slug(c: Column, most: int = 45) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    s = F.regexp_replace(F.substring(s, 1, most), r"-+$", "")
    return F.when(s == "", F.lit("source")).otherwise(s)


#: Formats of dates that are tried in turn (fixed values); a time of day is cut off.
DATE_FORMATS = ("yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "MMMM d, yyyy", "d MMMM yyyy")


def iso_date(c: Column) -> Column:
    """The date as yyyy-MM-dd where one of the formats reads it; else as it was."""
    s = strip(c)
    stamp = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d"), F.try_to_date(F.substring(s, 1, 10), "yyyy-MM-dd"))
    return F.coalesce(F.date_format(F.coalesce(stamp, *[F.try_to_date(s, f) for f in DATE_FORMATS]), "yyyy-MM-dd"), c)


#: record_type by needles in " file source ", in order (fixed values).
RECORD_TYPES = (
    ("cve", ("nvd", "cve", "kev")),
    ("log", ("cloudtrail", "syslog", "auth-log", "raw_log", " log")),
    ("advisory", ("att&ck", "attack", "capec", "cwe", "mitre")),
    ("playbook", ("playbook", "runbook")),
    ("doc", ("nist", "sp800", "sp-800", "fips", "-act-", "gdpr", "dpdp", "iso-")),
)


def record_type(file: Column, source: Column) -> Column:
    hay = F.lower(F.concat(F.lit(" "), F.coalesce(file, F.lit("")), F.lit(" "), F.coalesce(source, F.lit("")), F.lit(" ")))
    out = F.lit("article")
    for name, needles in reversed(RECORD_TYPES):
        met = F.lit(False)
        for x in needles:
            met = met | hay.contains(x)
        out = F.when(met, F.lit(name)).otherwise(out)
    return out


def origin_format(file: Column) -> Column:
    ext = F.lower(F.regexp_extract(file, r"\.([A-Za-z0-9]+)(?:\.gz)?$", 1))
    known = F.create_map(*[F.lit(x) for pair in (("jsonl", "jsonl"), ("json", "json"), ("csv", "csv"), ("tsv", "csv"), ("parquet", "parquet"), ("xml", "xml"), ("pdf", "pdf"), ("html", "html"), ("txt", "text"), ("md", "text")) for x in pair])
    return F.coalesce(F.try_element_at(known, ext), F.lit("jsonl"))


def fields_text(names: list[str], skip: tuple[str, ...] = ("source", "url", "license"), most: int = 40) -> Column:
    """`name: value; name: value` of the first fields that have a value."""
    each = F.array(*[F.when(F.col(f"`{n}`").isNotNull() & (strip(F.col(f"`{n}`").cast("string")) != ""), F.concat(F.lit(f"{n}: "), F.col(f"`{n}`").cast("string"))) for n in names if n not in skip and not n.startswith("_")])
    return F.array_join(F.slice(F.array_compact(each), 1, most), "; ")


#: Lines that are never content (fixed values).
BOILERPLATE = (
    "cookie policy", "all rights reserved", "terms of service", "privacy policy", "subscribe to our newsletter",
    "share this article", "click here to", r"read more\b.*", r"copyright\s*©?.*",
)


def without_boilerplate(c: Column) -> Column:
    """Boilerplate lines and control characters go; runs of spaces and blank lines shrink."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    c = F.regexp_replace(c, rf"(?imd)^\s*(?:{'|'.join(BOILERPLATE)})\s*$", "")
    c = F.regexp_replace(c, "[ \t\u00A0]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def canary(seed: str | Column, i: Column) -> Column:
    return F.concat(F.lit("CANARY-"), F.substring(F.sha2(F.concat(F.lit(seed) if isinstance(seed, str) else seed, F.lit(":"), i.cast("string")), 256), 1, 32))


def found_canaries(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(r"CANARY-[0-9a-f]{32}"), F.lit(0))


def chunks(c: Column, limit: int) -> Column:
    """The text in pieces of at most limit characters, for translators."""
    n = F.greatest(F.ceil(F.length(c) / limit), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.substr(c, k * limit + 1, F.lit(limit)))


def failure_category(reason: Column) -> Column:
    """Why a record was rejected, in one word."""
    r = F.lower(F.coalesce(reason, F.lit("")))
    return (
        F.when(r.rlike("mapper|no usable text"), "MAPPER_MISMATCH")
        .when(r.rlike("domain|text shorter|empty|content_hash|must not be|not in"), "DIRTY_DATA")
        .otherwise("AMBIGUOUS")
    )
