"""The cleaning chain: text mapping, sanitising, anomaly routes, redaction, language policy, exact dedup, reports.

A record never fails: it gets a route (clean, flagged, dropped, excluded) with the stage and reason that decided, and
route_to() writes each route apart. Order is data: `ordinal` columns (file, line) decide what comes first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from loamline import config
from loamline.functions import lang, pii, text
from loamline.session import table

#: Fields in the order in which they are tried.
COMBINATIONS = (
    ("instruction", "input", "output"), ("instruction", "output"), ("question", "answer"), ("prompt", "completion"),
    ("prompt", "response"), ("query", "response"), ("user", "assistant"), ("prompt", "chosen"), ("question", "chosen"),
    ("instruction", "chosen"), ("input", "output"), ("title", "abstract"), ("title", "body"),
)
MESSAGE_FIELDS = ("messages", "conversations", "conversation", "dialog", "dialogue", "turns")
ROLES = {"user": "User", "human": "User", "prompter": "User", "assistant": "Assistant", "gpt": "Assistant", "bot": "Assistant", "model": "Assistant", "system": "System"}
SINGLE = (
    "text content body article page_content passage document fulltext full_text raw_text message email email_text "
    "email_body mail comment post abstract summary description shortdescription short_description details definition "
    "explanation rationale analysis response completion answer output chosen assistant transcript dialogue conversation "
    "story essay instruction question sentence review caption notes playbook source_code code_snippet func code"
).split()
BEST_TEXT = ("text", "content", "description", "body", "raw_log", "message", "additional_info")
DATE_FIELDS = ("date", "collection_date", "last_updated", "published", "timestamp", "created", "modified")


def _filled(c: Column) -> Column:
    """Stripped, or null if nothing is left."""
    return F.nullif(text.strip(c), F.lit(""))


def turns_text(turns: Column) -> Column:
    """array<struct<role, content>> as `Role: content` parts with blank lines between; system turns are left out."""
    known = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

    def part(t: Column) -> Column:
        role, content = F.lower(text.strip(F.coalesce(t["role"], F.lit("")))), _filled(t["content"])
        label = F.coalesce(F.try_element_at(known, role), F.nullif(text.capitalized(role), F.lit("")))
        return F.when((role != "system") & content.isNotNull(), F.coalesce(F.concat(label, F.lit(": "), content), content))

    return F.nullif(F.array_join(F.array_compact(F.transform(turns, part)), "\n\n"), F.lit(""))


def _turns(df: DataFrame, name: str) -> Column | None:
    """A message list's column as array<struct<role, content>>, whatever its elements are."""
    kind = df.schema[name].dataType
    if not isinstance(kind, ArrayType):
        return None
    c = df[f"`{name}`"]
    if isinstance(kind.elementType, StringType):
        return F.transform(c, lambda x: F.struct(F.lit("").alias("role"), x.alias("content")))
    if not isinstance(kind.elementType, StructType):
        return None
    have = set(kind.elementType.fieldNames())

    def of(x: Column, names: tuple[str, ...]) -> Column:
        found = [F.nullif(x[n].cast("string"), F.lit("")) for n in names if n in have]
        return F.coalesce(*found) if found else F.lit(None).cast("string")

    return F.transform(c, lambda x: F.struct(of(x, ("role", "from")).alias("role"), of(x, ("content", "value", "text")).alias("content")))


def map_text(df: DataFrame, hint: str | list[str] | None = None) -> DataFrame:
    """df with `text` and `_text_field` (what it was built from, null if nothing): text itself, the hint, a list of
    turns, a combination of two or more columns, a single column of prose. Names match in any case."""
    by_name = {c.lower(): c for c in reversed(df.columns)}

    def col(n: str) -> Column | None:
        actual = by_name.get(n)
        return _filled(df[f"`{actual}`"]) if actual and isinstance(df.schema[actual].dataType, StringType) else None

    tries: list[tuple[Column, Column]] = []
    own = df["text"] if "text" in df.columns and isinstance(df.schema["text"].dataType, StringType) else None
    if own is not None:
        tries.append((F.when(_filled(own).isNotNull(), own), F.lit("text")))

    def joined(names: list[str], least: int, label: bool) -> None:
        have = [(n, c) for n in names if (c := col(n)) is not None]
        if len(have) < least:
            return
        parts = F.array_compact(F.array(*[F.concat(F.lit(f"{n.capitalize()}: "), c) if label else c for n, c in have]))
        used = F.array_compact(F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in have]))
        tries.append((F.when(F.size(parts) >= least, F.array_join(parts, "\n\n")), F.array_join(used, "+")))

    if hint:
        names = [hint] if isinstance(hint, str) else hint
        joined([n.lower() for n in names], 1, len(names) > 1)
    for n in MESSAGE_FIELDS:
        if n in by_name and (turns := _turns(df, by_name[n])) is not None:
            tries.append((turns_text(turns), F.lit(n)))
    for combination in COMBINATIONS:
        joined(list(combination), 2, True)
    for n in SINGLE:
        if (c := col(n)) is not None:
            tries.append((c, F.lit(n)))
    if not tries:
        none = F.lit(None).cast("string")
        return df.withColumns({"text": none, "_text_field": none})
    found = F.coalesce(*[F.when(t.isNotNull(), F.struct(t.alias("text"), f.alias("field"))) for t, f in tries])
    return df.withColumn("_mapped", found).withColumns({"text": F.col("_mapped.text"), "_text_field": F.col("_mapped.field")}).drop("_mapped")


def best_text(df: DataFrame) -> Column:
    """The first filled one of seven fields, else all string columns' values."""
    named = [_filled(df[n]) for n in BEST_TEXT if n in df.columns]
    others = F.concat_ws(" ", *[df[f"`{f.name}`"] for f in df.schema if isinstance(f.dataType, StringType)])
    return F.coalesce(*named, F.nullif(text.strip(others), F.lit("")), F.lit(""))


def structural(c: Column, least: int) -> Column:
    """Why a record has no usable text, or null."""
    n = F.length(text.strip(c))
    return F.when(c.isNull(), "missing text field").when(n == 0, "empty text").when(n < least, F.lit(f"text shorter than {least} chars"))


def behavioural(c: Column, conf: config.Clean) -> Column:
    """What is odd about a text, with its measure, or null."""
    measures = F.struct(F.length(text.strip(c)).alias("n"), text.garbage_ratio(c).alias("g"), text.repeated_line_ratio(c).alias("r"), text.top_token_ratio(c).alias("t"))
    return text.let(
        measures,
        lambda m: F.when(m["n"] > conf.max_chars, F.format_string("extreme length (%d chars)", m["n"]))
        .when(m["g"] > conf.garbage_max, F.format_string("garbage ratio %.2f", m["g"]))
        .when(m["r"] > conf.repeat_max, F.format_string("repeated-line ratio %.2f", m["r"]))
        .when(m["t"] > conf.repeat_max, F.format_string("single-token dominance %.2f", m["t"])),
    )


def classify(c: Column, conf: config.Clean = config.Clean(), parse_error: Column | None = None) -> Column:
    """struct(kind: structural, behavioral or clean; reason)."""
    bad = structural(c, conf.min_chars)
    if parse_error is not None:
        bad = F.when(parse_error, "json parse error").otherwise(bad)
    said = lambda k, r: F.struct(F.lit(k).alias("kind"), r.alias("reason"))
    return F.when(bad.isNotNull(), said("structural", bad)).otherwise(text.let(behavioural(c, conf), lambda odd: F.when(odd.isNotNull(), said("behavioral", odd)).otherwise(said("clean", F.lit("")))))


def sanitize(df: DataFrame) -> DataFrame:
    """df with sanitised text, tidy source and license, ISO dates, and `_sanitized` (whether anything changed)."""
    changes, out = F.lit(False), {}
    for f in df.schema:
        if not isinstance(f.dataType, StringType):
            continue
        c = df[f"`{f.name}`"]
        new = text.sanitized(c) if f.name in ("text", "source", "license") else text.iso_date(c) if f.name in DATE_FIELDS else c
        if f.name in ("source", "url", "license", "text"):
            new = F.coalesce(new, F.lit(""))
        if f.name in ("text", "source", "url", "license", *DATE_FIELDS):
            out[f.name] = new
            changes = changes | ~new.eqNullSafe(c)
    return df.withColumn("_sanitized", changes).withColumns({k: v for k, v in out.items()}) if out else df.withColumn("_sanitized", F.lit(False))


def clean(df: DataFrame, conf: config.Clean = config.Clean(), drop_foreign: bool = False, translate: lang.Translator = lang.no_translator, written: bool = True, redactor: Callable[[Column], Column] = pii.redact) -> DataFrame:
    """Each record of df (any shape) with text, route, stage, reason, pii (spans redacted), lang and counters' flags.

    The order of stages is the engine's contract: map, sanitise, anomaly, redaction, language. The sanitised text and
    the result are written to the shared folder and read back (written=True), so that no rule works out another's again
    and filters and self-joins after it repeat none; written=False leaves the plan lazy. `redactor` is a function from a
    text column to struct(text, n).
    """
    d = map_text(df)
    before = structural(F.col("text"), conf.min_chars)
    d = sanitize(d.withColumn("_was_bad", before.isNotNull()))
    d = table(d, "tidy") if written else d
    parse_error = F.col("_parse_error") if "_parse_error" in df.columns else None
    d = d.withColumn("_class", classify(F.col("text"), conf, parse_error))
    d = d.withColumn("_class", F.when(F.col("_text_field").isNull(), F.struct(F.lit("excluded").alias("kind"), F.lit("no text").alias("reason"))).otherwise(F.col("_class")))
    if parse_error is not None:
        d = d.withColumn("_class", F.when(parse_error, F.struct(F.lit("structural").alias("kind"), F.lit("json parse error").alias("reason"))).otherwise(F.col("_class")))
    passed = F.col("_class.kind") == "clean"
    d = d.withColumn("_pii", redactor(F.when(passed, F.col("text"))))
    redacted = F.when(F.col("_pii.n") > 0, text.strip(F.col("_pii.text"))).otherwise(F.col("text"))
    d = d.withColumn("text", F.when(passed, redacted).otherwise(F.col("text"))).withColumn("pii", F.when(passed, F.col("_pii.n")).otherwise(0))
    d = d.withColumn("detected", F.when(passed, lang.detect(F.col("text"))))
    foreign = passed & ~lang.allowed(F.col("detected"), conf.languages)
    translated = F.when(foreign & F.lit(not drop_foreign), translate(F.col("text")))
    d = d.withColumn("_translated", translated)
    lost = foreign & F.col("_translated").isNull()
    route = F.when(F.col("_class.kind") == "structural", "dropped").when(F.col("_class.kind") == "behavioral", "flagged").when(F.col("_class.kind") == "excluded", "excluded").when(lost, "dropped").otherwise("clean")
    reason = F.when(lost, F.concat(F.lit("language "), F.col("detected"))).otherwise(F.col("_class.reason"))
    stage = F.when(lost, "language").when(F.col("_class.kind").isin("structural", "behavioral"), "anomaly").when(F.col("_class.kind") == "excluded", "textmap")
    fixed = F.col("_was_bad") & F.col("_sanitized") & (F.col("_class.kind") != "structural") & (F.col("_class.kind") != "excluded")
    d = d.withColumns({"route": route, "stage": stage, "reason": reason, "struct_fixed": fixed, "_orig_lang": F.when(F.col("_translated").isNotNull(), F.col("detected"))})
    d = d.withColumn("text", F.coalesce("_translated", "text"))
    d = d.withColumnRenamed("_sanitized", "sanitized").drop("_class", "_pii", "_translated", "_was_bad")
    return table(d, "cleaned") if written else d


def first_wins(df: DataFrame, key: Column, order: list[Column], reason: str = "exact duplicate") -> DataFrame:
    """df with `duplicate` (a row of the key came before, by order) and `dup_reason`.

    The first row of a key is found by a pre-aggregated minimum, so a key of a third of all rows meets in no task.
    """
    every = [c for c in df.columns if c not in ("duplicate", "dup_reason")]
    d = df.select(F.struct(*[F.col(f"`{c}`") for c in every]).alias("row"), key.alias("key"), F.struct(*order).alias("at"))
    first = d.groupBy(F.col("key").alias("of")).agg(F.min("at").alias("first"))
    # null-safe: a null key is a key, and no filter on the key's expression is pushed down
    d = d.join(first, F.col("key").eqNullSafe(F.col("of"))).withColumn("again", F.col("at") != F.col("first"))
    return d.select(*[F.col("row").getField(c).alias(c) for c in every], F.col("again").alias("duplicate"), F.when(F.col("again"), F.lit(reason)).alias("dup_reason"))


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of each key the row that comes last by order (a pre-aggregated maximum)."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, F.struct(*order)).alias("row")).select("row.*")


def not_in_journal(df: DataFrame, key: Column, journal: DataFrame) -> DataFrame:
    """Rows whose key isn't among the journal's fingerprints; torn lines of it (not 64 hex digits) are left out."""
    done = journal.filter(F.col("fingerprint").rlike("^[0-9a-f]{64}$")).select(F.col("fingerprint").alias("_key")).distinct()
    return df.withColumn("_key", key).join(done, "_key", "left_anti").drop("_key")


def report(cleaned: DataFrame, by: list[str]) -> DataFrame:
    """Counters a file (or whatever `by` names), and a TOTAL row, by one rollup."""
    flag = lambda c, n: F.count_if(c).alias(n)
    dup = F.col("duplicate") if "duplicate" in cleaned.columns else F.lit(False)
    good = (F.col("route") == "clean") & ~dup
    counters = [
        F.count("*").alias("n_in"), flag(good, "n_out"), flag((F.col("route") == "dropped") & (F.col("stage") == "anomaly"), "struct_dropped"),
        flag(F.col("route") == "flagged", "flagged"), flag(F.col("route") == "excluded", "excluded_no_text"), flag(F.col("stage") == "language", "lang_dropped"),
        flag((F.col("route") == "clean") & dup, "exact_dups"), flag(F.col("sanitized"), "sanitized"), flag(F.col("struct_fixed"), "struct_fixed"),
        flag(F.col("pii") > 0, "pii_records"), F.sum("pii").alias("pii_spans"), flag(F.col("_text_field") != "text", "mapped_text"), flag(F.col("_orig_lang").isNotNull(), "translated"),
    ]
    total = F.grouping_id()
    rolled = cleaned.rollup(*by).agg(total.alias("_level"), *counters).filter(F.col("_level").isin(0, (1 << len(by)) - 1))
    named = [F.when(F.col("_level") == 0, F.col(c)).otherwise("TOTAL" if k == 0 else "").alias(c) for k, c in enumerate(by)]
    return rolled.select(*named, *[c for c in rolled.columns if c not in (*by, "_level")])


def merge_reports(old: DataFrame, new: DataFrame, key: str = "file") -> DataFrame:
    """New rows win by key."""
    return old.join(new.select(key), key, "left_anti").unionByName(new, allowMissingColumns=True)


def route_to(cleaned: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Writes clean, flagged and dropped records under path/route=...; excluded ones are only counted."""
    cleaned.filter("route != 'excluded'").write.mode(mode).partitionBy("route").json(path)


def affected(df: DataFrame, c: str, after: Column) -> DataFrame:
    """n_in, n_affected: how many rows one stage alone would change."""
    return df.agg(F.count("*").alias("n_in"), F.count_if(~after.eqNullSafe(F.col(c))).alias("n_affected"))
