"""Hazards in records: active content, script URIs, long base64, shell commands in structured fields, suspect URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type, severity, pattern; shell injection counts in structured fields only.
HAZARDS = (
    ("embedded_active_content", "warning", r"(?i)<\s*(?:script|iframe|object|embed|applet)\b[^>]*>"),
    ("javascript_uri", "warning", r"(?i)javascript\s*:"),
    ("base64_payload", "info", r"[A-Za-z0-9+/=]{500,}"),
    ("shell_injection", "warning", r"(?i)(?:\$\(.*?\)|`[^`]{2,}`|;\s*(?:rm|curl|wget|chmod|bash|sh|python|perl|nc|ncat)\b|&&\s*(?:rm|curl|wget|chmod|bash|sh|python|perl|nc|ncat)\b|\|\s*(?:bash|sh|python|perl)\b)"),
    ("suspicious_url", "info", r"(?i)https?://(?:[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}|.*?\.(?:tk|ml|ga|cf|gq|top|xyz|buzz|club|work|date|racing|download)\b|.*?pastebin\.com/raw/|.*?transfer\.sh/)"),
)
STRUCTURED = ("url", "source_url", "link", "command", "cmd", "script", "filename", "path", "file_path", "download_url")
SEVERITIES = ("info", "warning")


def counts(c: Column, structured: bool) -> Column:
    """array<struct<type, severity, n>> of a field's hazards."""
    each = [F.struct(F.lit(t).alias("type"), F.lit(s).alias("severity"), F.coalesce(F.regexp_count(c, F.lit(p)), F.lit(0)).alias("n")) for t, s, p in HAZARDS if structured or t != "shell_injection"]
    return F.filter(F.array(*each), lambda x: x["n"] > 0)


def findings(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, type, severity, n: one row a hazard type of a field. Fields that begin with _ are the engine's own."""
    def of(f: str) -> Column:
        return F.transform(counts(F.col(f), f in STRUCTURED), lambda x: F.struct(F.lit(f).alias("field"), x["type"].alias("type"), x["severity"].alias("severity"), x["n"].alias("n")))

    per = [of(f) for f in fields if not f.startswith("_")]
    return df.select(key, F.explode(F.concat(*per)).alias("h")).select(key, "h.field", "h.type", "h.severity", "h.n")


def summary(found: DataFrame) -> DataFrame:
    """type, n, severity (the worst)."""
    worst = F.max(F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("severity")))
    return found.groupBy("type").agg(F.sum("n").cast("long").alias("n"), F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), worst.cast("int")).alias("severity"))


#: First bytes (hex) and kinds of binaries.
MAGIC = (
    ("4D5A", "pe"), ("7F454C46", "elf"), ("CFFAEDFE", "macho"), ("CEFAEDFE", "macho"), ("CAFEBABE", "macho"),
    ("D0CF11E0A1B11AE1", "ole"), ("504B0304", "zip"), ("1F8B", "gzip"), ("526172211A07", "rar"), ("377ABCAF271C", "7z"), ("FD377A585A00", "xz"),
)


def binary_kind(content: Column) -> Column:
    """The kind of a binary by its first bytes, or null."""
    head = F.hex(F.substring(content, 1, 8))
    out = F.lit(None).cast("string")
    for magic, name in reversed(MAGIC):
        out = F.when(head.startswith(magic), F.lit(name)).otherwise(out)
    return out


#: What tells generated data, surely and maybe.
SYNTHETIC_YES = (
    "synthetic", "fabricated", "simulated", "simulation", "generated by", "llm-generated", "llm generated", "gpt-generated",
    "gpt generated", "ai-generated", "ai generated", "auto-generated", "auto generated", "machine-generated",
    "machine generated", "instruction-tuning", "instruction tuning", "instruct dataset", "dpo",
)
SYNTHETIC_MAYBE = (
    "generated", "instruction", "instructions", "q&a", "q & a", "question-answer", "question and answer",
    "questions and answers", "prompt-response", "prompt/response", "prompt response", "augmented", "preference pairs",
)


def synthetic(c: Column) -> Column:
    """struct(verdict Yes/review/No, terms) by whole words of lower-cased text."""
    low = F.lower(F.coalesce(c, F.lit("")))
    met = lambda terms: F.array_compact(F.array(*[F.when(low.rlike(rf"(?<![a-z0-9]){t}(?![a-z0-9])"), F.lit(t)) for t in terms]))
    sure, maybe = met(SYNTHETIC_YES), met(SYNTHETIC_MAYBE)
    return F.when(F.size(sure) > 0, F.struct(F.lit("Yes").alias("verdict"), sure.alias("terms"))).when(F.size(maybe) > 0, F.struct(F.lit("review").alias("verdict"), maybe.alias("terms"))).otherwise(F.struct(F.lit("No").alias("verdict"), F.array().cast("array<string>").alias("terms")))
