"""Readers and writers of records: tolerant JSON lines, tables, whole files, corpus trees, routed and combined sinks."""

from __future__ import annotations

import json
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from loamline.functions import text, urls

#: Columns that a text is taken from, and pairs of question and answer, when a table has no text (fixed values).
TEXT_COLUMNS = ("text", "content", "body", "description", "summary", "message")
PAIRS = (("question", "answer"), ("prompt", "response"), ("instruction", "output"))


def spread(df: DataFrame) -> DataFrame:
    """df dealt out over all cores where its files make fewer splits than there are (one large row group is one task);
    a table of many splits stays as it lies."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Records of JSON lines under path. Blank lines are skipped; a line that isn't an object has _parse_error.

    With a schema: its columns; without: `record`, a VARIANT. `_rel` (path) and `_bytes` tell where a record is from.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select("value", F.col("_metadata.file_path").alias("_rel"))
    lines = lines.filter(F.col("value").rlike(r"\S"))
    v = F.try_parse_json("value")
    bad = v.isNull() | ~F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    lines = lines.withColumn("_parse_error", bad)
    if schema is None:
        return lines.select(F.when(~bad, v).alias("record"), "_parse_error", "_rel")
    row = F.from_json(F.when(~F.col("_parse_error"), F.col("value")), schema)
    return lines.select(row.alias("r"), "_parse_error", "_rel").select("r.*", "_parse_error", "_rel")


def tree(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame:
    """A corpus tree's records with sub_domain, source and file from the path <root>/<sub-domain>/<source>/<file>;
    fewer parts give the first for both. Scratch folders (_z) are left out."""
    d = json_lines(spark, root, schema).filter(~F.col("_rel").contains("/_z/"))
    base = root.split(":", 1)[-1].lstrip("/").rstrip("/")
    parts = F.split(F.regexp_replace(F.url_decode("_rel"), rf"^.*?{_quoted(base)}/", ""), "/")
    n = F.size(parts)
    return d.withColumns({"sub_domain": parts[0], "source": F.when(n >= 3, parts[1]).otherwise(parts[0]), "file": F.element_at(parts, -1)})


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() or c in "/_" else "\\" + c for c in s)


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """A table by its file's ending: CSV/TSV, Parquet, JSON, JSON lines, spreadsheets, plain and rule texts; others sniffed."""
    ext = PurePosixPath(path).suffix.lower().lstrip(".")
    if ext in ("csv", "tsv"):
        return csv(spark, path, "\t" if ext == "tsv" else ",")
    if ext == "parquet":
        return spark.read.parquet(path)
    if ext in ("jsonl", "ndjson"):
        return spark.read.json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt")
    if ext == "json":
        return broken_json(spark, path)
    if ext in ("xls", "xlsx"):
        import pandas as pd  # a spreadsheet is one file of bounded rows (2^20), read where it lies

        return spark.createDataFrame(pd.read_excel(path, dtype=str))
    if ext in ("txt", "md", "yar", "yara", "yml", "yaml", "rule", "rules"):
        return whole_files(spark, path)
    return unknown(spark, path)


def csv(spark: SparkSession, path: str, sep: str = ",", names: list[str] | None = None) -> DataFrame:
    """Every column a string, bad rows dropped. names: of a table without a header, if it has as many columns."""
    if names:
        d = spark.read.csv(path, sep=sep, header=False, mode="DROPMALFORMED", multiLine=True, escape='"')
        return d.toDF(*names) if len(d.columns) == len(names) else d
    return spark.read.csv(path, sep=sep, header=True, mode="DROPMALFORMED", multiLine=True, escape='"')


def broken_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON file as records: a list's elements, an object, or a scalar as {text}; cut-off lists keep what is whole."""
    whole = spark.read.text(path, wholetext=True)

    def repaired(value: str) -> list[str]:
        decoder, out, at = json.JSONDecoder(), [], 0
        while at < len(value):
            while at < len(value) and value[at] in " \t\r\n,[]":
                at += 1
            if at >= len(value):
                break
            try:
                found, at = decoder.raw_decode(value, at)
            except ValueError:
                nxt = value.find("{", at + 1)
                if nxt < 0:
                    break
                at = nxt
                continue
            out.append(json.dumps(found if isinstance(found, dict) else {"text": str(found)}))
        return out

    # Spark has no repair of JSON: one file a row, in Arrow batches
    lines = whole.select(F.explode(F.udf(repaired, "array<string>", useArrow=True)("value")).alias("value"))
    return spark.read.json(lines.rdd.map(lambda r: r.value)) if not lines.isEmpty() else spark.createDataFrame([], "text string")


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One record a file: text and file."""
    return spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select(F.col("value").alias("text"), F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))


def unknown(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines, JSON, CSV, TSV or plain text, whichever the first lines look like."""
    head = [r.value for r in spark.read.text(path).limit(5).collect()]
    first = next((x for x in head if x.strip()), "")
    if first.lstrip().startswith("{") and first.rstrip().endswith("}"):
        return spark.read.json(path)
    if first.lstrip()[:1] in "[{" and first:
        return broken_json(spark, path)
    for sep in (",", "\t"):
        if first.count(sep) and len({x.count(sep) for x in head if x.strip()}) == 1:
            return csv(spark, path, sep)
    return whole_files(spark, path)


def enrich(d: DataFrame, source: str, url: str, licence: str) -> DataFrame:
    """source, url and license if absent; text from a column of prose or a pair of question and answer."""
    low = {c.lower(): c for c in d.columns}
    d = d.withColumns({n: F.lit(v) for n, v in (("source", source), ("url", url), ("license", licence)) if n not in low})
    if "text" in low:
        return d
    for q, a in PAIRS:
        if q in low and a in low:
            return d.withColumn("text", F.concat(F.col(low[q]), F.lit("\n\n"), F.col(low[a])))
    for n in TEXT_COLUMNS:
        if n in low:
            return d.withColumn("text", F.col(low[n]).cast("string"))
    return d


def combine(parts: list[DataFrame]) -> DataFrame:
    """All columns of all parts."""
    out = parts[0]
    for d in parts[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def to_jsonl(d: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """Null fields are left out; the engine's own (_...) columns stay."""
    w = d.write.mode(mode)
    (w.partitionBy(*by) if by else w).json(path)


def counts(d: DataFrame, by: str = "_rel") -> DataFrame:
    return d.groupBy(by).agg(F.count("*").alias("records"))


def shard_groups(d: DataFrame, c: str = "file") -> DataFrame:
    return d.withColumn("group", urls.shard_group(F.col(c)))


def binaries(spark: SparkSession, root: str) -> DataFrame:
    """path, kind, length of files that begin as binaries do. Only a file's row is read, by Spark's own reader."""
    from loamline.functions import hazards

    d = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return d.select("path", hazards.binary_kind(F.col("content")).alias("kind"), "length").filter("kind is not null")


#: Limits on archives (fixed values): bytes in all, entries, and bytes out a byte in.
ARCHIVE = (20 * 10**9, 200_000, 200)


def archive_refusal(entries: DataFrame, limits: tuple[int, int, int] = ARCHIVE) -> DataFrame:
    """archive, reason (or null) from a table of entries (archive, name, size, packed)."""
    unsafe = F.col("name").rlike(r"^(?:/|\\|[A-Za-z]:)|(?:^|[/\\])\.\.(?:[/\\]|$)")
    a = entries.groupBy("archive").agg(F.sum("size").alias("b"), F.count("*").alias("n"), F.sum("packed").alias("p"), F.max(unsafe).alias("u"))
    return a.select("archive", F.when(F.col("u"), "unsafe path").when(F.col("n") > limits[1], "too many entries").when(F.col("b") > limits[0], "too large").when(F.col("b") > limits[2] * F.greatest("p", F.lit(1)), "ratio").alias("reason"))


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def string_columns(d: DataFrame) -> list[str]:
    return [f.name for f in d.schema if isinstance(f.dataType, StringType)]


def nonblank(c: Column) -> Column:
    return F.coalesce(text.strip(c), F.lit("")) != ""
