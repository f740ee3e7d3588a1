"""Incremental runs by Structured Streaming: only new files are read, and what was done is in the checkpoint.

Streams run with trigger(availableNow=True): a run takes what has come since the last one and ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from loamline.functions import text


def new_records(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the JSON lines under path; a cut-off last line is a corrupt record, and left out."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).option("mode", "DROPMALFORMED").option("recursiveFileLookup", "true").json(path)


def append(stream: DataFrame, out: str, checkpoint: str, by: list[str] | None = None) -> None:
    """Writes what is new as Parquet, each input file once, however often a run fails and is begun again."""
    w = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    (w.partitionBy(*by) if by else w).start().awaitTermination()


def distinct_by_state(stream: DataFrame, c: str = "text") -> DataFrame:
    """The first record of each exact fingerprint; the hashes are kept in the state store."""
    return stream.withColumn("fingerprint", text.exact_fingerprint(F.col(c))).dropDuplicates(["fingerprint"])


def distinct_by_journal(stream: DataFrame, out: str, checkpoint: str, order: list[str], c: str = "text") -> None:
    """The same against a table: a batch keeps the first of each fingerprint that `out` hasn't. A batch that is run
    again replaces its own partition, so nothing is written twice."""
    from loamline.operators import clean

    def step(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        d = batch.withColumn("fingerprint", text.exact_fingerprint(F.col(c)))
        d = clean.first_wins(d, F.col("fingerprint"), [F.col(x) for x in order]).filter("not duplicate").drop("duplicate", "dup_reason")
        if n:
            done = spark.read.parquet(out).filter(F.col("batch") < n).select("fingerprint")
            d = d.join(done, "fingerprint", "left_anti")
        d.withColumn("batch", F.lit(n)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def running_stats(stream: DataFrame, name: str, checkpoint: str, by: str = "source") -> DataFrame:
    """records and tokens so far by source, in the table `name` (complete mode: one row a source)."""
    a = stream.groupBy(by).agg(F.count("*").alias("records"), F.sum(text.token_count(F.col("text"))).alias("tokens"))
    q = a.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def finished(sources: DataFrame, ledger: DataFrame, key: str, retry_failed: bool = False) -> DataFrame:
    """Sources left to do: those that the ledger (key, status) hasn't; failed ones again if asked."""
    done = ledger.filter(F.col("status").like("ok%")) if retry_failed else ledger
    return sources.join(done.select(key).distinct(), key, "left_anti")
