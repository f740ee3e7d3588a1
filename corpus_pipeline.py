"""From documents to token files: five stages, each over all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's docs. All but the last return the columns of docs. run() applies them to
the documents of sf_dir. No SQL states the result: a trained classifier and a tokenizer take part (see tests/llm).

All stages: an empty table of documents gives no rows; extra columns, whatever their names, are kept; texts are taken
whole, however long. The other cases are told with each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import decontaminate, mixing, ngram_join, token_output, toxicity
from loamline.llm.common import materialize, new_path, table
from loamline.llm.queries import tokenizer_json
from loamline.session import ship


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go: those of a score of 0.3 or more, a tie included.

    Null and empty texts score alike, by the prior alone; repeated rows go or stay together; a null doc_id has no label;
    without toxic labels, or without any, nothing goes."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document of the least id stays (five words, a similarity of 0.8).

    Texts without words (null, empty) all stay; rows equal in id and text stay together; of texts without an id one row
    stays, if no document with an id is in their component; a similarity of exactly 0.8 links."""
    ship(spark)
    return ngram_join.first_of_each(docs, ngram_join.Settings(shingle=5, percent=80))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null texts and texts without words stay, as does all where the benchmark is empty; repeated rows go together."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the curriculum draws them, in training order.

    Texts without words are never drawn; the null source is a source, the last; repeated rows are drawn each on its own;
    of equal positions the lesser doc_id comes first."""
    return mixing.draw(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file's documents: doc_id, start, n_tokens, ids_crc32, read back from it.

    In ascending doc_id, null first, then by text; each draw is a document of its own; a null text is the end id alone."""
    ship(spark)
    path = new_path(spark, "tokens")
    # workers hold what the stages before have left them, too
    token_output.write_tokens(docs, path, tokenizer_json(), memo=160 << 20)
    return token_output.read_digests(spark, path)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_join", near_duplicate_stage),
    ("decontaminate", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
