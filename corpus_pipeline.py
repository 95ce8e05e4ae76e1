"""From raw documents to packed training sequences, in five stages.

Each stage takes the session, the documents its predecessor kept and the folder of tables, and returns a DataFrame; all
but the last return documents. Between stages the rows are written to the shared folder and read again, so a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lateline.llm.line_templates import drop_recurring_lines
from lateline.llm.minhash import NO_ID, link_documents, text_md5
from lateline.llm.mixing import mix_sources
from lateline.llm.packing import pack_documents
from lateline.llm.storage import Scratch
from lateline.llm.toxicity import score_documents, train
from lateline.workspace import configure


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject. It learns from the labels of these documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return score_documents(docs, train(docs, labels)).where("predicted = 0").select(*docs.columns)


#: Rounds in which the lines of a leaf are split into templates.
LEVELS = 3


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across them, and without those that had no other lines.

    ``n_chars`` follows the text, where there is such a column. Documents that were empty before stay.
    """
    rest = drop_recurring_lines(docs, min_tokens=1, levels=LEVELS).where("n_dropped = 0 OR length(trim(text)) > 0")
    return rest.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns])


#: Share of their shingles from which two documents are near copies.
NEAR_COPIES = 0.8


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id; of rows of equal id and text, one. Rows of
    one id and different texts are different documents."""
    first = link_documents(docs, similarity=NEAR_COPIES).where("first")
    first = first.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("first_id"), F.col("text_md5").alias("first_md5")).distinct()
    own = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    rows = docs.select(own, F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("first_id"), text_md5(F.col("text")).alias("first_md5"))
    rows = rows.join(first, ["first_id", "first_md5"], "left_semi").dropDuplicates(["first_id", "first_md5"])
    return rows.select(*[F.col("doc")[c].alias(c) for c in docs.columns])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of each source as often as the mixture reads them; every one at least once."""
    return mix_sources(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

#: A trained classifier decides in the first stage, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(configure(spark), "pipeline")
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        rows = scratch.keep(stage(spark, rows, sf_dir), f"stage-{number}")
    return rows
