"""Mixing sources to target weights by temperature.

The token shares of the sources are raised to one exponent and normalised. At exponent 1 the mixture is the corpus, at 0
every source weighs the same; on the way down the entropy rises and small sources are read more often. The exponent is
bisected to the first value that meets the target entropy or the repetition limit. Weights become token budgets, scaled
so that no source is read less than once. A budget is realised as blocks: each whole pass is a permutation of all of the
source's documents, and the last block is the beginning of one more permutation, up to what is left of the budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Exponents tried at once in a round of the bisection, and rounds: 8 bits each.
STEPS, ROUNDS = 256, 6
#: Documents of a source whose tokens are added up in one window; larger sources get more windows.
BUCKET_ROWS = 5_000


def token_count(text: Column) -> Column:
    """Words between white space; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_sizes(docs: DataFrame) -> DataFrame:
    return docs.groupBy(F.coalesce("source", F.lit("")).alias("mix_source")).agg(
        F.sum(token_count(F.col("text"))).alias("source_tokens"), F.count("*").alias("source_docs")
    )


def bisect_exponent(sizes: DataFrame, target_entropy: float, repetition_limit: float) -> float:
    """The largest exponent in 0..1 whose mixture meets either goal; 0 if none does.

    Each round tries 255 exponents between the bounds in one aggregate over the sources and keeps one of 256 parts.
    """
    sized = sizes.where("source_tokens > 0").select(F.ln(F.col("source_tokens").cast("double")).alias("log_size"))
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / STEPS
        tried = sized.select(
            "log_size", F.explode(F.sequence(F.lit(1), F.lit(STEPS - 1))).alias("at")
        ).withColumn("mass", F.exp(F.col("log_size") * (F.lit(low) + F.col("at") * F.lit(step))))
        exponent = F.lit(low) + F.col("at") * F.lit(step)
        total = F.sum("mass")
        met = (
            tried.groupBy("at")
            .agg(
                (F.ln(total) - F.sum(F.col("mass") * F.col("log_size")) * exponent / total).alias("entropy"),
                ((F.max("log_size") - F.min("log_size")) * (1 - exponent)).alias("log_repeats"),
                F.count("*").alias("sources"),
            )
            .where(
                (F.col("entropy") >= F.lit(target_entropy) * F.ln("sources"))
                | (F.col("log_repeats") >= F.ln(F.lit(repetition_limit)))
            )
            .agg(F.max("at"))
            .first()[0]
        ) or 0
        low, high = low + met * step, low + (met + 1) * step
    return low


def budgets(sizes: DataFrame, exponent: float) -> DataFrame:
    """Whole passes and what is left of the budget, for each source. The source that gains least is read once."""
    passes = F.exp((F.lit(exponent) - 1) * (F.ln(F.col("source_tokens").cast("double")) - F.col("log_largest")))
    budget = F.round(passes * F.col("source_tokens")).cast("long")
    largest = sizes.where("source_tokens > 0").agg(F.ln(F.max("source_tokens").cast("double")).alias("log_largest"))
    return (
        sizes.where("source_tokens > 0")
        .crossJoin(F.broadcast(largest))  # one row
        .select(
            "mix_source",
            "source_docs",
            F.greatest(F.lit(1), F.floor(budget / F.col("source_tokens"))).cast("long").alias("whole_blocks"),
            F.pmod(budget, "source_tokens").alias("left_tokens"),
        )
        .unionByName(
            sizes.where("source_tokens = 0").select(
                "mix_source", "source_docs", F.lit(1).cast("long").alias("whole_blocks"), F.lit(0).cast("long").alias("left_tokens")
            )
        )
    )


def place(seed: int, block: Column, doc_id: Column) -> Column:
    """A document's place in a block's permutation: rows in the order of this text are shuffled."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), block, F.coalesce(doc_id.cast("string"), F.lit("null"))))


def mix_sources(
    docs: DataFrame, *, target_entropy: float = 0.95, repetition_limit: float = 1.5, seed: int = 7
) -> DataFrame:
    """The documents, each as often as it is read, with ``mix_block`` (from 0) and ``mix_place`` (its place there).

    Sorted by the two, the rows are the order of training. ``target_entropy`` is a share of the entropy of equal weights;
    ``repetition_limit`` bounds how often a source is read against the one that is read least. A document of the last
    block is read if the tokens before it in the permutation don't fill what is left. Every document is read at least
    once, so none is lost.

    Tokens are words between white space. A null source counts as the source ''. Null and empty texts have no tokens;
    a source without tokens is read once. Repeated ids share a place; those of equal place are taken or left together.
    No documents: no rows. Other columns pass through; of the names ``mix_block`` and ``mix_place`` the new columns win.
    """
    columns = [c for c in docs.columns if c not in ("mix_block", "mix_place")]
    docs = docs.select(*columns)
    # Stored, so that Spark knows how small they are: it then sends them to the documents instead of shuffling both.
    scratch = Scratch(docs.sparkSession, "mixing")
    sizes = scratch.keep(source_sizes(docs), "sizes")
    plan = scratch.keep(budgets(sizes, bisect_exponent(sizes, target_entropy, repetition_limit)), "plan")
    own = F.struct(*[F.col(c) for c in columns]).alias("doc")
    read = docs.select(own).withColumn("mix_source", F.coalesce("doc.source", F.lit(""))).join(plan, "mix_source")
    whole = read.select("doc", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole_blocks") - 1)).alias("mix_block"))
    whole = whole.withColumn("mix_place", place(seed, F.col("mix_block"), F.col("doc.doc_id")))

    # Tokens before a document: of the buckets before its own, each an interval of places, and of its own bucket.
    buckets = F.ceil(F.col("source_docs") / BUCKET_ROWS)
    part = (
        read.where("left_tokens > 0")
        .withColumn("mix_block", F.col("whole_blocks"))
        .withColumn("mix_place", place(seed, F.col("mix_block"), F.col("doc.doc_id")))
        .withColumn("bucket", F.shiftright(F.conv(F.substring("mix_place", 1, 8), 16, 10).cast("long") * buckets, 32))
        .withColumn("tokens", token_count(F.col("doc.text")))
    )
    filled = part.groupBy("mix_source", "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    earlier = Window.partitionBy("mix_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    filled = filled.select("mix_source", "bucket", F.coalesce(F.sum("bucket_tokens").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("mix_source", "bucket").orderBy("mix_place")
    upto = F.sum("tokens").over(inside.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    peers = F.sum("tokens").over(Window.partitionBy("mix_source", "bucket", "mix_place"))
    part = (
        part.withColumn("upto", upto - peers)
        .join(filled, ["mix_source", "bucket"])
        .where(F.col("before") + F.col("upto") < F.col("left_tokens"))
    )
    both = whole.unionByName(part.select("doc", "mix_block", "mix_place"))
    return both.select(*[F.col("doc")[c].alias(c) for c in columns], "mix_block", "mix_place")
