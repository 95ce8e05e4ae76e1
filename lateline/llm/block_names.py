"""Exact duplicates by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes. The different blocks of the corpus are sorted and
numbered; equal blocks have equal names and different blocks different ones. Then the names of neighbouring pairs are
sorted and numbered in the same way, round by round, until each document has a single name: its identity. No step
compares by hash alone: blocks travel to their names under a 128-bit key, and after the sort over the blocks themselves
it is checked that no two of them share a key; if two did, all keys would be made anew from another seed.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch
from lateline.workspace import sized_shuffles

#: The characters that don't count: the space and the controls from tab to carriage return.
WHITE = " \t\n\x0b\f\r"

BLOCK_BYTES = 4096


def wide_key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("h"), F.xxhash64(F.lit(2 * seed + 1), block).alias("g"))


def _numbered(distinct: DataFrame, *sort_by: str) -> DataFrame:
    """Numbers rows that differ: each partition is sorted and counted through, beyond those of the partitions before."""
    return distinct.sortWithinPartitions(*sort_by).withColumn("name", F.monotonically_increasing_id())


def _blocks(data: Column, block_bytes: int, made: Callable[[Column], Column]) -> Column:
    last = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / block_bytes)).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: made(F.substring(data, i * block_bytes + 1, F.lit(block_bytes))))


def name_documents(
    docs: DataFrame, *, block_bytes: int = BLOCK_BYTES, key: Callable[[Column, int], Column] = wide_key, seeds: int = 4
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, text_sha256, level and name (the identity of its text),
    keep_id, group_size and kept.

    Texts are equal if they are without ``WHITE``; a null text is an empty one. Of equal texts the row with the most
    code points in its whole text stays, of these the one of the smallest doc_id (null after all others), and of rows
    equal in that too exactly one. ``keep_id`` is its doc_id. ``text_sha256`` is that of the normalised text in UTF-8.

    Repeated ids and repeated rows count as rows of their own. No documents: no rows. Other columns than ``doc_id`` and
    ``text`` are not read. ``key`` carries blocks to their names; it may be weak, as names that it confuses are
    noticed, but after ``seeds`` attempts an error says so.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "block-names")
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.translate(text, WHITE, "")
    texts = docs.select(F.col("doc_id"), F.length(text).cast("long").alias("n_chars"), plain.alias("plain"))
    data = texts.withColumn("data", F.col("plain").cast("binary"))

    for seed in range(seeds):
        heads = data.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "n_chars",
            F.sha2("data", 256).alias("text_sha256"),
            F.octet_length("data").cast("long").alias("n_bytes"),
            _blocks(F.col("data"), block_bytes, lambda b: key(b, seed)).alias("keys"),
        )
        heads = scratch.keep(heads, f"heads-{seed}")
        size, longest = heads.agg(F.sum("n_bytes"), F.max(F.size("keys"))).first()
        with sized_shuffles(spark, size or 0):
            blocks = data.select(
                F.explode(_blocks(F.col("data"), block_bytes, lambda b: F.struct(key(b, seed).alias("key"), b.alias("block")))).alias("b")
            )
            names = _numbered(blocks.select("b.key", "b.block").distinct(), "block").select("key", "name")
            names = scratch.keep(names, f"names-0-{seed}")
            if names.groupBy("key").count().where("count > 1").isEmpty():
                return _identified(heads.drop("n_bytes"), names, longest or 0, scratch)
    raise RuntimeError(f"different blocks share a key with each of {seeds} seeds")


def _identified(heads: DataFrame, names: DataFrame, longest: int, scratch: Scratch) -> DataFrame:
    placed = heads.select("row", F.size("keys").alias("left"), F.posexplode("keys").alias("place", "key"))
    level = 0
    now = scratch.keep(placed.join(names, "key").select("row", "left", "place", "name"), "level-0")
    done = [now.where("left = 1").select("row", F.lit(0).alias("level"), "name")]
    while longest > 1:
        level, longest = level + 1, -(-longest // 2)
        half = F.expr("place div 2").cast("int")
        pairs = now.where("left > 1").groupBy("row", half.alias("place")).agg(
            F.max(F.expr("if(place % 2 = 0, name, null)")).alias("a"),
            F.coalesce(F.max(F.expr("if(place % 2 = 1, name, null)")), F.lit(-1)).alias("b"),  # the last one may stand alone
            F.max(F.expr("(left + 1) div 2").cast("int")).alias("left"),
        )
        names = scratch.keep(_numbered(pairs.select("a", "b").distinct(), "a", "b"), f"names-{level}")
        now = scratch.keep(pairs.join(names, ["a", "b"]).select("row", "left", "place", "name"), f"level-{level}")
        done.append(now.where("left = 1").select("row", F.lit(level).alias("level"), "name"))
    identities = done[0]
    for more in done[1:]:
        identities = identities.union(more)
    named = scratch.keep(heads.drop("keys").join(identities, "row"), "identities")
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
    groups = named.groupBy("level", "name").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    # Stored, so that the join below has a stage of its own, in which the adaptive plan can split a large group.
    groups = scratch.keep(groups.select("level", "name", "group_size", "best.keep_id", "best.keep_row"), "best")
    return scratch.keep(
        named.join(groups, ["level", "name"]).select(
            "doc_id", "n_chars", "text_sha256", "level", "name", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
        ),
        "groups",
    )
