"""MinHash near-dedup with an LSH forest.

Every document's set of word shingles gets a signature of minimum hashes; documents of equal sets are folded into one
text from there on. The signature is cut into trees, each an order of the texts by its own few hash values and then by
the rest of the signature. Texts that agree in the own values of a tree form a region of it; in the sorted
order the neighbour with the longest common prefix stands next to a text.

Candidates come in three steps, each seeing only what the one before left open:

1. neighbours in the first trees, which link most of a dense region whatever its size;
2. neighbours in all other trees that lie in different components so far;
3. texts of different components in a region. A region that is one component by now has none. In the others longer
   sketches are compared, block by block, and only pairs that these don't rule out go on. This step makes the search
   exact at its depth up to the sketches' error: there is no cap, and a pair at a threshold of 0.85 shares none of 24
   regions of depth 5 with a probability of 1e-6 (at 0.8, none of 24 of depth 4 with 3e-6), or is ruled out by its
   sketches with one of 3e-6.

The nodes of all this are the different sets, numbered; documents, whatever their ids, are mapped to them and back.
Depth is the same in all regions: no prefix lengths are computed, and a dense region is opened block by block.

Every candidate is confirmed on the full sets, made again from the texts. Texts move once: those that stand in a region
with another one are stored by themselves, and the rest are never looked at again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.components import merged
from lateline.llm.repeats import BASE, mixed
from lateline.llm.storage import Scratch

SHINGLE = 5
TREES, DEPTH, FIRST_TREES = 24, 5, 3
#: Chance to accept that a pair at the threshold shares no region.
MISSED = 1e-5
#: Hash functions of a sketch, one byte each, and how many standard deviations below the threshold still count.
SKETCH, DEVIATIONS = 480, 4.5
#: Texts of a region that are compared with as many others in one task, and pairs looked at together.
BLOCK, PAIRS = 512, 8_192
#: Shingles hashed together: their values stay in a core's cache.
CACHED = 128
NO_ID = (1 << 63) - 1  # a null id counts as the largest
SEEDS = np.random.default_rng(20_240_501).integers(1, 1 << 63, size=(2, TREES * DEPTH), dtype=np.uint64) | np.uint64(1)
SKETCH_SEEDS = np.random.default_rng(7_112_023).integers(1, 1 << 63, size=(2, SKETCH), dtype=np.uint64) | np.uint64(1)


@dataclass(frozen=True)
class Threshold:
    """All that follows from the share of their union that two linked sets have in common, ``over`` / ``under``."""

    over: int
    under: int
    depth: int
    agree: int

    @classmethod
    def of(cls, similarity: float) -> Threshold:
        if not 0 < similarity <= 1:
            raise ValueError(f"similarity {similarity} is not above 0 and at most 1")
        share = Fraction(str(similarity))
        fitting = [d for d in range(1, DEPTH + 1) if (1 - similarity**d) ** TREES <= MISSED]
        if not fitting:
            raise ValueError(f"{TREES} trees miss too many pairs of similarity {similarity}")
        same = similarity + (1 - similarity) / 256  # bytes also agree by chance
        agree = round(SKETCH * same - DEVIATIONS * math.sqrt(SKETCH * same * (1 - same)))
        return cls(share.numerator, share.denominator, fitting[-1], agree)


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of the distinct shingles: of five words, or of the whole sequence if there are fewer."""
    # Lower-casing bytes changes A-Z only, and leaves those of longer characters alone.
    words = text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = mixed(pd.util.hash_array(np.array(words, dtype=object), categorize=False))
    size = min(SHINGLE, len(h))
    total = np.full(len(h) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total = total * BASE + h[i : i + len(total)]
    return np.unique(mixed(total))


def signature(shingles: np.ndarray, seeds: np.ndarray = SEEDS) -> np.ndarray:
    """The least value of each hash function over a set that isn't empty, its upper 32 bits."""
    least = np.full(seeds.shape[1], np.iinfo(np.uint64).max, dtype=np.uint64)
    values = np.empty((min(len(shingles), CACHED), seeds.shape[1]), dtype=np.uint64)
    for begin in range(0, len(shingles), CACHED):
        part = shingles[begin : begin + CACHED]
        now = np.bitwise_xor(part[:, None], seeds[0], out=values[: len(part)])
        np.minimum(least, np.multiply(now, seeds[1], out=now).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def text_md5(text: Column) -> Column:
    """What tells rows of one id apart."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def profiles(docs: DataFrame, depth: int) -> DataFrame:
    """Size, identity and tree keys of each row's set: id, text_md5, n_shingles, set_key, trees (a region and what
    orders the texts in it, for each tree)."""

    def profiled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for ident, md5, text in zip(batch["id"], batch["text_md5"], batch["text"].array):
                s = shingle_set(text)
                if len(s):
                    flat = signature(s, SEEDS[:, : TREES * depth])
                    values = flat.reshape(TREES, depth)
                    digests = [hashlib.blake2b(v.tobytes(), digest_size=8, salt=bytes([t])).digest() for t, v in enumerate(values)]
                    regions = np.frombuffer(b"".join(digests), dtype="<i8")
                    # Below its own values each tree is ordered by the next tree's, the deeper levels of the forest.
                    deeper = [np.roll(flat, -depth - k)[::depth].astype(np.int64) for k in (0, 1)]
                    rest = deeper[0] << 31 | deeper[1] >> 1
                    rows.append((ident, md5, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), regions, rest))
                else:
                    rows.append((ident, md5, 0, None, [], []))
            yield pd.DataFrame(rows, columns=["id", "text_md5", "n_shingles", "set_key", "regions", "deeper"])

    schema = "id long, text_md5 string, n_shingles long, set_key binary, regions array<long>, deeper array<long>"
    return docs.mapInPandas(profiled, schema)


def neighbours(forest: DataFrame) -> DataFrame:
    """Texts that stand next to each other in a tree and lie in one region: tree, region, a, b and the sizes of their sets.

    Range partitions cut the sorted order, so no region, however large, meets in one task. The regions at either end of
    a partition, which may go on beyond it, get a row with the same text as a and b.
    """

    def next_to(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None
        names = ["tree", "region", "a", "b", "a_size", "b_size"]
        for batch in batches:
            if not len(batch):
                continue
            if last is None:
                yield batch.iloc[:1][["tree", "region", "id", "id", "n_shingles", "n_shingles"]].set_axis(names, axis=1)
            else:
                batch = pd.concat([last, batch], ignore_index=True)
            tree, region, ident, size = (batch[c].to_numpy() for c in ("tree", "region", "id", "n_shingles"))
            at = np.flatnonzero((tree[1:] == tree[:-1]) & (region[1:] == region[:-1]))
            columns = (tree[at], region[at], ident[at], ident[at + 1], size[at], size[at + 1])
            yield pd.DataFrame(dict(zip(names, columns)))
            last = batch.iloc[-1:]
        if last is not None:
            yield last[["tree", "region", "id", "id", "n_shingles", "n_shingles"]].set_axis(names, axis=1)

    order = ["tree", "region", "deeper", "id"]
    schema = "tree int, region long, a long, b long, a_size long, b_size long"
    return forest.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(next_to, schema)


def may_link(a: Column, b: Column, threshold: Threshold) -> Column:
    """Sets of these sizes can reach the threshold."""
    return F.least(a, b) * threshold.under >= F.greatest(a, b) * threshold.over


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def apart(adjacent: DataFrame, found: DataFrame) -> DataFrame:
    """Neighbours that lie in different components so far."""
    for end in ("a", "b"):
        known = found.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
        adjacent = adjacent.join(known, end, "left").withColumn(f"{end}_component", F.coalesce(f"{end}_component", end))
    return adjacent.where("a_component <> b_component")


def sketches(texts: DataFrame) -> DataFrame:
    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [signature(shingle_set(t), SKETCH_SEEDS).astype(np.uint8).tobytes() for t in batch["text"].array]
            yield pd.DataFrame({"id": batch["id"], "sketch": rows})

    return texts.mapInPandas(sketched, "id long, sketch binary")


def across_components(members: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs of different components in a region whose sizes and sketches don't rule a link out.

    ``members``: tree, region, region_size, id, component, n_shingles, regions, sketch. A region is dealt into blocks, and
    each two blocks meet in one task. A pair is looked at in the first tree where it shares a region; that region is open
    like all others it shares, since it holds two components.
    """
    blocks = F.ceil(F.col("region_size") / BLOCK)
    own = F.pmod(F.xxhash64("id"), blocks)
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.select(
        F.xxhash64("tree", "region", F.least("own", "other"), F.greatest("own", "other")).alias("meeting"),
        (F.col("own") > F.col("other")).alias("second"), (F.col("own") == F.col("other")).alias("alone"),
        "tree", "id", "component", "n_shingles", "regions", "sketch",
    )

    def looked_at(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        """Pairs of whole meetings, small meetings together."""
        if not len(rows):
            return
        ids, tree, component, size = (rows[c].to_numpy() for c in ("id", "tree", "component", "n_shingles"))
        sketch = np.frombuffer(b"".join(rows["sketch"]), dtype=np.uint8).reshape(len(rows), SKETCH)
        regions, meeting = np.stack(rows["regions"].to_numpy()), rows["meeting"].to_numpy()
        alone, second = rows["alone"].to_numpy(), rows["second"].to_numpy()

        def left(one: np.ndarray, other: np.ndarray) -> Iterator[pd.DataFrame]:
            for begin in range(0, len(one), PAIRS):
                a, b = one[begin : begin + PAIRS], other[begin : begin + PAIRS]
                here = (regions[a] == regions[b]).argmax(axis=1) == tree[a]
                a, b = a[here], b[here]
                alike = (sketch[a] == sketch[b]).sum(axis=1) >= threshold.agree
                a, b = ids[a[alike]], ids[b[alike]]
                yield pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})

        waiting, n = [], 0
        for begin, end in pairwise(np.flatnonzero(np.concatenate([[True], meeting[1:] != meeting[:-1], [True]]))):
            if alone[begin]:
                a, b = np.triu_indices(end - begin, 1)
            else:
                latter = np.flatnonzero(second[begin:end])
                former = np.flatnonzero(~second[begin:end])
                a, b = np.repeat(former, len(latter)), np.tile(latter, len(former))
            a, b = a + begin, b + begin
            near = threshold.under * np.minimum(size[a], size[b]) >= threshold.over * np.maximum(size[a], size[b])
            fit = (component[a] != component[b]) & near
            waiting.append((a[fit], b[fit]))
            n += len(waiting[-1][0])
            if n >= PAIRS:
                yield from left(*map(np.concatenate, zip(*waiting)))
                waiting, n = [], 0
        if n:
            yield from left(*map(np.concatenate, zip(*waiting)))

    def compared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last meeting of a batch may go on in the next one
        for batch in batches:
            if len(batch):
                batch = batch if held is None else pd.concat([held, batch], ignore_index=True)
                last = int(np.searchsorted(batch["meeting"].to_numpy(), batch["meeting"].iloc[-1]))
                yield from looked_at(batch.iloc[:last])
                held = batch.iloc[last:]
        if held is not None:
            yield from looked_at(held)

    return dealt.repartition("meeting").sortWithinPartitions("meeting").mapInPandas(compared, "a long, b long").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, np.ndarray] = {}

        def set_of(ident: int, text: str) -> np.ndarray:
            if ident not in known:
                if len(known) >= 2_000:
                    known.clear()
                known[ident] = shingle_set(text)
            return known[ident]

        for batch in batches:
            holds = []
            for a, b, one, other in zip(batch["a"], batch["b"], batch["text"], batch["other_text"]):
                x, y = set_of(a, one), set_of(b, other)
                both = len(np.intersect1d(x, y, assume_unique=True))
                holds.append(threshold.under * both >= threshold.over * (len(x) + len(y) - both))
            yield batch.loc[np.array(holds, dtype=bool), ["a", "b"]]

    joined = pairs.join(texts.withColumnRenamed("id", "a"), "a").join(
        texts.select(F.col("id").alias("b"), F.col("text").alias("other_text")), "b"
    )
    return joined.select("a", "b", "text", "other_text").mapInPandas(linked, "a long, b long")


def link_documents(docs: DataFrame, *, similarity: float = 0.85) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id, kept, set_id (the smallest id of an equal
    set), text_md5, and ``first``: whether the row stands for its component.

    Two documents are linked if their sets of word shingles (words lower-cased in A-Z) overlap in at least the share
    ``similarity`` of their union; a component holds all that links reach and is named by its smallest id, whose document is kept.

    A null or empty text, or one without words, has an empty set, links with nothing and is kept. A null id counts as
    the largest and is returned as null; a component without any other has the component null. Rows of the same id are
    documents of their own: each links by its own text, and so may be in different components. Of the rows of a
    component the one of the smallest id, then of the smallest hash of its text, is its ``first``, and so is every row
    of the same id and text. No documents: no rows. Columns other than ``doc_id`` and ``text`` are not read.
    """
    threshold = Threshold.of(similarity)
    scratch = Scratch(docs.sparkSession, "minhash")
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), "text", text_md5(F.col("text")).alias("text_md5"))
    profiled = scratch.keep(profiles(docs, threshold.depth), "profiles")
    # One node for each set, and the row that stands for it.
    texts = profiled.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.struct("id", "text_md5")).alias("row"), F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("regions").alias("regions"), F.any_value("deeper").alias("deeper"),
    )
    texts = scratch.keep(texts.withColumn("id", F.monotonically_increasing_id()), "texts")

    trees = F.posexplode(F.arrays_zip(F.col("regions").alias("region"), F.col("deeper").alias("deeper"))).alias("tree", "place")
    forest = texts.select("id", "n_shingles", trees).select("id", "n_shingles", "tree", "place.region", "place.deeper")
    adjacent = scratch.keep(neighbours(forest), "neighbours")
    close = adjacent.where((F.col("a") != F.col("b")) & may_link(F.col("a_size"), F.col("b_size"), threshold))
    ends = adjacent.where("a <> b").select(F.col("a").alias("id")).union(adjacent.where("a <> b").select("b")).distinct()
    # Regions cut by a partition have an end that may stand beside a text beyond it.
    ends = ends.union(adjacent.where("a = b").select("a")).distinct()
    wanted = texts.join(ends, "id", "left_semi").select(F.col("id").alias("node"), "row.id", "row.text_md5")
    stored = docs.join(wanted, ["id", "text_md5"]).select(F.col("node").alias("id"), "text").dropDuplicates(["id"])
    stored = scratch.keep(stored, "candidates")

    def joined(found: DataFrame, pairs: DataFrame, name: str) -> DataFrame:
        pairs = scratch.keep(pairs, f"{name}-pairs")
        return merged(found, scratch.keep(confirmed(pairs, stored, threshold), f"{name}-links"), scratch, name)

    found = docs.sparkSession.createDataFrame([], "node long, component long")
    first = ordered(close.where(F.col("tree") < FIRST_TREES))
    found = joined(found, first, "first")
    found = joined(found, ordered(apart(close, found)).exceptAll(first), "more")
    open_regions = apart(adjacent, found).select("tree", "region").union(adjacent.where("a = b").select("tree", "region"))
    open_regions = scratch.keep(open_regions.distinct(), "open")
    members = forest.join(open_regions, ["tree", "region"]).select("tree", "region", "id", "n_shingles")
    members = scratch.keep(members, "members")
    sizes = members.groupBy("tree", "region").agg(F.count("*").alias("region_size")).where("region_size > 1")
    known = found.select(F.col("node").alias("id"), "component")
    in_open = members.join(sizes, ["tree", "region"])
    ids = members.select("id").distinct()
    sketched = sketches(stored.join(ids, "id", "left_semi")).join(texts.select("id", "regions"), "id")
    sketched = scratch.keep(sketched, "sketches")
    whole = in_open.join(sketched, "id").join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    found = joined(found, across_components(whole, threshold), "across")

    nodes = texts.select("set_key", "row", F.col("id").alias("node")).join(found, "node", "left")
    nodes = scratch.keep(nodes.withColumn("component", F.coalesce("component", "node")), "nodes")
    firsts = nodes.groupBy("component").agg(F.min("row").alias("first_row"))
    sets = scratch.keep(nodes.join(firsts, "component").select("set_key", "row", "first_row"), "sets")
    # A text without words is a component of its own.
    own = F.struct("id", "text_md5")
    reached = profiled.select("id", "text_md5", "n_shingles", "set_key").join(sets, "set_key", "left")
    reached = reached.withColumns({"row": F.coalesce("row", own), "first_row": F.coalesce("first_row", own)})
    null_if_none = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return reached.select(
        null_if_none("id").alias("doc_id"),
        "n_shingles",
        null_if_none("first_row.id").alias("component_id"),
        (F.col("id") == F.col("first_row.id")).alias("kept"),
        null_if_none("row.id").alias("set_id"),
        "text_md5",
        (own == F.col("first_row")).alias("first"),
    )
