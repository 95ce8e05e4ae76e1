"""Packing documents into sequences of a fixed number of tokens by minimum bin slack.

Documents are tokenized once and cut into pieces of a whole window plus a rest. How pieces go together depends on
lengths only, so the driver packs the counts of the at most ``window`` lengths: it takes the longest length left, finds
by subset-sum over a bitset the multiset of remaining lengths that fills the window closest, walks the bitsets back to
the counts of each length, and uses that pattern as often as the counts allow. Each use of a pattern ends a length or
nearly so, so the patterns are a few thousand whatever the number of documents.

Pieces then take the slots of their length by rank. Ranks come from counts by length and hash bucket, with as many
buckets as pieces in a bucket, so that a length which a third of all pieces share is split evenly.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

END_ID = 0
#: Letters up to here are Latin; texts with others, and those with longer words, use the tokenizer file.
LAST_LATIN, LONG_WORD = "ɏ", 1_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


class FastTokenizer:
    """The ids that the tokenizer file gives for a text, as little-endian unsigned 32-bit bytes.

    The ranks file holds the same vocabulary and gives the same ids in a third of the time. It takes the texts of Latin
    letters; others, where the two libraries' tables of letters might differ, texts with very long words and those that
    hold a special token go through the tokenizer file itself.
    """

    def __init__(self, tokenizer: str, ranks: str, pattern: str, special: tuple[str, ...]):
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer)
        with open(ranks, "rb") as lines:
            found = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.latin = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=found, special_tokens={})
        self.other = re.compile("|".join([f"[^\\x00-{LAST_LATIN}]", rf"\S{{{LONG_WORD}}}", *map(re.escape, special)]))

    def ids(self, text: str) -> bytes:
        if self.other.search(text):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.latin.encode_ordinary(text)
        return np.array(ids, dtype="<u4").tobytes()


_tokenizers: dict[str, FastTokenizer] = {}


def tokenizer_of(vocabulary: str) -> FastTokenizer:
    """One for each Python process. The files lie where the package of public tokenizers is installed."""
    if vocabulary not in _tokenizers:
        import public_tokenizers

        _tokenizers[vocabulary] = FastTokenizer(
            public_tokenizers.path(f"{vocabulary}.json"),
            public_tokenizers.path(f"{vocabulary}.tiktoken"),
            public_tokenizers.PATTERN,
            ("<|endoftext|>",),
        )
    return _tokenizers[vocabulary]


def cut_documents(docs: DataFrame, window: int, vocabulary: str) -> DataFrame:
    """Pieces of every document: whole windows, then the rest. Ends with id 0, so each document has one at least."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = tokenizer_of(vocabulary)
        end = np.array([END_ID], dtype="<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].array, batch["text"].array):
                ids = memoryview(tokenizer.ids(text) + end if isinstance(text, str) else end)
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[start * 4 : (start + window) * 4]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n))
            found = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield found.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(cut, PIECES)


@dataclass
class Slots:
    """Where the pieces of one length go: from ``rank`` on, ``each`` of them into every sequence from ``sequence`` on."""

    rank: list[int]
    each: list[int]
    sequence: list[int]
    offset: list[int]


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths and how many of each that fill ``room`` as far as the counts allow.

    Bit s of a bitset says that the lengths seen so far can add up to s. Frequent lengths come first, and the walk back
    takes a length only where the sum can't be had without it, so patterns use what there is most of.
    """
    target, full = 1 << room, (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((n for n in counts if n <= room), key=lambda n: (-counts[n], -n)):
        left, times = min(counts[length], room // length), 1
        while left:  # 1, 2, 4, ... pieces at once reach every number up to what is left
            times = min(times, left)
            steps.append((reach, length, times))
            reach |= (reach << (length * times)) & full
            left -= times
            times *= 2
        if reach & target:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, times in reversed(steps):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + times
            total -= length * times
    return used


def pack_lengths(counts: dict[int, int], window: int) -> dict[int, Slots]:
    left, slots, sequence, taken = dict(counts), {n: Slots([], [], [], []) for n in counts}, 0, dict.fromkeys(counts, 0)
    while left:
        longest = max(left)
        own = {n: c - (n == longest) for n, c in left.items() if c - (n == longest) > 0}
        pattern = closest_fill(own, window - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        uses, offset = min(left[n] // k for n, k in pattern.items()), 0
        for n, k in sorted(pattern.items(), reverse=True):
            s = slots[n]
            s.rank.append(taken[n])
            s.each.append(k)
            s.sequence.append(sequence)
            s.offset.append(offset)
            offset += n * k
            taken[n] += k * uses
            left[n] -= k * uses
            if not left[n]:
                del left[n]
        sequence += uses
    return slots


def rank_by_length(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Numbers the pieces of each length from 0, in about root-of-count buckets of about root-of-count pieces."""
    bucket = F.pmod(F.xxhash64("doc_id", "start"), F.ceil(F.sqrt("count"))).alias("bucket")
    # The counts have a row for each length, as many as the window at most.
    dealt = pieces.join(F.broadcast(counts), "length").select(*pieces.columns, bucket)
    filled = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    filled = filled.select("length", "bucket", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens"))
    return (
        dealt.withColumn("within", within)
        .join(filled, ["length", "bucket"])
        .select(*pieces.columns, (F.col("before") + F.col("within") - 1).alias("rank"))
    )


def pack_documents(docs: DataFrame, *, window: int = 1024, vocabulary: str = "byte_bpe_50k") -> DataFrame:
    """One row for each piece: where it lies in its document and in which sequence.

    A document's ids, with id 0 at its end, are cut at multiples of ``window``; every id lies in exactly one piece. A
    null or empty text is the end id alone. Repeated ids and repeated rows are packed like other documents. No
    documents: no rows. Columns other than ``doc_id`` and ``text`` are not read. ``vocabulary`` names the tokenizer.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = scratch.keep(cut_documents(docs, window, vocabulary), "pieces")
    counted = pieces.groupBy("length").agg(F.count("*").alias("count")).collect()  # at most ``window`` rows
    counts = {row["length"]: row["count"] for row in counted}
    slots = {n: [np.array(x) for x in (s.rank, s.each, s.sequence, s.offset)] for n, s in pack_lengths(counts, window).items()}
    ranked = rank_by_length(pieces, spark.createDataFrame(list(counts.items()), "length long, count long"))

    def seat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(batch), dtype=np.int64), np.zeros(len(batch), dtype=np.int64)
            for n in np.unique(lengths):
                first, each, begin, at = slots[int(n)]
                own = np.flatnonzero(lengths == n)
                which = np.searchsorted(first, ranks[own], side="right") - 1
                copy, place = np.divmod(ranks[own] - first[which], each[which])
                sequence[own] = begin[which] + copy
                offset[own] = at[which] + place * n
            yield batch.drop(columns="rank").assign(sequence_id=sequence, offset=offset).astype({"doc_id": "Int64"})

    return ranked.mapInPandas(seat, PACKED)
