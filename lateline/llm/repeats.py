"""Substring dedup by fixed-block anchors.

Every document's words are cut into non-overlapping blocks of half a window; any window of 20 words holds a whole block
of 10. These blocks are the index, and every run of 10 words at any position is a probe. A run that equals a block
elsewhere is an anchor. Windows around anchors are extended: those of equal word sequences are grouped, the first keeps
its words, and unions of consecutive repeated windows are the maximal repeats. A run without an anchor can't lie in a
repeat, so nothing is missed.

Documents are dealt into units by a hash of their id, once; three steps read that one shuffle. A unit sends each content
only once however often it holds it (a passage that a third of all documents share is one record for each unit), sorted
and delta-coded, to the bin of its hash; bins answer with one bit for each record. So neither a frequent passage nor a
large group of copies meets in one task, and no pairs are ever formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.storage import shuffle_partitions

WINDOW = 20
#: Text bytes that a unit is meant to hold.
UNIT_BYTES = 4 << 20
NO_ID = -(1 << 63)
ANSWER = "unit long, bin long, answer binary"
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_list(text: str | None) -> list[bytes]:
    """Words between white space of one byte, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").split() if isinstance(text, str) else []


def to_planes(values: np.ndarray, width: int) -> bytes:
    """Byte by byte: all lowest bytes, then the next; equal high bytes lie together and compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    n = len(data) // width
    whole = np.zeros((n, 8), dtype=np.uint8)
    whole[:, :width] = np.frombuffer(data, dtype=np.uint8).reshape(width, n).T
    return whole.reshape(-1).view("<u8")


class Unit:
    """The words of a unit's documents one after the other, documents by id: earlier windows come first."""

    def __init__(self, docs: pd.DataFrame, window: int, bins: int):
        self.docs = docs.sort_values("id", kind="stable").reset_index(drop=True)
        self.block, self.window, self.bins = window // 2, window, np.uint64(bins)
        lists = [word_list(text) for text in self.docs["text"].array]
        self.sizes = np.array([len(words) for words in lists], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.words = np.array([word for words in lists for word in words] or [b""], dtype=object)[: self.starts[-1]]
        self.left = np.repeat(self.starts[1:], self.sizes) - np.arange(self.starts[-1])  # words from here to the end
        ids = self.docs["id"].to_numpy()
        self.ids = np.repeat(ids, self.sizes)
        hashes = mixed(pd.util.hash_array(self.words, categorize=False)) if len(self.words) else np.zeros(0, np.uint64)
        self.runs = self._rolled(hashes, self.block)

    @staticmethod
    def _rolled(hashes: np.ndarray, n: int) -> np.ndarray:
        total = np.zeros(max(len(hashes) - n + 1, 0), dtype=np.uint64)
        for i in range(n):
            total = total * BASE + hashes[i : i + len(total)]
        return total

    def bin_of(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(32)) * self.bins) >> np.uint64(32)

    def anchors(self):
        """Distinct contents of runs: bins, values, whether it is a block here, whether it is here twice; and all runs'
        positions and which content each has."""
        at = np.flatnonzero((self.left[: len(self.runs)] >= self.block) & (np.repeat(self.sizes, self.sizes)[: len(self.runs)] >= self.window))
        h, of, times = np.unique(mixed(self.runs[at]), return_inverse=True, return_counts=True)
        offset = at - np.repeat(self.starts[:-1], self.sizes)[at]
        block = np.zeros(len(h), dtype=bool)
        block[of[offset % self.block == 0]] = True
        return h, block, times > 1, at, of

    def windows(self, candidates: np.ndarray):
        """Distinct contents of candidate windows and the first position of each, and which content each has."""
        power = np.uint64(pow(int(BASE), self.block, 1 << 64))
        h = mixed(self.runs[candidates] * power + self.runs[candidates + self.block])
        return np.unique(h, return_index=True, return_inverse=True)


def _binned(unit: Unit, h: np.ndarray):
    """Slices of the sorted contents, one for each bin: bins grow with the hash."""
    bins = unit.bin_of(h)
    ends = np.concatenate([np.flatnonzero(np.diff(bins.astype(np.int64))) + 1, [len(h)]]) if len(h) else []
    begin = 0
    for end in ends:
        yield int(bins[begin]), begin, int(end)
        begin = end


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(bits: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n).astype(bool)


def remove_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of ``window`` words covers it whose word sequence also starts earlier: in a document of a
    smaller id, or before in the same one. Windows are judged on the input. ``window`` is even.

    Words are what stands between ASCII white space, unchanged. A null or empty text has none and keeps ''; a text of
    fewer words than a window keeps all. A null id counts as smaller than all others. Rows of the same id are the same
    document: their windows at equal starts are not earlier than one another. No documents: no rows. Columns other than
    ``doc_id`` and ``text`` are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bins = 2 * shuffle_partitions(docs.sparkSession)
    units = max(shuffle_partitions(docs.sparkSession), -(-size // UNIT_BYTES))
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    dealt = docs.select(ident.alias("id"), "text").withColumn("unit", F.pmod(F.xxhash64("id"), F.lit(units)))

    def send_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        unit = Unit(pdf, window, bins)
        h, block, twice, _, _ = unit.anchors()
        low = h & np.uint64(0xFFFFFFFF)
        rows = []
        for b, i, j in _binned(unit, h):
            order = np.argsort(low[i:j])
            deltas = np.diff(low[i:j][order], prepend=np.uint64(0))
            rows.append((b, pdf["unit"].iloc[0], to_planes(deltas, 4), _bits(block[i:j][order]), _bits(twice[i:j][order])))
        return pd.DataFrame(rows, columns=["bin", "unit", "values", "block", "twice"])

    def match_runs(pdf: pd.DataFrame) -> pd.DataFrame:
        values = [np.cumsum(from_planes(v, 4)) for v in pdf["values"]]
        sizes = [len(v) for v in values]
        block = np.concatenate([_flags(b, n) for b, n in zip(pdf["block"], sizes)])
        times = 1 + np.concatenate([_flags(b, n) for b, n in zip(pdf["twice"], sizes)]).astype(np.int64)
        _, of = np.unique(np.concatenate(values), return_inverse=True)
        shared = (np.bincount(of, times) > 1) & (np.bincount(of, block) > 0)
        found = np.split(shared[of], np.cumsum(sizes)[:-1])
        rows = [(u, b, _bits(f)) for u, b, f in zip(pdf["unit"], pdf["bin"], found) if f.any()]
        return pd.DataFrame(rows, columns=["unit", "bin", "answer"])

    def candidates_of(unit: Unit, answers: dict[int, bytes]) -> np.ndarray:
        """Starts of the windows that hold an anchor."""
        h, _, _, at, of = unit.anchors()
        low, shared = h & np.uint64(0xFFFFFFFF), np.zeros(len(h), dtype=bool)
        for b, i, j in _binned(unit, h):
            if b in answers:
                shared[i + np.argsort(low[i:j])] = _flags(answers[b], j - i)
        anchor = np.zeros(len(unit.words) + window + 1, dtype=np.int64)
        anchor[at[shared[of]] + 1] = 1
        before = np.cumsum(anchor)
        start = np.flatnonzero(unit.left >= window)
        return start[before[start + unit.block + 1] > before[start]]

    def send_windows(docs_of: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(docs_of) and len(answers):
            unit, number = Unit(docs_of, window, bins), docs_of["unit"].iloc[0]
            candidates = candidates_of(unit, dict(zip(answers["bin"], answers["answer"])))
            h, first, _ = unit.windows(candidates)
            ids = (unit.ids[candidates[first]] ^ np.int64(NO_ID)).view(np.uint64) if len(h) else h
            for b, i, j in _binned(unit, h):
                rows.append((b, number, to_planes(np.diff(h[i:j], prepend=np.uint64(0)), 8), to_planes(ids[i:j], 8)))
            chosen = np.zeros(len(unit.words), dtype=bool)
            chosen[candidates] = True
            if rows:  # passes through the bin, back to the unit
                rows.append((rows[0][0], number, None, _bits(chosen)))
        return pd.DataFrame(rows, columns=["bin", "unit", "values", "ids"])

    def match_windows(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["values"].isna()]
        rows = [(u, -1, d) for u, d in zip(own["unit"], own["ids"])]
        pdf = pdf[pdf["values"].notna()]
        values = [np.cumsum(from_planes(v, 8)) for v in pdf["values"]]
        ids = np.concatenate([from_planes(v, 8) for v in pdf["ids"]])
        _, of = np.unique(np.concatenate(values), return_inverse=True)
        order = np.lexsort((ids, of))
        begins = np.flatnonzero(np.diff(of[order], prepend=-1))
        least = ids[order][begins]
        later = np.split(ids > least[of], np.cumsum([len(v) for v in values])[:-1])
        rows += [(u, b, _bits(x)) for u, b, x in zip(pdf["unit"], pdf["bin"], later) if x.any()]
        return pd.DataFrame(rows, columns=["unit", "bin", "answer"])

    def keep_rest(docs_of: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        unit = Unit(docs_of, window, bins)
        gone = np.zeros(len(unit.words) + 1, dtype=np.int64)
        answers = dict(zip(answers["bin"], answers["answer"]))
        if -1 in answers:
            candidates = np.flatnonzero(_flags(answers[-1], len(unit.words)))
            h, first, of = unit.windows(candidates)
            later = np.zeros(len(h), dtype=bool)
            for b, i, j in _binned(unit, h):
                if b in answers:
                    later[i:j] = _flags(answers[b], j - i)
            # Not the first of the unit, by id and by start within the document: rows of one id are one document.
            at, head = candidates, candidates[first][of]
            start = np.repeat(unit.starts[:-1], unit.sizes)
            earlier = (unit.ids[head] < unit.ids[at]) | (head - start[head] < at - start[at])
            repeated = at[later[of] | earlier]
            np.add.at(gone, repeated, 1)
            np.add.at(gone, repeated + window, -1)
        kept = np.cumsum(gone)[:-1] == 0
        rows = []
        for ident, begin, end in zip(unit.docs["id"], unit.starts[:-1], unit.starts[1:]):
            stays = kept[begin:end]
            text = b" ".join(unit.words[begin:end][stays]).decode("utf-8", "surrogatepass")
            rows.append((ident, end - begin, (end - begin) - int(stays.sum()), text))
        return pd.DataFrame(rows, columns=["id", "n_words", "n_removed", "kept"])

    by_unit = dealt.groupBy("unit")
    anchors = (
        by_unit.applyInPandas(send_runs, "bin long, unit long, values binary, block binary, twice binary")
        .groupBy("bin").applyInPandas(match_runs, ANSWER)
    )
    repeats = (
        by_unit.cogroup(anchors.groupBy("unit"))
        .applyInPandas(send_windows, "bin long, unit long, values binary, ids binary")
        .groupBy("bin").applyInPandas(match_windows, ANSWER)
    )
    rest = by_unit.cogroup(repeats.groupBy("unit")).applyInPandas(keep_rest, "id long, n_words long, n_removed long, kept string")
    return rest.select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), "n_words", "n_removed", "kept")
