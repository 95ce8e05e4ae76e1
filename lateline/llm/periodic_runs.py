"""Periodic runs of words, found by longest common extensions over difference-cover samples.

A document's words become numbers, a separator of its own follows it, and many documents make one array. Of the suffixes
only those are sorted that begin at positions in a difference cover modulo 31, six in 31. The extension of two positions
compares words until both stand on samples, at most 30 words on; from there it is a range minimum over the common
prefixes of neighbouring samples, from a sparse table.

Runs come from a harmonic grid: one of four periods or more holds three periods of starts whose word recurs a period
later, so for every period p it's enough to look at each 3p-th position and extend it to both sides.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A perfect difference set: every difference modulo 31 is one of two of its members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)

#: A run holds its period so many times, and has so many words, at least.
LEAST_EXPONENT, LEAST_WORDS = 4, 6

#: Words of documents that are searched as one array; a longer document is an array of its own. Grid points at a time.
ARRAY_WORDS, GRID_POINTS = 400_000, 4_000_000

COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


@lru_cache(maxsize=1)
def _shifts() -> np.ndarray:
    """How far on two positions stand on samples both, by their remainders."""
    member = np.zeros(MODULUS, dtype=bool)
    member[list(COVER)] = True
    on = np.array([np.roll(member, -d) for d in range(MODULUS)])
    return np.argmax(on[:, :, None] & on[:, None, :], axis=0)


class Extensions:
    """Longest common extensions to the right between positions of an array in which every comparison ends at a value
    that occurs once."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.values = np.concatenate([values, np.full(2 * MODULUS + 2, -1)]).astype(np.int64)
        starts = np.arange(n)
        cover = np.zeros(MODULUS, dtype=bool)
        cover[list(COVER)] = True
        self.samples = starts[cover[starts % MODULUS]]
        self.number = np.full(n + MODULUS, -1)
        self.number[self.samples] = np.arange(len(self.samples))
        rank, steps = self._sort(n)
        order = np.argsort(rank)
        self.rank = rank
        self.table = self._sparse(self._neighbours(order, steps))

    def _sort(self, n: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
        """The samples' ranks; and for each round the distance that its equal ranks vouch for, and the ranks.

        Only samples that share their rank with others are sorted on. Two words at a time for the first 32, then by
        the ranks of the samples as many words on.
        """
        rank, steps = np.zeros(len(self.samples), dtype=np.int64), []
        tied = np.arange(len(self.samples))

        def refine(key: np.ndarray) -> np.ndarray:
            order = np.lexsort((key, rank[tied]))
            group, key = rank[tied][order], key[order]
            fresh = np.ones(len(order), dtype=bool)
            fresh[1:] = (np.diff(group) != 0) | (np.diff(key) != 0)
            opens = np.ones(len(order), dtype=bool)
            opens[1:] = np.diff(group) != 0
            at = np.arange(len(order))
            # Ranks are places in the sorted order: that of the group, and how many of it are less.
            lead = np.maximum.accumulate(np.where(opens, at, 0))
            first = np.maximum.accumulate(np.where(fresh, at, 0))
            moved = group + first - lead
            rank[tied[order]] = moved
            sizes = np.diff(np.append(np.flatnonzero(fresh), len(order)))
            return np.sort(tied[order][np.repeat(sizes > 1, sizes)])

        for t in range(0, MODULUS + 1, 2):
            if len(tied):
                at = np.minimum(self.samples[tied] + t, n)
                tied = refine((self.values[at] + 1) << 32 | (self.values[at + 1] + 1))
        steps.append((MODULUS, rank.copy()))
        far = MODULUS
        while len(tied):
            at = self.samples[tied] + far
            inside = at < n
            key = np.full(len(tied), -1)
            key[inside] = steps[-1][1][self.number[at[inside]]]
            tied = refine(key)
            far *= 2
            steps.append((far, rank.copy()))
        return rank, steps

    def _neighbours(self, order: np.ndarray, steps: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """Words that each sample has in common with the next one of the sorted order."""
        n = len(self.values) - (2 * MODULUS + 2)
        left, right = self.samples[order[:-1]], self.samples[order[1:]]
        common = np.zeros(len(left), dtype=np.int64)
        for far, rank in reversed(steps):
            a, b = left + common, right + common
            inside = np.maximum(a, b) < n
            a, b = np.where(inside, a, self.samples[0]), np.where(inside, b, self.samples[0])
            common += np.where(inside & (rank[self.number[a]] == rank[self.number[b]]), far, 0)
        return common + self._words(left + common, right + common, np.full(len(left), MODULUS + 1))

    def _words(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words in common, compared one by one, up to ``most`` of them."""
        common, active = np.zeros(len(a), dtype=np.int64), np.arange(len(a))
        for t in range(int(most.max(initial=0))):
            active = active[most[active] > t]
            active = active[self.values[a[active] + t] == self.values[b[active] + t]]
            if not len(active):
                break
            common[active] += 1
        return common

    @staticmethod
    def _sparse(common: np.ndarray) -> list[np.ndarray]:
        """Minima over 1, 2, 4, ... neighbours from each place on."""
        table = [common]
        while 2 * len(table[0]) >= 1 << (len(table) + 1):
            half = 1 << (len(table) - 1)
            if len(table[-1]) <= half:
                break
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words from positions a and b on, which differ."""
        shift = _shifts()[a % MODULUS, b % MODULUS]
        common = self._words(a, b, shift)
        go = np.flatnonzero(common == shift)
        i, j = self.rank[self.number[a[go] + shift[go]]], self.rank[self.number[b[go] + shift[go]]]
        low, high = np.minimum(i, j), np.maximum(i, j)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        least = np.zeros(len(go), dtype=np.int64)
        for k in np.unique(level):
            own = level == k
            least[own] = np.minimum(self.table[k][low[own]], self.table[k][high[own] - (1 << k)])
        common[go] += least
        return common


def _grid(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, periods and positions: each 3p-th one for every period that fits four times."""
    periods = sizes // LEAST_EXPONENT
    pairs, bound = np.cumsum(periods), np.arange(0, int(periods.sum()), GRID_POINTS // 8)
    for begin in bound:
        at = np.arange(begin, min(begin + GRID_POINTS // 8, int(periods.sum())))
        doc = np.searchsorted(pairs, at, side="right")
        period = at - (pairs[doc] - periods[doc]) + 1
        points = -(-(sizes[doc] - period) // ((LEAST_EXPONENT - 1) * period))
        total = np.cumsum(points)
        cut = 0
        while cut < len(at):  # a part with few points at a time
            done = total[cut - 1] if cut else 0
            end = max(cut + 1, int(np.searchsorted(total, done + GRID_POINTS, side="right")))
            own = points[cut:end]
            step = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
            p = np.repeat(period[cut:end], own)
            d = np.repeat(doc[cut:end], own)
            yield d, p, starts[d] + (LEAST_EXPONENT - 1) * p * step
            cut = end


def find_runs(documents: list[np.ndarray]) -> list[np.ndarray]:
    """For each array of word numbers (0 and up) its runs: rows of start, length and smallest period, by start and period."""
    sizes = np.array([len(d) for d in documents], dtype=np.int64)
    starts = np.cumsum(sizes + 1) - sizes  # a separator before each document, and one at the end
    none = [np.zeros((0, 3), dtype=np.int64) for _ in documents]
    if not (sizes >= LEAST_WORDS).any():
        return none
    words = max(int(d.max()) for d in documents if len(d)) + 1
    values = np.empty(int(sizes.sum()) + len(sizes) + 1, dtype=np.int64)
    for n, (start, own) in enumerate(zip(starts, documents)):
        values[start - 1] = words + n
        values[start : start + len(own)] = own
    values[-1] = words + len(sizes)

    right, left, last = Extensions(values), Extensions(values[::-1]), len(values) - 1
    found = []
    for doc, period, at in _grid(sizes, starts):
        same = values[at] == values[at + period]
        doc, period, at = doc[same], period[same], at[same]
        begin = at - left(last - (at - 1), last - (at + period - 1))
        length = at + period + right(at, at + period) - begin
        run = length >= np.maximum(LEAST_WORDS, LEAST_EXPONENT * period)
        found.append(np.stack([doc, begin, length, period], axis=1)[run])
    rows = np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)
    # A run is found with multiples of its period too, over the same words: the least one counts.
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), dtype=bool)
    first[1:] = (np.diff(rows[:, :3], axis=0) != 0).any(axis=1)
    rows = rows[first]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    rows[:, 1] -= starts[rows[:, 0]]
    return np.split(rows[:, 1:], np.searchsorted(rows[:, 0], np.arange(1, len(documents))))


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run of the greatest length by period; of equals that of the least start, then period."""
    best = None
    for start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def stays(n_words: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run is reduced to its first period."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edges[:-1]) == 0


def looped(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Words of one document in ten turned into a loop, so that long periods occur: the contract's own alteration."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a : a + p]
    return words[:a] + (loop * (-(-(n - a) // p)))[: n - a]


def _reported(ids: list, documents: list[list[bytes]]) -> pd.DataFrame:
    numbers, _ = pd.factorize(np.array(list(chain.from_iterable(documents)), dtype=object))
    ends = np.cumsum([len(d) for d in documents])
    rows = []
    for ident, words, runs in zip(ids, documents, find_runs(np.split(numbers.astype(np.int64), ends[:-1]))):
        best = strongest(runs)
        start, length, period = best or (None, None, None)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs.tolist())
        if best:
            words = list(np.array(words, dtype=object)[stays(len(words), runs)])
        rows.append((
            ident, len(runs), start, length, period, 1000 * length // period if best else None,
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest(),
        ))
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in COLUMNS.split(", ")])
    return frame.astype({c: "Int64" for c in ("doc_id", "start", "length", "period", "exponent_milli")})


def report_runs(docs: DataFrame, *, loops: bool = False) -> DataFrame:
    """One row for each document: doc_id, n_runs, start, length, period and exponent_milli of its strongest run, and the
    hashes of its runs and of the text without repetitions.

    Words are what stands between ASCII white space; a run is a stretch of at least ``LEAST_WORDS`` words and
    ``LEAST_EXPONENT`` times its smallest period that can't be extended. ``loops`` first alters a document in ten.

    A null or empty text has no words and no runs, a null id is reported as null and its text never altered. Repeated
    ids and repeated rows have a row each. A document beyond ``ARRAY_WORDS`` is searched whole, alone. No documents: no
    rows. Columns other than ``doc_id`` and ``text`` are not read.
    """

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, documents, size = [], [], 0
            for ident, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                ident = None if ident is pd.NA else int(ident)
                words = (text or "").encode("utf-8", "surrogatepass").split()  # of bytes: at ASCII white space only
                words = looped(ident, words) if loops else words
                if documents and size + len(words) > ARRAY_WORDS:
                    yield _reported(ids, documents)
                    ids, documents, size = [], [], 0
                ids.append(ident)
                documents.append(words)
                size += len(words)
            if documents:
                yield _reported(ids, documents)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInPandas(search, COLUMNS)
