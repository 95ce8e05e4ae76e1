"""Toxicity behind disguised spelling: a noisy channel restores the text, a classifier scores what was restored.

The channel. Writers replace letters by look-alike signs (``1d10t``), put signs or spaces between letters (``i d.i-o t``)
and repeat letters (``idiooot``). A disguised stretch is a lattice: at each character the letters it may stand for, or
nothing, or for a separator the end of a word. Viterbi decoding finds the cheapest path under the cost of each disguise and a character language model, four
letters long, counted over all documents. States are the last three letters, so the search is exact and its time is in
proportion to the stretch, however long that is.

The classifier. Logistic regression on how often words, and beginnings of words, occur in the restored text; compounds
of a toxic stem share its beginning. It is fitted on a bounded sample of labelled rows (``labelled_rows``), its features
chosen there, so model and lexicon have a bounded size whatever the corpus; everything else sees all documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

# Letters that a sign may stand for.
LOOK_ALIKES = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
#: Costs in nats: a sign read as a letter, a sign between letters skipped, a repeated letter skipped, a separator skipped
#: or read as a space; which of these two, the language model decides.
READ_SIGN, SKIP_SIGN, SKIP_REPEAT, SEPARATE = 0.7, 2.0, 1.0, 0.3
LETTERS = 28  # what stands between words, a-z, and all other letters
ORDER = 4
REMEMBERED_STRETCH = 64  # longer stretches and words rarely come again
SEPARATORS = " ._*-"
SIGNS = re.escape("".join(LOOK_ALIKES))
#: At least four single characters with one or two separators between them.
SPACED = r"(?<![^\W_])(?:[^\W_][ ._*\-]{1,2}){3,}[^\W_](?![^\W_])"
#: A word with signs in it, or with a letter three times in a row, or with two doubled letters in a row.
SIGNED = rf"(?<!\S)\S*?(?:[^\W\d_][{SIGNS}.*_\-]+[^\W\d_]|[{SIGNS}][^\W\d_]{{2}}|([^\W\d_])\1\1|([^\W\d_])\2([^\W\d_])\3)\S*"
RUN, WORD = re.compile(SPACED), re.compile(SIGNED)
STARTS = range(4, 9)
RIDGE, STEP = 0.02, 0.5


def _symbols() -> np.ndarray:
    table = np.zeros(256, dtype=np.int64)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[128:] = LETTERS - 1
    return table


SYMBOLS = _symbols()


def symbol_of(letter: str) -> int:
    return int(SYMBOLS[ord(letter)]) if ord(letter) < 128 else (LETTERS - 1 if letter.isalpha() else 0)


def count_letters(docs: DataFrame) -> np.ndarray:
    """How often each run of four letters occurs in all documents; at most 28^4 counts come to the driver."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(LETTERS**ORDER, dtype=np.int64)
        for batch in batches:
            for text in batch["text"].dropna():
                seen = SYMBOLS[np.frombuffer(f"    {text.lower()} ".encode("utf-8", "replace"), dtype=np.uint8)]
                codes = ((seen[:-3] * LETTERS + seen[1:-2]) * LETTERS + seen[2:-1]) * LETTERS + seen[3:]
                if len(codes) > 50_000:
                    total += np.bincount(codes, minlength=len(total))
                else:
                    np.add.at(total, codes, 1)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"code": found, "n": total[found]})

    rows = docs.select("text").mapInPandas(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    total = np.zeros(LETTERS**ORDER)
    found = rows.toPandas()
    total[found["code"].to_numpy()] = found["n"].to_numpy()
    return total


def letter_costs(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """Minus log probability of the fourth letter after three, smoothed by the shorter runs."""
    tables = [counts.reshape([LETTERS] * ORDER)]
    for _ in range(ORDER - 1):
        tables.append(tables[-1].sum(axis=0))
    p = (tables[-1] + 1) / (tables[-1].sum() + LETTERS)
    for table in reversed(tables[:-1]):
        p = (table + weight * p) / (table.sum(axis=-1, keepdims=True) + weight)
    return -np.log(p).astype(np.float32).ravel()


def without_end(core: str) -> str:
    """Without signs that stand for left out letters at its end, or a look-alike that is repeated there."""
    rest = core.rstrip("%&#*")
    if rest == core and core[-2:-1] == core[-1:] and core[-1:] in tuple("!$+|(@"):
        rest = core.rstrip(core[-1])
    return rest


class Restorer:
    """Decodes the disguised stretches of texts; a stretch met before is remembered.

    A disguised word lies between white space, so it's looked for once in each different word. Only runs of single
    letters are searched in whole texts.
    """

    def __init__(self, costs: np.ndarray, remembered: int = 50_000):
        self.costs, self.remembered, self.known = costs, remembered, {}

    def decode(self, stretch: str) -> str:
        """The cheapest reading, by Viterbi over the last three letters."""
        costs, size = self.costs, LETTERS**3
        # Last three letters and the last one as written -> cost, and the reading as its last letter and the reading before.
        best: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
        for at, sign in enumerate(stretch):
            ways = []
            if sign.isalpha():
                ways.append((sign, 0.0))
                if at and stretch[at - 1] == sign:
                    ways.append(("", SKIP_REPEAT))
            elif sign in SEPARATORS:
                ways = [("", SEPARATE), (" ", SEPARATE)]
            else:
                ways = [(letter, READ_SIGN) for letter in LOOK_ALIKES.get(sign, "")]
                ways.append(("", SKIP_SIGN))
            after: dict[tuple[int, str], tuple[float, tuple | None]] = {}
            for (state, last), (cost, reading) in best.items():
                for letter, price in ways:
                    if letter:
                        code = state * LETTERS + symbol_of(letter)
                        key, total = (code % size, letter), cost + price + costs[code]
                    else:
                        key, total = (state, last), cost + price
                    if key not in after or total < after[key][0]:
                        after[key] = (total, (letter, reading) if letter else reading)
            best = after
        _, reading = min(((cost + costs[state * LETTERS], reading) for (state, _), (cost, reading) in best.items()), key=lambda r: r[0])
        letters = []
        while reading:
            letter, reading = reading
            letters.append(letter)
        return "".join(reversed(letters))

    def _restored(self, stretch: str) -> str:
        reading = self.known.get(stretch)
        if reading is None:
            core = stretch.strip("".join(c for c in set(stretch) if not c.isalnum() and c not in "@$!|+(€£")) or stretch
            plain = without_end(core) or core
            digits = sum(c.isdigit() for c in plain)
            if plain.isalpha() and not re.search(r"(.)\1\1|(.)\2(.)\3", plain):
                reading = plain
            elif digits * 3 > len(plain) * 2 or plain.count("@") and "." in plain.partition("@")[2]:
                reading = stretch  # numbers and addresses
            else:
                reading = self.decode(plain)
            if len(stretch) <= REMEMBERED_STRETCH:
                if len(self.known) >= self.remembered:
                    self.known.clear()
                self.known[stretch] = reading
        return reading

    def _word(self, word: str) -> str:
        return self._restored(word) if WORD.match(word) else word

    def words_of_word(self, word: str) -> list[str]:
        """What one word between white space, in small letters, is read as; without signs at the edges."""
        if WORD.match(word):
            return list(words_of(self._restored(word)).elements())
        bare = word if word.isalpha() else EDGE.sub("", word)
        return [bare] if bare else []

    def words(self, text: str) -> Counter:
        """The words of the restored text, and how often they occur."""
        text = text.lower()
        if RUN.search(text):
            return words_of(self.restore(text))
        words: Counter = Counter()
        for word, n in Counter(text.split()).items():
            for read in self.words_of_word(word):
                words[read] += n
        return words

    def restore(self, text: str) -> str:
        """The text with its disguised stretches read: from left to right, and of two that begin together the run."""
        text, parts, at = text.lower(), [], 0

        def plain(begin: int, end: int) -> None:
            """Words read one by one; what is left of a word that a run ended in stays."""
            piece = text[begin:end]
            if begin and not text[begin - 1].isspace():
                rest = piece.lstrip() if piece[:1].isspace() else (piece.split(None, 1) + [""])[1] if piece.strip() else ""
                parts.append(piece[: len(piece) - len(rest)])
                piece = rest
            parts.append(re.sub(r"\S+", lambda m: self._word(m.group()), piece))

        run = RUN.search(text)
        while run:
            start = run.start()
            head = start
            while head > at and not text[head - 1].isspace():
                head -= 1
            whole = head == 0 or text[head - 1].isspace()
            word = WORD.match(text, head) if whole and head < start else None
            if word:  # a disguised word that begins before the run and holds its beginning
                plain(at, head)
                parts.append(self._restored(word.group()))
                at = word.end()
            else:
                plain(at, head)
                parts.append(text[head:start])
                parts.append(self._restored(run.group()))
                at = run.end()
            run = RUN.search(text, at)
        plain(at, len(text))
        return "".join(parts)


EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features_of(word: str) -> list[str]:
    """The word, and with an opening sign its beginnings."""
    return [word, *("^" + word[:n] for n in STARTS if len(word) > n)]


def words_of(restored: str) -> Counter:
    """Words without signs at their edges, the last letter alone kept where nothing is left."""
    found = Counter(restored.split())
    words: Counter = Counter()
    for word, n in found.items():
        words[word if word.isalpha() else EDGE.sub("", word)] += n
    del words[""]
    return words


@dataclass(frozen=True)
class Model:
    costs: np.ndarray
    weights: dict[str, float]
    bias: float

    def scorer(self):
        restorer, known = Restorer(self.costs), {}

        def features(words: list[str]) -> tuple[str, ...]:
            return tuple(f for word in words for f in features_of(word) if f in self.weights)

        def score(text: str | None) -> float:
            text = (text or "").lower()
            counts: Counter = Counter()
            if RUN.search(text):
                for word, n in restorer.words(text).items():
                    for feature in features([word]):
                        counts[feature] += n
            else:  # what most texts are: the features of a word as it stands are remembered
                for word, n in Counter(text.split()).items():
                    found = known.get(word)
                    if found is None:
                        found = features(restorer.words_of_word(word))
                        if len(word) <= REMEMBERED_STRETCH:
                            if len(known) >= 100_000:
                                known.clear()
                            known[word] = found
                    for feature in found:
                        counts[feature] += n
            z = self.bias + sum(self.weights[f] * math.log1p(n) for f, n in counts.items())
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _fit(rows: pd.DataFrame, labels: dict[int, int], names: list[str]) -> tuple[np.ndarray, float]:
    """Logistic regression by accelerated gradient descent. ``rows``: doc, feature's number, log count."""
    docs = {d: i for i, d in enumerate(labels)}
    y = np.array(list(labels.values()), dtype=float)
    doc = rows["doc"].map(docs).to_numpy()
    feature, value = rows["feature"].to_numpy(), rows["value"].to_numpy()
    rate = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w = np.zeros(len(names) + 1)
    w[-1] = math.log(rate / (1 - rate))
    # Sums of squares by feature scale the steps, so that rare features keep up with frequent ones.
    scale = np.append(1 / (np.bincount(feature, value * value, minlength=len(names)) + 1), 1 / len(y))
    ahead, momentum = w.copy(), 1.0
    for _ in range(400):
        z = ahead[-1] + np.bincount(doc, ahead[feature] * value, minlength=len(y))
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gradient = np.append(np.bincount(feature, error[doc] * value, minlength=len(names)), error.sum())
        gradient[:-1] += RIDGE * ahead[:-1]
        new = ahead - STEP * scale * gradient
        follow = (1 + math.sqrt(1 + 4 * momentum * momentum)) / 2
        if (gradient * (new - w)).sum() > 0:  # going uphill: begin the momentum anew
            follow, momentum = 1.0, 1.0
        ahead = new + (momentum - 1) / follow * (new - w)
        w, momentum = new, follow
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, *, labelled_rows: int = 12_000, lexicon: int = 2_000) -> Model:
    """Counts letters over all documents and fits the classifier on ``labelled_rows`` labelled rows, chosen by a hash of
    their id, none of them held out. An id with several labels counts as toxic if one of them says so."""
    spark = docs.sparkSession
    costs = letter_costs(count_letters(docs))
    usable = (
        labels.select("doc_id", "toxic").dropna().where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled_rows)
    )
    chosen = {row["doc_id"]: row["toxic"] for row in usable.collect()}
    rate = sum(chosen.values()) / len(chosen) if chosen else 0.0
    if rate in (0.0, 1.0):
        return Model(costs, {}, 30.0 if rate else -30.0)
    restorer_costs = spark.sparkContext.broadcast(costs)  # 28^4 numbers at most

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        restorer = Restorer(restorer_costs.value)
        for batch in batches:
            rows, size = [], 0
            for doc, text, toxic in zip(batch["doc_id"], batch["text"], batch["toxic"]):
                counts: Counter = Counter()
                for word, n in restorer.words(text or "").items():
                    for feature in features_of(word):
                        counts[feature] += n
                rows.append((doc, toxic, list(counts), [math.log1p(n) for n in counts.values()]))
                size += len(counts)
                if size > 20_000:  # a few documents at a time, as each has thousands of features
                    yield pd.DataFrame(rows, columns=["doc", "toxic", "names", "log_counts"])
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=["doc", "toxic", "names", "log_counts"])

    # The chosen ids are bounded, so Spark sends them to the documents; rows of the same id: any one is taken.
    ids = spark.createDataFrame(list(chosen.items()), "doc_id long, toxic int")
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = sample.mapInPandas(counted, "doc long, toxic int, names array<string>, log_counts array<double>")
    rows = Scratch(spark, "toxicity").keep(rows, "features")
    n, toxic = len(chosen), sum(chosen.values())
    expected = F.col("with") * F.lit(toxic / n)
    strong = (
        rows.select("toxic", F.explode("names").alias("name"))
        .groupBy("name").agg(F.count("*").alias("with"), F.sum("toxic").alias("toxic"))
        .where("with >= 5")
        .orderBy((F.abs(F.col("toxic") - expected) / F.sqrt(expected)).desc(), "name")
        .limit(lexicon).select("name").collect()
    )
    names = sorted(row["name"] for row in strong)
    numbers = {name: i for i, name in enumerate(names)}

    def chosen_only(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            kept = [[(numbers[f], v) for f, v in zip(fs, vs) if f in numbers] for fs, vs in zip(batch["names"], batch["log_counts"])]
            yield pd.DataFrame(
                {"doc": batch["doc"], "features": [[f for f, _ in k] for k in kept], "log_counts": [[v for _, v in k] for k in kept]}
            )

    # A row for each of the sample's documents.
    by_doc = rows.mapInPandas(chosen_only, "doc long, features array<int>, log_counts array<double>").toPandas()
    sizes = by_doc["features"].str.len().to_numpy(dtype=int)
    found = pd.DataFrame(
        {
            "doc": np.repeat(by_doc["doc"].to_numpy(), sizes),
            "feature": np.concatenate([np.zeros(0, int), *by_doc["features"]]).astype(int),
            "value": np.concatenate([np.zeros(0), *by_doc["log_counts"]]),
        }
    )
    weights, bias = _fit(found, chosen, names)
    return Model(costs, dict(zip(names, weights.tolist())), bias)


def score_documents(docs: DataFrame, model: Model, *, threshold: float = 0.7) -> DataFrame:
    """The documents with ``score`` (0 to 1, higher is likelier toxic) and ``predicted`` (1 at ``threshold`` or above).

    Scores depend on the text alone. Null and empty texts get the score of a text without any known word. Other columns
    pass through; of the names ``score`` and ``predicted`` the new columns win. No documents: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a bounded lexicon and at most 28^4 numbers

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = shared.value.scorer()
        for batch in batches:
            yield pd.Series([scorer(text) for text in batch], dtype="float64")

    columns = [c for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(*columns, score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
