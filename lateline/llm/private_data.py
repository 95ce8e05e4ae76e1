"""Personal data: patterns, and a skip-chain conditional random field that carries their labels on.

Patterns find what has the full form of an e-mail address, IP address, card or phone number. People also write such data
in part: a phone number without its country code, a repeated number with other signs. The field labels the tokens that
hold a digit or an @ with a kind or none. Its potentials:

- own: a logistic model of sixteen signs of form and neighbourhood;
- chain: the labels of tokens next to each other;
- skip: tokens far apart with the same digits, the same last digits or the same address share a label.

The first two are fitted to the patterns' labels over all documents. As signs are yes or no, the counts of their combinations by
label say all there is to say, so the driver fits on at most 2^16 rows. Skip links join a token to the last one before it
with the same key, so a document has at most three links for each token. Marginals come from loopy belief propagation over all
documents of a batch at once; tokens in pattern matches are given. Confident tokens outside matches become added spans
where skip links lead from one of the span's tokens to a match of the same kind: the field carries labels on, it doesn't
declare numbers private that no pattern knows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
LABELS = NONE + 1
SIGNS = 16
SPANS = "spans array<struct<kind:string,start:long,end:long,base:boolean>>"

# The patterns of the contract. The look-behind and possessive forms find the same matches in linear time.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ACTIVE = re.compile(r"[0-9@]")
TOKEN_END = re.compile(r"\s")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @: the run of local characters before it, not beyond the last match, and the domain after it."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def small_enough(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """kind's number, start, end; by kind, then start."""
    found = [(0, a, b) for a, b in emails(text)]
    found += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(map(small_enough, m.group().split(".")))]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := only_digits(m.group())) <= 19 and passes_luhn(digits):
            found.append((2, m.start(), m.end()))
    found += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return found


@dataclass
class Tokens:
    """The active tokens of a batch of documents, and the links between them."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    given: np.ndarray  # the kind of the pattern match that the token lies in, or -1
    signs: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def _sign_bits(token: str, digits: int, before: bool, after: bool) -> int:
    letters, dots = any(c.isalpha() for c in token), token.count(".")
    signs = (
        "@" in token, not letters, token[:1] == "+", "(" in token, "-" in token, dots == 3, 0 < dots < 3, digits >= 3,
        digits >= 4, digits >= 7, digits >= 12, 16 <= digits <= 19, before, after, "=" in token or '"' in token,
        "/" in token or ":" in token,
    )
    return sum(1 << i for i, s in enumerate(signs) if s)


def tokens_of(texts: list[str], bases: list[list[tuple[int, int, int]]]) -> Tokens:
    rows, chain, skip = [], [], []
    for doc, (text, base) in enumerate(zip(texts, bases)):
        spots, at = [], ACTIVE.search(text)
        while at:
            start = at.start()
            floor = spots[-1][1] if spots else 0
            while start > floor and not text[start - 1].isspace():
                start -= 1
            stop = TOKEN_END.search(text, at.end())
            end = stop.start() if stop else len(text)
            spots.append((start, end))
            at = ACTIVE.search(text, end)
        kinds = np.full(len(spots), -1)
        if base and spots:
            starts, ends = np.array(spots).T
            for kind, a, b in base:
                kinds[np.searchsorted(ends, a, "right") : np.searchsorted(starts, b, "left")] = kind
        last: dict[str, int] = {}
        for i, (start, end) in enumerate(spots):
            token, number = text[start:end], len(rows)
            digits = only_digits(token)
            before = i > 0 and start - spots[i - 1][1] <= 1
            after = i + 1 < len(spots) and spots[i + 1][0] - end <= 1
            if before:
                chain.append((number - 1, number))
            keys = {digits, "-" + digits[-7:]} if len(digits) >= 7 else set()
            for key in keys | ({token.lower().strip(".,;:!?()<>\"'*%$&#")} if "@" in token else set()):
                if key in last:
                    skip.append((last[key], number))
                last[key] = number
            rows.append((doc, start, end, int(kinds[i]), _sign_bits(token, len(digits), before, after)))
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return Tokens(*table.T, np.array(chain, dtype=np.int64).reshape(-1, 2), np.array(skip, dtype=np.int64).reshape(-1, 2))


@dataclass
class Field:
    own: np.ndarray  # 2^16 combinations by label, log
    chain: np.ndarray
    skip: np.ndarray


def propagate(field: Field, tokens: Tokens, rounds: int = 8) -> np.ndarray:
    """Marginals of all tokens: sum-product along chain and skip links, in the log domain, damped."""
    own = field.own[tokens.signs].copy()
    held = np.flatnonzero(tokens.given >= 0)
    own[held] = -50.0
    own[held, tokens.given[held]] = 0.0
    links = np.concatenate([tokens.chain, tokens.skip])
    if len(links):
        matrix = np.concatenate([np.repeat(field.chain[None], len(tokens.chain), 0), np.repeat(field.skip[None], len(tokens.skip), 0)])
        source, target = np.concatenate([links[:, 0], links[:, 1]]), np.concatenate([links[:, 1], links[:, 0]])
        matrix = np.concatenate([matrix, matrix.transpose(0, 2, 1)])
        back = np.roll(np.arange(len(source)), len(links))
        sent = np.zeros((len(source), LABELS))
        order = np.argsort(target, kind="stable")
        ends, begins = np.unique(target[order], return_index=True)

        def belief() -> np.ndarray:
            total = own.copy()
            total[ends] += np.add.reduceat(sent[order], begins, axis=0)
            return total

        for _ in range(rounds):
            x = (belief()[source] - sent[back])[:, :, None] + matrix
            top = x.max(axis=1)
            new = top + np.log(np.exp(x - top[:, None]).sum(axis=1))
            sent = 0.5 * sent + 0.5 * (new - new.max(axis=1, keepdims=True))
        own = belief()
    p = np.exp(own - own.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _fit_own(counts: np.ndarray, steps: int = 300) -> np.ndarray:
    """Multinomial logistic regression on counted combinations of signs, by Newton-like scaled gradient steps."""
    seen = np.flatnonzero(counts.sum(1))
    x = ((seen[:, None] >> np.arange(SIGNS)) & 1).astype(float)
    x = np.hstack([x, np.ones((len(seen), 1))])
    n = counts[seen]
    w, total = np.zeros((SIGNS + 1, LABELS)), n.sum(1)
    curve = np.linalg.pinv((x * total[:, None]).T @ x * 0.25 + np.eye(SIGNS + 1))
    for _ in range(steps):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        w += curve @ (x.T @ (n - p * total[:, None]) - 0.01 * w)
    every = np.hstack([((np.arange(1 << SIGNS)[:, None] >> np.arange(SIGNS)) & 1).astype(float), np.ones((1 << SIGNS, 1))]) @ w
    return every - np.log(np.exp(every - every.max(1, keepdims=True)).sum(1, keepdims=True)) - every.max(1, keepdims=True)


def train(docs: DataFrame, *, agreement: float = 4.0) -> Field:
    """Counts signs and neighbouring labels over all documents and fits the own and chain potentials to them.

    The skip potential is the log odds ``agreement`` for equal labels. It can't be learned here: to the patterns a
    repeated number without its full form is none, which is just what the field is to mend.
    """

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(((1 << SIGNS) + LABELS) * LABELS, dtype=np.int64)
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"].array]
            tokens = tokens_of(texts, [base_spans(t) for t in texts])
            label = np.where(tokens.given < 0, NONE, tokens.given)
            np.add.at(total, tokens.signs * LABELS + label, 1)
            np.add.at(total, ((1 << SIGNS) + label[tokens.chain[:, 0]]) * LABELS + label[tokens.chain[:, 1]], 1)
        found = np.flatnonzero(total)
        yield pd.DataFrame({"code": found, "n": total[found]})

    summed = docs.select("text").mapInPandas(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toPandas()
    total = np.zeros(((1 << SIGNS) + LABELS) * LABELS)
    total[summed["code"].to_numpy()] = summed["n"].to_numpy()
    counts = total[: (1 << SIGNS) * LABELS].reshape(-1, LABELS)

    def together(pairs: np.ndarray) -> np.ndarray:
        """How much likelier two linked labels are than apart."""
        pairs = pairs + pairs.T + 0.5
        return np.clip(np.log(pairs * pairs.sum() / np.outer(pairs.sum(1), pairs.sum(1))), -6, 6)

    chain = total[(1 << SIGNS) * LABELS :].reshape(LABELS, LABELS)
    return Field(_fit_own(counts), together(chain), agreement * np.eye(LABELS))


def supported(tokens: Tokens) -> np.ndarray:
    """The kind of a pattern match that skip links lead to, or -1. Links of a key run from token to token in order, so a
    pass forth and one back reach all of them."""
    kind = tokens.given.copy()
    links = tokens.skip.tolist()
    for a, b in links:
        kind[b] = kind[a] if kind[b] < 0 else kind[b]
    for a, b in reversed(links):
        kind[a] = kind[b] if kind[a] < 0 else kind[a]
    return kind


def _added(text: str, tokens: Tokens, own: np.ndarray, label: np.ndarray, support: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of neighbouring confident tokens of one kind, without signs at their edges."""
    found: list[list] = []
    for i in own.tolist():
        kind, start, end = int(label[i]), int(tokens.start[i]), int(tokens.end[i])
        while start < end and not (text[start].isalnum() or text[start] in "+("):
            start += 1
        while end > start and not (text[end - 1].isalnum() or text[end - 1] == ")"):
            end -= 1
        backed = bool(support[i] == kind)
        if end <= start:
            continue
        if found and found[-1][0] == kind and start - found[-1][2] <= 1 and found[-1][3] == i - 1:
            found[-1][2:] = [end, i, backed or found[-1][4]]
        else:
            found.append([kind, start, end, i, backed])
    return [(k, a, b) for k, a, b, _, backed in found if backed]


def find_private_data(docs: DataFrame, field: Field, *, confidence: float = 0.9) -> DataFrame:
    """One row for each document: doc_id and spans, an array of kind, start, end (code points, end exclusive) and whether
    a pattern found it; by kind (email, ip, card, phone), then start.

    Added spans hold no part of a pattern's match. Null and empty texts have no spans. Null and repeated ids and
    repeated rows stay, one row each. No documents: no rows. Columns other than ``doc_id`` and ``text`` are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # 2^16 combinations

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [t if isinstance(t, str) else "" for t in batch["text"].array]
            bases = [base_spans(t) for t in texts]
            tokens = tokens_of(texts, bases)
            spans = [[(k, a, b, True) for k, a, b in base] for base in bases]
            if len(tokens.doc):
                p = propagate(shared.value, tokens)
                label = p.argmax(axis=1)
                sure = np.flatnonzero((tokens.given < 0) & (label != NONE) & (p.max(axis=1) >= confidence))
                support = supported(tokens)
                for doc in np.unique(tokens.doc[sure]):
                    own = sure[tokens.doc[sure] == doc]
                    spans[doc] += [(*s, False) for s in _added(texts[doc], tokens, own, label, support)]
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in sorted(s)] for s in spans]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "spans": rows})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(found, f"doc_id long, {SPANS}")
