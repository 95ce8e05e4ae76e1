"""How filters of a corpus interact, with exact copies found by radix text tries.

Each task of the input puts its texts into a compressed trie whose terminals hold the least id seen so far. Every row but
one of a text leaves at once: a row that comes to a smaller id is a copy, and a smaller id turns the one before into a
copy. What is left, one row for each text and task, goes on to tasks that hold ranges of the texts, by prefixes that are
longer where the corpus is denser, and through a trie once more. So a text that fills the corpus reaches its range once
for each task, and no trie holds a text twice.

Every row ends with a mask of the filters it fails. Counts by part and mask, 32 at most for a part, answer for every
order of the filters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import permutations
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch, shuffle_partitions

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")

#: Code points of the prefixes among which a text's range is chosen.
PREFIXES = (1, 2, 4, 8, 16, 32, 64)

#: Bytes of text that a range, and a task's trie, should hold; and ranges of the corpus at most, unless the session asks
#: for more partitions. The list of prefixes that every task gets has at most 4 * ``len(PREFIXES)`` entries a range.
ROOM, MOST_RANGES = 32 << 20, 500_000

NOT_UPPER = bytes(b for b in range(256) if not 65 <= b <= 90)
SIGNS = b"#$%&*|"


def text_mask(text: str) -> int:
    """Bits of the filters that look at the text alone."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: at ASCII white space only
    failed = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(data.translate(None, NOT_UPPER)) > 2 * len(text),
        len(data.translate(None, SIGNS)) < len(data),
    )
    return sum(bit << n for n, bit in enumerate(failed))


@dataclass(slots=True)
class Terminal:
    """What a trie knows of one text: its mask, the least id, and the rows of that id by part."""

    mask: int
    least: int
    rows: dict[str, int]


@dataclass(slots=True)
class Node:
    label: str
    children: dict[str, Node] = field(default_factory=dict)
    terminal: Terminal | None = None


class Trie:
    """A radix tree of whole texts; edges carry text, so it has two nodes a text at most."""

    def __init__(self):
        self.root, self.characters = Node(""), 0

    def reach(self, text: str) -> Node:
        """The node at which the text ends, made if there is none."""
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = Node(text[at:])
                self.characters += len(child.label)
                return child
            if not text.startswith(child.label, at):
                shared = _shared(child.label, text, at)
                upper = Node(child.label[:shared], {child.label[shared]: child})
                child.label = child.label[shared:]
                node.children[text[at]] = child = upper
            node, at = child, at + len(child.label)
        return node

    def texts(self) -> Iterator[tuple[str, Terminal]]:
        """Every text and its terminal, in order of the text."""
        stack = [("", self.root)]
        while stack:
            before, node = stack.pop()
            text = before + node.label
            if node.terminal:
                yield text, node.terminal
            stack.extend((text, node.children[c]) for c in sorted(node.children, reverse=True))


def _shared(label: str, text: str, at: int) -> int:
    """Characters that a label and a text have in common from a place on; less than the whole label."""
    low, high = 1, min(len(label), len(text) - at)
    if text.startswith(label[:high], at):
        return high
    while low < high:  # the first half is known to be shared, or not
        middle = (low + high + 1) // 2
        if text.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def insert(node: Node, own: Terminal, leave: Callable[[Terminal], None]) -> None:
    """Puts rows of one text and id at the text's node; ``leave`` takes those that turn out to be copies."""
    there = node.terminal
    if there is None:
        node.terminal = own
    elif own.least == there.least:
        for part, n in own.rows.items():
            there.rows[part] = there.rows.get(part, 0) + n
    else:
        keep, gone = (own, there) if own.least < there.least else (there, own)
        node.terminal = keep
        leave(gone)


SENT = "doc_id long, part string, mask int, n long, prefix string, slot int, text string"


class Sender:
    """Rows on their way out of a task, a frame at a time."""

    def __init__(self):
        self.rows, self.characters = [], 0

    def row(self, ident: int | None, part: str, mask: int, n: int, prefix: str | None = None, slot: int | None = None, text: str | None = None):
        self.rows.append((ident, part, mask, n, prefix, slot, text))
        self.characters += len(text or "")

    def copies(self, terminal: Terminal) -> None:
        for part, n in terminal.rows.items():
            self.row(terminal.least, part, terminal.mask | COPY, n)

    def frames(self, room: int = 0) -> Iterator[pd.DataFrame]:
        if self.rows and (len(self.rows) > 20_000 or self.characters >= room):
            frame = pd.DataFrame(self.rows, columns=[c.split()[0] for c in SENT.split(", ")])
            self.rows, self.characters = [], 0
            yield frame.astype({"doc_id": "Int64", "slot": "Int32"})


def dense_prefixes(docs: DataFrame, room: int) -> dict[str, int]:
    """Prefixes with more text than ``room``, and their bytes. At most ``len(PREFIXES)`` times the text by ``room``."""
    starts = F.explode(F.array(*[F.struct(F.lit(n).alias("length"), F.substring("text", 1, n).alias("prefix")) for n in PREFIXES]))
    counted = docs.where("text <> ''").select(starts.alias("start"), F.octet_length("text").cast("long").alias("size"))
    dense = counted.groupBy("start.length", "start.prefix").agg(F.sum("size").alias("size")).where(F.col("size") > room)
    return {r.prefix: r.size for r in dense.where(F.length("prefix") == F.col("length")).select("prefix", "size").toLocalIterator()}


def fail_masks(docs: DataFrame, *, room: int = ROOM) -> DataFrame:
    """doc_id, part, mask and n: how many rows of ``docs`` with that id and part fail the filters of the mask.

    Bits 0 to 4 are the filters A to E: under 200 words; fewer distinct words than half of them; more than 2 in 100
    code points A to Z; one of the signs ``#$%&*|``; a text that a row of a smaller doc_id has too. A null text is
    empty, a null source is the part ''. A null id is neither smaller nor larger than another, so such rows never fail
    E and fail no other. Repeated rows count each. No documents: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "filter-audit")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    room = max(room, -(-total // MOST_RANGES))
    ranges = max(shuffle_partitions(spark), -(-total // room))
    # A quarter of an even share, so that ranges of whole prefixes come out about even.
    share = max(total // (4 * ranges), 1)
    listed = spark.sparkContext.broadcast(dense_prefixes(rows, share))

    def place(text: str) -> tuple[str, int]:
        """The shortest prefix that isn't dense; texts alike beyond all prefixes are dealt by a hash of the whole."""
        for n in PREFIXES:
            if (size := listed.value.get(text[:n])) is None:
                return text[:n], 0
        return text[: PREFIXES[-1]], crc32(text.encode("utf-8", "surrogatepass")) % -(-size // share)

    def emptied(trie: Trie, out: Sender) -> Iterator[pd.DataFrame]:
        """Every text of a trie with the rows of its least id; more than one only if an id is repeated in other parts."""
        for text, terminal in trie.texts():
            for part, n in terminal.rows.items():
                out.row(terminal.least, part, terminal.mask, n, *place(text), text)
            yield from out.frames(room // 4)

    def in_tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, out = Trie(), Sender()
        for batch in batches:
            for ident, part, text in zip(batch["doc_id"].astype("Int64"), batch["part"], batch["text"]):
                if ident is pd.NA:
                    out.row(None, part, text_mask(text), 1)
                    continue
                node = trie.reach(text)
                mask = node.terminal.mask if node.terminal else text_mask(text)
                insert(node, Terminal(mask, int(ident), {part: 1}), out.copies)
                if trie.characters > room:  # what a trie holds is bounded; the ranges see to the rest
                    yield from emptied(trie, out)
                    trie = Trie()
            yield from out.frames(room // 4)
        yield from emptied(trie, out)
        yield from out.frames()

    def in_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie, out = Trie(), Sender()
        for batch in batches:
            for least, part, mask, n, text in batch[["doc_id", "part", "mask", "n", "text"]].itertuples(index=False, name=None):
                insert(trie.reach(text), Terminal(mask, least, {part: n}), out.copies)
            yield from out.frames(room)
        for _, terminal in trie.texts():
            for part, n in terminal.rows.items():
                out.row(terminal.least, part, terminal.mask, n)
            yield from out.frames(room)
        yield from out.frames()

    sent = scratch.keep(rows.mapInPandas(in_tasks, SENT), "texts")
    masks = ["doc_id", "part", "mask", "n"]
    ranged = sent.where("text IS NOT NULL").repartitionByRange(ranges, "prefix", "slot").mapInPandas(in_ranges, SENT)
    return scratch.keep(sent.where("text IS NULL").select(*masks).union(ranged.select(*masks)), "masks")


def _steps(spark) -> DataFrame:
    """Each order of the filters, each step of it and each mask: 120 times 5 times 32 rows."""
    rows = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << FILTERS.index(letter)
            rows.append(("".join(order), step, letter, bit, before))
            before |= bit
    steps = spark.createDataFrame(rows, "filter_order string, step int, letter string, bit int, before int")
    return steps.withColumn("mask", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))))


def audit_filters(docs: DataFrame, labels: DataFrame, *, room: int = ROOM) -> DataFrame:
    """For every part, order of the filters and step the documents that are kept, removed, redundant and so on.

    ``fail_masks`` says what the filters are, and what becomes of nulls. A document is good or toxic if any row of
    ``labels`` with its id says 1; labels without an id or a document have no effect. Each row of ``docs`` counts as a
    document. A part has 600 rows, zeros included; no documents: no rows.
    """
    spark = docs.sparkSession
    masks = fail_masks(docs, room=room)
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("if(quality = 1, 1, 0)")).alias("good"), F.max(F.expr("if(toxic = 1, 1, 0)")).alias("bad")
    )
    # Rows without an id have no labels; left out of the join, they don't meet in one task.
    marked = masks.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").select("part", "mask", "n", "good", "bad")
    bare = masks.where("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("bad"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    counts = marked.union(bare).groupBy("part", "mask").agg(
        F.sum("n").alias("n"), total(F.col("n") * F.col("good")).alias("n_good"), total(F.col("n") * F.col("bad")).alias("n_bad")
    )
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")
    count = lambda when, of="n": F.sum(F.when(when, F.col(of)).otherwise(0)).cast("long")
    steps = F.broadcast(_steps(spark))  # 19,200 rows whatever the corpus
    audited = counts.join(steps, "mask").groupBy("part", "filter_order", "step", "letter").agg(
        count(~fails & ~earlier).alias("kept"),
        count(fails & ~earlier).alias("removed"),
        count(fails & earlier).alias("redundant"),
        count(F.expr("mask = bit")).alias("unique_fails"),
        count(fails & ~earlier, "n_good").alias("good_lost"),
        count(fails & ~earlier, "n_bad").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    return audited.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", shapley)
