"""The audit against a brute-force one; tries against dictionaries; dense prefixes and hot texts."""

import re
from collections import Counter
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lateline.llm import filter_audit
from lateline.llm.filter_audit import Terminal, Trie, audit_filters, dense_prefixes, fail_masks, insert
from llm.cases import ROWS, SAME, documents

LABELS = [(1, 1, 0), (1, 0, 1), (2, 1, 1), (3, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]


def failed(rows):
    """For each row the letters that it fails."""
    out = []
    for row in rows:
        text = row[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        copy = row[0] is not None and any(o[0] is not None and o[0] < row[0] and (o[1] or "") == text for o in rows)
        fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), bool(re.search(r"[#$%&*|]", text)), copy)
        out.append("".join(x for x, f in zip("ABCDE", fails) if f))
    return out


def audit(rows, labels):
    fails, out = failed(rows), []
    good, bad = {r[0] for r in labels if r[1] == 1 and r[0] is not None}, {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    for part in {r[3] or "" for r in rows}:
        docs = [(r[0], f) for r, f in zip(rows, fails) if (r[3] or "") == part]
        shapley, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                shapley[x] += len(gone)
                steps.append((x, (
                    part, "".join(order), step, len(left), len(gone), sum(x in f for _, f in docs) - len(gone), sum(f == x for _, f in docs),
                    sum(i in good for i, _ in gone), sum(i in bad for i, _ in gone),
                )))
        out += [(*row, shapley[x]) for x, row in steps]
    return sorted(out)


def labels(spark, rows=LABELS):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").selectExpr("*", "1 as mask", "'own' as part")


def got(df):
    return sorted(tuple(r) for r in df.collect())


MORE = [
    (20, SAME, "en", "b", 1), (0, SAME, "en", None, 1), (21, "A B c", "en", "a", 1), (22, "50 % off & more", "en", "a", 1), (23, "", "en", "b", 0),
    (24, "a" * 98 + "AB", "en", "a", 1), (25, "a" * 97 + "ABC", "en", "a", 1), (26, "x y " * 101, "en", "b", 1), (27, " ".join(map(str, range(200))), "en", "b", 1),
    (2, SAME, "en", "b", 1), (28, "a\x1cb", "en", "a", 1),
]


@pytest.mark.parametrize("room", [100, 32 << 20])
def test_edge_rows(spark, room):
    rows = ROWS + MORE
    docs = documents(spark, rows, clashing=True).repartition(3)
    assert got(audit_filters(docs, labels(spark), room=room)) == audit(rows, LABELS)
    assert got(audit_filters(docs, labels(spark, []).where("false"), room=room)) == audit(rows, [])


def test_no_documents(spark):
    assert got(audit_filters(documents(spark, []), labels(spark))) == []


def test_every_row_has_one_mask(spark):
    masks = fail_masks(documents(spark, ROWS + MORE))
    assert Counter((r.doc_id, r.part, r.mask) for r in masks.collect() for _ in range(r.n)) == Counter(
        (r[0], r[3] or "", sum(1 << "ABCDE".index(x) for x in f)) for r, f in zip(ROWS + MORE, failed(ROWS + MORE))
    )


def test_one_text_and_one_beginning_hold_most_rows(spark):
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"),
        F.expr("case id % 3 when 0 then repeat('all the same ', 30) when 1 then concat(repeat('one beginning ', 8), id) else concat(id div 6, ' own') end").alias("text"),
    ).repartition(16)
    for room in (4000, 32 << 20):
        counts = {r.copy: r.n for r in fail_masks(docs, room=room).groupBy((F.col("mask").bitwiseAND(16) > 0).alias("copy")).agg(F.sum("n").alias("n")).collect()}
        assert counts == {True: 1999 + 1000, False: 1 + 2000 + 1000}
    rows = docs.select("text")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0]
    dense = dense_prefixes(rows, 4000)
    assert len(dense) <= len(filter_audit.PREFIXES) * total / 4000 and "one beginning on" in dense and max(map(len, dense)) == 64


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6) | st.text(max_size=4), st.integers(0, 5), st.sampled_from("pq")), max_size=40))
def test_tries(rows):
    trie, copies = Trie(), Counter()

    def leave(terminal):
        for part, n in terminal.rows.items():
            copies[terminal.least, part] += n

    for text, ident, part in rows:
        insert(trie.reach(text), Terminal(0, ident, {part: 1}), leave)
    kept = list(trie.texts())
    assert [t for t, _ in kept] == sorted({t for t, _, _ in rows})
    assert {t: x.least for t, x in kept} == {t: min(i for u, i, _ in rows if u == t) for t, _ in kept}
    leave_all = copies.copy()
    for _, terminal in kept:
        for part, n in terminal.rows.items():
            leave_all[terminal.least, part] += n
    assert leave_all == Counter((i, p) for _, i, p in rows)
    nodes, stack = 0, [trie.root]
    while stack:
        node = stack.pop()
        nodes += 1
        assert node is trie.root or node.terminal or len(node.children) > 1
        stack += node.children.values()
    assert nodes <= 2 * len(kept) + 1
