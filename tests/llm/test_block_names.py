"""Exact duplicates: groups, the row that stays, blocks of every size, keys that fail."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lateline.llm.block_names import name_documents
from llm.cases import ROWS, documents


def expected(rows):
    """Per row: keep_id, group_size, kept, hash. Rows equal in id and length are told apart by order."""
    plain = [re.sub(r"[\x20\x09-\x0D]", "", r[1] or "") for r in rows]
    groups = {}
    for n, p in enumerate(plain):
        groups.setdefault(p, []).append(n)
    out = []
    for n, p in enumerate(plain):
        best = min(groups[p], key=lambda k: (-len(rows[k][1] or ""), rows[k][0] is None, rows[k][0] or 0, k))
        out.append((rows[n][0], rows[best][0], len(groups[p]), best == n, hashlib.sha256(p.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(docs, **options):
    named = name_documents(docs, **options)
    return sorted((tuple(r) for r in named.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [3, 64, 4096])
def test_edge_rows(spark, block_bytes):
    assert result(documents(spark, clashing=True), block_bytes=block_bytes) == expected(ROWS)


def test_no_documents(spark):
    assert result(documents(spark, [])) == []


def test_white_space_and_ties(spark):
    rows = [(5, "a b", "", "", 0), (4, "ab", "", "", 0), (3, " a\tb ", "", "", 0), (2, "\na\x0bb\r", "", "", 0), (None, "a  b\x0c", "", "", 0),
            (9, "a\x1cb", "", "", 0), (8, "a b", "", "", 0), (7, "a\x00", "", "", 0), (6, "a", "", "", 0), (7, "a\x00", "", "", 0)]
    assert result(documents(spark, rows), block_bytes=2) == expected(rows)


def test_one_text_holds_a_third_of_all_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 3 = 0, repeat('same text ', 40), concat(id, repeat(' own text', 40)))").alias("text")
    )
    got = name_documents(docs, block_bytes=64).groupBy("kept", "group_size").count().collect()
    assert sorted(map(tuple, got)) == [(False, 1000, 999), (True, 1, 2000), (True, 1000, 1)]


def test_weak_keys_are_noticed(spark):
    rows = [(n, f"text {n} " * 5, "", "", 0) for n in range(40)]
    weak_first = lambda block, seed: F.struct(F.when(F.lit(seed == 0), F.lit(1)).otherwise(F.xxhash64(block)).alias("h"))
    assert result(documents(spark, rows), key=weak_first, block_bytes=8) == expected(rows)
    with pytest.raises(RuntimeError, match="share a key"):
        name_documents(documents(spark, rows), key=lambda block, seed: F.struct(F.lit(1).alias("h")), seeds=2)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("ab \n", max_size=12), min_size=1, max_size=40), st.integers(1, 5))
def test_any_texts(spark, texts, block_bytes):
    rows = [(n // 2, t, "", "", 0) for n, t in enumerate(texts)]
    assert result(documents(spark, rows), block_bytes=block_bytes) == expected(rows)
