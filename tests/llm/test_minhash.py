"""Hashing and block-by-block comparison of the near-dedup, against plain Python."""

import tracemalloc

import numpy as np

from lateline.llm import minhash
from lateline.llm.minhash import SEEDS, SKETCH, SKETCH_SEEDS, Threshold


def test_shingles_lower_ascii_only():
    same = minhash.shingle_set("One TWO\tÄRGER\x0bK İZMİR five SIX")
    assert (same == minhash.shingle_set("one two ÄRGER K İzmİr Five six")).all() and len(same) == 3
    assert not set(same) & set(minhash.shingle_set("one two ärger k i̇zmi̇r five six"))
    assert not len(minhash.shingle_set(None)) and not len(minhash.shingle_set(" \n")) and len(minhash.shingle_set("a B")) == 1


def test_signatures_are_made_within_the_cache():
    shingles = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5_000, dtype=np.uint64))
    for some in (shingles[:1], shingles[:127], shingles[:300], shingles):
        for seeds in (SEEDS, SKETCH_SEEDS):
            values = (some[:, None] ^ seeds[0]) * seeds[1]
            assert (minhash.signature(some, seeds) == values.min(axis=0) >> np.uint64(32)).all()
    tracemalloc.start()
    minhash.signature(shingles, SKETCH_SEEDS)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20


def test_many_small_regions_are_compared_without_a_call_each(spark, monkeypatch):
    """Regions that end in the middle of a batch, of several blocks, and of one text; no task is called once a region."""
    monkeypatch.setattr(minhash, "BLOCK", 5)
    monkeypatch.setattr(minhash, "PAIRS", 16)
    rng, threshold = np.random.default_rng(7), Threshold.of(0.85)
    rows, kinds = [], rng.integers(0, 256, (12, SKETCH))
    for n in range(150):
        sketch = np.where(rng.random(SKETCH) < 0.12, rng.integers(0, 256, SKETCH), kinds[n % 12])
        rows.append((n, int(rng.integers(0, 60)), int(rng.integers(85, 112)), [int(x) for x in rng.integers(0, 9, minhash.TREES)], bytes(sketch.astype(np.uint8))))
    members, want = [], set()
    for tree in (0, 3, 7):
        for region in range(9):
            inside = [r for r in rows if r[3][tree] == region]
            members += [(tree, region, len(inside), *r) for r in inside]
            for a in inside:
                for b in inside:
                    first = next(t for t in range(minhash.TREES) if a[3][t] == b[3][t])
                    agree = sum(x == y for x, y in zip(a[4], b[4])) >= threshold.agree
                    if a[0] > b[0] and a[1] != b[1] and first == tree and agree and minhash_sizes(a[2], b[2], threshold):
                        want.add((a[0], b[0]))
    assert len(want) > 20
    schema = "tree int, region long, region_size long, id long, component long, n_shingles long, regions array<long>, sketch binary"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        pairs = minhash.across_components(spark.createDataFrame(members, schema), threshold)
        got = [tuple(r) for r in pairs.collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(got) == sorted(want)
    assert "FlatMapGroupsInPandas" not in pairs._jdf.queryExecution().executedPlan().toString()


def minhash_sizes(one, other, threshold):
    return min(one, other) * threshold.under >= max(one, other) * threshold.over
