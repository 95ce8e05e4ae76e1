"""Null, empty, long, repeated and clashing input; empty tables. Each has the result that the docstring states."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lateline.llm import cover_tree, line_templates, minhash, mixing, packing, private_data, repeats, syncmers, toxicity, url_rules
from llm.cases import CLASHING, LONG, ROWS, SAME, SCHEMA, UNBROKEN, documents, sorted_rows

OPERATORS = {
    "minhash": minhash.link_documents,
    "mixing": mixing.mix_sources,
    "private_data": lambda docs: private_data.find_private_data(docs, private_data.train(docs)),
    "toxicity": lambda docs: toxicity.score_documents(docs, toxicity.train(docs, labels(docs.sparkSession))),
    "repeats": repeats.remove_repeats,
    "line_templates": line_templates.drop_recurring_lines,
    "packing": packing.pack_documents,
    "syncmers": syncmers.fingerprint_documents,
}


def labels(spark, rows=((1, 0, 1), (2, 1, 0), (7, 1, 0), (7, 0, None), (None, 1, 1))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("name", OPERATORS)
def test_no_documents_no_rows(spark, name):
    assert OPERATORS[name](documents(spark, [])).collect() == []


@pytest.mark.parametrize("name", OPERATORS)
def test_columns_of_other_names_change_nothing(spark, name):
    def own(docs):
        result = OPERATORS[name](docs)
        return result.select([c for c in result.columns if c not in CLASHING or c in ("kept", "start", "length", "n_dropped", "score")])

    plain, clashing = own(documents(spark)), own(documents(spark, clashing=True))
    rounded = lambda df: sorted_rows(df.select([F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes]))
    assert rounded(plain) == rounded(clashing.select(plain.columns))
    if name in ("mixing", "line_templates", "toxicity"):  # these pass columns through
        assert set(clashing.columns) >= set(plain.columns)


def test_minhash(spark):
    got = sorted_rows(minhash.link_documents(documents(spark)), "doc_id", "n_shingles", "component_id", "kept")
    assert [r for r in got if r[0] in (1, 2)] == [(1, 16, 1, True), (2, 16, 1, False), (2, 16, 1, False)]
    assert [r for r in got if r[0] in (3, 4, 5)] == [(n, 0, n, True) for n in (3, 4, 5)]
    assert [r for r in got if r[0] in (6, 8)] == [(6, 1, 6, True), (8, 1, 8, True)]
    assert [r for r in got if r[0] == 7] == [(7, 977, 7, True)]
    assert sorted(r[1] for r in got if r[0] is None) == [0, 1] and all(r[2] is None and r[3] for r in got if r[0] is None)


def test_mixing_loses_no_document_and_repeats_within_the_limit(spark):
    mixed = mixing.mix_sources(documents(spark))
    counts = {(r[0], r[1]): r[2] for r in mixed.groupBy("doc_id", "text").count().collect()}
    assert set(counts) == {(r[0], r[1]) for r in ROWS}
    assert mixed.where("doc_id = 4").count() in (1, 2) and mixed.where("doc_id = 3").count() >= 1
    assert mixed.columns == [*documents(spark).columns, "mix_block", "mix_place"]


def test_private_data(spark):
    seen = documents(spark, [(n, f"her number is +1 ({200 + n}) 555-{1000 + n} or so", "en", "a", 1) for n in range(100)])
    docs = documents(spark, [(1, "call +1 (372) 555-7739, later (372) 555-7739!", "en", "a", 1), (2, None, "en", "a", 1), (3, "", "en", "a", 0), (None, "x@y.zz", None, None, None)])
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in private_data.find_private_data(docs, private_data.train(seen.union(docs))).collect()}
    assert got == {1: [("phone", 5, 22, True), ("phone", 36, 44, False)], 2: [], 3: [], None: [("email", 0, 6, True)]}


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = documents(spark)
    for rows, score in (([(1, 0, 0)], 0.0), ([(1, 0, 1)], 1.0), ([], 0.0)):
        got = toxicity.score_documents(docs, toxicity.train(docs, labels(spark, rows))).select("score", "predicted").distinct().collect()
        assert len(got) == 1 and got[0].score == pytest.approx(score, abs=1e-9) and got[0].predicted == int(score)


def test_repeats(spark):
    got = {(r.doc_id, r.n_words): (r.n_removed, r.kept) for r in repeats.remove_repeats(documents(spark)).collect()}
    assert got[1, 20] == (0, SAME) and got[2, 20] == (20, "")
    assert got[3, 0] == got[4, 0] == got[5, 0] == (0, "") and got[6, 1] == (0, "short") and got[8, 1] == (0, UNBROKEN)
    words = LONG.split()
    assert got[7, 30_000] == (30_000 - 977 - 19 + 19, " ".join(words[:977]))
    assert got[None, 5] == (0, "a text without an id") and got[None, 0] == (0, "")


def test_lines_are_masked_and_texts_hashed_once(spark):
    keys = line_templates.line_keys(documents(spark, [(1, "a b 1\nc d e f\n", "en", "a", 14)]).select("doc_id", "text"), 3, 3)
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and plan.count("split(") == 1
    assert plan.index("posexplode(") < plan.index("AS text_hash")  # below it
    assert [(r.doc_id, r.position, r.template) for r in keys.collect()] == [(1, 0, "a b <*>"), (1, 1, "c d e f")]


def test_line_templates(spark):
    rows = [(n, f"head {n} of page now\nown line number of {'abc'[n % 3]} {n}\nstable tail of all pages", "en", "a", 1) for n in range(12)]
    docs = documents(spark, [*rows, *rows[:1], (50, None, None, None, None), (51, "", "en", "a", 0), (None, rows[0][1], "en", "a", 1)])
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_templates.drop_recurring_lines(docs).collect()}
    assert got[0] == (3, 0, rows[0][1]) and got[50] == (0, 0, None) and got[51] == (1, 0, "")
    assert all(got[n][1] >= 2 and "tail" not in got[n][2] and "head" not in got[n][2] for n in range(1, 12))
    assert got[None][1] >= 2


def test_packing(spark):
    got = packing.pack_documents(documents(spark))
    ends = {}
    for r in got.collect():
        ends.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in ends.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))]
        assert sum(n for _, n in pieces) <= 1024
    by_doc = {r[0]: (r[1], r[2]) for r in got.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens")).collect()}
    assert by_doc[3] == by_doc[4] == (1, 1) and by_doc[2][0] == 2 * by_doc[2][1]
    assert all(total == tokens for doc, (total, tokens) in by_doc.items() if doc != 2)


def test_fingerprints(spark):
    rows = {r.doc_id: r for r in syncmers.fingerprint_documents(documents(spark).where("doc_id IS NOT NULL")).collect()}
    assert rows[1].fingerprint == rows[2].fingerprint and rows[3].fingerprint == rows[4].fingerprint == ""
    assert rows[2].near_next == 1.0 and rows[4].near_next == 1.0 and 0.3 < rows[1].near_edited < 1
    by_id = {r[0]: r[1] or "" for r in ROWS if r[0] is not None}
    order = sorted(by_id, reverse=True)
    for doc, following in zip(order, order[1:] + order[:1]):
        text, n = by_id[doc], len(by_id[doc])
        edited = text[: n - n // 3] + by_id[following][: n // 3]
        assert rows[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[doc].n_chars == n
    one = syncmers.fingerprint_documents(documents(spark, [(None, "a b c", None, None, None)])).collect()
    assert len(one) == 1 and one[0].doc_id is None and one[0].near_next == 1.0


def test_urls(spark):
    urls = ["HTTP://A.WWW.Example.COM/en/x?q#f", "https://example.com", "no scheme", None, "x://y.net/fr/", "x://net/es/a", "a://b://c/d", "q://É.com/", "s://example.com.evil.org/en/"]
    pages = spark.createDataFrame([*enumerate(urls), (0, urls[0]), (None, urls[4])], "page_id long, url string")
    for name in CLASHING:
        pages = pages.selectExpr("*", f"'own' as {name}")
    rules = spark.createDataFrame(
        [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"), ("net", "/fr/", "allow"), (None, "/", "block")],
        "host string, path string, verdict string",
    )
    got = [tuple(r) for r in url_rules.judge_urls(pages, rules).collect()]
    assert got.count((0, "a.www.example.com", "/en/x", "www.example.com/en/", "allow")) == 2
    for row in [
        (1, "example.com", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"),
        (4, "y.net", "/fr/", "net/fr/", "block"), (None, "y.net", "/fr/", "net/fr/", "block"), (5, "net", "/es/a", "net/es/", "block"),
        (6, "b:", "//c/d", None, "allow"), (7, "É.com", "/", "com/", "allow"), (8, "example.com.evil.org", "/en/", None, "allow"),
    ]:
        assert row in got
    assert len(got) == 11
    assert {r[4] for r in url_rules.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
    assert url_rules.judge_urls(pages.limit(0), rules).collect() == []


def test_urls_nested_rules_close_again(spark):
    rules = spark.createDataFrame([("b.c", "/", "block"), ("x.a.b.c", "/", "allow"), ("a.b.c", "/", "block"), ("c", "/k/", "block")], "host string, path string, verdict string")
    hosts = ["b.c", "a.b.c", "x.a.b.c", "y.x.a.b.c", "z.a.b.c", "ab.c", "zz.b.c", "c", "0.b.c", "b.c0"]
    pages = spark.createDataFrame([(h, f"s://{h}/k/") for h in hosts], "page_id string, url string")
    want = {}
    for h in hosts:
        fits = [r for r in [("b.c", "/"), ("x.a.b.c", "/"), ("a.b.c", "/"), ("c", "/k/")] if h == r[0] or h.endswith("." + r[0])]
        want[h] = "".join(max(fits, key=lambda r: (len(r[0] + r[1]), len(r[1])))) if fits else None
    assert {r.page_id: r.rule for r in url_rules.judge_urls(pages, rules).collect()} == want


def test_top_k(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 0.0]), (7, []), (8, [1.0]),
            (9, [-0.001, 0.001]), (50, [1.0, 0.0, 3.0]), (None, [1.0, 1.0]), (1, [0.5, 0.5]), (10, [1e30, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as node", "'x' as part", "1 as ids", "2 as rank", "3 as score")
    got = sorted_rows(cover_tree.top_k(vectors, k=5), "query_id", "rank", "vec_id", "score")
    # 9 is (-1, 0); 8 is 256 and zeros; 7 has no components and scores 0.
    assert got == [(0, 1, 1, 32768), (0, 2, 2, 32768), (0, 3, 8, 32768), (0, 4, 50, 32768), (0, 5, 7, 0),
                   (50, 1, 8, 65536), (50, 2, 0, 32768), (50, 3, 1, 32768), (50, 4, 2, 32768), (50, 5, 7, 0)]
    assert cover_tree.top_k(vectors.limit(0)).collect() == []
    assert cover_tree.top_k(vectors.where("vec_id = 0")).collect() == []


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert corpus_pipeline.run(spark, str(tmp_path)).where("doc_id = 7").count() >= 1
    near = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in near.where("doc_id <= 2").collect()) == [1]
    assert near.where("doc_id IS NULL").count() == 2
