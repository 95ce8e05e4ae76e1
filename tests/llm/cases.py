"""Documents that hold what an operator must not stumble over."""

LONG = " ".join(f"w{i % 977}" for i in range(30_000))
UNBROKEN = "x" * 20_000
SAME = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
ROWS = [
    (1, SAME, "en", "a", 1),
    (2, SAME, "en", "a", 1),
    (2, SAME, "en", "a", 1),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \t\n ", "en", "b", 4),
    (6, "short", "en", "b", 5),
    (7, LONG, "en", "c", len(LONG)),
    (8, UNBROKEN, "en", "c", len(UNBROKEN)),
    (None, "a text without an id", "en", None, 20),
    (None, None, None, None, None),
    (9, "ünï cödé 日本語 😀 text", "de", "d", 20),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators give to their own columns.
CLASHING = [
    "id", "unit", "bin", "template", "leaf", "position", "n_lines", "n_dropped", "mix_block", "mix_place", "mix_source",
    "tokens", "bucket", "score", "predicted", "text_hash", "set_key", "component", "kept", "part", "length", "start",
    "host", "path", "rule", "key", "verdict", "doc", "positions", "vector", "is_query", "node", "anchors", "head",
]


def documents(spark, rows=ROWS, clashing=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING if clashing else []:
        docs = docs.selectExpr("*", f"cast('own' as string) as {name}")
    return docs


def sorted_rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
