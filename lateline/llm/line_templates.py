"""Line dedup with a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its leading tokens, tokens with a digit counting as variable. In a
leaf the lines are generalised: at each position the token that most of the leaf's lines share stays, the others become
variable. A leaf whose template keeps enough constant tokens stands for one kind of line (a heading with a changing date,
a licence line with a changing name). Lines that follow no template so far are split, within their leaf, by the most
frequent token that each has and not nearly all share, and the groups are generalised in turn, so that a leaf can hold
several templates among unrelated lines. What is left after ``levels`` rounds only recurs as it is. A template that recurs
across documents is dropped everywhere but in the first document that has it.

All of it is grouping and joining: line keys first, 64-bit hashes and positions; only leaves with enough lines are looked
at token by token; the texts themselves move once, to lose their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

VARIABLE = "<*>"
WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*"
SPACE = r"[\x20\x09-\x0D]+"
#: What tells a line from all others.
WHERE = ["doc_id", "text_hash", "position"]
OTHER_SPACE = "\t\v\f\r"


def masked(line: Column) -> Column:
    """The line with single spaces, tokens that hold a digit made variable. Lines that need neither are left alone."""
    spaced = F.regexp_replace(F.regexp_replace(line, SPACE, " "), "^ | $", "")
    # Plain searches: one pattern with alternatives takes several times as long, and nearly no line needs it.
    uneven = line.contains("  ") | line.startswith(" ") | line.endswith(" ")
    for space in OTHER_SPACE:
        uneven |= line.contains(space)
    even = F.when(uneven, spaced).otherwise(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(even, WITH_DIGIT, VARIABLE)).otherwise(even)


def line_keys(docs: DataFrame, depth: int, min_tokens: int) -> DataFrame:
    """A row for each line of enough tokens: its document, position, leaf (hashed) and masked text."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    lines = texts.select("doc_id", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
    # An array of one, exploded: the conditions below stay above it. As a plain column the line would be masked again for
    # each place that uses it; likewise a text is hashed before its lines are taken apart, not line by line.
    lines = lines.select("doc_id", "text_hash", "position", F.explode(F.array(masked(F.col("line")))).alias("template"))
    tokens = F.length("template") - F.length(F.replace("template", F.lit(" "), F.lit(""))) + 1
    # Blank lines separate paragraphs, and one or two variable tokens say nothing in common.
    bare = F.col("template").isin("", VARIABLE, f"{VARIABLE} {VARIABLE}")
    return lines.withColumn("tokens", tokens).where((F.col("tokens") >= min_tokens) & ~bare).select(
        "doc_id",
        "text_hash",
        "position",
        F.xxhash64("tokens", F.substring_index("template", " ", depth)).alias("leaf"),
        "template",
    )


def leaf_templates(lines: DataFrame, support: float, constant: float) -> DataFrame:
    """Leaves whose generalised template keeps at least the share ``constant`` of its tokens."""
    tokens = lines.select("leaf", "lines", F.posexplode(F.split("template", " ")).alias("at", "token"))
    counted = tokens.groupBy("leaf", "at", "token").agg(F.count("*").alias("n"), F.any_value("lines").alias("lines"))
    best = counted.groupBy("leaf", "at").agg(
        F.max_by("token", F.struct("n", "token")).alias("token"), (F.max("n") / F.any_value("lines")).alias("share")
    )
    kept = F.when(F.col("share") >= support, F.col("token")).otherwise(F.lit(VARIABLE))
    return (
        best.groupBy("leaf")
        .agg(F.array_sort(F.collect_list(F.struct("at", kept.alias("token")))).alias("tokens"))
        .select("leaf", F.transform("tokens", lambda t: t["token"]).alias("leaf_tokens"))
        .withColumn("constants", F.size(F.filter("leaf_tokens", lambda t: t != VARIABLE)))
        .where(F.col("constants") >= F.lit(constant) * F.size("leaf_tokens"))
    )


def split_groups(lines: DataFrame, support: float, least: int) -> DataFrame:
    """Lines by the group of their leaf they belong to next; those without one have no row.

    A line goes by its most frequent token that ``least`` lines of its leaf have, in this place, and that fewer than the
    share ``support`` of them do.
    """
    tokens = lines.select("leaf", *WHERE, F.posexplode(F.split("template", " ")).alias("at", "token")).where(F.col("token") != VARIABLE)
    sizes = lines.groupBy("leaf").agg(F.count("*").alias("lines"))
    frequent = (
        tokens.groupBy("leaf", "at", "token").agg(F.count("*").alias("n")).where(F.col("n") >= least)
        .join(sizes, "leaf").where(F.col("n") < F.lit(support) * F.col("lines")).drop("lines")
    )
    best = F.max_by(F.struct("at", "token"), F.struct("n", -F.col("at"), "token")).alias("by")
    groups = tokens.join(frequent, ["leaf", "at", "token"]).groupBy("leaf", *WHERE).agg(best)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("leaf", *WHERE)]
    return lines.alias("l").join(groups.alias("g"), same).select(
        F.xxhash64("l.leaf", "g.by.at", "g.by.token").alias("leaf"), *[f"l.{c}" for c in WHERE], "l.template"
    )


def recurring_lines(
    docs: DataFrame, *, depth: int, min_tokens: int, min_documents: int, support: float, constant: float, levels: int
) -> DataFrame:
    """Positions of the lines to drop: doc_id, text_hash, positions (ascending).

    Keys of all lines are stored as numbers; the masked texts are made again for leaves of enough lines only.
    """
    scratch = Scratch(docs.sparkSession, "line_templates")
    lines = line_keys(docs, depth, min_tokens)
    keys = scratch.keep(lines.withColumn("template", F.xxhash64("template")), "keys")

    def enough(grouped: DataFrame) -> DataFrame:
        return grouped.groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") >= min_documents)

    large = scratch.keep(enough(keys), "large")
    large_lines = scratch.keep(lines.join(large, "leaf"), "large_lines")
    keyed = keys.join(large, "leaf", "left_anti").select(*WHERE, "template")
    for level in range(1, levels + 1):
        leaves = scratch.keep(leaf_templates(large_lines, support, constant), f"leaves-{level}")
        # A line follows its leaf's template if it has the share ``support`` of the constant tokens.
        own = F.zip_with(F.split("template", " "), "leaf_tokens", lambda a, b: (b != VARIABLE) & (a == b))
        follows = F.size(F.filter(own, lambda same: same)) >= F.lit(support) * F.col("constants")
        sorted_out = large_lines.join(leaves, "leaf", "left").select(
            "leaf", *WHERE, "template", F.coalesce(follows, F.lit(False)).alias("follows")
        )
        if level < levels:
            sorted_out = scratch.keep(sorted_out, f"sorted_out-{level}")
        keyed = keyed.union(sorted_out.where("follows").select(*WHERE, F.xxhash64("leaf", F.lit("leaf"))))
        rest = sorted_out.where("NOT follows")
        if level == levels:
            keyed = keyed.union(rest.select(*WHERE, F.xxhash64("template")))
            break
        # Copies of a document have the same lines in the same places.
        rest = rest.dropDuplicates(["leaf", *WHERE])
        grouped = scratch.keep(split_groups(rest, support, min_documents), f"grouped-{level}")
        large_lines = scratch.keep(grouped.join(enough(grouped), "leaf"), f"large_lines-{level}")
        alone = [rest[c].eqNullSafe(large_lines[c]) for c in WHERE]
        keyed = keyed.union(rest.join(large_lines, alone, "left_anti").select(*WHERE, F.xxhash64("template")))
    keyed = scratch.keep(keyed, "lines")
    # Exact copies of a document count once; taking copies out is another operator's work.
    texts = keyed.groupBy("template", "text_hash").agg(F.min("doc_id").alias("doc_id"))
    recurring = scratch.keep(
        texts.groupBy("template")
        .agg(F.count("*").alias("texts"), F.min("doc_id").alias("first_doc"))
        .where(F.col("texts") >= min_documents),
        "recurring",
    )
    return (
        keyed.join(recurring, "template")
        .where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
        .groupBy("doc_id", "text_hash")
        .agg(F.array_sort(F.collect_set("position")).alias("positions"))
    )


def drop_recurring_lines(
    docs: DataFrame,
    *,
    depth: int = 3,
    min_tokens: int = 3,
    min_documents: int = 10,
    support: float = 0.8,
    constant: float = 0.7,
    levels: int = 1,
) -> DataFrame:
    """The documents without the lines whose template recurs in ``min_documents`` different texts, plus ``n_lines`` and
    ``n_dropped``.

    ``depth`` leading tokens lead to a leaf. A leaf's token is constant if the share ``support`` of its lines have it; the
    leaf counts as one template if the share ``constant`` of its tokens are, and a line follows it if it agrees in the
    share ``support`` of them. With more than one of the ``levels``, the other lines of a leaf are split into groups that
    are treated as leaves in turn. Lines under ``min_tokens`` tokens always stay, as do blank ones and those of one or two
    tokens that are all variable. The document of the smallest id that has a template keeps its lines; a null id is larger than any other.

    A null text stays null and has 0 lines; an empty one has one line, empty. Rows of the same id and text lose the same
    lines. Other columns pass through; of the names ``n_lines`` and ``n_dropped`` the new columns win. No documents: no
    rows.
    """
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drops = recurring_lines(
        docs.select("doc_id", "text"),
        depth=depth, min_tokens=min_tokens, min_documents=min_documents, support=support, constant=constant, levels=levels,
    ).select(F.col("doc_id").alias("drop_doc"), "text_hash", "positions")
    rows = docs.select(F.struct(*[F.col(c) for c in columns]).alias("doc"), F.xxhash64("text").alias("doc_hash"))
    same = F.col("doc.doc_id").eqNullSafe(F.col("drop_doc")) & (F.col("doc_hash") == F.col("text_hash"))
    joined = rows.join(drops, same, "left")
    split = F.split("doc.text", "\n", -1)
    # What lies between two dropped lines, and at either end, stays: as many slices as dropped lines, and one.
    slices = F.transform(F.array(F.struct(split.alias("lines"), F.concat(F.array(F.lit(-1)), "positions", F.array(F.size(split))).alias("ends"))),
        lambda x: F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(x["ends"]) - 1),
            lambda i: F.slice(x["lines"], F.element_at(x["ends"], i) + 2, F.element_at(x["ends"], i + 1) - F.element_at(x["ends"], i) - 1),
        )))[0]
    text = F.when(F.col("positions").isNull(), F.col("doc.text")).otherwise(F.array_join(slices, "\n"))
    return joined.select(
        *[(text if c == "text" else F.col("doc")[c]).alias(c) for c in columns],
        F.when(F.col("doc.text").isNull(), F.lit(0)).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce(F.size("positions"), F.lit(0)).cast("long").alias("n_dropped"),
    )
