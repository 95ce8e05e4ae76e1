"""Document fingerprints from closed syncmers.

Every eight neighbouring code points are hashed, the inner substrings. A run of three neighbouring ones is a closed syncmer
if the least of them is the first or the last one. Whether it is depends on its own code points alone, so an edit
elsewhere neither adds nor removes anchors, and two thirds of all runs are anchors. The unit is the same for short and
long texts, with spaces or without. The fingerprint keeps a fixed share of all hashes, the least ones, so it grows with
the text, and at least the ``ANCHORS`` least (a sample that two texts share as far as they share anchors). Each anchor has its
position, in blocks of code points.

Two fingerprints are alike in the share of common anchors among the hashes that both would hold, counting those whose
positions are shifted alike: that finds moved text and tells it from scattered chance matches.

Only functions of columns are used. Texts are gone through by ``explode``: hashes, rule and a cut by hash are generated
code over one row for each position, of which few come out. ``anchors`` says the same in one expression.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lateline.llm.storage import Scratch

#: Code points of a unit, units of a run, and code points of a block, in which positions are counted.
UNIT, RUN, BLOCK = 8, 3, 32
#: Least number of anchors in a fingerprint; bits of a packed anchor that hold its position; blocks that positions may drift.
ANCHORS, POSITION_BITS, DRIFT = 48, 24, 6
#: One in so many hashes is in every fingerprint: those up to the limit.
SHARE = 32
LIMIT = -(1 << (63 - POSITION_BITS)) + (1 << (64 - POSITION_BITS)) // SHARE
NO_ID = -(1 << 63)
#: Anchors that the cut by hash leaves of a text on average, where it has so many; far more than ``ANCHORS``.
EXPECTED = 120


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def packed(hash_: Column, position: Column) -> Column:
    """The upper bits of the hash and, below them, the position: sorted, anchors come by hash and then by position."""
    high = F.shiftleft(F.shiftright(hash_, POSITION_BITS), POSITION_BITS)
    return high.bitwiseOR(position.cast("long").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)))


def hash_of(anchor: Column) -> Column:
    return F.shiftright(anchor, POSITION_BITS)


def position_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << POSITION_BITS) - 1))


def _closed(units: Column) -> Column:
    """Packed anchors of the runs whose least unit is at an edge."""
    runs = F.filter(
        F.sequence(F.lit(1), F.size(units) - 2),
        lambda i: F.element_at(units, i + 1) >= F.least(F.element_at(units, i), F.element_at(units, i + 2)),
    )
    place = lambda i: F.shiftright(i - 1, BLOCK.bit_length() - 1)
    return F.transform(runs, lambda i: packed(F.xxhash64(F.element_at(units, i), F.element_at(units, i + 2)), place(i)))


def _least(anchors: Column) -> Column:
    """The share of least hashes, and the least in any case, each hash at its first position."""
    first = F.filter(anchors, lambda a, i: (i == 0) | (hash_of(a) != hash_of(F.get(anchors, i - 1))))
    return F.filter(first, lambda a, i: (i < ANCHORS) | (hash_of(a) <= LIMIT))


def anchors(text: Column) -> Column:
    """Packed anchors of a text. One too short for a run has a single anchor, all of it; an empty one has none."""
    # Four bytes for each code point: parts of binary values are cut out without going through what lies before.
    def units(points: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(points) - (4 * UNIT - 1), F.lit(4))
        return F.transform(starts, lambda i: F.xxhash64(F.substring(points, i, F.lit(4 * UNIT))))

    found = bound(bound(F.encode(text, "UTF-32"), units), lambda u: bound(F.sort_array(_closed(u)), _least))
    short = F.array(packed(F.xxhash64(text), F.lit(0)))
    return F.when(text == "", F.array().cast("array<bigint>")).when(F.length(text) < UNIT + RUN - 1, short).otherwise(found)


def _cut(n: Column) -> Column:
    """The largest hash that is looked at in a text of n code points, two thirds of whose places are anchors."""
    share = F.least(F.lit(1.0), F.lit(1.5 * EXPECTED) / n)
    return F.greatest(F.floor(share * F.lit(float(1 << (64 - POSITION_BITS)))).cast("long"), F.lit((1 << (64 - POSITION_BITS)) // SHARE)) - F.lit(1 << (63 - POSITION_BITS))


def collect_anchors(texts: DataFrame, keys: list[str], text: str, *measures: str, whole: bool = False) -> DataFrame:
    """By key: the packed anchors of its text, the text's length ``n`` and the measures, and ``lacking``: whether fewer
    than ``ANCHORS`` were left below the cut, so that the text must be gone through ``whole``.

    Texts of equal keys are equal. A text's positions are rows in the task that has the text only; those left are
    combined there, so a key that very many rows have is one row a task.
    """
    points = texts.select(*keys, F.col(text).alias("written"), F.length(text).cast("long").alias("n"), *measures).withColumn("points", F.encode("written", "UTF-32"))
    # Position 0 stands for the text as a whole.
    positions = F.when(F.col("n") >= UNIT + RUN - 1, F.sequence(F.lit(1), F.octet_length("points") - (4 * (UNIT + RUN - 1) - 1), F.lit(4))).otherwise(F.array())
    placed = points.withColumn("at", F.explode(F.concat(F.array(F.lit(0)), positions)))
    unit = lambda k: F.xxhash64(F.substring(F.col("points"), F.col("at") + 4 * k, F.lit(4 * UNIT)))
    closed = placed.where((F.col("at") == 0) | (unit(1) >= F.least(unit(0), unit(2))))
    anchor = packed(F.xxhash64(unit(0), unit(2)), F.shiftright(F.col("at") - 1, 2 + BLOCK.bit_length() - 1))
    found = closed.withColumn("anchor", F.when(F.col("at") > 0, anchor))
    if not whole:
        found = found.where((F.col("at") == 0) | (hash_of(F.col("anchor")) <= _cut(F.col("n"))))
    is_short = (F.col("at") == 0) & (F.col("n") > 0) & (F.col("n") < UNIT + RUN - 1)
    found = found.withColumn("anchor", F.when(is_short, packed(F.xxhash64("written"), F.lit(0))).otherwise(F.col("anchor")))
    head = F.col("at") == 0
    grouped = found.groupBy(*keys).agg(
        F.collect_set("anchor").alias("set"), F.max("n").alias("n"), *[F.max(F.when(head, F.col(m))).alias(m) for m in measures]
    )
    kept = grouped.withColumn("anchors", bound(F.sort_array("set"), _least)).drop("set")
    lacking = F.lit(False) if whole else (F.col("n") > 1.5 * EXPECTED) & (F.size("anchors") < ANCHORS)
    return kept.withColumn("lacking", lacking)


def as_text(anchors_: Column) -> Column:
    """``hash:position``, hashes in hexadecimal, joined by commas."""
    unsigned = F.shiftrightunsigned
    return F.array_join(
        F.transform(anchors_, lambda a: F.concat(F.lower(F.hex(unsigned(a, POSITION_BITS))), F.lit(":"), position_of(a).cast("string"))), ","
    )


def likeness(one: Column, other: Column) -> Column:
    """From 0 to 1; 1 for equal fingerprints, empty ones included."""

    def sided(anchors_: Column, side: int) -> Column:
        return F.transform(anchors_, lambda a: F.struct(hash_of(a).alias("hash"), F.lit(side).alias("side"), position_of(a).alias("position")))

    def share(both: Column) -> Column:
        def among(hashes: Column) -> Column:
            """Both fingerprints hold all hashes of their texts up to the limit, and the least ``ANCHORS`` of their union."""
            total = F.least(F.size(hashes), F.greatest(F.lit(ANCHORS), F.size(F.filter(hashes, lambda h: h <= LIMIT))))
            return bound(total, lambda n: bound(F.get(hashes, n - 1), lambda last: met(n, last)))

        def met(total: Column, last: Column) -> Column:
            """What a lambda uses is bound outside of it; an expression inside would be computed again for each anchor."""
            following = lambda i: F.get(both, i + 1)
            moved = F.transform(both, lambda a, i: F.when((a["hash"] <= last) & (a["hash"] == following(i)["hash"]), a["position"] - following(i)["position"]))
            shifts = F.sort_array(F.filter(moved, lambda s: s.isNotNull()))
            middle = lambda s: F.get(s, F.shiftright(F.size(s), 1))
            alike = bound(shifts, lambda s: bound(middle(s), lambda m: F.size(F.filter(s, lambda x: F.abs(x - m) <= DRIFT))))
            return alike / F.greatest(total, F.lit(1))

        return bound(F.array_distinct(F.transform(both, lambda a: a["hash"])), among)

    both = F.sort_array(F.concat(sided(one, 0), sided(other, 1)))
    return F.when(one == other, F.lit(1.0)).otherwise(bound(both, share))


def next_documents(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """The key (id, text_hash) that follows each key (own_id, own_hash) by descending id; the first follows the last.

    Keys are range-partitioned and looked through partition by partition; the first key of each partition, one row,
    is what follows the last of the one before.
    """
    order = [F.col("id").desc(), F.col("text_hash")]
    parts = scratch.keep(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "keys")
    firsts = parts.groupBy("part").agg(F.max_by(F.struct("id", "text_hash"), F.struct("id", -F.col("text_hash").cast("decimal(20)"))).alias("first"))
    by_part = Window.orderBy("part")
    whole = by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = firsts.select("part", F.coalesce(F.lead("first").over(by_part), F.first("first").over(whole)).alias("following"))
    within = Window.partitionBy("part").orderBy(*order)
    return (
        parts.withColumn("next", F.lead(F.struct("id", "text_hash")).over(within))
        .join(following, "part")
        .withColumn("next", F.coalesce("next", "following"))
        .select(F.col("id").alias("own_id"), F.col("text_hash").alias("own_hash"), "third", "next.id", "next.text_hash")
    )


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how near they and the next document's are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. In the edited text
    the last third of the code points, rounded down, is replaced by as many from the beginning of the next document, or
    all that it has. The next document has the next smaller id; after the smallest comes the largest.

    Null texts count as empty; an empty text has an empty fingerprint, which is near (1) to other empty ones only. A null
    id (or the least long) comes last and is returned as null. Rows of equal id are ordered by a hash of their text;
    rows of equal id and text count as one document and get the same values. A single document is its own next. No
    documents: no rows. Columns other than ``doc_id`` and ``text`` are not read.
    """
    scratch = Scratch(docs.sparkSession, "syncmers")
    key, own = ["id", "text_hash"], ["own_id", "own_hash"]
    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("text_hash", F.xxhash64("text"))
    keys = texts.select("id", "text_hash", F.floor(F.length("text") / 3).cast("int").alias("third")).distinct()
    links = scratch.keep(next_documents(keys, scratch), "links")

    def edited_texts(links: DataFrame, own_texts: DataFrame) -> DataFrame:
        """The edited texts of the documents that the links begin at."""
        heads = texts.join(links, key).select(*own, F.expr("substring(text, 1, third)").alias("head")).groupBy(*own).agg(F.any_value("head").alias("head"))
        rest = F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 3) AS int))")
        joined = own_texts.join(heads, (F.col("id") == F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")))
        edited = joined.select(*key, F.length("text").cast("long").alias("n_chars"), F.concat(rest, "head").alias("edited"))
        return edited.withColumn("edited_sha256", F.sha2("edited", 256))

    def edited_again(some: DataFrame) -> DataFrame:
        """Of some documents only. Their links are stored, as only a table's own size tells Spark that it is small, and
        texts that aren't theirs go before a shuffle."""
        few = scratch.keep(links.join(some.toDF(*own), own, "left_semi"), "edited-links")
        return edited_texts(few, texts.join(some, key, "left_semi"))

    def prints(of: Callable[[DataFrame | None], DataFrame], text: str, *measures: str) -> DataFrame:
        """Anchors of all texts; those that the cut left too few of are made again from their whole texts."""
        first = scratch.keep(collect_anchors(of(None), key, text, *measures), text)
        lacking = scratch.keep(first.where("lacking").select(*key), f"{text}-lacking")
        if lacking.isEmpty():
            return first
        again = scratch.keep(collect_anchors(of(lacking), key, text, *measures, whole=True), f"{text}-whole")
        return first.where("NOT lacking").union(again)

    owns = prints(lambda some: texts if some is None else texts.join(some, key, "left_semi"), "text")
    edits = prints(lambda some: edited_texts(links, texts) if some is None else edited_again(some), "edited", "edited_sha256", "n_chars")

    following = owns.select(*key, F.col("anchors").alias("next_anchors")).join(links.select(*own, *key), key).select(*own, "next_anchors")
    near = (
        edits.select(*key, "n_chars", "edited_sha256", F.col("anchors").alias("edited_anchors"))
        .join(owns.select(*key, "anchors"), key)
        .join(following.toDF(*key, "next_anchors"), key)
    )
    prints_of = near.select(
        *key, "n_chars", "edited_sha256",
        as_text(F.col("anchors")).alias("fingerprint"),
        as_text(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
    # A row for each row of the documents; rows of equal id and text share one. Only keys are shuffled for it.
    return texts.select(*key).join(prints_of, key).select(F.nullif("id", F.lit(NO_ID)).alias("doc_id"), *prints_of.columns[2:])
