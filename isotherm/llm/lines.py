"""Line deduplication by an exact set-similarity join, in DataFrame functions alone.

A line is the set of its words. A line is removed if an earlier one (by id, then
place in the text) has an equal set, or one with a Jaccard similarity of at least
4/5. Each step covers all lines:

1. Words are counted in 2^21 hash cells, over all lines. A word's number has the
   size class of its cell in front, then its hash; so ordering numbers orders
   words by rarity. The classes are 16 MB, whatever the vocabulary; any order would
   be right, this one is fast. A word whose cell counts one can't be shared and
   leaves the prefixes; sets of less than four words have equal ones only.
2. Equal sets become one node with its earliest line, combined on the map side.
3. Two sets of n words that are similar enough share a word among their first
   n - ceil(4n/5) + 1 in that order (prefix filter). Nodes meet by these words;
   sizes have to fit (length filter), the rest behind the shared word has to be
   long enough (positional filter), and 128 bits of both sets, 64 if one has few
   words, must not differ in more places than similar sets have words of their own
   (bitmap filter).
4. Pairs that meet by words of at most 256 nodes have to share as many words of
   their prefixes as similarity implies (count filter). A word of more nodes is
   not expanded into pairs: its nodes are compared with their earliest one, twice
   more with the earliest that is unresolved, and only what is still unresolved
   then with all earlier ones. Which words these are is counted before, among words
   that are that frequent in all lines; so no group gathered for pairs is large.
5. What is left is verified on the whole sets.

Defined cases: null texts are empty; a line without words is never removed;
order of lines is by id, hash of the text, place; rows that repeat id and text
are one document; a null id comes first.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.llm import frames
from isotherm.llm.frames import texts, width
from isotherm.llm.line_words import CELLS, LEAST_WORDS, NUMBER_BITS, SHORT_WORDS
from isotherm.llm.repeats import NO_ID

#: Spark's setting that removes the shuffle files of a query once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
HUB_ROUNDS = 3
#: Words of at most so many nodes give pairs at once.
FEW = 256
#: Size classes for each doubling of a cell's count.
CLASSES = 4
#: A long with each one bit.
BITS = [1 << i for i in range(63)] + [-1 << 63]


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``frames.stored`` that leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return frames.stored(df, purpose)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def spaced(text: Column) -> Column:
    """Tabs and carriage returns as spaces."""
    return F.replace(F.replace(text, F.lit("\t"), F.lit(" ")), F.lit("\r"), F.lit(" "))


def word_hashes(line: Column) -> Column:
    """The distinct words of a spaced line as hashes."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once for a row, however often the body has it."""
    return F.transform(F.array(value), body)[0]


def low_bits(x: Column, mask: int) -> Column:
    return x.bitwiseAND(F.lit(mask)).cast("int")


def rarity_classes(rows: DataFrame) -> DataFrame:
    """One row: for each cell four times the binary logarithm of its count, 0 for a single word, shifted to its place in a number; CELLS longs at any size of input."""
    words = rows.select(F.explode(F.split(F.replace(spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("word")).where("word <> ''")
    counted = words.groupBy(low_bits(F.xxhash64("word"), CELLS - 1).alias("cell")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = counted.select("cell", F.least(F.lit(127), F.floor(CLASSES * F.log2("n"))).cast("int").alias("size_class")).toArrow()
    classes = np.zeros(CELLS, np.int64)
    classes[found["cell"].to_numpy()] = found["size_class"].to_numpy().astype(np.int64) << NUMBER_BITS
    return _one_row(rows.sparkSession, classes)


def _one_row(spark: SparkSession, classes: np.ndarray) -> DataFrame:
    whole = pa.ListArray.from_arrays(pa.array([0, len(classes)], pa.int32()), pa.array(classes))
    return spark.createDataFrame(pa.table({"classes": whole}))


def number_lines(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, tag, line_no, node, other, n, skipped, low, high, prefix``, one row per line with words.

    ``prefix`` has 31 bits of the words' numbers, as a negative number for words that
    may have more than ``FEW`` nodes. It leaves out the ``skipped`` words in front that
    no other line can have. Each bit of ``low`` is the parity of how many words fall on
    it; ``high``, of long sets alone, is that of every other word.
    """
    split = F.transform(F.split(spaced(F.col("text")), "\n"), lambda line, i: F.struct(i.alias("line_no"), line.alias("line")))
    lines = rows.select("doc_id", "tag", F.explode(split).alias("at")).select("doc_id", "tag", "at.line_no", "at.line")

    # Spark puts the subquery where the column is used, so that no row carries the classes; written there, it is refused.
    known = lines.where(F.trim("line") != "").select("*", classes.scalar().alias("classes"))
    size_class = lambda w: F.coalesce(F.get("classes", w.bitwiseAND(F.lit(CELLS - 1))), F.lit(0).cast("long"))
    numbers = F.transform(word_hashes(F.col("line")), lambda w: size_class(w) + F.shiftrightunsigned(w, 64 - NUMBER_BITS))
    sets = known.select("doc_id", "tag", "line_no", F.sort_array(numbers).alias("words"))
    n, words, none = F.size("words"), F.col("words"), F.lit(0).cast("long")
    in_front = F.when(n >= LEAST_WORDS, prefix_length(n)).otherwise(0)
    single, frequent = 1 << NUMBER_BITS, int(CLASSES * math.log2(FEW)) << NUMBER_BITS

    def parity(masks: list[int]) -> Column:
        table = F.lit(masks).cast("array<long>")
        return F.aggregate(words, none, lambda all_, w: all_.bitwiseXOR(F.get(table, w.bitwiseAND(F.lit(len(masks) - 1)))))

    def short(w: Column) -> Column:
        bits = low_bits(w, 0x7FFFFFFF)
        return F.when(w >= frequent, -1 - bits).otherwise(bits)

    return sets.select(
        "doc_id",
        "tag",
        "line_no",
        F.xxhash64(words).alias("node"),
        F.xxhash64(F.lit(1), words).alias("other"),
        n.alias("n"),
        in_front.alias("in_front"),
        parity(BITS).alias("low"),
        F.when(n > SHORT_WORDS, parity([0] * 64 + BITS)).otherwise(none).alias("high"),
        F.transform(F.filter(F.slice(words, 1, in_front), lambda w: w >= single), short).alias("prefix"),
    ).select("doc_id", "tag", "line_no", "node", "other", "n", (F.col("in_front") - F.size("prefix")).alias("skipped"), "low", "high", "prefix")


def similar(both: Column, n_a: Column, n_b: Column) -> Column:
    """``both`` has to be 4/5 of the union, ``n_a + n_b - both``; it stands here once, as it may be dear."""
    return 9 * both >= 4 * (n_a + n_b)


def _nodes(lines: DataFrame) -> DataFrame:
    """Equal sets as one, with what its earliest line has: ``node, other, first, n, skipped, low, high, prefix``; two hashes name a set."""
    line = F.struct("doc_id", "tag", "line_no", "n", "skipped", "low", "high", "prefix")
    first = F.struct(*(F.col(f"line.{name}").alias(name) for name in ("doc_id", "tag", "line_no"))).alias("first")
    rest = (f"line.{name}" for name in ("n", "skipped", "low", "high", "prefix"))
    return lines.groupBy("node", "other").agg(F.min(line).alias("line")).select("node", "other", first, *rest)


def prefix_length(n: Column) -> Column:
    return n - F.ceil(4 * n / F.lit(5)).cast("int") + 1


def _hot(nodes: DataFrame) -> DataFrame:
    """``word``: those of more than ``FEW`` nodes."""
    words = nodes.select(F.explode("prefix").alias("word")).where("word < 0")
    return words.groupBy("word").count().where(F.col("count") > FEW).select("word")


def _met(nodes: DataFrame, hot: DataFrame, partitions: int) -> DataFrame:
    """Pairs ``a < b`` with ``n, m`` that pass the filters, a row for each word of few nodes by which they meet.

    A row is kept small: of a word 31 bits go, which may bring different words
    together, but keeps no equal ones apart.
    """
    size = F.shiftleft(F.col("n").cast("long"), 32) + F.col("place") + F.col("skipped")
    entries = nodes.select("node", "n", "skipped", "low", "high", F.posexplode("prefix").alias("place", "word"))
    entries = entries.join(hot, "word", "left_anti").select("word", "node", size.alias("size"), "low", "high")
    members = F.collect_list(F.struct("node", "size", "low", "high"))
    groups = entries.repartition(partitions, "word").groupBy("word").agg(members.alias("members")).where(F.size("members") > 1)
    one = groups.select("members", F.posexplode("members").alias("before", "b"))
    both = one.select("b", F.explode(F.slice("members", 1, F.col("before"))).alias("a"))

    def unpacked(x: str) -> list[Column]:
        parts = {"node": F.col(f"{x}.node"), "n": F.shiftright(f"{x}.size", 32).cast("int"), "place": low_bits(F.col(f"{x}.size"), 0x7FFFFFFF)}
        return [c.alias(f"{x}_{name}") for name, c in (parts | {half: F.col(f"{x}.{half}") for half in ("low", "high")}).items()]

    fitting = both.select(*unpacked("a"), *unpacked("b")).where((F.col("a_node") != F.col("b_node")) & _fits("a_", "b_"))
    turned = F.col("a_node") > F.col("b_node")
    ordered = lambda x, y: F.when(turned, F.col(y)).otherwise(F.col(x))
    return fitting.select(ordered("a_node", "b_node").alias("a"), ordered("b_node", "a_node").alias("b"), ordered("a_n", "b_n").alias("n"), ordered("b_n", "a_n").alias("m"))


def _with_few(met: DataFrame) -> DataFrame:
    """Pairs ``a < b`` that share enough of their prefixes, for words of few nodes.

    With an overlap of at least ``o``, the k-th common word is among the first
    k + n - o words of a set; so that many common words lie in both prefixes.
    """
    n, m = F.col("n"), F.col("m")
    pairs = met.groupBy("a", "b", "n", "m").agg(F.count(F.lit(1)).alias("common"))
    least = F.ceil(4 * (n + m) / F.lit(9)).cast("int")
    enough = F.least(prefix_length(n) - (n - least), prefix_length(m) - (m - least))
    return pairs.where(F.col("common") >= enough).select("a", "b")


def _fits(one: str, two: str) -> Column:
    """Length filter, positional filter for a word at both places, and bitmap filter.

    Each bit in which two sets differ stands for a word of its own that one set
    alone has; similar sets differ in at most a ninth of their words together.
    """
    n, m, i, j = F.col(f"{one}n"), F.col(f"{two}n"), F.col(f"{one}place"), F.col(f"{two}place")
    lengths = 5 * F.least(n, m) >= 4 * F.greatest(n, m)
    places = 9 * (F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)) >= 4 * (n + m)
    low, high = (F.col(f"{one}{half}").bitwiseXOR(F.col(f"{two}{half}")) for half in ("low", "high"))
    long = F.least(n, m) > SHORT_WORDS
    apart = F.when(long, F.bit_count(low.bitwiseXOR(high)) + F.bit_count(high)).otherwise(F.bit_count(low))
    return lengths & (9 * apart <= n + m) & places


def _with_many(nodes: DataFrame, hot: DataFrame) -> DataFrame:
    """``word, node, place, n, low, high, first`` of the words of many nodes."""
    entries = nodes.select("*", F.explode("prefix").alias("word")).where("word < 0").join(hot, "word", "left_semi")
    place = (F.array_position("prefix", F.col("word")) - 1).cast("int") + F.col("skipped")
    return entries.select("word", "node", place.alias("place"), "n", "low", "high", "first")


def _early() -> Column:
    return F.struct("first", "node", "n", "place", "low", "high")


def _hubs(open_ones: DataFrame, before: DataFrame | None) -> DataFrame:
    """``word, hub``: each word's earliest unresolved node behind its hub of the round before."""
    if before is not None:
        last = before.select("word", F.col("hub.first").alias("last"))
        open_ones = open_ones.join(last, "word").where(F.col("first") > F.col("last"))
    return open_ones.groupBy("word").agg(F.min(_early()).alias("hub"))


def _candidates(open_ones: DataFrame, hubs: DataFrame) -> DataFrame:
    """Pairs of an earlier node ``a`` and an unresolved ``b`` that pass the filters."""
    met = open_ones.join(hubs, "word").where(F.col("hub.first") < F.col("first"))
    return met.where(_fits("", "hub.")).select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Those pairs that are similar on whole sets, which are made of the earliest lines of the nodes in ``pairs`` alone."""
    pairs = stored(pairs, "pairs")
    asked = nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi").select("node", "first.*")
    asked = stored(asked.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("line_no", "node")).alias("asked")), "asked")
    holders = rows.join(asked, ["doc_id", "tag"]).dropDuplicates(["doc_id", "tag"])
    lines = bound(F.split(spaced(F.col("text")), "\n"), lambda parts: F.transform("asked", lambda x: F.struct(x["node"].alias("node"), F.get(parts, x["line_no"]).alias("line"))))
    bodies = holders.select(F.explode(lines).alias("at")).select("at.node", word_hashes(F.col("at.line")).alias("words"))
    sets = stored(bodies, "sets")
    found = pairs.join(sets.withColumnsRenamed({"node": "a", "words": "words_a"}), "a")
    found = found.join(sets.withColumnsRenamed({"node": "b", "words": "words_b"}), "b")
    both = F.size(F.array_intersect("words_a", "words_b"))
    return found.where(similar(both, F.size("words_a"), F.size("words_b"))).select("a", "b")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, removed, near``: places of the lines to remove, for documents that have any.

    ``text_hash`` (``xxhash64(text)``) tells rows of one id apart; ``near`` counts the
    lines that go for a similar, not an equal one. A null id is shown as null.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    classes = rarity_classes(rows)

    lines = stored(number_lines(rows, classes), "lines")
    nodes = stored(_nodes(lines), "nodes")
    hot = stored(_hot(nodes), "hot")
    met = stored(_met(nodes, hot, width(rows)), "met")

    # Of two similar nodes the one whose first line comes later goes.
    first = nodes.select("node", "first")
    ordered = _verified(_with_few(met), nodes, rows).join(first.withColumnsRenamed({"node": "a", "first": "first_a"}), "a")
    ordered = ordered.join(first.withColumnsRenamed({"node": "b", "first": "first_b"}), "b")
    later_one = F.when(F.col("first_a") < F.col("first_b"), F.col("b")).otherwise(F.col("a"))
    similar_ones = stored(ordered.select(later_one.alias("node")).distinct(), "found")
    members = stored(_with_many(nodes, hot).join(similar_ones.withColumn("near", F.lit(True)), "node", "left"), "members")
    open_ones, hubs = members.where("near IS NULL").drop("near"), None
    for turn in range(HUB_ROUNDS + 1):
        if open_ones.isEmpty():
            break
        if turn < HUB_ROUNDS:
            hubs = stored(_hubs(open_ones, hubs), "hubs")
        else:
            hubs = members.select("word", _early().alias("hub"))
        found = stored(_verified(_candidates(open_ones, hubs), nodes, rows).select(F.col("b").alias("node")).distinct(), "found")
        similar_ones = similar_ones.unionByName(found)
        # Not stored: a round settles few nodes, so that what is left is about as large as the members.
        open_ones = open_ones.join(found, "node", "left_anti")

    later = nodes.select("node", "other", "first").join(similar_ones.distinct().withColumn("near", F.lit(True)), "node", "left")
    marked = lines.select("doc_id", "tag", "line_no", "node", "other").join(later, ["node", "other"])
    is_first = F.struct("doc_id", "tag", "line_no") == F.col("first")
    marked = marked.select("doc_id", "tag", "line_no", F.coalesce("near", F.lit(False)).alias("near"), is_first.alias("is_first"))
    gone = marked.where("near OR NOT is_first").distinct()
    near = F.count_if(F.col("near") & F.col("is_first")).alias("near")
    by_doc = gone.groupBy("doc_id", "tag").agg(F.sort_array(F.collect_list("line_no")).alias("removed"), near)
    return by_doc.select(F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), F.col("tag").alias("text_hash"), "removed", "near")


def without_lines(text: Column, removed: Column) -> Column:
    """The text without the lines at the given places."""

    def left(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed)
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    return bound(F.split(text, "\n"), left)


def line_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_removed, n_near, kept_sha256``.

    ``kept_sha256`` is the digest of the remaining lines, joined again. Only texts
    that lose a line are brought together with their list of places.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col).withColumn("tag", F.xxhash64("text"))
    removed = removed_lines(docs, id_col, text_col).withColumnsRenamed({"doc_id": "removed_id", "text_hash": "removed_tag"})
    removed = stored(removed, "removed")
    same = (F.coalesce("doc_id", F.lit(NO_ID)) == F.coalesce("removed_id", F.lit(NO_ID))) & (F.col("tag") == F.col("removed_tag"))
    digest = F.sha2(without_lines(F.col("text"), F.col("removed")), 256)
    changed = rows.join(removed, same).select("removed_id", "removed_tag", "removed", "near", digest.alias("rest")).distinct()
    whole = rows.select("doc_id", "tag", F.size(F.split("text", "\n")).alias("n_lines"), F.sha2("text", 256).alias("whole"))
    return whole.join(changed, same, "left").select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
        F.coalesce("rest", "whole").alias("kept_sha256"),
    )
