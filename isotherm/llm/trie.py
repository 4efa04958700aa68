"""Prefix tree over conversations, from sorted matrices of turn ids.

Every conversation is a row of turn ids, padded to the longest of its shard. A
shard's rows are sorted by ``numpy.lexsort``; where a column differs from the row
above, it and all columns behind it start new nodes, so the change masks are
OR-accumulated along a row. ``reduceat`` between the starts of a depth aggregates
all nodes of that depth at once.

Shards are ranges of (turn ids, conversation), so that equal conversations may lie
in several: no group is too large for a task. A node is whole in its shard unless
it touches the shard's first or last row; such boundary nodes are written as parts
under a fingerprint of their turns and recombined by sums. Each shard takes its
first row to start all of its nodes and its last row to end a leaf. Where
neighbouring shards share turns this counts too much, which is corrected by the
pairs of rows at the edges, two per shard.

Long conversations are cut into blocks of ``BLOCK`` turns. A block is sorted behind
the fingerprint of all turns before it, so no row is wider than a block; what a
subtree has in later blocks comes to a row as a sum along its conversation.

Defined cases: null role or text is empty; turns that share their number are
ordered by role, then text, repeated rows count; rows without ``conv_id`` belong to
no conversation; an empty table gives no nodes, not even the root. The digest of a
node's members is sequential by definition: pieces of ids pass one task as a
stream, one piece in memory at a time. Turns are told apart by 128-bit digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.frames import stored, width
from isotherm.session import configure

#: Conversations whose ids are equal but for the last ``FAMILY`` share their first turns; at most this many less one.
FAMILY, HEADS = 20, 4
BLOCK, SHARD_ROWS, DIGEST = 32, 32768, 16
WORDS = r"[^\x20\x09-\x0D]+"

_WHOLE, _PART, _FIRST, _LAST = 0, 1, 2, 3
_NODES = pa.schema(
    [("kind", pa.int32()), ("depth", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64())]
    + [("parent_hi", pa.int64()), ("parent_lo", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64())]
    + [("saved_tokens", pa.int64()), ("words", pa.int64()), ("ends_sha256", pa.string()), ("ends", pa.binary())]
    + [("block", pa.int32()), ("path", pa.binary()), ("turn_words", pa.list_(pa.int32()))]
)
_NODES_DDL = (
    "kind int, depth long, hi long, lo long, conv_id long, parent_conv_id long, parent_hi long, parent_lo long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, words long, ends_sha256 string, ends binary, block int, path binary, turn_words array<int>"
)


# --- conversations ------------------------------------------------------------


def _count_on(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over turns in order: each one's place among its conversation's turns in this task."""
    shard, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        first = np.flatnonzero(np.append(True, conv[1:] != conv[:-1]))
        nth = np.arange(len(conv)) - np.repeat(first, np.diff(np.append(first, len(conv)))) + 1
        if last == conv[0]:
            nth[: first[1] if len(first) > 1 else None] += seen
        last, seen = conv[-1], nth[-1]
        columns = [batch.column(0), pa.array(np.full(len(conv), shard, np.int32)), pa.array(nth, pa.int64()), *batch.columns[1:]]
        yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "shard", "nth", "digest", "words"])


def numbered_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, nth, digest, words`` of each turn; a conversation may be spread over many tasks."""
    empty = F.lit("")
    plain = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), empty).alias("text"),
    ).where("conv_id IS NOT NULL")
    ranged = plain.repartitionByRange(width(turns), "conv_id", "turn", "role", F.substring("text", 1, 256)).sortWithinPartitions(*plain.columns)
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    counted = ranged.select("conv_id", digest.alias("digest"), F.regexp_count("text", F.lit(WORDS)).alias("words"))
    local = stored(counted.mapInArrow(_count_on, "conv_id long, shard int, nth long, digest string, words int"), "turns")
    earlier = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    pieces = local.groupBy("conv_id", "shard").agg(F.max("nth").alias("n")).withColumn("before", F.sum("n").over(earlier))
    spread = pieces.where("before > 0").select("conv_id", "shard", "before")  # no more rows than there are tasks
    joined = local.join(spread, ["conv_id", "shard"], "left")
    return joined.select("conv_id", (F.col("nth") + F.coalesce("before", F.lit(0))).alias("nth"), "digest", "words")


def rebuilt_blocks(turns: DataFrame) -> DataFrame:
    """Conversations with shared heads, in blocks: ``conv_id, block, path, words, length``; ``turns`` is from ``numbered_turns``.

    ``path`` has the digests of the block's turns, and one byte more where the conversation goes on.
    """
    heads_taken = F.crc32(F.col("conv_id").cast("string")) % HEADS
    own = turns.withColumn("h", heads_taken)
    totals = turns.groupBy("conv_id").agg(F.max("nth").alias("total"))
    base = totals.select(F.col("conv_id").alias("base"), F.col("total").alias("base_total"))
    convs = totals.withColumn("h", heads_taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(base, "base", "left")
    m = F.least("h", F.coalesce("base_total", F.lit(0)))
    convs = convs.withColumn("m", m).withColumn("length", F.col("m") + F.greatest(F.col("total") - F.col("h"), F.lit(0)))
    convs = stored(convs.select("conv_id", "base", "m", "length"), "conversations")

    heads = turns.where(f"nth < {HEADS} AND conv_id % {FAMILY} = 0").withColumnRenamed("conv_id", "base")
    taken = convs.where("m > 0").join(heads, "base").where("nth <= m").select("conv_id", F.col("nth").alias("pos"), "length", "digest", "words")
    kept = own.where("nth > h").join(convs, "conv_id").select("conv_id", (F.col("m") + F.col("nth") - F.col("h")).alias("pos"), "length", "digest", "words")
    block = F.expr(f"CAST((pos - 1) DIV {BLOCK} AS INT)").alias("block")
    by_block = taken.unionByName(kept).groupBy("conv_id", block).agg(
        F.sort_array(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns"), F.max("length").alias("length")
    )
    goes_on = F.expr(f"CASE WHEN length > {BLOCK} * (block + 1L) THEN '01' ELSE '' END")
    path = F.unhex(F.concat(F.array_join(F.transform("turns", lambda t: t["digest"]), ""), goes_on)).alias("path")
    filled = by_block.select("conv_id", "block", path, F.transform("turns", lambda t: t["words"]).alias("words"), "length")
    bare = convs.where("length = 0").select("conv_id", F.lit(0).alias("block"), F.unhex(F.lit("")).alias("path"), F.array().cast("array<int>").alias("words"), "length")
    return filled.unionByName(bare)


def _along(*order) -> Window:
    return Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def with_prefixes(blocks: DataFrame) -> DataFrame:
    """Add the fingerprint of all earlier blocks, and the words of all later ones as ``tail``."""
    short = blocks.where(f"length <= {BLOCK}").selectExpr("conv_id", "block", "0L AS hi", "0L AS lo", "path", "words", "0L AS tail", "0L AS tail_leaves")
    long = blocks.where(f"length > {BLOCK}").withColumn("own", F.md5(F.concat(F.col("block").cast("string").cast("binary"), F.lit(b":"), F.substring("path", 1, BLOCK * DIGEST))))

    def prefix(at: int):
        return F.coalesce(F.bit_xor(F.conv(F.substring("own", at, 15), 16, 10).cast("long")).over(_along("block")), F.lit(0))

    later = F.coalesce(F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x)).over(_along(F.desc("block"))), F.lit(0))
    named = long.withColumn("hi", prefix(1)).withColumn("lo", prefix(16)).withColumn("tail", later)
    return short.unionByName(named.select("conv_id", "block", "hi", "lo", "path", "words", "tail", F.lit(0).cast("long").alias("tail_leaves")))


# --- a shard ------------------------------------------------------------------


def node_key(block: int, hi: int, lo: int, path: bytes) -> tuple[int, int]:
    """Fingerprint of a node whose turns in this block are ``path``."""
    if not path:
        return hi, lo
    own = hashlib.md5(b"%d:" % block + path).hexdigest()
    return hi ^ int(own[:15], 16), lo ^ int(own[15:30], 16)


def padded(rows: pa.Table) -> tuple[np.ndarray, ...]:
    """Turn ids (ascending as their digests, 0 where there is none), words, lengths, and whether a row goes on."""
    paths = rows["path"].to_pylist()
    lengths = np.array([len(p) // DIGEST for p in paths])
    more = np.array([len(p) % DIGEST > 0 for p in paths])
    digests = np.frombuffer(b"".join(p[: n * DIGEST] for p, n in zip(paths, lengths, strict=True)), f"S{DIGEST}")
    ids = np.unique(digests, return_inverse=True)[1] + 1
    filled = np.arange(lengths.max(initial=0)) < lengths[:, None]
    matrix, words = np.zeros(filled.shape, np.int64), np.zeros(filled.shape, np.int64)
    matrix[filled] = ids
    words[filled] = rows["words"].combine_chunks().flatten().to_numpy()
    return matrix, words, lengths, more


def shard_nodes(rows: pa.Table) -> list[tuple]:
    """Rows of ``_NODES`` for the conversations of one shard."""
    matrix, words, lengths, more = padded(rows)
    group = [rows[c].to_numpy() for c in ("block", "hi", "lo")]
    conv, tail, tail_leaves = (rows[c].to_numpy() for c in ("conv_id", "tail", "tail_leaves"))
    n, deepest = matrix.shape
    order = np.lexsort((conv, more, *matrix.T[::-1], *group[::-1]))
    matrix, words, lengths, more, conv, tail, tail_leaves = (x[order] for x in (matrix, words, lengths, more, conv, tail, tail_leaves))
    block, hi, lo = (x[order] for x in group)

    # Column 0 stands for the turns of earlier blocks, column d for turn d.
    changed = np.ones((n, deepest + 1), bool)
    changed[1:, 0] = (block[1:] != block[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
    changed[1:, 1:] = matrix[1:] != matrix[:-1]
    changed = np.logical_or.accumulate(changed, axis=1)
    present = np.arange(deepest + 1) <= lengths[:, None]
    starts = changed & present
    goes_below = np.append(~np.take_along_axis(changed[1:], lengths[:-1, None], 1)[:, 0], False)
    leaves = (~more & ~goes_below) + tail_leaves
    spared = np.zeros((n, deepest + 1), np.int64)
    spared[:, 1:] = words * ~starts[:, 1:]
    spared = np.cumsum(spared[:, ::-1], axis=1)[:, ::-1] + tail[:, None]

    paths = rows["path"].take(pa.array(order)).to_pylist()
    turn_words = rows["words"].take(pa.array(order))
    out, above = [], None
    for d in range(deepest + 1):
        first = np.flatnonzero(changed[:, d])
        size = np.diff(np.append(first, n))
        least, children = np.minimum.reduceat(conv, first), np.zeros(len(first), np.int64)
        if d < deepest:
            children = np.add.reduceat(starts[:, d + 1].astype(np.int64), first)
        n_leaves, saved = np.add.reduceat(leaves, first), np.add.reduceat(spared[:, d], first)
        ended = np.add.reduceat(((lengths == d) & ~more).astype(np.int64), first)
        onward = np.logical_or.reduceat(more, first) if d == BLOCK else np.zeros(len(first), bool)
        parted = onward.copy()
        parted[0] = parted[-1] = True
        if d == 0:
            parted[:] = True  # the root, or the last node of the block before
        real = present[first, d]
        keys = {}
        for i in np.flatnonzero(parted & real).tolist():
            at = first[i]
            keys[i] = node_key(int(block[at]), int(hi[at]), int(lo[at]), paths[at][: d * DIGEST])
        parent = np.searchsorted(above[0], first, "right") - 1 if d else None
        for i in np.flatnonzero(real).tolist():
            at, depth = first[i], int(block[first[i]]) * BLOCK + d
            key = keys.get(i)
            if d == 0 and block[at]:
                out.append((_PART, depth, *key, None, None, None, None, 0, int(children[i]), 0, 0, None, None, None, None, None, None))
                continue
            parent_conv = parent_key = None
            if d:
                parent_key = above[2].get(parent[i])
                parent_conv = None if parent_key else int(above[1][parent[i]])
            ids = ",".join(map(str, conv[at : at + ended[i]].tolist())).encode()
            sums = (int(size[i]), int(children[i]), int(n_leaves[i]), int(saved[i]), int(words[at, d - 1]) if d else 0)
            digest = None if key else hashlib.sha256(ids).hexdigest()
            kind, pieces = (_PART, ids or None) if key else (_WHOLE, None)
            out.append((kind, depth, *(key or (None, None)), int(least[i]), parent_conv, *(parent_key or (None, None)), *sums, digest, pieces, None, None, None))
        above = first, least, keys
    for kind, at in ((_FIRST, 0), (_LAST, n - 1)):
        edge = (int(block[at]), paths[at], turn_words[at].as_py())
        out.append((kind, None, int(hi[at]), int(lo[at]), int(conv[at]), *[None] * 10, *edge))
    return out


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_NODES)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODES, strict=True)], schema=_NODES)


def _shard_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over a range of rows, which the number of ranges keeps to about ``SHARD_ROWS``."""
    held = [b for b in batches if b.num_rows]
    if held:
        found = shard_nodes(pa.Table.from_batches(held))
        for at in range(0, len(found), 8192):
            yield _as_batch(found[at : at + 8192])


def _corrections(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over pairs of neighbouring rows of two shards: what both shards have counted, as parts with less."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            block, hi, lo, path, before = row["block"], row["hi"], row["lo"], row["path"], row["before"]
            most = min(len(path), len(before)) // DIGEST
            shared = next((d for d in range(most) if path[d * DIGEST : (d + 1) * DIGEST] != before[d * DIGEST : (d + 1) * DIGEST]), most)
            same_leaf = len(before) == shared * DIGEST
            for d in range(shared + 1):
                inside = d > 0 or not block  # column 0 of a later block only counts children
                spared = sum(row["turn_words"][max(d, 1) - 1 : shared]) if inside else 0
                key = node_key(block, hi, lo, path[: d * DIGEST])
                sums = (0, -1 if d < shared else 0, -1 if same_leaf and inside else 0, spared)
                out.append((_PART, block * BLOCK + d, *key, None, None, None, None, *sums, None, None, None, None, None, None))
        yield _as_batch(out)


def _streamed_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task over pieces of ids sorted by node and first id."""
    last, digest = None, None

    def done() -> pa.RecordBatch:
        columns = [*zip(last), [digest.hexdigest()]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["depth", "hi", "lo", "ends_sha256"])

    for batch in batches:
        for *key, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
            if key != last:
                if digest:
                    yield done()
                last, digest = key, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
    if digest:
        yield done()


def trie_nodes(rows: DataFrame) -> DataFrame:
    """All nodes of the blocks of conversations in ``rows``."""
    n = max(width(rows), -(-rows.count() // SHARD_ROWS))
    by = ["block", "hi", "lo", "path", "conv_id"]
    found = stored(rows.select(*by, "words", "tail", "tail_leaves").repartitionByRange(n, *by).mapInArrow(_shard_task, _NODES_DDL), "nodes")

    edges = found.where(f"kind IN ({_FIRST}, {_LAST})").select("kind", *by, "turn_words")  # two rows per shard
    above = Window.orderBy(*by, "kind")
    pairs = edges.select("*", *(F.lag(c).over(above).alias(f"_{c}") for c in ("kind", "block", "hi", "lo", "path")))
    met = pairs.where(f"kind = {_FIRST} AND _kind = {_LAST} AND block = _block AND hi = _hi AND lo = _lo")
    less = met.select("block", "hi", "lo", "path", F.col("_path").alias("before"), "turn_words").mapInArrow(_corrections, _NODES_DDL)

    key = ["depth", "hi", "lo"]
    parts = found.where(f"kind = {_PART}")
    most = [F.max(c).alias(c) for c in ("parent_conv_id", "parent_hi", "parent_lo", "words")]
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    joined = parts.unionByName(less).groupBy(*key).agg(F.min("conv_id").alias("conv_id"), *most, *sums)
    first_id = F.substring_index(F.col("ends").cast("string"), ",", 1).cast("long").alias("first_id")
    pieces = parts.where("ends IS NOT NULL").select(*key, first_id, "ends").repartition(width(rows), *key).sortWithinPartitions(*key, "first_id")
    digests = pieces.mapInArrow(_streamed_digests, "depth long, hi long, lo long, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    joined = stored(joined.join(digests, key, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none)), "boundary")

    columns = ["conv_id", "depth", "parent_conv_id", "parent_hi", "parent_lo", "n_convs", "n_children", "n_leaves", "saved_tokens", "words", "ends_sha256"]
    nodes = found.where(f"kind = {_WHOLE}").select(*columns).unionByName(joined.select(*columns))
    parents = joined.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("parent_hi"), F.col("lo").alias("parent_lo"), F.col("conv_id").alias("_parent"))
    placed = nodes.join(parents, ["depth", "parent_hi", "parent_lo"], "left")
    return placed.select("conv_id", "depth", F.coalesce("parent_conv_id", "_parent").alias("parent_conv_id"), *columns[5:])


def with_tails(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows with what their conversations stand for in later blocks; each node is counted with its smallest member."""
    leaf = F.sum((F.col("n_children") == 0).cast("long"))
    own = nodes.where(f"depth > {BLOCK}").groupBy("conv_id", F.expr(f"CAST((depth - 1) DIV {BLOCK} AS INT)").alias("block")).agg(F.sum("words").alias("once"), leaf.alias("leaves"))
    joined = rows.join(own, ["conv_id", "block"], "left")
    back = _along(F.desc("block"))
    tails = joined.withColumn("tail", F.col("tail") - F.coalesce(F.sum("once").over(back), F.lit(0)))
    return tails.withColumn("tail_leaves", F.coalesce(F.sum("leaves").over(back), F.lit(0))).select(*rows.columns)


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    configure(turns.sparkSession)
    rows = stored(with_prefixes(rebuilt_blocks(numbered_turns(turns, conv_col, turn_col, role_col, text_col))), "rows")
    nodes = trie_nodes(rows)
    if not rows.where("block > 0").isEmpty():
        nodes = trie_nodes(with_tails(rows, nodes))
    return nodes.drop("words")
