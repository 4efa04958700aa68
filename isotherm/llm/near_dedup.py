"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles. Equal sets are one node. Each node
has 128 minima over hashes of its shingles; 32 bands of four minima give its
buckets, and the low four bits of each minimum, packed, its signature. Nodes that
share a bucket are candidates. A candidate pair is dropped only if the similarity
estimated from its signatures (equal groups by bit counts, corrected for equal
bits by chance) is more than six standard deviations below the limit; all others
are confirmed on their full sets.

Only components are wanted, so a bucket is not expanded into its pairs. Its
members are compared with one hub a round, the member that shares the most
buckets with others first, as an original does among its copies; then with the
next, as long as the bucket holds more than one component. Buckets that still do
after four rounds, and have pairs without a hub, are compared whole, in blocks:
a task counts all intersections of two blocks as products of matrices and gives
only the links that tie components together. So no link is lost, and what is
handed on grows with the members, not with their pairs.

A pair at the limit of 0.8 shares no bucket with probability 5e-8, and less above.

Defined cases: null and empty texts have an empty set and are linked with
nothing; a text of fewer words than a shingle has one shingle, the whole; rows
that repeat an id are documents of their own by their text, and rows that repeat
id and text share their result; a null id counts for a component only if it has
no other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isotherm.llm.components import connected
from isotherm.llm.frames import lean, stored, texts
from isotherm.llm.repeats import NO_ID, PolynomialHash, mixed

BANDS, PER_BAND, BITS = 32, 4, 4
MINIMA = BANDS * PER_BAND
WORDS = MINIMA * BITS // 64
#: Lowest bit of each group of BITS bits in a word of a signature.
GROUP_LOW = sum(1 << i for i in range(0, 64, BITS))
HUB_ROUNDS = 4
#: Members of a block, and shingles that are multiplied at once.
BLOCK, BLOCK_SHINGLES, COLUMNS = 512, 1 << 18, 2048

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Shingler:
    """Texts to sorted distinct 64-bit hashes of their word shingles."""

    def __init__(self, words: int):
        self.words, self.hashes = words, PolynomialHash(0x9E3779B97F4A7C15, 11)
        self.factors = np.random.default_rng(12).integers(0, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def word_hashes(self, text: str) -> np.ndarray:
        data = np.frombuffer(text.encode().lower(), np.uint8)  # bytes.lower changes A-Z alone
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~_SPACE[data]
        change = np.diff(inside)
        starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        return self.hashes.of(self.hashes.prefixes(data), starts, ends - starts)

    def shingles(self, text: str) -> np.ndarray:
        words = self.word_hashes(text)
        size = min(self.words, len(words))
        if not size:
            return words
        n = len(words) - size + 1
        total = np.full(n, size, np.uint64)
        for j in range(size):
            total += words[j : j + n] * self.factors[j]
        return np.unique(mixed(total))


class Signer:
    """Shingle sets to minima, buckets and packed signatures."""

    def __init__(self):
        rng = np.random.default_rng(13)
        self.factor = rng.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shift = rng.integers(0, 2**63, MINIMA, dtype=np.uint64)
        self.band = rng.integers(0, 2**63, (BANDS, PER_BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(MINIMA, np.iinfo(np.uint64).max)
        for i in range(0, len(shingles), 512):
            best = np.minimum(best, (shingles[i : i + 512, None] * self.factor + self.shift).min(0))
        return best

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        salted = (minima.reshape(BANDS, PER_BAND) * self.band).sum(1, dtype=np.uint64)
        return mixed(salted + np.arange(BANDS, dtype=np.uint64)).view(np.int64)

    @staticmethod
    def signature(minima: np.ndarray) -> np.ndarray:
        low = mixed(minima) & np.uint64((1 << BITS) - 1)
        places = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
        return np.bitwise_or.reduce(low.reshape(WORDS, -1) << places, axis=1).view(np.int64)


def set_key(shingles: np.ndarray) -> bytes:
    """128-bit name of a set, equal for equal sets only (up to hash collisions)."""
    rotated = shingles ^ (shingles << np.uint64(29))
    sums = [mixed(shingles).sum(dtype=np.uint64), mixed(rotated * np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64)]
    return np.array(sums, np.uint64).tobytes()


def sign(words: int):
    """Task: texts to sets' names, sizes, buckets and signatures."""
    names = ["doc_id", "tag", "n_shingles", "node", "buckets", "signature"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, signer = Shingler(words), Signer()
        for batch in batches:
            sizes, nodes, buckets, signatures = [], [], [], []
            for text in batch.column(1).to_pylist():
                found = shingler.shingles(text)
                sizes.append(len(found))
                if len(found):
                    minima = signer.minima(found)
                    nodes.append(set_key(found))
                    buckets.append(signer.buckets(minima))
                    signatures.append(signer.signature(minima))
                else:
                    nodes.append(None)
                    buckets.append(None)
                    signatures.append(None)
            found = [sizes, nodes, buckets, signatures]
            columns = [pa.array(c, f.type) for c, f in zip(found, list(schema)[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], schema=schema)

    return task


def estimate(a: str, b: str):
    """Similarity by two signature columns: equal groups of bits, less those equal by chance."""
    unequal = F.lit(0)
    for i in range(WORDS):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for step in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
        unequal = unequal + F.bit_count(x.bitwiseAND(F.lit(GROUP_LOW)))
    chance = 2.0**-BITS
    return (1 - unequal / F.lit(MINIMA) - chance) / (1 - chance)


def least_estimate(similarity: int) -> float:
    """Six standard deviations below the limit."""
    chance = 2.0**-BITS
    equal = similarity / 100 + (1 - similarity / 100) * chance
    return similarity / 100 - 6 * (equal * (1 - equal) / MINIMA) ** 0.5 / (1 - chance)


def confirm(words: int, similarity: int):
    """Task: pairs with both texts to those whose full sets are similar enough."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, held_set = Shingler(words), None, None
        for batch in batches:
            keep = []
            for a, b, text_a, text_b in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if a != held:
                    held, held_set = a, shingler.shingles(text_a)
                other = shingler.shingles(text_b)
                both = len(np.intersect1d(held_set, other, assume_unique=True))
                keep.append(100 * both >= similarity * (len(held_set) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=schema).filter(pa.array(keep, pa.bool_()))

    return task


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections; shingles of one set alone are left out first."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total.astype(np.int64)


def tie(linked: np.ndarray, labels: list) -> list[tuple[int, int]]:
    """Links that connect what ``linked`` connects beyond equal labels: fewer than there are members."""
    first, seen, out = {}, np.zeros(len(labels), bool), []
    for i, label in enumerate(labels):
        first.setdefault(label, i)
    same = np.array([first[label] for label in labels])
    for start in range(len(labels)):
        if seen[start]:
            continue
        todo = [start]
        seen[start] = True
        while todo:
            i = todo.pop()
            for j in np.flatnonzero((linked[i] | (same == same[i])) & ~seen):
                seen[j] = True
                todo.append(int(j))
                if same[i] != same[j]:
                    out.append((i, int(j)))
    return out


def confirm_blocks(words: int, similarity: int):
    """Function over the members of two blocks of a bucket: the links that tie their components together."""
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def group(members: pa.Table) -> pa.Table:
        shingler, nodes = Shingler(words), members["node"].to_pylist()
        sets = [shingler.shingles(text) for text in members["text"].to_pylist()]
        both, sizes = intersections(sets), np.array([len(x) for x in sets])
        linked = 100 * both >= similarity * (sizes[:, None] + sizes[None] - both)
        found = tie(linked, members["label"].to_pylist())
        return pa.table([[nodes[i] for i, _ in found], [nodes[j] for _, j in found]], schema=schema)

    return group


def _hubs(members: DataFrame, tried: DataFrame | None) -> DataFrame:
    """``bucket, hub, hub_label``: of each bucket the member with the most company that was not its hub yet."""
    fresh = members if tried is None else members.join(tried.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti")
    best = F.max(F.struct("company", "node", "label")).alias("best")
    return fresh.groupBy("bucket").agg(best).select("bucket", F.col("best.node").alias("hub"), F.col("best.label").alias("hub_label"))


def _pairs(members: DataFrame, hubs: DataFrame) -> DataFrame:
    """Candidate pairs ``a < b`` of members and their bucket's hub, where they are apart."""
    apart = members.join(hubs, "bucket").where("label <> hub_label")
    return apart.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def _labelled(members: DataFrame, stars: DataFrame) -> DataFrame:
    """Members of buckets that still hold more than one component."""
    found = members.drop("label").join(stars.select(F.col("a").alias("node"), F.col("b").alias("label")), "node", "left")
    found = found.withColumn("label", F.coalesce("label", "node"))
    mixed_up = found.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return found.join(mixed_up.select("bucket"), "bucket", "left_semi")


def _in_blocks(members: DataFrame, bodies: DataFrame, words: int, similarity: int) -> DataFrame:
    """Links within buckets that hold pairs without a hub; each member goes to its block's pairs of blocks."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("total")).where(F.col("size") > HUB_ROUNDS + 1)
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    own = members.join(sizes, "bucket").withColumn("own", F.pmod(F.xxhash64("node", "bucket"), blocks).cast("int"))
    other = F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other")
    dealt = own.select("bucket", "node", "label", "own", other)
    dealt = dealt.select("bucket", "node", "label", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    full = dealt.join(bodies.select("node", "text"), "node")
    return full.groupBy("bucket", "low", "high").applyInArrow(confirm_blocks(words, similarity), "a binary, b binary")


def _components(docs: DataFrame, words: int, similarity: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """All rows as signed, and ``node, doc_id, tag, label`` of those with words; ``label`` names the component, ``NO_ID`` is a null id.

    ``tag``, a 64-bit hash of ``text``, tells rows of one id apart.
    """
    rows = texts(docs, id_col=id_col, text_col=text_col)
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64("text").alias("tag"))
    ddl = "doc_id long, tag long, n_shingles long, node binary, buckets array<long>, signature array<long>"
    signed = stored(rows.mapInArrow(lean(sign(words)), ddl), "signatures")
    sets = signed.where("n_shingles > 0")

    banded = sets.select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    counted = banded.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high")
    members = banded.join(counted.select("bucket"), "bucket", "left_semi").distinct()
    members = stored(members.withColumn("label", F.col("node")), "members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    company = members.join(sizes, "bucket").groupBy("node").agg(F.sum("size").alias("company"))
    members = stored(members.join(company, "node"), "members")

    # One document stands for each node that has a candidate.
    asked = members.select("node").distinct()
    place = F.struct("doc_id", "tag", "signature")
    stand_in = sets.join(asked, "node", "left_semi").groupBy("node").agg(F.min(place).alias("place")).select("node", "place.*")
    bodies = stored(rows.join(stand_in, ["doc_id", "tag"]).select("node", "text", "signature").dropDuplicates(["node"]), "bodies")

    stars, tried = None, None
    for turn in range(HUB_ROUNDS + 1):
        if stars is not None:
            members = stored(_labelled(members, stars), "members")
        if members.isEmpty():
            break
        if turn < HUB_ROUNDS:
            hubs = stored(_hubs(members, tried), "hubs")
            tried = hubs if tried is None else tried.unionByName(hubs)
            links = _links(_pairs(members, hubs), bodies, words, similarity)
        else:
            links = _in_blocks(members, bodies, words, similarity)
        stars = connected(links if stars is None else stars.unionByName(links))

    by_node = sets.select("node", "doc_id", "tag")
    if stars is None:
        return signed, by_node.withColumn("label", F.col("node"))
    by_node = by_node.join(stars.select(F.col("a").alias("node"), F.col("b").alias("label")), "node", "left")
    return signed, by_node.withColumn("label", F.coalesce("label", "node"))


def near_duplicates(docs: DataFrame, words: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, text_hash``.

    ``text_hash`` (``xxhash64(text)``) tells rows of one id apart. Documents are linked if 100 * intersection >= similarity * union of their
    sets; ``component_id`` is the smallest id reachable over links.
    """
    signed, by_node = _components(docs, words, similarity, id_col, text_col)
    own = F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))
    by_node = by_node.select("node", own.alias("doc_id"), "label")
    least = by_node.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = by_node.groupBy("node").agg(F.min("label").alias("label")).join(least, "label").select("node", "component_id")
    found = signed.select("doc_id", "tag", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(own)
    kept = own.eqNullSafe(component).alias("kept")
    return found.select(own.alias("doc_id"), "n_shingles", component.alias("component_id"), kept, F.col("tag").alias("text_hash"))


def stand_ins(docs: DataFrame, words: int = 5, similarity: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` (``NO_ID``: null), ``tag`` (``xxhash64(text)``), ``alone``: one text of each component, and every text without words.

    The smallest id stands for its component, of its texts that with the smallest
    tag. Where not ``alone``, several rows may have this id and text.
    """
    signed, by_node = _components(docs, words, similarity, id_col, text_col)
    first = F.min(F.struct((F.col("doc_id") == NO_ID).alias("no_id"), "doc_id", "tag")).alias("first")
    one = by_node.groupBy("label").agg(first, F.count(F.lit(1)).alias("n"))
    wordless = signed.where("n_shingles = 0").select("doc_id", "tag").distinct()
    return one.select("first.doc_id", "first.tag", (F.col("n") == 1).alias("alone")).unionByName(wordless.withColumn("alone", F.lit(True)))


def _links(pairs: DataFrame, bodies: DataFrame, words: int, similarity: int) -> DataFrame:
    signatures = bodies.select("node", "signature")
    likely = pairs.join(signatures.withColumnsRenamed({"node": "a", "signature": "signature_a"}), "a")
    likely = likely.join(signatures.withColumnsRenamed({"node": "b", "signature": "signature_b"}), "b")
    likely = likely.where(estimate("signature_a", "signature_b") >= least_estimate(similarity)).select("a", "b")
    found = bodies.select("node", "text")
    paired = likely.join(found.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
    paired = paired.join(found.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    return paired.select("a", "b", "text_a", "text_b").mapInArrow(lean(confirm(words, similarity)), "a binary, b binary")
