"""SimHash near-duplicates by pigeonring filtering.

Fingerprints are cut into ``max_bits + 1`` segments on a ring. If two differ in at most
``max_bits`` bits, there is a segment from which every chain of l consecutive segments
differs in at most l · max_bits / segments bits. So the first segment of that chain is equal
and the second differs in one bit at most, which leaves one of its halves equal: both make
the key by which candidates meet. A candidate must keep the budget of every longer chain
before the whole distance is looked at.

Links are not written as pairs: a task writes the edges of a spanning forest of each
key's fingerprints. A key with more than ``block`` fingerprints is dealt into blocks, and each two
blocks meet in a task of their own.

Defined cases: a null text has no words; texts without words have fingerprint zero and are linked like any
other; a row without an id gets its group's smallest id, if there is one; equal rows get equal results; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import free_name
from .graph import connected_components

BITS = 64
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of a text, as a signed integer."""
    import xxhash

    words = (text or "").encode().lower().split()  # of bytes: A-Z only, and the six blanks only
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n], ends[-n:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 15):
        some = [whole[x:y] for x, y in zip(starts[at : at + (1 << 15)].tolist(), ends[at : at + (1 << 15)].tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, some, repeat(SEED)), "<u8", len(some))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``doc_id, fingerprint`` (a signed 64-bit integer) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint bigint")


class Ring:
    """Segments of a fingerprint, chains from every start and their budgets."""

    def __init__(self, max_bits: int):
        if not 1 <= max_bits < BITS // 2:
            raise ValueError("max_bits must be from 1 to 31")
        n = max_bits + 1
        cuts = [BITS * i // n for i in range(n + 1)]
        self.segments = list(zip(cuts, cuts[1:]))
        masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in self.segments]
        self.budgets = [max_bits * (k + 1) // n for k in range(n)]
        self.chains = np.array([[sum(masks[(s + j) % n] for j in range(k + 1)) for k in range(n)] for s in range(n)], np.uint64)

    def keys(self, fingerprint: Column) -> list[Column]:
        """A key for every start and half of the segment behind it."""
        def bits(a: int, b: int) -> Column:
            return F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1))

        n, out = len(self.segments), []
        for s, (a, b) in enumerate(self.segments):
            c, d = self.segments[(s + 1) % n]
            for half, (x, y) in enumerate([(c, (c + d) // 2), ((c + d) // 2, d)]):
                tag = F.lit(2 * s + half).cast("bigint")
                out.append(F.shiftleft(F.shiftleft(tag, b - a).bitwiseOR(bits(a, b)), y - x).bitwiseOR(bits(x, y)) if y - x + b - a < 56 else F.xxhash64(tag, bits(a, b), bits(x, y)))
        return out

    def near(self, differing: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Places of the differences that stay within every chain's budget from their start."""
        left = np.arange(len(differing))
        for k, budget in enumerate(self.budgets):
            left = left[np.bitwise_count(differing[left] & self.chains[start[left], k]) <= budget]
        return left


def _forest(start: np.ndarray, group: np.ndarray, prints: np.ndarray, ring: Ring, small: int = 24) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what is linked within each group; groups are runs of equal numbers."""
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
    sizes = np.diff(np.concatenate([[0], ends]))
    of = np.repeat(sizes, sizes)
    left, right = [], []
    for lag in range(1, min(small, int(sizes.max(initial=1)))):
        i = np.flatnonzero((group[lag:] == group[:-lag]) & (of[lag:] <= small))
        i = i[ring.near(prints[i] ^ prints[i + lag], start[i])]
        left.append(prints[i])
        right.append(prints[i + lag])
    for end, size in zip(ends[sizes > small], sizes[sizes > small]):
        own = prints[end - size : end]
        unseen = np.arange(size)
        while len(unseen):
            queue, unseen = [unseen[0]], unseen[1:]
            while queue and len(unseen):
                at = queue.pop()
                found = ring.near(own[at] ^ own[unseen], np.full(len(unseen), start[end - 1]))
                left.append(np.full(len(found), own[at]))
                right.append(own[unseen[found]])
                queue.extend(unseen[found])
                unseen = np.delete(unseen, found)
    none = np.empty(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def links(prints: DataFrame, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints of ``max_bits`` or fewer differing bits."""
    ring = Ring(max_bits)
    keys = F.posexplode(F.array(*ring.keys(F.col("fingerprint")))).alias("way", "key")
    keyed = prints.select("fingerprint", keys)
    crowded = keyed.groupBy("way", "key").agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    blocks = crowded.select("way", "key", F.ceil(F.col("_n") / block).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("fingerprint"), F.col("_blocks").cast("bigint")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda x: x != own)
    tiles = F.transform(others, lambda x: F.least(x, own).cast("bigint") * F.col("_blocks") + F.greatest(x, own))
    dealt = keyed.join(blocks, ["way", "key"], "left").select(
        "way", "key", "fingerprint", F.explode(F.when(F.col("_blocks").isNull(), F.array(F.lit(0).cast("bigint"))).otherwise(tiles)).alias("tile")
    )

    def edges(rows: list[np.ndarray]) -> pa.RecordBatch:
        way, key, tile, prints = rows
        new = (way[1:] != way[:-1]) | (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])
        group = np.concatenate([[0], np.cumsum(new)]) if len(way) else np.empty(0, np.int64)
        a, b = _forest(way // 2, group, prints.view(np.uint64), ring)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest:
                rows = [np.concatenate(x) for x in zip(rest, rows)]
            if not len(rows[0]):
                continue
            same = np.logical_and.reduce([c == c[-1] for c in rows[:3]])
            cut = len(same) if not same[-1] else len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
            rest = [c[cut:] for c in rows]  # the last group may go on in the next batch
            if cut:
                yield edges([c[:cut] for c in rows])
        if rest:
            yield edges(rest)

    placed = dealt.select("way", "key", "tile", "fingerprint").repartition("way", "key", "tile").sortWithinPartitions("way", "key", "tile")
    return placed.mapInArrow(run, "a bigint, b bigint")


def components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, block: int = 4096) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``."""
    prints = cut_lineage(fingerprints(docs, shingle))
    distinct = cut_lineage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("_least")))
    found = connected_components(links(distinct.select("fingerprint"), max_bits, block))
    rooted = distinct.join(found.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    rooted = rooted.select("fingerprint", "_least", F.coalesce("component", "fingerprint").alias("_root"))
    ids = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    labels = rooted.join(ids, "_root").select("fingerprint", "component_id")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    return prints.join(labels, "fingerprint").select("doc_id", digits, "component_id")


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each component: the one with the smallest id, and of several with it the one of the smallest row hash.

    Rows are told apart by id and a hash of all their columns, so a text whose id also names another is not lost with it, and
    equal rows are one. A row without an id is kept: nothing can name it.
    """
    mark = free_name(docs, "_mark")
    named = docs.where(F.col("doc_id").isNotNull()).withColumn(mark, F.xxhash64(*docs.columns))
    found = components(named.select(F.struct("doc_id", F.col(mark).alias("mark")).alias("doc_id"), "text"), **options)
    firsts = found.where(F.col("doc_id") == F.col("component_id")).select("doc_id.doc_id", F.col("doc_id.mark").alias(mark))
    kept = named.join(firsts, ["doc_id", mark], "left_semi").dropDuplicates(["doc_id", mark]).select(docs.columns)
    return kept.unionByName(docs.where(F.col("doc_id").isNull()))
