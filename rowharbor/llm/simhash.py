"""SimHash near-duplicates by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, row_digest, spare, text_of
from rowharbor.llm.components import components

BITS = 64
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """A bit is set if it is set in over half of the hashes of all word shingles."""
    words = text.lower().split()  # of bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    total = len(starts)
    ends = ends[shingle - 1:].tolist()
    for at in range(0, total, 1 << 16):  # the bits of 65,536 hashes at a time
        some = np.array([digest(joined[s:e], seed) for s, e in
                         zip(starts[at:at + (1 << 16)], ends[at:at + (1 << 16)], strict=True)], np.uint64)
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp, digest)`` of every row, fp as a signed 64-bit number; null text counts as empty.

    ``digest`` is of id and text, to find the row again.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64)), batch.column("digest")],
                names=["doc_id", "fp", "digest"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text"),
                       row_digest().alias("digest"))
    return slim.mapInArrow(each, "doc_id bigint, fp bigint, digest bigint")


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of words: bit i of word w of row j is bit j of fingerprint 64 w + i."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def pairs_within(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs i < j of a block at ``radius`` or fewer differing bits.

    All fingerprints of the block are compared with 64 others per machine word. Distances are
    counted by vertical counters: two planes at a time go through a carry-save adder into the
    lowest counter bit, the carries ripple up. The counters start at 2^k - radius - 1, so that a
    carry out of the top says that the radius is exceeded, for good. Rows of which all others have
    exceeded it are given up every eight planes, and the block once none is left.
    """
    n = len(fps)
    planes = bit_planes(fps)
    width = planes.shape[1]
    rows = np.arange(n)
    column = np.arange(width * 64)
    outside = (column[None, :] <= rows[:, None]) | (column[None, :] >= n)
    over = np.packbits(outside, axis=1, bitorder="little").view(np.uint64)
    size = max(1, int(radius + 1).bit_length())
    start = (1 << size) - radius - 1
    counters = [np.full((n, width), ALL if start >> k & 1 else 0, np.uint64) for k in range(size)]
    own = np.where((fps[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1), ALL, np.uint64(0))
    for j in range(0, BITS, 2):
        a = planes[j][None, :] ^ own[rows, j][:, None]
        b = planes[j + 1][None, :] ^ own[rows, j + 1][:, None]
        low = counters[0]
        half = low ^ a
        carry = (low & a) | (b & half)
        counters[0] = half ^ b
        for k in range(1, size):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if j % 8 == 6:
            alive = (over != ALL).any(axis=1)
            if not alive.all():
                rows, over = rows[alive], over[alive]
                counters = [c[alive] for c in counters]
            if not len(rows):
                break
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.nonzero(np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little"))
    return rows[left], right


def block_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each component of a block to its least fingerprint's index, not all pairs."""
    left, right = pairs_within(fps, radius)
    label = np.arange(len(fps))
    while True:
        least = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, least)
        np.minimum.at(new, right, least)
        np.minimum.at(new, label[left], least)
        np.minimum.at(new, label[right], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = np.nonzero(label != np.arange(len(fps)))[0]
    return tied, label[tied]


def _child_masks(mask: int, radius: int, parts: int) -> list[int]:
    """The mask plus each choice of ``parts - radius`` of ``parts`` equal pieces of the other bits."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    step = len(free) // parts
    pieces = [sum(1 << b for b in free[i * step:(i + 1) * step if i < parts - 1 else len(free)]) for i in range(parts)]
    return [mask | sum(chosen) for chosen in combinations(pieces, parts - radius)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_links(fps: DataFrame, radius: int = 2, block: int = 1024) -> DataFrame:
    """``fps(fp)``, distinct -> links ``(a, b)`` whose components are those of all pairs in radius.

    Two fingerprints that differ in ``radius`` bits agree on two of ``radius + 2`` pieces, so each
    goes to the group of its bits under every choice of two pieces. Groups up to ``block`` are
    compared bit by bit; a larger one is dealt again by pieces of its other bits, which loses no
    pair either. Once few bits are free a group can't be larger than their number of values, so
    no group is ever compared as a whole beyond that, however many near copies there are.
    """
    spark = fps.sparkSession
    parts = radius + 2
    masks = {m: [0] for m in _child_masks(0, radius, parts)}
    keyed = fps.withColumn("mask", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])))
    found = None
    while True:
        keyed = materialise(keyed.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key")), "simhash-keys")
        groups = materialise(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-groups")
        free = BITS - min(m.bit_count() for m in masks)
        last = free < parts or (1 << min(free, 60)) <= block
        small = groups if last else groups.filter(F.col("n") <= block)
        links = materialise(_compared(keyed.join(small.drop("n"), ["mask", "key"]), radius, block), "simhash-links")
        found = links if found is None else found.unionByName(links)
        if last or groups.filter(F.col("n") > block).isEmpty():
            return found
        children = [(_signed(m), _signed(c)) for m in masks for c in _child_masks(m, radius, parts)]
        masks = {c: [0] for m in masks for c in _child_masks(m, radius, parts)}
        finer = spark.createDataFrame(children, "mask bigint, child bigint")  # at most 6 to the power of the level
        keyed = (
            keyed.join(groups.filter(F.col("n") > block).drop("n"), ["mask", "key"])
            .join(F.broadcast(finer), "mask").select("fp", F.col("child").alias("mask")).distinct()
        )


def _compared(members: DataFrame, radius: int, block: int) -> DataFrame:
    """The links of all groups; whole groups are gathered into blocks within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, fps = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

        def links(upto: int) -> Iterator[pa.RecordBatch]:
            at = 0
            while at < upto:
                to = min(upto, at + block)
                if to < upto:  # back to where a group starts, or on to its end
                    new = np.nonzero((group[at + 1:to + 1] != group[at:to]).any(axis=1))[0]
                    if len(new):
                        to = at + 1 + int(new[-1])
                    else:
                        more = np.nonzero((group[to:upto] != group[to - 1:upto - 1]).any(axis=1))[0]
                        to = to + int(more[0]) if len(more) else upto
                some = np.unique(fps[at:to])  # one fingerprint can be in several groups
                child, root = block_links(some, radius)
                if len(child):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some[child].view(np.int64)), pa.array(some[root].view(np.int64))], names=["a", "b"])
                at = to

        for batch in batches:
            rows = np.stack([batch.column("mask").to_numpy(), batch.column("key").to_numpy()], axis=1)
            group = np.concatenate([group, rows])
            fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
            new = np.nonzero((group[1:] != group[:-1]).any(axis=1))[0]
            if len(new):
                whole = int(new[-1]) + 1
                yield from links(whole)
                group, fps = group[whole:], fps[whole:]
        yield from links(len(fps))

    ordered = members.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return ordered.select("mask", "key", "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def near_groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """``prints(doc_id, fp)`` -> ``(fp, root, component_id)``, one row per distinct fingerprint.

    ``root`` names the group, also where no document of it has an id. ``component_id`` is the
    least id of the documents that are linked, directly or through others; null if none has one.
    """
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    roots = components(near_links(distinct.select("fp"), radius))
    rooted = materialise(
        distinct.join(roots, F.col("fp") == F.col("node"), "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")),
        "simhash-roots",
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fingerprint (hex), component_id``, one row per row of ``docs``.

    Null and blank texts have fingerprint zero, which links like any other. Repeated rows repeat.
    """
    prints = materialise(fingerprints(docs, shingle), "simhash")
    groups = materialise(near_groups(prints, radius), "simhash-components")
    return prints.join(groups, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each group of near copies: the one of the least id.

    Rows without an id come after those that have one; among rows of one id, and among those without,
    a digest of the text decides. Rows that repeat an id and its text become one.
    """
    prints = materialise(fingerprints(docs, shingle), "simhash")
    groups = materialise(near_groups(prints, radius), "simhash-components")
    rank = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "digest")
    own = spare(docs, "_digest")
    first = prints.join(groups, "fp").groupBy("root").agg(F.min(rank).alias("first"))
    kept = first.select(F.col("first.digest").alias(own))
    return docs.withColumn(own, row_digest()).join(kept, own, "left_semi").dropDuplicates([own]).drop(own)
