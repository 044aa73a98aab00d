"""Cross-tokenizer alignment: how two tokenizations of the same texts overlap, token by token.

Every text is tokenized twice, by a byte-level BPE (side A, on a space and the text) and by a
sentence-piece BPE (side B, which adds that space itself). Both sides cover the same bytes; an A and a B token are
linked where their byte ranges overlap, and where both sides end a token, a group ends. How
often each pair of ids is linked in the whole corpus decides which links are the best ones.

Counting is external: a task turns a pack of texts into one run of pairs in order, B id first,
radix-partitioned by bucket and cut into zstd frames; a bucket's task merges its runs frame by frame through
a heap, which counts each pair and, as a B id's pairs lie side by side, gives the highest count of the
bucket's share of the id as it goes; then the counts go back to each run in the order of its pairs.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, text_of
from rowharbor.llm.packs import squeeze, unsqueeze

FOLDER = "/opt/tokenizers"
SIDE_A, SIDE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
PACK_CHARS = 8 << 20
SLICE_CHARS = 1 << 20
FRESH = 1 << 15  # new pieces that are tokenized at once
FRAME = 1 << 13  # pairs in a zstd frame of a run
PACKS_A_TASK = 12
BUCKET_PAIRS = 1 << 21  # pairs of all runs that a bucket takes
SLICES = 64  # shares of a B id by its A ids, so that a B id in every link is spread
PACK_SCHEMA = ("pack bigint, ids array<bigint>, totals binary, sha array<string>, doc_ends binary, segments binary, "
               "link_ends binary, links binary, pairs binary, times binary, n_pairs bigint")
RUN_SCHEMA = "bucket bigint, pack bigint, size bigint, frames array<binary>"
ANSWER_SCHEMA = "pack bigint, bucket bigint, counts binary, top_ids binary, tops binary"
RESULT_SCHEMA = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
                 "count_sum bigint, groups_sha256 string")

ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
         "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}

# A single blank between two characters that aren't white space: a token of either side begins
# with it, and no merge of either side reaches over it, so texts may be tokenized between them.
CUT = re.compile(r"(?<=\S) (?=\S)")


class Sides:
    """Both tokenizers, with the bytes of each entry; loaded once in a worker process."""

    _loaded: dict[str, Sides] = {}

    def __init__(self, folder: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/{SIDE_A}")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{SIDE_B}")
        letters = _byte_letters()
        own = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(own.values()) + 1)
        for piece, number in own.items():
            known = all(c in letters for c in piece)
            self.a_bytes[number] = bytes(letters[c] for c in piece) if known else piece.encode()
        self.b_bytes = []
        for number in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(number)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode())
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in own], np.int64) for own in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = ([str(i) for i in range(len(own))] for own in (self.a_bytes, self.b_bytes))

    @classmethod
    def load(cls, folder: str) -> Sides:
        if folder not in cls._loaded:
            cls._loaded[folder] = cls(folder)
        return cls._loaded[folder]


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the other bytes as letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(text: str) -> Iterator[list[str]]:
    """The text between cuts, without the blank before each piece, some megabyte at a time."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + SLICE_CHARS) if len(text) - at > SLICE_CHARS else None
        end = cut.start() if cut else len(text)
        yield CUT.split(text[at:end])
        at = end + 1


class Segments:
    """The distinct pieces of a pack: ids of both sides, links and the text of their groups."""

    def __init__(self, sides: Sides):
        self.sides, self.number, self.fresh = sides, {}, []
        self.bad: set[int] = set()
        self.groups: list[str] = []
        self.counts: list[np.ndarray] = []  # per batch: n_a, n_b, n_groups, n_links of each piece
        self.links: list[np.ndarray] = []  # per batch: all links in order, as B id * 2**16 + A id

    def indexes(self, found: list[str]) -> array:
        number, out = self.number, array("i")
        for piece in found:
            at = number.get(piece)
            if at is None:
                at = number[piece] = len(number)
                self.fresh.append(piece)
            out.append(at)
        return out

    def encode(self) -> None:
        """Tokenize the pieces that are new, all at once."""
        if not self.fresh:
            return
        fresh, self.fresh = self.fresh, []
        sides, first = self.sides, len(self.groups)
        whole = [" " + p for p in fresh]
        ids_a = [e.ids for e in sides.a.encode_batch_fast(whole, add_special_tokens=False)]
        ids_b = sides.b.encode(fresh, num_threads=1)
        flat_a, flat_b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        body = "".join(whole).encode()
        if body != b"".join([sides.a_bytes[t] for t in flat_a]) or body != b"".join([sides.b_bytes[t] for t in flat_b]):
            for i, piece in enumerate(whole):
                own = piece.encode()
                if own != b"".join([sides.a_bytes[t] for t in ids_a[i]]) or own != b"".join([sides.b_bytes[t] for t in ids_b[i]]):
                    self.bad.add(first + i)
                    ids_a[i], ids_b[i] = [], []
            flat_a, flat_b = list(chain.from_iterable(ids_a)), list(chain.from_iterable(ids_b))
        n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
        a, b = [sides.a_names[t] for t in flat_a], [sides.b_names[t] for t in flat_b]
        flat_a, flat_b = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        ends_a, ends_b = np.cumsum(sides.a_sizes[flat_a]), np.cumsum(sides.b_sizes[flat_b])
        # Between two neighbouring ends of either side lies one link; where both end, a group does.
        ends = np.union1d(ends_a, ends_b)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        owner = np.repeat(np.arange(len(fresh)), n_a)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        self.links.append(flat_b[at_b] << 16 | flat_a[at_a])
        last_a, last_b = np.searchsorted(ends_a, both), np.searchsorted(ends_b, both)
        size = len(fresh)
        n_groups = np.bincount(owner[last_a], minlength=size)
        n_links = np.bincount(owner[at_a], minlength=size)
        self.counts.append(np.stack([n_a, n_b, n_groups, n_links], 1))
        texts, from_a, from_b = [], 0, 0
        for to_a, to_b in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            texts.append(",".join(a[from_a:to_a]) + "|" + ",".join(b[from_b:to_b]))
            from_a, from_b = to_a, to_b
        at = 0
        for n in n_groups.tolist():
            self.groups.append(";".join(texts[at:at + n]))
            at += n


def _packed(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides, part, number = Sides.load(folder), TaskContext.get().partitionId(), 0
        pack, size = _Pack(sides), 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole = text.as_py()
                if size and size + len(whole) > PACK_CHARS:
                    yield pack.batch((part << 32) + number)
                    pack, size, number = _Pack(sides), 0, number + 1
                pack.add(doc, whole)
                size += len(whole) + 64
        if pack.ids:
            yield pack.batch((part << 32) + number)

    return run


class _Pack:
    def __init__(self, sides: Sides):
        self.segments, self.ids, self.sha = Segments(sides), [], []
        self.ends, self.used = [], array("i")

    def add(self, doc: int | None, text: str) -> None:
        for found in pieces(text):
            self.used.extend(self.segments.indexes(found))
            if len(self.segments.fresh) > FRESH:
                self.segments.encode()
        self.ids.append(doc)
        self.ends.append(len(self.used))

    def _digests(self) -> None:
        """The digest of each text's groups; texts with a piece that can't be given back lose all pieces."""
        segments, every, start = self.segments, self.used, 0
        self.used = array("i")
        for i, end in enumerate(self.ends):
            own, start = every[start:end], end
            digest = hashlib.sha256()
            if own and (not segments.bad or segments.bad.isdisjoint(own)):
                for at in range(0, len(own), FRESH):
                    digest.update((";" if at else "").encode())
                    digest.update(";".join([segments.groups[k] for k in own[at:at + FRESH]]).encode())
                self.used.extend(own)
                self.sha.append(digest.hexdigest())
            else:
                self.sha.append("")
            self.ends[i] = len(self.used)

    def batch(self, number: int) -> pa.RecordBatch:
        self.segments.encode()
        self._digests()
        segments, used = self.segments, np.frombuffer(self.used, np.int32)
        counts = np.concatenate(segments.counts or [np.zeros((0, 4), np.int64)])
        links = np.concatenate(segments.links or [np.zeros(0, np.int64)])
        ends = np.array(self.ends, np.int64)
        totals = np.stack([_sums(counts[:, k][used], ends) for k in range(4)])
        link_ends = np.cumsum(counts[:, 3])
        times = np.bincount(used, minlength=len(counts))
        pairs, inverse = np.unique(links, return_inverse=True)
        weight = np.bincount(inverse, np.repeat(times, counts[:, 3]).astype(np.float64), len(pairs)).astype(np.int64)
        fields = [[number], [self.ids], [squeeze(totals.reshape(-1))], [self.sha], [squeeze(ends)], [squeeze(used)],
                  [squeeze(link_ends)], [squeeze(inverse.astype(np.int32))], [squeeze(np.diff(pairs, prepend=0))],
                  [squeeze(weight)], [len(pairs)]]
        return _batch(fields, PACK_SCHEMA)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of the stretches of ``values`` that end at ``ends``."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[ends], prepend=0)


def _batch(fields: list, ddl: str) -> pa.RecordBatch:
    schema = pa.schema([(name, ARROW[kind]) for name, kind in (f.split(" ") for f in ddl.split(", "))])
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(fields, schema, strict=True)], schema=schema)


def bucket_of(pairs: np.ndarray, buckets: int) -> np.ndarray:
    return ((pairs >> 16) * SLICES + (pairs & (SLICES - 1))) % buckets


def _runs(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):  # a pack at a time
                pack, packed, times = (batch.column(i)[k].as_py() for i in range(3))
                pairs, weight = np.cumsum(unsqueeze(packed, np.int64)), unsqueeze(times, np.int64)
                bucket = bucket_of(pairs, buckets)
                order = np.argsort(bucket, kind="stable")  # pairs stay in order within a bucket
                edges = np.searchsorted(bucket[order], np.unique(bucket))
                rows: list[list] = [[], [], [], []]
                for a, b in zip(edges, [*edges[1:], len(order)], strict=True):
                    own = order[a:b]
                    frames = [squeeze(np.concatenate((pairs[own[i:i + FRAME]], weight[own[i:i + FRAME]])))
                              for i in range(0, len(own), FRAME)]
                    for into, value in zip(rows, (int(bucket[own[0]]), pack, len(own), frames), strict=True):
                        into.append(value)
                yield _batch(rows, RUN_SCHEMA)

    return run


def merged(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct pairs in order with their counts, over runs of zstd frames, one frame of each at a time.

    The heap holds the last pair of each run's frame: up to the least of them all pairs are known.
    """
    heap: list[tuple[int, int]] = []
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    rest = [iter(frames) for frames in runs]

    def fill(i: int) -> None:
        frame = next(rest[i], None)
        if frame is not None:
            both = unsqueeze(frame, np.int64)
            held[i] = both[:len(both) // 2], both[len(both) // 2:]
            heapq.heappush(heap, (int(held[i][0][-1]), i))

    for i in range(len(runs)):
        fill(i)
    while heap:
        bound, taken, empty = heap[0][0], [], []
        for i, (pairs, counts) in held.items():
            n = int(np.searchsorted(pairs, bound, "right"))
            if n:
                taken.append((pairs[:n], counts[:n]))
                held[i] = pairs[n:], counts[n:]
            if n == len(pairs):
                empty.append(i)
        keys, inverse = np.unique(np.concatenate([p for p, _ in taken]), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, inverse, np.concatenate([c for _, c in taken]))
        yield keys, total
        for i in empty:
            del held[i]
        while heap and heap[0][0] <= bound:
            heapq.heappop(heap)
        for i in empty:
            fill(i)


def _answer(table: pa.Table) -> pa.Table:
    """The counts of a bucket, back to each of its runs in the run's order, and its highest count of each B id."""
    bucket = table.column("bucket")[0].as_py()
    packs, runs = table.column("pack").to_pylist(), table.column("frames").to_pylist()
    known = list(merged(runs))
    keys, counts = (np.concatenate(x) for x in zip(*known, strict=True))
    starts = np.nonzero(np.diff(keys >> 16, prepend=-1))[0]
    rows: list[list] = [[None], [bucket], [None], [squeeze(keys[starts] >> 16)], [squeeze(np.maximum.reduceat(counts, starts))]]
    for pack, frames in zip(packs, runs, strict=True):
        own = np.concatenate([(both := unsqueeze(f, np.int64))[:len(both) // 2] for f in frames])
        for into, value in zip(rows, (pack, bucket, squeeze(counts[np.searchsorted(keys, own)]), None, None), strict=True):
            into.append(value)
    return pa.Table.from_batches([_batch(rows, ANSWER_SCHEMA)])


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, tops in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield _batch([unsqueeze(ids, np.int64), unsqueeze(tops, np.int64)], "b bigint, top bigint")


def _documents(buckets: int, top: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a pack at a time
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                pairs, ends = np.cumsum(unsqueeze(row["pairs"], np.int64)), unsqueeze(row["doc_ends"], np.int64)
                count = np.zeros(len(pairs), np.int64)
                bucket = bucket_of(pairs, buckets)
                order = np.argsort(bucket, kind="stable")
                got = sorted(row["answers"] or [], key=lambda r: r["bucket"])
                if got:
                    count[order] = np.concatenate([unsqueeze(r["counts"], np.int64) for r in got])
                links, link_ends = unsqueeze(row["links"], np.int32), unsqueeze(row["link_ends"], np.int64)
                used = unsqueeze(row["segments"], np.int32)
                best = _sums((count == top[pairs >> 16])[links].astype(np.int64), link_ends)
                total = _sums(count[links], link_ends)
                totals = unsqueeze(row["totals"], np.int64).reshape(4, -1)
                yield _batch([row["ids"], *totals, _sums(best[used], ends), _sums(total[used], ends), row["sha"]], RESULT_SCHEMA)

    return run


def align(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``groups_sha256`` is the digest of the groups' ids, ``a1,a2|b1;a3|b2,b3``. A link is best
    if no other pair of its B id is linked more often in the corpus (ties are all best).
    Null and empty texts, and texts that a side can't give back byte by byte, have no tokens:
    zeros, an empty digest, and no share in any count. Rows that repeat an id are rows of their own; other columns
    are not read. The highest counts, a number for each B id of the vocabulary, go through the driver.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    packs = materialise(slim.mapInArrow(_packed(folder), PACK_SCHEMA), "align-packs")
    total = packs.agg(F.sum("n_pairs")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_PAIRS))
    runs = packs.filter("n_pairs > 0").select("pack", "pairs", "times").mapInArrow(_runs(buckets), RUN_SCHEMA)
    answers = materialise(
        runs.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_answer, ANSWER_SCHEMA), "align-counts")
    tops = answers.filter("pack is null").select("top_ids", "tops").mapInArrow(_tops, "b bigint, top bigint")
    top = np.zeros(1 << 16, np.int64)
    for b, most in tops.groupBy("b").agg(F.max("top")).collect():
        top[b] = most
    # Packs meet their counts by shuffle at every size, in as many tasks as there are dozens of packs.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), packs.count() // PACKS_A_TASK + 1)
    own = answers.filter("pack is not null").repartition(tasks, "pack").groupBy("pack").agg(
        F.collect_list(F.struct("bucket", "counts")).alias("answers"))
    met = packs.drop("n_pairs", "times").repartition(tasks, "pack").join(own.hint("merge"), "pack", "left")
    return met.mapInArrow(_documents(buckets, top), RESULT_SCHEMA)


if sys.byteorder != "little":  # frames are written as they lie in memory
    raise ImportError("little-endian machines only")
