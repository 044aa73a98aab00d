"""Packs of whole texts, and an exchange of sorted keys between packs.

Work on all positions of a corpus would shuffle a row for each. Here a task turns a pack of texts
into sorted arrays of distinct 64-bit keys, one for each bucket of a second, independent hash;
Spark shuffles these arrays by bucket, a bucket's task answers for every key, and the answers go
back to the pack, in the order of its keys. A key reaches its bucket once per pack, so a frequent
one is no hot spot, and the number of buckets follows the size of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, text_of

PACK_SCHEMA = "pack bigint, ids array<bigint>, marks array<bigint>, bytes bigint, ends binary, body binary"
PACK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20


def squeeze(values: np.ndarray) -> bytes:
    """Numbers by byte planes, compressed: high bytes that are all zero take no room."""
    wide = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize)
    return zstandard.compress(np.ascontiguousarray(wide.T).tobytes(), 1)


def unsqueeze(blob: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    planes = raw.reshape(size, len(raw) // size)
    return np.ascontiguousarray(planes.T).view(dtype).reshape(-1)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(blob, np.uint64), dtype=np.uint64)


def mixed(state: np.ndarray, word: np.ndarray, factor: int) -> np.ndarray:
    """One round of a multiply-xorshift hash over arrays."""
    state = (state ^ word) * np.uint64(factor)
    return state ^ (state >> np.uint64(29))


FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)  # odd numbers of two independent hashes


def pack_texts(docs: DataFrame, mark: Column, tag: str) -> DataFrame:
    """All texts in packs of about 4 MB, in order of id (null first) over all packs.

    ``mark`` is a number kept with each text. Pack numbers rise with the ids. A longer text has a
    pack to itself. The packs are written to the shared scratch folder.
    """
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), mark.cast("bigint").alias("mark"),
                       text_of().cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        marks: list[int] = []
        texts: list[bytes] = []
        size = 0

        def pack() -> pa.RecordBatch:
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            body = zstandard.compress(b"".join(texts), 1)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([marks], pa.list_(pa.int64())), pa.array([size], pa.int64()),
                 pa.array([ends.tobytes()], pa.binary()), pa.array([body], pa.binary())],
                names=["pack", "ids", "marks", "bytes", "ends", "body"])

        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), batch.column("text"), strict=True)
            for doc, own, text in rows:
                raw = text.as_py()
                if texts and size + len(raw) > PACK_BYTES:
                    yield pack()
                    number, ids, marks, texts, size = number + 1, [], [], [], 0
                ids.append(doc)
                marks.append(own)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield pack()

    order = F.col("doc_id").asc_nulls_first()
    return materialise(slim.repartitionByRange(order).sortWithinPartitions(order, "text").mapInArrow(run, PACK_SCHEMA), tag)


@dataclass
class Pack:
    """A pack in a task: ``body`` holds all texts, text i ends at ``ends[i]``."""

    number: int
    ids: list[int | None]
    marks: np.ndarray
    body: bytes
    ends: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate(([0], self.ends[:-1])).astype(np.int64)


def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[Pack, int]]:
    for i in range(batch.num_rows):
        yield Pack(
            batch.column("pack")[i].as_py(), batch.column("ids")[i].as_py(),
            np.array(batch.column("marks")[i].as_py(), np.int64),
            zstandard.decompress(batch.column("body")[i].as_py()),
            np.frombuffer(batch.column("ends")[i].as_py(), np.int64),
        ), i


def bucket_count(packs: DataFrame) -> int:
    """So many buckets that one holds the keys of about 8 MB of text; one per shuffle partition at least."""
    total = packs.agg(F.sum("bytes")).first()[0] or 0
    return max(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


def dealt(key: np.ndarray, other: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By bucket of ``other``: bucket, its places in ``key``, distinct sorted keys, the first place
    of each (within those places), and for each place the number of its key."""
    bucket = other % np.uint64(buckets)
    order = np.argsort(bucket.astype(np.uint16 if buckets < 1 << 16 else np.uint64), kind="stable")
    sorted_buckets, sorted_keys = bucket[order], key[order]
    edges = np.concatenate(([0], np.nonzero(sorted_buckets[1:] != sorted_buckets[:-1])[0] + 1, [len(order)])) if len(order) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        distinct, first, inverse = np.unique(sorted_keys[a:b], return_index=True, return_inverse=True)
        yield int(sorted_buckets[a]), order[a:b], distinct, first, inverse


def exchanged(packs: DataFrame, emit: Callable, answer: Callable, emitted: str, answered: str, tag: str) -> DataFrame:
    """Send what ``emit(pack, answers so far)`` gives to its buckets and write the answers.

    ``emit`` yields tuples of the columns of ``emitted``, which begins with ``bucket, pack, kind``;
    ``answer`` gets the rows of one bucket and kind by pack and yields tuples of ``answered``.
    """
    sent, got = _arrow_schema(packs, emitted), _arrow_schema(packs, answered)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            more = [c for c in batch.schema.names if c.startswith("got_")]
            for pack, i in unpacked(batch):
                rows = list(emit(pack, *[batch.column(c)[i].as_py() or [] for c in more]))
                yield _batch(rows, sent)

    def reply(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["pack"])
        return pa.Table.from_batches([_batch(list(answer(rows)), got)])

    return materialise(
        packs.mapInArrow(send, emitted).groupBy("bucket", "kind").applyInArrow(reply, answered), tag)


def with_answers(packs: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``packs`` with an array column of the answers to each."""
    fields = F.struct(*[c for c in answers.columns if c != "pack"])
    own = answers.groupBy("pack").agg(F.collect_list(fields).alias(f"got_{name}"))
    return packs.join(own, "pack", "left")


def _arrow_schema(df: DataFrame, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
