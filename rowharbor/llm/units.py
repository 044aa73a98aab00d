"""Line deduplication: the first occurrence of each unit in the whole corpus stays.

A unit is a sentence of a line: it ends where the line does, or at a blank behind a full stop, exclamation
or question mark. So a passage that many documents share is found within longer lines too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, row_digest, spare, text_of

UNIT_SCHEMA = ("row bigint, doc_id bigint, unit bigint, `start` bigint, `end` bigint, words bigint, "
               "hi bigint, lo bigint")


SENTENCE_END = re.compile(r"([.!?]) ")


def text_units(text: str, separator: str = "\n") -> Iterator[tuple[int, int, str]]:
    """``(start, end, unit)`` of each stretch between separators and sentence ends, by code points, end exclusive.

    The separator is one character, and so is the blank that ends a sentence.
    """
    at = 0
    for unit in SENTENCE_END.sub(rf"\1{separator}", text).split(separator):
        yield at, at + len(unit), unit
        at += len(unit) + 1


def normal(unit: str) -> list[str]:
    """The words of a unit, lower-cased; white space of any kind and amount separates them."""
    return unit.lower().split()


def units(docs: DataFrame, separator: str = "\n") -> DataFrame:
    """One row per unit with a word: place among them, offsets and a 128-bit digest of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            digests = []
            for row, doc, text in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                number = 0
                for start, end, unit in text_units(text, separator):
                    if words := normal(unit):
                        for into, value in zip(out, (row, doc, number, start, end, len(words)), strict=False):
                            into.append(value)
                        digests.append(hashlib.md5(" ".join(words).encode("utf-8", "surrogatepass")).digest())
                        number += 1
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(v, pa.int64()) for v in out[:6]), pa.array(halves[:, 0]), pa.array(halves[:, 1])],
                names=["row", "doc_id", "unit", "start", "end", "words", "hi", "lo"])

    slim = docs.select(row_digest().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return slim.mapInArrow(run, UNIT_SCHEMA)


def repeated_units(docs: DataFrame, separator: str = "\n") -> DataFrame:
    """The units to remove: all but the first of each digest, by document id, then place.

    Returns ``doc_id, unit, start, end, words, first_doc_id``, offsets in code points of the
    original text. First occurrences are found by an aggregate that combines within tasks, so a
    unit that is everywhere reaches the shuffle once per task; only digests that repeat are joined
    back, and that join can be split at a hot digest.

    ``unit`` counts the units with a word of a text. Null and empty texts have no units. Rows without an id come
    after all others; rows that repeat an id and a text count as one, so that text keeps its
    first occurrence in each of them.
    """
    all_units = materialise(units(docs, separator), "units")
    rank = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "row", "unit")
    firsts = materialise(
        all_units.groupBy("hi", "lo").agg(F.min(rank).alias("first"), F.max(rank).alias("last"))
        .filter("first != last").select("hi", "lo", "first"),
        "repeats",
    )
    named = all_units.withColumn("rank", rank).join(firsts, ["hi", "lo"]).filter("rank != first")
    return named.select("doc_id", "unit", "start", "end", "words", F.col("row"),
                        F.when(F.col("first.doc") < (1 << 63) - 1, F.col("first.doc")).alias("first_doc_id"))


def without_units(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` whose text lacks the removed units, each with the separator after it."""
    row, doc, spans = spare(docs, "_row"), spare(docs, "_id"), spare(docs, "_cuts")
    cuts = removed.groupBy(F.col("row").alias(row), F.col("doc_id").alias(doc)).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias(spans))
    own = (row_digest() == F.col(row)) & F.col("doc_id").eqNullSafe(F.col(doc))
    pieces = F.aggregate(
        spans, F.struct(F.lit("").alias("kept"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, cut: F.struct(
            F.concat(acc["kept"], F.substring("text", acc["at"] + 1, cut["start"] - acc["at"])).alias("kept"),
            (cut["end"] + 1).alias("at")),
        lambda acc: F.concat(acc["kept"], F.substring("text", acc["at"] + 1, F.length("text"))),
    )
    return (
        docs.join(cuts, own, "left")
        .withColumn("text", F.when(F.col(spans).isNull(), F.col("text")).otherwise(pieces))
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def removal_report(docs: DataFrame, removed: DataFrame, passage: int = 20) -> DataFrame:
    """One row per row of ``docs``: how many units and words go, their spans by start, and what tells
    shared passages from single lines: ``longest_run``, the most words in neighbouring units that go, and
    ``n_passages``, how many such runs have ``passage`` words or more. All of them go, short or long.

    Rows that repeat an id and a text, or have no id, have rows of their own.
    """
    own = F.struct("start", "end", "unit", "words", "first_doc_id")
    cuts = removed.groupBy(F.col("row").alias("_row")).agg(F.sort_array(F.collect_set(own)).alias("_spans"))
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("longest"), zero.alias("passages"), zero.alias("run"), F.lit(-2).cast("bigint").alias("unit"))

    def step(acc: Column, span: Column) -> Column:
        before = F.when(span["unit"] == acc["unit"] + 1, acc["run"]).otherwise(0)
        run = before + span["words"]
        begun = (before < passage) & (run >= passage)
        return F.struct(F.greatest(acc["longest"], run).alias("longest"), (acc["passages"] + begun.cast("bigint")).alias("passages"),
                        run.alias("run"), span["unit"].alias("unit"))

    runs = F.aggregate("_spans", start, step)
    words = F.aggregate("_spans", zero, lambda acc, s: acc + s["words"])
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_digest().alias("_row"))
    return slim.join(cuts, "_row", "left").withColumn("_runs", runs).select(
        "doc_id", F.greatest(F.size("_spans"), F.lit(0)).cast("bigint").alias("n_units"),
        F.coalesce(words, zero).alias("n_words"), F.coalesce("_runs.longest", zero).alias("longest_run"),
        F.coalesce("_runs.passages", zero).alias("n_passages"),
        F.coalesce(F.array_join(F.transform("_spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ","), F.lit("")).alias("spans"),
        F.coalesce(F.transform("_spans", lambda s: s["first_doc_id"]), F.array().cast("array<bigint>")).alias("first_doc_ids"),
    )
