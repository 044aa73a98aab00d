"""Benchmark decontamination: rare word pairs as seeds, then Smith-Waterman alignment."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, spare, text_of

HIT_SCHEMA = "doc_id bigint, item_id bigint, score double, item_words bigint, first_word bigint, last_word bigint"


@dataclass(frozen=True)
class Items:
    """A bounded block of test items as word numbers; seeds are pairs of near words as numbers."""

    vocabulary: dict[bytes, int]
    ids: list[int | None]
    words: list[np.ndarray]
    threshold: float
    singles: bool  # whether some item is seeded by single words

    def pair(self, first: np.ndarray, second: np.ndarray | int) -> np.ndarray:
        return first * (len(self.vocabulary) + 1) + second

    def seeds_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All seeds of an item as (number, place), its words alone where pairs are too few."""
        places = np.arange(len(words))
        if matches(len(words), self.threshold) < 2:
            return self.pair(words, len(self.vocabulary)), places
        return (np.concatenate([self.pair(words[:-d], words[d:]) for d in (1, 2)]),
                np.concatenate([places[:-d] for d in (1, 2)]))

    def seeds_in(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All that can be a seed in a document, as (number, place)."""
        numbers, places = [], []
        for d in (1, 2):
            at = np.nonzero((words[:-d] >= 0) & (words[d:] >= 0))[0]
            numbers.append(self.pair(words[at], words[at + d]))
            places.append(at)
        if self.singles:
            at = np.nonzero(words >= 0)[0]
            numbers.append(self.pair(words[at], len(self.vocabulary)))
            places.append(at)
        return np.concatenate(numbers), np.concatenate(places)

    def numbered(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        look = self.vocabulary.get
        return np.fromiter((look(w, -1) for w in words), np.int64, len(words))


def matches(length: int, threshold: float) -> int:
    """How many words of an item of this length a copy at the threshold matches at least."""
    return max(1, math.ceil(threshold * length - 1e-9))


def item_block(rows: list[tuple[int | None, bytes]], threshold: float) -> Items:
    """Number the words of the items; items without words are left out."""
    vocabulary: dict[bytes, int] = {}
    ids, words = [], []
    for item, text in rows:
        own = [vocabulary.setdefault(w, len(vocabulary)) for w in text.lower().split()]
        if own:
            ids.append(item)
            words.append(np.array(own, np.int64))
    return Items(vocabulary, ids, words, threshold, any(matches(len(w), threshold) < 2 for w in words))


def align(doc: np.ndarray, item: np.ndarray, mismatch: float = 0.5, gap: float = 0.5) -> tuple[float, int, int]:
    """Best local alignment of word lists: score (1 a match), and the words of ``doc`` it spans.

    One row of the table per item word, all columns at once: a gap along the row is a running
    maximum. The start of the best path is carried along with the scores.
    """
    n = len(doc)
    steps = np.arange(n + 1) * gap
    above, from_above = np.zeros(n + 1), np.arange(n + 1)
    best, first, last = 0.0, 0, 0
    for word in item:
        row, start = np.zeros(n + 1), np.arange(n + 1)
        diagonal = above[:-1] + np.where(doc == word, 1.0, -mismatch)
        down = above[1:] - gap
        row[1:] = np.maximum(np.maximum(diagonal, down), 0.0)
        start[1:] = np.where(diagonal >= down, from_above[:-1], from_above[1:])
        start[row == 0.0] = np.arange(n + 1)[row == 0.0]
        lifted = row + steps
        top = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(n + 1), 0))
        row, start = top - steps, start[source]
        at = int(row.argmax())
        if row[at] > best + 1e-12:
            best, first, last = float(row[at]), int(start[at]), at
        above, from_above = row, start
    return best, first, last


def windows(places: np.ndarray, inside: np.ndarray, length: int, total: int, threshold: float) -> list[tuple[int, int]]:
    """Where a copy of an item with these seeds can lie, with all words it can have added; overlaps merge."""
    spare = math.floor(2 * (1 - threshold) * length + 1e-9) + 1
    low = np.maximum(0, places - inside - spare)
    high = np.minimum(total, places - inside + length + spare)
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(low.tolist(), high.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _seed_counts(docs: DataFrame, items: Items) -> dict[int, int]:
    """In how many documents each possible seed of the items occurs."""
    wanted = np.unique(np.concatenate([items.seeds_of(w)[0] for w in items.words]))
    shared = docs.sparkSession.sparkContext.broadcast((items, wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, wanted = shared.value
        counts = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for text in batch.column("text"):
                found = np.unique(items.seeds_in(items.numbered(text.as_py()))[0])
                at = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
                counts[at[wanted[at] == found]] += 1
        there = counts > 0
        yield pa.RecordBatch.from_arrays([pa.array(wanted[there]), pa.array(counts[there])], names=["seed", "n"])

    found = docs.select(text_of().cast("binary").alias("text")).mapInArrow(run, "seed bigint, n bigint")
    return {r[0]: r[1] for r in found.groupBy("seed").agg(F.sum("n")).collect()}  # at most the items' seeds


def _rare(items: Items, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rarest seeds of each item as (seed, item, place in the item), by seed.

    A copy that scores t matches m words of the item's L and has at most 2 (m - t L) words changed,
    added or left out, so of its m - 1 steps from match to match at most m - t L pass more than one
    of them. The others, t L - 1 at least, start at different places of the item and show a pair
    of its words at distance 1 or 2 in both texts. So all copies hold a seed of some place if only
    the places that are one fewer than these are left out, the commonest ones. Where t L is at
    most 1 a single match may be all, and every word is a seed.
    """
    out = []
    for k, words in enumerate(items.words):
        seeds, places = items.seeds_of(words)
        seen = np.bincount(places, [counts.get(s, 0) for s in seeds.tolist()], len(words))
        starts = np.unique(places)
        keep = len(words) - matches(len(words), items.threshold) + 1
        chosen = np.isin(places, starts[np.argsort(seen[starts], kind="stable")[:keep]])
        out += [(s, k, p) for s, p in zip(seeds[chosen].tolist(), places[chosen].tolist(), strict=True) if s in counts]
    table = np.array(sorted(out), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _hits(docs: DataFrame, items: Items, seeds: tuple, threshold: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((items, seeds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, (seeds, owner, place) = shared.value
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                words = items.numbered(text.as_py())
                own, at = items.seeds_in(words)
                low, high = np.searchsorted(seeds, own, "left"), np.searchsorted(seeds, own, "right")
                at, low, n = at[high > low], low[high > low], (high - low)[high > low]
                if not len(at):
                    continue
                which = np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                places = np.repeat(at, n)
                for k in np.unique(owner[which]).tolist():
                    mine = owner[which] == k
                    item = items.words[k]
                    best = (0.0, 0, 0)
                    for a, b in windows(places[mine], place[which][mine], len(item), len(words), threshold):
                        value, first, last = align(words[a:b], item)
                        best = max(best, (value, a + first, a + last), key=lambda x: (x[0], -x[1]))
                    if best[0] >= threshold * len(item):
                        out.append((doc, items.ids[k], best[0] / len(item), len(item), best[1], best[2]))
            columns = list(zip(*out, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "item_id", "score", "item_words", "first_word", "last_word"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().cast("binary").alias("text"))
    return slim.mapInArrow(run, HIT_SCHEMA)


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.6, block_words: int = 500_000) -> DataFrame:
    """Documents that hold an exact, edited or paraphrased copy of a test item.

    ``doc_id, item_id, score, item_words, first_word, last_word``, one row per row of ``docs`` and
    item at ``threshold`` or more: the best local alignment of their lower-cased words (1 a match,
    -0.5 a changed, added or left out word) by the item's words; the span counts words, end
    exclusive. Alignments are made where a rare pair of words of the item occurs, of so many of
    its pairs that no copy at the threshold can lack them all.

    Items are a query set: they reach the tasks in blocks of about ``block_words`` words, whose
    number is counted first, one pass over ``docs`` for the counts and one for the alignments per
    block. Items without words or with null text match nothing; null and empty texts hold
    nothing. Equal items and repeated rows each give their own rows.
    """
    own = materialise(
        benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_of().cast("binary").alias("text"),
                         F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).alias("words")),
        "items",
    )
    total = own.agg(F.sum("words")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    found = None
    for block in range(blocks):
        rows = own.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).select("item_id", "text").collect()
        items = item_block(sorted(((r[0], bytes(r[1])) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])), threshold)
        if not items.words:
            continue
        seeds = _rare(items, _seed_counts(docs, items))
        hits = _hits(docs, items, seeds, threshold)
        found = hits if found is None else found.unionByName(hits)
    return found if found is not None else docs.sparkSession.createDataFrame([], HIT_SCHEMA)


def without_leaks(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that hold no test item; rows without an id are judged by their text."""
    key = F.xxhash64("doc_id", "text")
    marked = docs.select(key.alias("doc_id"), "text")
    own, row = spare(docs, "_key"), spare(docs, "_row")
    hit = materialise(leaks(marked, benchmark, **options).select(F.col("doc_id").alias(row)).distinct(), "leaks")
    return docs.withColumn(own, key).join(hit, F.col(own) == F.col(row), "left_anti").drop(own)
