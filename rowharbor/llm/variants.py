"""Spelling variants: words one edit apart, found by an index of variable-length grams.

A gram starts anywhere in a word (between marks for its ends) and is read on while more than
``LIST`` places of the vocabulary hold what was read, so that frequent stretches get longer
grams. The dictionary keeps the frequent stretches only, and is found level by level with counts. What gram
starts at a place depends on the letters of the gram alone, so an edit affects the grams
that it lies in and no other.

For each place of a word where an edit may be, the affected grams are known. If a rare gram is
unaffected there, both words of a pair have it at the same distance from the start or the end,
and its list, of ``LIST`` entries at most, holds both. Where all rare grams are affected, the lists of
all other letters are merged instead: the key is what stands before the place and behind it,
which at most as many words share as there are letters. So no list grows with the vocabulary.
Pairs of a list are verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.common import materialise, text_of

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SHORTEST, LONGEST, LIST = 5, 8, 16  # letters of a gram, with the marks; places that share one
HELD = 300_000  # distinct words a task counts before it passes them on
SLICE = 1 << 20


def runs(text: str) -> Iterator[list[str]]:
    """The lower-cased runs of a text, some megabyte at a time."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and RUN.match(text, end):  # never inside a run
            end = RUN.match(text, end).end()
        yield RUN.findall(text[at:end].translate(LOWER))
        at = end


def spelled(doc: str, run: str, every: int) -> str:
    """The run, without one of its code points if the digest of document and run says so."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """``word, n`` of all words of ``least`` or more code points; tasks count before they shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def known() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for run, n in Counter(chain.from_iterable(runs(text.as_py()))).items():
                    if len(run) >= least:
                        word = spelled(doc, run, every)
                        if len(word) >= least:
                            total[word] += n
                if len(total) > HELD:
                    yield known()
                    total.clear()
        yield known()

    slim = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), text_of().alias("text"))
    return slim.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def rare_grams(words: DataFrame) -> DataFrame:
    """``word, start, size`` of the grams of each word that ``LIST`` places or fewer share.

    Each level shuffles the places that are still open once, to their counts; the dictionary grows with
    the vocabulary, so it is never broadcast, whatever its size.
    """
    out, at = None, words.select("word", F.explode(F.sequence(F.lit(1), F.length("word") + (3 - SHORTEST))).alias("start"))
    for size in range(SHORTEST, LONGEST + 1):
        at = at.withColumn("gram", F.substring(F.concat(F.lit("^"), "word", F.lit("$")), F.col("start"), F.lit(size)))
        frequent = at.groupBy("gram").agg(F.count("*").alias("_n")).filter(F.col("_n") > LIST)
        told = materialise(at.join(frequent.hint("merge"), "gram", "left").select("word", "start", F.col("_n").isNotNull().alias("more")),
                           f"grams-{size}")
        rare = told.filter("not more").select("word", "start", F.lit(size).alias("size"))
        out = rare if out is None else out.unionAll(rare)
        at = told.filter(F.col("more") & (F.col("start") + size <= F.length("word") + 2)).select("word", "start")
    return out


def list_keys(word: str, grams: list[tuple[int, int]]) -> set[str]:
    """The lists of a word: for each letter that may go or change, and each gap that may get a
    letter, the first unaffected rare gram in an order of all grams, or else all that is unaffected."""
    padded = f"^{word}$"
    end = len(padded)
    order = sorted((xxhash.xxh64_intdigest(g := padded[s:s + n]), s, s + n, g) for s, n in grams)
    keys = set()
    for place in range(1, end):
        for behind in ((place + 1, place) if place < end - 1 else (place,)):  # the letter at the place; the gap before it
            for _, start, stop, gram in order:
                if stop <= place:
                    keys.add(f"<{start}:{gram}")
                    break
                if start >= behind:
                    keys.add(f">{end - start}:{gram}")
                    break
            else:
                keys.add(f"{padded[:place]} {padded[behind:]}")
    return keys


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys: list[int] = []
        words: list[str] = []
        counts: list[int] = []
        columns = [batch.column(c).to_pylist() for c in ("word", "n", "starts", "sizes")]
        for word, n, starts, sizes in zip(*columns, strict=True):
            own = list_keys(word, [(s - 1, z) for s, z in zip(starts, sizes, strict=True)])
            keys += [xxhash.xxh64_intdigest(k) - (1 << 63) for k in own]
            words += [word] * len(own)
            counts += [n] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.string()), pa.array(counts, pa.int64())],
                                         names=["key", "word", "n"])


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b, n_a, n_b``: each pair of words (a < b) that one edit turns into each other, once."""
    entries = words.select("word", "n", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("size")).unionAll(
        rare_grams(words).select("word", F.lit(None).cast("bigint"), "start", "size"))
    listed = entries.groupBy("word").agg(  # a word has no more grams than letters
        F.max("n").alias("n"), F.collect_list(F.struct("start", "size")).alias("grams"))
    real = F.filter("grams", lambda g: g["start"].isNotNull())
    listed = listed.select("word", "n", F.transform(real, lambda g: g["start"]).alias("starts"),
                           F.transform(real, lambda g: g["size"]).alias("sizes"))
    keys = materialise(listed.mapInArrow(_keyed, "key bigint, word string, n bigint"), "gram-lists")
    left = keys.select("key", F.col("word").alias("a"), F.col("n").alias("n_a"))
    right = keys.select("key", F.col("word").alias("b"), F.col("n").alias("n_b"))
    met = left.join(right, "key").filter((F.col("a") < F.col("b")) & (F.levenshtein("a", "b", 1) == 1))
    return met.groupBy("a", "b").agg(F.max("n_a").alias("n_a"), F.max("n_b").alias("n_b"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root``: where the forms lead in the end. Counts grow tenfold at each step, so
    chains are short; each round doubles the steps taken."""
    known = forms.select("word", F.col("form").alias("root"))
    while True:
        ahead = known.select(F.col("word").alias("_word"), F.col("root").alias("_ahead"))
        known = materialise(
            known.join(ahead, F.col("root") == F.col("_word"), "left")
            .select("word", F.coalesce("_ahead", "root").alias("root"), F.col("_ahead").isNotNull().alias("_moved")), "roots")
        if known.filter("_moved").isEmpty():
            return known.select("word", "root")
        known = known.drop("_moved")


def group_variants(docs: DataFrame, least: int = 7, least_count: int = 2, times: int = 10, every: int = 31) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of the corpus.

    Words are runs of letters, lower-cased in A-Z, of which those that a digest of document and
    run picks (one in ``every``) lose one code point; they have ``least`` or more code points and
    occur ``least_count`` times or more. The form of a word is the most frequent word one edit away (ties: the
    least in code-point order) if it occurs ``times`` as often. Null and empty texts have no
    words, a null id counts as an empty one in the digest, repeated rows count as often as they are there.
    """
    words = materialise(word_counts(docs, least, every).filter(F.col("n") >= least_count), "words")
    pairs = materialise(near_pairs(words), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionAll(
        pairs.select(F.col("b"), F.col("a"), F.col("n_a")))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= F.lit(times) * F.col("n")
    found = materialise(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")), "variants")
    ends = roots(found.filter("form is not null"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
