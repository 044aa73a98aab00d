"""N-gram scores by deleted interpolation: mixture weights per context frequency, learned by EM."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowharbor.llm.packs import (
    FACTORS,
    Pack,
    bucket_count,
    dealt,
    exchanged,
    mixed,
    pack_texts,
    squeeze,
    squeeze_sorted,
    unpacked,
    unsqueeze,
    unsqueeze_sorted,
    with_answers,
)

END = b""  # no word is empty
FOLDS, HELD_OUT, DELETED = 5, 1, 4
STEPS = 4  # histogram cells per doubling
ABSENT = -10_000
BUCKETS = 48  # context counts by powers of two

EMITTED = "bucket bigint, pack bigint, kind int, keys binary, train binary, rest binary"
ANSWERED = "pack bigint, bucket bigint, kind int, train binary, rest binary, n_distinct bigint, n_train bigint, n_rest bigint"
RESULT = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


class Tokens:
    """The tokens of a pack: local word numbers, the word before each, and the distinct pairs."""

    def __init__(self, pack: Pack):
        vocabulary = {END: 0}
        number = vocabulary.setdefault
        ids: list[int] = []
        lengths = []
        for start, end in zip(pack.starts.tolist(), pack.ends.tolist(), strict=True):
            words = pack.body[start:end].lower().split()
            ids += [number(w, len(vocabulary)) for w in words]
            ids.append(0)
            lengths.append(len(words) + 1)
        self.word = np.array(ids, np.int64)
        self.context = np.concatenate(([0], self.word[:-1])).astype(np.int64)  # a text starts after an end
        self.lengths = np.array(lengths, np.int64)
        self.fold = np.repeat(pack.marks, self.lengths)
        raw = b"".join([xxhash.xxh3_128_digest(w) for w in vocabulary])
        self.key = np.frombuffer(raw, np.uint64).reshape(-1, 2)
        self.size = len(vocabulary)
        self.pair, self.pair_of = np.unique(self.context * self.size + self.word, return_inverse=True)

    def keys(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        if kind == 1:
            return self.key[:, 0], self.key[:, 1]
        a, b = self.key[self.pair // self.size], self.key[self.pair % self.size]
        return tuple(mixed(mixed(a[:, k], np.uint64(0), FACTORS[k]), b[:, k], FACTORS[k]) for k in (0, 1))

    def counts(self, kind: int) -> tuple[np.ndarray, np.ndarray]:
        """In training, and in training without the deleted part."""
        at, n = (self.word, self.size) if kind == 1 else (self.pair_of, len(self.pair))
        train = self.fold != HELD_OUT
        rest = train & (self.fold != DELETED)
        return tuple(np.bincount(at[m], minlength=n).astype(np.uint32) for m in (train, rest))


def _emit(buckets: int):
    def run(pack: Pack) -> Iterator[tuple]:
        tokens = Tokens(pack)
        for kind in (1, 2):
            train, rest = tokens.counts(kind)
            for bucket, at, keys, first, _ in dealt(*tokens.keys(kind), buckets):
                own = at[first]
                yield bucket, pack.number, kind, squeeze_sorted(keys), squeeze(train[own]), squeeze(rest[own])

    return run


def _answer(rows: list[dict]) -> Iterator[tuple]:
    """The counts of every key over all packs, sent to each pack in the order of its keys."""
    keys = [unsqueeze_sorted(r["keys"]) for r in rows]
    _, number = np.unique(np.concatenate(keys), return_inverse=True)
    totals = {}
    for name in ("train", "rest"):
        own = np.concatenate([unsqueeze(r[name], np.uint32) for r in rows])
        totals[name] = np.bincount(number, own).astype(np.uint64)
    edges = np.cumsum([len(k) for k in keys])[:-1]
    for i, (row, piece) in enumerate(zip(rows, np.split(number, edges), strict=True)):
        first = i == 0  # the sums of a bucket stand in one row
        yield (row["pack"], row["bucket"], row["kind"], squeeze(totals["train"][piece]), squeeze(totals["rest"][piece]),
               int((totals["train"] > 0).sum()) * first, int(totals["train"].sum()) * first, int(totals["rest"].sum()) * first)


def _corpus_counts(tokens: Tokens, got: list[dict], buckets: int, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: corpus count of the word, of its context and of the pair."""
    by = {(g["kind"], g["bucket"]): g for g in got}
    out = []
    for kind in (1, 2):
        total = np.zeros(tokens.size if kind == 1 else len(tokens.pair), np.uint64)
        for bucket, at, _, _, number in dealt(*tokens.keys(kind), buckets):
            total[at] = unsqueeze(by[kind, bucket][which], np.uint64)[number]
        out.append(total.astype(np.float64))
    return out[0][tokens.word], out[0][tokens.context], out[1][tokens.pair_of]


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(BUCKETS - 1, np.ceil(np.log2(count + 1)).astype(np.int64))


def _estimates(word: np.ndarray, context: np.ndarray, pair: np.ndarray, total: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates of the word after its context, and of the word."""
    return pair / np.maximum(context, 1), word / max(total, 1)


def learn_weights(cells: list[tuple[int, int, int, int]], rounds: int = 60) -> np.ndarray:
    """Weights (pair, word, uniform) per bucket of the context's count, by EM on held-out events.

    ``cells`` are (bucket, estimate of the pair over the uniform one, of the word over it, events);
    ratios are in steps of a logarithm. A bucket without events takes the weights of all.
    """
    table = np.array(cells, np.int64).reshape(-1, 4)
    ratios = np.where(table[:, 1:3] == ABSENT, 0.0, 2.0 ** (table[:, 1:3] / STEPS))
    parts = np.column_stack([ratios, np.ones(len(table))])
    events = table[:, 3].astype(np.float64)

    def fitted(own: np.ndarray) -> np.ndarray:
        weights = np.full(3, 1 / 3)
        if events[own].sum():
            for _ in range(rounds):
                share = parts[own] * weights
                share /= share.sum(axis=1, keepdims=True)
                weights = (share * events[own, None]).sum(axis=0) / events[own].sum()
        return np.maximum(weights, 1e-9) / np.maximum(weights, 1e-9).sum()

    pooled = fitted(np.ones(len(table), bool))
    return np.array([fitted(table[:, 0] == b) if (table[:, 0] == b).any() else pooled for b in range(BUCKETS)])


def score_texts(docs: DataFrame) -> DataFrame:
    """Log10 probabilities of every text under an interpolated bigram model, and a unigram base.

    Texts are lower-cased (A-Z), cut at white space, and end with an end token; the first word
    follows an end. Those whose ``crc32(doc_id) mod 5`` is 1 are held out of all counts. Among the
    others, those with remainder 4 are deleted from the counts while the weights are learned: EM
    finds, for each power of two of the context's count, how much the estimates of the pair, of the
    word and the uniform one are worth on them. Scores then use the counts of all training texts.

    Counts are exact and cover the corpus; a frequent word or pair is summed within its pack first.
    The events for EM are summed by bucket and quarter octaves of both estimates, at most some
    hundred thousand cells however large the corpus is, and these come to the driver.

    One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score``. Null text is empty and has one token; rows without an id are in training; repeated rows
    count as often as they occur. Without training texts, all words are unknown.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    packs = pack_texts(docs, F.coalesce(remainder, F.lit(0)), "lm-packs")
    buckets = bucket_count(packs)
    answers = exchanged(packs, _emit(buckets), _answer, EMITTED, ANSWERED, "lm-counts")
    words = answers.filter("kind = 1").agg(F.sum("n_distinct"), F.sum("n_train"), F.sum("n_rest")).first()
    distinct, total, rest = (float(x or 0) for x in words)
    counted = with_answers(packs, answers.select("pack", "bucket", "kind", "train", "rest"), "counts")

    def events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, i in unpacked(batch):
                tokens = Tokens(pack)
                own = tokens.fold == DELETED
                word, context, pair = (c[own] for c in _corpus_counts(tokens, batch.column("got_counts")[i].as_py(), buckets, "rest"))
                cells = [context_bucket(context)]
                for estimate in _estimates(word, context, pair, rest):
                    with np.errstate(divide="ignore"):
                        steps = np.round(np.log2(estimate * (distinct + 1)) * STEPS)
                    cells.append(np.where(estimate > 0, steps, ABSENT).astype(np.int64))
                found, n = np.unique(np.column_stack(cells), axis=0, return_counts=True)
                yield pa.RecordBatch.from_arrays([*(pa.array(found[:, k]) for k in range(3)), pa.array(n)], names=["b", "p", "w", "n"])

    summed = counted.mapInArrow(events, "b bigint, p bigint, w bigint, n bigint").groupBy("b", "p", "w").agg(F.sum("n"))
    weights = learn_weights([tuple(r) for r in summed.collect()])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, i in unpacked(batch):
                tokens = Tokens(pack)
                word, context, pair = _corpus_counts(tokens, batch.column("got_counts")[i].as_py(), buckets, "train")
                base = np.log10((word + 0.5) / (total + 0.5 * (distinct + 1)))
                of_pair, of_word = _estimates(word, context, pair, total)
                own = weights[context_bucket(context)]
                model = np.log10(own[:, 0] * of_pair + own[:, 1] * of_word + own[:, 2] / (distinct + 1))
                at = np.concatenate(([0], np.cumsum(tokens.lengths)[:-1]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack.ids, pa.int64()), pa.array(pack.marks == HELD_OUT), pa.array(tokens.lengths),
                     pa.array(np.add.reduceat((word > 0).astype(np.int64), at)),
                     pa.array(np.full(len(at), int(total), np.int64)),
                     pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(model, at))],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return counted.mapInArrow(scores, RESULT)
