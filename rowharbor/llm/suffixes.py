"""Exact removal of repeated byte strings, by a sampled suffix sort with a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
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
    squeeze_sorted,
    unpacked,
    unsqueeze_sorted,
    with_answers,
)

# Every number modulo 73 is the difference of two of these (a perfect difference set: fixed values).
COVER = (1, 2, 4, 8, 16, 32, 37, 55, 64)
PERIOD = 73
EMITTED = "bucket bigint, pack bigint, kind int, keys binary"
ANSWERED = "pack bigint, bucket bigint, kind int, bits binary"
KEYS, STATE = 0, 1
ANCHOR_BITS = 4  # one place in 16 is an anchor
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def digests(body: bytes, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of the ``width`` bytes (8 at least) at each place."""
    words = np.ndarray((max(0, len(body) - 7),), "<u8", body, strides=(1,))
    offsets = [*range(0, width - 7, 8)]
    if width % 8:
        offsets.append(width - 8)
    one = np.full(len(places), FACTORS[1], np.uint64)
    two = np.full(len(places), FACTORS[0], np.uint64)
    for offset in offsets:
        word = words[places + offset]
        one, two = mixed(one, word, FACTORS[0]), mixed(two, word, FACTORS[1])
    return one, two


def sampled(pack: Pack, width: int) -> np.ndarray:
    """Places of the cover in each text, counted from its start, that have ``width`` bytes left."""
    lengths = pack.ends - pack.starts
    longest = int(lengths.max(initial=0))
    base = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)[None, :]).reshape(-1)
    counts = np.searchsorted(base, np.maximum(0, lengths - width + 1))
    return np.concatenate([base[:n] + s for n, s in zip(counts, pack.starts, strict=True)] or [base[:0]])


def _bits(got: list[dict], groups: list[tuple]) -> Iterator[np.ndarray]:
    """The answers to each group of keys, as booleans."""
    by = {g["bucket"]: g["bits"] for g in got if g["kind"] == KEYS}
    for bucket, _, keys, _, _ in groups:
        yield np.unpackbits(np.frombuffer(by[bucket], np.uint8), count=len(keys)).astype(bool)


def _later(groups: list[tuple], got: list[dict], size: int) -> np.ndarray:
    """Which places have a key that an earlier pack, or an earlier place of this one, has too."""
    out = np.zeros(size, bool)
    for (_, at, _, first, number), bits in zip(groups, _bits(got, groups), strict=True):
        out[at] = bits[number] | (first[number] < np.arange(len(at)))
    return out


def _covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Mask of the places in any of the half-open ranges."""
    steps = np.zeros(size + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def _mask_row(pack: Pack, mask: np.ndarray, buckets: int) -> tuple:
    """A mask over the pack's bytes, as a row that the exchange hands back."""
    return pack.number % buckets, pack.number, STATE, zstandard.compress(np.packbits(mask).tobytes(), 1)


def _mask(pack: Pack, got: list[dict]) -> np.ndarray:
    blob = next(g["bits"] for g in got if g["kind"] == STATE)
    return np.unpackbits(np.frombuffer(zstandard.decompress(blob), np.uint8), count=len(pack.body)).astype(bool)


def _key_rows(pack: Pack, groups: list[tuple]) -> Iterator[tuple]:
    for bucket, _, keys, _, _ in groups:
        yield bucket, pack.number, KEYS, squeeze_sorted(keys)


def tuple_groups(pack: Pack, length: int, buckets: int) -> tuple[np.ndarray, list[tuple]]:
    places = sampled(pack, length - PERIOD + 1)
    return places, list(dealt(*digests(pack.body, places, length - PERIOD + 1), buckets))


def near_repeats(pack: Pack, got: list[dict], length: int, buckets: int) -> np.ndarray:
    """Mask of the places whose ``length`` bytes hold a sampled tuple that occurs elsewhere too."""
    places, groups = tuple_groups(pack, length, buckets)
    again = np.zeros(len(places), bool)
    for (_, at, keys, _, number), bits in zip(groups, _bits(got, groups), strict=True):
        again[at] = (bits | (np.bincount(number, minlength=len(keys)) > 1))[number]
    hits = places[again]
    text = np.searchsorted(pack.ends, hits, "right")
    near = _covered(np.maximum(hits - (PERIOD - 1), pack.starts[text]), hits + 1, len(pack.body))
    for start, end in zip(pack.starts, pack.ends, strict=True):
        near[max(start, end - length + 1):end] = False
    return near


def stretch_groups(pack: Pack, near: np.ndarray, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """Stretches between neighbouring anchors (places picked by their own bytes): from, to, keys.

    The key of a stretch stands for all bytes from its first anchor to ``length`` bytes after its
    second: both strings there and their distance, which is less than ``length``.
    """
    places = np.nonzero(near)[0]
    words = np.ndarray((max(0, len(pack.body) - 7),), "<u8", pack.body, strides=(1,))
    own = mixed(np.full(len(places), FACTORS[1], np.uint64), words[places], FACTORS[0])
    anchors = places[own >> np.uint64(64 - ANCHOR_BITS) == 0]
    text = np.searchsorted(pack.ends, anchors, "right")
    step = anchors[1:] - anchors[:-1]
    good = (step < length) & (text[1:] == text[:-1])
    keys = [mixed(mixed(mixed(k[:-1][good], np.uint64(0), f), k[1:][good], f), step[good].astype(np.uint64), f)
            for k, f in zip(digests(pack.body, anchors, length), FACTORS, strict=True)]
    return anchors[:-1][good], anchors[1:][good], list(dealt(*keys, buckets))


def settled_stretches(pack: Pack, got: list[dict], near: np.ndarray, length: int, buckets: int) -> np.ndarray:
    """Mask of the places in stretches that occur earlier as a whole."""
    first, last, groups = stretch_groups(pack, near, length, buckets)
    later = _later(groups, got, len(first))
    return _covered(first[later], last[later] + 1, len(pack.body))


def _answer(earlier: bool):
    """For every pack's keys, whether another (or an earlier) pack has the key."""

    def run(rows: list[dict]) -> Iterator[tuple]:
        if rows[0]["kind"] == STATE:
            yield from ((r["pack"], r["bucket"], STATE, r["keys"]) for r in rows)
            return
        keys = [unsqueeze_sorted(r["keys"]) for r in rows]
        sizes = [len(k) for k in keys]
        _, first, number, count = np.unique(
            np.concatenate(keys), return_index=True, return_inverse=True, return_counts=True)
        bit = first[number] < np.arange(len(number)) if earlier else count[number] > 1
        for row, piece in zip(rows, np.split(bit, np.cumsum(sizes)[:-1]), strict=True):
            yield row["pack"], row["bucket"], KEYS, np.packbits(piece).tobytes()

    return run


def repeated_bytes(docs: DataFrame, length: int = 100) -> DataFrame:
    """Each text without the bytes covered by a ``length``-byte string that also starts earlier.

    Earlier means in a smaller id or further ahead in the same text; rows without an id come first,
    rows that repeat an id in order of their text. Null counts as empty, texts shorter than
    ``length`` keep all. One row per row of ``docs``: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256``.

    1. The difference cover of period 73 samples one suffix in eight. Any two equal strings of
       ``length`` bytes have, at one and the same distance from their starts, sampled places in
       both, and the tuple of ``length - 72`` bytes there is equal. Tuples are sorted and named; a
       unique name settles its suffix, and only suffixes near repeated names remain.
    2. Longer names: between anchors that the bytes themselves pick, whole stretches of remaining
       suffixes are named. A stretch that occurs earlier settles all suffixes in it, since each
       occurs earlier with it; what is left are first occurrences and the ends of repeats.
    3. These last suffixes are sorted by their first ``length`` bytes, equal neighbours are compared,
       and all but the earliest are marked.

    Sorting is by two independent 64-bit digests of the bytes, one for the bucket, one within it.
    """
    if length < PERIOD + 8:
        raise ValueError(f"strings of {PERIOD + 8} or more bytes can be found")
    packs = pack_texts(docs, F.lit(0), "suffix-packs")
    buckets = bucket_count(packs)

    def tuples(pack: Pack) -> Iterator[tuple]:
        yield from _key_rows(pack, tuple_groups(pack, length, buckets)[1])

    def stretches(pack: Pack, got: list[dict]) -> Iterator[tuple]:
        near = near_repeats(pack, got, length, buckets)
        yield _mask_row(pack, near, buckets)
        yield from _key_rows(pack, stretch_groups(pack, near, length, buckets)[2])

    def suffixes(pack: Pack, got: list[dict]) -> Iterator[tuple]:
        near = _mask(pack, got)
        settled = settled_stretches(pack, got, near, length, buckets)
        left = np.nonzero(near & ~settled)[0]
        yield _mask_row(pack, np.concatenate([settled, near & ~settled]), buckets)
        yield from _key_rows(pack, list(dealt(*digests(pack.body, left, length), buckets)))

    def removed(pack: Pack, got: list[dict]) -> np.ndarray:
        blob = next(g["bits"] for g in got if g["kind"] == STATE)
        both = np.unpackbits(np.frombuffer(zstandard.decompress(blob), np.uint8), count=2 * len(pack.body)).astype(bool)
        settled, left = both[:len(pack.body)], np.nonzero(both[len(pack.body):])[0]
        later = _later(list(dealt(*digests(pack.body, left, length), buckets)), got, len(left))
        starts = np.concatenate([np.nonzero(settled)[0], left[later]])
        return _covered(starts, starts + length, len(pack.body))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, i in unpacked(batch):
                gone = removed(pack, batch.column("got_answers")[i].as_py())
                out = []
                body = np.frombuffer(pack.body, np.uint8)
                for doc, start, end in zip(pack.ids, pack.starts, pack.ends, strict=True):
                    mask = gone[start:end]
                    n_spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                    kept = body[start:end][~mask].tobytes() if n_spans else pack.body[start:end]
                    out.append((doc, int(end - start), int(mask.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns[:4]), pa.array(columns[4], pa.string())],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    answers = exchanged(packs, tuples, _answer(False), EMITTED, ANSWERED, "suffix-names")
    for emit, tag in ((stretches, "suffix-stretches"), (suffixes, "suffix-order")):
        answers = exchanged(with_answers(packs, answers, "answers"), emit, _answer(True), EMITTED, ANSWERED, tag)
    return with_answers(packs, answers, "answers").mapInArrow(cut, RESULT)
