"""Language identification with string kernels, Nyström landmarks and kernel ridge regression."""

from __future__ import annotations

from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowharbor.llm.common import materialise, row_digest, spare

# Symbols of the spectrum: 0 for all that is no letter, 1-26 for a-z, the rest by code point.
SYMBOLS = 64
SIZES = (SYMBOLS, SYMBOLS**2, SYMBOLS**3)  # of the tables of 1-, 2- and 3-grams
SPACE = sum(SIZES)
UNKNOWN = "und"


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        if chr(point).isalpha():
            low = chr(point).lower()
            low = ord(low) if len(low) == 1 else point
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


_table: list[np.ndarray] = []


def symbols(text: str) -> np.ndarray:
    """The symbol of each code point of a text."""
    if not _table:
        _table.append(_symbol_table())  # once per Python worker
    return _table[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def presence(marks: np.ndarray) -> np.ndarray:
    """Which of all 1-, 2- and 3-grams occur in a text, blanks run together."""
    there = np.zeros(SPACE, bool)
    keep = np.ones(len(marks), bool)
    keep[1:] = (marks[1:] != 0) | (marks[:-1] != 0)
    s = marks[keep].astype(np.int32)
    there[s] = True
    pairs = s[:-1] * SYMBOLS + s[1:]
    there[SIZES[0] + pairs] = True
    there[SIZES[0] + SIZES[1] + pairs[:-1] * SYMBOLS + s[2:]] = True
    return there


@dataclass(frozen=True)
class Model:
    """Landmark spectra over the n-grams they hold, and weights from kernel values to classes."""

    labels: list[str]
    grams: np.ndarray  # the n-grams of the landmarks
    spectra: np.ndarray  # (n-grams, landmarks), unit columns
    weights: np.ndarray  # (landmarks + 1, classes)


def fit(sample: list[tuple[str, bytes]], landmarks_per_label: int, ridge: float) -> Model:
    """One-versus-rest kernel ridge regression in the space that the landmarks span."""
    labels = sorted({label for label, _ in sample})
    if not labels:
        return Model([], np.zeros(0, np.int64), np.zeros((0, 0), np.float32), np.zeros((1, 0), np.float32))
    rows = np.stack([np.unpackbits(np.frombuffer(bits, np.uint8), count=SPACE) for _, bits in sample])
    at = np.array([labels.index(label) for label, _ in sample])
    marks = np.concatenate([np.nonzero(at == k)[0][:landmarks_per_label] for k in range(len(labels))])
    grams = np.nonzero(rows[marks].any(axis=0))[0]
    lengths = np.sqrt(np.maximum(1, rows.sum(axis=1, dtype=np.int64)))
    unit = rows[:, grams].astype(np.float32) / lengths[:, None].astype(np.float32)
    spectra = unit[marks].T
    kernel = (unit @ spectra).astype(np.float64)  # samples by landmarks
    values, vectors = np.linalg.eigh(kernel[marks])
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])  # W^(-1/2), the Nyström map
    mapped = np.column_stack([kernel @ whiten, np.ones(len(rows))])
    goal = np.where(at[:, None] == np.arange(len(labels)), 1.0, -1.0)
    balance = 1.0 / np.bincount(at, minlength=len(labels))[at][:, None]  # each label weighs the same
    solved = np.linalg.solve(mapped.T @ (mapped * balance) + ridge * np.eye(mapped.shape[1]), mapped.T @ (goal * balance))
    weights = np.vstack([whiten @ solved[:-1], solved[-1:]])
    return Model(labels, grams, np.ascontiguousarray(spectra), weights.astype(np.float32))


def score(texts: list[str | None], model: Model, batch: int = 128) -> tuple[list[str], list[float]]:
    """The label and a share of belief (softmax of the margins) for each text."""
    out, belief = [UNKNOWN] * len(texts), [0.0] * len(texts)
    for start in range(0, len(texts), batch):
        spectra, places = [], []
        for place in range(start, min(start + batch, len(texts))):
            marks = symbols(texts[place] or "")
            if marks.any() and model.labels:
                there = presence(marks)
                spectra.append(there[model.grams].astype(np.float32) / np.float32(np.sqrt(np.count_nonzero(there))))
                places.append(place)
        if not places:
            continue
        kernel = np.stack(spectra) @ model.spectra
        margins = kernel @ model.weights[:-1] + model.weights[-1]
        if len(model.labels) > 1:
            best = margins.argmax(axis=1)
            odds = np.exp(4.0 * (margins - margins.max(axis=1, keepdims=True)))
            share = odds.max(axis=1) / odds.sum(axis=1)
        else:
            best, share = np.zeros(len(places), int), np.ones(len(places))
        for place, label, value in zip(places, best, share, strict=True):
            out[place], belief[place] = model.labels[label], float(min(1.0, max(0.0, value)))
    return out, belief


def train(labelled: DataFrame, rows_per_label: int = 150, landmarks_per_label: int = 24, ridge: float = 1e-3) -> Model:
    """Fit on at most ``rows_per_label`` texts of each label of ``labelled(doc_id, text, lang)``.

    The rows with the least MD5 of their id are taken, whole; those of one id, or without one, by a
    digest of the text, and repeated rows count once. Tasks turn them into presence bits
    of a fixed size (33 KB), and only those come to the driver. Longer texts hold more n-grams,
    so a document counts once, whatever its length; texts without a letter are left out.
    """
    order = Window.partitionBy("lang").orderBy("_place", "doc_id", "_row")
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", "doc_id", row_digest().alias("_row"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_place"))
    chosen = materialise(  # digests only; a task sends at most rows_per_label of each label on, and their copies
        usable.select("lang", "doc_id", "_row", "_place").withColumn("_n", F.dense_rank().over(order))
        .filter(F.col("_n") <= rows_per_label).select("lang", "_row", "_n").distinct(),
        "langid-sample",
    )
    sample = usable.select("_row", "lang", "text").join(chosen, ["_row", "lang"]).dropDuplicates(["_row", "lang"])

    def spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bits = [np.packbits(presence(symbols(t.as_py()))).tobytes() for t in rows.column("text")]
            yield pa.RecordBatch.from_arrays(
                [rows.column("lang"), rows.column("_n").cast(pa.int64()), pa.array(bits, pa.binary())], names=["lang", "n", "bits"])

    rows = sample.mapInArrow(spectra, "lang string, n bigint, bits binary").collect()
    ordered = sorted(rows, key=lambda r: (r["lang"], r["n"]))
    return fit([(r["lang"], bytes(r["bits"])) for r in ordered], landmarks_per_label, ridge)


def predict(docs: DataFrame, model: Model, label: str = "lang_pred", belief: str = "lang_score") -> DataFrame:
    """All rows and columns of ``docs`` with the predicted language and its score.

    ``und`` with score 0 if the text is null, has no letter, or nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by fit's parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, values = score(batch.column("text").to_pylist(), shared.value)
            names = [*batch.schema.names, label, belief]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(labels, pa.string()), pa.array(values, pa.float64())], names=names)

    schema = StructType([*docs.schema.fields]).add(label, "string").add(belief, "double")
    return docs.mapInArrow(run, schema)


def held_out(docs_id: str = "doc_id", folds: int = 5, fold: int = 0):
    """Whether a row belongs to the fold kept from learning; a row without an id doesn't."""
    remainder = F.pmod(F.crc32(F.col(docs_id).cast("string").cast("binary")), F.lit(folds))
    return F.coalesce(remainder == fold, F.lit(False))


def identify(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per row; learns from the rows not held out."""
    model = train(docs.filter(~held_out()), **options)
    slim = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(slim, model, belief="score").drop("text")


def keep_identified(docs: DataFrame, wanted: Collection[str] | None = None, least: float = 0.0, **options) -> DataFrame:
    """The rows of ``docs`` whose predicted language is wanted, with a score of ``least`` or more.

    By default every language of the labelled rows is wanted, so those go that have none: no text, or no
    letter in it. Where ``lang`` is null, the predicted one takes its place. If no row is labelled,
    nothing can be predicted, and the rows with a letter stay as they are.
    """
    model = train(docs.filter(~held_out()), **options)
    if not model.labels:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    label, belief = spare(docs, "_lang"), spare(docs, "_belief")
    fits = F.col(label).isin(*(model.labels if wanted is None else wanted)) & (F.col(belief) >= least)
    return predict(docs, model, label, belief).filter(fits).withColumn("lang", F.coalesce("lang", label)).drop(label, belief)
