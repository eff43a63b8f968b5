"""Quality by importance resampling: which texts a model of good text would rather have written.

Texts become sets of hashed n-grams: words, pairs of words, the shapes of words, and
how often pairs repeat. Two generative models say how likely a text holds each: the
raw model is the share of all documents that do, the target model that of documents
labelled good. The log ratio of the two, added up over a text, is its importance
weight. An n-gram whose count among the good documents is as near to what the raw model
expects as chance brings counts as equally likely in both: the largest of m deviations
by chance is about sqrt(2 ln m) standard deviations, m being the n-grams of its kind
that occur. Otherwise small errors would add up in long texts and hide what is bad in them.

With few labels that test finds next to nothing, so the others are tested again among
labelled documents alone, where a word that only bad ones hold stands out after a few: its log
likelihood ratio against the share of good ones must exceed 2 ln m, and the weaker it is
the more the log ratio is shrunk, as copies of one text are no independent evidence.

Labels are dealt into ``FOLDS`` folds in the order of a hash. A labelled document is weighed by a model
without its own fold, so the cut below comes from documents that their model has not seen.

The sample is drawn by Gumbel top-k: the k highest of ``SHARPNESS`` times the log weight plus Gumbel
noise, which a hash of the id gives. k is a parameter, or as many as it takes to hold all but ``MISSED`` of the good
documents: how many of a range of weights are good is the share of the labelled ones in it, times all in it, and
ranges are taken from the highest on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .text import keep_rows, whole

WORD_BITS = 18
SHAPE_BITS = 12
REPEATS = 1 << 9
# How many n-grams there are of each kind: words, pairs, shapes, repeats.
KINDS = (1 << WORD_BITS, 1 << WORD_BITS, 1 << SHAPE_BITS, REPEATS)
N_FEATURES = sum(KINDS)
# At most so many good documents, and so many others, fit the model: the first in the order of a hash.
LABELLED = 100_000
FOLDS = 5
PRIOR = 0.5
SHARPNESS = 5.0
MISSED = 0.01
# Labelled documents in a range of weights, and the most ranges.
RANGE_LABELS, RANGES = 25, 64
MEMO_WORDS = 300_000
# Rows of counts that a task gives out at a time.
COUNT_ROWS = 1 << 16
_MARKS = b".,;:!?()[]\"'"
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256))
_RUN = re.compile(rb"(.)\1+", re.DOTALL)


class Words(dict):
    """Word -> hash of its core and, above, of its shape; emptied when it holds ``MEMO_WORDS``."""

    def __missing__(self, word: bytes) -> int:
        core = zlib.crc32(word.lower().strip(_MARKS)) & ((1 << WORD_BITS) - 1)
        shape = zlib.crc32(_RUN.sub(rb"\1+", word.translate(_SHAPE))) & ((1 << SHAPE_BITS) - 1)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = code = core | shape << WORD_BITS
        return code


def features(text: bytes, words: Words) -> np.ndarray:
    """The distinct n-grams of a text, as numbers below ``N_FEATURES``."""
    found = text.split()
    codes = np.fromiter(map(words.__getitem__, found), np.int64, len(found))
    core, shape = codes & ((1 << WORD_BITS) - 1), codes >> WORD_BITS
    pairs, times = np.unique((core[:-1] * 1_000_003 + core[1:]) & ((1 << WORD_BITS) - 1), return_counts=True)
    often = times[times > 1]
    share = np.clip(np.log2(max(len(core) - 1, 1) / often).astype(np.int64), 0, 15)
    repeats = np.minimum(np.log2(often).astype(np.int64), 31) * 16 + share
    return np.concatenate((
        np.unique(core), pairs + (1 << WORD_BITS), np.unique(shape) + (2 << WORD_BITS),
        np.unique(repeats) + (2 << WORD_BITS) + (1 << SHAPE_BITS)))


def text_key(text: Column) -> Column:
    """A hash that tells texts of one id apart."""
    return F.xxhash64(whole(text))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
        whole(F.col("text")).cast("binary").alias("text"))


class Labels:
    """Ids of labelled documents, which are good, and the fold of each; ids come in the order of a hash, the good first."""

    def __init__(self, good: np.ndarray, other: np.ndarray):
        order = np.argsort(ids := np.concatenate((good, other)).astype(np.int64))
        fold = np.concatenate((np.arange(len(good)), np.arange(len(other)))) % FOLDS
        self.ids, self.good, self.fold = ids[order], (np.arange(len(ids)) < len(good))[order], fold[order]

    def find(self, ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The fold of each document, -1 without a label, and whether it is good."""
        if not len(self.ids):
            return np.full(len(ids), -1), np.zeros(len(ids), bool)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        known &= self.ids[at] == ids
        return np.where(known, self.fold[at], -1), known & self.good[at]


def count_features(docs: DataFrame, labels: Labels) -> np.ndarray:
    """Documents that hold each n-gram, and at the end all: a row for all documents, for the
    labelled of each fold and for the good of each fold."""
    send_with_tasks(__name__)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = Words(), np.zeros((1 + 2 * FOLDS, N_FEATURES + 1), np.int32)
        for batch in batches:
            for fold, good, text in zip(*labels.find(batch.column("doc_id")), batch.column("text")):
                held = np.append(features(text.as_buffer().to_pybytes(), words), N_FEATURES)
                counts[0, held] += 1
                if fold >= 0:
                    counts[1 + fold, held] += 1
                if good:
                    counts[1 + FOLDS + fold, held] += 1
        every = np.flatnonzero(counts[0])
        for at in range(0, len(every), COUNT_ROWS):
            held = every[at:at + COUNT_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(held), *(pa.array(row[held], pa.int64()) for row in counts)], names=["feature", *names])

    names = [f"n{row}" for row in range(1 + 2 * FOLDS)]
    # Counts of labelled documents are at most twice LABELLED.
    summed = _rows(docs).mapInArrow(count, ", ".join(f"{name} bigint" for name in ["feature", *names])).groupBy("feature").agg(
        F.sum(names[0]).alias(names[0]), *[F.sum(name).cast("int").alias(name) for name in names[1:]])
    summed = summed.withColumn("feature", F.col("feature").cast("int")).toArrow()
    counts = np.zeros((len(names), N_FEATURES + 1), np.int64)
    places = summed.column("feature").to_numpy()
    for row, name in zip(counts, names):
        row[places] = summed.column(name).to_numpy()
        summed = summed.drop_columns([name])
    return counts


def log_ratios(raw: np.ndarray, good: np.ndarray, n_raw: int, n_good: int) -> np.ndarray:
    """Log ratio of target to raw probability of each n-gram."""
    expected = raw * (n_good / max(n_raw, 1))
    ratio = np.log((good + PRIOR) / (expected + PRIOR))
    ratio[np.abs(good - expected) < np.sqrt(_chance(raw)) * np.sqrt(expected + 1)] = 0
    return ratio


def _chance(counts: np.ndarray) -> np.ndarray:
    """2 ln m for each n-gram, m being the n-grams of its kind that occur."""
    seen = [max(int(np.count_nonzero(kind)), 2) for kind in np.split(counts, np.cumsum(KINDS)[:-1])]
    return np.repeat(2 * np.log(seen), KINDS)


def shrunk_ratios(raw: np.ndarray, labelled: np.ndarray, good: np.ndarray, n_raw: int, n_labelled: int, n_good: int) -> np.ndarray:
    """Log ratio of each n-gram, shrunk by how far the good are from their share among the labelled that hold it."""
    share, bad = n_good / max(n_labelled, 1), labelled - good
    surprise = 2 * (_surprise(good, labelled * share) + _surprise(bad, labelled * (1 - share)))
    chance = _chance(labelled)
    ratio = np.log((good + PRIOR) / (raw * (n_good / max(n_raw, 1)) + PRIOR)) * (surprise / (surprise + chance)) ** 2
    ratio[surprise < chance] = 0
    return ratio


def _surprise(found: np.ndarray, expected: np.ndarray) -> np.ndarray:
    return found * np.log(np.where(found > 0, found, 1) / np.where(found > 0, expected, 1))


def fold_ratios(counts: np.ndarray) -> np.ndarray:
    """Log ratios by the labels of all folds but one, a row for each; and last, by all labels."""
    raw, labelled, good = counts[0], counts[1:1 + FOLDS], counts[1 + FOLDS:]
    ratios = np.zeros((FOLDS + 1, N_FEATURES))
    for left_out in range(FOLDS + 1):
        rest = [fold for fold in range(FOLDS) if fold != left_out]
        some, fine = labelled[rest].sum(0), good[rest].sum(0)
        sure = log_ratios(raw[:-1], fine[:-1], int(raw[-1]), int(fine[-1]))
        shrunk = shrunk_ratios(raw[:-1], some[:-1], fine[:-1], int(raw[-1]), int(some[-1]), int(fine[-1]))
        # Without good documents there is no target model.
        if fine[-1]:
            ratios[left_out] = np.where(sure != 0, sure, shrunk)
    return ratios


def log_weights(docs: DataFrame, ratios: np.ndarray, labels: Labels) -> DataFrame:
    """doc_id, text_key and log_weight of every document, of labelled ones by the model without their fold."""
    send_with_tasks(__name__)
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ratios = Words(), shared.value
        for batch in batches:
            folds, _ = labels.find(batch.column("doc_id"))
            sums = [float(ratios[fold, features(text.as_buffer().to_pybytes(), words)].sum())
                    for fold, text in zip(folds, batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sums, pa.float64())], names=["doc_id", "text_key", "log_weight"])

    return _rows(docs).mapInArrow(weigh, "doc_id bigint, text_key bigint, log_weight double")


def sample_size(scored: DataFrame, good: DataFrame, other: DataFrame, missed: float = MISSED) -> int:
    """How many documents of the highest weights hold all but a share of the good ones, from the labelled (doc_id).

    Ranges hold about ``RANGE_LABELS`` labelled documents each. Nothing but their counts goes to the driver.
    """
    marks = good.select(F.col("doc_id").alias("_marked"), F.lit(1).alias("good")).unionByName(
        other.select(F.col("doc_id").alias("_marked"), F.lit(0).alias("good")))
    marked = scored.join(marks, F.col("doc_id") == F.col("_marked"), "left").select("log_weight", "good")
    labelled = marked.where("good is not null")
    ranges = min(labelled.count() // RANGE_LABELS, RANGES)
    edges = labelled.agg(F.percentile_approx("log_weight", [at / ranges for at in range(1, ranges)], 10_000)).first()[0] if ranges > 1 else []
    place = F.size(F.filter(F.array(*[F.lit(float(edge)) for edge in edges]), lambda edge: edge <= F.col("log_weight"))) if edges else F.lit(0)
    found = marked.groupBy(place.alias("range")).agg(
        F.count(F.lit(1)).alias("n"), F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).collect()
    share = sum(row["good"] for row in found) / max(sum(row["labelled"] for row in found), 1)
    held = [(row["n"], row["n"] * (row["good"] / row["labelled"] if row["labelled"] else share))
            for row in sorted(found, key=lambda row: -row["range"])]
    size, left = 0.0, (1 - missed) * sum(target for _, target in held)
    for n, target in held:
        if target >= left:
            return round(size + n * (left / target if target else 0))
        size, left = size + n, left - target
    return round(size)


def gumbel(key: Column, seed: int) -> Column:
    """Standard Gumbel noise that ``key`` and ``seed`` determine."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(uniform))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, found by counting rows in 4096 bins and then in the bin that holds it."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        width = (high - low) / 4096
        bin_ = F.least(F.floor((F.col(column) - low) / width), F.lit(4095)).cast("long")
        found = rows.where(F.col(column).between(low, high)).groupBy(bin_.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect()
        for row in sorted(found, key=lambda row: -row["bin"]):
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low


def select_documents(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 0, labelled: int = LABELLED) -> DataFrame:
    """doc_id, log_weight, perturbed (with noise) and kept of every document.

    ``labels`` holds doc_id, quality and toxic; a document is good if it has quality 1
    and is not toxic. All documents make the raw model, up to ``labelled`` good ones the
    target model, and up to as many others help to tell chance from evidence. ``k`` rows are kept, and those tied with the k-th; without ``k`` it is
    reckoned from the labels as above.

    A null text is an empty one, with weight 0. Null ids have no label. Rows that repeat an id and its text are judged
    alike; several texts under one id, or under null ids, each by its own weight. Without good documents, or if no text tells them from the
    others, every weight is 0 and without ``k`` all documents stay. No documents give no
    rows. Other columns are not read.
    """
    return _judged(docs, labels, k, seed, labelled).drop("text_key")


def _judged(docs: DataFrame, labels: DataFrame, k: int | None, seed: int, labelled: int) -> DataFrame:
    """As :func:`select_documents`, with text_key."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    other = labels.where("(quality <> 1 or toxic <> 0) and doc_id is not null").select("doc_id").distinct().join(
        good, "doc_id", "left_anti")
    chosen = Labels(*(
        ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled).toArrow().column("doc_id").to_numpy() for ids in (good, other)))
    ratios = fold_ratios(count_features(docs, chosen))
    scored = log_weights(docs, ratios, chosen).withColumn(
        "perturbed", F.lit(SHARPNESS) * F.col("log_weight") + gumbel(F.col("doc_id"), seed))
    scored = materialize(scored, "quality-weights")
    if k is None:
        n = scored.count()
        k = sample_size(scored, good, other) if ratios.any() else n
    least = kth_largest(scored, "perturbed", k) if k > 0 else None
    kept = F.col("perturbed") >= least if least is not None else F.lit(False)
    return scored.select("*", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, k: int | None = None, seed: int = 0, labelled: int = LABELLED) -> DataFrame:
    """The documents that stay, with all their columns: those that ``kept`` names by id and text."""
    judged = _judged(docs, labels, k, seed, labelled).where("kept")
    return keep_rows(docs, judged.select("doc_id", "text_key"), "doc_id", text_key(F.col("text")))
