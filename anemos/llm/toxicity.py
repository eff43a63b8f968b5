"""Toxicity by a weighted finite-state grammar that reads clauses.

Words become tags: insult, threat, target, negation, reported speech, other. Five
transducers rewrite the tags of a clause one after the other: negation marks what it
covers, reported speech what is only quoted, target and threat what is aimed at
somebody, and insult says what each match counts as. They are composed into one, and the cheapest
path through it is the reading of the clause. So a word counts by its clause: bare, aimed, as
a threat, negated or reported.

Which words insult is learnt. Of a bounded sample of labelled documents, of which copies
and near copies count once, words and stems are told apart from chance by their
log likelihood ratio. They are then taken one by one, each time the strongest, and toxic documents it explains
count half from then on; so the words of one text that was copied much do not follow. A word
weighs its log odds. Last, a logistic regression on the same sample learns what each reading is worth and turns sums into a score.
Texts alone make a score; ids only choose what is learnt from.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .text import let, whole, words

#: At most so many toxic and as many other labelled documents are learnt from: the first in the order of a hash.
LABELLED = 20_000
HELD_OUT = 5
STEMS = range(4, 9)
CANDIDATES = 4096
HELD_FEATURES = 150_000
MEMO_WORDS = 250_000
SCOPE, REACH = 4, 3
RIDGE = 1.0
THREAT_WEIGHT = 2.0
_MARKS = ".,;:!?()[]{}\"'`*#$%&|<>~-_=+/\\¡¿«»„“”‘’…"
_BREAKS = (".", ",", ";", ":", "!", "?")

# Words of the grammar in English, German, French and Spanish.
TARGETS = frozenset("you your u yourself he she they them him her people everyone du dich dir ihr euch sie ihn leute tu te toi "
                    "vous ils elles eux gens tú ti usted ustedes ellos ellas vosotros gente".split())
NEGATIONS = frozenset("not no never isn't aren't wasn't don't doesn't without nobody nicht kein keine keinen nie niemals ohne "
                      "ne pas jamais sans aucun nunca jamás sin ningún".split())
REPORTS = frozenset("said says saying wrote writes called calls quoted quotes reported reports claimed claims according sagte sagt "
                    "schrieb nannte berichtete laut dit disait écrit selon dijo dice escribió llamó según".split())
THREATS = frozenset("kill hurt destroy beat attack die shoot burn stab töten umbringen schlagen vernichten sterben tuer frapper "
                    "détruire mourir brûler matar golpear destruir morir quemar".split())

TAGS = "oIHYNR"
KINDS = ("bare", "aimed", "threat", "negated", "reported")


class Transducer(NamedTuple):
    """Arcs by (state, symbol): (symbol given out, cost, next state); where a path may end."""

    start: object
    arcs: dict
    final: frozenset


def build(start, step, symbols: Iterable[str], ends=lambda state: True) -> Transducer:
    """The transducer of all states that ``step`` (state, symbol → arcs) reaches from the start."""
    arcs, states, left = {}, {start}, [start]
    while left:
        state = left.pop()
        for symbol in symbols:
            found = arcs[state, symbol] = tuple(step(state, symbol))
            for _, _, after in found:
                if after not in states:
                    states.add(after)
                    left.append(after)
    return Transducer(start, arcs, frozenset(filter(ends, states)))


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What the second makes of the output of the first, as one transducer."""
    def step(state, symbol):
        one, two = state
        for middle, cost, after_one in first.arcs.get((one, symbol), ()):
            for out, more, after_two in second.arcs.get((two, middle), ()):
                yield out, cost + more, (after_one, after_two)

    symbols = sorted({symbol for _, symbol in first.arcs})
    return build((first.start, second.start), step, symbols, lambda state: state[0] in first.final and state[1] in second.final)


def negation() -> Transducer:
    """Insults and threats up to ``SCOPE`` words behind a negation become i and h."""
    def step(left, symbol):
        if symbol == "N":
            return [("N", 0, SCOPE)]
        return [(symbol.lower() if left and symbol in "IH" else symbol, 0, max(left - 1, 0))]

    return build(0, step, TAGS)


def reported() -> Transducer:
    """Behind a word of speech, insults and threats become q up to the end of the clause."""
    return build(False, lambda told, symbol: [("q" if told and symbol in "IHih" else symbol, 0, told or symbol == "R")], TAGS + "ih")


def aimed(symbol_in: str, hit: str, miss: str) -> Transducer:
    """``symbol_in`` with a target at most ``REACH`` words before or behind it becomes ``hit``, otherwise ``miss``.

    A state holds for how many words a target before still counts and within how many one must
    follow, as a path has promised; a path that breaks its promise ends nowhere.
    """
    def step(state, symbol):
        seen, due = state
        if symbol == "Y":
            return [("Y", 0, (REACH, 0))]
        if due == 1:
            return []
        after = (max(seen - 1, 0), max(due - 1, 0))
        if symbol != symbol_in:
            return [(symbol, 0, after)]
        if seen:
            return [(hit, -1, after)]
        return [(miss, 0, after), (hit, -1, (0, after[1] or REACH))]

    return build((0, 0), step, TAGS + "ihqTX", lambda state: state[1] == 0)


def insult() -> Transducer:
    """What each match counts as; nothing for other words. Named by its place in ``KINDS``."""
    counts = {"I": "0", "T": "1", "X": "2", "i": "3", "h": "3", "q": "4"}
    return build(0, lambda state, symbol: [(counts.get(symbol, ""), 0, 0)], TAGS + "ihqTX")


class Grammar:
    """All transducers in one, and the readings of clauses."""

    def __init__(self):
        steps = [negation(), reported(), aimed("I", "T", "I"), aimed("H", "X", "o"), insult()]
        self.whole = functools.reduce(compose, steps)
        self.read = functools.lru_cache(1 << 16)(self._read)

    def _read(self, tags: str) -> str:
        """The kinds of a clause's matches, in order, by the cheapest path (of equal ones the first by its output)."""
        paths = {self.whole.start: (0, "")}
        for tag in tags:
            after = {}
            for state, (cost, out) in paths.items():
                for symbol, more, to in self.whole.arcs[state, tag]:
                    option = (cost + more, out + (symbol or "-"))
                    if to not in after or option < after[to]:
                        after[to] = option
            paths = after
        # A word that counts for nothing keeps its place, so that matches and words stay in step.
        return min(path for state, path in paths.items() if state in self.whole.final)[1]


def core(word: str) -> str:
    return word.lower().strip(_MARKS)


def word_features(found: str) -> list[str]:
    """A word and its stems."""
    return [found, *(found[:size] + "~" for size in STEMS if len(found) > size)]


def text_words(text: str) -> list[str]:
    """The words of a text; a line's end is a mark of its own."""
    return text.replace("\n", " . ").split()


class Lexicon(dict):
    """Word as written → tag, whether it ends a clause, whether it is one, and the place of its weight."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights
        self.values_ = [0.0]

    def make_room(self) -> None:
        """Forget all words if there are more than ``MEMO_WORDS``; for between two texts."""
        if len(self) > MEMO_WORDS:
            self.clear()
            self.values_ = [0.0]

    def __missing__(self, word: str) -> int:
        found = core(word)
        weight = max((self.weights[name] for name in word_features(found) if name in self.weights), default=0.0)
        if weight:
            tag = 1
        elif found in THREATS:
            tag, weight = 2, THREAT_WEIGHT
        else:
            tag = 3 if found in TARGETS else 4 if found in NEGATIONS else 5 if found in REPORTS else 0
        place = 0
        if weight:
            place = len(self.values_)
            self.values_.append(weight)
        self[word] = code = tag | (word[-1] in _BREAKS or word.rstrip(_MARKS[6:])[-1:] in _BREAKS) << 3 | bool(found) << 4 | place << 5
        return code


def readings(text: str, lexicon: Lexicon, grammar: Grammar) -> tuple[np.ndarray, int]:
    """The weight of all matches of each kind, and the number of words."""
    lexicon.make_room()
    found = text_words(text)
    codes = np.fromiter(map(lexicon.__getitem__, found), np.int64, len(found))
    sums, tags = np.zeros(len(KINDS)), codes & 7
    matched = np.flatnonzero((tags == 1) | (tags == 2))
    if len(matched):
        ends = np.flatnonzero(codes & 8)
        clause = np.searchsorted(ends, matched)
        starts = np.concatenate(([0], ends + 1))
        stops = np.append(ends + 1, len(codes))
        for at in np.unique(clause):
            part = codes[starts[at]:stops[at]]
            part = part[_telling(part & 7)]
            kinds = grammar.read("".join(map(TAGS.__getitem__, (part & 7).tolist())))
            for code, kind in zip(part.tolist(), kinds):
                if kind != "-":
                    sums[int(kind)] += lexicon.values_[code >> 5]
    return sums, int(np.count_nonzero(codes & 16))


def _telling(tags: np.ndarray) -> np.ndarray:
    """Leaves of each run of other words as many as the longest scope counts, so that all readings stay as they are."""
    other = tags == 0
    place = np.arange(len(tags))
    last = np.maximum.accumulate(np.where(other, -1, place))
    return place - last <= max(SCOPE, REACH) + 1


def document_features(sums: np.ndarray, n: int) -> np.ndarray:
    """What the regression sees: readings, their density and the length."""
    total = sums.sum()
    return np.concatenate((np.log1p(sums), [np.log1p(total), 20 * total / (n + 20), np.log1p(n), total > 0]))


class Model(NamedTuple):
    """The words that insult with their weights, and the regression (on features less ``mean``)."""

    weights: dict
    mean: np.ndarray
    scale: np.ndarray
    slope: np.ndarray
    intercept: float

    def score(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip((features - self.mean) / self.scale @ self.slope + self.intercept, -700, 700))))


def held_out(doc_id: Column) -> Column:
    """Whether the label of a document must not be learnt from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % HELD_OUT == 0


def labelled_texts(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> tuple[DataFrame, dict[int, float]]:
    """text and toxic of the documents that are learnt from, and how many labels each one of a class stands for.

    Of the labels that may be used, the first ``labelled`` of each class in the order of a hash. Of texts with the same two
    smallest word hashes, as copies and most near copies have, one per class is left.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    counts = {row["toxic"]: row["count"] for row in ids.groupBy("toxic").count().collect()}
    chosen = None
    for toxic in (0, 1):
        part = ids.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
        chosen = part if chosen is None else chosen.unionByName(part)
    # Twice ``labelled`` rows at most.
    chosen = chosen.select(F.col("doc_id").alias("_labelled"), "toxic")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_labelled"))

    def least(found: Column) -> Column:
        return F.struct(*[F.array_min(F.transform(found, lambda word: F.xxhash64(word, F.lit(seed)))).alias(f"h{seed}") for seed in (1, 2)])

    rows = rows.select("toxic", "text", let(words(F.col("text")), least).alias("likeness"))
    rows = rows.groupBy("toxic", "likeness").agg(F.min("text").alias("text"))
    return materialize(rows.select("text", "toxic"), "toxicity-sample"), {
        toxic: max(1.0, counts.get(toxic, 0) / labelled) for toxic in (0, 1)}


def feature_counts(sample: DataFrame) -> DataFrame:
    """feature, toxic and other: the sampled documents of each class that hold a word or stem."""
    send_with_tasks(__name__)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def given() -> pa.RecordBatch:
            columns = [list(counts), *([pair[side] for pair in counts.values()] for side in (1, 0))]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()))], names=["feature", "toxic", "other"])

        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                for feature in {name for word in {core(word) for word in text_words(text)} if word for name in word_features(word)}:
                    counts.setdefault(feature, [0, 0])[toxic] += 1
                if len(counts) >= HELD_FEATURES:
                    yield given()
                    counts.clear()
        yield given()

    return sample.mapInArrow(count, "feature string, toxic bigint, other bigint").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def chance(counts: DataFrame, odds: float) -> float:
    """The log likelihood ratio that chance brings among as many features, 2 ln m. Those that too few documents hold to
    reach it, were they all toxic, are not counted."""
    held = {row["n"]: row["count"] for row in counts.select(
        F.least(F.col("toxic") + F.col("other"), F.lit(1000)).alias("n")).groupBy("n").count().collect()}
    gate = 0.0
    for least in range(1, 1001):
        gate = 2 * np.log(max(sum(count for n, count in held.items() if n >= least), 2))
        if 2 * least * np.log(odds) >= gate:
            break
    return float(gate)


def surprise(toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> np.ndarray:
    """Log likelihood ratio of an uneven against an even share; 0 where a feature is not more frequent among the toxic."""
    def part(found, of):
        expected = (toxic + other) * of / (n_toxic + n_other)
        return np.where(found > 0, found * np.log(np.where(found > 0, found, 1) / np.where(expected > 0, expected, 1)), 0)

    ratio = 2 * (part(toxic, n_toxic) + part(other, n_other))
    return np.where(toxic * n_other > other * n_toxic, ratio, 0)


def chosen_words(names: list[str], holder: np.ndarray, held: np.ndarray, toxic: np.ndarray, gate: float) -> dict[str, float]:
    """Weights of the candidates that stand out. Document ``holder[i]`` holds candidate ``held[i]``; ``toxic`` tells which are."""
    n, n_toxic, n_other = len(names), int(toxic.sum()), int((~toxic).sum())
    of_toxic = toxic[holder]
    other = np.bincount(held[~of_toxic], minlength=n).astype(float)
    holder, held = holder[of_toxic], held[of_toxic]
    found = np.bincount(held, minlength=n).astype(float)
    odds = np.log((found + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    share, weights, left = toxic.astype(float), {}, np.ones(n, bool)
    # Of equals the longest.
    size = np.array([len(name) for name in names]) / 1e6
    while left.any():
        value = surprise(np.bincount(held, share[holder], n), other, share.sum(), n_other)
        value = np.where(left, value + size, 0)
        best = int(np.argmax(value))
        if value[best] < gate:
            break
        weights[names[best]] = float(max(odds[best], 0.1))
        holds = np.zeros(len(toxic), bool)
        holds[holder[held == best]] = True
        # What nearly the same documents hold says the same, as the stems of a word do.
        common = np.bincount(held, holds[holder], n)
        same = common > 0.95 * (found + found[best] - common)
        left &= ~(same & np.array([_related(names[best], name) for name in names]))
        left[best] = False
        share[holds] /= 2
    return weights


def _related(one: str, other: str) -> bool:
    one, other = one.rstrip("~"), other.rstrip("~")
    return one.startswith(other) or other.startswith(one)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Words, weights and regression from the labels that may be used. Without labels of both classes nothing
    is learnt, and every document gets the share of toxic labels, or a half without any."""
    sample, stand_for = labelled_texts(docs, labels, labelled)
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    width = len(document_features(np.zeros(len(KINDS)), 0))
    if not n_toxic or not n_other:
        share = (n_toxic + 0.5) / (n_toxic + n_other + 1)
        return Model({}, np.zeros(width), np.ones(width), np.zeros(width), float(np.log(share / (1 - share))))
    counts = materialize(feature_counts(sample), "toxicity-words")
    total = float(n_toxic + n_other)
    gate = chance(counts, total / n_toxic)

    def part(column: str, of: int) -> Column:
        found = F.col(column).cast("double")
        return F.when(found > 0, found * F.log(found / ((F.col("toxic") + F.col("other")) * F.lit(of / total)))).otherwise(0.0)

    ratio = 2 * (part("toxic", n_toxic) + part("other", n_other))
    names = counts.where(F.col("toxic") * n_other > F.col("other") * n_toxic).select("feature", ratio.alias("ratio")).where(
        F.col("ratio") >= gate).orderBy(F.desc("ratio"), "feature").limit(CANDIDATES).toArrow().column("feature").to_pylist()
    place = {name: at for at, name in enumerate(names)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [sorted({place[name] for word in {core(word) for word in text_words(text)} for name in word_features(word) if name in place})
                    for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.list_(pa.int32())), batch.column("toxic")], names=["held", "toxic"])

    found = sample.mapInArrow(look, "held array<int>, toxic int").toArrow()
    held = found.column("held").combine_chunks()
    holder = np.repeat(np.arange(found.num_rows), np.asarray(held.value_lengths()))
    toxic = found.column("toxic").to_numpy() == 1
    weights = chosen_words(names, holder, held.flatten().to_numpy(), toxic, gate) if names else {}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, grammar = Lexicon(weights), Grammar()
        for batch in batches:
            rows = [document_features(*readings(text, lexicon, grammar)).tolist() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column("toxic")], names=["x", "toxic"])

    seen = sample.mapInArrow(measure, "x array<double>, toxic int").toArrow()
    x = np.array(seen.column("x").to_pylist()).reshape(-1, width)
    y = seen.column("toxic").to_numpy().astype(float)
    order = np.lexsort((*x.T, y))
    return Model(weights, *regression(x[order], y[order], np.where(y[order] > 0, stand_for[1], stand_for[0])))


def regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Mean, scale, slope and intercept of a ridge logistic regression, by Newton steps."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    ridge = np.append(np.full(x.shape[1], RIDGE), 1e-6)
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (weight * (y - p)) - ridge * beta
        curve = (z * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        beta += step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-8:
            break
    return mean, scale, beta[:-1], float(beta[-1])


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and, for each kind of reading, the weight found, of every document. Only the text is read for them."""
    send_with_tasks(__name__)
    kinds = [f"{kind}_weight" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, grammar = Lexicon(model.weights), Grammar()
        for batch in batches:
            read = [readings(text, lexicon, grammar) for text in batch.column("text").to_pylist()]
            scores = [model.score(document_features(*row)) for row in read]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()),
                 *(pa.array([float(sums[at]) for sums, _ in read], pa.float64()) for at in range(len(KINDS)))],
                names=["doc_id", "score", *kinds])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double, " + ", ".join(f"{name} double" for name in kinds))


def toxic_documents(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from a half on) and the weight of each kind of reading of every document.

    Labels of held-out documents, whose crc32 of the id is divisible by five, are not learnt from. An id with several labels is
    toxic if one says so; labels without id or verdict are left out, and texts of a repeated id share its label.
    A null text is an empty one and is scored like any text without a match. Null and repeated ids are scored one by
    one. No documents give no rows; without labels of both classes all scores are alike. Other columns are not read.
    """
    scored = score_documents(docs, fit(docs, labels, labelled))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *[f"{kind}_weight" for kind in KINDS])
