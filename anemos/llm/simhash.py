"""Near duplicates by SimHash fingerprints, linked by the generalised pigeonhole principle.

If the bits are cut into parts with a radius r_i each and the r_i + 1 add up to
``distance`` + 1, two fingerprints within ``distance`` are within r_i of each other in
some part i. So each fingerprint is looked up, per part, by its bits and all that
differ from them in r_i places or fewer, and what is found is verified.

Bits that go together share a part. The radii (-1: the part is not used) come from
dynamic programming over the parts: the estimated number of candidates of each part and
radius, and the look-ups. Candidates are estimated from all fingerprints, as the pairs that agree in a
part, which are counted, times the growth that the bits' own frequencies predict for
a larger radius. Any choice finds every link; it only costs more or less.

Equal fingerprints are one row before any of this, so copies cost nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .components import components
from .salts import per_salt, salt, salts_present
from .text import keep_rows, whole

SHINGLE = 3
SEED = 42
BITS = 64
CHUNK = 1 << 14
DISTANCE = 3
PARTS = (2, 3, 4, 5)
# Cost of a row looked up, against one candidate verified.
LOOKUP_COST = 20.0
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of a text in UTF-8: A-Z lower-cased, shingles of words with repeats.

    A text of fewer words has its whole sequence of words as its one shingle, one of no
    words the fingerprint 0.
    """
    found = text.translate(_LOWER).split()
    if not found:
        return 0
    line = memoryview(b" ".join(found))
    ends = np.cumsum([len(word) + 1 for word in found])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    ends = (ends - 1).tolist()
    n = max(1, len(found) - shingle + 1)
    last = min(shingle, len(found)) - 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[at:to], ends[at + last:to + last])], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def text_key(text: Column) -> Column:
    """A hash that tells texts of one id apart."""
    return F.xxhash64(whole(text))


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key and fp (the 64 bits as a signed number) of every document."""
    send_with_tasks(__name__)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(text.as_buffer().to_pybytes(), shingle) for text in batch.column("text")), "<u8", batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view("<i8"))], names=["doc_id", "text_key", "fp"])

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
        whole(F.col("text")).cast("binary").alias("text"))
    return rows.mapInArrow(hashed, "doc_id bigint, text_key bigint, fp bigint")


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints there are, and how many have bits i and j: 64 x 64 sums of all rows."""
    send_with_tasks(__name__)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            codes = batch.column("fp").to_numpy().view("<u8").reshape(-1, 1).view(np.uint8)
            bits = np.unpackbits(codes, axis=1, bitorder="little").astype(np.float64)
            together += (bits.T @ bits).astype(np.int64)
            n += len(bits)
        cells = np.append(together.ravel(), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    rows = fps.select("fp").mapInArrow(sums, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def _correlation(n: int, together: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frequency of each bit and the correlation of each two."""
    n = max(n, 1)
    p = np.diag(together) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    correlation = (together / n - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(correlation, 1)
    return p, np.clip(correlation, -1, 1)


def information(bits: list[int], p: np.ndarray, correlation: np.ndarray) -> float:
    """About how many bits of information a group of bits has: what they have alone less what they share."""
    q = np.clip(p[bits], 1e-9, 1 - 1e-9)
    alone = float(-(q * np.log2(q) + (1 - q) * np.log2(1 - q)).sum())
    _, shared = np.linalg.slogdet(correlation[np.ix_(bits, bits)] + 1e-6 * np.eye(len(bits)))
    return max(alone + 0.5 * shared / np.log(2), 0.0)


def grouped_bits(n: int, together: np.ndarray, parts: int, even: bool = True) -> list[list[int]]:
    """Bits in ``parts`` groups, each grown by the bit most correlated with it: of equal size, or, not ``even``, as wide
    as it takes for equal information, so that bits which say the same make a wide group."""
    p, correlation = _correlation(n, together)
    strength = np.abs(correlation) - np.eye(BITS)
    free, groups = list(range(BITS)), []
    for part in range(parts):
        room = BITS // parts + (part < BITS % parts)
        group = [max(free, key=lambda bit: strength[bit, free].sum())]
        free.remove(group[0])
        share = information([*group, *free], p, correlation) / (parts - part)

        def full() -> bool:
            if even:
                return len(group) >= room
            return part + 1 < parts and (information(group, p, correlation) >= share or len(free) <= parts - part - 1)

        while free and not full():
            best = max(free, key=lambda bit: strength[bit, group].sum())
            group.append(best)
            free.remove(best)
        groups.append(sorted(group))
    return groups


def _within(differ: np.ndarray, distance: int) -> np.ndarray:
    """Chance that at most r of independent events with chances ``differ`` happen, r = 0 to ``distance``."""
    exactly = np.zeros(distance + 2)
    exactly[0] = 1.0
    for chance in differ:
        exactly[1:] = exactly[1:] * (1 - chance) + exactly[:-1] * chance
        exactly[0] *= 1 - chance
    return np.cumsum(exactly[:distance + 1])


def flips(mask: int, radius: int) -> list[int]:
    """All ways to change up to ``radius`` bits of ``mask``."""
    bits = [1 << bit for bit in range(BITS) if mask >> bit & 1]
    return [sum(chosen) for r in range(radius + 1) for chosen in itertools.combinations(bits, r)]


def _agreeing(fps: DataFrame, masks: list[int]) -> list[float]:
    """Per mask, the pairs of fingerprints that agree in it, counted over all of them."""
    keys = F.array(*[F.struct(F.lit(at).alias("at"), F.col("fp").bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("value"))
                     for at, mask in enumerate(masks)])
    counts = fps.select(F.explode(keys).alias("key")).groupBy("key").agg(F.count(F.lit(1)).cast("double").alias("n"))
    pairs = counts.groupBy("key.at").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).collect()
    found = {row["at"]: row["pairs"] for row in pairs}
    return [found.get(at, 0.0) for at in range(len(masks))]


def allocation(fps: DataFrame, distance: int = DISTANCE, parts: tuple[int, ...] = PARTS) -> list[tuple[int, int]]:
    """(mask, radius) of the parts that are looked up, of the cheapest plan. Parts are of equal width, or of equal
    information; with more than ``distance`` + 1 of them some are not looked up."""
    n, together = bit_statistics(fps)
    p = np.diag(together) / max(n, 1)
    plans = []
    for count, even in itertools.product(parts, (True, False)):
        groups = grouped_bits(n, together, count, even)
        masks = [sum(1 << bit for bit in group) for group in groups]
        plans.append((groups, masks))
    agreeing = iter(_agreeing(fps, [mask for _, masks in plans for mask in masks]))
    best = None
    for groups, masks in plans:
        costs = []
        for group, mask in zip(groups, masks):
            within = _within(2 * p[group] * (1 - p[group]), distance)
            pairs, width = next(agreeing) + 1.0, len(group)
            cost = [0.0]
            lookups = 0.0
            for radius in range(distance + 1):
                lookups += float(np.prod([(width - i) / (i + 1) for i in range(radius)]))
                cost.append(n * (lookups + 1) * LOOKUP_COST + pairs * within[radius] / max(within[0], 1e-30))
            costs.append(cost)
        # Least cost of the first parts for a sum of (radius + 1).
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            grown: dict[int, tuple[float, list[int]]] = {}
            for used, (sum_, radii) in table.items():
                for more in range(distance + 2 - used):
                    option = (sum_ + cost[more], [*radii, more - 1])
                    if used + more not in grown or option < grown[used + more]:
                        grown[used + more] = option
            table = grown
        total, radii = table[distance + 1]
        if best is None or total < best[0]:
            best = (total, [(mask, radius) for mask, radius in zip(masks, radii) if radius >= 0])
    return best[1]


def candidates(fps: DataFrame, plan: list[tuple[int, int]]) -> int:
    """How many pairs a plan verifies: those that meet in a part, each time they do."""
    kept, asked = _met(fps, plan)
    met = kept.join(asked, (kept["part"] == asked["part"]) & (kept["value"] == asked["value"]) & (F.col("a") < F.col("b")))
    return met.count()


def links(fps: DataFrame, distance: int = DISTANCE, parts: tuple[int, ...] = PARTS) -> DataFrame:
    """a < b: pairs of different fingerprints that differ in ``distance`` bits or fewer
    (a pair may come more than once). ``fps`` holds distinct fingerprints; pass a table."""
    kept, asked = _met(fps, allocation(fps, distance, parts))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    found = kept.join(asked, (kept["part"] == asked["part"]) & (kept["value"] == asked["value"])
                      & (F.col("a") < F.col("b")) & near)
    return found.select("a", "b")


def _met(fps: DataFrame, plan: list[tuple[int, int]]) -> tuple[DataFrame, DataFrame]:
    """Fingerprints by the parts of a plan: as they are (a), and with all that is looked up for them (b)."""
    fp = F.col("fp")

    def key(part: int, value: Column) -> Column:
        return F.struct(F.lit(part).alias("part"), value.alias("value"))

    def own(mask: int) -> Column:
        return fp.bitwiseAND(F.lit(_signed(mask)).cast("long"))

    def around(part: int, mask: int, radius: int) -> Column:
        changes = F.array(*[F.lit(_signed(change)).cast("long") for change in flips(mask, radius)])
        return F.transform(changes, lambda change: key(part, own(mask).bitwiseXOR(change)))

    index = F.array(*[key(at, own(mask)) for at, (mask, _) in enumerate(plan)])
    probe = F.flatten(F.array(*[around(at, mask, radius) for at, (mask, radius) in enumerate(plan)]))
    return fps.select(fp.alias("a"), F.inline(index)), fps.select(fp.alias("b"), F.inline(probe))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents are linked if their fingerprints differ in ``distance`` bits or fewer;
    ``component_id`` is the smallest id that links reach. A null text is an empty one,
    whose fingerprint is 0 and linked like any other; a null id counts for
    ``component_id`` only if no other is there. Repeated rows and ids share a component.
    No documents give no rows; other columns are not read.
    """
    return _judged(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def _judged(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """doc_id, text_key, fp and the first row (without_id, doc_id, text_key) of the component, of every document.

    Fingerprints and components that very many documents share are joined back by salt.
    """
    keyed = fingerprints(docs, shingle).withColumn("salt", salt("doc_id"))
    rows = materialize(keyed, "simhash-fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("without_id"), "doc_id", "text_key")
    classes = materialize(
        rows.groupBy("fp").agg(F.min(place).alias("first"), salts_present().alias("salts")), "simhash-classes")
    roots = components(links(classes.select("fp"), distance), "simhash-links")
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", "salts", F.coalesce("root", "fp").alias("root"), salt("fp").alias("_salt"))
    rooted = materialize(rooted, "simhash-rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("first"), salts_present("_salt").alias("_salts"))
    named = rooted.drop("first").join(per_salt(named, "_salts", "_salt"), ["root", "_salt"])
    return rows.join(per_salt(named.select("fp", "first", "salts")), ["fp", "salt"]).select("doc_id", "text_key", "fp", "first")


def drop_near_duplicates(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay, with all their columns: of each component the one with the smallest id, null ids last.

    Of several texts under that id the one with the smallest hash stays. Rows that repeat its id and text stay with it.
    """
    judged = _judged(docs, options.get("shingle", SHINGLE), options.get("distance", DISTANCE))
    first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return keep_rows(docs, judged.where(first).select("doc_id", "text_key"), "doc_id", text_key(F.col("text")))
