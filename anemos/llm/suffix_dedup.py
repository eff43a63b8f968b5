"""Repeated passages: every byte of a long string that also starts earlier goes.

A suffix index over a whole corpus cannot be built in parts, so the corpus is first cut
where only the repetitive part is left, without losing a match:

1. Anchors. Each window of ``length`` bytes is given the least hashed ``GRAM``-byte gram
   inside it; windows next to each other that share it form a stretch. Equal windows
   have equal grams at the same place, so they are found under one anchor. A task
   combines equal stretches (same anchor, same hash) among the texts it holds; rows
   then meet by anchor, where all but the first of equal stretches are matches as a whole.
2. Run-length index. Anchors that have several different stretches (the edges of repeated passages) go on,
   with their bytes, into buckets of bounded size. Each bucket builds the Burrows-Wheeler
   transform of its stretches, keeps its runs, the suffix places at run ends and the ranks
   where the longest common prefix falls below ``length``, and streams the stretches
   backwards from the sampled run ends: every step tells the interval of suffixes
   that match the window at hand, and the first place in it.
3. An anchor with more than ``GROUP`` rows is too large for a task. Its equal stretches are combined
   before they meet and joined back, and the windows of what is left are matched by 128-bit hash in
   a shuffle instead.

The matches of a document are merged and cut out. Stretches are told apart by the
128 bits of anchor and stretch hash; the index compares bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .text import whole

LENGTH = 100
GRAM = 32
CHUNK = 1 << 20
GROUP = 20_000
BUCKET_BYTES = 1 << 21
_PLACE_BITS = 22
_RNG = np.random.default_rng(20240607)
_TABLES = _RNG.integers(0, 1 << 63, (3, 256), np.int64).astype("u8") * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of two bases and of their inverses modulo 2^64, for hashes of any stretch of a chunk."""

    def __init__(self, size: int):
        def powers(base: int) -> np.ndarray:
            row = np.full(size, base, "u8")
            row[0] = 1
            return np.cumprod(row, dtype="u8")

        self.up = [powers(base) for base in _BASES[1:]]
        self.down = [powers(pow(base, -1, 1 << 64)) for base in _BASES[1:]]

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        found = []
        for table, up, down in zip(_TABLES[1:], self.up, self.down):
            sums = np.zeros(len(data) + 1, "u8")
            np.cumsum(table[data] * up[:len(data)], out=sums[1:])
            found.append(_mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype("u8")))
        return found


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes (a power of two) from each place on."""
    row, size, base = _TABLES[0][data], 1, _BASES[0]
    while size < gram:
        row = row[:-size] * np.uint64(base) + row[size:]
        size, base = 2 * size, base * base % (1 << 64)
    return _mixed(row)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each ``width`` in a row."""
    row, size = keys, 1
    while 2 * size <= width:
        row = np.minimum(row[:-size], row[size:])
        size *= 2
    rest = width - size
    return np.minimum(row[:len(row) - rest], row[rest:]) if rest else row


def stretches(data: np.ndarray, bounds: np.ndarray, length: int, powers: _Powers) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor hash and content hash of each stretch of a chunk of texts.

    ``bounds`` are the texts' first places and the end of the last. At most 2^22 bytes.
    """
    n = len(data) - length + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, "u8"),) * 2
    grams = _gram_hashes(data, GRAM)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype="u8")
    anchors = (_least(keys, length - GRAM + 1) & low).astype(np.int64)
    crossing = np.zeros(n + 1, np.int32)
    for end in bounds[1:-1]:
        crossing[max(0, end - length + 1)] += 1
        crossing[min(end, n)] -= 1
    windows = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    if not len(windows):
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, "u8"),) * 2
    own = anchors[windows]
    breaks = np.flatnonzero(own[1:] != own[:-1]) + 1
    at = np.concatenate(([0], breaks))
    first = windows[at]
    count = np.diff(np.append(at, len(windows)))
    one, two = powers.hashes(data, first, first + count - 1 + length)
    return first, count, grams[own[at]], one ^ (two << np.uint64(1) | two >> np.uint64(63))


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and the places where its values start and the last ends."""
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    places = np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), places


def batch_stretches(texts: pa.Array, docs: np.ndarray, length: int, powers: _Powers) -> dict[str, np.ndarray]:
    """Stretches of a batch, equal ones combined: the first in the order of documents and places stays as
    (a, h, doc, start, n); the others become matches (n minus their length in bytes)."""
    data, places = _buffer(texts)
    found: list[tuple[np.ndarray, ...]] = []

    def add(low: int, high: int, first_doc: int, bounds: np.ndarray) -> None:
        first, count, a, h = stretches(data[low:high], bounds - low, length, powers)
        own = first_doc + np.searchsorted(bounds - low, first, "right") - 1
        found.append((own, first + low - places[own], count, a, h))

    at = 0
    while at < len(docs):
        to = at + 1
        if places[to] - places[at] > CHUNK:
            for low in range(int(places[at]), int(places[to]) - length + 1, CHUNK - length + 1):
                high = min(low + CHUNK, int(places[to]))
                add(low, high, at, np.array([low, high]))
        else:
            while to < len(docs) and places[to + 1] - places[at] <= CHUNK:
                to += 1
            add(int(places[at]), int(places[to]), at, places[at:to + 1])
        at = to
    own, start, n, a, h = (np.concatenate(part) for part in zip(*found)) if found else (np.empty(0, np.int64),) * 5
    doc = docs[own]
    order = np.lexsort((start, doc, h, a))
    doc, start, n, a, h = doc[order], start[order], n[order], a[order].astype("u8"), h[order].astype("u8")
    repeat = np.zeros(len(a), bool)
    repeat[1:] = (a[1:] == a[:-1]) & (h[1:] == h[:-1])
    # Matches that touch are one; their rows spread by a hash of their own.
    r = np.flatnonzero(repeat)
    r = r[np.lexsort((start[r], doc[r]))]
    m_doc, m_start, m_end = doc[r], start[r], start[r] + n[r] + length - 1
    fresh = np.ones(len(r), bool)
    fresh[1:] = (m_doc[1:] != m_doc[:-1]) | (m_start[1:] > m_end[:-1])
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(r)) - 1
    m_doc, m_start, m_size = m_doc[head], m_start[head], m_end[last] - m_start[head] if len(head) else m_end[:0]
    key = _mixed(m_doc.astype("u8") * np.uint64(_BASES[0]) + m_start.astype("u8"))
    one = ~repeat
    return {
        "a": np.concatenate((a[one], key)).view("i8"), "h": np.concatenate((h[one], key)).view("i8"),
        "doc": np.concatenate((doc[one], m_doc)), "start": np.concatenate((start[one], m_start)),
        "n": np.concatenate((n[one], -m_size)).astype(np.int64)}


class RunIndex:
    """Run-compressed Burrows-Wheeler transform of texts, each ended by a mark of its own.

    Kept: the first rank of each run and where the last-to-first map sends it, rank and place of
    run ends (and of the marks), and the ranks where a new class of suffixes with
    the same first ``length`` bytes begins.
    """

    def __init__(self, texts: list[bytes], length: int):
        m = len(texts)
        sizes = np.array([len(text) for text in texts])
        ends = np.cumsum(sizes + 1) - 1
        joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        codes = joined.astype(np.int64) + m
        codes[ends] = np.arange(m)
        n = len(codes)
        half = 1 << ((length - 1).bit_length() - 1)
        longest = int(sizes.max()) + 1
        rank, size, at_half = codes, 1, None
        # As many codes as fit into one number need no sorting.
        while size < half and (top := int(rank.max()) + 2) < 1 << 31:
            rank = self._paired(rank, size, top)
            size *= 2
        key = rank
        while True:
            order = np.argsort(key)
            ordered = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
            if size == half:
                at_half = rank
            if size >= longest and at_half is not None:
                break
            key = self._paired(rank, size, n + 1)
            size *= 2
        suffixes = np.empty(n, np.int64)
        suffixes[rank] = np.arange(n)
        # First ``length`` bytes: two overlapping halves of a power of two.
        shift = length - half
        key = at_half * (n + 1)
        key[:n - shift] += at_half[shift:] + 1
        ordered = key[suffixes]
        self.class_starts = np.concatenate(([0], np.flatnonzero(ordered[1:] != ordered[:-1]) + 1))
        before = codes[suffixes - 1]
        self.run_starts = np.concatenate(([0], np.flatnonzero(before[1:] != before[:-1]) + 1))
        run_codes = before[self.run_starts]
        run_sizes = np.diff(np.append(self.run_starts, n))
        by_code = np.argsort(run_codes, kind="stable")
        self.sent_to = np.empty(len(run_codes), np.int64)
        self.sent_to[by_code] = np.cumsum(run_sizes[by_code]) - run_sizes[by_code]
        run_ends = np.append(self.run_starts[1:], n) - 1
        ranks = np.union1d(run_ends, np.arange(m))
        places = suffixes[ranks]
        by_place = np.argsort(places)
        self.sample_ranks, self.sample_places = ranks[by_place], places[by_place]
        self.ends, self.n, self.length = ends, n, length

    @staticmethod
    def _paired(rank: np.ndarray, size: int, top: int) -> np.ndarray:
        """Keys in the order of twice as many codes."""
        key = rank * top
        key[:len(key) - size] += rank[size:] + 1
        return key

    def stepped(self, ranks: np.ndarray) -> np.ndarray:
        """Ranks of the suffixes that start one place earlier."""
        run = np.searchsorted(self.run_starts, ranks, "right") - 1
        return self.sent_to[run] + ranks - self.run_starts[run]

    def ranks(self) -> np.ndarray:
        """Rank of the suffix at every place, streamed backwards from all samples at once."""
        found = np.empty(self.n, np.int64)
        gaps = np.diff(np.concatenate(([-1], self.sample_places)))
        order = np.argsort(-gaps, kind="stable")
        ranks, places, gaps = self.sample_ranks[order], self.sample_places[order], gaps[order]
        step = 0
        while len(ranks):
            found[places - step] = ranks
            step += 1
            going = int(np.searchsorted(-gaps, -step, "left"))
            ranks, places, gaps = self.stepped(ranks[:going]), places[:going], gaps[:going]
        return found

    def repeated(self) -> np.ndarray:
        """Places where a window starts that starts at an earlier place too."""
        sizes = np.diff(np.concatenate(([-1], self.ends))) - 1
        text_end = np.repeat(self.ends, sizes + 1)
        windows = np.flatnonzero(np.arange(self.n) + self.length <= text_end)
        found = np.searchsorted(self.class_starts, self.ranks()[windows], "right") - 1
        first = np.full(len(self.class_starts), self.n, np.int64)
        first[found[::-1]] = windows[::-1]
        return windows[windows > first[found]]


def bucket_matches(stretch: pd.DataFrame, length: int) -> pd.DataFrame:
    """doc, start and end of what the stretches (doc, start, body) of a bucket repeat of earlier ones."""
    stretch = stretch.sort_values(["doc", "start"], ignore_index=True)
    index = RunIndex([bytes(body) for body in stretch["body"]], length)
    places = index.repeated()
    text = np.searchsorted(index.ends, places)
    offset = places - np.concatenate(([-1], index.ends))[text] - 1
    # Runs of windows within one stretch.
    fresh = np.ones(len(places), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (offset[1:] != offset[:-1] + 1)
    head = np.flatnonzero(fresh)
    last = np.append(head[1:], len(places)) - 1
    base = stretch["start"].to_numpy()[text[head]]
    return pd.DataFrame({
        "doc": stretch["doc"].to_numpy()[text[head]], "start": base + offset[head],
        "end": base + offset[last] + length if len(head) else base})


def _window_matches(wide: DataFrame, length: int) -> DataFrame:
    """The same for stretches of anchors too large for a bucket: windows meet by their hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(CHUNK)
        for batch in batches:
            for doc, start, body in zip(*(batch.column(c).to_pylist() for c in ("doc", "start", "body"))):
                at = np.arange(len(body) - length + 1)
                one, two = powers.hashes(np.frombuffer(body, np.uint8), at, at + length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view("i8")), pa.array(two.view("i8")), pa.array(np.full(len(at), doc)), pa.array(start + at)],
                    names=["w1", "w2", "doc", "start"])

    windows = materialize(
        wide.select("doc", "start", "body").mapInArrow(cut, "w1 bigint, w2 bigint, doc bigint, start bigint"), "suffix-windows")
    first = windows.groupBy("w1", "w2").agg(
        F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    return windows.join(first, ["w1", "w2"]).where(F.struct("doc", "start") > F.col("first")).select(
        "doc", "start", (F.col("start") + length).alias("end"))


def _few(found: DataFrame, length: int) -> DataFrame:
    """doc, start, size, matched, a and crowded of the stretches that match as a whole or go on, for anchors of
    few rows: the rows of an anchor meet in one partition."""
    by_anchor = Window.partitionBy("a")
    equal = Window.partitionBy("a", "h").orderBy("doc", "start")
    rows = found.select(
        "*", F.row_number().over(equal).alias("copy"),
        F.min("h").over(by_anchor).alias("least"), F.max("h").over(by_anchor).alias("most"))
    return rows.where("n < 0 or copy > 1 or least <> most").select(
        "doc", "start", F.expr(f"if(n < 0, -n, n + {length - 1})").alias("size"),
        F.expr("n < 0 or copy > 1").alias("matched"), "a", F.lit(False).alias("crowded"))


def _many(found: DataFrame, length: int) -> DataFrame:
    """The same for anchors of many rows: equal stretches are combined in each task before they meet, and
    what is left is joined back, which a hot key does not hold up as joins can be split."""
    size = F.lit(length - 1)
    classes = materialize(
        found.groupBy("a", "h").agg(F.min(F.struct("doc", "start", "n")).alias("first"), F.count(F.lit(1)).alias("times")),
        "suffix-classes")
    several = classes.groupBy("a").count().where("count > 1").select("a")
    copies = found.join(classes.where("times > 1").select("a", "h", "first"), ["a", "h"]).where(
        F.struct("doc", "start") > F.struct("first.doc", "first.start"))
    return copies.select(
        "doc", "start", (F.col("n") + size).alias("size"), F.lit(True).alias("matched"), "a", F.lit(True).alias("crowded"),
    ).unionByName(classes.join(several, "a", "left_semi").select(
        "first.doc", "first.start", (F.col("first.n") + size).alias("size"), F.lit(False).alias("matched"), "a",
        F.lit(True).alias("crowded")))


def find_matches(texts: DataFrame, length: int = LENGTH, group: int = GROUP, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc, start, end: byte ranges, possibly overlapping, whose union is what goes.

    ``texts`` holds doc, a number that tells texts apart and gives their order, and body, bytes.
    """
    send_with_tasks(__name__)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(CHUNK + 1)
        for batch in batches:
            columns = batch_stretches(batch.column("body"), batch.column("doc").to_numpy(), length, powers)
            yield pa.RecordBatch.from_pydict({name: pa.array(column) for name, column in columns.items()})

    found = materialize(
        texts.select("doc", "body").mapInArrow(emit, "a bigint, h bigint, doc bigint, start bigint, n bigint"),
        "suffix-found")
    crowded = materialize(found.groupBy("a").count().where(F.col("count") > group).select("a"), "suffix-crowded")
    rows = _few(found.join(crowded, "a", "left_anti"), length).unionByName(
        _many(found.join(crowded, "a", "left_semi"), length))
    rows = materialize(rows, "suffix-stretches")
    matches = rows.where("matched").select("doc", "start", (F.col("start") + F.col("size")).alias("end"))

    open_ = rows.where("not matched")
    total = open_.agg(F.sum("size")).first()[0] or 0
    asked = open_.groupBy("doc").agg(F.collect_list(F.struct("start", "size", "a", "crowded")).alias("asked"))
    bodies = texts.join(asked, "doc").select("doc", "body", F.inline("asked")).select(
        "doc", "start", F.expr("substring(body, cast(start + 1 as int), cast(size as int))").alias("body"), "a", "crowded")
    bodies = materialize(bodies, "suffix-bodies")
    buckets = max(1, -(-total // bucket_bytes))
    small = bodies.where("not crowded").withColumn("bucket", F.pmod(F.xxhash64("a"), F.lit(buckets)))
    indexed = small.select("bucket", "doc", "start", "body").groupBy("bucket").applyInPandas(
        _bucket_fitter(length), "doc bigint, start bigint, end bigint")
    return matches.unionByName(indexed).unionByName(_window_matches(bodies.where("crowded"), length))


def _bucket_fitter(length: int):
    def fit(stretch: pd.DataFrame) -> pd.DataFrame:
        return bucket_matches(stretch, length)

    return fit


def _merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    runs: list[list[int]] = []
    for start, end in sorted(zip(starts, ends)):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return [tuple(run) for run in runs]


def _numbered(docs: DataFrame) -> DataFrame:
    """doc, doc_id and body; doc is doc_id where ids are unique, else a number in the order of ids and texts."""
    body = whole(F.col("text")).cast("binary")
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body.alias("body"))
    odd = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null")
    if odd.isEmpty():
        return plain.withColumn("doc", F.col("doc_id"))
    ranged = plain.repartitionByRange(F.col("doc_id").asc_nulls_last(), "body")
    ranged = ranged.sortWithinPartitions(F.col("doc_id").asc_nulls_last(), "body")
    return materialize(ranged.withColumn("doc", F.monotonically_increasing_id()), "suffix-documents")


def remove_repeats(docs: DataFrame, length: int = LENGTH, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes left) and spans (start, end) of every document.

    Texts are bytes of UTF-8; a null text is empty. Strings are judged on the input.
    Earlier means a smaller id, or an earlier start in the same document. Rows that
    share an id are documents of their own, in the order of their texts, and null ids come last. Texts
    shorter than ``length`` are left alone. No documents give no rows; other columns are not read.
    ``length`` is 64 or more.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length is {2 * GRAM} or more")
    texts = _numbered(docs)
    matches = materialize(find_matches(texts, length, **options), "suffix-matches")
    spans = matches.groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    rows = texts.join(spans, "doc", "left").select("doc_id", "body", "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("body", "starts", "ends"))):
                runs = _merged(starts or [], ends or [])
                edges = [0, *(edge for run in runs for edge in run), len(body)]
                kept = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                out.append((len(body), len(body) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept,
                            [{"start": a, "end": b} for a, b in runs]))
            columns = zip(*out) if out else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans"])

    return rows.mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary, "
        "spans array<struct<start:bigint,end:bigint>>")
