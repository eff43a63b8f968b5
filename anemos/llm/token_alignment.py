"""How the tokens of two tokenizers lie on each other, over a corpus with many copies.

1. Rows meet by their full text, combined in each task first, so every distinct text is one
   row with the number of its documents, and is tokenised and aligned once.
2. The byte offsets where tokens of both tokenizers end cut the two rows of tokens into groups;
   tokens whose byte ranges overlap are linked. A text's row holds its distinct id pairs and how often
   each is linked, compressed.
3. An id pair counts as many documents as the texts that hold it stand for: each task adds up its
   texts' pairs, weighted by their documents, and Spark adds up the tasks.
4. Each text looks its pairs up. The ``HEAD`` most frequent pairs go to every task (their
   number is fixed); the others meet their counts in a join, in which no pair has more than a
   ``HEAD``-th of all rows, as the more frequent ones are gone.
5. The measures go back to the documents by the digest of the text and a salt, which the id
   gives and of which a text's row has as many as its documents have.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .salts import per_salt, salt, salts_present
from .text import whole

HEAD = 1 << 16
#: Bytes of texts that are aligned together, and pairs that a task adds up before it gives them out.
BATCH_BYTES = 1 << 20
PENDING_PAIRS = 1 << 21
HELD_PAIRS = 1 << 22
MEASURES = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies(NamedTuple):
    """Files of the two tokenizers, and the pattern by which the first cuts a text into words."""

    byte_level: str
    pieces: str
    pattern: str


def byte_level_bytes() -> dict[str, int]:
    """Byte of each letter that byte-level vocabularies write it as: printable Latin-1 ones stand for
    themselves, the others in turn for the letters from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [byte for byte in range(256) if byte not in plain]
    return {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    """The bytes that a piece stands for: <0xHH> a byte, U+2581 a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Sides:
    """Both tokenizers, the bytes of their ids and the digits of ids as groups show them."""

    def __init__(self, files: Vocabularies):
        import sentencepiece
        import tiktoken

        with open(files.byte_level, encoding="utf-8") as file:
            content = json.load(file)
        special = {token["content"] for token in content["added_tokens"] if token["special"]}
        letters = byte_level_bytes()
        ranks = {bytes(letters[c] for c in token): id_ for token, id_ in content["model"]["vocab"].items() if token not in special}
        self.first = tiktoken.Encoding("first", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
        self.size_a, self.size_b = max(ranks.values()) + 1, self.second.get_piece_size()
        bytes_a = dict(zip(ranks.values(), ranks))
        self.bytes_a = [bytes_a.get(id_, b"") for id_ in range(self.size_a)]
        self.bytes_b = [piece_bytes(self.second.id_to_piece(id_)) for id_ in range(self.size_b)]
        self.length_a, self.length_b = (np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b))
        # Ids followed by the sign that stands behind them, inside and at the end of a group's side.
        self.shown = [b"%d%c" % (id_, sign) for size, signs in ((self.size_a, b",|"), (self.size_b, b",;"))
                      for sign in signs for id_ in range(size)]

    def ids(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both, or None if the text is empty or either side does not spell it."""
        if not text:
            return None
        words = text.decode("utf-8", "replace")
        a = self.first.encode_ordinary(" " + words)
        b = self.second.encode(words, num_threads=1)
        spelt = b" " + text
        if b"".join(map(self.bytes_a.__getitem__, a)) != spelt or b"".join(map(self.bytes_b.__getitem__, b)) != spelt:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


class Aligned(NamedTuple):
    """Of one text: its counts, its groups as text, and its distinct id pairs (a * size of b + b) with their links."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    groups: bytes = b""
    codes: np.ndarray = np.empty(0, np.int64)
    links: np.ndarray = np.empty(0, np.int64)


def align(texts: list[bytes], sides: Sides) -> list[Aligned]:
    """The alignment of each text. The token rows of all are laid end to end, so each step is one array operation."""
    found = [sides.ids(text) for text in texts]
    spelt = [at for at, ids in enumerate(found) if ids is not None]
    result = [Aligned()] * len(texts)
    if not spelt:
        return result
    n_a, n_b = (np.array([len(found[at][side]) for at in spelt]) for side in (0, 1))
    a, b = (np.concatenate([found[at][side] for at in spelt]) for side in (0, 1))
    end_a, end_b = np.cumsum(sides.length_a[a]), np.cumsum(sides.length_b[b])
    ends_a, ends_b = (np.zeros(int(end_a[-1]) + 1, bool) for _ in range(2))
    ends_a[end_a], ends_b[end_b] = True, True
    # Every stretch between two ends lies in one token of either side, and is all that these two share.
    stretch = np.flatnonzero(ends_a | ends_b)
    is_a, is_b = ends_a[stretch], ends_b[stretch]
    both = is_a & is_b
    pair = a[np.cumsum(is_a) - is_a] * sides.size_b + b[np.cumsum(is_b) - is_b]
    group = np.cumsum(both) - both
    group_a, group_b, last_a, last_b = group[is_a], group[is_b], both[is_a], both[is_b]
    # Groups as text: the first side's tokens of a group, then the second's.
    shown = np.empty(len(a) + len(b), np.int64)
    before_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
    shown[np.arange(len(a)) + before_b[group_a]] = a + last_a * sides.size_a
    shown[np.arange(len(b)) + (np.flatnonzero(last_a) + 1)[group_b]] = 2 * sides.size_a + b + last_b * sides.size_b
    shown = shown.tolist()

    text_end = end_a[np.cumsum(n_a) - 1]
    links_to = np.searchsorted(stretch, text_end, "right")
    groups_to = np.cumsum(both)[links_to - 1]
    n_links, n_groups = np.diff(links_to, prepend=0), np.diff(groups_to, prepend=0)
    space = sides.size_a * sides.size_b
    keys, times = np.unique(np.repeat(np.arange(len(spelt)), n_links) * space + pair, return_counts=True)
    pairs_to = np.searchsorted(keys, np.arange(1, len(spelt) + 1) * space)
    codes = keys % space
    shown_from = pairs_from = 0
    for at, *counts, pairs_end in zip(spelt, n_a.tolist(), n_b.tolist(), n_groups.tolist(), n_links.tolist(), pairs_to.tolist()):
        shown_end = shown_from + counts[0] + counts[1]
        groups = b"".join(map(sides.shown.__getitem__, shown[shown_from:shown_end]))[:-1]
        result[at] = Aligned(*counts, groups, codes[pairs_from:pairs_end], times[pairs_from:pairs_end])
        shown_from, pairs_from = shown_end, pairs_end
    return result


def packed_pairs(codes: np.ndarray, links: np.ndarray) -> bytes:
    """Pairs with their links in few bytes: steps from code to code, byte by byte, compressed."""
    import zstandard

    numbers = np.stack((np.diff(codes, prepend=0), links)).astype("<i8")
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked_pairs(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(8, -1)
    steps, links = np.ascontiguousarray(planes.T).view("<i8").reshape(2, -1)
    return np.cumsum(steps), links


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@functools.cache
def _sides(files: Vocabularies) -> Sides:
    return Sides(files)


def aligned_texts(docs: DataFrame, files: Vocabularies, groups: bool = False) -> DataFrame:
    """One row per distinct text: row (its number), digest, copies, salts (a bit for each), n_a, n_b, n_groups,
    n_links, groups_sha256, pairs (packed), and the groups themselves if asked for.

    Groups read ``a1,a2|b1;a3|b2,b3``. A text that is null, empty or not spelt alike by
    both tokenizers has zeros, no pairs and '' for its groups and their digest.
    """
    send_with_tasks(__name__)
    salted = docs.select(whole(F.col("text")).alias("text"), salt("doc_id").alias("salt"))
    texts = salted.groupBy("text").agg(F.count(F.lit(1)).alias("copies"), salts_present().alias("salts"))
    rows = texts.select(_digest(F.col("text")).alias("digest"), "copies", "salts", F.col("text").cast("binary").alias("text"))
    shown = ["groups"] if groups else []

    def parts(column: pa.Array) -> Iterator[list[bytes]]:
        part, size = [], 0
        for text in column:
            part.append(text.as_buffer().to_pybytes())
            size += len(part[-1])
            if size >= BATCH_BYTES:
                yield part
                part, size = [], 0
        yield part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(files)
        for batch in batches:
            done = 0
            for part in parts(batch.column("text")):
                found = align(part, sides)
                kept = batch.slice(done, len(part))
                done += len(part)
                columns = [kept.column(name) for name in ("digest", "copies", "salts")]
                columns += [pa.array([getattr(row, name) for row in found], pa.int64()) for name in MEASURES]
                columns.append(pa.array([hashlib.sha256(row.groups).hexdigest() if row.groups else "" for row in found], pa.string()))
                columns.append(pa.array([packed_pairs(row.codes, row.links) for row in found], pa.binary()))
                columns += [pa.array([row.groups.decode() for row in found], pa.string()) for _ in shown]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "copies", "salts", *MEASURES, "groups_sha256", "pairs", *shown])

    schema = ("digest binary, copies bigint, salts bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
              "groups_sha256 string, pairs binary" + "".join(f", {name} string" for name in shown))
    made = rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())
    return materialize(made, "token-alignment")


def added_up(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(codes), return_inverse=True)
    sums = np.zeros(len(distinct), np.int64)
    np.add.at(sums, at, np.concatenate(counts))
    return distinct, sums


def pair_counts(aligned: DataFrame, size_b: int) -> DataFrame:
    """code, n (documents that hold the pair linked) and best (no pair with its first id has more) of every id pair.

    A first id has at most as many pairs as there are second ids, which bounds the window.
    """
    send_with_tasks(__name__)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, pending, held = [], [], 0, 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes[0]), pa.array(counts[0])], names=["code", "n"])

        for batch in batches:
            for copies, packed in zip(batch.column("copies").to_pylist(), batch.column("pairs")):
                found, _ = unpacked_pairs(packed.as_buffer())
                codes.append(found)
                counts.append(np.full(len(found), copies))
                pending += len(found)
                if pending >= PENDING_PAIRS + held:
                    codes, counts = map(lambda x: [x], added_up(codes, counts))
                    pending, held = 0, len(codes[0])
                    if held >= HELD_PAIRS:
                        yield given()
                        codes, counts, held = [], [], 0
        if codes:
            codes, counts = map(lambda x: [x], added_up(codes, counts))
            yield given()

    sums = aligned.where("n_links > 0").select("copies", "pairs").mapInArrow(count, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
    first = Window.partitionBy(F.expr(f"code div {size_b}"))
    return materialize(sums.withColumn("best", F.col("n") == F.max("n").over(first)), "token-pairs")


def text_sums(aligned: DataFrame, counts: DataFrame, head: int = HEAD) -> DataFrame:
    """row, n_best and count_sum of every text with links."""
    send_with_tasks(__name__)
    frequent = counts.orderBy(F.desc("n"), "code").limit(head).toArrow().sort_by("code")
    top = [frequent.column(name).to_numpy() for name in ("code", "n", "best")]
    shared = aligned.sparkSession.sparkContext.broadcast(top)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            rows = []
            for row, packed in zip(batch.column("row").to_pylist(), batch.column("pairs")):
                found, links = unpacked_pairs(packed.as_buffer())
                at = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
                known = codes[at] == found
                at, of = at[known], links[known]
                rows.append((row, int(of[best[at]].sum()), int((of * n[at]).sum()), found[~known], links[~known]))
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["row", "n_best", "count_sum", "codes", "links"])

    schema = "row bigint, n_best bigint, count_sum bigint, codes array<bigint>, links array<bigint>"
    found = materialize(aligned.where("n_links > 0").select("row", "pairs").mapInArrow(look_up, schema), "token-sums")
    rare = found.where("size(codes) > 0").select("row", F.inline(F.arrays_zip("codes", "links"))).withColumnRenamed("codes", "code")
    rare = rare.join(counts, "code").select(
        "row", F.expr("if(best, links, 0)").alias("n_best"), F.expr("links * n").alias("count_sum"))
    both = found.select("row", "n_best", "count_sum").unionByName(rare)
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def document_alignments(docs: DataFrame, files: Vocabularies, head: int = HEAD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    ``n_best`` counts the links whose pair is in as many documents as any pair with the same first id,
    ``count_sum`` adds up, over the links, the documents that hold the pair.

    Null ids and repeated rows and ids are documents of their own, which all count. Null and empty texts
    have zeros and ''. No documents give no rows; other columns are not read. Equal texts are found by their
    content; where their measures go back to the documents, a SHA-256 stands for a text.
    """
    aligned = aligned_texts(docs, files)
    counts = pair_counts(aligned, _sides(files).size_b)
    sums = text_sums(aligned, counts, head)
    texts = aligned.drop("pairs").join(sums, "row", "left").select(
        "digest", "salts", *MEASURES, *[F.coalesce(name, F.lit(0)).cast("long").alias(name) for name in ("n_best", "count_sum")],
        "groups_sha256")
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _digest(whole(F.col("text"))).alias("digest"), salt("doc_id").alias("salt"))
    return keyed.join(per_salt(texts), ["digest", "salt"]).select(
        "doc_id", *MEASURES, "n_best", "count_sum", "groups_sha256")
