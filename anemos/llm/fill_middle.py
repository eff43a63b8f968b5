"""Fill-in-the-middle: the lines of a text in another order, put together by a secondary sort.

A hash of the id draws two places between the lines of a text; the lines before, between
and behind them are prefix, middle and suffix. The output has them as prefix, suffix,
middle (``psm``) or suffix, prefix, middle (``spm``), each behind its sentinel, or the text
as it is (``plain``).

No task holds an output. The lines leave the reading task in chunks, keyed by document
and place in the output; ``repartitionAndSortWithinPartitions`` brings the chunks of a document
together in that order, and they stream on one by one: into a digest, or to whoever reads them.
To restore the text, the stream's sentinels say which part a chunk belongs to, and
the chunks are sorted once more, by document and place in the text. That sort keeps the
partitioning, so it moves nothing. Both sorts spill to disk. A key holds the input partition and a hash of
the row, so chunks of a lost task come again under the same keys, and copies of a row lie in
as many partitions as they were read from.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import send_with_tasks
from .text import utf8_bytes, whole

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Parts in the order of the text, and the sentinel of each.
PARTS = (PREFIX, MIDDLE, SUFFIX)
CHUNK = 1 << 16
#: Text of a partition, and the most partitions; beyond them partitions grow and their sorts spill.
PARTITION_BYTES = 1 << 25
MOST_PARTITIONS = 1 << 16
COLUMNS = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint"
_HEADER, _END = -1, len(PARTS)


class Rates(NamedTuple):
    """How documents are drawn: the seed, the percentage that is transformed, and that of ``spm`` among those."""

    seed: int = 7
    transformed: int = 100
    spm: int = 50


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers that the id and the seed determine; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[at:at + 8], 16) for at in range(0, 32, 8)]


def _chars(data: bytes) -> int:
    """Code points of valid UTF-8: the bytes that begin one."""
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def _line_ends(text: bytes) -> np.ndarray:
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if text.endswith(b"\n") or not text else np.append(ends, len(text))


def _chunks(text: bytes, ends: np.ndarray, start: int, stop: int) -> Iterator[bytes]:
    """Whole lines of ``text[start:stop]``, about ``CHUNK`` bytes together; a longer line is cut."""
    while start < stop:
        cut = min(start + CHUNK, stop)
        if cut < stop:
            line = int(ends[np.searchsorted(ends, cut, "right") - 1]) if ends[0] <= cut else 0
            cut = line if line > start else cut
        yield text[start:cut]
        start = cut


def output_pieces(doc_id: int | None, text: bytes, rates: Rates) -> tuple[tuple, Iterator[bytes]]:
    """The header (doc_id, n, form, prefix_chars, middle_chars) and the chunks of the output, in order."""
    ends = _line_ends(text)
    first, second, share, order = draws(doc_id, rates.seed)
    n = len(ends)
    if not text or any(mark in text for mark in PARTS) or share % 100 >= rates.transformed:
        return (doc_id, n, "plain", None, None), _chunks(text, ends, 0, len(text))
    low, high = sorted((first % (n + 1), second % (n + 1)))
    places = [0, *(int(ends[at - 1]) if at else 0 for at in (low, high)), len(text)]
    parts = dict(zip(PARTS, zip(places, places[1:])))
    form = "spm" if order % 100 < rates.spm else "psm"
    in_order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)

    def pieces() -> Iterator[bytes]:
        for mark in in_order:
            yield mark
            yield from _chunks(text, ends, *parts[mark])

    sizes = [_chars(text[start:stop]) for start, stop in (parts[PREFIX], parts[MIDDLE])]
    return (doc_id, n, form, *sizes), pieces()


def _deal(key: tuple) -> int:
    return int.from_bytes(key[0][:8], "big")


def _sorted(pieces: RDD, partitions: int) -> RDD:
    return pieces.repartitionAndSortWithinPartitions(partitions, _deal)


def _row_key(partition: int, doc_id: int | None, text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16, key=f"{partition}:{doc_id}".encode()).digest()


def output_stream(docs: DataFrame, rates: Rates = Rates()) -> RDD:
    """((document, place), piece) of all outputs, each partition in that order: first a header, at
    place 0, then the chunks of the output. Rows that repeat within an input partition repeat their pieces."""
    send_with_tasks(__name__)
    rows = docs.select(F.col("doc_id").cast("long"), whole(F.col("text")).cast("binary"))
    size = docs.select(F.sum(utf8_bytes(F.col("text")))).first()[0] or 0

    def emit(partition: int, rows: Iterator) -> Iterator[tuple]:
        for doc_id, text in rows:
            text = bytes(text)
            document = _row_key(partition, doc_id, text)
            header, pieces = output_pieces(doc_id, text, rates)
            yield (document, 0), header
            for place, piece in enumerate(pieces, 1):
                yield (document, place), piece

    partitions = min(max(1, -(-size // PARTITION_BYTES)), MOST_PARTITIONS)
    return _sorted(rows.rdd.mapPartitionsWithIndex(emit), partitions)


def _documents(stream: Iterator[tuple]) -> Iterator[tuple[bytes, list, Iterator]]:
    """(document, [header, copies], pieces) in turn. The copies are known before the pieces, which must be used up."""
    rows = iter(stream)
    ahead = [next(rows, None)]

    def pieces(document: bytes) -> Iterator[bytes]:
        last = None
        while ahead[0] is not None and ahead[0][0][0] == document:
            key, piece = ahead[0]
            ahead[0] = next(rows, None)
            if key != last:
                yield key, piece
            last = key

    while ahead[0] is not None:
        first, header = ahead[0]
        copies = 0
        while ahead[0] is not None and ahead[0][0] == first:
            copies += 1
            ahead[0] = next(rows, None)
        yield first[0], [header, copies], pieces(first[0])


def text_pieces(form: str, output: Iterator[bytes]) -> Iterator[tuple[int, bytes]]:
    """(part, piece) of an output that comes in pieces, sentinels by themselves: what restores the text when sorted by part."""
    part = 0
    for piece in output:
        if form != "plain" and piece in PARTS:
            part = PARTS.index(piece)
        else:
            yield part, piece


def restored_stream(outputs: RDD) -> RDD:
    """((document, part, place), piece) from :func:`output_stream`, in the order of the texts: first the
    header with the number of copies, then the pieces of the text, last the digest of the output."""
    def turn(rows: Iterator[tuple]) -> Iterator[tuple]:
        for document, header, pieces in _documents(rows):
            digest = hashlib.sha256()

            def read(pieces: Iterator = pieces, digest=digest) -> Iterator[bytes]:
                for _, piece in pieces:
                    digest.update(piece)
                    yield piece

            yield (document, _HEADER, 0), header
            for place, (part, piece) in enumerate(text_pieces(header[0][2], read())):
                yield (document, part, place), piece
            yield (document, _END, 0), digest.hexdigest()

    return _sorted(outputs.mapPartitions(turn, preservesPartitioning=True), outputs.getNumPartitions())


def document_digests(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n (lines), form, prefix_chars, middle_chars, output_sha256 and restored_sha256 of every document.

    The second digest is of the text rebuilt from the output. A null text is an empty one,
    which is plain, as is a text that holds a sentinel; both have null sizes. A null id is drawn like an
    id without digits. Repeated rows and ids are documents of their own. No documents give no rows; other
    columns are not read. Memory is bounded by the chunks and the longest single text that is read.
    """
    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, (first, _), pieces in _documents(rows):
            (header, copies), output, digest = first, None, hashlib.sha256()
            for (_, part, _), piece in pieces:
                if part == _END:
                    output = piece
                else:
                    digest.update(piece)
            for _ in range(copies):
                yield (*header, output, digest.hexdigest())

    found = restored_stream(output_stream(docs, rates)).mapPartitions(read)
    return docs.sparkSession.createDataFrame(found, f"{COLUMNS}, output_sha256 string, restored_sha256 string", verifySchema=False)


def transformed_documents(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and output (the text to train on) of every document.

    Nulls, empty texts, repeats and other columns are as in :func:`document_digests`. An output is one value
    of a row, so it must fit into a task; a reader of :func:`output_stream` has no such limit.
    """
    return _joined(output_stream(docs, rates), lambda header, pieces: (*header, b"".join(pieces).decode()), "output", docs)


def restored_documents(docs: DataFrame, rates: Rates = Rates()) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and text, rebuilt from the outputs of ``docs`` by the second sort."""
    def text(first: list, pieces: list) -> tuple:
        return (*first[0], b"".join(pieces[:-1]).decode())

    return _joined(restored_stream(output_stream(docs, rates)), text, "text", docs, copies=lambda first: first[1])


def _joined(stream: RDD, row: Callable, name: str, docs: DataFrame, copies: Callable | None = None) -> DataFrame:
    def read(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, (header, seen), pieces in _documents(rows):
            made = row(header, [piece for _, piece in pieces])
            for _ in range(copies(header) if copies else seen):
                yield made

    return docs.sparkSession.createDataFrame(stream.mapPartitions(read), f"{COLUMNS}, {name} string", verifySchema=False)


def restore(output: str, form: str) -> str:
    """The text of one output, which only the output and its form tell."""
    if form == "plain":
        return output
    marks = sorted((output.index(mark.decode()), mark.decode()) for mark in PARTS)
    ends = [at for at, _ in marks[1:]] + [len(output)]
    parts = {mark: output[at + len(mark):end] for (at, mark), end in zip(marks, ends)}
    return "".join(parts[mark.decode()] for mark in PARTS)
