"""Best-fit packing of tokenised documents into sequences, by rounds over a tree.

Documents longer than a sequence are cut; full pieces are sequences as they are. The
other pieces are items. In a round the items, spread over groups by a hash, are packed
best-fit decreasing within each group. Bins that are nearly full, or into whose rest
not even the smallest item left anywhere would fit, are done. The others go into the
next round as items, several groups together, until one group is left, or a round no
longer saves a bin in a thousand. A group holds about ``GROUP_ITEMS`` items in any round, so the work of a
task does not grow with the corpus.
"""

from __future__ import annotations

import itertools
import re
import struct
import sys
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, send_with_tasks
from .text import whole

LENGTH = 4096
END_ID = 1
GROUP_ITEMS = 20_000
SLACK = 8
# What a worker's memory of pieces may take, the share of each in the table included, and how much is tokenised at once:
# the tokenizer needs some hundred bytes a piece for that.
MEMO_BYTES, ENTRY_BYTES = 64 << 20, 40
LEARN_CHARS = 1 << 15
TOKENISED_BYTES = 1 << 20
_LETTERS, _SIGNS = "a-zß-öø-ÿ", "!-&(-/:-@\\[-`{-~"
_PIECES = re.compile(f"[{_LETTERS}]+|[0-9]|[{_SIGNS}]+")
_PLAIN = re.compile(f"[{_LETTERS}]+|[{_SIGNS}]+")
_SIMPLE = re.compile(f"[A-ZÀ-ÖØ-Þ{_LETTERS}0-9{_SIGNS} \\t\\n\\x0b\\x0c\\r]*")


class PieceTokenizer:
    """Ids of texts by a tokenizer that reads runs of letters, runs of signs and digits one
    by one, ignores case, and joins nothing across them.

    The ids of a text are those of its pieces in a row, so pieces are looked up and only
    new ones are tokenised, ``LEARN_CHARS`` at a time. That goes for texts of Latin letters, digits and ASCII signs
    without apostrophes; a text with other characters is taken apart at white space
    only. The memory is emptied before it takes more than ``MEMO_BYTES``, and never holds a piece that takes more alone.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.held = 0

    def _tokenised(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        plain, odd = [], []
        for piece in new:
            (plain if _PLAIN.fullmatch(piece) else odd).append(piece)
        code = self.tokenizer.encode(" ".join(plain), add_special_tokens=False)
        ids, places = np.asarray(code.ids, "<u4"), np.asarray(code.word_ids, np.int64)
        if len(plain) != (places[-1] + 1 if len(places) else 0):
            raise ValueError("the tokenizer does not read such pieces one by one")
        ends = np.searchsorted(places, np.arange(len(plain)), "right") * 4
        data, start = ids.tobytes(), 0
        for piece, end in zip(plain, ends.tolist()):
            yield piece, data[start:end]
            start = end
        for piece, code in zip(odd, self.tokenizer.encode_batch(odd, add_special_tokens=False)):
            yield piece, np.asarray(code.ids, "<u4").tobytes()

    def _learn(self, new: Iterable[str]) -> dict[str, bytes]:
        """The ids of new pieces, which are also remembered as far as there is room."""
        learnt, part, chars = {}, [], 0
        for piece in new:
            if part and chars + len(piece) > LEARN_CHARS:
                learnt.update(self._tokenised(part))
                part, chars = [], 0
            part.append(piece)
            chars += len(piece)
        learnt.update(self._tokenised(part))
        for piece, code in learnt.items():
            size = sys.getsizeof(piece) + sys.getsizeof(code) + ENTRY_BYTES
            if size > MEMO_BYTES:
                continue
            if self.held + size > MEMO_BYTES:
                self.known.clear()
                self.held = 0
            self.known[piece] = code
            self.held += size
        return learnt

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts in UTF-8, as little-endian unsigned 32-bit numbers."""
        found, new = [], set()
        for text in texts:
            words = text.decode("utf-8")
            if _SIMPLE.fullmatch(words):
                pieces = _PIECES.findall(words.lower())
            else:
                pieces = [word.decode("utf-8") for word in text.split()]
            codes = list(map(self.known.get, pieces))
            gaps = [(at, pieces[at]) for at, code in enumerate(codes) if code is None]
            new.update(piece for _, piece in gaps)
            found.append((codes, gaps))
        learnt = self._learn(new) if new else {}
        for codes, gaps in found:
            for at, piece in gaps:
                codes[at] = learnt[piece]
        return [b"".join(codes) for codes, _ in found]


def shared_tokenizer(path: str) -> PieceTokenizer:
    """One tokenizer, with what it knows, per Python worker. It is kept with the module of the
    tokenizers, which lasts as long as the worker; this module may come with each task anew."""
    import tokenizers

    kept = vars(tokenizers).setdefault("_piece_tokenizers", {})
    if path not in kept:
        kept[path] = PieceTokenizer(path)
    return kept[path]


def tokenised_pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece of every document; row tells equal pieces apart."""
    send_with_tasks(__name__)

    def groups(texts: pa.Array) -> Iterator[list[bytes]]:
        """Texts of about ``TOKENISED_BYTES`` together."""
        group, size = [], 0
        for text in texts:
            group.append(text.as_buffer().to_pybytes())
            size += len(group[-1])
            if size >= TOKENISED_BYTES:
                yield group
                group, size = [], 0
        yield group

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = shared_tokenizer(tokenizer), struct.pack("<I", END_ID)
        for batch in batches:
            rows = []
            texts = itertools.chain.from_iterable(words.ids(group) for group in groups(batch.column("text")))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole(F.col("text")).cast("binary").alias("text"))
    pieces = rows.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    return materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "packing-pieces")


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, best-fit decreasing: the largest item left goes into
    the bin with the least rest that holds it."""
    bins = np.empty(len(sizes), np.int64)
    offsets = np.empty(len(sizes), np.int64)
    by_rest: list[list[int]] = [[] for _ in range(length + 1)]
    open_rests = 0
    n = 0
    for at in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[at])
        fitting = open_rests >> size
        if fitting:
            rest = size + (fitting & -fitting).bit_length() - 1
            bin_ = by_rest[rest].pop()
            if not by_rest[rest]:
                open_rests ^= 1 << rest
        else:
            rest, bin_ = length, n
            n += 1
        bins[at], offsets[at] = bin_, length - rest
        rest -= size
        by_rest[rest].append(bin_)
        open_rests |= 1 << rest
    return bins, offsets


def _fitter(level: int, length: int):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "item"], ascending=[False, True], ignore_index=True)
        sizes = group["size"].to_numpy()
        bins, offsets = best_fit(sizes, length)
        fill = np.bincount(bins, weights=sizes).astype(np.int64)
        name = ((level + 1) << 56) | (int(group["part"].iloc[0]) << 28)
        return pd.DataFrame({"item": group["item"], "bin": name | bins, "offset": offsets, "fill": fill[bins]})

    return fit


def packed(pieces: DataFrame, length: int = LENGTH, group_items: int = GROUP_ITEMS, slack: int = SLACK) -> DataFrame:
    """``pieces`` (row, unique, and length, 1 to ``length``, among others) with sequence_id and offset.

    No sequence is longer than ``length`` and offsets leave no gaps.
    """
    send_with_tasks(__name__)
    full = pieces.where(F.col("length") == length)
    items = pieces.where(F.col("length") < length).select(F.col("row").alias("item"), F.col("length").alias("size"))
    count = items.count()
    done, links = [], []
    for level in itertools.count():
        groups = max(1, -(-count // group_items))

        parts = items.withColumn("part", F.pmod(F.xxhash64("item", F.lit(level)), F.lit(groups)))
        fitted = materialize(
            parts.groupBy("part").applyInPandas(_fitter(level, length), "item bigint, bin bigint, offset bigint, fill bigint"),
            f"packing-round-{level}")
        links.append(fitted.select("item", "bin", "offset"))
        # Each bin has one item at its start, which stands for it.
        bins = fitted.where("offset = 0").select(F.col("bin").alias("item"), F.col("fill").alias("size"))
        smallest = bins.agg(F.min("size")).first()[0]
        if groups == 1 or smallest is None:
            break
        rest = length - F.col("size")
        items = bins.where((rest > slack) & (rest >= smallest))
        left = items.count()
        if left > count * 0.999:
            break
        count = left
    place = links[0].select(F.col("item").alias("row"), "bin", "offset")
    for link in links[1:]:
        above = link.select(F.col("item").alias("bin"), F.col("bin").alias("_bin"), F.col("offset").alias("_offset"))
        place = place.join(above, "bin", "left").select(
            "row", F.coalesce("_bin", "bin").alias("bin"),
            (F.col("offset") + F.coalesce("_offset", F.lit(0))).alias("offset"))
    place = place.withColumnRenamed("bin", "sequence_id")
    whole_ones = full.withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")})
    return pieces.where(F.col("length") < length).join(place, "row").unionByName(whole_ones)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A document's ids are those of its whole text and the end id; a null text is empty
    and still has the end id. Null and repeated ids are documents of their own. No
    documents give no rows; other columns are not read. A sequence id tells the round
    and group that made it; a full piece is a sequence by itself.
    """
    return packed(tokenised_pieces(docs, tokenizer, length), length).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
