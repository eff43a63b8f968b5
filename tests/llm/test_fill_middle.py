"""Fill-in-the-middle against a version that works on whole strings."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest

from anemos.llm import fill_middle
from anemos.llm.fill_middle import Rates

SCHEMA = "doc_id long, text string, n long, form string, output string"
ROWS = [
    (1, "a\nb\nc\nd\n"), (2, None), (3, ""), (4, "\n"), (5, "\n\n\nä\n€\n"), (6, "one line"), (7, "has <P> in it\nand more"),
    (8, "x" * 200_000), (9, "\n".join(f"line {i} é" for i in range(40_000))), (10, "y" * 70_000 + "\n" + "z" * 70_000 + "\ntail"),
    (None, "null\nid\n"), (None, None), (11, "same\nrow\n"), (11, "same\nrow\n"), (11, "other\ntext\n"), (-3, "<S\n>\n<M\n"),
]


def expected(doc_id, text, rates):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{rates.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rates.transformed:
        return doc_id, n, "plain", None, None, text
    pre, mid, suf = ("".join(lines[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h4 % 100 < rates.spm:
        return doc_id, n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*row, 5, "clash", "clash") for row in ROWS + [(i, f"{i}\n" * (i % 7)) for i in range(100, 160)]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.mark.parametrize("rates", [Rates(), Rates(seed=3, transformed=60, spm=20)])
def test_digests_and_texts(docs, rates):
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    want = Counter((*(e := expected(*row, rates))[:5], sha(e[5]), sha(row[1] or "")) for row in rows)
    assert Counter(map(tuple, fill_middle.document_digests(docs, rates).collect())) == want
    assert Counter(map(tuple, fill_middle.transformed_documents(docs, rates).collect())) == Counter(expected(*row, rates) for row in rows)
    assert Counter(map(tuple, fill_middle.restored_documents(docs, rates).collect())) == Counter(
        (*expected(*row, rates)[:5], row[1] or "") for row in rows)


def test_restore_from_output_and_form(docs):
    for row in ROWS:
        made = expected(*row, Rates())
        assert fill_middle.restore(made[5], made[2]) == (row[1] or "")


def test_pieces_hold_whole_lines_and_stay_small():
    text = ROWS[8][1].encode()
    _, pieces = fill_middle.output_pieces(9, text, Rates())
    pieces = [piece for piece in pieces if piece not in fill_middle.PARTS]
    assert max(map(len, pieces)) <= fill_middle.CHUNK
    assert all(piece.endswith(b"\n") or text.endswith(piece) for piece in pieces)


def test_one_row_many_times(spark):
    docs = spark.createDataFrame([(1, "a\nb\n")] * 500, "doc_id long, text string")
    assert fill_middle.document_digests(docs).groupBy("doc_id", "form").count().collect()[0]["count"] == 500


def test_one_shuffle(docs):
    stream = fill_middle.output_stream(docs)
    assert fill_middle.restored_stream(stream).partitioner == stream.partitioner


def test_empty(docs):
    assert fill_middle.document_digests(docs.limit(0)).collect() == []
