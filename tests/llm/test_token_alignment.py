"""Token alignment against a plain version that works token by token."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from tokenizers import Tokenizer

from anemos.llm import token_alignment
from anemos.llm.queries import table, vocabularies

SCHEMA = "doc_id long, text string, copies long, salt int, digest string, row string, n string"


def texts():
    rng = random.Random(5)
    signs = "ab Zé€😀\n\t  '.,#09 ▁　中́\x00"
    words = ["the", "then", " the", "don't", "über", "ESTÁ", "2024", "</s>", "<|endoftext|>", "<s>", "<0x41>"]
    rows = [(1, None), (2, ""), (3, " "), (4, "one"), (5, "▁under"), (6, "<unk>"), (7, "x" * 3000), (8, " lead and trail "),
            (None, "the end"), (None, "the end"), (9, "the end"), (9, "the end"), (9, "another text")]
    for doc_id in range(20, 120):
        rows.append((doc_id, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))))
        rows.append((doc_id + 200, "".join(rng.choice(signs) for _ in range(rng.randrange(1, 60)))))
        rows.append((doc_id + 400, "the same passage in many documents"))
    return rows


@pytest.fixture(scope="module")
def plain():
    """(a tokens, b tokens) of a text, as (id, bytes) pairs, by the libraries' own ways."""
    files = vocabularies()
    first = Tokenizer.from_file(files.byte_level)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=files.pieces)
    letters = token_alignment.byte_level_bytes()

    def tokens(text):
        a = [(id_, bytes(letters[c] for c in first.id_to_token(id_))) for id_ in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(id_, token_alignment.piece_bytes(second.id_to_piece(id_))) for id_ in second.encode(text)]
        spelt = (" " + text).encode()
        return (a, b) if text and all(b"".join(x for _, x in side) == spelt for side in (a, b)) else ([], [])

    return tokens


def spans(tokens):
    at = 0
    for id_, data in tokens:
        yield id_, at, at + len(data)
        at += len(data)


def expected(rows, tokens):
    linked, shown = [], []
    for _, text in rows:
        a, b = (list(spans(side)) for side in tokens(text or ""))
        linked.append([(x, y) for x, s, e in a for y, t, f in b if s < f and t < e])
        cuts = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups = [([str(x) for x, s, e in a if low < e <= high], [str(y) for y, t, f in b if low < f <= high])
                  for low, high in zip([0, *cuts], cuts)]
        shown.append((len(a), len(b), groups))
    count = Counter(pair for pairs in linked for pair in set(pairs))
    highest = defaultdict(int)
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    for (doc_id, _), pairs, (n_a, n_b, groups) in zip(rows, linked, shown):
        said = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        yield (doc_id, n_a, n_b, len(groups), len(pairs), sum(count[p] == highest[p[0]] for p in pairs),
               sum(count[p] for p in pairs), hashlib.sha256(said.encode()).hexdigest() if groups else "")


@pytest.mark.parametrize("head", [token_alignment.HEAD, 40])
def test_by_hand(spark, plain, head):
    rows = texts()
    docs = spark.createDataFrame([(*row, 1, 2, "x", "y", "z") for row in rows], SCHEMA).repartition(4)
    found = token_alignment.document_alignments(docs, vocabularies(), head)
    assert Counter(map(tuple, found.collect())) == Counter(expected(rows, plain))


def test_given_table(spark, sf_dir, plain):
    docs = table(spark, sf_dir, "documents").where("length(text) < 3000")
    rows = [(row["doc_id"], row["text"]) for row in docs.collect()]
    found = token_alignment.document_alignments(docs, vocabularies())
    assert Counter(map(tuple, found.collect())) == Counter(expected(rows, plain))


def test_groups_are_given_out(spark):
    docs = spark.createDataFrame([(1, "the end"), (2, "the end")], "doc_id long, text string")
    row = token_alignment.aligned_texts(docs, vocabularies(), groups=True).collect()
    assert [(r["copies"], hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"]) for r in row] == [(2, True)]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_alignment.document_alignments(docs, vocabularies()).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, token_alignment.document_alignments(blank, vocabularies()).collect())) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
