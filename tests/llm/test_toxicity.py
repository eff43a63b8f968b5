"""The clause grammar against plain rules, and what is learnt against held-out labels."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest

from anemos.llm import toxicity
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, score double, toxic string, likeness string"


def plainly(tags):
    """The kind of each insult and threat by rules that look at the whole clause."""
    found = []
    for at, tag in enumerate(tags):
        if tag not in "IH":
            continue
        before = tags[:at]
        if "R" in before:
            found.append("4")
        elif "N" in before[-toxicity.SCOPE:]:
            found.append("3")
        elif "Y" in tags[max(0, at - toxicity.REACH):at + toxicity.REACH + 1]:
            found.append("1" if tag == "I" else "2")
        else:
            found.append("0" if tag == "I" else "-")
    return found


def kinds_of(grammar, tags):
    return [kind for kind, tag in zip(grammar.read(tags), tags) if tag in "IH"]


def test_readings_of_clauses():
    grammar = toxicity.Grammar()
    assert kinds_of(grammar, "ooIo") == ["0"]
    assert kinds_of(grammar, "YoI") == ["1"]
    assert kinds_of(grammar, "IooY") == ["1"]
    assert kinds_of(grammar, "IoooY") == ["0"]
    assert kinds_of(grammar, "oHY") == ["2"]
    assert kinds_of(grammar, "oHo") == ["-"]
    assert kinds_of(grammar, "NoI") == ["3"]
    assert kinds_of(grammar, "YRoYoI") == ["4"]
    rng = random.Random(3)
    for _ in range(3000):
        tags = "".join(rng.choices(toxicity.TAGS, [6, 2, 1, 1, 0.5, 0.3], k=rng.randrange(1, 14)))
        assert kinds_of(grammar, tags) == plainly(tags), tags


def test_composition_is_one_after_the_other():
    """All outputs of two transducers in a row, by trying every path."""
    def outputs(machine, symbols):
        paths = {(machine.start, "")}
        for symbol in symbols:
            paths = {(to, out + given) for state, out in paths for given, _, to in machine.arcs[state, symbol]}
        return {out for state, out in paths if state in machine.final}

    first, second = toxicity.negation(), toxicity.aimed("I", "T", "I")
    both = toxicity.compose(first, second)
    for size in range(1, 5):
        for tags in itertools.product("oIYN", repeat=size):
            assert outputs(both, tags) == {out for middle in outputs(first, tags) for out in outputs(second, middle)}


def test_long_runs_of_other_words_do_not_matter():
    grammar, rng = toxicity.Grammar(), random.Random(4)
    for _ in range(500):
        tags = "".join(rng.choice("IHYNR") + "o" * rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 30]) for _ in range(6))
        codes = np.array([toxicity.TAGS.index(tag) for tag in tags])
        short = "".join(np.array(list(tags))[toxicity._telling(codes)])
        assert kinds_of(grammar, tags) == kinds_of(grammar, short)


def test_words_of_a_text():
    lexicon = toxicity.Lexicon({"fool": 3.0, "knav~": 2.0})
    sums, n = toxicity.readings('You FOOL!! A knavery### ends.\nThey said: fool, not a fool\nhe said a fool "knav" ...', lexicon, toxicity.Grammar())
    assert n == 16
    assert dict(zip(toxicity.KINDS, sums)) == {"aimed": 3.0, "bare": 5.0, "negated": 3.0, "reported": 3.0, "threat": 0.0}


def fixture(n=600):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(2, 5))) for _ in range(400)]
    insults, rows, labels = ["grubwit", "snarkoad", "bleeter", "dungheap"], [], []
    for doc_id in range(n):
        text = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", ".", "\n"]) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.2
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice([*insults, "zork" + rng.choice(vocabulary)]))
        rows.append((doc_id, " ".join(text)))
        labels.append((doc_id, int(toxic)))
    # One toxic text many times over, with one word changed, must not make its words insults.
    copied = next(text for (_, text), (_, toxic) in zip(rows, labels) if toxic)
    for doc_id in range(n, n + 60):
        rows.append((doc_id, f"{copied} {rng.choice(vocabulary)}"))
        labels.append((doc_id, 1))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame([(*row, "en", "s", 9.0, "x", "y") for row in rows], SCHEMA).repartition(4).cache()
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int").cache()


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    found = {row["doc_id"]: row for row in toxicity.toxic_documents(docs, labels).collect()}
    truth = {row["doc_id"]: row["toxic"] for row in labels.collect()}
    assert all(found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in truth)
    held = [i for i in truth if found[i]["held_out"]]
    assert sum(found[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= row["score"] <= 1 and row["predicted"] == (row["score"] >= 0.5) for row in found.values())


def test_words_of_copies_are_not_insults(tables):
    docs, labels = tables
    weights = toxicity.fit(docs, labels).weights
    assert {"grubwit", "snarkoad", "bleeter", "dungheap"} <= set(weights)
    assert any(name.startswith("zork") for name in weights)
    assert len([name for name in weights if not name.startswith(("grub", "snar", "blee", "dung", "zork"))]) <= 2


def test_only_the_text_and_allowed_labels_count(spark, tables):
    docs, labels = tables
    lied = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")).cast("int"))
    moved = docs.withColumn("lang", F.lit("de")).withColumn("source", F.lit(None).cast("string"))
    first = {row["doc_id"]: row["score"] for row in toxicity.toxic_documents(docs, labels).collect()}
    again = {row["doc_id"]: row["score"] for row in toxicity.toxic_documents(moved, lied).collect()}
    assert first == again
    model = toxicity.fit(docs, labels)
    renamed = docs.withColumn("doc_id", -F.col("doc_id") - 7)
    assert {-row["doc_id"] - 7: row["score"] for row in toxicity.score_documents(renamed, model).collect()} == first


def test_edges(spark, tables):
    docs, labels = tables
    more = spark.createDataFrame(
        [(None, None), (None, "grubwit bleeter"), (5000, ""), (5000, " \n\t"), (5001, "dungheap. " * 50_000), (5001, "dungheap. " * 50_000)],
        "doc_id long, text string")
    found = toxicity.toxic_documents(docs.select("doc_id", "text").unionByName(more), labels.unionByName(
        spark.createDataFrame([(None, 1), (3, None), (4, 1), (4, 0)], "doc_id long, toxic int")))
    rows = [row for row in found.collect() if row["doc_id"] is None or row["doc_id"] >= 5000]
    assert len(rows) == 6
    empty = {row["score"] for row in rows if row["doc_id"] == 5000}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert all(row["predicted"] == 1 for row in rows if row["doc_id"] == 5001)
    assert toxicity.toxic_documents(docs.limit(0), labels).collect() == []
    alike = toxicity.toxic_documents(docs, labels.limit(0)).select("score").distinct().collect()
    assert [row["score"] for row in alike] == [0.5]
