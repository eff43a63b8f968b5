"""Operators against brute force on small fixtures that hold nulls, empty and long texts,
ties, repeated rows, copies and columns whose names clash with those used inside."""

from __future__ import annotations

import hashlib
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from anemos.llm import (
    chat, components, exact_dedup, mixing, packing, quality_classifier, quality_rules, sharding, simhash, suffix_dedup, warc,
)
from anemos.llm.queries import CONTROL_TURNS, tokenizer_path
from pyspark.sql import functions as F

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "row long, digest string, salt int, keep_id long, kept string, size string, at string, fp string, body string, a string")
CLASH = (1, "x", 2, 3, "y", "s", "z", "f", "b", "c")
SPACE = " \t\n\x0b\x0c\r"


def _words(text):
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def _fixture():
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7))) for _ in range(120)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, rows = prose(40), []
    for doc_id in range(1, 90):
        text = prose(rng.randrange(5, 120))
        if doc_id % 7 == 0:
            text = text[:50] + " " + passage + text[50:]
        if doc_id % 11 == 0:
            text = rows[3][1]
        if doc_id % 13 == 0:
            text = rows[3][1].replace(" ", "\n\t")
        if doc_id % 17 == 0:
            text = rows[5][1] + " tail"
        rows.append((doc_id, text, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s2", "s2", None]), len(text)))
    rows += [
        (100, None, None, None, None), (101, "", "en", "s1", 0), (102, " \n\t ", "en", "s1", 4), (103, "one", None, "s3", 3),
        (104, prose(9000), "en", "s2", 1), (105, "ab " * 400, "en", "s2", 1), (106, "# | $ " * 50, "en", "s2", 1),
        (107, "same line\n" * 9, "en", "s2", 1), (None, "null id", "en", "s2", 1), (None, prose(60), "en", "s2", 1),
    ]
    rows.append(rows[2])
    rows.append(rows[2])
    return rows


ROWS = _fixture()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([row + CLASH for row in ROWS], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def unique(docs):
    return docs.where("doc_id is not null").dropDuplicates(["doc_id"])


def _spaced(text):
    import re

    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda body: F.unhex(F.substring(F.sha2(body, 256), 1, 2))])
def test_exact_groups(docs, digest):
    """Also with digests of one byte, which stand for many texts."""
    groups = {}
    for row in ROWS:
        groups.setdefault(_spaced(row[1]), []).append(row[0])
    want = Counter()
    for row in ROWS:
        ids = groups[_spaced(row[1])]
        keep = min((i for i in ids if i is not None), default=None)
        want[(row[0], keep, len(ids), row[0] == keep)] += 1
    got = Counter(tuple(r)[:4] for r in exact_dedup.duplicate_groups(docs, digest=digest).collect())
    assert got == want


def test_exact_drop(docs):
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert {r["text"] for r in kept.select("text").distinct().collect()} <= {row[1] for row in ROWS}
    ids = [r["doc_id"] for r in kept.collect()]
    assert 11 not in ids and 13 not in ids and 4 in ids and None in ids


# Two texts under one id, copies under null ids, repeated rows.
TANGLED = [(3, "B text of five words"), (5, "A other words stand here"), (5, "B text of five words"), (None, "x"), (None, "B text of five words"),
           (None, "y"), (5, "A other words stand here"), (7, "A other words stand here"), (None, "x")]


def test_drops_go_by_row_not_by_id(spark):
    """Of equal texts the row with the smallest id stays, whatever else bears that id."""
    docs = spark.createDataFrame([row + (1, "z") for row in TANGLED], "doc_id long, text string, _kept_id long, digest string")
    groups = {}
    for doc_id, text in TANGLED:
        groups.setdefault(text, []).append(doc_id)
    keep = {text: min((i for i in ids if i is not None), default=None) for text, ids in groups.items()}
    want = Counter(row for row in TANGLED if row[0] == keep[row[1]])
    assert Counter((r["doc_id"], r["text"]) for r in exact_dedup.drop_duplicates(docs).collect()) == want
    assert want == Counter({(3, "B text of five words"): 1, (5, "A other words stand here"): 2, (None, "x"): 2, (None, "y"): 1})


def test_near_duplicates_go_by_row_not_by_id(spark):
    docs = spark.createDataFrame([row + (1, "z") for row in TANGLED], "doc_id long, text string, _kept_id long, fp string")
    codes = {text: _brute_fingerprint(text) for _, text in TANGLED}
    root = _brute_components(set(codes.values()))
    kept = simhash.drop_near_duplicates(docs).collect()
    assert kept[0].__fields__ == docs.columns
    found = Counter((r["doc_id"], r["text"]) for r in kept)
    for group in set(root.values()):
        members = [row for row in TANGLED if root[codes[row[1]]] == group]
        first = min(((i is None, i or 0) for i, _ in members))
        (stays,) = {row for row in found if root[codes[row[1]]] == group}
        assert (stays[0] is None, stays[0] or 0) == first and found[stays] == members.count(stays)


def test_unequal_parts(spark):
    """Where bits say the same, parts of equal information have unequal widths and far fewer candidates."""
    rng = random.Random(2)
    codes = set()
    while len(codes) < 3000:
        code = sum((0b1111 if rng.random() < 0.5 else 0) << at for at in range(0, 32, 4)) | rng.getrandbits(32) << 32
        codes.add(code ^ (1 << rng.randrange(64) if rng.random() < 0.2 else 0))
    fps = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long").cache()
    n, together = simhash.bit_statistics(fps)
    groups = simhash.grouped_bits(n, together, 4, even=False)
    assert sorted(bit for group in groups for bit in group) == list(range(64)) and len({len(group) for group in groups}) > 1
    even = [(0xFFFF << at, 0) for at in range(0, 64, 16)]
    assert 4 * simhash.candidates(fps, simhash.allocation(fps)) < simhash.candidates(fps, even)
    signed = {r["fp"] for r in fps.collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {tuple(r) for r in simhash.links(fps, 3).collect()} == want


def test_mix(docs):
    total = Counter()
    for row in ROWS:
        total[row[3]] += len(_words(row[1]))
    got = mixing.taken_words(docs, block=50).collect()
    assert len(got) == len(ROWS)
    by_source = Counter()
    size_of = {}
    for row in ROWS:
        size_of.setdefault(row[0], set()).add(len(_words(row[1])))
    for row in got:
        assert row["size"] in size_of[row["doc_id"]] and row["taken"] <= 3 * row["size"]
        by_source[(row["source_size"], row["target"])] += row["taken"]
    # Water filling by brute force: one unit more at a time cannot be split better.
    order = sorted(total, key=lambda s: (s is None, s or ""))
    weights = dict(zip(order, [1, 2, 3] * 3))
    low, high = 0.0, float(sum(total.values()))
    for _ in range(200):
        unit = (low + high) / 2
        low, high = (unit, high) if sum(min(3 * total[s], weights[s] * unit) for s in order) < sum(total.values()) else (low, unit)
    for source in order:
        target = min(3 * total[source], weights[source] * low)
        taken = [n for (size, t), n in by_source.items() if size == total[source] and abs(t - target) < 1e-3]
        # what its slots take: a few blocks more or less
        assert taken and abs(taken[0] - target) <= 3 * 50
    again = Counter(map(tuple, mixing.taken_words(docs.repartition(3), block=50).collect()))
    assert again == Counter(map(tuple, got))


def test_mixed_documents(docs):
    out = mixing.mixed_documents(docs, block=50)
    assert out.columns == docs.columns
    rows = out.collect()
    words = sum(len(_words(r["text"])) for r in rows)
    assert abs(words - sum(len(_words(row[1])) for row in ROWS)) <= 4 * 50
    # The sources take turns: no half of the mix is without one that has a tenth of all words.
    total = Counter()
    for r in rows:
        total[r["source"]] += len(_words(r["text"]))
    for half in (rows[:len(rows) // 2], rows[len(rows) // 2:]):
        assert {s for s, n in total.items() if n > words / 10} <= {r["source"] for r in half}


def test_the_schedule_decides_what_is_taken(docs, monkeypatch):
    """Other points give other slots, and so other words; the given ones stay near the targets whatever the block."""
    plain = Counter(map(tuple, mixing.taken_words(docs, block=50).collect()))
    monkeypatch.setattr(mixing, "STEP", 1)
    assert Counter(map(tuple, mixing.taken_words(docs, block=50).collect())) != plain
    monkeypatch.undo()
    for block in (None, 7, 200):
        by_source = Counter()
        for row in mixing.taken_words(docs, block=block).collect():
            by_source[row["source_size"], row["target"]] += row["taken"]
        assert all(abs(n - target) <= 3 * (block or 4) or n == 3 * size for (size, target), n in by_source.items())


def test_mix_is_the_blocks_of_its_slots(docs):
    """Slot by slot: each takes the next block of its source's shuffled row, which is read again at its end."""
    block = 30
    mixed, sized = mixing.mix(docs, block=block)
    size = {r["row"]: (r["source"], r["size"], r["source_size"]) for r in sized.collect()}
    slots = {}
    for r in mixed.collect():
        slots.setdefault(r["slot"], []).append(r)
    taken, given = Counter(), Counter()
    for slot in sorted(slots):
        sources = {size[r["row"]][0] for r in slots[slot]}
        assert len(sources) == 1
        (source,) = sources
        words = sum(r["n"] for r in slots[slot])
        left = 3 * size[slots[slot][0]["row"]][2] - given[source]
        assert words == min(block, left) or source not in taken and words < block
        given[source] += words
        taken[source] += 1
    for row, (_, words, _) in size.items():
        pieces = sorted((r["pass_"], r["first"], r["n"]) for found in slots.values() for r in found if r["row"] == row)
        at = {}
        for pass_, first, n in pieces:
            assert first == at.get(pass_, 0)
            at[pass_] = first + n
        assert sorted(at) == list(range(len(at))) and all(n == words for n in list(at.values())[:-1]) and all(n <= words for n in at.values())


def test_schedule_is_even(spark):
    sources = [{"source": s, "size": 1, "weight": 1, "target": t} for s, t in (("a", 5000.0), ("b", 3000.0), ("c", 2000.0))]
    slots = [r["at"] for r in mixing.schedule(spark, sources, 10).orderBy("slot").collect()]
    for end in (50, 100, 333, 1000):
        counts = Counter(slots[:end])
        assert all(abs(counts[at] - end * s["target"] / 10000) <= 4 for at, s in enumerate(sources))


def test_shards(docs):
    got = sharding.shard_documents(docs, 7).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text_crc32"], r["size"]) for r in got) == sorted(
        (row[0] is None, row[0], zlib.crc32((row[1] or "").encode()), len((row[1] or "").encode()) + 16) for row in ROWS)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    again = sharding.shard_documents(docs.repartition(2), 7).collect()
    key = lambda r: (r["doc_id"] or -1, r["text_crc32"], r["shard"], r["slot"])
    assert sorted(map(key, again)) == sorted(map(key, got))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1000, 4097])
def test_permutation(spark, n):
    got = [r[0] for r in spark.range(n).select(sharding.permuted(F.col("id"), n, seed=3)).collect()]
    assert sorted(got) == list(range(n))
    assert n < 100 or got != list(range(n))


def test_classifier_tells_chance_from_evidence():
    """Among 20,000 n-grams that have nothing to do with quality hardly any counts, and those that do all count."""
    rng = np.random.default_rng(5)
    n_raw, n_good, odd = 4000, 1000, 20
    raw, good = np.zeros((2, quality_classifier.N_FEATURES), np.int64)
    raw[:20_000] = rng.integers(1, n_raw, 20_000)
    good[:20_000] = rng.hypergeometric(n_good, n_raw - n_good, raw[:20_000])
    raw[:odd], good[:odd] = 400, 0
    raw[odd:2 * odd], good[odd:2 * odd] = 400, 300
    ratio = quality_classifier.log_ratios(raw, good, n_raw, n_good)
    assert ratio[:odd] == pytest.approx(np.log(0.5 / 100.5)) and ratio[odd:2 * odd] == pytest.approx(np.log(300.5 / 100.5))
    assert np.count_nonzero(ratio[2 * odd:]) <= 2


def test_classifier(spark, docs):
    rng = random.Random(5)
    good = ["calm", "river", "stone", "bread", "light", "paper", "north", "green"]
    rows, labels = [], []
    for doc_id in range(600):
        kind = doc_id % 3
        words = [rng.choice(good) for _ in range(40)]
        if kind == 1:
            words = [w + "%%%" for w in words]
        if kind == 2:
            for _ in range(4):
                words[rng.randrange(40)] = "moron"
        rows.append((doc_id, " ".join(words)))
        if doc_id % 2:
            labels.append((doc_id, int(kind != 1), int(kind == 2)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_classifier.select_documents(table, marks).collect()
    assert sum(r["kept"] for r in got if r["doc_id"] % 3 == 0) >= 195
    assert not any(r["kept"] for r in got if r["doc_id"] % 3)
    top = [r for r in quality_classifier.select_documents(table, marks, k=50).collect() if r["kept"]]
    assert len(top) == 50
    assert min(r["perturbed"] for r in top) >= sorted((r["perturbed"] for r in got), reverse=True)[49]
    unlabelled = quality_classifier.select_documents(docs, marks.where("false"))
    assert unlabelled.where("kept").count() == len(ROWS)
    assert quality_classifier.select_documents(docs, marks).count() == len(ROWS)


def test_classifier_with_few_labels(spark):
    """A word of 3 % of the documents counts with a hundred labels, and none that says nothing."""
    rng = random.Random(11)
    vocabulary = [f"w{n}" for n in range(300)]
    rows = []
    for doc_id in range(1500):
        words = [rng.choice(vocabulary) for _ in range(50)]
        for at in (5, 25) if doc_id % 33 == 0 else ():
            words[at] = "moron"
        rows.append((doc_id, " ".join(words)))
    marks = [(doc_id, 1, int(doc_id % 33 == 0)) for doc_id in range(1500) if doc_id % 4 == 0]
    got = quality_classifier.select_documents(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    unlabelled = [r for r in got if r["doc_id"] % 4]
    toxic = [r["kept"] for r in unlabelled if r["doc_id"] % 33 == 0]
    good = [r["kept"] for r in unlabelled if r["doc_id"] % 33]
    assert sum(toxic) <= 0.1 * len(toxic) and sum(good) >= 0.95 * len(good)


def test_classifier_leaves_the_fold_out():
    """A labelled document is weighed without its own fold; an unlabelled one by all."""
    counts = np.zeros((1 + 2 * quality_classifier.FOLDS, quality_classifier.N_FEATURES + 1), np.int64)
    counts[0, :5000], counts[0, :2], counts[0, -1] = 1, (40, 100), 1000
    counts[1:, -1] = [100] * quality_classifier.FOLDS + [80] * quality_classifier.FOLDS
    counts[1, 0] = 40
    counts[1:1 + quality_classifier.FOLDS, 1] = 8
    ratios = quality_classifier.fold_ratios(counts)
    assert ratios[0, 0] == 0 and (ratios[1:, 0] < 0).all() and (ratios[:, 1] < 0).all()
    labels = quality_classifier.Labels(np.array([9, 2]), np.array([5]))
    folds, good = labels.find(pa.array([2, None, 5, 7, 9]))
    assert folds.tolist() == [1, -1, 0, -1, 0] and good.tolist() == [True, False, False, False, True]


def _repeats(words):
    seen = {}
    for at in range(len(words) - 4):
        seen.setdefault(tuple(words[at:at + 5]), []).append(at)
    return len({p for found in seen.values() if len(found) > 1 for at in found for p in range(at, at + 5)})


def test_rules(docs):
    want = Counter()
    for row in ROWS:
        text, words = row[1] or "", _words(row[1])
        lines = [line for line in text.split("\n") if _words(line)]
        repeats = _repeats(words)
        want[(row[0], len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeats,
              len(words) < 10 or 100 * repeats > 20 * len(words))] += 1
    judged = quality_rules.apply_rules(docs, prior=5)
    got = judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    assert Counter(map(tuple, got)) == want
    verdict = {r["doc_id"]: r for r in judged.collect()}
    assert not verdict[106]["kept"] and not verdict[107]["kept"] and verdict[2]["kept"]
    assert all(not r["kept"] for r in verdict.values() if r["base_failed"])


def _fractions(row):
    return {name: row[part] / max(row[of], 1) for name, (part, of, _) in quality_rules.MEASURES.items()}


def _verdicts(rows, prior):
    """(limits, failed rule) of each measured row, by sorting whole groups."""
    def own(group):
        found = {}
        for name in quality_rules.MEASURES:
            values = sorted(_fractions(row)[name] for row in group)
            middle, upper = (values[max(int(np.ceil(p * len(values))) - 1, 0)] for p in (0.5, 0.8))
            found[name] = upper + 3 * (upper - middle)
        return found

    sound = [row for row in rows if row["n_words"]]
    overall = own(sound)
    for row in rows:
        limit = dict(overall)
        for same in ([r for r in sound if r["lang"] == row["lang"]],
                     [r for r in sound if (r["lang"], r["source"]) == (row["lang"], row["source"])]):
            if same:
                mine = own(same)
                limit = {name: (mine[name] * len(same) + limit[name] * prior) / (len(same) + prior) for name in limit}
        failed = None
        for name, (part, of, unit) in reversed(quality_rules.MEASURES.items()):
            expected, spread = limit[name] * row[of], 4 * limit[name] * row[of] ** 0.5
            if unit:
                spread = 4 * (expected / unit + 1) ** 0.5 * unit
            if row[part] > expected + spread:
                failed = name
        yield limit, failed


def test_rules_by_brute_force(docs):
    rows = quality_rules.apply_rules(docs, prior=7).collect()
    for row, (limit, failed) in zip(rows, _verdicts(rows, 7)):
        assert all(row[f"{name}_limit"] == pytest.approx(limit[name]) for name in limit)
        assert row["failed_rule"] == failed and row["kept"] == (failed is None and not row["base_failed"])


def test_limits_follow_the_source_and_every_rule_rejects(spark):
    """What is usual in one source is too much in another; no rule does nothing."""
    rng = random.Random(17)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 7))) for _ in range(300)]

    def text(n=120):
        return [rng.choice(vocabulary) for _ in range(n)]

    def joined(found):
        return "\n".join(" ".join(found[at:at + 8]) for at in range(0, len(found), 8))

    rows = []
    for n in range(300):
        words = text()
        rows.append((n, joined(words), "en", "plain"))
        for at in rng.sample(range(120), 15):
            words[at] = rng.choice("#*$%&|<>") + words[at]
        rows.append((1000 + n, joined(words), "en", "code"))
    signs = text()
    for at in range(0, 120, 3):
        signs[at] = "#" + signs[at]
    phrase = text(5)
    rare = text(400)
    for at in range(0, 39, 3):
        rare[at * 10:at * 10 + 5] = phrase
    cases = {
        2000: ("symbol_share", joined(signs)), 2001: ("dup_line_share", joined(text(400)) + "\nsame line here" * 12),
        2002: ("repeat_share", " ".join(rare)), 2003: ("shout_share", " ".join(text()[:60] + [w.upper() for w in text()[:60]])),
        2004: ("word_length", " ".join(w * 3 for w in text())),
    }
    rows += [(n, body, "en", "plain") for n, (_, body) in cases.items()] + [(3000, joined(signs), "en", "code")]
    judged = {r["doc_id"]: r for r in quality_rules.apply_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert judged[3]["symbol_share_limit"] < 0.6 * judged[1003]["symbol_share_limit"]
    for n, (rule, _) in cases.items():
        assert not judged[n]["base_failed"] and judged[n]["failed_rule"] == rule, (n, rule, judged[n])
    assert judged[3000]["kept"]
    assert sum(not judged[n]["kept"] for n in [*range(300), *range(1000, 1300)]) <= 6


def _brute_fingerprint(text):
    import xxhash

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = _words(lower)
    if not words:
        return 0
    shingles = [" ".join(words[at:at + 3]) for at in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _brute_components(codes):
    root = {c: c for c in codes}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for one in codes:
        for other in codes:
            if (one ^ other).bit_count() <= 3:
                root[find(one)] = find(other)
    return {c: find(c) for c in codes}


def test_simhash(docs):
    codes = [_brute_fingerprint(row[1]) for row in ROWS]
    root = _brute_components(set(codes))
    least = {}
    for row, code in zip(ROWS, codes):
        if row[0] is not None:
            least[root[code]] = min(least.get(root[code], 10**9), row[0])
    want = Counter((row[0], f"{code:016x}", least.get(root[code])) for row, code in zip(ROWS, codes))
    assert Counter(map(tuple, simhash.near_duplicates(docs).collect())) == want


@pytest.mark.parametrize("parts", [(2,), (3,), (4,), (1, 2, 5)])
def test_links_are_complete(spark, parts):
    rng = random.Random(11)
    codes = set()
    for _ in range(60):
        code = rng.getrandbits(64)
        for _ in range(6):
            codes.add(code)
            for _ in range(rng.randrange(0, 4)):
                code ^= 1 << rng.randrange(64)
    signed = {c - (1 << 64) if c >> 63 else c for c in codes}
    fps = spark.createDataFrame([(c,) for c in signed], "fp long").cache()
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {tuple(r) for r in simhash.links(fps, 3, parts).collect()} == want


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7), (200, 100), (50, 60)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and got[200] == got[101] == 100 and got[60] == got[50] == 50


def test_warc(spark, tmp_path):
    pages = [(i, f"http://a/{i}\r\nx y", "page " * 30 if i % 3 else f"own {i} " * 30) for i in range(30)]
    pages += [(40, None, None), (41, "u", ""), (42, "u", "short"), (43, "u", "short"), (None, "u", "page " * 30), (1, "u", "page " * 30),
              (44, "u", "long é " * 40_000)]
    table = spark.createDataFrame([p + ("x", 1) for p in pages], "page_id long, url string, html string, digest string, salt int")
    folder = f"file://{tmp_path}/w"
    records = warc.read_archives(warc.write_archives(table.repartition(3), folder), folder).collect()
    want = Counter()
    for page_id, _, html in pages:
        body = (html or "").encode()
        first = min((p[0] for p in pages if p[0] is not None and p[2] == html), default=None)
        again = len(body) >= 100 and page_id != first
        want[(page_id, "revisit" if again else "response", first if again else None, len(body), hashlib.sha256(body).hexdigest(),
              None if again else body)] += 1
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"],
                    None if r["payload"] is None else bytes(r["payload"])) for r in records) == want


def test_warc_reads_in_many_tasks(spark, tmp_path):
    table = spark.createDataFrame([(i, "u", f"page {i} " * 30) for i in range(400)], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    archives = warc.write_archives(table.repartition(20), folder)
    records = warc.read_archives(archives, folder, payloads=False)
    tasks = records.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(row["count"] for row in tasks) == 400
    assert len(tasks) > min(archives.count(), 8) / 2


def _packed(text):
    import gzip

    return gzip.compress(text)


def _read(data, **options):
    import io

    return list(warc.records(io.BytesIO(data), "here", **options))


def test_warc_verifies():
    import gzip

    data = warc.record_bytes(1, "http://a", b"x" * 200, hashlib.sha256(b"x" * 200).hexdigest(), None, False)
    text = gzip.decompress(data)
    (row,) = _read(data)
    assert row[4] == 200 and row[6] == b"x" * 200
    good = len(data)
    for wrong, error in (
        (_packed(text.replace(b"xxx", b"xyx", 1)), "digest"), (_packed(text[:-6] + text[-4:]), "frame"), (data[:-9], "cut off"),
        (_packed(text + b"more"), "frame"), (_packed(text.replace(b"Content-Length: 200", b"Content-Length: 201")), "digest|instead"),
        (_packed(b"GET / HTTP/1.1\r\n\r\n"), "not a WARC"), (_packed(b"WARC/1.1\r\nWARC-Type: response\r\n\r\n"), "Content-Length is missing"),
        (_packed(b"WARC/1.1\r\nno end"), "without end"), (_packed(b"WARC/1.1\r\nX: \xff\r\n\r\n"), "UTF-8"),
    ):
        with pytest.raises(ValueError, match=f"here at {good}: .*({error})"):
            _read(data + wrong)
    for at in range(0, len(data), 7):
        flipped = data[:at] + bytes([data[at] ^ 0x10]) + data[at + 1:]
        try:
            _read(data + flipped)
        except ValueError as wrong:
            assert str(wrong).startswith(f"here at {good}: ")
        else:
            assert 4 <= at < 10  # times and names in a gzip header change nothing


def test_warc_of_other_writers():
    """Records without HTTP, other digests, foreign ids, transfer codings, empty blocks."""
    import base64

    def record(kind, block, *head):
        lines = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:1234>", *head, b"Content-Length: %d" % len(block)]
        return _packed(b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n")

    def sha1(data):
        return b"sha1:" + base64.b32encode(hashlib.sha1(data).digest())

    body = b"<html>" + b"y" * 300_000
    plain = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\nContent-Length: 1\r\n\r\n5\r\nhello\r\n0\r\n\r\n"
    http = b"Content-Type: application/http; msgtype=response"
    data = b"".join([
        record(b"warcinfo", b"software: x\r\n", b"Content-Type: application/warc-fields", b"WARC-Block-Digest: " + sha1(b"software: x\r\n")),
        record(b"response", plain, http, b"WARC-Block-Digest: " + sha1(plain), b"WARC-Payload-Digest: " + sha1(body)),
        record(b"request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", b"Content-Type: application/http; msgtype=request"),
        record(b"response", chunked, http),
        record(b"resource", b"", b"Content-Type: text/plain"),
        record(b"metadata", b"a: b", b"WARC-Block-Digest: blake9:abc"),
        record(b"revisit", b"HTTP/1.1 200 OK\r\nContent-Length: 300006\r\n\r\n", http, b"WARC-Payload-Digest: " + sha1(body),
               b"WARC-Refers-To: <urn:uuid:77>"),
    ])
    rows = _read(data)
    assert [(r[1], r[4]) for r in rows] == [
        ("warcinfo", 13), ("response", len(body)), ("request", 0), ("response", 15), ("resource", 0), ("metadata", 4), ("revisit", 300_006)]
    assert rows[1][6] == body and rows[1][5] == hashlib.sha256(body).hexdigest() and rows[6][6] is None
    assert all(r[0] is None and r[7] == "<urn:uuid:1234>" for r in rows) and rows[6][8] == "<urn:uuid:77>"
    assert [r[:6] for r in _read(data, payloads=False)] == [r[:6] for r in rows]
    wrong = data.replace(b"", b"", 0) + record(b"response", plain, http, b"WARC-Payload-Digest: " + sha1(b"other"))
    with pytest.raises(ValueError, match=f"here at {len(data)}: payload digest"):
        _read(wrong)


def test_tokens_and_packing(docs):
    plain = Tokenizer.from_file(tokenizer_path())
    plain.encode_special_tokens = True
    pieces = packing.pack_documents(docs, tokenizer_path(), length=256).toPandas()
    want = Counter()
    for row in ROWS:
        ids = [*plain.encode(row[1] or "", add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            part = ids[at:at + 256]
            want[(row[0], piece, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes()))] += 1
    got = Counter((None if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in pieces.itertuples())
    assert got == want
    for _, group in pieces.sort_values("offset").groupby("sequence_id"):
        assert group["length"].sum() <= 256
        assert group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]


@pytest.mark.parametrize("text", ["Don't <|endoftext|> ÀÉß́ é 2024 a\x1cb\x85c", "中文 Σς İx 'll", "", " ", "###ab12!?"])
def test_piece_tokenizer(text):
    words = packing.PieceTokenizer(tokenizer_path())
    for texts in ([text.encode()], [text.encode(), b"Hello, world!"]):
        for ids, one in zip(words.ids(texts), texts):
            assert ids == np.asarray(words.tokenizer.encode(one.decode(), add_special_tokens=False).ids, "<u4").tobytes()


def test_piece_tokenizer_memory(monkeypatch):
    """What is remembered keeps to its bytes, few long pieces or many short ones; no more than a portion is tokenised at once."""
    monkeypatch.setattr(packing, "MEMO_BYTES", 1 << 18, raising=False)
    monkeypatch.setattr(packing, "LEARN_CHARS", 1 << 12, raising=False)
    words, rng, most = packing.PieceTokenizer(tokenizer_path()), random.Random(6), [0]
    plain = words.tokenizer

    class Watched:
        def encode(self, text, **options):
            most[0] = max(most[0], len(text))
            return plain.encode(text, **options)

        def encode_batch(self, texts, **options):
            most[0] = max(most[0], sum(map(len, texts)))
            return plain.encode_batch(texts, **options)

    words.tokenizer = Watched()
    short = [" ".join("".join(rng.choices("abcdeñ", k=8)) for _ in range(n)) for n in (1, 300, 2000, 9000, 2000)]
    long = ["".join(rng.choices("中文字书", k=3000)) for _ in range(30)]
    texts = [*short, short[1], *long, short[3], short[0], " ".join(long[:2]), "", "中" * 300_000]
    for group in ([texts[0]], texts[1:4], texts[3:9], *([text] for text in texts[9:])):
        for ids, text in zip(words.ids([text.encode() for text in group]), group):
            assert ids == np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert sum(sys.getsizeof(piece) + sys.getsizeof(ids) for piece, ids in words.known.items()) <= 1 << 18
        if len(group[0]) < 300_000:
            assert most[0] <= 1 << 13


def test_packing_rounds(spark):
    """Many groups and rounds: near the bound, and every item placed once."""
    rng = random.Random(3)
    rows = [(i, rng.randrange(1, 257)) for i in range(3000)]
    pieces = spark.createDataFrame(rows, "row long, length long")
    out = packing.packed(pieces, length=256, group_items=100).toPandas()
    assert sorted(out["row"]) == list(range(3000))
    fill = out.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 256 and len(fill) <= 1.06 * sum(n for _, n in rows) / 256 + 1
    for _, group in out.sort_values("offset").groupby("sequence_id"):
        assert group["offset"].tolist() == [0, *group["length"].cumsum().tolist()[:-1]]


def test_chat(spark):
    rng = random.Random(9)
    strings = [*chat.CONTROL, "<", "[", "\\", "\\\\", "/", "s>", "|im_end|>", "hello", " ", "\n", "é", "INST]"]
    turns = [row + ("c",) for row in CONTROL_TURNS]
    for conv in range(25):
        for turn in range(rng.randrange(1, 30)):
            role = "system" if turn == 0 and conv % 2 else rng.choice(["user", "assistant", "tool", None, "<|im_sep|>"])
            text = None if rng.random() < 0.1 else "".join(rng.choice(strings) for _ in range(rng.randrange(0, 60)))
            turns.append((conv, turn if turn % 5 else None, role, text, "c"))
    turns += [turns[5], (None, 1, "assistant", "no conversation", "c"), (None, None, None, None, "c")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, window string")
    windows = chat.format_conversations(table, span=60, history=30).cache()
    got = {r["conv_id"]: r for r in chat.conversation_digests(windows).collect()}
    want = {}
    for row in turns:
        want.setdefault(row[0], []).append(row)
    assert set(got) == set(want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, rows in want.items():
        said = {(r[1], r[2] or "", r[3] or "") for r in rows}
        read = [(t["role"], t["text"]) for w in chat.read_turns(windows.where(F.col("conv_id").eqNullSafe(F.lit(conv)))).orderBy("window").collect()
                for t in w["turns"]]
        assert Counter(read) == Counter((r[2] or "", r[3] or "") for r in rows) and said
        loss = "".join(text for role, text in read if role == "assistant")
        assert got[conv]["n_turns"] == len(rows)
        assert got[conv]["turns_sha256"] == sha("".join(f"{role}\n{text}\n" for role, text in read))
        assert (got[conv]["loss_chars"], got[conv]["loss_sha256"]) == (len(loss), sha(loss))
    for w in windows.collect():
        new = [p for p in w["text"].split(chat.END)[:-1]][w["n_context"]:]
        assert len(new) == 1 or sum(-(-(len(p) + len(chat.END)) // 4) for p in new) <= 60
        assert w["text"].count(chat.START) == w["n_context"] + w["n_turns"]
    assert windows.where("n_context > 0").count() > 10


def test_chat_counts_tokens(spark):
    """With a count of tokens, windows of digits and Chinese keep the span that the estimate overruns."""
    turns = [(1, turn, "user", text) for turn in range(40) for text in [("7" * 30, "中文" * 15, "plain words here", "a-b")[turn % 4]]]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    counts = table.select(chat.piece_tokens(F.col("text")).alias("n")).limit(4).collect()
    assert [r["n"] for r in counts] == [30, 30, 3, 3]

    def most(**options):
        windows = chat.format_conversations(table, span=120, history=0, **options)
        assert windows.agg(F.sum("n_turns")).first()[0] == 40
        return windows.agg(F.max(chat.piece_tokens(F.col("text")))).first()[0]

    assert most(tokens=chat.piece_tokens) <= 120 < most()


def _brute_repeats(rows, length):
    seen, out = set(), []
    for doc_id, text in rows:
        body, mark = (text or "").encode(), set()
        for at in range(len(body) - length + 1):
            window = body[at:at + length]
            if window in seen:
                mark.update(range(at, at + length))
            seen.add(window)
        kept = bytes(c for at, c in enumerate(body) if at not in mark)
        spans = sum(at - 1 not in mark for at in mark)
        out.append((doc_id, len(body), len(mark), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("options", [{}, {"group": 2}, {"bucket_bytes": 3000}])
def test_repeats(docs, unique, options):
    """Also with anchors over the bound of a group, and many buckets."""
    by_id = lambda row: (row[0] is None, row[0] or 0, (row[1] or "").encode())
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = sorted({row[0]: row[:2] for row in ROWS if row[0] is not None}.values())
    assert Counter(map(tuple, suffix_dedup.remove_repeats(unique, 100, **options).select(columns).collect())) == _brute_repeats(rows, 100)
    rows = [row[:2] for row in sorted(ROWS, key=by_id)]
    assert Counter(map(tuple, suffix_dedup.remove_repeats(docs, 100, **options).select(columns).collect())) == _brute_repeats(rows, 100)


def test_run_index():
    rng = random.Random(2)
    base = bytes(rng.choice(b"ab") for _ in range(400))
    texts = [base[rng.randrange(0, 250):][:rng.randrange(60, 150)] for _ in range(40)] + [b"a" * 150, b"ab" * 70]
    index = suffix_dedup.RunIndex(texts, 50)
    assert len(index.run_starts) < index.n / 2
    joined, want, seen, at = b"", [], set(), 0
    for text in texts:
        for start in range(len(text) - 49):
            window = text[start:start + 50]
            if window in seen:
                want.append(at + start)
            seen.add(window)
        at += len(text) + 1
    assert index.repeated().tolist() == want


@pytest.mark.parametrize("run", [
    lambda d: exact_dedup.duplicate_groups(d), lambda d: mixing.taken_words(d), lambda d: mixing.mixed_documents(d),
    lambda d: sharding.shard_documents(d), lambda d: quality_rules.apply_rules(d), lambda d: simhash.near_duplicates(d),
    lambda d: suffix_dedup.remove_repeats(d), lambda d: packing.pack_documents(d, tokenizer_path()),
    lambda d: quality_classifier.keep_good(d, d.selectExpr("doc_id", "1 as quality", "0 as toxic")),
    lambda d: chat.format_conversations(d.selectExpr("doc_id as conv_id", "doc_id as turn", "lang as role", "text")),
    lambda d: warc.round_trip(d.selectExpr("doc_id as page_id", "lang as url", "text as html")),
])
def test_empty_tables(empty, run):
    assert run(empty).collect() == []


def test_classifier_weights_by_brute_force(spark):
    """Log weights from counts and formulas written out n-gram by n-gram."""
    rng = random.Random(21)
    rows = [(n, " ".join(rng.choice(["tree", "stone", "Lake", "sky!", "moron", "x%%"][:4 + (n % 7 == 0) + (n % 5 == 0)]) for _ in range(30)))
            for n in range(120)]
    marks = [(n, int(n % 5 != 0), int(n % 7 == 0)) for n in range(0, 120, 2)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["log_weight"] for r in quality_classifier.select_documents(table, labels).collect()}
    hashed = {r["doc_id"]: r["h"] for r in table.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    is_good = {n: quality == 1 and not toxic for n, quality, toxic in marks}
    ordered = {kind: sorted((n for n in is_good if is_good[n] == kind), key=lambda n: (hashed[n], n)) for kind in (True, False)}
    fold = {n: at % quality_classifier.FOLDS for kind in ordered for at, n in enumerate(ordered[kind])}
    grams = {n: quality_classifier.features(text.encode(), quality_classifier.Words()).tolist() for n, text in rows}
    kinds = np.cumsum(quality_classifier.KINDS)

    def ratios(left_out):
        learnt = [n for n in is_good if fold[n] != left_out]
        raw = Counter(g for n in grams for g in grams[n])
        some = Counter(g for n in learnt for g in grams[n])
        fine = Counter(g for n in learnt if is_good[n] for g in grams[n])
        n_fine = sum(is_good[n] for n in learnt)

        def chance(counts):
            seen = Counter(int(np.searchsorted(kinds, g, "right")) for g in counts)
            return lambda g: 2 * np.log(max(seen[int(np.searchsorted(kinds, g, "right"))], 2))

        sure, labelled = chance(raw), chance(some)

        def ratio(g):
            expected = raw[g] * n_fine / len(rows)
            value = np.log((fine[g] + 0.5) / (expected + 0.5))
            if abs(fine[g] - expected) >= np.sqrt(sure(g)) * np.sqrt(expected + 1) and value:
                return value
            share, bad = n_fine / len(learnt), some[g] - fine[g]
            told = 2 * sum(x * np.log(x / e) for x, e in ((fine[g], some[g] * share), (bad, some[g] * (1 - share))) if x)
            return 0.0 if told < labelled(g) else value * (told / (told + labelled(g))) ** 2

        return {g: ratio(g) for g in raw}

    by_fold = {f: ratios(f) for f in range(-1, quality_classifier.FOLDS)}
    for n, found in grams.items():
        assert got[n] == pytest.approx(sum(by_fold[fold.get(n, -1)][g] for g in found), abs=1e-9)


def test_sample_size_and_top_k(spark):
    """The size comes from shares of good documents in ranges of weights; another seed draws other documents."""
    rows = [(n, float(n // 10), int(n >= 300)) for n in range(1000)]
    scored = spark.createDataFrame([(n, w) for n, w, _ in rows], "doc_id long, log_weight double")
    good = spark.createDataFrame([(n,) for n, _, g in rows if g and n % 4 == 0], "doc_id long")
    other = spark.createDataFrame([(n,) for n, _, g in rows if not g and n % 4 == 0], "doc_id long")
    assert abs(quality_classifier.sample_size(scored, good, other) - 0.99 * 700) <= 15
    assert quality_classifier.sample_size(scored, good, other.limit(0)) == 990
    table = spark.createDataFrame([(n, "one two three") for n in range(300)], "doc_id long, text string")
    marks = spark.createDataFrame([(n, 1, 0) for n in range(0, 300, 3)], "doc_id long, quality int, toxic int")
    drawn = [{r["doc_id"] for r in quality_classifier.select_documents(table, marks, k=100, seed=seed).where("kept").collect()} for seed in (0, 1)]
    assert len(drawn[0]) == len(drawn[1]) == 100 and drawn[0] != drawn[1]


def test_classifier_keeps_by_row(spark):
    """Two texts under one id, and null ids: each stays or goes by its own weight."""
    rng = random.Random(8)
    rows = []
    for n in range(400):
        words = [rng.choice(["calm", "river", "stone", "bread", "light"]) for _ in range(30)]
        rows.append((n, " ".join(words + (["moron"] * 3 if n % 4 == 0 else []))))
    rows += [(1, rows[0][1]), (None, rows[0][1]), (None, rows[1][1])]
    marks = spark.createDataFrame([(n, 1, int(n % 4 == 0)) for n in range(2, 400)], "doc_id long, quality int, toxic int")
    kept = Counter((r["doc_id"], r["text"]) for r in quality_classifier.keep_good(
        spark.createDataFrame(rows, "doc_id long, text string"), marks).collect())
    assert (1, rows[1][1]) in kept and (1, rows[0][1]) not in kept
    assert (None, rows[1][1]) in kept and (None, rows[0][1]) not in kept
