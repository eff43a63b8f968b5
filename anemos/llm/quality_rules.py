"""Quality rules whose limits are learnt from the corpus, per language and source.

The measures of every text are computed in one pass and written as a narrow table.
Mergeable quantile sketches (``percentile_approx``, combined in each task before the
shuffle) give the median and the upper fifth of each measure per (language, source),
per language and overall. The limit of a measure is the upper fifth plus three times its distance
from the median, so up to a fifth of a source may be junk without moving it. A group's limit is drawn
to that of its language, and this to the overall one, as if ``prior`` rows more had said so.
The limits are joined to the rows. There is no fixed slack: a text fails if what it counts is further above
the limit than chance brings in a text of its length (``CHANCE`` standard deviations, and one count at least),
so a stray character condemns no text, and a long text is held to the limit more closely than a short one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import let, whole, word_chars, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIDDLE, UPPER = 0.5, 0.8
SPREAD = 3.0
CHANCE = 4.0
PRIOR = 100
ACCURACY = 10_000
# Measures: what is counted, out of what, and how many counts come together (a repeat is two windows).
MEASURES = {
    "symbol_share": ("n_symbols", "word_chars", 1), "dup_line_share": ("n_dup_lines", "n_lines", 1),
    "repeat_share": ("n_repeat_words", "n_words", 2 * WINDOW), "shout_share": ("n_shouts", "word_chars", 1),
    "word_length": ("word_chars", "n_words", 0),
}


def _repeated_words(found: Column) -> Column:
    """Words that lie in a window of five words which the text has twice or more.

    Windows are told apart by 64 bits of hash, and by their words where hashes meet.
    """
    starts = F.sequence(F.lit(1), F.size(found) - (WINDOW - 1))
    windows = F.transform(
        starts, lambda at: F.struct(F.xxhash64(F.slice(found, at, WINDOW)).alias("w"), at.alias("at")))

    def places(ordered: Column) -> Column:
        def words_at(place: Column) -> Column:
            return F.slice(found, F.get(ordered, place)["at"], WINDOW)

        def same(one: Column, other: Column) -> Column:
            met = F.coalesce(F.get(ordered, one)["w"] == F.get(ordered, other)["w"], F.lit(False))
            return F.when(met, words_at(one) == words_at(other)).otherwise(False)

        hits = F.filter(
            F.transform(ordered, lambda row, at: F.when(same(at, at - 1) | same(at, at + 1), row["at"])),
            lambda at: at.isNotNull())
        return F.array_sort(hits)

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            at, start,
            lambda sum_, place: F.struct(
                (sum_["n"] + F.least(F.lit(WINDOW), place - sum_["last"])).alias("n"), place.alias("last")),
            lambda sum_: sum_["n"])

    def of(every: Column) -> Column:
        distinct = F.size(F.array_distinct(F.transform(every, lambda row: row["w"])))
        repeats = covered(let(F.sort_array(every), places))
        return F.when(distinct == F.size(every), F.lit(0).cast("long")).otherwise(repeats)

    return F.when(F.size(found) <= WINDOW, F.lit(0).cast("long")).otherwise(let(windows, of))


def _lines(text: Column) -> Column:
    return F.filter(F.split(whole(text), "\n", -1), lambda line: F.length(F.trim(F.translate(line, "\t\x0b\x0c\r", "    "))) > 0)


def text_measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts of each whole text and the shares made of them."""
    text = F.col("text")
    base = docs.select(
        "doc_id", "lang", "source", "text", words(text).alias("found"), _lines(text).alias("lines"),
    )
    counted = base.select(
        "doc_id", "lang", "source",
        F.size("found").cast("long").alias("n_words"),
        word_chars(text).alias("word_chars"),
        (F.length(whole(text)) - F.length(F.translate(whole(text), SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        let(F.col("found"), _repeated_words).alias("n_repeat_words"),
        F.length(F.regexp_replace(whole(text), "[^\\p{Lu}!]+", "")).cast("long").alias("n_shouts"),
    )

    return counted.withColumns({
        name: F.col(part) / F.greatest(F.col(of), F.lit(1)) for name, (part, of, _) in MEASURES.items()})


def limits(measured: DataFrame, keys: list[str], spread: float = SPREAD) -> DataFrame:
    """Per group: its size and the limit of each measure as its own rows have it, NULL keys being a group too."""
    sketches = measured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(name, [MIDDLE, UPPER], ACCURACY).alias(name) for name in MEASURES],
    )
    return sketches.select(
        *keys, "n",
        *[(F.col(name)[1] + F.lit(spread) * (F.col(name)[1] - F.col(name)[0])).alias(name) for name in MEASURES],
    )


def group_limits(measured: DataFrame, prior: int = PRIOR, spread: float = SPREAD) -> DataFrame:
    """lang, source and the limits of each group, drawn to those of its language and of all by ``prior`` rows.

    One row per language and source, from tables of that size; texts without words do not count.
    """
    sound = measured.where("n_words > 0")
    overall = limits(sound, [], spread).first()
    by_lang = limits(sound, ["lang"], spread).select(
        F.col("lang").alias("_lang"), F.col("n").alias("_lang_n"), *[F.col(name).alias(f"_lang_{name}") for name in MEASURES])

    def drawn(own: Column, n: Column, to: Column) -> Column:
        return (F.coalesce(own * n, F.lit(0.0)) + to * prior) / (F.coalesce(n, F.lit(0)) + prior)

    groups = measured.select("lang", "source").distinct().join(
        limits(sound, ["lang", "source"], spread).withColumnsRenamed({"lang": "_own_lang", "source": "_own_source"}),
        F.col("lang").eqNullSafe(F.col("_own_lang")) & F.col("source").eqNullSafe(F.col("_own_source")), "left")
    groups = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    return groups.select("lang", "source", *[
        drawn(F.col(name), F.col("n"), drawn(F.col(f"_lang_{name}"), F.col("_lang_n"), F.lit(float(overall[name] or 0)))).alias(f"{name}_limit")
        for name in MEASURES])


def above(name: str) -> Column:
    """Whether a text is further above the limit of a measure than chance brings."""
    part, of, unit = MEASURES[name]
    expected = F.col(f"{name}_limit") * F.col(of)
    if not unit:
        # A mean: words differ in length by about as much as they are long.
        return F.col(part) > expected + F.lit(CHANCE) * F.col(f"{name}_limit") * F.sqrt(F.col(of))
    return F.col(part) / unit > expected / unit + F.lit(CHANCE) * F.sqrt(expected / unit + 1)


def apply_rules(docs: DataFrame, prior: int = PRIOR, spread: float = SPREAD) -> DataFrame:
    """The measures of every document with the limits of its group, base_failed, kept and the rule that decided.

    ``base_failed``: fewer than ten words, or more than a fifth of the words lie in
    repeated windows. ``failed_rule`` names the first measure above its limit.

    Null texts are empty and so fail the base rules. Null languages and sources are
    groups of their own. Repeated rows and ids are judged one by one. No rows give no
    rows; other columns are not read.
    """
    measured = materialize(text_measures(docs), "quality-rules")
    table = group_limits(measured, prior, spread).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    rows = measured.join(table, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")))
    failed = F.coalesce(*[F.when(above(name), F.lit(name)) for name in MEASURES])
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.select(
        *measured.columns, *[f"{name}_limit" for name in MEASURES], base.alias("base_failed"), failed.alias("failed_rule"),
        (~base & failed.isNull()).alias("kept"),
    )
