"""Benchmark decontamination by template windows, in DataFrame functions only.

A text becomes a sequence of tokens: names (capitalised words that do not begin a sentence,
several in a row as one), numbers, units behind a number, and words. Names, numbers and
units are slots, which their type stands for in the template; other words are themselves,
in lower case; in scripts without spaces each letter is a word. Punctuation is dropped. A window
is ``TEMPLATE`` consecutive tokens, or all of an item that has fewer: documents have windows of each
width that some item needs. Of an item count the windows with at least ``LITERALS`` words, or all
where these do not cover it; a window of slots alone, or an item of fewer than ``TEMPLATE``
tokens and ``LITERALS`` words, must also have equal values, as its template is met anywhere.
Windows of documents meet equal windows of benchmark items in a hash join.

Matches are gathered by document, item and distance of their positions, so that each run
of matches is one reading of the item. It is consistent if each slot value of the item
always stands for one value of the document, and the other way round: a question with other
numbers or names passes, a chance match of templates does not. A document is
contaminated by an item if its consistent matches cover ``SHARE`` of the item's windows.

The benchmark is broadcast only after a count of its windows. Null texts have no tokens;
items or documents without windows match nothing, and so do documents without an id; items
without one are told apart by their texts. Rows with equal ids count as one document (or
item). Pairs are returned once, in no order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from riskflow.llm.common import small, table
from riskflow.sources.tables import written

TEMPLATE = 5
LITERALS = 3
SHARE = 0.5

#: Units, as they follow a number.
UNITS = (
    "mm cm dm m km in ft yd mi mg g kg t lb oz ml cl dl l s sec min h hr hours minutes seconds days weeks years "
    "km/h mph m/s hz khz mhz w kw v a j kj cal kcal pa kpa bar k c f eur usd euros dollars cents percent degrees "
    "meters metres miles inches feet yards grams kilograms pounds ounces liters litres"
).split()

# Marks around slots: \x01 number, \x02 name, \x03 unit, each up to \x04. The repeated groups are
# possessive: Java matches those in a loop, and all others by recursion, which ends the task on a
# text with thousands of names or numbers in a row. Nothing follows them, so they match the same.
NUMBER = r"([0-9]+(?:[.,:/][0-9]+)*+)"
NAME = r"([\p{L}0-9,;:)\x04] )(\p{Lu}\p{Ll}+(?: \p{Lu}\p{Ll}+)*+)"
UNIT = "(\\x01[^\\x04]*\\x04 ?)(" + "|".join(sorted((u.replace("/", "\\/") for u in UNITS), key=lambda u: (-len(u), u))) + r"|%|°|€|\$)([^\p{L}0-9]|$)"
#: Letters of scripts that put no spaces between words: each is a word.
UNSPACED = "".join(rf"\p{{Is{name}}}" for name in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
TOKEN = rf"[\x01-\x03][^\x04]*\x04|[\p{{L}}&&[{UNSPACED}]]|[\p{{L}}&&[^{UNSPACED}]]+"


def marked(text: Column) -> Column:
    """A text in lower case in which slots are marked."""
    plain = F.regexp_replace(text, r"[\x01-\x04]", " ")
    named = F.regexp_replace(plain, F.lit(NAME), F.lit("$1\x02$2\x04"))
    numbered = F.regexp_replace(named, F.lit(NUMBER), F.lit("\x01$1\x04"))
    return F.lower(F.regexp_replace(numbered, F.lit(UNIT), F.lit("$1\x03$2\x04$3")))


def cut(rows: DataFrame, *keys: Column) -> DataFrame:
    """``keys`` and the array ``tokens`` of every row that has a text."""
    return rows.where(F.col("text").isNotNull()).select(
        *keys, F.regexp_extract_all(marked(F.col("text")), F.lit(TOKEN), F.lit(0)).alias("tokens"),
    )


def windows(tokens: DataFrame, key: str, width: int = TEMPLATE, narrow: tuple[int, ...] = ()) -> DataFrame:
    """``key, at, window, words, slots`` of every window: its place, the hash of its template,
    the number of its tokens and the values of its slots in a row, each up to ``\\x04``.
    Windows of ``narrow`` widths come besides those of ``width``."""
    # The tokens beside themselves, each time from one further on: a row per window without
    # a lambda, so that all that follows is generated code and slots are joined where asked for.
    # The outer form, as Spark puts a filter with a copy of all patterns below the other one.
    last = F.greatest(F.size("tokens") - (min(narrow, default=width) - 1), F.lit(1))
    places = [f"t{k}" for k in range(1, width + 1)]
    shifted = F.arrays_zip(*[F.slice("tokens", k, last).alias(name) for k, name in enumerate(places, 1)])
    parts = [F.col("w")[name] for name in places]
    slot = [t < "\x04" for t in parts]

    def of(wide: int) -> list[Column]:
        some = list(zip(slot[:wide], parts[:wide]))
        return [
            F.xxhash64(*[F.when(s, F.substring(t, 1, 1)).otherwise(t) for s, t in some]).alias("window"),
            sum((t.isNotNull().cast("int") for _, t in some), F.lit(0)).alias("words"),
            F.concat_ws("", *[F.when(s, t) for s, t in some]).alias("slots"),
        ]

    placed = tokens.select(key, F.posexplode_outer(shifted).alias("at", "w")).where(F.col("w").isNotNull())
    at = (F.col("at") + 1).alias("at")
    if not narrow:
        return placed.select(key, at, *of(width))
    # Behind the last whole window there are begun ones: they count for the narrow widths.
    forms = [F.when(parts[-1].isNotNull() | (F.col("at") == 0), F.struct(*of(width)))]
    forms += [F.when(parts[n - 1].isNotNull(), F.struct(*of(n))) for n in narrow]
    return placed.select(key, at, F.explode(F.array(*forms)).alias("f")).where(F.col("f").isNotNull()).select(key, "at", "f.*")


def item_windows(benchmark: DataFrame, literals: int = LITERALS) -> DataFrame:
    """Windows of the benchmark: of each item those with enough words that are not slots, or all
    where these leave a token of the item out. ``item`` is the id, or the text if there is none.
    ``exact`` tells windows whose template says too little to stand for other values."""
    item_id = F.col("item_id").cast("long")
    tokens = cut(benchmark, F.struct(
        item_id.alias("item_id"), F.when(item_id.isNull(), F.xxhash64("text")).alias("text")
    ).alias("item"))
    sizes = tokens.groupBy("item").agg(F.max(F.size("tokens")).alias("tokens"))
    plain = F.col("words") - (F.size(F.split("slots", "\x04")) - 1)
    each = windows(tokens, "item").withColumn("rich", plain >= F.least(F.lit(literals), F.col("words"))).withColumn(
        "exact", (plain == 0) | ((F.col("words") < TEMPLATE) & (plain < literals))
    )
    covered = each.where("rich").select("item", F.explode(F.sequence("at", F.col("at") + F.col("words") - 1)).alias("place")).groupBy(
        "item"
    ).agg(F.countDistinct("place").alias("covered"))
    return each.join(sizes.join(covered, "item", "left"), "item").where(
        F.col("rich") | (F.coalesce("covered", F.lit(0)) < F.col("tokens"))
    ).select(
        "item", F.col("at").alias("item_at"), "window", F.col("words").alias("item_words"),
        F.col("slots").alias("item_slots"), "exact",
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = SHARE) -> DataFrame:
    """``doc_id, item_id, matched, item_windows`` of the pairs in which the document holds the item."""
    items = written(item_windows(benchmark), "item-windows")
    narrow = tuple(sorted(r[0] for r in items.where(F.col("item_words") < TEMPLATE).select("item_words").distinct().collect()))
    total = items.groupBy("item").agg(F.countDistinct("window").alias("item_windows"))
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    cuts = cut(docs.where(F.col("doc_id").isNotNull()), doc_id)
    met = windows(cuts, "doc_id", narrow=narrow).drop("words").join(small(items.drop("item_words")), "window")
    run = (F.col("at") - F.col("item_at")).alias("distance")
    pairs = F.transform(
        F.arrays_zip(F.split("item_slots", "\x04").alias("a"), F.split("slots", "\x04").alias("b")),
        lambda p: F.struct(p["a"].alias("a"), p["b"].alias("b")),
    )
    same = ~F.col("exact") | (F.col("item_slots") == F.col("slots"))
    runs = met.where(same).select("doc_id", "item", run, "window", pairs.alias("pairs")).groupBy("doc_id", "item", "distance").agg(
        F.collect_set("window").alias("found"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    one_to_one = (F.size("pairs") == F.size(F.array_distinct(F.col("pairs.a")))) & (
        F.size("pairs") == F.size(F.array_distinct(F.col("pairs.b")))
    )
    covered = runs.where(one_to_one).groupBy("doc_id", "item").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).cast("long").alias("matched")
    )
    return covered.join(total, "item").where(F.col("matched") >= share * F.col("item_windows")).select(
        "doc_id", F.col("item.item_id").alias("item_id"), "matched", "item_windows"
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns kept."""
    bad = contaminated(docs, benchmark).select(F.col("doc_id").alias("bad")).distinct()
    # The row stays a struct of its own, so its columns may have any names.
    whole = docs.select(F.struct("*").alias("row"))
    return whole.join(bad, F.col("row.doc_id").cast("long") == F.col("bad"), "left_anti").select("row.*")


def op2_template_contamination(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
