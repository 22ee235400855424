"""Line dedup: maximal repeated runs of lines by prefix doubling, in DataFrame functions only.

The lines of all documents form one sequence per document. Prefix doubling gives every
position a name for the ``2**k`` lines that begin there: level 0 names a line by its
hash, level ``k + 1`` names two names of level ``k`` that follow each other. Only names with
two or more positions go on to the next level, so each round works on what still
repeats, and the rounds end at the longest repeat.

The names of all levels then give the longest-common-prefix intervals: an interval is the
set of positions that share their first ``length`` lines. From the widest level down, an
interval is split by the name of the next ``2**k`` lines. Positions that share that
name form an interval of their own, longer by ``2**k``; its first position (smallest
id, then line) also stays behind to stand for the others in shorter matches. So each position
ends in the interval of the longest run that begins there and earlier too: the
maximal repeated run. Intervals are told apart by hashes, not by rank: deletion needs
their lengths and first positions, not their order among each other.

A maximal repeated run of at least ``MIN_CHARS`` characters is deleted where it begins later.
What goes is thus every line that lies in some run of that size, of whatever length, that also
begins earlier. Lines that have ``MIN_CHARS`` alone are settled by level 0. A run that
deletes a shorter line has a part with that line which begins with two lines of which one is
short, so only such positions are followed through the intervals.

A document equal to an earlier one is found by the hash of its text before, and loses all its
lines if it has ``MIN_CHARS``. Documents without a deleted line are returned as they are;
``n_chars``, where there is such a column, is the length of the new text. A null text stays
null. Rows with the same id and text are one document and are treated alike; a null
id comes first. Lines, and runs of lines, are compared by 64-bit hashes. Names with more
than ``HOT`` positions take their first position from a broadcast of at most 10,000 rows and
are dealt by position, so a very common line is no group of one task. Other columns keep
their values, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import small, table
from riskflow.operators.skew import hottest
from riskflow.sources.tables import written

MIN_CHARS = 20
#: Positions of a name beyond which it may count as hot; ``skew.hottest`` bounds how many names do.
HOT = 1_000
_LOWEST = -(1 << 63)
_PLACE = ["d", "t", "i"]


def _key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    return [
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_LOWEST)).alias("d"),
        F.xxhash64(text).alias("t"),
    ]


def _with_first(places: DataFrame, name: str, hot: int) -> DataFrame:
    """``places`` with the ``first`` place of their name, null where no other place has that name."""
    several = written(
        places.where(F.col(name).isNotNull()).groupBy(name).agg(
            F.min(F.struct(_PLACE)).alias("first"), F.max(F.struct(_PLACE)).alias("last"), F.count(F.lit(1)).alias("places")
        ).where("first < last").select(name, "first", "places"), "line-names",
    )
    hotter = hottest(several, hot, "places").select(name, F.col("first").alias("hot_first"))
    by_place = F.col("hot_first").isNotNull() | F.col(name).isNull()
    return (
        places.join(F.broadcast(hotter), name, "left")
        .withColumn("route", F.when(by_place, F.xxhash64(*_PLACE, F.spark_partition_id())).otherwise(F.col(name)))
        .join(several.select(F.col(name).alias("route"), F.col("first").alias("cold_first")), "route", "left")
        .select(*places.columns, F.when(by_place, F.col("hot_first")).otherwise(F.col("cold_first")).alias("first"))
    )


def copies(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``d, t`` of the documents whose text occurs under a smaller id."""
    keys = docs.where(F.col("text").isNotNull()).select(*_key(), F.lit(0).alias("i"))
    return _with_first(keys, "t", hot).where(F.struct(_PLACE) > F.col("first")).select("d", "t").distinct()


def _levels(lines: DataFrame, min_chars: int, hot: int) -> list[DataFrame]:
    """By doubling: the repeated places of 1, 2, 4 ... lines, with their ``first`` place and ``edge``.

    ``edge``: the line, or one of the two lines of level 1, has less than ``min_chars`` characters.
    """
    level, levels = lines.withColumn("edge", F.col("chars") < min_chars), []
    while True:
        width = 1 << len(levels)
        again = written(_with_first(level, "name", hot).where(F.col("first").isNotNull()), "line-runs")
        if again.limit(1).count() == 0:
            return levels
        levels.append(again)
        left = again.select(*_PLACE, "name", "chars", "edge")
        right = again.select(
            "d", "t", (F.col("i") - width).alias("i"), F.col("name").alias("name_2"), F.col("chars").alias("chars_2"),
            F.col("edge").alias("edge_2"),
        )
        if width == 1:
            # Repeated rows are one document: without this they would multiply in every round.
            # The columns are those of the join, so no shuffle is added.
            left, right = (side.dropDuplicates(_PLACE) for side in (left, right))
        edge = (F.col("edge") | F.col("edge_2")) if width == 1 else F.col("edge")
        level = left.join(right, _PLACE).select(
            *_PLACE, F.xxhash64("name", "name_2").alias("name"), (F.col("chars") + F.col("chars_2")).alias("chars"),
            edge.alias("edge"),
        )


def _longest(levels: list[DataFrame], hot: int) -> DataFrame:
    """``d, t, i, length, chars``: the longest runs from two lines on that begin at ``edge`` places and earlier too."""
    held = levels[1].where("edge").select(
        *_PLACE, F.lit(0).alias("length"), F.lit(0).cast("long").alias("node"), F.lit(0).cast("long").alias("chars"),
        F.lit(False).alias("later"),
    )
    if held.limit(1).count() == 0:
        return held.drop("node", "later")
    for k in reversed(range(len(levels))):
        width, level = 1 << k, levels[k]
        if k == 0:
            level = level.dropDuplicates(_PLACE)
        ahead = level.select("d", "t", F.col("i").alias("at"), "name", F.col("chars").alias("more"))
        split = written(
            held.withColumn("at", F.col("i") + F.col("length")).join(ahead, ["d", "t", "at"], "left").select(
                *held.columns, "more",
                F.when(F.col("name").isNotNull(), F.xxhash64("node", "length", F.lit(width), "name")).alias("child"),
            ), "run-splits",
        )
        place = F.struct(_PLACE)
        stays = F.struct("length", "node", "chars", "later")
        deeper = F.struct(
            (F.col("length") + width).alias("length"), F.col("child").alias("node"),
            (F.col("chars") + F.col("more")).alias("chars"), (place > F.col("first")).alias("later"),
        )
        now = (
            F.when(F.col("first").isNull(), F.array(stays))
            .when(place > F.col("first"), F.array(deeper))
            .otherwise(F.array(stays, deeper))
        )
        held = written(
            _with_first(split, "child", hot).select(*_PLACE, F.explode(now).alias("now")).select(*_PLACE, "now.*"),
            "run-intervals",
        )
    return held.where("later").drop("node", "later")


def repeated_runs(docs: DataFrame, later: DataFrame, min_chars: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """``d, t, begin, end``: later copies of runs, as merged intervals of line numbers."""
    lines = (
        docs.where(F.col("text").isNotNull()).select(*_key(), F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
        .select("d", "t", "i", F.xxhash64("line").alias("name"), F.length("line").cast("long").alias("chars"))
        .join(small(later), ["d", "t"], "left_anti")
    )
    lines = written(lines, "lines")
    levels = _levels(lines, min_chars, hot)
    begin = F.col("i").alias("begin")
    if levels:
        single = levels[0].where((F.struct(_PLACE) > F.col("first")) & (F.col("chars") >= min_chars))
        marks = single.select("d", "t", begin, (F.col("i") + 1).alias("end")).distinct()
    else:
        marks = lines.select("d", "t", begin, F.col("i").alias("end")).limit(0)
    if len(levels) > 1:
        runs = _longest(levels, hot).where(F.col("chars") >= min_chars)
        marks = marks.unionByName(runs.select("d", "t", begin, (F.col("i") + F.col("length")).alias("end")))
    # Merge what overlaps: an interval opens where no earlier one reaches.
    order = Window.partitionBy("d", "t").orderBy("begin", "end")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    opened = marks.withColumn("reach", F.max("end").over(before)).withColumn(
        "opens", F.when(F.col("reach").isNull() | (F.col("begin") > F.col("reach")), 1).otherwise(0)
    )
    numbered = opened.withColumn("island", F.sum("opens").over(order))
    return numbered.groupBy("d", "t", "island").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("island")


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, hot: int = HOT) -> DataFrame:
    """``docs`` with the deleted lines cut out of ``text``."""
    later = written(copies(docs, hot), "line-copies")
    runs = repeated_runs(docs, later, min_chars, hot)
    told = runs.groupBy("d", "t").agg(F.collect_list(F.struct("begin", "end")).alias("runs")).unionByName(
        later.withColumn("runs", F.lit(None).cast("array<struct<begin:int,end:int>>"))
    ).withColumn("told", F.lit(1))
    # The row stays a struct of its own, so its columns may have any names.
    whole = docs.select(F.struct("*").alias("row"))
    all_lines = F.split("row.text", "\n", -1)
    chars = F.length("row.text") - F.size(all_lines) + 1
    kept = F.array_join(
        F.filter(all_lines, lambda line, i: ~F.exists("runs", lambda r: (i >= r["begin"]) & (i < r["end"]))), "\n"
    )
    text = (
        F.when(F.col("told").isNull(), F.col("row.text"))
        .when(F.col("runs").isNotNull(), kept)
        .when(chars >= min_chars, F.lit(""))
        .otherwise(F.col("row.text"))
    )
    d, t = _key("row.doc_id", "row.text")
    cut = whole.join(told, d.eqNullSafe(F.col("d")) & t.eqNullSafe(F.col("t")), "left").withColumn("text", text)
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("told").isNull(), F.col("row.n_chars")).otherwise(length)
    return cut.select(*[changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def op4_line_runs(spark, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE docs AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l,
         row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy
  FROM documents WHERE text IS NOT NULL
), lines AS (
  SELECT doc_id, CAST(unnest(range(1, len(l) + 1)) AS INTEGER) AS i, unnest(l) AS line FROM docs WHERE copy = 1
), runs AS (
  -- Runs of 1, 2, 3 ... lines that occur more than once; ``nth`` counts the earlier ones.
  SELECT doc_id, i, 1 AS width, length(line) AS chars, md5(line) AS name,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, i) AS nth,
         count(*) OVER (PARTITION BY line) AS n FROM lines
  UNION ALL
  SELECT doc_id, i, width, chars, name,
         row_number() OVER (PARTITION BY name ORDER BY doc_id, i), count(*) OVER (PARTITION BY name)
  FROM (
    SELECT r.doc_id, r.i, r.width + 1 AS width, r.chars + length(x.line) AS chars, md5(r.name || x.line) AS name
    FROM runs r JOIN lines x ON x.doc_id = r.doc_id AND x.i = r.i + r.width WHERE r.n > 1
  )
), later AS (
  SELECT doc_id, i, max(width) AS width FROM runs WHERE nth > 1 AND chars >= 20 GROUP BY doc_id, i
), gone AS (
  SELECT doc_id, list_distinct(flatten(list(range(i, i + width)))) AS g FROM later GROUP BY doc_id
), cut AS (
  SELECT doc_id,
    CASE WHEN copy > 1 AND length(text) - len(l) + 1 >= 20 THEN '' WHEN g IS NULL THEN text
         ELSE coalesce(array_to_string(list_transform(list_filter(list_zip(l, range(1, len(l) + 1)),
                                       lambda x: NOT list_contains(g, x[2])), lambda x: x[1]), chr(10)), '') END AS text
  FROM docs LEFT JOIN gone USING (doc_id)
)
SELECT d.doc_id, c.text, d.lang, d.source,
       CASE WHEN c.text = d.text THEN d.n_chars ELSE CAST(length(c.text) AS BIGINT) END AS n_chars
FROM documents d LEFT JOIN cut c USING (doc_id)
"""
