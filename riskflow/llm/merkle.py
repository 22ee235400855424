"""Merkle manifest of a dataset: concatenated-level strings, in DataFrame functions only.

The digests of a tree level are kept as one string. An aligned block of ``FANOUT ** LEVELS``
consecutive nodes of a group holds them as hexadecimal text, each digest 64 characters wide, so

* a level above is the hash of every ``64 * FANOUT`` characters wide substring,
* the siblings of a node are what stands left and right of it in that substring,
* a block ends in few digests, which are the nodes of the next, ``FANOUT ** LEVELS`` times
  smaller string of its group: the roots of blocks recurse until one digest per group is left.

The groups are the sources; their roots, in order of the sources (none first, then by bytes), are
the one group of a second tree whose root stands for the dataset. Where a level has
several nodes, every ``FANOUT`` consecutive ones become the hash of their digests, the last ones also if
they are fewer or one; a group of one node is its own root.

A leaf is the SHA-256 of the fields in order: ``-`` if null, else the length in bytes, a
colon and the value. Leaves of a source stand in order of their id, none first; equal ids in order
of their digests. Rows with equal digests and ids are interchangeable, so the result does not depend
on how they are dealt. Other columns are ignored; an empty table has no leaf and no root.

Positions come from a range-partitioned table: rows are numbered within a partition and source, and
the counts of the partitions before are added. So no source, however large, is one task, and blocks
are strings of bounded size. A proof is a list of (left, right) digest strings from leaf to root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from riskflow.llm.common import table
from riskflow.sources.tables import written

FANOUT = 16
LEVELS = 2  # tree levels within a block: blocks of 256 digests, strings of 16 KB
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64
_STEP = "struct<left:string,right:string>"


def field(column: Column) -> Column:
    """A value with its length in bytes in front; ``-`` if it is null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(columns: dict[str, Column]) -> Column:
    """Digest of a row, from its fields in the given order."""
    return F.sha2(F.concat(*[field(c) for c in columns.values()]), 256)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- positions -------------------------------------------------------------------------


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, counted from 0 within each value of ``group`` in the given order."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts, group, *order).withColumn("part", F.spark_partition_id())
    cut = written(cut, "merkle-order")  # fixed, whatever a repeated task would sample
    counts = cut.groupBy(group, "part").agg(F.count(F.lit(1)).alias("rows"))
    # One row per partition and group in it; a group's rows are its partitions.
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(group).alias("start_group"), F.col("part").alias("start_part"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"),
    )
    within = F.row_number().over(Window.partitionBy("part", group).orderBy(*order)) - 1
    return (
        cut.withColumn("within", within)
        .join(starts, (F.col("part") == F.col("start_part")) & F.col(group).eqNullSafe(F.col("start_group")))
        .withColumn("pos", F.col("start") + F.col("within"))
        .drop("part", "within", "start", "start_part", "start_group")
    )


# --- strings of digests ----------------------------------------------------------------


def _parents(level: Column, fanout: int) -> Column:
    """The level above: digests of all fixed-width substrings, as one string."""
    wide = _HEX * fanout
    last = F.floor((F.length(level) - 1) / wide).cast("int")
    return F.concat_ws("", F.transform(
        F.sequence(F.lit(0), last), lambda k: F.sha2(F.substring(level, k * wide + 1, F.lit(wide)), 256)
    ))


def _flanks(level: Column, at: Column, fanout: int) -> Column:
    """What stands left and right of digest number ``at`` among its siblings."""
    wide = _HEX * fanout
    run = F.floor(at / fanout).cast("int") * wide
    own = (at * _HEX).cast("int")
    return F.struct(
        F.substring(level, run + 1, own - run).alias("left"),
        F.substring(level, own + _HEX + 1, run + wide - own - _HEX).alias("right"),
    )


def blocks(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``grp, block, nodes, level_0, level_1, ..., top`` of ``grp, pos, node``.

    ``nodes`` is the number of nodes of the group. A level that the group does not have (one node is
    left below it) is null, and ``top`` the last digest there is.
    """
    width = fanout ** levels
    size = nodes.groupBy("grp").agg(F.count(F.lit(1)).alias("nodes")).withColumnRenamed("grp", "of")
    strings = nodes.groupBy("grp", F.floor(F.col("pos") / width).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "node"))).alias("held")
    ).select("grp", "block", F.array_join(F.col("held.node"), "").alias("level_0"))
    # One row per block on the left, one per group on the right.
    out = strings.join(size, F.col("grp").eqNullSafe(F.col("of"))).drop("of")
    for k in range(1, levels + 1):
        several = F.col("nodes") > fanout ** (k - 1)
        out = out.withColumn(f"level_{k}", F.when(several, _parents(F.col(f"level_{k - 1}"), fanout)))
    return out.withColumn("top", F.coalesce(*[F.col(f"level_{k}") for k in range(levels, -1, -1)]))


def proven(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """The blocks of ``nodes`` with ``rest``, the proof from their top to the root, and ``grp, root``.

    A proof is a list of (left, right) siblings. Blocks are built upwards and proofs handed
    downwards: one round per ``fanout ** levels`` of the largest group.
    """
    held = []
    while True:
        held.append(written(blocks(nodes, fanout, levels), "merkle-blocks"))
        nodes = held[-1].select("grp", F.col("block").alias("pos"), F.col("top").alias("node"))
        if held[-1].where("block > 0").limit(1).count() == 0:
            break
    roots = nodes.select("grp", F.col("node").alias("root"))
    level = held.pop().withColumn("rest", F.array().cast(f"array<{_STEP}>"))
    for below in reversed(held):
        tops = below.select("grp", F.col("block").alias("pos"))
        above = with_path(tops, level, fanout, levels).select(
            F.col("grp").alias("of"), F.col("pos").alias("at"), F.col("path").alias("rest")
        )
        level = below.join(above, F.col("grp").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))).drop("of", "at")
    return level, roots


def with_path(rows: DataFrame, level: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """``rows`` (with ``grp, pos``) with ``path``: they meet the strings of their block, so that
    proofs, which are longer than what they prove, are never shuffled."""
    width = fanout ** levels
    strings = level.select(F.col("grp").alias("of"), F.col("block").alias("at"), *[
        F.col(c).alias(f"block_{c}") for c in ("nodes", "rest", *[f"level_{k}" for k in range(levels)])
    ])
    met = rows.join(strings, F.col("grp").eqNullSafe(F.col("of")) & (F.floor(F.col("pos") / width) == F.col("at")))
    inside = F.pmod(F.col("pos"), F.lit(width))
    steps = [
        F.when(F.col("block_nodes") > fanout ** k, _flanks(F.col(f"block_level_{k}"), F.floor(inside / fanout ** k), fanout))
        for k in range(levels)
    ]
    path = F.concat(F.filter(F.array(*steps), lambda s: s.isNotNull()), F.col("block_rest"))
    return met.select(*[F.col(c) for c in rows.columns], path.alias("path"))


def folded(path: Column, node: Column) -> Column:
    """The root that a node and its proof lead to."""
    return F.aggregate(path, node, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a proof, left to right and level by level."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))), 256)


def manifest(
    docs: DataFrame, changed: dict[str, Column] | None = None, where: Column | None = None,
    fanout: int = FANOUT, levels: int = LEVELS,
) -> DataFrame:
    """``doc_id, source, pos, leaf, other, subroot, root, path`` of every row.

    ``other`` is the leaf of the row with the columns in ``changed`` in place of its own (of rows
    ``where`` holds, if given; null otherwise). ``path`` leads from the leaf over its source's root to the root.
    """
    columns = {name: F.col(name) for name in FIELDS}
    other = F.lit(None).cast("string")
    if changed is not None:
        other = F.when(F.lit(True) if where is None else where, leaf(columns | changed))
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("grp"),
        leaf(columns).alias("node"), other.alias("other"),
    )
    placed = written(numbered(leaves, "grp", ["doc_id", "node"]), "merkle-leaves")
    level, roots = proven(placed.select("grp", "pos", "node"), fanout, levels)

    # The tree over the sources: one group, whose nodes are their roots.
    tops = roots.select(F.lit(0).alias("grp"), F.col("grp").alias("source"), F.col("root").alias("subroot"))
    tops = written(numbered(tops, "grp", ["source"]), "merkle-sources")
    upper, top = proven(tops.select("grp", "pos", F.col("subroot").alias("node")), fanout, levels)
    sources = with_path(tops, upper, fanout, levels).join(top, "grp").select(
        F.col("source").alias("of_source"), "subroot", F.col("path").alias("source_path"), "root"
    )
    found = with_path(placed, level, fanout, levels).join(sources, F.col("grp").eqNullSafe(F.col("of_source")))
    return found.select(
        "doc_id", F.col("grp").alias("source"), "pos", F.col("node").alias("leaf"), "other", "subroot", "root",
        F.concat("path", "source_path").alias("path"),
    )


def op11_merkle_manifest(spark, sf_dir: str) -> DataFrame:
    """Every row proven, and rows whose id's CRC-32 is a multiple of 5 tampered with (a null id is not)."""
    struck = F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0
    rows = manifest(table(spark, sf_dir, "documents"), {"text": lowered(F.col("text"))}, struck)
    again = rows.withColumn("folded_root", folded(F.col("path"), F.coalesce("other", "leaf")))
    return again.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Levels of a tree in the SQL: enough for 16 ** 8 rows of a source.
_SQL_LEVELS = 8


def _sql_tree(name: str, nodes: str) -> str:
    """Levels of a tree over ``nodes`` (g, pos, h, key) and, per node, ``root`` and the siblings on its way."""
    parts = [f"{name}_0 AS ({nodes})"]
    for k in range(_SQL_LEVELS):
        parts.append(
            f"{name}_run_{k} AS (SELECT g, pos // 16 AS run, list(h ORDER BY pos) AS hs, any_value(size) AS size FROM "
            f"(SELECT g, pos, h, count(*) OVER (PARTITION BY g) AS size FROM {name}_{k}) GROUP BY g, pos // 16)"
        )
        parts.append(
            f"{name}_{k + 1} AS (SELECT g, CASE WHEN size = 1 THEN 0 ELSE run END AS pos, "
            f"CASE WHEN size = 1 THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h FROM {name}_run_{k})"
        )
    walk = f"SELECT g, pos AS at, pos, key, other AS h, '' AS proof FROM {name}_0"
    for k in range(_SQL_LEVELS):
        parts.append(f"{name}_walk_{k} AS ({walk})")
        left = "array_to_string(hs[1:w.pos % 16], '')"
        right = "array_to_string(hs[w.pos % 16 + 2:], '')"
        walk = (
            f"SELECT w.g, w.at, w.key, w.pos // 16 AS pos, CASE WHEN size = 1 THEN w.h ELSE sha256({left} || w.h || {right}) END AS h, "
            f"CASE WHEN size = 1 THEN w.proof ELSE w.proof || {left} || {right} END AS proof "
            f"FROM {name}_walk_{k} w JOIN {name}_run_{k} r ON w.g = r.g AND w.pos // 16 = r.run"
        )
    parts.append(f"{name}_way AS ({walk})")
    parts.append(f"{name}_root AS (SELECT g, h FROM {name}_{_SQL_LEVELS})")
    return ", ".join(parts)


def _sql_leaf(text: str) -> str:
    kinds = {"doc_id": "doc_id", "source": "source", "lang": "lang", "n_chars": "n_chars", "text": text}
    return "sha256(" + " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in kinds.values()
    ) + ")"


_SQL_BITS = (
    "flatten(list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: list_transform(range(0, 8), "
    "lambda b: (ascii(substr(CAST(doc_id AS VARCHAR), i, 1)) >> b) & 1)))"
)
_SQL_CRC = (
    f"xor(list_reduce(list_transform({_SQL_BITS}, lambda b: CAST(b AS BIGINT)), "
    "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1)), CAST(4294967295 AS BIGINT)), 4294967295)"
)
_SQL_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE = f"""
WITH leaves AS (
  SELECT source AS g, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, doc_id AS key,
         {_sql_leaf("text")} AS h,
         CASE WHEN {_SQL_CRC} % 5 = 0 THEN {_sql_leaf(_SQL_LOWERED)} ELSE {_sql_leaf("text")} END AS other
  FROM documents
), named AS (SELECT coalesce('s' || g, '') AS g, pos, key, h, other FROM leaves),
{_sql_tree("own", "SELECT g, pos, key, h, other FROM named")},
{_sql_tree("top", "SELECT 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, g AS key, h, h AS other FROM own_root")},
tampered AS (
  SELECT w.key AS doc_id, n.h AS leaf, o.h AS subroot, r.h AS root, sha256(w.proof || t.proof) AS proof_sha256, w.h AS sub, t.at AS place
  FROM own_way w JOIN named n ON w.g = n.g AND w.at = n.pos JOIN own_root o ON w.g = o.g
  JOIN top_way t ON t.key = w.g CROSS JOIN top_root r
), {", ".join(
    f"up_{k + 1} AS (SELECT u.* EXCLUDE (sub, place), place // 16 AS place, CASE WHEN size = 1 THEN sub ELSE "
    f"sha256(array_to_string(hs[1:place % 16], '') || sub || array_to_string(hs[place % 16 + 2:], '')) END AS sub "
    f"FROM {'tampered' if k == 0 else f'up_{k}'} u JOIN top_run_{k} ON place // 16 = run)"
    for k in range(_SQL_LEVELS)
)}
SELECT doc_id, leaf, subroot, root, proof_sha256, sub AS folded_root, sub = root AS verified FROM up_{_SQL_LEVELS}
"""
