"""What moves and what is written: each row once, in short form, at any size."""

import uuid
from dataclasses import replace

from pyspark.sql import DataFrameWriter, functions as F

from builders import SETTINGS, payment, payments, some_id, sound_registry
from riskflow.functions.fingerprint import payload_hash, with_packed_keys, with_unpacked_keys
from riskflow.functions.rule_checks import rule_errors
from riskflow.operators import keyindex
from riskflow.operators.enrich import enrich
from riskflow.operators.landing import read_fact
from riskflow.operators.mutation import resolve_history
from riskflow.plans import loads
from riskflow.sources import fixtures

KEYS = "transaction_id string, payload_hash string"


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_rows_beyond_the_limit_are_shuffled_once(spark, folder, shuffled_plans):
    spark.range(3_000).select(
        F.concat(F.lit("i"), F.col("id") % 700).alias("transaction_id"), F.concat(F.lit("h"), F.col("id") % 1_900).alias("payload_hash"),
        F.lit(1.0).alias("amount"), (F.col("id") % 3).alias("epoch"),
    ).write.parquet(folder("rows"))
    found = resolve_history(spark.read.parquet(folder("rows")), broadcast_rows=10)
    found.collect()
    plan = planned(found)
    assert plan.count("Exchange hashpartitioning") - plan.count("ReusedExchange") == 1


def test_delivered_payments_are_not_sorted_by_load(spark, folder, monkeypatch):
    key, seen, kept = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *a, **k: seen.append(int(spark.conf.get(key))) or kept(*a, **k))
    before = spark.conf.get(key)
    rows = payments(spark, *[payment(i) for i in range(40)]).withColumn("file_seq", F.ascii(F.substring("transaction_id", -1, 1)) % 3)
    fixtures.deliver(rows, folder("in"))
    assert min(seen) > fixtures.LOADS and spark.conf.get(key) == before
    found = spark.read.parquet(folder("in")).select(*rows.columns[:-1], F.col("load").cast("int").alias("file_seq"))
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))


def test_null_ids_are_kept_and_never_flagged(spark):
    rows = spark.createDataFrame([(None, "h1", 1.0, 0), (None, "h2", 1.0, 1), ("a", "h1", 1.0, 0), ("a", "h2", 1.0, 1)],
                                 f"{KEYS}, amount double, epoch long")
    want = {(None, "h1", False), (None, "h2", False), ("a", "h1", False), ("a", "h2", True)}
    for limit in (100, 0):
        got = resolve_history(rows, broadcast_rows=limit).select("transaction_id", "payload_hash", "mutated").collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_packed_keys_stand_for_the_same_text(spark):
    one = str(uuid.UUID(int=2**127 + 0xABCDEF))
    texts = [one, one.upper(), one.replace("-", ""), f"{{{one}}}", "", "x", "é" * 9, "0" * 16, "f" * 32, "F" * 32, "g" * 32, None]
    rows = spark.createDataFrame([(a, b) for a in texts for b in texts], KEYS)
    packed = with_packed_keys(rows)
    assert packed.distinct().count() == len(texts) ** 2
    assert sorted(map(tuple, with_unpacked_keys(packed).collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
    assert packed.where(F.col("transaction_id") == F.unhex(F.lit(one.replace("-", "")))).count() == len(texts)


def test_possible_keys_miss_none_and_move_no_key(spark, folder, shuffled_plans):
    stored = spark.createDataFrame([(some_id(n), f"h{n}") for n in range(4_000)], KEYS)
    asked = stored.where(F.hash("transaction_id") % 40 == 0).select("transaction_id")
    found = keyindex.possible_keys(stored, asked, 1_000)
    got = {r.transaction_id for r in found.collect()}
    want = {r.transaction_id for r in asked.collect()}
    assert want <= got and len(got) < len(want) + 20
    assert planned(found).count("Exchange hashpartitioning(_part") == 1 and planned(found).count("Exchange hashpartitioning") == 1


def test_a_load_writes_no_copy_of_its_rows(spark, folder, monkeypatch):
    made = []
    monkeypatch.setattr(loads, "written", lambda frame, purpose, *more: made.append(purpose) or kept(frame, purpose, *more))
    kept = __import__("riskflow.sources.tables", fromlist=["written"]).written
    payments(spark, *[payment(i) for i in range(5)]).write.parquet(folder("in"))
    rows = spark.read.parquet(folder("in")).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    assert loads.load_rows(rows, sound_registry(spark), folder("fact"), 0, SETTINGS) == (5, 5)
    assert "batch" not in made


def test_lines_are_shuffled_once(spark, folder, shuffled_plans):
    spark.sql("SELECT 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 5D l_extendedprice, timestamp'2020-01-01' l_shipdate"
              ).write.parquet(folder("sf/lineitem.parquet"))
    spark.sql("SELECT 1L o_orderkey, 7L o_custkey").write.parquet(folder("sf/orders.parquet"))
    everything = fixtures.transactions(spark, folder("sf"))
    assert planned(everything).count("Exchange hashpartitioning") == 2  # lines and orders
    for load in range(fixtures.LOADS):
        assert fixtures.transactions(spark, folder("sf"), load).collect() == everything.where(F.col("file_seq") == load).collect()


def test_an_entry_is_parsed_once_and_an_amount_is_written_once(spark):
    plan = planned(rule_errors(spark.createDataFrame([(1, "{}")], "entry_no int, entry string")))
    assert plan.count("parse_json(") == 1 or plan.lower().count("parsejson") == 1
    plan = planned(payments(spark, payment(1)).select(payload_hash()))
    assert plan.count("cast(amount") <= 8


REGISTERED = "cnpj string, status string, company_age double, capital_stock float"


def test_a_role_with_few_companies_is_not_shuffled(spark, folder, shuffled_plans):
    spark.createDataFrame([(f"p{n % 40}", f"r{n % 3}", n) for n in range(200)],
                          "payer_cnpj string, receiver_cnpj string, n long").write.parquet(folder("rows"))
    rows = spark.read.parquet(folder("rows"))
    aged = spark.createDataFrame([(f"{k}{n}", f"{k}{n}", 1.0, 2.0) for k in "pr" for n in range(0, 40, 2)], REGISTERED)
    found = enrich(rows, aged, broadcast_rows=10, hot_rows=1_000)
    assert planned(found).count("Exchange hashpartitioning(_route") == 2  # rows and payers; receivers meet them by a broadcast
    known = {r.cnpj for r in aged.collect()}
    for row in found.collect():
        assert row.payer_status == (row.payer_cnpj if row.payer_cnpj in known else None)
        assert row.receiver_status == (row.receiver_cnpj if row.receiver_cnpj in known else None)


def test_rows_are_told_apart_without_a_copy_at_any_size(spark, folder, monkeypatch):
    made = []
    monkeypatch.setattr(loads, "written", lambda frame, purpose, *more: made.append(purpose) or kept(frame, purpose, *more))
    kept = __import__("riskflow.sources.tables", fromlist=["written"]).written
    some = [payment(i, payer_cnpj=f"{i % 20:014d}", amount=1e14 if i == 7 else 10.0 + i) for i in range(60)]
    payments(spark, *some).write.parquet(folder("in"))
    rows = spark.read.parquet(folder("in")).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    sides = sorted({r[c] for r in rows.collect() for c in ("payer_cnpj", "receiver_cnpj")})
    registry = spark.createDataFrame([(c, "x" * 101 if c.endswith("03") else "ATIVO", "2020-01-01", 1.0) for c in sides if not c.endswith("11")],
                                     "cnpj string, status string, activity_start_date string, capital_stock float")
    results = []
    for limit in (1_000, 5, 1):
        made.clear()
        settings = replace(SETTINGS, reject_path=folder(f"rejects{limit}"), broadcast_rows=limit)
        assert loads.load_rows(rows, registry, folder(f"fact{limit}"), 0, settings) == (60, 53)
        assert ("batch" in made) == (limit == 1)  # only where the companies that cannot land are too many as well
        refused = spark.read.parquet(folder(f"rejects{limit}/load_seq=0")).select("transaction_id", "payer_status", "violations")
        fact = read_fact(spark, folder(f"fact{limit}")).drop("load_seq")
        results.append([sorted(map(str, frame.collect())) for frame in (refused, fact)])
    assert results[0] == results[1] == results[2] and len(results[0][0]) == 7


def test_stored_rows_are_not_moved_by_the_manifest(spark, folder, shuffled_plans):
    payments(spark, payment(1)).write.parquet(folder("in"))
    rows = spark.read.parquet(folder("in")).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    loads.load_rows(rows, sound_registry(spark), folder("fact"), 0, SETTINGS)
    for frame in (read_fact(spark, folder("fact")), keyindex.read_keys(spark, folder("fact"))):
        assert frame.count() == 1 and "SortMergeJoin" not in planned(frame)


def test_nulls_are_looked_for_in_one_pass_and_refused_rows_before_their_fingerprint(spark, folder, monkeypatch):
    some = [payment(i, payer_cnpj=f"{i % 20:014d}", amount=1e14 if i == 7 else 10.0 + i) for i in range(60)]
    payments(spark, *some).write.parquet(folder("in"))
    rows = spark.read.parquet(folder("in")).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    taken, kept = [], loads.told_apart
    monkeypatch.setattr(loads, "told_apart", lambda *a: taken.append(kept(*a)) or taken[-1])
    settings = replace(SETTINGS, reject_path=folder("rejects"), broadcast_rows=5)
    sides = sorted({r[c] for r in rows.collect() for c in ("payer_cnpj", "receiver_cnpj")})
    registry = spark.createDataFrame([(c, "ATIVO", "2020-01-01", 1.0) for c in sides if not c.endswith("11")],
                                     "cnpj string, status string, activity_start_date string, capital_stock float")
    assert loads.load_rows(rows, registry, folder("fact"), 0, settings) == (60, 56)
    accepted = taken[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert "raise_error" not in accepted and "violations" not in accepted
