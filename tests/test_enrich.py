from datetime import date

import pytest
from pyspark.sql import functions as F

from builders import PAYER, RECEIVER, SETTINGS, payment, payments, registry, sound_registry
from riskflow.functions.rules import load_rules
from riskflow.operators.enrich import distinct_companies, enrich, with_company_age
from riskflow.operators.landing import fingerprinted, to_fact
from riskflow.operators.quality import (
    duplicate_keys,
    has_nulls,
    landing_violations,
    null_counts,
    require_landable,
    require_no_nulls,
    split_landable,
)
from riskflow.operators.scoring import score, score_history
from riskflow.operators.skew import fits, hottest
from riskflow.schemas import FINAL_COLUMNS, TRANSACTIONS

AS_OF = SETTINGS.as_of


def scored(spark, rows, companies, mutated=False):
    enriched = enrich(fingerprinted(rows), with_company_age(companies, AS_OF))
    return score_history(enriched.withColumn("mutated", F.lit(mutated)), load_rules())


def test_no_rule_and_all_rules(spark):
    quiet = scored(spark, payments(spark, payment()), sound_registry(spark)).first()
    assert (quiet.risk_score, quiet.score_reasons) == (0, "[]")
    bad = registry(spark, (PAYER, "BAIXADA", "2023-12-01", 10.0), (RECEIVER, "INAPTA", "2023-12-01", 1.0))
    loud = scored(spark, payments(spark, payment(amount=100_000.01)), bad, mutated=True).first()
    assert loud.risk_score == 50 + 50 + 10 + 10 + 20 + 10 + 75
    assert loud.score_reasons == (
        '["payer_cnpj_inactive","receiver_cnpj_inactive","receiver_less_than_1_year",'
        '"payer_less_than_1_year","amount_over_payer_capital","amount_over_100k",'
        '"payload_mutation_detected"]'
    )


def test_capital_is_compared_in_single_precision(spark):
    companies = registry(
        spark, (PAYER, "ATIVO", "2010-01-01", 1234567.89), (RECEIVER, "ATIVO", "2010-01-01", 1.0)
    )
    rows = payments(spark, payment(1, amount=1234567.875), payment(2, amount=1234567.88))
    got = {r.amount: r for r in scored(spark, rows, companies).collect()}
    assert "amount_over_payer_capital" not in got[1234567.875].score_reasons
    assert "amount_over_payer_capital" in got[1234567.88].score_reasons
    fact = to_fact(scored(spark, rows, companies), SETTINGS.run_time)
    assert str(fact.first().payer_capital_stock) == "1234567.88"
    assert fact.columns == FINAL_COLUMNS


def test_unknown_companies_keep_their_rows_without_points(spark):
    row = scored(spark, payments(spark, payment(payer_cnpj="9" * 14)), sound_registry(spark)).first()
    assert row.payer_status is None and row.risk_score == 0


@pytest.mark.parametrize("limits", [(1_000, 1_000), (0, 1_000), (0, 3), (0, 0)])
def test_every_join_strategy_gives_the_same(spark, limits):
    people = [(f"1{i:013d}", "ATIVO" if i % 3 else "BAIXADA", f"20{i % 23:02d}-01-01", float(i)) for i in range(40)]
    rows = payments(spark, *[
        payment(
            i,
            payer_cnpj="1" + "0" * 13 if i % 3 == 0 else f"1{i % 45:013d}",
            receiver_cnpj="9" * 14 if i % 3 == 1 else f"1{i * 7 % 45:013d}",
        )
        for i in range(300)
    ])
    aged = with_company_age(registry(spark, *people), AS_OF)
    known = {p[0]: p for p in people}
    got = enrich(rows, aged, *limits).collect()
    assert len(got) == 300
    for row in got:
        payer, receiver = known.get(row.payer_cnpj), known.get(row.receiver_cnpj)
        assert row.payer_status == (payer and payer[1])
        assert row.payer_capital_stock == (payer and payer[3])
        assert row.receiver_status == (receiver and receiver[1])
        assert (row.receiver_company_age is None) == (receiver is None)


def test_hot_company_is_spread_over_partitions(spark, shuffled_plans):
    rows = payments(
        spark,
        *[payment(i) for i in range(900)],
        *[payment(i, payer_cnpj=f"3{i:013d}") for i in range(900)],
    )
    aged = with_company_age(sound_registry(spark), AS_OF)
    joined = enrich(rows, aged, broadcast_rows=0, hot_rows=100)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    parts = joined.withColumn("p", F.spark_partition_id()).where(F.col("payer_status") == "ATIVO")
    shares = [r["count"] for r in parts.groupBy("p").count().collect()]
    assert sum(shares) == 900 and len(shares) == 4 and max(shares) < 400


def test_equal_rows_of_a_hot_company_are_spread_too(spark, shuffled_plans):
    rows = payments(spark, payment()).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(2_000))))
    rows = rows.repartition(40).drop("copy")
    aged = with_company_age(sound_registry(spark), AS_OF)
    joined = enrich(rows, aged, broadcast_rows=0, hot_rows=100)
    shares = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(shares) == 2_000 and len(shares) > 1 and max(shares) < 1_500


def test_distinct_companies(spark):
    rows = payments(spark, payment(1), payment(2, payer_cnpj=RECEIVER), payment(3, receiver_cnpj="7" * 14))
    assert {r.cnpj for r in distinct_companies(rows).collect()} == {PAYER, RECEIVER, "7" * 14}


# --- quality ----------------------------------------------------------------------


@pytest.mark.parametrize("column", TRANSACTIONS.fieldNames())
def test_null_gate_names_the_load_and_the_column(spark, column):
    rows = payments(spark, payment(1), payment(2, **{column: None})).withColumn("file", F.lit("b.parquet"))
    report = null_counts(rows, "file")
    line = report.withColumn("rejected", has_nulls(report)).first()
    assert line.total_rows == 2 and line[f"null_{column}"] == 1 and line.rejected
    with pytest.raises(Exception, match=f"b.parquet: null values in {column}"):
        require_no_nulls(rows, "file").select("transaction_id").collect()


def test_null_gate_passes_sound_rows(spark):
    rows = payments(spark, payment(1), payment(2))
    assert require_no_nulls(rows).count() == 2
    report = null_counts(rows)
    assert not report.select(has_nulls(report)).first()[0]


def test_null_totals_come_from_file_footers_when_the_session_allows(spark, folder):
    payments(spark, payment(1), payment(2, description=None)).write.parquet(folder("in"))
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    try:
        report = null_counts(spark.read.schema(TRANSACTIONS).parquet(folder("in")))
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)" in plan
        assert report.first().null_description == 1
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", v1)
        spark.conf.set("spark.sql.parquet.aggregatePushdown", "false")


@pytest.mark.parametrize(
    ("changes", "named"),
    [
        ({}, []),
        ({"transaction_id": "trx_nope"}, ["transaction_id"]),
        ({"receiver_cnpj": "2" * 15}, ["receiver_cnpj", "receiver_status", "receiver_company_age"]),
        ({"amount": 1e14}, ["amount"]),
        ({"amount": float("nan")}, ["amount"]),
        ({"payer_cnpj": "8" * 14}, ["payer_status", "payer_company_age", "payer_capital_stock"]),
    ],
)
def test_landing_constraints(spark, changes, named):
    rows = scored(spark, payments(spark, payment(1, **changes)), sound_registry(spark))
    found = rows.select(landing_violations().alias("v")).first().v
    assert sorted(found) == sorted(named)
    good, bad = split_landable(rows)
    assert (good.count(), bad.count()) == ((0, 1) if named else (1, 0))
    if named:
        with pytest.raises(Exception, match="not landable because of"):
            require_landable(rows).collect()
    else:
        assert require_landable(rows).count() == 1


def test_landing_checks_are_decided_once(spark):
    rows = scored(spark, payments(spark, payment(1)), sound_registry(spark))
    good, _ = split_landable(rows)
    plan = good.select("transaction_id", "amount")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") <= 4


def test_a_company_listed_twice_counts_once(spark):
    registry = spark.createDataFrame(
        [("1", "ATIVO", "2020-01-01", 5.0), ("1", "ATIVO", "2020-01-01", 5.0), ("1", "BAIXADA", "2021-01-01", 7.0),
         ("2", None, None, None), (None, "ATIVO", "2020-01-01", 1.0)],
        "cnpj string, status string, activity_start_date string, capital_stock float",
    )
    found = {r.cnpj: (r.status, r.capital_stock) for r in with_company_age(registry, date(2024, 1, 1)).collect()}
    assert found == {"1": ("BAIXADA", 7.0), "2": (None, None), None: ("ATIVO", 1.0)}
    assert with_company_age(registry.limit(0), date(2024, 1, 1)).count() == 0


def test_the_mark_of_hot_keys_rises_until_few_enough_are_hot(spark, folder):
    counts = [(f"k{n}", n) for n in range(1, 101)]
    spark.createDataFrame(counts, "key string, count long").write.parquet(folder("counts"))
    written_counts = spark.read.parquet(folder("counts"))
    assert hottest(written_counts, 90, most=10).count() == 10
    hot = {r["count"] for r in hottest(written_counts, 1, most=40).collect()}
    assert hot == set(range(64, 101))
    assert hottest(written_counts, 1, most=10).count() == 0


def test_fits_counts_rows_and_bytes(spark, monkeypatch):
    rows = spark.createDataFrame([("a" * 100, 1), (None, 2)], "name string, n long")
    assert fits(rows, 2) and not fits(rows, 1) and not fits(rows, 0) and fits(rows.limit(0), 1)
    monkeypatch.setattr("riskflow.operators.skew.BROADCAST_BYTES", 100)
    assert not fits(rows, 2)


def test_duplicate_keys(spark):
    fact = spark.createDataFrame([("a", "h"), ("a", "h"), ("b", "h")], "transaction_id string, payload_hash string")
    assert [tuple(r) for r in duplicate_keys(fact).collect()] == [("a", "h", 2)]


def test_scoring_keeps_to_generated_code(spark):
    rows = fingerprinted(payments(spark, payment()))
    plan = score(enrich(rows, with_company_age(sound_registry(spark), AS_OF)), load_rules())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in text and "lambda" not in text and "CartesianProduct" not in text
