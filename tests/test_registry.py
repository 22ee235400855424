import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from riskflow.schemas import REGISTRY, REGISTRY_CACHE
from riskflow.sources import registry as source

NOW = datetime(2024, 1, 10, tzinfo=timezone.utc)
PAST, FUTURE = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 15, 3, tzinfo=timezone.utc)


def companies(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "cnpj string")


def snapshot(spark, *names):
    return spark.createDataFrame([(n, f"fresh {n}", "2020-01-01", 5.0) for n in names], REGISTRY)


def cached(spark, *entries):
    rows = [(n, f"cached {n}", "2020-01-01", 1.0, at) for n, at in entries]
    return spark.createDataFrame(rows, REGISTRY_CACHE)


def raw(**fields):
    record = {
        "descricao_situacao_cadastral": "SUSPENSA",
        "data_inicio_atividade": "2013-04-08",
        "capital_social": 73250.5,
    }
    record.update(fields)
    return json.dumps({k: v for k, v in record.items() if v != "absent"})


@pytest.mark.parametrize(
    ("text", "valid"),
    [
        (raw(), True),
        (raw(other="ignored"), True),
        (raw(capital_social=7), True),
        (raw(capital_social="12.5"), True),
        (raw(capital_social=None), False),
        (raw(capital_social="much"), False),
        (raw(capital_social="absent"), False),
        (raw(descricao_situacao_cadastral=2), False),
        (raw(descricao_situacao_cadastral=None), False),
        (raw(data_inicio_atividade="absent"), False),
        ("{", False),
        ("[]", False),
        (None, False),
    ],
)
def test_records_are_validated(spark, text, valid):
    frame = spark.createDataFrame([("1", text)], "cnpj string, raw string")
    good, bad = source.parse_registry_json(frame)
    assert (good.count(), bad.count()) == ((1, 0) if valid else (0, 1))
    if valid:
        assert good.first().status == "SUSPENSA" and good.schema == REGISTRY


def test_split_and_stats(spark):
    live = source.live_cache(cached(spark, ("a", FUTURE), ("b", PAST), ("z", FUTURE), ("n", NOW)), F.lit(NOW))
    wanted = companies(spark, "a", "b", "c", "n")
    hits, misses = source.split_cache(wanted, live)
    assert [r.cnpj for r in hits.collect()] == ["a"]
    assert {r.cnpj for r in misses.collect()} == {"b", "c", "n"}
    assert tuple(source.cache_stats(wanted, live).first()) == (1, 3, 25.0)
    assert tuple(source.cache_stats(companies(spark).limit(0), live).first()) == (0, 0, 0.0)


def test_refresh_sets_only_absent_entries(spark, folder):
    path = folder("cache")
    cached(spark, ("a", FUTURE), ("b", PAST)).write.parquet(path)
    find = source.from_snapshot(snapshot(spark, "a", "b", "c", "unasked"))
    found = source.refresh_cache(companies(spark, "a", "b", "c", "d"), path, find, F.lit(NOW))
    assert {r.cnpj: r.status for r in found.collect()} == {
        "a": "cached a", "b": "fresh b", "c": "fresh c",
    }
    entries = source.read_cache(spark, path)
    assert entries.count() == 4
    expiry = entries.where("cnpj = 'c'").select(F.unix_seconds("expires_at")).first()[0]
    assert expiry == FUTURE.timestamp()


def test_refresh_of_an_absent_cache_and_without_misses(spark, folder):
    path = folder("cache")
    find = source.from_snapshot(snapshot(spark, "a"))
    assert source.refresh_cache(companies(spark, "a"), path, find, F.lit(NOW)).count() == 1

    def never(_):
        raise AssertionError("all companies are cached")

    assert source.refresh_cache(companies(spark, "a"), path, never, F.lit(NOW)).count() == 1


def test_merged_has_one_row_per_company(spark):
    live = source.live_cache(cached(spark, ("a", FUTURE)), F.lit(NOW))
    hits, misses = source.split_cache(companies(spark, "a", "c"), live)
    rows = source.merged(hits, source.from_snapshot(snapshot(spark, "a", "c"))(misses)).collect()
    assert {r.cnpj: r.status for r in rows} == {"a": "cached a", "c": "fresh c"}


def test_lookups_are_tried_again_and_parsed(spark, folder):
    import os

    marks = folder("marks")
    os.makedirs(marks)

    sample = json.loads(raw())

    def fetch(cnpj):
        import json

        mark = os.path.join(marks, cnpj)
        if not os.path.exists(mark):
            open(mark, "w").close()
            raise OSError("first try fails")
        return json.dumps({**sample, "capital_social": int(cnpj)})

    records = source.fetch_missing(companies(spark, "1", "2", "3"), fetch, in_flight=2)
    good, _ = source.parse_registry_json(records)
    assert {r.cnpj: r.capital_stock for r in good.collect()} == {"1": 1.0, "2": 2.0, "3": 3.0}


def test_a_company_that_keeps_failing_fails_the_job(spark):
    def fetch(cnpj):
        raise OSError(f"no answer for {cnpj}")

    with pytest.raises(Exception, match="no answer for 1"):
        source.fetch_missing(companies(spark, "1"), fetch, in_flight=1, attempts=2).collect()
