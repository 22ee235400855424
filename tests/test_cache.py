"""The registry cache as versions."""

from datetime import datetime, timedelta, timezone

from riskflow.schemas import REGISTRY_CACHE
from riskflow.sources import cache

NOW = datetime(2024, 1, 10, 12, tzinfo=timezone.utc)


def entries(spark, *rows):
    return spark.createDataFrame([(c, s, "2020-01-01", 1.0, NOW + timedelta(hours=h)) for c, s, h in rows], REGISTRY_CACHE)


def state(spark, path, now=NOW):
    return {r.cnpj: (r.status, (r.expires_at.astimezone(timezone.utc) - NOW) // timedelta(hours=1)) for r in cache.live(spark, path, now).collect()}


def test_newest_live_entries(spark, folder):
    path = folder("cache")
    assert state(spark, path) == {} and cache.versions(spark, path) == []
    assert cache.append(entries(spark, ("a", "OLD", 100), ("b", "OLD", -1), ("c", "OLD", 0)), path) == 0
    assert cache.append(entries(spark, ("a", "NEW", 50), ("d", "NEW", 900)), path) == 1
    assert state(spark, path) == {"a": ("NEW", 50), "d": ("NEW", 900)}
    # An entry that has expired does not hide an older one that has not.
    assert state(spark, path, NOW + timedelta(hours=60)) == {"a": ("OLD", 100), "d": ("NEW", 900)}


def test_compaction_keeps_what_is_live(spark, folder):
    path = folder("cache")
    for turn in range(3):
        cache.append(entries(spark, ("a", f"S{turn}", 100 + turn), ("b", "GONE", -30), (f"x{turn}", "ONE", 5)), path)
    before = state(spark, path)
    assert cache.compact(spark, path, NOW) == 3 and cache.versions(spark, path) == [3]
    assert state(spark, path) == before == {"a": ("S2", 102), **{f"x{t}": ("ONE", 5) for t in range(3)}}
    assert spark.read.parquet(path).count() == 4
    assert cache.compact(spark, path, NOW + timedelta(hours=2000)) == 4 and state(spark, path) == {}


def test_only_days_to_come_are_read(spark, folder):
    path = folder("cache")
    cache.append(entries(spark, *[(f"c{d}", "X", 24 * d + 1) for d in range(-5, 3)]), path)
    found = cache.live(spark, path, NOW)
    assert {r.cnpj for r in found.collect()} == {"c0", "c1", "c2"}
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "expires_on" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
