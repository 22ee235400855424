from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from builders import PAYER, SETTINGS, payment, payments, some_id, sound_registry
from riskflow.operators import audit, landed
from riskflow.operators.landed import landed_loads
from riskflow.operators.landing import next_load_seq, read_fact, stream_load_seq
from riskflow.operators.quality import duplicate_keys
from riskflow.plans.loads import load_folder, load_rows
from riskflow.schemas import AUDIT_EVENTS, FACT, FACT_TABLE
from riskflow.sources.registry import from_snapshot, refresh_cache
from riskflow.sources.tables import new_folder, read_or_empty, shared_root, subfolders
from riskflow.streaming import ingest


@pytest.fixture
def place(folder):
    """Paths of a run."""
    class Place:
        inbox, fact, trail, rejects = (folder(n) for n in ("inbox", "fact", "audit", "rejects"))
        checkpoint = folder("checkpoint")
    return Place


def deliver(spark, place, name, *rows):
    payments(spark, *rows).coalesce(1).write.parquet(f"{place.inbox}/{name}")


def run(spark, place, settings=SETTINGS, known=None, **options):
    return load_folder(
        spark, place.inbox, known or sound_registry(spark), place.fact, place.trail, settings,
        unit="folder", **options,
    )


def facts(spark, place):
    return {
        (r.transaction_id, str(r.amount)): (r.load_seq, r.risk_score)
        for r in read_fact(spark, place.fact).collect()
    }


def trail(spark, place):
    state = audit.current_state(read_or_empty(spark, place.trail, AUDIT_EVENTS))
    return {r.file.rsplit("/")[-1]: (r.status, r.total_rows, r.inserted_rows) for r in state.collect()}


def three_loads(spark, place):
    deliver(spark, place, "a", payment(1), payment(2), payment(2))
    deliver(spark, place, "b", payment(1, amount=200.0), payment(3))
    deliver(spark, place, "c", payment(1), payment(1, amount=200.0), payment(1, amount=300.0))


LANDED = {
    (some_id(1), "100.00"): (0, 0),
    (some_id(2), "100.00"): (0, 0),
    (some_id(1), "200.00"): (1, 75),
    (some_id(3), "100.00"): (1, 0),
    (some_id(1), "300.00"): (2, 75),
}


def test_loads_one_after_the_other(spark, place):
    three_loads(spark, place)
    assert run(spark, place) == 8
    assert facts(spark, place) == LANDED
    assert trail(spark, place) == {
        "a": ("COMPLETED", 3, 2), "b": ("COMPLETED", 2, 2), "c": ("COMPLETED", 3, 1),
    }
    table = read_fact(spark, place.fact)
    assert table.schema == FACT_TABLE and duplicate_keys(table).isEmpty()
    # A rerun reprocesses everything and adds nothing.
    run(spark, place)
    assert read_fact(spark, place.fact).count() == len(LANDED)


@pytest.mark.parametrize("limits", [(1_000, 1_000), (0, 1)])
def test_one_job_lands_the_same_rows(spark, place, limits):
    three_loads(spark, place)
    settings = replace(SETTINGS, broadcast_rows=limits[0], hot_rows=limits[1])
    assert run(spark, place, settings, one_job=True) == 8
    # One audit row per file, as when they are loaded one after the other.
    assert trail(spark, place) == {
        "a": ("COMPLETED", 3, 2), "b": ("COMPLETED", 2, 2), "c": ("COMPLETED", 3, 1),
    }
    assert {k: v[1] for k, v in facts(spark, place).items()} == {k: v[1] for k, v in LANDED.items()}
    run(spark, place, settings, one_job=True)
    assert read_fact(spark, place.fact).count() == len(LANDED)


def test_the_same_load_again_replaces_itself(spark, place):
    rows = payments(spark, payment(1), payment(2)).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    for _ in range(2):
        assert load_rows(rows, sound_registry(spark), place.fact, 0, SETTINGS) == (2, 2)
    assert read_fact(spark, place.fact).count() == 2


def test_first_bad_file_ends_the_run(spark, place):
    deliver(spark, place, "a", payment(1))
    deliver(spark, place, "b", payment(2), payment(3, description=None))
    deliver(spark, place, "c", payment(4))
    with pytest.raises(Exception, match="b: null values in description"):
        run(spark, place)
    assert trail(spark, place) == {"a": ("COMPLETED", 1, 1), "b": ("FAILED", 0, 0)}
    with pytest.raises(Exception, match="b: null values in description"):
        run(spark, place, one_job=True)
    assert sorted(r.status for r in audit.current_state(spark.read.parquet(place.trail)).collect()) == [
        "COMPLETED", "FAILED", "FAILED", "FAILED", "FAILED",
    ]
    assert set(facts(spark, place)) == {(some_id(1), "100.00")}


def test_unknown_company_fails_the_load_or_is_set_aside(spark, place):
    deliver(spark, place, "a", payment(1), payment(2, payer_cnpj="9" * 14))
    with pytest.raises(Exception, match="not landable because of payer_status"):
        run(spark, place)
    assert facts(spark, place) == {}
    run(spark, place, replace(SETTINGS, reject_path=place.rejects))
    assert set(facts(spark, place)) == {(some_id(1), "100.00")}
    rejected = spark.read.parquet(place.rejects).first()
    assert rejected.transaction_id == some_id(2) and "payer_status" in rejected.violations


@pytest.mark.parametrize("one_job", [False, True])
def test_a_rejected_version_is_no_earlier_version(spark, place, one_job):
    deliver(spark, place, "a", payment(1, amount=1e14))
    deliver(spark, place, "b", payment(1))
    run(spark, place, replace(SETTINGS, reject_path=place.rejects), one_job=one_job)
    assert [v[1] for v in facts(spark, place).values()] == [0]


def test_loads_of_equal_names_stay_apart(spark, place):
    deliver(spark, place, "2024/x", payment(1))
    deliver(spark, place, "2025/x", payment(1, amount=200.0))
    deliver(spark, place, "2025/y a+b%c", payment(2))
    assert run(spark, place) == 3
    assert facts(spark, place) == {
        (some_id(1), "100.00"): (0, 0), (some_id(1), "200.00"): (1, 75), (some_id(2), "100.00"): (2, 0),
    }
    state = audit.current_state(spark.read.parquet(place.trail)).collect()
    assert sorted(r.file for r in state) == ["2024/x", "2025/x", "2025/y a+b%c"]


@pytest.mark.parametrize("one_job", [False, True])
def test_a_resumed_run_takes_what_is_new_or_changed(spark, place, one_job):
    deliver(spark, place, "2024/x", payment(1))
    deliver(spark, place, "2025/x", payment(1, amount=200.0))
    assert run(spark, place, resume=True, one_job=one_job) == 2
    assert run(spark, place, resume=True, one_job=one_job) == 0
    deliver(spark, place, "2025/y", payment(2))
    payments(spark, payment(1, amount=300.0), payment(3)).coalesce(1).write.mode("overwrite").parquet(f"{place.inbox}/2025/x")
    assert run(spark, place, resume=True, one_job=one_job) == 3
    assert len(facts(spark, place)) == 5 and facts(spark, place)[some_id(1), "300.00"][1] == 75
    assert run(spark, place, resume=True, one_job=one_job) == 0
    # What is not in the manifest any more has to be loaded again.
    landed.record(spark, place.fact, 0, False)
    assert run(spark, place, resume=True, one_job=one_job) > 0


@pytest.mark.parametrize("one_job", [False, True])
def test_empty_load_completes(spark, place, one_job):
    deliver(spark, place, "a")
    deliver(spark, place, "b", payment(1))
    assert run(spark, place, one_job=one_job) == 1
    assert trail(spark, place) == {"a": ("COMPLETED", 0, 0), "b": ("COMPLETED", 1, 1)}


def test_empty_folder_loads_nothing(spark, place):
    import os

    os.makedirs(place.inbox)
    assert run(spark, place) == 0 and facts(spark, place) == {}


def test_batches_of_one_file_see_each_other(spark, place):
    rows = [payment(n) for n in range(4)]
    deliver(spark, place, "a", *rows, payment(1, amount=200.0))
    run(spark, place, replace(SETTINGS, batch_size=2))
    scores = sorted(v[1] for k, v in facts(spark, place).items() if k[0] == some_id(1))
    assert scores == [0, 75]  # rows 0,1 | 1,2 | 3: the edge falls between both versions


def test_registry_through_the_cache(spark, place, folder):
    deliver(spark, place, "a", payment(1))
    cache, now = folder("cache"), SETTINGS.run_time
    snapshot = sound_registry(spark)

    def known(companies):
        return refresh_cache(companies, cache, from_snapshot(snapshot), F.lit(now))

    run(spark, place, known=known)
    assert set(facts(spark, place)) == {(some_id(1), "100.00")}
    assert {r.cnpj for r in spark.read.parquet(cache).collect()} == {PAYER, "20000000000001"}


def test_next_load_number(spark, place):
    assert next_load_seq(spark, place.fact) == 0
    deliver(spark, place, "a", payment(1))
    run(spark, place)
    assert next_load_seq(spark, place.fact) == 1


# --- streaming --------------------------------------------------------------------


def test_stream_equals_batch_and_remembers_what_it_loaded(spark, place):
    def step():
        ingest.start(
            spark, place.inbox, sound_registry(spark), place.fact, place.trail, place.checkpoint,
            SETTINGS, unit="folder", max_files=None, once=True,
        ).awaitTermination()

    deliver(spark, place, "a", payment(1), payment(2), payment(2))
    step()
    deliver(spark, place, "b", payment(1, amount=200.0), payment(3))
    step()
    deliver(spark, place, "c", payment(1), payment(1, amount=200.0), payment(1, amount=300.0))
    step()
    step()
    assert facts(spark, place) == LANDED
    assert trail(spark, place) == {
        "a": ("COMPLETED", 3, 2), "b": ("COMPLETED", 2, 2), "c": ("COMPLETED", 3, 1),
    }
    # Notes of micro-batches go when they land; the manifest names them instead.
    assert subfolders(spark, f"{place.fact}/_streams") == []
    entries = landed_loads(spark, place.fact).collect()
    assert sorted((r.load_seq, r.micro_batch, r.rows) for r in entries) == [(0, 0, 2), (1, 1, 2), (2, 2, 1)]
    owner = entries[0].owner
    assert stream_load_seq(spark, place.fact, owner, 1) == 1


def test_stream_takes_single_files_in_the_order_they_were_written(spark, place):
    import os

    for number, amount in enumerate((100.0, 200.0, 300.0)):
        deliver(spark, place, f"part{number}", payment(1, amount=amount))
    os.makedirs(f"{place.inbox}-flat")
    for number in range(3):
        part = f"{place.inbox}/part{number}"
        name = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        target = f"{place.inbox}-flat/{9 - number}.parquet"
        with open(os.path.join(part, name), "rb") as source, open(target, "wb") as copy:
            copy.write(source.read())
        os.utime(target, (1_700_000_000 + number, 1_700_000_000 + number))
    ingest.start(
        spark, f"{place.inbox}-flat", sound_registry(spark), place.fact, place.trail,
        place.checkpoint, lambda: SETTINGS, once=True,
    ).awaitTermination()
    assert facts(spark, place) == {
        (some_id(1), "100.00"): (0, 0), (some_id(1), "200.00"): (1, 75), (some_id(1), "300.00"): (2, 75),
    }


def test_a_failing_load_fails_the_stream_and_can_be_repeated(spark, place):
    deliver(spark, place, "a", payment(1, payer_cnpj="9" * 14))

    def step(settings):
        return ingest.start(
            spark, place.inbox, sound_registry(spark), place.fact, place.trail, place.checkpoint,
            settings, unit="folder", max_files=None, once=True,
        ).awaitTermination()

    with pytest.raises(Exception, match="not landable"):
        step(SETTINGS)
    assert facts(spark, place) == {}
    step(replace(SETTINGS, reject_path=place.rejects))
    states = audit.current_state(spark.read.parquet(place.trail)).select("status").collect()
    assert sorted(r.status for r in states) == ["COMPLETED", "FAILED"]
    assert spark.read.parquet(place.rejects).count() == 1


def test_streams_and_batches_share_a_fact_table(spark, place):
    def stream(inbox, checkpoint):
        ingest.start(
            spark, inbox, sound_registry(spark), place.fact, place.trail, checkpoint,
            SETTINGS, unit="folder", max_files=None, once=True,
        ).awaitTermination()

    deliver(spark, place, "a", payment(1))
    run(spark, place)
    other = f"{place.inbox}-stream"
    payments(spark, payment(2)).coalesce(1).write.parquet(f"{other}/b")
    stream(other, place.checkpoint)
    payments(spark, payment(3)).coalesce(1).write.parquet(f"{place.inbox}-late/c")
    load_folder(
        spark, f"{place.inbox}-late", sound_registry(spark), place.fact, place.trail, SETTINGS, unit="folder"
    )
    payments(spark, payment(1, amount=200.0)).coalesce(1).write.parquet(f"{other}/d")
    stream(other, place.checkpoint)
    stream(other, f"{place.checkpoint}-second")
    assert facts(spark, place) == {
        (some_id(1), "100.00"): (0, 0), (some_id(2), "100.00"): (1, 0),
        (some_id(3), "100.00"): (2, 0), (some_id(1), "200.00"): (3, 75),
    }


def test_a_micro_batch_keeps_its_number(spark, place):
    assert stream_load_seq(spark, place.fact, "x", 0) == 0
    assert next_load_seq(spark, place.fact) == 1
    assert stream_load_seq(spark, place.fact, "y", 0) == 1
    assert stream_load_seq(spark, place.fact, "x", 0) == 0
    assert stream_load_seq(spark, place.fact, "x", 1) == 2


def test_a_load_broken_before_its_entry_is_not_read(spark, place, monkeypatch):
    """Whatever a crash leaves of a load, rows or rows and keys, it does not count."""
    from riskflow.operators import landing

    three_loads(spark, place)
    run(spark, place)
    left = facts(spark, place)
    assert left == LANDED
    rows = payments(spark, payment(1, amount=900.0), payment(9)).withColumns({"file": F.lit("d"), "file_seq": F.lit(0)})

    def crash(*_, **__):
        raise OSError("lost")

    for step in ("write_keys", "read_load"):
        with monkeypatch.context() as broken:
            broken.setattr(landing, step, crash)
            with pytest.raises(OSError):
                load_rows(rows, sound_registry(spark), place.fact, 3, SETTINGS)
        assert facts(spark, place) == left
        assert next_load_seq(spark, place.fact) == 4
    # The next load does not see what was broken, and the same one can be run again.
    assert load_rows(rows, sound_registry(spark), place.fact, 4, SETTINGS) == (2, 2)
    assert facts(spark, place)[some_id(9), "100.00"] == (4, 0)
    assert load_rows(rows, sound_registry(spark), place.fact, 3, SETTINGS) == (2, 2)


def test_a_load_that_breaks_while_it_is_replaced_is_taken_back(spark, place, monkeypatch):
    from riskflow.operators import landing

    rows = payments(spark, payment(1)).withColumns({"file": F.lit("a"), "file_seq": F.lit(0)})
    load_rows(rows, sound_registry(spark), place.fact, 0, SETTINGS)

    def crash(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(landing, "write_keys", crash)
        with pytest.raises(OSError):
            load_rows(rows, sound_registry(spark), place.fact, 0, SETTINGS)
    assert facts(spark, place) == {}
    load_rows(rows, sound_registry(spark), place.fact, 0, SETTINGS)
    assert set(facts(spark, place)) == {(some_id(1), "100.00")}


def test_no_lookup_for_a_rejected_load(spark, place):
    asked = []

    def lookup(companies):
        asked.extend(companies.collect())
        return sound_registry(spark)

    deliver(spark, place, "a", payment(1, payer_cnpj=None))
    with pytest.raises(Exception):
        run(spark, place, known=lookup)
    assert not asked


def test_running_settings_follow_the_clock():
    current = ingest.running_now(SETTINGS)()
    assert abs(datetime.now(timezone.utc) - current.run_time) < timedelta(minutes=1)
    late = datetime(2024, 1, 1, 2, tzinfo=timezone.utc)
    assert ingest.business_date(late) == date(2023, 12, 31)


# --- audit ------------------------------------------------------------------------


def test_audit_states(spark, place):
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    finish = start + timedelta(seconds=1, milliseconds=255)
    files = spark.createDataFrame([(0, "a"), (1, "b")], "file_seq int, file string")
    both = audit.begin(spark, place.trail, files, start)
    failing = audit.begin(spark, place.trail, files.where("file_seq = 1"), start)
    audit.begin(spark, place.trail, files.where("file_seq = 0"), start)
    measured = spark.createDataFrame([(0, 7, 5)], "file_seq int, total_rows long, inserted_rows long")
    audit.end(place.trail, both, audit.COMPLETED, start, finish, measured)
    audit.end(place.trail, failing, audit.FAILED, start, finish)
    rows = audit.current_state(spark.read.parquet(place.trail)).collect()
    state = sorted((r.file, r.status, r.total_rows, r.inserted_rows, str(r.duration_seconds)) for r in rows)
    assert state == [
        ("a", "COMPLETED", 7, 5, "1.26"), ("a", "PROCESSING", 0, 0, "0.00"),
        ("b", "COMPLETED", 0, 0, "1.26"), ("b", "FAILED", 0, 0, "1.26"),
    ]
    assert all((r.finished_at is None) == (r.status == "PROCESSING") for r in rows)


def test_load_ids_are_ordered_by_time(spark, place):
    import uuid

    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    files = spark.createDataFrame([(0, "a")], "file_seq int, file string")
    ids = [
        audit.begin(spark, place.trail, files, start + timedelta(milliseconds=n)).first().batch_id for n in range(4)
    ]
    assert ids == sorted(ids) and len(set(ids)) == 4 and all(uuid.UUID(i).version == 7 for i in ids)


# --- tables -----------------------------------------------------------------------


def test_absent_table_is_empty_and_other_errors_are_not_hidden(spark, folder):
    assert read_or_empty(spark, folder("none"), FACT).count() == 0
    with pytest.raises(Exception):
        read_or_empty(spark, "nosuchscheme://x/y", FACT).count()


def test_working_folders_are_below_the_shared_folder(spark):
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(shared_root(spark))


# --- command line -----------------------------------------------------------------


def test_command_line_load(spark, place, folder):
    from riskflow.__main__ import main

    deliver(spark, place, "a", payment(1))
    sound_registry(spark).write.parquet(folder("registry"))
    main([
        place.inbox, place.fact, place.trail, "--registry", folder("registry"),
        "--cache", folder("cache"), "--unit", "folder", "--one-job",
    ])
    assert set(facts(spark, place)) == {(some_id(1), "100.00")}
    assert spark.read.parquet(folder("cache")).count() == 2
