"""The registered queries: every operator of the package over the given tables.

Each takes a session and a table folder. Decimals are shown as doubles, dates as text
and instants as unix seconds, so that results compare across engines.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, FloatType, IntegerType, StructField, StructType, TimestampType

from riskflow.functions.dates import cache_expiry, seconds_to_expiry, time_ordered_id
from riskflow.functions.fingerprint import canonical_uuid, payload_hash, strip_prefix, with_packed_keys
from riskflow.functions import rule_checks
from riskflow.functions.rules import Rule, load_rules
from riskflow.operators import audit, enrich as companies, keyindex, quality
from riskflow.operators.landing import fingerprinted, new_rows, read_fact, to_fact
from riskflow.operators.mutation import flag_against
from riskflow.operators.scoring import rule_points, score, score_history
from riskflow.plans.loads import (
    LoadSettings,
    enriched as with_companies,
    load_folder,
    load_rows,
    payload,
    resolved,
    with_epochs,
)
from riskflow.schemas import AUDIT_EVENTS, FACT, FACT_KEY, REGISTRY_JSON_FIELDS, TRANSACTIONS
from riskflow.sources import cache, fixtures, footers, registry as registry_source
from riskflow.sources.batches import assign_epochs, number_batches, sorted_copy
from riskflow.sources.footers import NullsFound
from riskflow.sources.tables import CODEC, new_folder, read_or_empty, remove_files, written
from riskflow.sources.transactions import file_order, read_transactions, with_file_seq
from riskflow.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = LoadSettings(as_of=fixtures.AS_OF, run_time=fixtures.RUN_TIME)
BATCH_SIZE = 1_000

# Every operator, against literals and columns, with operands that may be null.
ALL_OPERATORS = [
    Rule("payer_status", "==", 1, "payer_active", value="ATIVO"),
    Rule("receiver_status", "!=", 2, "receiver_not_active", value="ATIVO"),
    Rule("payer_company_age", ">", 4, "payer_older", compare_column="receiver_company_age"),
    Rule("payer_company_age", "<", 8, "payer_younger", compare_column="receiver_company_age"),
    Rule("amount", ">=", 16, "amount_from_50k", value=50_000),
    Rule("amount", "<=", 32, "amount_within_capital", compare_column="payer_capital_stock"),
    Rule("payer_status", "==", 64, "same_status", compare_column="receiver_status"),
    Rule("payer_company_age", "!=", 128, "other_age", compare_column="receiver_company_age"),
    Rule("payer_company_age", ">=", 256, "payer_from_four_years", value=4),
    Rule("payer_capital_stock", "<", 512, "small_capital", value=20_000.5),
    Rule("payer_status", ">", 1024, "never", value=None),
]


def shown(frame: DataFrame) -> DataFrame:
    def column(field):
        value = F.col(field.name)
        if isinstance(field.dataType, (DecimalType, FloatType)):
            return value.cast("double").alias(field.name)
        if isinstance(field.dataType, DateType):
            return value.cast("string").alias(field.name)
        if isinstance(field.dataType, TimestampType):
            return F.unix_seconds(value).alias(field.name)
        return value

    return frame.select(*[column(field) for field in frame.schema.fields])


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(fixtures.transactions(spark, sf_dir))


def _aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.with_company_age(fixtures.registry(spark, sf_dir), fixtures.AS_OF)


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.enrich(_keyed(spark, sf_dir), _aged(spark, sf_dir))


def _now():
    return F.lit(fixtures.RUN_TIME)


# --- expressions ------------------------------------------------------------------


def strip_and_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    written_id = rows["transaction_id"]
    return rows.select(
        written_id.alias("written_id"),
        "file_seq",
        strip_prefix(written_id).alias("transaction_id"),
    ).withColumn("upper_id", F.upper("transaction_id")).select(
        "written_id", "file_seq", "transaction_id",
        canonical_uuid(F.col("upper_id")).alias("from_upper"),
        canonical_uuid(F.concat(F.lit("{"), F.replace("upper_id", F.lit("-"), F.lit("")), F.lit("}")))
        .alias("from_braces"),
        canonical_uuid(F.col("written_id")).alias("from_written"),
    )


def payload_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keyed(spark, sf_dir).select("transaction_id", "payload_hash", "file_seq")


def plain_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    stripped = rows.withColumn("transaction_id", strip_prefix(F.col("transaction_id")))
    return stripped.select("transaction_id", payload_hash("plain").alias("payload_hash"), "file_seq")


def _all_aged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every company of the tables, those that the registry of the loads lacks included."""
    return companies.with_company_age(fixtures.all_companies(spark, sf_dir), fixtures.AS_OF)


def company_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_all_aged(spark, sf_dir))


def cache_expiries(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    at = F.convert_timezone(
        F.lit("UTC"), F.current_timezone(), F.col("ts").cast("timestamp_ntz")
    ).cast("timestamp")
    spread = events.select(
        "event_id", F.timestamp_micros(F.unix_micros(at) + F.col("event_id") * 3_600_000_000).alias("at")
    )
    return spread.select(
        "event_id",
        F.unix_seconds(cache_expiry(F.col("at"))).alias("expires_at"),
        seconds_to_expiry(F.col("at")).alias("ttl"),
    )


# --- companies --------------------------------------------------------------------


def payer_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(companies.payer_view(_all_aged(spark, sf_dir)))


def receiver_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(companies.receiver_view(_all_aged(spark, sf_dir)))


ENRICHED_COLUMNS = (
    "transaction_id", "payload_hash", "file_seq", "payer_cnpj", "receiver_cnpj",
    "payer_status", "payer_company_age", "payer_capital_stock",
    "receiver_status", "receiver_company_age",
)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_enriched(spark, sf_dir).select(*ENRICHED_COLUMNS))


def enriched_with_repeated_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A registry that lists companies again, as they were or changed, multiplies no payment."""
    known = fixtures.registry(spark, sf_dir)
    number = F.substring("cnpj", 2, 13).cast("long")

    def changed(some: DataFrame, start: str) -> DataFrame:
        return some.withColumns({"status": F.lit("NULA"), "activity_start_date": F.lit(start)})

    repeated = (
        known.unionByName(known.where(number % 2 == 0))
        .unionByName(changed(known.where(number % 3 == 0), "1990-01-01"))
        .unionByName(changed(known.where(number % 5 == 1), "2023-12-31"))
    )
    aged = companies.with_company_age(repeated, fixtures.AS_OF)
    return shown(companies.enrich(_keyed(spark, sf_dir), aged).select(*ENRICHED_COLUMNS))


def distinct_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies.distinct_companies(fixtures.transactions(spark, sf_dir))


def _companies_and_live(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    live = registry_source.live_cache(fixtures.registry_cache(spark, sf_dir), _now())
    return distinct_companies(spark, sf_dir), live


def cache_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits, misses = registry_source.split_cache(*_companies_and_live(spark, sf_dir))
    return hits.select("cnpj", F.lit(True).alias("hit")).unionByName(
        misses.select("cnpj", F.lit(False).alias("hit"))
    )


def cache_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry_source.cache_stats(*_companies_and_live(spark, sf_dir))


def cache_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cache holds after a refresh: stale, live and new entries."""
    path = new_folder(spark, "cache")
    fixtures.registry_cache(spark, sf_dir).write.parquet(path)
    find = registry_source.from_snapshot(fixtures.registry(spark, sf_dir))
    registry_source.refresh_cache(distinct_companies(spark, sf_dir), path, find, _now())
    return shown(registry_source.read_cache(spark, path))


def cache_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of a cache of two versions, the second with later changes, after its compaction."""
    path = new_folder(spark, "cache")
    entries = fixtures.registry_cache(spark, sf_dir)
    number = F.substring("cnpj", 2, 13).cast("long")
    cache.append(entries, path)
    cache.append(entries.where(number % 4 == 0).withColumn("status", F.lit("NULA")), path)
    cache.compact(spark, path, fixtures.RUN_TIME)
    return shown(cache.live(spark, path, fixtures.RUN_TIME))


def registry_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of a batch: live cache entries and snapshot rows for the rest."""
    hits, misses = registry_source.split_cache(*_companies_and_live(spark, sf_dir))
    find = registry_source.from_snapshot(fixtures.registry(spark, sf_dir))
    return shown(registry_source.merged(hits, find(misses)))


def registry_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = registry_source.parse_registry_json(fixtures.registry_json(spark, sf_dir))
    return shown(valid)


def registry_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = registry_source.parse_registry_json(fixtures.registry_json(spark, sf_dir))
    return rejected


def registry_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing companies from a stand-in service that computes records from the number."""
    names = dict(REGISTRY_JSON_FIELDS)

    def service(cnpj: str) -> str:
        number = int(cnpj[1:])
        return json.dumps({
            names["status"]: "ATIVO" if number % 3 else "BAIXADA",
            names["activity_start_date"]: f"2020-01-{number % 28 + 1:02d}",
            names["capital_stock"]: number * 16,
        })

    _, misses = registry_source.split_cache(*_companies_and_live(spark, sf_dir))
    valid, _ = registry_source.parse_registry_json(registry_source.fetch_missing(misses, service))
    return shown(valid)


# --- rules ------------------------------------------------------------------------


def rule_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = load_rules()
    points = rule_points(_enriched(spark, sf_dir), rules)
    return points.select(*FACT_KEY, "file_seq", *[rule.reason for rule in rules])


def all_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_enriched(spark, sf_dir), ALL_OPERATORS).select(
        *FACT_KEY, "file_seq", "risk_score", "score_reasons"
    )


def rule_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a catalogue of rules, one per part, many of which are broken in some way."""
    found = rule_checks.rule_errors(fixtures.rule_entries(spark, sf_dir))
    return found.select("entry_no", F.array_join("violations", ", ").alias("violations"))


def risk_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(to_fact(score(_enriched(spark, sf_dir), SETTINGS.rules), SETTINGS.run_time))


# --- history ----------------------------------------------------------------------


def _history(rows: DataFrame, known: DataFrame, settings: LoadSettings) -> DataFrame:
    """Fact rows of payloads with epochs, nothing being stored yet."""
    new = with_companies(resolved(rows, settings), known, settings, sides=rows)
    return shown(to_fact(score_history(new, settings.rules), settings.run_time))


def risk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = payload(with_epochs(fixtures.transactions(spark, sf_dir), SETTINGS), SETTINGS)
    return _history(rows, fixtures.registry(spark, sf_dir), SETTINGS)


def risk_history_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same when nothing fits a broadcast and keys with two rows are hot, up to the most that may be."""
    tight = replace(SETTINGS, broadcast_rows=0, hot_rows=1)
    rows = payload(with_epochs(fixtures.transactions(spark, sf_dir), tight), tight)
    # Ids and companies are counted before the rows move, so the rows are kept instead of derived each time.
    return _history(written(rows, "payloads", CODEC), fixtures.registry(spark, sf_dir), tight)


def _delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fixtures.deliver(fixtures.transactions(spark, sf_dir), new_folder(spark, "delivered"))
    return read_transactions(spark, path, "folder")


def _sorted_loads(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """All loads sorted by id; rows of one id by fingerprint, copies by file position. Of the ``columns`` besides."""
    keyed = fingerprinted(with_file_seq(_delivered(spark, sf_dir), "folder"))
    return sorted_copy(
        keyed.select(*FACT_KEY, "file_seq", "row_index", *columns), new_folder(spark, "sorted"), load="file_seq", tie=("payload_hash", "row_index")
    )


def _sort_keys(written_id) -> dict:
    """Columns that payments are sorted by, from the stripped id and the other fields."""
    return {
        "transaction_id": F.coalesce(canonical_uuid(written_id), written_id),
        "payload_hash": payload_hash(transaction_id=written_id),
    }


def sorted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All loads sorted like :func:`_sorted_loads`. Whole payments are moved and stored, from which
    the fingerprint follows at any time, so that does not travel with them."""
    rows = with_file_seq(_delivered(spark, sf_dir), "folder").withColumn("transaction_id", strip_prefix(F.col("transaction_id")))
    ordered = sorted_copy(
        rows.select(*TRANSACTIONS.fieldNames(), "file_seq", "row_index"), new_folder(spark, "sorted"), load="file_seq",
        tie=("payload_hash", "row_index"), derived=_sort_keys,
    )
    keyed = ordered.withColumns(_sort_keys(F.col("transaction_id")))
    return shown(keyed.select(*TRANSACTIONS.fieldNames(), "file_seq", "payload_hash"))


def sorted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    batches = number_batches(_sorted_loads(spark, sf_dir), BATCH_SIZE, "file_seq")
    return batches.groupBy("file_seq", "batch_no").agg(
        F.count(F.lit(1)).alias("batch_rows"),
        F.min("transaction_id").alias("first_id"),
        F.max("transaction_id").alias("last_id"),
    )


def risk_history_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mutations between batches of one load count, too."""
    ordered = _sorted_loads(spark, sf_dir, "payer_cnpj", "receiver_cnpj", "amount")
    rows = assign_epochs(ordered, BATCH_SIZE, "file_seq")
    needed = rows.select(*FACT_KEY, "payer_cnpj", "receiver_cnpj", "amount", "epoch")
    return _history(needed, fixtures.registry(spark, sf_dir), SETTINGS)


def _first_loads_and_replay(spark: SparkSession, sf_dir: str, *columns: str) -> tuple[DataFrame, DataFrame]:
    keyed = written(_keyed(spark, sf_dir).select(*FACT_KEY, "file_seq", *columns), "keyed", CODEC)
    return keyed.where("file_seq < 3"), keyed.where("file_seq >= 3")


def mutation_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, arriving = _first_loads_and_replay(spark, sf_dir)
    return flag_against(arriving, stored).select(*FACT_KEY, "file_seq", "mutated")


def unseen_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, arriving = _first_loads_and_replay(spark, sf_dir, "payer_cnpj", "receiver_cnpj", "amount")
    return new_rows(arriving, stored).select(*FACT_KEY, "payer_cnpj", "receiver_cnpj", "amount")


def loads_to_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of many small loads hold ids of a batch: those whose bitmaps share a bit with it, then
    checked key by key. A load that a bitmap missed would be missing here.
    """
    keyed = _keyed(spark, sf_dir)
    receiver = F.substring("receiver_cnpj", 2, 13).cast("long")
    invoice = F.substring("invoice_id", 5, 20).cast("long")
    stored = keyed.where("file_seq < 4").select("transaction_id", F.pmod(receiver, F.lit(97)).alias("load_seq"))
    batch = keyed.where("file_seq = 4").where((receiver % 97 < 10) & (invoice % 30 == 0)).select("transaction_id")
    possible = keyindex.loads_to_read(keyindex.id_bitmaps(stored, "load_seq"), keyindex.id_bitmaps(batch))
    asked = stored.join(possible.select("load_seq").distinct(), "load_seq", "left_semi")
    return asked.join(batch.distinct(), "transaction_id", "left_semi").groupBy("load_seq").agg(
        F.countDistinct("transaction_id").alias("ids")
    )


# --- quality ----------------------------------------------------------------------


def _with_nulls(rows: DataFrame) -> DataFrame:
    """Blank out a different column in each load but the first."""
    blanks = {1: "amount", 2: "due_date", 3: "description", 4: "transaction_id"}
    invoice = F.substring("invoice_id", 5, 20).cast("long")
    part = (invoice % 10 == 3) | (invoice % 20 == 0)
    return rows.withColumns({
        name: F.when(~((F.col("file_seq") == load) & part), F.col(name))
        for load, name in blanks.items()
    })


def null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.null_counts(_with_nulls(fixtures.transactions(spark, sf_dir)), "file_seq")
    return report.withColumn("rejected", quality.has_nulls(report))


def footer_null_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from the footers of delivered files."""
    path = fixtures.deliver(_with_nulls(fixtures.transactions(spark, sf_dir)), new_folder(spark, "delivered"))
    report = footers.null_report(spark, path, "folder")
    number = F.substring("file", -4, 4).cast("int")
    return report.select(number.alias("file_seq"), *report.columns[1:])


def null_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_counts(_with_nulls(fixtures.transactions(spark, sf_dir)))


def null_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the loads that pass the gate, counted per load and method; most loads hold nulls."""
    # Each load is a job of its own: the loads are derived once, not once for each.
    rows = written(_with_nulls(fixtures.transactions(spark, sf_dir)), "loads", CODEC)
    rows = rows.withColumn("file", F.col("file_seq").cast("string"))
    passed = []
    for load in range(fixtures.LOADS):
        gated = quality.require_no_nulls(rows.where(F.col("file_seq") == load), "file")
        counted = gated.groupBy("file_seq", "payment_method").agg(F.count(F.lit(1)).alias("passed"))
        try:
            passed.append(written(counted, "gate"))
        except PySparkException as error:
            if "null values in" not in str(error):
                raise
    return reduce(DataFrame.unionByName, passed)


def _landing_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows, some with an oversized number, a long company or a broken id."""
    rows = score(_enriched(spark, sf_dir), SETTINGS.rules)
    invoice = F.substring("invoice_id", 5, 20).cast("long")
    return rows.withColumns({
        "amount": F.when(invoice % 101 == 1, F.lit(1e14)).otherwise(F.col("amount")),
        "receiver_cnpj": F.when(invoice % 103 == 2, F.concat("receiver_cnpj", F.lit("0")))
        .otherwise(F.col("receiver_cnpj")),
        "transaction_id": F.when(invoice % 107 == 3, F.concat(F.lit("x"), "transaction_id"))
        .otherwise(F.col("transaction_id")),
    })


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.split_landable(_landing_candidates(spark, sf_dir))
    return rejected.select(
        *FACT_KEY, "file_seq", F.array_join("violations", ",").alias("violations")
    )


def landing_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    landable, _ = quality.split_landable(_landing_candidates(spark, sf_dir))
    return shown(to_fact(landable, SETTINGS.run_time))


def key_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated keys among the delivered rows, and in a table that two inserts of unseen rows have filled."""
    rows = written(with_packed_keys(_keyed(spark, sf_dir).select(*FACT_KEY, "file_seq")), "keyed", CODEC)
    path = new_folder(spark, "inserted")
    kinds = rows.drop("file_seq").schema
    for number, part in enumerate((rows.where("file_seq < 3"), rows.where("file_seq >= 3"), rows.where("file_seq = 4"))):
        stored = read_or_empty(spark, path, StructType([*kinds, StructField("insert", IntegerType())])).drop("insert")
        # An insert is a folder of its own, so it reads the earlier ones and is written once.
        new_rows(part.drop("file_seq"), stored).write.parquet(f"{path}/insert={number}", compression=CODEC)
    stored = spark.read.schema(kinds).parquet(path)

    def summary(stage: str, frame: DataFrame, repeated: DataFrame) -> DataFrame:
        found = repeated.agg(
            F.count(F.lit(1)).alias("repeated_keys"), F.coalesce(F.sum("count"), F.lit(0)).alias("repeated_rows")
        )
        return found.withColumn("stage", F.lit(stage)).join(
            frame.agg(F.count(F.lit(1)).alias("all_rows"), F.first(F.lit(stage)).alias("stage")), "stage"
        )

    return summary("delivered", rows, quality.duplicate_keys(rows)).unionByName(
        summary("inserted", stored, quality.duplicate_keys(stored))
    )


# --- loads ------------------------------------------------------------------------


def files_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return file_order(_delivered(spark, sf_dir), "folder")


def _fact(spark: SparkSession, path: str) -> DataFrame:
    return shown(read_fact(spark, path))


def _quarantining(spark: SparkSession) -> LoadSettings:
    return replace(SETTINGS, reject_path=new_folder(spark, "rejects"))


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four loads in one job, the replay on top, then a load with changed amounts."""
    fact = new_folder(spark, "fact")
    rows = with_file_seq(_delivered(spark, sf_dir), "folder")
    changed = rows.where("file_seq < 4").where(
        F.substring("invoice_id", 5, 20).cast("long") % 10 == 1
    ).withColumn("amount", F.col("amount") + 1)
    known = fixtures.registry(spark, sf_dir)
    settings = _quarantining(spark)
    for load_seq, part in enumerate((rows.where("file_seq < 4"), rows.where("file_seq = 4"), changed)):
        load_rows(part, known, fact, load_seq, settings)
    return _fact(spark, fact)


def _folder_load(
    spark: SparkSession, rows: DataFrame, known: DataFrame, one_job: bool = False, failing: bool = False
):
    """Paths of the fact table and the audit trail of a folder load, which fails only if it is to."""
    fact, trail = new_folder(spark, "fact"), new_folder(spark, "audit")
    path = fixtures.deliver(rows, new_folder(spark, "delivered"))
    try:
        load_folder(
            spark, path, known, fact, trail, _quarantining(spark), unit="folder", one_job=one_job
        )
    except (PySparkException, NullsFound):
        if not failing:
            raise
    else:
        if failing:
            raise AssertionError("a load with nulls was accepted")
    return fact, trail


def folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    fact, _ = _folder_load(spark, rows, fixtures.registry(spark, sf_dir))
    return _fact(spark, fact)


def folder_load_in_one_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    fact, _ = _folder_load(spark, rows, fixtures.registry(spark, sf_dir), one_job=True)
    return _fact(spark, fact).drop("load_seq")


def resumed_folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that ends at a bad load; once that is delivered anew, a resumed run takes it and what follows."""
    inbox, fact, trail = (new_folder(spark, name) for name in ("inbox", "fact", "audit"))
    for load in range(fixtures.LOADS):
        rows = fixtures.transactions(spark, sf_dir, load)
        fixtures.deliver(_with_nulls(rows) if load == 2 else rows, f"{inbox}/day={load}")
    settings, known = _quarantining(spark), fixtures.registry(spark, sf_dir)

    def go_on() -> int:
        return load_folder(spark, inbox, known, fact, trail, settings, unit="folder", resume=True)

    try:
        go_on()
    except (PySparkException, NullsFound):
        remove_files(spark, inbox, ["day=2"])
    fixtures.deliver(fixtures.transactions(spark, sf_dir, 2), f"{inbox}/day=2")
    go_on()
    if go_on():
        raise AssertionError("loads that have landed were taken again")
    return _fact(spark, fact)


def _trail(spark: SparkSession, path: str) -> DataFrame:
    state = audit.current_state(read_or_empty(spark, path, AUDIT_EVENTS))
    name = F.element_at(F.split("file", "/"), -1)
    return state.select(name.alias("file"), "status", "total_rows", "inserted_rows")


def folder_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fixtures.transactions(spark, sf_dir)
    _, trail = _folder_load(spark, rows, fixtures.registry(spark, sf_dir))
    return _trail(spark, trail)


def one_job_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows when all files are one job."""
    rows = fixtures.transactions(spark, sf_dir)
    _, trail = _folder_load(spark, rows, fixtures.registry(spark, sf_dir), one_job=True)
    return _trail(spark, trail)


def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows when a stream picks the files up."""
    _, trail = _stream_after(spark, sf_dir, 0)
    return _trail(spark, trail)


def failing_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load holds nulls: it is recorded as failed and nothing follows it."""
    rows = _with_nulls(fixtures.transactions(spark, sf_dir))
    _, trail = _folder_load(spark, rows, fixtures.registry(spark, sf_dir), failing=True)
    return _trail(spark, trail)


def audit_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(audit.current_state(fixtures.audit_events(spark, sf_dir)))


def load_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    started = fixtures.audit_events(spark, sf_dir).where("event_no = 0")
    return started.select(
        "file", time_ordered_id(F.col("started_at"), F.col("batch_id")).alias("load_id")
    )


def _stream_after(spark: SparkSession, sf_dir: str, batch_loads: int) -> tuple[str, str]:
    """Paths of the fact table and the audit trail after the first loads by a folder load and
    each later one as a micro-batch of a stream."""
    rows = fixtures.transactions(spark, sf_dir)
    inbox, fact, trail, checkpoint = (
        new_folder(spark, name) for name in ("inbox", "fact", "audit", "stream")
    )
    known = fixtures.registry(spark, sf_dir)
    settings = _quarantining(spark)
    if batch_loads:
        first = fixtures.deliver(
            rows.where(F.col("file_seq") < batch_loads), new_folder(spark, "delivered")
        )
        load_folder(spark, first, known, fact, trail, settings, unit="folder")
    for load in range(batch_loads, fixtures.LOADS):
        fixtures.deliver(fixtures.transactions(spark, sf_dir, load), f"{inbox}/arrival={load}")
        ingest.start(
            spark, inbox, known, fact, trail, checkpoint, settings,
            unit="folder", max_files=None, once=True,
        ).awaitTermination()
    return fact, trail


def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads arrive one by one and a stream picks each up as one micro-batch."""
    return _fact(spark, _stream_after(spark, sf_dir, 0)[0])


def batch_then_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder load and a stream share one fact table."""
    return _fact(spark, _stream_after(spark, sf_dir, 3)[0])


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        risk_scored, risk_history, risk_history_split, risk_history_batched, incremental_load,
        folder_load, resumed_folder_load, folder_load_in_one_job, folder_load_audit, one_job_audit, stream_audit,
        failing_load_audit, stream_load,
        batch_then_stream_load,
        strip_and_hash, payload_fingerprint, plain_fingerprint, company_age, cache_expiries,
        payer_roles, receiver_roles, enriched, enriched_with_repeated_companies, distinct_companies, cache_split, cache_stats,
        cache_refresh, cache_compacted, registry_merged, registry_parsed, registry_rejected, registry_fetched,
        rule_columns, rule_errors, all_operators, mutation_check, unseen_rows, loads_to_read, sorted_rows, sorted_batches,
        null_report, footer_null_report, null_totals, null_gate, landing_rejects, landing_accepted, key_uniqueness,
        files_processed, audit_state, load_ids,
    )
}
