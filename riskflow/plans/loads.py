"""Loads: transactions in, fact rows and audit events out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.functions.rules import Rule, load_rules
from riskflow.operators import audit, inputs
from riskflow.operators.enrich import (
    Lookups,
    attributed,
    distinct_companies,
    enrich,
    lookups,
    unsound_companies,
    with_company_age,
)
from riskflow.operators.keyindex import (
    buckets_in,
    id_bitmaps,
    loads_to_read,
    possible_keys,
    read_filters,
    read_keys,
    touched,
)
from riskflow.operators.landed import has_loads
from riskflow.operators.landing import (
    FILE_SEQ,
    fingerprinted,
    next_load_seq,
    read_load,
    to_fact,
    write_load,
)
from riskflow.operators.mutation import keys_of_interest, resolve_history
from riskflow.operators.quality import require_landable, require_no_nulls, sound_input, with_violations
from riskflow.operators.scoring import score_history
from riskflow.operators.skew import BROADCAST_ROWS, HOT_ROWS, fits
from riskflow.schemas import FACT_KEY
from riskflow.sources.footers import refuse_nulls
from riskflow.sources.batches import EPOCHS_PER_FILE, assign_epochs, sorted_copy
from riskflow.sources.tables import CODEC, new_folder, working_tables, written
from riskflow.sources.transactions import load_name, paths, read_transactions, with_file_seq

#: Maps the distinct companies of a load to registry rows.
RegistryLookup = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class LoadSettings:
    """Parameters of a run. One ``as_of`` and one ``run_time`` hold for all of it."""

    as_of: date
    run_time: datetime
    rules: list[Rule] = field(default_factory=load_rules)
    batch_size: int | None = None
    """Rows per batch when mutations between batches of one file are to be flagged."""
    reject_path: str | None = None
    """Where rows that cannot land are put; without it such a row fails the load."""
    amount_style: str = "positional"
    load_filters: bool = False
    """Keep a membership bitmap per load and read only the keys of loads that may hold an id of the batch."""
    broadcast_rows: int = BROADCAST_ROWS
    hot_rows: int = HOT_ROWS


def enriched(
    transactions: DataFrame, registry: DataFrame, settings: LoadSettings, sides: DataFrame | None = None
) -> DataFrame:
    """Registry attributes of both companies, under the limits of the run."""
    aged = with_company_age(registry, settings.as_of)
    return enrich(transactions, aged, settings.broadcast_rows, settings.hot_rows, sides)


def with_epochs(transactions: DataFrame, settings: LoadSettings) -> DataFrame:
    """Epoch of every row: its file, or its batch of the sorted file."""
    if settings.batch_size is None:
        return transactions.withColumn("epoch", F.col("file_seq").cast("long"))
    path = new_folder(transactions.sparkSession, "sorted")
    tie = tuple(name for name in ("row_index",) if name in transactions.columns)
    ordered = sorted_copy(transactions, path, load="file_seq", tie=tie)
    return assign_epochs(ordered, settings.batch_size)


def resolved(
    rows: DataFrame, settings: LoadSettings, stored: DataFrame | None = None, ids: DataFrame | None = None,
    packed: bool = False,
) -> DataFrame:
    """New (id, payload) rows with ``mutated``, under the limits of the run."""
    return resolve_history(
        rows,
        stored=stored,
        broadcast_rows=settings.broadcast_rows,
        hot_rows=settings.hot_rows,
        ids=ids,
        packed=packed,
    )


def payload(transactions: DataFrame, settings: LoadSettings) -> DataFrame:
    """The columns that a fact row depends on, fingerprinted."""
    return fingerprinted(transactions, settings.amount_style).select(
        *FACT_KEY, "payer_cnpj", "receiver_cnpj", "amount", "epoch"
    )


def stored_keys(
    batch: DataFrame, rows: int, buckets: list[int], fact_path: str, load_seq: int, settings: LoadSettings
) -> DataFrame | None:
    """Keys that earlier loads hold for the ids of a batch, as a table; none before the first load.

    Only the ``buckets`` of the key index that the ids fall into are read. The ids of a batch beyond the limit of
    a broadcast meet the stored keys as a bitmap, so some keys of other ids are left among them.
    """
    spark = batch.sparkSession
    if not has_loads(spark, fact_path):
        return None
    keys = read_keys(spark, fact_path, buckets, load_seq)
    if settings.load_filters:
        possible = loads_to_read(read_filters(spark, fact_path, load_seq), id_bitmaps(batch))
        keys = keys.join(possible.select("load_seq").distinct(), "load_seq", "left_semi")
    if rows > settings.broadcast_rows:
        return possible_keys(keys.select(*FACT_KEY), batch, rows)
    return written(keys_of_interest(keys, batch, rows, settings.broadcast_rows), "stored-keys")


def told_apart(delivered: DataFrame, known: Lookups, settings: LoadSettings) -> tuple[DataFrame, DataFrame]:
    """Of payments with epochs, the payloads that never land, with attributes and ``violations``, and the others: as they
    are, or enriched where that needed a copy of them.

    Companies that fit a broadcast are attached to all rows. Else the companies with which no row can land are
    broadcast; rows are told apart before they are fingerprinted, and only the refused ones are shuffled for their
    attributes. If these do not fit either, the enriched rows are kept.
    """
    rows = payload(delivered, settings)
    found = F.size("violations") > 0
    if known.few_payers and known.few_receivers:
        marked = with_violations(attributed(rows, known))
        return marked.where(found), marked.where(~found).select(*rows.columns)
    payers, receivers = unsound_companies(known)
    if fits(payers, settings.broadcast_rows) and fits(receivers, settings.broadcast_rows):
        sound = sound_input()
        accepted, flagged = delivered.where(sound), delivered
        for unsound in (payers, receivers):
            key = unsound.columns[0]
            accepted = accepted.join(F.broadcast(unsound), key, "left_anti")
            flagged = flagged.join(F.broadcast(unsound.withColumn(f"_{key}", F.lit(True))), key, "left")
        some = flagged.where(~sound | F.col("_payer_cnpj").isNotNull() | F.col("_receiver_cnpj").isNotNull())
        return with_violations(attributed(payload(some, settings), known)).where(found), payload(accepted, settings)
    marked = written(with_violations(attributed(rows, known)), "batch", CODEC)
    return marked.where(found), marked.where(~found).drop("violations")


@dataclass(frozen=True)
class Landed:
    """What a load did: rows read, rows inserted, and both per ``file_seq``."""

    total_rows: int
    inserted_rows: int
    by_file: DataFrame


def land(
    transactions: DataFrame,
    registry: DataFrame | RegistryLookup,
    fact_path: str,
    load_seq: int,
    settings: LoadSettings,
    owner: str | None = None,
    micro_batch: int | None = None,
) -> Landed:
    """Land ``transactions`` (with ``file`` and ``file_seq``) as load ``load_seq``.

    The input is read more than once, and must be the same each time, as files are: what is read again
    needs no copy on the disks. The first pass checks for nulls, which the later ones need not do again, and counts the
    rows and the buckets of their ids. ``owner`` and ``micro_batch`` tell whose load it is if a stream runs it.
    """
    sound = require_no_nulls(transactions, "file")
    counted = F.count(F.lit(1))
    read = written(fingerprinted(sound).groupBy(FILE_SEQ).agg(
        counted.alias("total_rows"), touched(F.col("transaction_id")).alias("buckets")
    ), "counts")
    counts = read.agg(F.coalesce(F.sum("total_rows"), F.lit(0)).alias("rows"), F.bit_or("buckets").alias("buckets")).first()
    total, buckets = counts["rows"], buckets_in(counts["buckets"])
    # Nothing is looked up for a load that is going to be rejected.
    companies = registry(distinct_companies(transactions)) if callable(registry) else registry
    aged = written(with_company_age(companies, settings.as_of), "companies")
    limits = settings.broadcast_rows, settings.hot_rows
    delivered = with_epochs(transactions, settings)
    ids = fingerprinted(transactions).select("transaction_id")
    stored = stored_keys(ids, total, buckets, fact_path, load_seq, settings)
    known = lookups(transactions, aged, *limits)
    if settings.reject_path is None:
        # Duplicates go before the registry joins: every fact column follows from the
        # fingerprinted fields, the registry and the run time.
        new = resolved(payload(delivered, settings), settings, stored, ids, packed=True)
        landable = require_landable(attributed(new, known, packed=True))
    else:
        # Rows that never land must not count as earlier versions of an id, so they are
        # told apart before anything else.
        refused, accepted = told_apart(delivered, known, settings)
        refused.write.mode("overwrite").parquet(f"{settings.reject_path}/load_seq={load_seq}")
        if "payer_status" in accepted.columns:
            landable = resolved(accepted, settings, stored, ids)
        else:  # attributes are attached to what is left of the rows, whose keys stay packed between the shuffles
            landable = attributed(resolved(accepted, settings, stored, ids, packed=True), known, packed=True)
    scored = score_history(landable, settings.rules).withColumn(FILE_SEQ, file_of_epoch(settings))
    fact_rows = to_fact(scored, settings.run_time, FILE_SEQ)
    inserted = write_load(fact_rows, fact_path, load_seq, owner, micro_batch, settings.load_filters)
    held = read_load(transactions.sparkSession, fact_path, load_seq).groupBy(FILE_SEQ).agg(counted.alias("inserted_rows"))
    return Landed(total, inserted, read.select(FILE_SEQ, "total_rows").join(held, FILE_SEQ, "left"))


def load_rows(
    transactions: DataFrame,
    registry: DataFrame | RegistryLookup,
    fact_path: str,
    load_seq: int,
    settings: LoadSettings,
) -> tuple[int, int]:
    """:func:`land` without an audit trail; gives rows read and rows inserted."""
    with working_tables(transactions.sparkSession):
        done = land(transactions, registry, fact_path, load_seq, settings)
    return done.total_rows, done.inserted_rows


def audited_load(
    transactions: DataFrame,
    registry: DataFrame | RegistryLookup,
    fact_path: str,
    audit_path: str,
    load_seq: int,
    files: DataFrame,
    settings: LoadSettings,
    owner: str | None = None,
    micro_batch: int | None = None,
    whole: dict[str, list[str]] | None = None,
) -> int:
    """:func:`land` between audit events of each of ``files`` (``file, file_seq``).

    A failure is recorded for all of them, as they land together, and raised again. Working
    tables are removed either way. Where ``transactions`` are ``whole`` files (paths by load), those whose
    footers tell of nulls are refused before any data is read.
    """
    spark = transactions.sparkSession
    started = datetime.now(timezone.utc)
    begun = audit.begin(spark, audit_path, files, started)
    with working_tables(spark):
        try:
            for name, paths_of_load in (whole or {}).items():
                refuse_nulls(spark, paths_of_load, name)
            done = land(transactions, registry, fact_path, load_seq, settings, owner, micro_batch)
        except Exception:
            audit.end(audit_path, begun, audit.FAILED, started, datetime.now(timezone.utc))
            raise
        audit.end(audit_path, begun, audit.COMPLETED, started, datetime.now(timezone.utc), done.by_file)
    return done.total_rows


def file_of_epoch(settings: LoadSettings) -> Column:
    """Number of the file whose epoch a row has."""
    epoch = F.col("epoch") if settings.batch_size is None else F.floor(F.col("epoch") / EPOCHS_PER_FILE)
    return epoch.cast("int")


def load_folder(
    spark: SparkSession,
    input_path: str,
    registry: DataFrame | RegistryLookup,
    fact_path: str,
    audit_path: str,
    settings: LoadSettings,
    unit: str = "file",
    one_job: bool = False,
    resume: bool = False,
) -> int:
    """Load every file (or folder) below ``input_path`` in name order; gives rows read.

    By default loads follow one another, each published before the next starts, and the
    first failing one ends the run. ``one_job`` resolves all of them in a single job with
    the file number as epoch: the same fact rows, but published together or not at all,
    and the stored keys are read once instead of once per file. Either way there is one audit
    row per file. ``resume`` leaves out loads whose files have all landed as they are, and notes those it lands.
    """
    transactions = read_transactions(spark, input_path, unit)
    first = next_load_seq(spark, fact_path)
    whole: dict[str, list[str]] = {}
    for path in paths(transactions):
        whole.setdefault(load_name(spark, path, unit, input_path), []).append(path)
    names = sorted(whole)
    listing = None
    if resume:
        listed = [(path, name) for name in names for path in whole[name]]
        listing = written(inputs.described(
            spark, spark.createDataFrame(listed, "path string, file string"), len(listed)
        ), "listing")
        open_loads = {row["file"] for row in inputs.unfinished(listing, fact_path).collect()}
        names = [name for name in names if name in open_loads]
        if not names:
            return 0
    if one_job:
        files = spark.createDataFrame(list(enumerate(names)), f"{FILE_SEQ} int, file string")
        some = transactions if not resume else read_transactions(spark, [p for n in names for p in whole[n]], unit)
        numbered = with_file_seq(some, unit, input_path)
        total = audited_load(
            numbered, registry, fact_path, audit_path, first, files, settings, whole={n: whole[n] for n in names}
        )
        if listing is not None:
            inputs.finish(listing.where(F.col("file").isin(names)), fact_path, first)
        return total

    total = 0
    for position, name in enumerate(names):
        one = read_transactions(spark, f"{input_path}/{name}", unit)
        total += audited_load(
            one.withColumns({"file": F.lit(name), FILE_SEQ: F.lit(0)}),
            registry,
            fact_path,
            audit_path,
            first + position,
            spark.createDataFrame([(0, name)], f"{FILE_SEQ} int, file string"),
            settings,
            whole={name: whole[name]},
        )
        if listing is not None:
            inputs.finish(listing.where(F.col("file") == name), fact_path, first + position)
    return total
