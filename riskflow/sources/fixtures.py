"""Payments, registry and audit events derived from the order tables.

The tables at hand hold no payments. Each order line becomes a payment of its customer
to its supplier; lines that repeat an (order, line) pair become changed payloads of one
transaction id. Everything grows with the tables.
"""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskflow.schemas import REGISTRY_JSON_FIELDS, TRANSACTIONS
from riskflow.sources.tables import CODEC, configured

AS_OF = date(2024, 1, 1)
RUN_TIME = datetime(2024, 1, 1, 12, 0, tzinfo=timezone.utc)
LOADS = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _company(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), 13, "0"))


def _hyphenated(digits: Column) -> Column:
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digits, at, size) for at, size in cuts])


def transactions(spark: SparkSession, sf_dir: str, load: int | None = None) -> DataFrame:
    """Input columns plus ``file_seq``: four loads, and a fifth that repeats rows of them.

    Of one ``load``, only its own lines are shuffled.
    """
    lines = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"
    )
    supplier_load = (F.col("l_suppkey") % 4).cast("int")
    replayed = F.array(supplier_load, F.lit(LOADS - 1))
    loads = F.when(F.col("l_orderkey") % 10 == 0, replayed).otherwise(F.array(supplier_load))
    if load is not None:
        lines = lines.where(F.array_contains(loads, load))
        loads = F.array(F.lit(load))
    # The given table is one row group: dealt out once, at any size, by the key that the join needs.
    lines = lines.repartition("l_orderkey")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    digest = F.md5(F.concat(order.cast("string"), F.lit("-"), line.cast("string")))
    shipped = F.replace(F.col("l_shipdate").cast("string"), F.lit(" "), F.lit("T"))
    price = F.col("l_extendedprice")
    return lines.join(orders, order == F.col("o_orderkey")).select(
        F.concat(F.lit("trx_"), _hyphenated(digest)).alias("transaction_id"),
        F.concat(shipped, F.lit("-03:00")).alias("event_timestamp"),
        _company("1", F.col("o_custkey")).alias("payer_cnpj"),
        _company("2", F.col("l_suppkey")).alias("receiver_cnpj"),
        F.concat(F.lit("INV-"), order.cast("string")).alias("invoice_id"),
        # Some amounts lie above ten million, where Spark's own text has an exponent.
        F.when(order % 97 == 5, price * 1024).when(line == 1, price * 4).otherwise(price).alias("amount"),
        F.when(line % 3 == 0, "PIX").when(line % 3 == 1, "TED").otherwise("BOLETO")
        .alias("payment_method"),
        F.col("l_shipdate").cast("date").alias("due_date"),
        F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("description"),
        F.explode(loads).alias("file_seq"),
    )


def _registry_rows(
    rows: DataFrame, prefix: str, key: str, balance: str, status: Column, days: Column
) -> DataFrame:
    return rows.select(
        _company(prefix, F.col(key)).alias("cnpj"),
        status.alias("status"),
        F.date_sub(F.lit(AS_OF), days.cast("int")).cast("string").alias("activity_start_date"),
        (F.abs(balance) * 16).cast("float").alias("capital_stock"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The companies that loads can look up: one payer in fifty is not registered, so that
    enrichment and cache meet companies without a record."""
    number = F.substring("cnpj", 2, 13).cast("long")
    return all_companies(spark, sf_dir).where(F.startswith("cnpj", F.lit("2")) | (number % 50 != 49))


def all_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and suppliers as companies."""
    customer, supplier = F.col("c_custkey"), F.col("s_suppkey")
    payers = _registry_rows(
        _table(spark, sf_dir, "customer"),
        "1", "c_custkey", "c_acctbal",
        F.when(customer % 10 == 0, "BAIXADA").when(customer % 10 == 1, "SUSPENSA")
        .otherwise("ATIVO"),
        (customer * 37) % 3000,
    )
    receivers = _registry_rows(
        _table(spark, sf_dir, "supplier"),
        "2", "s_suppkey", "s_acctbal",
        F.when(supplier % 8 == 3, "INAPTA").otherwise("ATIVO"),
        (supplier * 41) % 2500,
    )
    return payers.unionByName(receivers)


def registry_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the registry as cache entries, half of those expired at the run time."""
    number = F.substring("cnpj", 2, 13).cast("long")
    expiry = F.when(number % 3 == 0, "2024-01-15 03:00:00").otherwise("2023-12-15 03:00:00")
    return registry(spark, sf_dir).where(number % 3 != 2).withColumn(
        "expires_at", F.to_timestamp(F.concat(expiry, F.lit("+00:00")))
    )


def registry_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw registry records of all customers, some with a missing or mistyped field."""
    key = F.col("c_custkey")
    status = F.when(key % 10 == 0, "BAIXADA").otherwise("ATIVO")
    start = F.date_sub(F.lit(AS_OF), ((key * 37) % 3000).cast("int")).cast("string")
    whole = (F.abs("c_acctbal") * 100).cast("long")
    names = REGISTRY_JSON_FIELDS
    fields = F.concat_ws(
        ",",
        F.when(key % 7 != 3, F.concat(F.lit(f'"{names["status"]}":"'), status, F.lit('"'))),
        F.when(key % 11 == 4, F.concat(F.lit(f'"{names["activity_start_date"]}":'), key))
        .otherwise(F.concat(F.lit(f'"{names["activity_start_date"]}":"'), start, F.lit('"'))),
        F.when(key % 13 == 5, F.lit(f'"{names["capital_stock"]}":null'))
        .otherwise(F.concat(F.lit(f'"{names["capital_stock"]}":'), whole)),
    )
    record = F.concat(F.lit("{"), fields, F.when(key % 17 == 6, F.lit("")).otherwise(F.lit("}")))
    return _table(spark, sf_dir, "customer").select(
        _company("1", key).alias("cnpj"), record.alias("raw")
    )


def rule_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule per part as JSON text; by remainders of the key fields are missing, unknown or mistyped."""
    key = F.col("p_partkey")

    def put(name: str, value: Column, present: Column | None = None) -> Column:
        text = F.concat(F.lit(f'"{name}":'), value)
        return text if present is None else F.when(present, text)

    fields = F.concat_ws(
        ",",
        put("column", F.when(key % 5 == 1, F.lit('"colour"')).otherwise(F.lit('"amount"')), key % 7 != 2),
        put("operator", F.when(key % 11 == 3, F.lit('"=>"')).otherwise(F.lit('">="')), key % 13 != 4),
        put("points", F.when(key % 3 == 1, F.lit("2.5")).when(key % 3 == 2, F.lit('"10"')).otherwise(F.lit("10")), key % 17 != 5),
        put("reason", F.concat(F.lit('"r'), key.cast("string"), F.lit('"')), key % 19 != 6),
        put("value", key.cast("string"), key % 4 != 3),
        put("compare_column", F.lit('"size"'), key % 23 == 7),
    )
    entry = F.when(key % 29 == 8, F.lit("[1]")).when(key % 31 == 9, F.lit("{")).otherwise(F.concat(F.lit("{"), fields, F.lit("}")))
    # The given table is one row group: dealt out, so that not one task writes and checks all entries.
    parts = _table(spark, sf_dir, "part").select("p_partkey").repartition("p_partkey")
    return parts.select(key.alias("entry_no"), entry.alias("entry"))


def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load per order: started, and by order status completed, failed or still open."""
    orders = _table(spark, sf_dir, "orders")
    key, state = F.col("o_orderkey"), F.col("o_orderstatus")
    started = F.col("o_orderdate").cast("timestamp_ntz")
    batch_id = F.md5(key.cast("string"))
    common = (
        batch_id.alias("batch_id"),
        F.concat(F.lit("file_"), key.cast("string"), F.lit(".parquet")).alias("file"),
        F.convert_timezone(F.lit("UTC"), F.current_timezone(), started).cast("timestamp")
        .alias("started_at"),
    )
    begin = orders.select(
        *common, F.lit(0).alias("event_no"), F.lit("PROCESSING").alias("status"),
        F.lit(None).cast("long").alias("total_rows"),
        F.lit(None).cast("long").alias("inserted_rows"),
        F.lit(None).cast("timestamp").alias("finished_at"),
    )
    millis = (key % 100_000) * 10
    finished = F.timestamp_micros(F.unix_micros("started_at") + millis * 1000)
    done = state == "F"
    end = orders.where(state != "O").select(*common, "o_orderkey", "o_orderstatus").select(
        "batch_id", "file", "started_at", F.lit(1).alias("event_no"),
        F.when(done, "COMPLETED").otherwise("FAILED").alias("status"),
        F.when(done, key % 1000).alias("total_rows"),
        F.when(done, key % 700).alias("inserted_rows"),
        finished.alias("finished_at"),
    )
    return begin.unionByName(end)


def deliver(rows: DataFrame, path: str) -> str:
    """Write payments as one folder of part files per load (``load_000N``-like names).

    A task keeps a file per load open. Else it would sort its payments by load, and these are many times as wide
    as the lines that were shuffled for them. It does sort what is left once it has as many files as are allowed.
    """
    named = rows.select(*TRANSACTIONS.fieldNames(), F.format_string("%04d", "file_seq").alias("load"))
    with configured(rows.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(2 * LOADS)):
        named.write.partitionBy("load").parquet(path, compression=CODEC)
    return path
