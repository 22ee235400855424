import random

from pyspark.sql import functions as F, types as T

from builders import payment, payments, some_id
from riskflow.sources.batches import EPOCHS_PER_FILE, assign_epochs, number_batches, sorted_copy
from riskflow.sources.transactions import file_order, read_transactions, with_file_seq


def two_loads(spark, sizes=(57, 23)):
    dice = random.Random(1)
    rows = []
    for load, size in enumerate(sizes):
        numbers = list(range(size))
        dice.shuffle(numbers)
        rows += [(*payment(n), load) for n in numbers]
    frame = payments(spark, *[r[:-1] for r in rows])
    schema = frame.schema.add("file_seq", T.IntegerType())
    return spark.createDataFrame(rows, schema).repartition(7)


def test_sorted_copy_is_ordered_across_partitions(spark, folder):
    ordered = sorted_copy(two_loads(spark), folder("sorted"), load="file_seq")
    rows = ordered.orderBy("sort_key").select("file_seq", "transaction_id").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows) and len(rows) == 80


def test_batches_are_consecutive_and_start_anew_in_each_load(spark, folder):
    ordered = sorted_copy(two_loads(spark), folder("sorted"), load="file_seq")
    got = number_batches(ordered, 10, "file_seq").select("file_seq", "transaction_id", "batch_no").collect()
    want = {(load, f"trx_{some_id(n)}", n // 10) for load, size in ((0, 57), (1, 23)) for n in range(size)}
    assert {tuple(r) for r in got} == want


def test_epochs_grow_with_load_then_batch(spark, folder):
    ordered = sorted_copy(two_loads(spark), folder("sorted"), load="file_seq")
    got = assign_epochs(ordered, 30)
    assert "sort_key" not in got.columns
    assert {r.epoch for r in got.select("epoch").collect()} == {0, 1, EPOCHS_PER_FILE}


def test_copies_of_one_id_span_partitions_with_a_tie_column(spark, folder, shuffled_plans):
    rows = payments(spark, payment(1)).select("*", F.explode(F.sequence(F.lit(1), F.lit(4_000))).alias("row_index"))
    rows = rows.withColumn("file_seq", F.lit(0)).repartition(8)
    ordered = sorted_copy(rows, folder("sorted"), load="file_seq", tie=("row_index",))
    parts = ordered.select(F.shiftright("sort_key", 33).alias("p")).distinct().count()
    sizes = number_batches(ordered, 1_000, "file_seq").groupBy("batch_no").count().collect()
    assert parts > 1 and sorted(tuple(r) for r in sizes) == [(n, 1_000) for n in range(4)]


def test_files_are_numbered_in_name_order(spark, folder):
    import os
    import shutil

    os.makedirs(folder("in/below"))
    for name, size in (("b.parquet", 2), ("a.parquet", 3), ("B.parquet", 1)):
        part = folder(f"tmp-{name}")
        payments(spark, *[payment(i) for i in range(size)]).coalesce(1).write.parquet(part)
        written = next(f for f in os.listdir(part) if f.endswith(".parquet"))
        shutil.copy(os.path.join(part, written), folder(f"in/{name}"))
    shutil.copy(folder("in/a.parquet"), folder("in/below/c.parquet"))
    shutil.copy(folder("in/a.parquet"), folder("in/notes.txt"))
    rows = read_transactions(spark, folder("in"))
    assert [tuple(r) for r in file_order(rows).orderBy("file_seq").collect()] == [
        ("B.parquet", 0, 1), ("a.parquet", 1, 3), ("b.parquet", 2, 2),
    ]
    assert with_file_seq(rows).where("file = 'a.parquet'").select("file_seq").distinct().first()[0] == 1


def test_counting_files_reads_no_data_column(spark, folder):
    payments(spark, payment(1)).write.parquet(folder("in"))
    plan = file_order(read_transactions(spark, folder("in")))._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<>" in plan.toString()


def test_derived_keys_order_rows_but_are_not_stored(spark, folder):
    rows = spark.createDataFrame(
        [(f"x{i % 7}", f"d{i * 37 % 11}", i % 2, i) for i in range(60)], "transaction_id string, description string, file_seq int, row_index long"
    )
    keys = lambda key: {"transaction_id": F.reverse(key), "payload_hash": F.md5(F.concat(key, "description"))}
    ordered = sorted_copy(rows, folder("sorted"), load="file_seq", tie=("payload_hash", "row_index"), derived=keys)
    assert ordered.columns == [*rows.columns, "sort_key"]
    got = ordered.withColumns({f"_{name}": key for name, key in keys(F.col("transaction_id")).items()}).orderBy("sort_key").collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(tuple(r) for r in rows.collect())
    order = [(r.file_seq, r._transaction_id, r._payload_hash, r.row_index) for r in got]
    assert order == sorted(order) and len({r.sort_key for r in got}) == 60
