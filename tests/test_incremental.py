import os

import pytest
from pyspark.errors import StreamingQueryException

import frames
from tallybook.plans import clean
from tallybook.sources import files
from tallybook.streaming import incremental
from tallybook.streaming.ledger import Ledger


def test_batches_end_as_one_clean_table(spark, folder):
    first = [{"transaction_id": f"A{i}", "item": "Tea", "quantity": "5"} for i in range(3)]
    second = [{"transaction_id": "B0", "item": "Tea", "quantity": None},
              {"transaction_id": "A0", "item": "Tea", "quantity": "5"},
              {"transaction_id": "B1", "item": " ERROR ", "price_per_unit": "UNKNOWN"}]
    source, store = f"{folder}/in", f"{folder}/store"
    files.write_table(frames.raw(spark, *first), f"{source}/day=1", "csv")
    incremental.load_new_files(spark, f"{source}/day=*", store)
    assert incremental.clean_history(spark, store).count() == 3
    files.write_table(frames.raw(spark, *second), f"{source}/day=2", "csv")
    incremental.load_new_files(spark, f"{source}/day=*", store, files_per_batch=1)
    incremental.load_new_files(spark, f"{source}/day=*", store)  # nothing new
    whole = clean.clean_sales(frames.raw(spark, *first, *second))
    assert sorted(incremental.clean_history(spark, store).collect()) == sorted(whole.collect())
    assert whole.count() == 5


def test_original_column_names_load(spark, folder):
    source, store = f"{folder}/in", f"{folder}/store"
    raw = frames.raw(spark, {"transaction_id": "A"}, {"transaction_id": "B", "transaction_date": " 2023-01-06\t"})
    titled = raw.toDF(*[c.replace("_", " ").title() for c in raw.columns])
    files.write_table(titled.select(*reversed(titled.columns)), source, "csv")
    incremental.load_new_files(spark, source, store)
    assert incremental.clean_history(spark, store).count() == 2


def test_layouts_and_line_breaks_load_as_in_the_batch_reader(spark, folder):
    source = f"{folder}/in"
    os.makedirs(source)
    head = "Transaction ID,Item,Quantity,Price Per Unit,Total Spent,Payment Method,Location,Transaction Date"
    with open(f"{source}/a.csv", "w") as out:
        out.write(head + '\nA,Cake,2,3.00,6.00,Cash,"\nIn-Store\n",2023-01-05\n')
    turned = ",".join(reversed(head.split(",")))
    with open(f"{source}/b.csv", "w") as out:
        out.write(turned + ",Note\n2023-01-06,Takeaway,Cash,2,2,1,Tea,B,hello\n")
    whole = sorted(clean.clean_sales(files.read_raw_csv(spark, f"{source}/*.csv").drop("note")).collect())
    assert [r.location for r in whole] == ["In-Store", "Takeaway"]
    for per_batch in (None, 1):
        store = f"{folder}/store{per_batch}"
        incremental.load_new_files(spark, source, store, files_per_batch=per_batch)
        assert sorted(incremental.clean_history(spark, store).collect()) == whole
        ledger = Ledger(spark, f"{folder}/ledger{per_batch}")
        incremental.update_ledger(ledger, source, files_per_batch=per_batch)
        incremental.update_ledger(ledger, source)
        assert sorted(ledger.clean().collect()) == whole and ledger.rollup().count() == 2


def test_a_file_without_a_record_column_fails(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.csv", "w") as out:
        out.write("Transaction ID,Item\nA,Cake\n")
    with pytest.raises(StreamingQueryException, match="lacks columns"):
        incremental.load_new_files(spark, f"{folder}/in", f"{folder}/store")
