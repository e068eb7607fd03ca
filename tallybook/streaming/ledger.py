"""Clean sales and their daily rollup, kept up to date batch by batch.

Records lie in monthly buckets, each distinct one once, with a fingerprint. A batch is compared with the
buckets of its own months only, since copies of a record have its date. Complete records and those with
gaps are kept apart: the former never change again, the latter follow the statistics that fill them.

The rows of a batch travel once, to the slot of their day (``Ledger._days``), where copies meet each other and
the fingerprints of the history, and are written once. Filled records can only become equal if all columns that are
never filled agree. Records of which the hash of these, their ``kin``, is shared with another record are listed, and
only they are compared again; all others are counted and read where they lie.

The rollup is a sum of signed changes. A batch adds its new records, and where a statistic has changed it
takes back the old filling of the gaps concerned and adds the new one, in the months that have such gaps.
Nothing else of the history is read. A largest bill cannot be taken back, so groups that lose a record get
theirs anew from the months touched.

Tables below the store, each with a folder per batch: ``records`` (by kind and month: ``complete``, ``gaps`` and
``known``, which are copies of records of earlier batches and only counted), ``shared`` (kins of several records),
``counts`` (value counts so far), ``by_item`` and ``overall`` (statistics), ``gap_index`` (which gaps a month has),
``changes`` (of the rollup, by month) and, written last, ``batches``: only batches listed there count, so
an interrupted one leaves no trace, and repeating it overwrites its own folders.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from tallybook.config import COGS_RATE
from tallybook.operators import aggregates, features, imputation
from tallybook.sources import files
from tallybook.sources.staging import stage_table

FILLED = ("item", "quantity", "price_per_unit", "payment_method", "location")
KINDS = ("complete", "gaps", "known")
# Rows of a slot: fewer would make many small files, and a task that sorts more may have to spill them.
SLOT_ROWS, MOST_ROWS = 50_000, 500_000
# A value of each filled column that no statistic changes.
_PRESENT = {"item": "", "quantity": 0, "price_per_unit": 0, "payment_method": "", "location": ""}


def _month(date: str = "transaction_date") -> Column:
    return F.year(date) * 100 + F.month(date)


def _gap() -> Column:
    """True where a record has something to fill."""
    return F.greatest(*[F.col(c).isNull() for c in FILLED])


class Ledger:
    """A store of clean sales under one folder; ``rates`` are the cost rates of its rollup."""

    def __init__(self, spark: SparkSession, store: str, price_median: str = "raw",
                 rates: Mapping[str, str] | None = None, default_rate: str = COGS_RATE):
        self.spark, self.store, self.price_median = spark, store.rstrip("/"), price_median
        self.rates, self.default_rate = rates, default_rate

    # --- stored tables ------------------------------------------------------------------

    def batches(self) -> list[int]:
        """Numbers of the batches that are complete."""
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.store}/batches/batch=*/_SUCCESS")
        found = path.getFileSystem(conf).globStatus(path)
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def _path(self, table: str, batch: int) -> str:
        return f"{self.store}/{table}/batch={batch}"

    def _write(self, df: DataFrame, table: str, batch: int, by_month: bool = False) -> None:
        files.write_table(df, self._path(table, batch), "parquet", ("month",) if by_month else ())

    def _folders(self, table: str, batches: list[int]) -> tuple[str, list[str]]:
        """A table's folder and those of some batches; a batch without records of a kind has none."""
        if table not in KINDS:
            return f"{self.store}/{table}", [self._path(table, b) for b in batches]
        jvm, conf = self.spark._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.store}/records/batch=*/kind={table}")
        found = path.getFileSystem(conf).globStatus(path)
        there = {f.getPath().getParent().getName() for f in found or []}
        return f"{self.store}/records", [
            f"{self._path('records', b)}/kind={table}" for b in batches if f"batch={b}" in there]

    def _read(self, table: str, schema: T.StructType, batches: list[int],
              months: list[int] | None = None) -> DataFrame:
        """Rows of some batches, of the given months' folders only."""
        base, folders = self._folders(table, batches)
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", base).parquet(*folders)
        rows = rows if months is None else rows.where(F.col("month").isin(months))
        return rows.select(*schema.names)

    def _schema(self, batch: int, table: str = "records") -> T.StructType:
        """Columns of the records, which are those of the clean table but the total, or of the changes."""
        noted = self.spark.read.parquet(self._path("batches", batch)).first()
        return T.StructType.fromJson(json.loads(noted[table]))

    def _statistics(self, batch: int) -> imputation.Statistics:
        return imputation.Statistics(*(self.spark.read.parquet(self._path(t, batch)) for t in ("by_item", "overall")))

    @staticmethod
    def _stored(schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField("copies", T.LongType()),
                             T.StructField("fingerprint", T.BinaryType()), T.StructField("month", T.IntegerType())])

    # --- rows ----------------------------------------------------------------------------

    @staticmethod
    def _typed(df: DataFrame, schema: T.StructType, *others: str) -> DataFrame:
        """The record's columns in their types, and ``others`` as they are."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *others)

    @staticmethod
    def _fingerprint(schema: T.StructType) -> Column:
        whole = F.to_json(F.struct(*schema.names), {"ignoreNullFields": "false"})
        return F.unhex(F.md5(whole.cast("binary")))

    @staticmethod
    def _kin(schema: T.StructType) -> Column:
        """Hash of the columns that are never filled: records that become equal have the same."""
        return F.xxhash64(*[n for n in schema.names if n not in FILLED])

    def _filled(self, gaps: DataFrame, statistics: imputation.Statistics, schema: T.StructType,
                *others: str) -> DataFrame:
        rows = gaps.withColumn("total_spent", F.lit(None).cast("decimal(18,2)"))
        return self._typed(imputation.fill_gaps(rows, statistics), schema, *others)

    def _refilled(self, gaps: DataFrame, old: imputation.Statistics, new: imputation.Statistics,
                  schema: T.StructType) -> DataFrame:
        """Records with gaps as they were filled and as they are now, with ``old`` and ``new``: 1 where it holds."""
        def row(of: str, old: int, new: int) -> Column:
            return F.struct(*[F.col(f"{of}.{n}").alias(n) for n in schema.names],
                            F.lit(old).alias("old"), F.lit(new).alias("new"))

        was = self._filled(gaps.select(*schema.names, "month", F.struct(*schema.names).alias("record")), old, schema,
                           "month", "record")
        was = was.select("month", "record.*", F.struct(*schema.names).alias("was"))
        both = self._filled(was, new, schema, "month", "was").select("month", "was", F.struct(*schema.names).alias("now"))
        same = F.col("was").eqNullSafe(F.col("now"))
        rows = F.when(same, F.array(row("now", 1, 1))).otherwise(F.array(row("was", 1, 0), row("now", 0, 1)))
        return both.select("month", F.explode(rows).alias("row")).select("month", "row.*")

    def _gap_index(self, gaps: DataFrame) -> DataFrame:
        """Which gaps the records of a month have; one row per month, item and kind of gap."""
        missing = [F.col(c).isNull().alias(f"no_{c}") for c in FILLED]
        return gaps.groupBy("month", F.col("item"), *missing).agg(F.count(F.lit(1)).alias("n"))

    def _refilled_months(self, index: DataFrame, old: imputation.Statistics,
                         new: imputation.Statistics) -> list[int]:
        """Months with gaps that the new statistics fill in another way."""
        kinds = index.select("month", *[
            F.when(~F.col(f"no_{c}"), F.col("item") if c == "item" else F.lit(_PRESENT[c])).alias(c) for c in FILLED])
        kinds = kinds.distinct().withColumn("total_spent", F.lit(None)).withColumn("kind", F.struct(*FILLED))

        def fill(statistics: imputation.Statistics, name: str) -> DataFrame:
            return imputation.fill_gaps(kinds, statistics).select("month", "kind", F.struct(*FILLED).alias(name))

        sides = fill(old, "value").unionByName(fill(new, "value"))
        changed = sides.groupBy("month", "kind").agg(F.count_distinct(F.to_json("value")).alias("n")).where("n > 1")
        return [r.month for r in changed.select("month").distinct().collect()]  # as many as the calendar has

    # --- a batch ---------------------------------------------------------------------------

    def _days(self, counted: DataFrame, history: DataFrame | None) -> tuple[DataFrame, int]:
        """The batch's dates, each with the first of its ``slots``, and how many slots there are.

        Slots are equal shares of the rows, along the calendar: rows gathered by slot have few days, so they are
        written in few files, and are many in their groups of the rollup. A day with many rows has several slots.
        """
        if history is not None:
            held = history.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("held"))
            counted = stage_table(counted.join(held, "transaction_date", "left").select(
                "transaction_date", (F.col("n") + F.coalesce("held", F.lit(0))).alias("n")), "days")
        rows = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        slots = max(1, min(tasks, -(-rows // SLOT_ROWS)), -(-rows // MOST_ROWS))
        # One row per date; the window is over these alone.
        upto = F.sum("n").over(Window.orderBy("transaction_date"))
        first, last = (F.floor(at * slots / F.lit(rows)).cast("int") for at in (upto - F.col("n"), upto - 1))
        days = counted.select("transaction_date", first.alias("slot"), (last - first + 1).alias("slots"))
        return stage_table(days, "slots"), slots

    def _placed(self, rows: DataFrame, days: DataFrame, schema: T.StructType, how: str, *columns: Column) -> DataFrame:
        """``columns`` of the rows, with the slot of their day."""
        slot = F.coalesce(F.col("slot") + F.pmod(self._kin(schema), F.col("slots")).cast("int"), F.lit(0))
        return rows.join(days, "transaction_date", how).select(slot.alias("slot"), *columns)

    def _arrived(self, standardised: DataFrame, days: DataFrame, slots: int, schema: T.StructType,
                 history: DataFrame | None) -> DataFrame:
        """The batch's distinct records with their kind, gathered by slot.

        The rows and the fingerprints of the history travel together, once: copies of a record have its day and so
        its slot. A record's own fingerprint, which its columns decide, need not travel.
        """
        none = F.lit(None)
        rows = self._placed(self._typed(standardised, schema), days, schema, "left",
                            *[F.col(n) for n in schema.names], none.cast("binary").alias("held"))
        if history is not None:
            rows = rows.unionByName(self._placed(
                history, days, schema, "inner", *[none.cast(f.dataType).alias(f.name) for f in schema.fields],
                F.col("fingerprint").alias("held")))
        rows = (
            rows.repartitionById(slots, "slot").groupBy("slot", "held", *schema.names).agg(F.count(F.lit(1)).alias("copies"))
            .withColumns({"fingerprint": F.coalesce("held", self._fingerprint(schema)), "month": _month()}))
        kind = F.when(_gap(), "gaps").otherwise("complete")
        if history is not None:
            found = F.max(F.col("held").isNotNull()).over(Window.partitionBy("slot", "fingerprint"))
            rows = rows.withColumn("found", found).where(F.col("held").isNull())
            kind = F.when(F.col("found"), "known").otherwise(kind)
        return rows.withColumn("kind", kind)

    def apply(self, standardised: DataFrame, batch: int) -> None:
        """Takes in a batch of standardised records, which are read twice: for their dates and for the rows."""
        done = [b for b in self.batches() if b < batch]
        last = done[-1] if done else None
        schema = self._schema(last) if done else standardised.drop("total_spent").schema
        stored = self._stored(schema)

        dates = stage_table(self._typed(standardised, schema).groupBy("transaction_date").agg(
            F.count(F.lit(1)).alias("n")), "dates")
        months = [r.month for r in dates.select(_month().alias("month")).distinct().collect()]
        # New records: the fingerprints of the batch's own days are all that travels of the history.
        history = self._read("complete", stored, done, months).unionByName(
            self._read("gaps", stored, done, months)) if done else None
        days, slots = self._days(dates, history)
        arrived = self._arrived(standardised, days, slots, schema, history).select(*stored.names, "kind")
        files.write_table(arrived, self._path("records", batch), "parquet", ("kind", "month"), rebalance=False)
        self._write(self._gap_index(self._read("gaps", stored, [batch])), "gap_index", batch)
        self._write(self._shared(stored, schema, [*done, batch], months, days), "shared", batch)

        taken = self._read(KINDS[0], stored, [batch])
        for k in KINDS[1:]:
            taken = taken.unionByName(self._read(k, stored, [batch]))
        counts = imputation.value_counts(taken, "copies")
        if done:
            before = self.spark.read.parquet(self._path("counts", last))
            counts = imputation.merge_counts(before.unionByName(counts))
        self._write(counts, "counts", batch)
        counts = self.spark.read.parquet(self._path("counts", batch))
        self._write(imputation.item_statistics(counts), "by_item", batch)
        by_item = self.spark.read.parquet(self._path("by_item", batch))
        self._write(imputation.flat(stage_table(
            imputation.overall_statistics(counts, by_item, self.price_median), "overall")), "overall", batch)

        refilled = []
        if done:
            index = self.spark.read.option("basePath", f"{self.store}/gap_index").parquet(
                *[self._path("gap_index", b) for b in done])
            refilled = self._refilled_months(index, self._statistics(last), self._statistics(batch))
        changes = self._changes(stored, schema, done, batch, months, refilled)
        self._write(changes, "changes", batch, by_month=True)
        noted = {"records": schema.json(), "changes": changes.schema.json()}
        self._write(self.spark.createDataFrame([noted], "records string, changes string"), "batches", batch)

    def _shared(self, stored: T.StructType, schema: T.StructType, batches: list[int], months: list[int],
                days: DataFrame) -> DataFrame:
        """Kins of more than one record, on the days of the last batch. Eight bytes of each record travel."""
        rows = (self._read("complete", stored, batches, months)
                .unionByName(self._read("gaps", stored, batches, months)))
        return (rows.join(days, "transaction_date", "left_semi").groupBy(self._kin(schema).alias("kin"))
                .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("kin"))

    def _apart(self, rows: DataFrame, schema: T.StructType, batches: list[int]) -> tuple[DataFrame, DataFrame | None]:
        """Rows that no other can equal, and those whose kin several records share, if there are any."""
        shared = self.spark.read.schema("kin bigint").parquet(*[self._path("shared", b) for b in batches])
        if shared.isEmpty():
            return rows, None
        keyed = rows.withColumn("kin", self._kin(schema))
        return tuple(keyed.join(shared, "kin", how).drop("kin") for how in ("left_anti", "left_semi"))

    def _changes(self, stored: T.StructType, schema: T.StructType, done: list[int], batch: int,
                 months: list[int], refilled: list[int]) -> DataFrame:
        """Signed totals of the records that the clean table gains and loses."""
        statistics = self._statistics(batch)

        def side(df: DataFrame, old: int) -> DataFrame:
            return df.select("month", *schema.names, F.lit(old).alias("old"), F.lit(1).alias("new"))

        added = side(self._read("complete", stored, [batch]), 0).unionByName(side(
            self._filled(self._read("gaps", stored, [batch]), statistics, schema, "month"), 0))

        def held(months: list[int]) -> DataFrame:
            """The history, as the clean table had and has it."""
            return side(self._read("complete", stored, done, months), 1).unionByName(self._refilled(
                self._read("gaps", stored, done, months), self._statistics(done[-1]), statistics, schema))

        # Of the months whose fillings change all rows are read: a group that loses one has its largest bill among them.
        rows, shared = self._apart(added.unionByName(held(refilled)) if refilled else added, schema, [*done, batch])
        if shared is not None:
            others = [m for m in months if m not in refilled]
            if done and others:
                shared = shared.unionByName(self._apart(held(others), schema, [*done, batch])[1])
            rows = rows.unionByName(shared.groupBy("month", *schema.names).agg(
                F.max("old").alias("old"), F.max("new").alias("new")))
        sales = self._costed(rows.withColumn("sign", F.col("new") - F.col("old")))
        gained, lost = F.col("sign") > 0, F.col("sign") < 0

        def signed(c: str) -> Column:
            return F.sum(F.when(gained, F.col(c)).when(lost, -F.col(c))).alias(c)

        totals = sales.groupBy("month", *self._keys(sales)).agg(
            *[signed(c) for c in aggregates.SUMMED], F.sum(F.col("sign").cast("bigint")).alias("transactions"),
            F.max(F.when(gained, F.col("max_bill"))).alias("max_bill"), F.max(lost).alias("lost"),
            F.max(F.when(F.col("new") > 0, F.col("max_bill"))).alias("left_bill"), F.max(F.col("sign") != 0).alias("moved"))
        return totals.where("moved").withColumn(
            "max_bill", F.when(F.col("lost"), F.col("left_bill")).otherwise(F.col("max_bill"))).drop("left_bill", "moved")

    def _costed(self, rows: DataFrame) -> DataFrame:
        return aggregates.additive(features.add_financials(imputation.with_total(rows), self.rates, self.default_rate))

    @staticmethod
    def _keys(df: DataFrame) -> list[str]:
        return [k for k in aggregates.ROLLUP_KEYS if k in df.columns]

    # --- results -----------------------------------------------------------------------------

    def clean(self) -> DataFrame:
        """The clean table of everything taken in so far, as one clean load would give it."""
        done = self.batches()
        schema = self._schema(done[-1])
        stored = self._stored(schema)
        filled = self._filled(self._read("gaps", stored, done), self._statistics(done[-1]), schema)
        rows = self._read("complete", stored, done).select(*schema.names).unionByName(filled)
        # Distinct records become equal by their filling only if they share their kin.
        rows, shared = self._apart(rows, schema, done)
        return imputation.with_total(rows if shared is None else rows.unionByName(shared.dropDuplicates()))

    def rollup(self, months: list[int] | None = None) -> DataFrame:
        """The daily rollup, from the changes alone; ``months`` (as 202301) limits what is read."""
        done = self.batches()
        schema = T.StructType([*self._schema(done[-1], "changes").fields, T.StructField("batch", T.IntegerType())])
        changes = self._read("changes", schema, done)
        if months is not None:
            changes = changes.where(F.col("month").isin(months))
        keys = self._keys(changes)
        since = F.max(F.when(F.col("lost"), F.col("batch"))).over(Window.partitionBy(*keys))
        summed = changes.withColumn("since", since).groupBy(*keys).agg(
            *[F.sum(c).cast(changes.schema[c].dataType).alias(c) for c in aggregates.SUMMED],
            F.sum("transactions").alias("transactions"),
            F.max(F.when(F.col("since").isNull() | (F.col("batch") >= F.col("since")), F.col("max_bill"))).alias("max_bill"))
        return summed.where("transactions > 0")
