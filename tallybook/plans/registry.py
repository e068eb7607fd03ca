"""Every registered query: name -> function of (spark, folder of tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallybook import schemas
from tallybook.config import CHECKED_TOKENS_V1
from tallybook.functions.numbers import real
from tallybook.operators import (
    aggregates, cleaning, costs, cube, drivers, features, imputation, kpis, measures, profiling, segmentation, sketches,
    trends, validation, visuals,
)
from tallybook.plans import clean, observed, report, sales_sql
from tallybook.plans.lattice import Lattice
from tallybook.sources import files, layout
from tallybook.sources.sample_tables import (
    EXTRA_COLUMNS, SAMPLE, SAMPLE_COST_RATES, SAMPLE_DATED_RATES, SAMPLE_V1, raw_sales,
)
from tallybook.sources.staging import stage_table, staged_once, staging_path
from tallybook.streaming import incremental
from tallybook.streaming.ledger import Ledger

Query = Callable[[SparkSession, str], DataFrame]

# Cost per order of the channel report.
ORDER_COSTS = {"BUILDING": "35.50", "MACHINERY": "120.00", "AUTOMOBILE": "8.25"}


class Tables:
    """The stages of the job over one folder of tables.

    Stored once per application: the standardised records, which the passes for
    statistics and for rows both read, the statistics and the daily rollup.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _stored(self, name: str, build: Callable[[], DataFrame], partition_by: tuple[str, ...] = ()) -> DataFrame:
        return staged_once(self.spark, self.folder, name, build, partition_by)

    def raw(self) -> DataFrame:
        return raw_sales(self.spark, self.folder)

    def normalised(self) -> DataFrame:
        return cleaning.normalise_tokens(self.raw(), SAMPLE)

    def typed(self) -> DataFrame:
        return cleaning.typed_records(self.raw(), SAMPLE)

    def standardised(self, old: bool = False) -> DataFrame:
        return cleaning.standardised_records(self.raw(), SAMPLE_V1 if old else SAMPLE)

    def records(self, old: bool = False) -> DataFrame:
        """The standardised records, stored: the tables are joined and the texts parsed once."""
        return self._stored("standardised-v1" if old else "standardised", lambda: self.standardised(old))

    def stored_raw(self) -> DataFrame:
        """The raw records, stored, for jobs that read them more than once."""
        return self._stored("raw-records", self.raw)

    def statistics(self, old: bool = False, price_median: str = "raw",
                   records: DataFrame | None = None) -> imputation.Statistics:
        """``records`` are the standardised records, if they come from elsewhere than :meth:`records`."""
        tag = "-v1" if old else ""
        counts = self._stored(f"value-counts{tag}", lambda: imputation.value_counts(
            self.records(old) if records is None else records))
        by_item = self._stored(f"item-statistics{tag}", lambda: imputation.item_statistics(counts))
        overall = self._stored(
            f"overall-statistics{tag}-{price_median}",
            lambda: imputation.overall_statistics(counts, by_item, price_median))
        return imputation.Statistics(by_item, imputation.flat(overall))

    def with_statistics(self, statistics: imputation.Statistics) -> DataFrame:
        return imputation.with_item_statistics(self.records(), statistics)

    def filled(self) -> DataFrame:
        return imputation.fill_gaps(self.records(), self.statistics())

    def clean(self) -> DataFrame:
        return clean.clean_records(self.records(), self.statistics())

    def clean_v1(self) -> DataFrame:
        statistics = self.statistics(old=True, price_median="filled")
        return clean.clean_records(self.records(old=True), statistics)

    def engineered(self) -> DataFrame:
        """With the flat cost rate."""
        return features.engineer(self.clean())

    def costed(self) -> DataFrame:
        """With per-item cost rates, which the reports use."""
        return features.engineer(self.clean(), SAMPLE_COST_RATES)

    def sales(self) -> DataFrame:
        rollup = self._stored("daily-rollup", lambda: aggregates.daily_rollup(
            features.engineer(aggregates.gathered(self.clean()), SAMPLE_COST_RATES)))
        return features.add_calendar(rollup)

    def cube(self) -> DataFrame:
        """The rollup's totals by level, which the report reads."""
        return self._stored("analysis-cube", lambda: cube.analysis_cube(self.sales()), ("level",))


def plain(df: DataFrame, places: int | None = None) -> DataFrame:
    """Types any engine shares: doubles, 64-bit integers, ISO dates as text.

    ``places`` rounds what an operator leaves unrounded; decimals are rounded
    as decimals.
    """
    def convert(field: T.StructField):
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            if places is not None and kind.scale > places:
                col = F.round(col, places)
            col = col.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            col = col.cast("bigint")
        elif isinstance(kind, T.DateType):
            col = F.date_format(col, "yyyy-MM-dd")
        elif isinstance(kind, T.DoubleType) and places is not None:
            col = F.round(col, places)
        return col.alias(field.name)

    return df.select(*[convert(f) for f in df.schema.fields])


_QUERIES: dict[str, Query] = {}


def query(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of :class:`Tables` under its own name."""
    _QUERIES[function.__name__] = lambda spark, folder: function(Tables(spark, folder))
    return function


# --- files ------------------------------------------------------------------


@query
def io_raw_csv_roundtrip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "raw-csv")
    raw = t.raw()
    half = F.pmod(F.xxhash64("transaction_id"), F.lit(2))
    # Two header layouts, and a line break inside quotes that cleaning trims off again.
    broken = F.when(F.col("location") == "ASIA", F.lit("\nASIA\n")).otherwise(F.col("location"))
    files.write_table(raw.filter(half == 0).withColumn("location", broken), f"{path}/a", "csv")
    turned = raw.filter(half == 1).select(*reversed(raw.columns))
    files.write_table(turned.toDF(*[c.replace("_", " ").title() for c in turned.columns]), f"{path}/b", "csv")
    # Null and empty text look alike in a text file.
    return cleaning.normalise_tokens(files.read_raw_csv(t.spark, f"{path}/*"), SAMPLE)


@query
def io_clean_roundtrip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "clean-csv")
    files.write_table(t.clean(), path, "csv")
    return plain(files.read_clean(t.spark, path, "csv", EXTRA_COLUMNS))


@query
def io_engineered_roundtrip(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "engineered")
    rows = features.engineer(features.gathered_by_month(t.clean()))
    files.write_table(rows, path, "parquet", ("year_month",), rebalance=False)
    return plain(files.read_engineered(t.spark, path, extras=EXTRA_COLUMNS))


# --- cleaning ---------------------------------------------------------------


@query
def clean_tokens(t: Tables) -> DataFrame:
    return t.normalised()


@query
def clean_numeric(t: Tables) -> DataFrame:
    return plain(cleaning.cast_numeric(t.normalised()).select(
        "transaction_id", "quantity", "price_per_unit", "total_spent"))


@query
def clean_dates(t: Tables) -> DataFrame:
    dated = cleaning.drop_undated(cleaning.parse_dates(t.normalised()))
    return plain(dated.select("transaction_id", "transaction_date"))


@query
def clean_categoricals(t: Tables) -> DataFrame:
    return cleaning.standardise_categoricals(t.typed(), SAMPLE).select(
        "transaction_id", "item", "payment_method", "location")


@query
def clean_reconcile(t: Tables) -> DataFrame:
    flagged = t.typed().withColumn("mismatch", F.coalesce(cleaning.total_mismatch(), F.lit(False)))
    return plain(cleaning.reconcile_totals(flagged).select(
        "transaction_id", "quantity", "price_per_unit", "total_spent",
        F.col("mismatch").cast("int").alias("mismatch")))


@query
def impute_quantity(t: Tables) -> DataFrame:
    s = t.statistics()
    return plain(t.with_statistics(s).select(
        "transaction_id", "item", imputation.filled_quantity(s).alias("quantity")))


def _filled_price(t: Tables, price_median: str) -> DataFrame:
    s = t.statistics(price_median=price_median)
    return plain(t.with_statistics(s).select(
        "transaction_id", "item", imputation.filled_price(s).alias("price_per_unit")))


@query
def impute_price(t: Tables) -> DataFrame:
    return _filled_price(t, "raw")


@query
def impute_price_v1(t: Tables) -> DataFrame:
    return _filled_price(t, "filled")


@query
def impute_categoricals(t: Tables) -> DataFrame:
    s = t.statistics()
    return t.records().select("transaction_id", *[
        imputation.filled_category(s, c).alias(c) for c in schemas.CATEGORICAL_COLUMNS])


@query
def clean_dedup(t: Tables) -> DataFrame:
    return plain(imputation.with_total(cleaning.remove_duplicates(t.filled())))


@query
def clean_full(t: Tables) -> DataFrame:
    return plain(t.clean())


@query
def clean_full_v1(t: Tables) -> DataFrame:
    return plain(t.clean_v1())


@query
def profile_nulls(t: Tables) -> DataFrame:
    return profiling.null_counts(t.normalised())


@query
def profile_coercions(t: Tables) -> DataFrame:
    return profiling.coercion_counts(t.normalised())


@query
def profile_dates(t: Tables) -> DataFrame:
    return profiling.date_counts(cleaning.parse_dates(t.normalised()))


@query
def profile_out_of_vocab(t: Tables) -> DataFrame:
    return profiling.out_of_vocabulary_counts(t.typed(), SAMPLE)


@query
def profile_mismatches(t: Tables) -> DataFrame:
    return profiling.mismatch_counts(t.typed())


@query
def profile_imputed(t: Tables) -> DataFrame:
    return profiling.imputation_counts(t.standardised())


@query
def profile_duplicates(t: Tables) -> DataFrame:
    return profiling.duplicate_counts(t.filled())


@query
def validate_clean(t: Tables) -> DataFrame:
    return validation.validate_clean(t.clean(), SAMPLE)


@query
def observed_run(t: Tables) -> DataFrame:
    """Run counts and checks from the pass that writes the clean table."""
    figures = observed.Figures(t.spark)
    raw = t.stored_raw()
    statistics = t.statistics(records=cleaning.standardised_records(raw, SAMPLE))
    rows = observed.clean_records(raw, statistics, figures, SAMPLE)
    files.publish_table(rows, staging_path(t.spark, "clean"), versions=True)
    return figures.counts()


@query
def validate_clean_v1(t: Tables) -> DataFrame:
    return validation.validate_clean(t.clean_v1(), SAMPLE_V1, CHECKED_TOKENS_V1)


# --- features ---------------------------------------------------------------

_FINANCIAL = ("transaction_id", "item", "quantity", "price_per_unit", "revenue", "cost", "profit",
              "profit_margin_pct")


@query
def features_financial(t: Tables) -> DataFrame:
    return plain(features.add_financials(t.clean()).select(*_FINANCIAL))


@query
def features_cost_dim(t: Tables) -> DataFrame:
    return plain(features.add_financials(t.clean(), SAMPLE_COST_RATES).select(*_FINANCIAL))


@query
def features_cost_as_of(t: Tables) -> DataFrame:
    rates = t.spark.createDataFrame(SAMPLE_DATED_RATES, "item string, valid_from string, cogs_rate string")
    return plain(costs.add_financials_as_of(t.clean(), rates).select(
        "transaction_id", "item", "transaction_date", "revenue", "cost", "profit"))


@query
def features_time(t: Tables) -> DataFrame:
    return plain(features.add_calendar(t.clean()).select(
        "transaction_id", "transaction_date", *[f.name for f in schemas.TIME.fields]))


@query
def features_preview(t: Tables) -> DataFrame:
    return plain(features.preview(t.engineered()))


@query
def engineered_full(t: Tables) -> DataFrame:
    return plain(t.engineered())


@query
def validate_features(t: Tables) -> DataFrame:
    return validation.validate_features(t.engineered())


@query
def validate_features_v1(t: Tables) -> DataFrame:
    return validation.validate_features(
        t.engineered(), tolerance="0", required=validation.REQUIRED_FEATURES_V1)


@query
def validate_margin(t: Tables) -> DataFrame:
    return plain(validation.validate_margin(t.engineered()), 6)


# --- KPIs -------------------------------------------------------------------


@query
def kpi_executive(t: Tables) -> DataFrame:
    return plain(kpis.executive_kpis(t.sales()), 4)


@query
def kpi_monthly(t: Tables) -> DataFrame:
    return plain(trends.monthly_trend(t.sales()).orderBy("month_start"))


@query
def kpi_quarterly(t: Tables) -> DataFrame:
    return plain(trends.quarterly_trend(t.sales()).orderBy("quarter_label"))


@query
def kpi_quarterly_by_year(t: Tables) -> DataFrame:
    return plain(trends.quarterly_trend(t.sales(), "quarter").orderBy("quarter"))


@query
def kpi_product_matrix(t: Tables) -> DataFrame:
    return plain(kpis.product_matrix(t.sales()), 4)


@query
def kpi_product_quadrants(t: Tables) -> DataFrame:
    matrix = kpis.product_quadrants(kpis.product_matrix(t.sales()))
    return plain(matrix.select("item", "total_revenue", "profit_margin_pct", "quadrant"))


@query
def kpi_channel(t: Tables) -> DataFrame:
    return plain(kpis.channel_analysis(t.sales(), "location"), 4)


@query
def kpi_channel_order_type(t: Tables) -> DataFrame:
    return plain(kpis.channel_analysis(t.sales()), 4)


@query
def kpi_payment(t: Tables) -> DataFrame:
    return plain(kpis.payment_analysis(t.sales()), 4)


def _anomalies(t: Tables, multiplier: float) -> DataFrame:
    found = trends.revenue_anomalies(trends.monthly_trend(t.sales()), multiplier)
    return plain(found, 2)


@query
def kpi_anomalies(t: Tables) -> DataFrame:
    return _anomalies(t, 1.5)


@query
def kpi_anomalies_narrow(t: Tables) -> DataFrame:
    """Narrow fences, so that some months fall outside."""
    return _anomalies(t, 0.25)


@query
def kpi_forecast(t: Tables) -> DataFrame:
    return plain(trends.revenue_forecast(trends.monthly_trend(t.sales())))


@query
def kpi_recommendations(t: Tables) -> DataFrame:
    """With the rule for a dominant payment method set to one that occurs."""
    sales = t.sales()
    return plain(report.rules.recommendations(
        kpis.product_quadrants(kpis.product_matrix(sales)), kpis.channel_analysis(sales),
        kpis.payment_analysis(sales), method="Low"))


@query
def kpi_top_bottom_n(t: Tables) -> DataFrame:
    return plain(kpis.top_and_bottom(kpis.product_matrix(t.sales()), 3))


@query
def report_lines(t: Tables) -> DataFrame:
    lines = report.report_lines(report.analyse_cube(t.cube()))
    return plain(lines.orderBy("section", "line_no"))


@query
def analysis_cube(t: Tables) -> DataFrame:
    return plain(t.cube().drop("gross"))


_LATTICES: dict[tuple[str, str], Lattice] = {}


@query
def lattice_answers(t: Tables) -> DataFrame:
    """Totals by several groupings, each from the smallest stored rollup that has its columns."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key not in _LATTICES:
        _LATTICES[key] = Lattice(t.sales())
    stored = _LATTICES[key]
    rows = []
    for keys in (("item",), ("location", "payment_method"), ("item", "quarter"), ("order_type", "year_month"),
                 ("item", "location", "year"), ("day_of_week",), ()):
        found = aggregates.totals(stored.rows(*keys), *keys)
        rows.append(found.select(
            F.lit("+".join(keys)).alias("grouping"), F.concat_ws("|", *keys).alias("key"),
            "revenue", "profit", "quantity", "transactions", "max_bill"))
    united = rows[0]
    for part in rows[1:]:
        united = united.unionByName(part)
    return plain(united)


# --- named sales queries ----------------------------------------------------


def _sales_query(name: str) -> Query:
    return lambda spark, folder: plain(sales_sql.run_query(Tables(spark, folder).sales(), name), 6)


_QUERIES.update({f"sql_{name}": _sales_query(name) for name in sales_sql.SALES_QUERIES})


# --- measures ---------------------------------------------------------------


@query
def dim_date(t: Tables) -> DataFrame:
    return plain(measures.date_dimension(t.sales()))


@query
def measure_core(t: Tables) -> DataFrame:
    return plain(measures.core_measures(t.sales(), ("item", "location")), 4)


def _calendar(t: Tables, measure: Callable, by: tuple[str, ...] = ()) -> DataFrame:
    return plain(measure(measures.monthly_spine(t.sales(), by), by), 4)


@query
def measure_mom_calendar(t: Tables) -> DataFrame:
    return _calendar(t, measures.month_over_month, ("item",))


@query
def measure_yoy(t: Tables) -> DataFrame:
    return _calendar(t, measures.year_over_year)


@query
def measure_ytd(t: Tables) -> DataFrame:
    return _calendar(t, measures.year_to_date)


@query
def measure_rolling_3m(t: Tables) -> DataFrame:
    return _calendar(t, measures.rolling_three_months)


@query
def measure_contribution(t: Tables) -> DataFrame:
    return plain(measures.contribution(t.sales(), ("location",)), 4)


@query
def measure_rank_with_total(t: Tables) -> DataFrame:
    return plain(measures.rank_with_total(t.sales()), 4)


@query
def measure_top_n(t: Tables) -> DataFrame:
    return plain(measures.top_n(t.sales(), 3), 4)


@query
def measure_titles(t: Tables) -> DataFrame:
    return measures.titles(t.sales())


@query
def measure_mom_label(t: Tables) -> DataFrame:
    grown = measures.month_over_month(measures.monthly_spine(t.sales()))
    return plain(grown.select("month_start", measures.growth_label().alias("mom_label")))


@query
def measure_margin_class(t: Tables) -> DataFrame:
    measured = measures.core_measures(t.sales(), ("item",), rate=None)
    return plain(measured.select(
        "item", "profit_margin", measures.margin_class().alias("margin_class")), 6)


# --- visuals ----------------------------------------------------------------


@query
def view_filtered_kpis(t: Tables) -> DataFrame:
    chosen = measures.in_context(t.sales(), "1996-03-01", "1999-10-31",
                                 location=["Asia", "Europe"], payment_method="High")
    return plain(kpis.executive_kpis(chosen), 4)


@query
def view_clustered_slicer(t: Tables) -> DataFrame:
    """The figures of a few items and places, from sales stored by a key of all slicers."""
    path = staging_path(t.spark, "clustered-sales")
    clean_sales = stage_table(t.clean(), "clean-sales")
    layout.write_clustered(
        clean_sales.withColumn("year_month", F.date_format("transaction_date", "yyyy-MM")), path,
        ("item", "location", "payment_method"), ("year_month",),
        derive=lambda rows: features.engineer(rows, SAMPLE_COST_RATES))
    chosen = measures.in_context(files.read_engineered(t.spark, path, extras=EXTRA_COLUMNS), item=["Promo", "Small"],
                                 location="Europe")
    return plain(kpis.executive_kpis(chosen), 4)


@query
def view_kpi_cards(t: Tables) -> DataFrame:
    return plain(visuals.kpi_cards(t.sales()))


@query
def view_heatmap_pivot(t: Tables) -> DataFrame:
    return plain(visuals.heatmap(t.sales(), SAMPLE.payments))


@query
def view_scatter(t: Tables) -> DataFrame:
    return plain(visuals.scatter(t.sales()), 4)


@query
def view_treemap(t: Tables) -> DataFrame:
    return plain(visuals.treemap(t.sales()))


@query
def view_profit_waterfall(t: Tables) -> DataFrame:
    return plain(visuals.profit_waterfall(t.sales()).orderBy("position"))


@query
def view_driver_tree(t: Tables) -> DataFrame:
    return plain(visuals.driver_tree(t.sales()))


@query
def view_price_volume(t: Tables) -> DataFrame:
    return plain(visuals.price_volume_mix(t.sales()))


@query
def view_revenue_drivers(t: Tables) -> DataFrame:
    return plain(drivers.revenue_drivers(t.sales()))


# --- segments, order costs, item forecasts, incremental load ----------------


@query
def rfm_segments(t: Tables) -> DataFrame:
    return plain(segmentation.rfm_segments(t.costed()))


@query
def channel_net_profit(t: Tables) -> DataFrame:
    return plain(segmentation.channel_net_profit(t.sales(), ORDER_COSTS))


@query
def forecast_by_item(t: Tables) -> DataFrame:
    monthly = aggregates.totals(t.sales(), "item", "month_start").select(
        "item", "month_start", real("revenue").alias("revenue"))
    return plain(trends.revenue_forecast(monthly, by=("item",)))


@query
def incremental_load(t: Tables) -> DataFrame:
    source, store = (staging_path(t.spark, n) for n in ("incoming", "incremental"))
    raw = t.stored_raw()
    # Column names as in the original files, two loads of one half each.
    titled = raw.toDF(*[c.replace("_", " ").title().replace(" Id", " ID") for c in raw.columns])
    for half in (0, 1):
        part = titled.filter(F.pmod(F.xxhash64("Transaction ID"), F.lit(2)) == half)
        part.write.mode("append").options(**files.CSV_OPTIONS, compression="gzip").csv(source)
        incremental.load_new_files(t.spark, source, store, SAMPLE, EXTRA_COLUMNS)
    return plain(incremental.clean_history(t.spark, store))


_LEDGERS: dict[tuple[str, str], Ledger] = {}


def _taken_in(t: Tables) -> Ledger:
    """A ledger fed with three batches: early months, later ones, and late records of all of them."""
    key = (t.spark.sparkContext.applicationId, t.folder)
    if key in _LEDGERS:
        return _LEDGERS[key]
    raw = t.stored_raw().withColumn("row", F.monotonically_increasing_id())
    late, early = F.col("row") % 10 == 3, F.coalesce(F.col("transaction_date"), F.lit("")) < "1995"
    ledger = Ledger(t.spark, staging_path(t.spark, "ledger"), rates=SAMPLE_COST_RATES)
    # A record's copies come one after another, so some are in another batch than their original.
    for batch, part in enumerate((~late & early, ~late & ~early, late)):
        ledger.apply(cleaning.standardised_records(raw.where(part).drop("row"), SAMPLE), batch)
    _LEDGERS[key] = ledger
    return ledger


@query
def incremental_dedup(t: Tables) -> DataFrame:
    return plain(_taken_in(t).clean())


@query
def incremental_rollup(t: Tables) -> DataFrame:
    return plain(_taken_in(t).rollup())


def _sketched(t: Tables) -> DataFrame:
    """Sketches of three parts of the records, merged."""
    part = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    def build() -> DataFrame:
        rows = t.records()
        parts = [sketches.value_sketches(rows.where(part == k)) for k in range(3)]
        return sketches.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return t._stored("sketches", build)


@query
def sketch_statistics(t: Tables) -> DataFrame:
    """Most frequent quantity and mean price of each item, from merged sketches."""
    return plain(sketches.item_statistics(_sketched(t)))


@query
def sketch_quantiles(t: Tables) -> DataFrame:
    """Whether the sketched price quantiles keep their rank bound; counts of all prices."""
    shares = [0.05, 0.25, 0.5, 0.75, 0.95]
    found = _sketched(t).where("kind = 'item'").agg(F.kll_merge_agg_double("prices").alias("prices"))
    asked = found.select(
        F.kll_sketch_get_n_double("prices").alias("sketched"),
        F.posexplode(sketches.quantiles(F.col("prices"), shares)).alias("at", "value"))
    counts = t._stored("value-counts", lambda: imputation.value_counts(t.records()))
    prices = counts.where(imputation.in_set("item", "price_per_unit") & F.col("price_per_unit").isNotNull()).groupBy(
        F.col("price_per_unit").cast("double").alias("price")).agg(F.sum("n").alias("n"))
    # Five values, each compared with every distinct price.
    values = asked.agg(F.array_sort(F.collect_list(F.struct("at", "value"))), F.max("sketched")).first()
    figures = [f(p) for _, p in enumerate(values[0]) for f in (
        lambda p: F.sum(F.when(F.col("price") < p.value, F.col("n")).otherwise(0)).alias(f"below{p.at}"),
        lambda p: F.sum(F.when(F.col("price") <= p.value, F.col("n")).otherwise(0)).alias(f"upto{p.at}"))]
    total = prices.agg(F.sum("n").alias("n"), *figures)
    bound = F.col("n") * sketches.RANK_ERROR
    return total.select("n", F.explode(F.array(*[F.struct(
        F.lit(p).alias("share"),
        ((F.col(f"below{k}") - bound <= p * F.col("n")) & (F.col(f"upto{k}") + bound >= p * F.col("n"))
         & (F.col("n") == values[1])).alias("kept")) for k, p in enumerate(shares)])).alias("row")).select("n", "row.*")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
