from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import frames
from tallybook.operators import aggregates, features, kpis, recommendations, segmentation, trends
from tallybook.plans import report, sales_sql
from tallybook.sources import files

YEAR = [(f"2023-{m:02}-01", 100) for m in range(1, 13)]


def test_monthly_growth_skips_missing_months(spark):
    df = frames.months(spark, ("2023-01-05", 100), ("2023-02-01", 150), ("2023-04-01", 75))
    rows = trends.monthly_trend(df).orderBy("month_start").collect()
    assert [r.mom_growth_pct for r in rows] == [None, 50.0, -50.0]
    assert [r.running_total for r in rows] == [100, 250, 325]
    assert [r.month_label for r in rows] == ["Jan 2023", "Feb 2023", "Apr 2023"]


def test_quarter_grains(spark):
    df = frames.months(spark, ("2022-01-01", 100), ("2023-01-01", 50), ("2023-04-01", 300))
    merged = trends.quarterly_trend(df).orderBy("quarter_label").collect()
    assert [(r.quarter_label, r.revenue, r.qoq_growth_pct) for r in merged] == [
        ("Q1", 150, None), ("Q2", 300, 100.0)]
    apart = trends.quarterly_trend(df, "quarter").orderBy("quarter").collect()
    assert [(r.quarter, r.qoq_growth_pct) for r in apart] == [
        ("2022Q1", None), ("2023Q1", -50.0), ("2023Q2", 500.0)]


def test_rolling_average_uses_the_months_there_are(spark):
    df = frames.months(spark, ("2023-01-01", 30), ("2023-02-01", 60), ("2023-05-01", 90),
                       ("2023-06-01", 120))
    rows = trends.rolling_average(df).orderBy("year_month").collect()
    assert [r.rolling_3m_avg for r in rows] == [30, 45, 60, 90]


def test_outlier_month(spark):
    months = [*YEAR[:11], ("2023-12-01", 900)]
    found = trends.revenue_anomalies(trends.monthly_trend(frames.months(spark, *months))).collect()
    assert [(r.month_label, r.fence_lower, r.fence_upper) for r in found] == [("Dec 2023", 100, 100)]
    flat = trends.monthly_trend(frames.months(spark, *YEAR))
    assert trends.revenue_anomalies(flat).count() == 0


def test_forecast_continues_a_line(spark):
    df = frames.months(spark, *[(f"2023-{m:02}-01", 100 + 10 * m) for m in range(1, 7)])
    rows = trends.revenue_forecast(trends.monthly_trend(df)).orderBy("step").collect()
    assert [(r.month_label, r.forecast_revenue) for r in rows] == [
        ("Forecast +1", 170.0), ("Forecast +2", 180.0), ("Forecast +3", 190.0)]
    assert trends.revenue_forecast(trends.monthly_trend(df.limit(0))).count() == 0


def test_executive_figures(spark):
    df = frames.sales(spark, ("Tea", 2, 10, "2023-01-01"), ("Cake", 1, 40, "2023-01-02"))
    got = frames.by(kpis.executive_kpis(df), "kpi", "value")
    assert got == {
        "Total Revenue (₹)": 60, "Total Cost (₹)": 36, "Total Profit (₹)": 24,
        "Gross Margin (%)": 40, "Total Transactions": 2, "Avg Transaction Value (₹)": 30,
        "Avg Revenue per Transaction": 30, "Avg Quantity per Transaction": 1.5}
    empty = frames.by(kpis.executive_kpis(df.limit(0)), "kpi", "value")
    assert empty["Total Transactions"] == 0 and empty["Gross Margin (%)"] is None


FOUR = (("Tea", 1, 100, "2023-01-01"), ("Cake", 1, 90, "2023-01-01"),
        ("Salad", 1, 20, "2023-01-01"), ("Juice", 1, 10, "2023-01-01"))
RATES = {"Tea": "0.50", "Cake": "0.70", "Salad": "0.40", "Juice": "0.80"}


def four(spark):
    return frames.sales(spark, *FOUR, rates=RATES)


def test_every_quadrant(spark):
    got = frames.by(kpis.product_quadrants(kpis.product_matrix(four(spark))), "item", "quadrant")
    assert got == {"Tea": kpis.STAR, "Cake": kpis.VOLUME_DRIVER, "Salad": kpis.NICHE,
                   "Juice": kpis.REVIEW}


def test_median_counts_as_high(spark):
    df = frames.sales(spark, *FOUR)  # one cost rate: every margin is the median
    got = set(frames.by(kpis.product_quadrants(kpis.product_matrix(df)), "item", "quadrant").values())
    assert got == {kpis.STAR, kpis.NICHE}


def test_rank_ties_and_running_share(spark):
    df = frames.sales(spark, ("Tea", 1, 50, "2023-01-01"), ("Cake", 1, 50, "2023-01-01"),
                      ("Salad", 1, 25, "2023-01-01"))
    assert frames.by(kpis.product_matrix(df), "item", "revenue_rank") == {
        "Tea": 1, "Cake": 1, "Salad": 3}
    rows = sales_sql.run_query(df, "q6_2").collect()
    assert [(r.item, r.cumulative_revenue, r.cumulative_pct) for r in rows] == [
        ("Cake", 50, 40.0), ("Tea", 100, 80.0), ("Salad", 125, 100.0)]
    ends = kpis.top_and_bottom(kpis.product_matrix(df), 1).collect()
    assert [(r.end, r.item) for r in ends] == [("top", "Cake"), ("bottom", "Salad")]


def test_low_margin_low_volume_flag(spark):
    df = frames.sales(spark, ("Tea", 1, 95, "2023-01-01"), ("Juice", 1, 5, "2023-01-01"),
                      ("Cake", 1, 50, "2023-01-01"),
                      rates={"Tea": "0.50", "Juice": "0.80", "Cake": "0.80"})
    assert frames.by(sales_sql.margin_flags(df), "item", "action_flag") == {
        "Tea": sales_sql.ACCEPTABLE, "Juice": sales_sql.PRIORITY_REVIEW,
        "Cake": sales_sql.MARGIN_REVIEW}


def test_channel_column_follows_the_data(spark):
    df = four(spark)
    assert kpis.channel_column(df) == "location"
    assert kpis.channel_column(df.withColumn("order_type", F.lit("Dine"))) == "order_type"


def advise(df, **options):
    return recommendations.recommendations(
        kpis.product_quadrants(kpis.product_matrix(df)), kpis.channel_analysis(df),
        kpis.payment_analysis(df), **options).orderBy("position").collect()


def test_recommendations(spark):
    rows = advise(four(spark))
    assert [r.position for r in rows] == [1, 2, 4]  # one channel only: no weakest one
    assert "[Juice]" in rows[0].recommendation and "[Tea]" in rows[1].recommendation
    assert rows[2].recommendation.startswith("PAYMENT | Cash represents 100.0% of revenue.")
    assert [r.position for r in advise(four(spark), threshold_pct=100.0)] == [1, 2]
    two = frames.sales(spark, ("Tea", 1, 90, "2023-01-01", "In-Store", "Debit Card"),
                       ("Tea", 1, 10, "2023-01-01", "Delivery", "Debit Card"))
    assert advise(two)[-1].recommendation.startswith(
        "CHANNEL | 'Delivery' channel contributes 10.0% of revenue.")


def test_sums_and_shares_tie_out(spark):
    df = four(spark)
    matrix = kpis.product_matrix(df)
    assert matrix.agg(F.sum("revenue_share_pct")).first()[0] == pytest.approx(100, abs=0.05)
    assert matrix.agg(F.sum("total_revenue")).first()[0] == Decimal("220.00")


def test_rows_and_rollup_give_the_same(spark):
    rows = frames.sales(spark, *FOUR, *FOUR, ("Tea", 3, "1.25", "2023-03-05", "Delivery", "Cash"))
    rollup = features.add_calendar(aggregates.daily_rollup(rows))
    assert rollup.count() < rows.count()
    for name in sales_sql.SALES_QUERIES:
        assert (sales_sql.run_query(rows, name).collect()
                == sales_sql.run_query(rollup, name).collect()), name


def test_python_and_sql_style_months_agree(spark):
    df = frames.months(spark, *YEAR)
    a = trends.monthly_trend(df).select("revenue", "mom_growth_pct", "running_total")
    b = sales_sql.monthly_growth(df).select("monthly_revenue", "mom_growth_pct", "running_total")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_sql_view(spark):
    files.register_sales_view(four(spark), "sales_for_test")
    row = spark.sql(
        "SELECT ROUND(SUM(Total_Spent), 2) AS t, COUNT(DISTINCT DayOfWeek) AS d, MAX(IsWeekend) AS w,"
        " COUNT(Month_Start) AS m FROM sales_for_test").first()
    assert (row.t, row.d, row.w, row.m) == (Decimal("220.00"), 1, 1, 4)


def test_report(spark, folder):
    df = frames.months(spark, ("2023-01-05", 100), ("2023-02-01", 2500000))
    report.run_analysis(df, f"{folder}/report", "CORNER SHOP")
    text = [r.value for r in spark.read.text(f"{folder}/report").collect()]
    assert text[:4] == ["", "=" * 64, "  CORNER SHOP — BUSINESS KPI REPORT", "=" * 64]
    assert "  Jan 2023     ₹   100.00 ₹    40.00    40.0%        —      1" in text
    assert "  Feb 2023     ₹2,500,000.00 ₹1,000,000.00    40.0% +2499900.00%      1" in text
    assert "  Total Transactions                      :        2" in text
    assert "  No monthly revenue anomalies detected (IQR method, 1.5× fence)." in text
    assert text[-2:] == ["  END OF REPORT", "=" * 64]
    sections = [line for line in text if line.startswith("  SECTION")]
    assert sections == sorted(sections) and len(sections) == 9


def test_order_costs(spark):
    df = frames.sales(spark, ("Tea", 1, 100, "2023-01-01", "Delivery"),
                      ("Tea", 1, 100, "2023-01-01", "In-Store"))
    got = frames.by(segmentation.channel_net_profit(df, {"Delivery": "15.50"}), "channel", "net_profit")
    assert got == {"Delivery": Decimal("24.50"), "In-Store": Decimal("40.00")}


def test_rfm_scores(spark):
    rows = [(f"C{i}", i * 10, 11 - i, Decimal(1000 - i)) for i in range(1, 11)]
    customers = spark.createDataFrame(
        rows, "customer_id string, recency_days int, frequency bigint, monetary decimal(18,2)")
    got = frames.by(segmentation.rfm_scores(customers), "customer_id", "rfm_code")
    assert got["C1"] == "555" and got["C10"] == "111"
    same = customers.withColumn("frequency", F.lit(3))
    assert set(frames.by(segmentation.rfm_scores(same), "customer_id", "f_score").values()) == {1}
