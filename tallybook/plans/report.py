"""The text report as ordered lines: (section, line_no, line)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tallybook.functions.numbers import real
from tallybook.operators import kpis, recommendations as rules, trends
from tallybook.operators.cube import analysis_cube, level
from tallybook.plans.engineered import sales_rollup
from tallybook.sources.files import write_report
from tallybook.sources.staging import stage_table

# Rules, titles and notes of the report.
DOUBLE_RULE = "=" * 64
SINGLE_RULE = "-" * 64
FORECAST_MONTHS = 3
TITLES = (
    "%s — BUSINESS KPI REPORT",
    "SECTION 1 — EXECUTIVE KPI OVERVIEW",
    "SECTION 2 — MONTHLY REVENUE TRENDS",
    "SECTION 3 — QUARTERLY PERFORMANCE",
    "SECTION 4 — PRODUCT PERFORMANCE MATRIX",
    "SECTION 5 — CHANNEL ANALYSIS",
    "SECTION 6 — PAYMENT METHOD ANALYSIS",
    "SECTION 7 — ANOMALY DETECTION",
    "SECTION 8 — REVENUE FORECAST (3-Month Linear Trend)",
    "SECTION 9 — BUSINESS RECOMMENDATIONS",
)
COLUMN_HEADS = {
    2: "  Month           Revenue     Profit  Margin%     MoM%   Txns",
    3: "  Quarter       Revenue     Profit  Margin%     QoQ%   Txns",
    4: "  Item         Rank    Revenue   Rev%  Margin%  Quadrant",
}
NO_ANOMALIES = "  No monthly revenue anomalies detected (IQR method, 1.5× fence)."
ANOMALIES = "  Anomalous months (outside IQR 1.5× fences):"
FORECAST_NOTE = (
    "  Note: Linear extrapolation. For accuracy, use Prophet with ≥24 months of data.")
CLOSING = ("", DOUBLE_RULE, "  END OF REPORT", DOUBLE_RULE)

# Data lines come after titles and column heads, notes after data lines.
_FIRST_DATA_LINE = 10
_NOTE_LINE = 1_000_000


class Analysis(NamedTuple):
    """Everything the report shows; each a small aggregated DataFrame."""

    executive: DataFrame
    monthly: DataFrame
    quarterly: DataFrame
    products: DataFrame
    channels: DataFrame
    payments: DataFrame
    anomalies: DataFrame
    forecast: DataFrame
    recommendations: DataFrame


def store_cube(sales: DataFrame) -> DataFrame:
    """The totals by level of a rollup or of a small table of sales, in one pass over it.

    Large sales are rolled up first: each row of the input takes part in every level.
    """
    return stage_table(analysis_cube(sales), "analysis-cube", ("level",))


def analyse_cube(cube: DataFrame, iqr_multiplier: float = 1.5) -> Analysis:
    """All analyses; each section reads its own level of the cube."""
    monthly = trends.monthly_trend(level(cube, "month_start"))
    products = kpis.product_quadrants(kpis.product_matrix(level(cube, "item")))
    channel = kpis.channel_column(cube)
    channels = kpis.channel_analysis(level(cube, channel), channel)
    payments = kpis.payment_analysis(level(cube, "payment_method"))
    return Analysis(
        executive=kpis.executive_kpis(level(cube)),
        monthly=monthly,
        quarterly=trends.quarterly_trend(level(cube, "month_start")),
        products=products,
        channels=channels,
        payments=payments,
        anomalies=trends.revenue_anomalies(monthly, iqr_multiplier),
        forecast=trends.revenue_forecast(monthly, FORECAST_MONTHS),
        recommendations=rules.recommendations(products, channels, payments),
    )


def analyse(sales: DataFrame, iqr_multiplier: float = 1.5) -> Analysis:
    """All analyses of engineered sales or of a rollup of them, which are read once."""
    return analyse_cube(store_cube(sales), iqr_multiplier)


def _fixed_lines(spark: SparkSession, business: str) -> DataFrame:
    lines = []
    for section, title in enumerate(TITLES):
        shown = title % business if section == 0 else title
        block = ["", DOUBLE_RULE, f"  {shown}", DOUBLE_RULE]
        if section in COLUMN_HEADS:
            block += [COLUMN_HEADS[section], "  " + SINGLE_RULE]
        lines += [(section, n, text) for n, text in enumerate(block)]
    lines.append((8, _NOTE_LINE, FORECAST_NOTE))
    lines += [(len(TITLES), n, text) for n, text in enumerate(CLOSING)]
    rows = F.array(*[
        F.struct(F.lit(s).alias("section"), F.lit(n).alias("line_no"), F.lit(text).alias("line"))
        for s, n, text in lines
    ])
    return spark.range(1).select(F.explode(rows).alias("row")).select("row.*")


def _lines(df: DataFrame, section: int, line: Column, *order: Column | str) -> DataFrame:
    number = F.row_number().over(Window.orderBy(*order)) + _FIRST_DATA_LINE
    return df.select(F.lit(section).alias("section"), number.alias("line_no"), line.alias("line"))


def _signed_pct(column: str) -> Column:
    shown = F.when(F.col(column).isNotNull(), F.format_string("%+.2f%%", F.col(column)))
    return F.format_string("%8s", F.coalesce(shown, F.lit("—")))


def _executive_line() -> Column:
    name, value = F.col("kpi"), F.col("value")
    return (
        F.when(name.contains("%"), F.format_string("  %-40s: %8.2f%%", name, value))
        .when(name.contains("Transaction") & ~name.contains("Value"),
              F.format_string("  %-40s: %,8.0f", name, value))
        .otherwise(F.format_string("  %-40s: ₹%,11.2f", name, value))
    )


def _period_line(label: str, width: int, growth: str) -> Column:
    return F.format_string(
        f"  %-{width}s ₹%,9.2f ₹%,9.2f %7.1f%% %s %6d",
        F.col(label), real("revenue"), real("profit"), F.col("margin_pct"), _signed_pct(growth),
        F.col("transactions"))


def report_lines(analysis: Analysis, business: str = "RETAIL SALES") -> DataFrame:
    """The whole report; sort by (section, line_no) to read it."""
    by_revenue = F.desc("total_revenue")
    product = F.format_string(
        "  %-12s %4d ₹%,9.2f %5.1f%% %7.1f%%  %s",
        F.col("item"), F.col("revenue_rank"), real("total_revenue"), F.col("revenue_share_pct"),
        F.col("profit_margin_pct"), F.col("quadrant"))
    channel = F.format_string(
        "  %-12s  Revenue: ₹%,9.2f  Share: %.1f%%  Margin: %.1f%%  Avg Bill: ₹%.2f",
        F.col("channel"), real("total_revenue"), F.col("revenue_share_pct"),
        F.col("profit_margin_pct"), F.col("avg_bill"))
    payment = F.format_string(
        "  %-16s  Revenue: ₹%,9.2f  Share: %.1f%%  Avg Bill: ₹%.2f  Txns: %,d",
        F.col("payment_method"), real("total_revenue"), F.col("revenue_share_pct"),
        F.col("avg_bill"), F.col("transactions"))
    anomaly = F.format_string(
        "  ⚠  %s  Revenue: ₹%,.2f  [Fence: ₹%,.0f – ₹%,.0f]",
        F.col("month_label"), real("revenue"), F.col("fence_lower"), F.col("fence_upper"))
    forecast = F.format_string("  %-16s  Forecast: ₹%,10.2f", F.col("month_label"),
                               F.col("forecast_revenue"))
    anomaly_head = analysis.anomalies.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(7).alias("section"), F.lit(_FIRST_DATA_LINE).alias("line_no"),
        F.when(F.col("n") == 0, NO_ANOMALIES).otherwise(ANOMALIES).alias("line"))
    # A blank line precedes each recommendation.
    numbered = analysis.recommendations.withColumn(
        "i", F.row_number().over(Window.orderBy("position")))
    advice = numbered.select(
        F.lit(9).alias("section"),
        F.posexplode(F.array(
            F.lit(""), F.concat(F.lit("  ["), "i", F.lit("] "), "recommendation")
        )).alias("half", "line"),
        "i",
    ).select("section", (F.col("i") * 2 + F.col("half") + _FIRST_DATA_LINE).alias("line_no"), "line")

    parts = [
        _fixed_lines(analysis.executive.sparkSession, business),
        _lines(analysis.executive, 1, _executive_line(), "position"),
        _lines(analysis.monthly, 2, _period_line("month_label", 12, "mom_growth_pct"), "month_start"),
        _lines(analysis.quarterly, 3, _period_line("quarter_label", 10, "qoq_growth_pct"),
               "quarter_label"),
        _lines(analysis.products, 4, product, by_revenue, "item"),
        _lines(analysis.channels, 5, channel, by_revenue, "channel"),
        _lines(analysis.payments, 6, payment, by_revenue, "payment_method"),
        anomaly_head,
        _lines(analysis.anomalies, 7, anomaly, "month_start"),
        _lines(analysis.forecast, 8, forecast, "step"),
        advice,
    ]
    lines = parts[0]
    for part in parts[1:]:
        lines = lines.unionByName(part)
    return lines


def run_analysis(engineered: DataFrame, report_path: str, business: str = "RETAIL SALES",
                 iqr_multiplier: float = 1.5) -> Analysis:
    """Roll up once, analyse, write the report, and return the analyses."""
    analysis = analyse(sales_rollup(engineered), iqr_multiplier)
    write_report(report_lines(analysis, business), report_path)
    return analysis
