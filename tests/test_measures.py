import pytest
from pyspark.sql import functions as F

import frames
from tallybook.operators import measures, visuals


def gap(spark):
    return frames.months(spark, ("2023-01-05", 100), ("2023-02-01", 150), ("2023-04-01", 75))


def values(df, column, order="month_idx"):
    return [r[column] for r in df.orderBy(order).collect()]


def test_calendar_growth_sees_the_gap(spark):
    grown = measures.month_over_month(measures.monthly_spine(gap(spark)))
    # March has no sales: it fell by all of February, and April has no base.
    assert values(grown, "mom_growth") == [None, 0.5, -1.0, None]
    assert values(measures.with_default(grown, "mom_growth", 0.0), "mom_growth") == [0, 0.5, -1, 0]
    labels = grown.withColumn("label", measures.growth_label())
    assert values(labels, "label") == ["—", "▲ 50.0% vs LM", "▼ 100.0% vs LM", "—"]


def test_rolling_always_divides_by_three(spark):
    rolled = measures.rolling_three_months(measures.monthly_spine(gap(spark)))
    assert values(rolled, "revenue_3m_rolling_avg") == pytest.approx([100 / 3, 250 / 3, 250 / 3, 75])


def test_year_over_year_and_year_to_date(spark):
    months = [(f"{y}-{m:02}-01", 100 * (y - 2021) + m) for y in (2022, 2023) for m in range(1, 13)]
    spine = measures.monthly_spine(frames.months(spark, *months))
    year = measures.year_over_year(spine)
    assert values(year, "revenue_py")[:12] == [None] * 12
    assert values(year, "revenue_py")[12:14] == [101, 102]
    assert values(year, "yoy_growth")[12] == pytest.approx(100 / 101)
    total = values(measures.year_to_date(spine), "revenue_ytd")
    assert total[11] == 1278 and total[12] == 201 and total[23] == 2478


def test_spine_by_group_covers_the_whole_range(spark):
    df = frames.sales(spark, ("Tea", 1, 5, "2023-01-01"), ("Cake", 1, 5, "2023-03-01"))
    assert measures.monthly_spine(df, ("item",)).count() == 6


def test_core_measures_round_nothing(spark):
    df = frames.sales(spark, *[("Tea", 1, "0.004", "2023-01-01")] * 5)
    row = measures.core_measures(df).first()
    assert float(row.total_revenue) == 0.02 and float(row.total_cost) == 0.012
    assert row.profit_margin == pytest.approx(0.4) and row.total_transactions == 5
    empty = measures.core_measures(df.limit(0)).first()
    assert (empty.total_transactions, empty.profit_margin, empty.avg_transaction_value) == (0, 0, 0)


def test_contribution_ignores_the_item_filter(spark):
    df = frames.sales(spark, ("Tea", 1, 75, "2023-01-01"), ("Cake", 1, 25, "2023-01-01"),
                      ("Cake", 1, 100, "2023-01-01", "Delivery"))
    got = measures.contribution(df, ("location",), items=["Cake"])
    assert frames.by(got, "location", "revenue_contribution") == {"In-Store": 0.25, "Delivery": 1.0}


def tied(spark):
    return frames.sales(spark, ("Tea", 1, 50, "2023-01-01"), ("Cake", 1, 50, "2023-01-01"),
                        ("Salad", 1, 30, "2023-01-01"), ("Juice", 1, 10, "2023-01-01"))


def test_rank_is_dense_and_the_total_has_none(spark):
    rows = measures.rank_with_total(tied(spark))
    assert frames.by(rows, "item", "revenue_rank") == {
        "Tea": 1, "Cake": 1, "Salad": 2, "Juice": 3, None: None}
    assert rows.filter("is_total").first().total_revenue == 140
    assert frames.by(measures.rank_with_total(tied(spark), ["Juice"]), "item", "revenue_rank") == {
        "Juice": 3, None: None}


def test_top_n_keeps_ties(spark):
    rows = {r.item: r for r in measures.top_n(tied(spark), 1).collect()}
    assert {float(r.top_n_revenue) for r in rows.values()} == {100.0}
    two = {r.item: r for r in measures.top_n(tied(spark), 2).collect()}
    # Two items share the first place: the sum stops there, the dense rank does not.
    assert float(two["Tea"].top_n_revenue) == 100.0 and two["Salad"].is_top_n


def test_margin_classes(spark):
    df = spark.createDataFrame([(0.38,), (0.379,), (0.32,), (0.31,)], "profit_margin double")
    got = [r[0] for r in df.select(measures.margin_class()).collect()]
    assert got == ["High Margin (≥38%)", "Mid Margin (32–38%)", "Mid Margin (32–38%)",
                   "Low Margin (<32%)"]


def test_dates_titles_and_context(spark):
    df = gap(spark)
    days = measures.date_dimension(df)
    assert days.count() == 87 and days.filter("date = '2023-03-15'").count() == 1
    row = measures.titles(df).first()
    assert row.title_date_range == "Revenue Analysis · 05 Jan 2023 – 01 Apr 2023"
    assert row.title_revenue_kpi == "Total Revenue (Apr 2023)"
    chosen = measures.in_context(df, "2023-02-01", "2023-03-31", item=["Tea"], location="In-Store")
    assert chosen.count() == 1


def test_waterfall_ends_at_the_total(spark):
    df = frames.sales(spark, ("Tea", 1, 100, "2023-01-01", "Delivery"),
                      ("Tea", 1, 200, "2023-01-01"))
    rows = visuals.profit_waterfall(df).orderBy("position").collect()
    assert [(r.channel, r.bar_start, r.bar_end) for r in rows] == [
        ("In-Store", 0, 80), ("Delivery", 80, 120), ("Total", 0, 120)]


def test_price_volume_mix_adds_up(spark):
    df = frames.sales(
        spark, ("Tea", 10, 2, "2022-01-01"), ("Cake", 5, 4, "2022-01-01"), ("Juice", 1, 9, "2022-01-01"),
        ("Tea", 20, 3, "2023-01-01"), ("Cake", 5, 4, "2023-01-01"), ("Salad", 1, 7, "2023-01-01"))
    row = visuals.price_volume_mix(df).first()
    assert (row.revenue, row.prior_revenue, row.price_effect) == (87, 49, 20.0)
    assert row.volume_effect == pytest.approx(10 * 49 / 16, abs=0.01)
    assert row.volume_effect + row.price_effect + row.mix_effect == pytest.approx(38)


def test_driver_tree_levels_agree(spark):
    df = frames.sales(spark, ("Tea", 1, 10, "2022-05-01"), ("Tea", 1, 30, "2023-01-01"),
                      ("Cake", 1, 5, "2023-04-01", "Delivery"))
    tree = visuals.driver_tree(df)
    whole = tree.filter("depth = 0").first()
    assert (whole.revenue, whole.prior_revenue, whole.change_pct) == (35, 10, 250.0)
    deepest = tree.filter("depth = 4").agg(F.sum("revenue"), F.sum("prior_revenue")).first()
    assert tuple(deepest) == (35, 10)


def test_heatmap_and_cards(spark):
    df = frames.sales(spark, ("Tea", 1, 10, "2023-01-01", "In-Store", "Credit Card"),
                      ("Tea", 1, 30, "2023-02-01"), ("Tea", 1, 30, "2023-02-01"))
    row = visuals.heatmap(df, ["Cash", "Credit Card", "Debit Card"]).first()
    assert (row.cash, row.credit_card, row.debit_card) == (2, 1, None)
    cards = {r.card: r for r in visuals.kpi_cards(df).collect()}
    assert cards["Revenue"].value == 60 and cards["Revenue"].vs_lm == 5.0
    assert cards["MoM Growth"].value == 5.0 and cards["Revenue"].prior_year is None
