import datetime
import random
import statistics
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricegrid.operators import stats
from pricegrid.operators.catalog import categorise, name_clusters, product_search
from pricegrid.operators.history import price_asof, price_history, price_on_days
from pricegrid.operators.merchants import (
    cheapest_merchant,
    merchant_breakdown,
    merchant_matrix,
    merchant_rank,
)
from pricegrid.operators.rows import drop_repeats, union_all
from pricegrid.operators.stats import price_stats

SCHEMA = "product string, vendor string, price decimal(18,4), price_date date, dataset string"
DAY = datetime.date(2020, 1, 1)


@pytest.fixture(scope="module")
def rows():
    """A third of the rows are one product of one vendor; prices repeat."""
    random.seed(7)
    made = []
    for i in range(1500):
        hot = i % 3 == 0
        product = "hot" if hot else f"p{random.randint(0, 20)}"
        vendor = "v0" if hot else f"v{random.randint(0, 6)}"
        price = Decimal(random.choice([100, 99, 250, 1000])) + Decimal(random.randint(0, 400)) / 100
        made.append((product, vendor, price, DAY + datetime.timedelta(random.randint(0, 90)), f"d{i % 2}"))
    return made


@pytest.fixture(scope="module")
def prices(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def by(rows, *fields):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[f] for f in fields)].append(row)
    return groups


def daily(rows):
    return {k: min(r[2] for r in g) for k, g in by(rows, 0, 1, 3).items()}


def test_breakdown(prices, rows):
    want = {}
    for (product, vendor), group in by(rows, 0, 1).items():
        last = max(r[3] for r in group)
        values = [r[2] for r in group]
        want[product, vendor] = (len(values), min(values), max(values), min(r[2] for r in group if r[3] == last))
    got = {
        (r.product, r.vendor): (r.n_prices, r.min_price, r.max_price, r.latest_price)
        for r in merchant_breakdown(prices).collect()
    }
    assert got == want


def test_rank_and_cheapest(prices, rows):
    offers = {k: min(r[2] for r in g) for k, g in by(rows, 0, 1).items()}
    got = merchant_rank(prices).collect()
    assert len(got) == len(offers)
    for r in got:
        others = {v: p for (product, v), p in offers.items() if product == r.product}
        assert r.price == offers[r.product, r.vendor]
        assert r.price_rank == 1 + sum(p < r.price for p in others.values())
        assert r.gap == r.price - min(others.values())
        assert r.is_cheapest == (min((p, v) for v, p in others.items())[1] == r.vendor)
    best = {(r.product, r.vendor) for r in cheapest_merchant(prices).collect()}
    assert best == {(r.product, r.vendor) for r in got if r.is_cheapest}


def test_matrix(prices, rows):
    offers = {k: min(r[2] for r in g) for k, g in by(rows, 0, 1).items()}
    for r in merchant_matrix(prices, ["v0", "v1"]).collect():
        assert (r.v0, r.v1) == (offers.get((r.product, "v0")), offers.get((r.product, "v1")))


def steps(rows):
    want = []
    days = defaultdict(list)
    for (product, vendor, day), price in daily(rows).items():
        days[product, vendor].append((day, price))
    for key, seen in days.items():
        changes = []
        for day, price in sorted(seen):
            if not changes or changes[-1][1] != price:
                changes.append((day, price))
        ends = [day for day, _ in changes[1:]] + [None]
        want += [(*key, price, day, end) for (day, price), end in zip(changes, ends)]
    return want


def test_history(prices, rows):
    got = price_history(prices.withColumn("price", F.round("price", 0).cast("decimal(18,4)")))
    rounded = [(*r[:2], r[2].quantize(Decimal(1), "ROUND_HALF_UP").quantize(Decimal("1.0000")), *r[3:]) for r in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, steps(rounded)))


def test_prices_on_days_and_as_of(spark, prices, rows):
    days = [DAY + datetime.timedelta(i) for i in (-5, 0, 31, 60, 200)]
    want = {
        (product, vendor, day): price
        for product, vendor, price, start, end in steps(rows)
        for day in days
        if start <= day and (end is None or day < end)
    }
    asked = spark.createDataFrame([(d,) for d in days + days], "day date")
    pairs = [(*key, d) for key in by(rows, 0, 1) for d in days + days]
    on_days = price_on_days(price_history(prices), asked)
    assert {(r.product, r.vendor, r.day): r.price for r in on_days.collect()} == want
    assert on_days.count() == len(want)
    probes = spark.createDataFrame(pairs, "product string, vendor string, day date")
    answers = price_asof(probes, prices).collect()
    assert len(answers) == 2 * len(days) * len(by(rows, 0, 1))
    assert all(r.price == want.get((r.product, r.vendor, r.day)) for r in answers)


def test_no_days_no_prices(spark, prices):
    assert price_on_days(price_history(prices), spark.createDataFrame([], "day date")).count() == 0


def test_stats(prices, rows):
    groups = {("product", k[0]): g for k, g in by(rows, 0).items()}
    groups |= {("dataset", k[0]): g for k, g in by(rows, 4).items()}
    groups["all", "*"] = rows
    got = {(r.grain, r.key): r for r in price_stats(prices).collect()}
    assert got.keys() == groups.keys()
    for key, group in groups.items():
        values, r = [g[2] for g in group], got[key]
        top = max(Counter(values).items(), key=lambda item: (item[1], -item[0]))[0]
        assert (r.n, r.min_price, r.max_price, r.mode_price) == (len(values), min(values), max(values), top)
        assert r.median_price == statistics.median(values)
        assert r.avg_price == pytest.approx(float(statistics.mean(values)))
        if len(values) > 1:
            assert r.stddev_price == pytest.approx(float(statistics.stdev(values)))


def test_stddev_of_one_row_is_null(spark):
    df = spark.createDataFrame([("a", "v", Decimal(5), DAY, "d"), ("a", "v", None, DAY, "d")], SCHEMA)
    assert {r.stddev_price for r in price_stats(df).collect()} == {None}
    assert {r.n for r in price_stats(df).collect()} == {1}


def test_search_and_categories(spark):
    names = ["Leche Entera", "leche", "Azúcar crema", "AZUCAR BLANCA", "Pan"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    got = [(r.name, r.score) for r in product_search(df, "azucar ENTERA leche", k=3).collect()]
    assert got == [("Leche Entera", 2), ("AZUCAR BLANCA", 1), ("Azúcar crema", 1)]
    assert [r.name for r in product_search(df, "leche entera", match_all=True).collect()] == ["Leche Entera"]
    rules = [(2, "az[uú]car", "dulce"), (1, "crema", "lacteo"), (3, "leche", "lacteo")]
    assert [r.category for r in categorise(df, rules).orderBy("id").collect()] == [
        "lacteo", "lacteo", "lacteo", "dulce", "other",
    ]


def test_name_clusters(spark):
    names = ["Crema Azúcar"] * 2 + ["azucar crema"] * 2 + ["AZUCAR, CREMA"] + ["pan"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    got = {r.name: (r.canonical, r.n, r.cluster_n) for r in name_clusters(df).collect()}
    # equal counts: the first spelling in order
    assert got["AZUCAR, CREMA"] == ("Crema Azúcar", 1, 5)
    assert got["pan"] == ("pan", 1, 1)


def test_repeats_and_unions(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 1)], "k int, v string, o int")
    assert {tuple(r) for r in drop_repeats(df, ["k"], ["o"]).collect()} == {(1, "a", 1), (2, "c", 1)}
    both = union_all(df, df.drop("v"))
    assert both.count() == 6 and both.filter("v is null").count() == 3


def test_spread_of_large_prices(spark):
    """Near a thousand million, squares of prices would cancel."""
    import statistics

    values = [Decimal(10**9) + Decimal(i % 7) / 4 for i in range(1000)] + [Decimal(10**9) + 512] * 3
    rows = [("p", "d", v) for v in values] + [("q", "d", Decimal("34.57"))] * 5 + [("r", "d", Decimal(1))]
    df = spark.createDataFrame(rows, "product string, dataset string, price decimal(18,4)")
    got = {r.key: r.stddev_price for r in price_stats(df).collect() if r.grain == "product"}
    assert abs(got["p"] - float(statistics.stdev(values))) < 1e-9
    assert got["q"] == 0 and got["r"] is None


def test_names_without_letters_stay_apart(spark):
    names = ["***", "--", "--", "米", "Хлеб", "ХЛЕБ"]
    rows = {r.name: r for r in name_clusters(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert rows["***"].canonical == "***" and rows["--"].cluster_n == 2
    assert rows["Хлеб"].cluster_n == 2 and rows["米"].cluster_n == 1


def test_levels_are_dealt_out_before_they_are_added_up(spark, monkeypatch):
    """The task that counts levels does not hold their sums of three grains as well."""
    plans, put = [], stats.stage
    monkeypatch.setattr(stats, "stage", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or put(df, name))
    rows = spark.createDataFrame([("a", "x", Decimal(i)) for i in range(50)], "product string, dataset string, price decimal(12,2)")
    assert stats.price_stats(rows).count() == 3
    nodes = [line.split("(")[0].strip(" :+-").split(" ")[0] for line in plans[0].splitlines()]
    found = [n for n in nodes if n in ("Aggregate", "Expand", "RepartitionByExpression")]
    assert found == ["Aggregate", "Expand", "RepartitionByExpression", "Aggregate"]
