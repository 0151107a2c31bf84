"""Registered queries: every operator over the whole trade, page and event tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricegrid import schemas
from pricegrid.functions.dates import add_report_dates
from pricegrid.functions.prices import is_priced, observation_id, parse_price
from pricegrid.functions.records import with_fields
from pricegrid.functions.urls import output_name, report_name
from pricegrid.operators import feeds, html, reports
from pricegrid.operators.catalog import categorise, name_clusters, product_search
from pricegrid.operators.grid import basket_prices
from pricegrid.operators.history import price_asof, price_history, price_on_days
from pricegrid.operators.intervals import overlap_days, overlaps
from pricegrid.operators.medicines import medicine_prices, written_variants
from pricegrid.operators.merchants import (
    cheapest_merchant,
    merchant_breakdown,
    merchant_matrix,
    merchant_rank,
)
from pricegrid.operators.reconcile import bag_intersect, differences, reconciled
from pricegrid.operators.rows import drop_repeats, union_all
from pricegrid.operators.rules import categorise_by_rules
from pricegrid.operators.search_index import search_index, write_index
from pricegrid.operators.states import daily_states, stats_of_states
from pricegrid.operators.stats import price_stats
from pricegrid.plans import standins as data
from pricegrid.plans.standins import money, table
from pricegrid.plans.surveys import medicine_survey, new_reports, survey
from pricegrid.session import scratch_dir, stage
from pricegrid.sinks.files import write_archive, write_feed, write_laid_out_cells, write_report_csv
from pricegrid.sinks.reload import replace_range, replaced
from pricegrid.sinks.snapshots import append_rows, read_snapshot, reload_range
from pricegrid.sources.pages import SEEDS, seeds
from pricegrid.sources.tables import read_archive, read_cells, read_feed, stream_feed
from pricegrid.streaming.load import load_increment
from pricegrid.streaming.repeats import stream_without_repeats
from pricegrid.streaming.windows import daily_prices, open_days, stream_daily_prices

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = datetime.date(2020, 1, 15)
YEAR_1996 = (datetime.date(1996, 1, 1), datetime.date(1996, 12, 31))

# Category rules, the lowest number wins.
RULES = [
    (1, r"\bring\b", "jewelry"),
    (2, r"\b(bolt|rod|plate)\b", "hardware"),
    (3, r"^(hot|cold)\b", "seasonal"),
    (4, r"\b(gear|gizmo|widget)\b", "machinery"),
]


# Pages


def seed_pages(spark, sf_dir):
    """Pages as fetched from the index addresses, by turns."""
    addresses = F.array(*[F.lit(url) for _, url, _ in SEEDS])
    pages = table(spark, sf_dir, "pages").withColumn(
        "url", F.get(addresses, (F.col("page_id") % len(SEEDS)).cast("int"))
    )
    return reports.active_pages(pages, seeds(spark)).select("page_id", "url", "dataset")


def link_extract(spark, sf_dir):
    return html.links(table(spark, sf_dir, "pages"), "nav", None)


def link_extract_parsed(spark, sf_dir):
    return html.parsed_links(table(spark, sf_dir, "pages"), "nav ul li a").select(
        "page_id", "page_url", "pos", "file_url"
    )


def link_markup(spark, sf_dir):
    return html.links(stage(data.link_pages(spark, sf_dir), "pages"))


def link_markup_parsed(spark, sf_dir):
    return html.parsed_links(stage(data.link_pages(spark, sf_dir), "pages"))


def page_first_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", html.first_text(F.col("html"), "h1").alias("title"))


def page_first_text_parsed(spark, sf_dir):
    pages = html.read_pages(table(spark, sf_dir, "pages"), text="article h1")
    return pages.select("page_id", F.col("text").alias("title"))


def stored_file_names(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("file_url"))
    return reports.report_links(pages).select(
        "page_id",
        "file_name",
        "file_id",
        output_name(F.concat(F.lit("store/"), "file_name"), F.lit("generic")).alias("output"),
    )


def url_decode_twice(spark, sf_dir):
    url = F.replace(F.col("url"), F.lit("/"), F.lit("%252F"))
    encoded = F.concat(url, F.lit("+a%2520b%20c%25"))
    return table(spark, sf_dir, "pages").select("page_id", report_name(encoded).alias("name"))


def html_table_rows(spark, sf_dir):
    rows = html.table_rows(data.flower_pages(spark, sf_dir)).filter(F.size("cells") > 0)
    return rows.select("page_id", "row_no", F.array_join("cells", "|").alias("cells"))


def flowers_feed(spark, sf_dir):
    feed = feeds.flowers(data.flower_pages(spark, sf_dir), RUN_DATE)
    return feeds.typed(feed, "price")


def transport_feed(spark, sf_dir):
    feed = feeds.transport_fees(data.fee_pages(spark, sf_dir), RUN_DATE)
    return feeds.typed(feed, "cost")


# Reports


def report_date_range(spark, sf_dir):
    return add_report_dates(data.order_reports(spark, sf_dir), "file_url").select(
        "o_orderkey", "start_date", "end_date", "date_error", "range_inverted"
    )


def new_reports_only(spark, sf_dir):
    """Two datasets link to files of the same names; each has a store and a manifest of its own."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.explode(F.array(F.lit("basic_baskets"), F.lit("dairy_products"))).alias("dataset"),
        F.concat(F.lit("https://example.org/files/r"), "o_orderkey", F.lit(".PDF")).alias("file_url"),
    )
    links = reports.report_links(orders)
    stored = links.filter("o_orderstatus = 'F' and dataset = 'basic_baskets'").select("dataset", "file_name")
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    manifest = returned.select(
        F.lit("dairy_products").alias("dataset"), F.concat(F.lit("r"), "l_orderkey").alias("file_id")
    )
    fresh = reports.not_converted(reports.not_stored(links, stored), manifest)
    return fresh.select("o_orderkey", "dataset", "file_name", "file_id")


def failed_download_pairing(spark, sf_dir):
    links = html.links(table(spark, sf_dir, "pages"), "nav", None).withColumnRenamed("page_id", "item_id")
    links = stage(reports.report_links(links), "links")
    downloads = links.select(
        "item_id",
        "pos",
        "file_url",
        (~F.col("file_url").rlike("[,.]$")).alias("ok"),
        F.concat(F.lit("/store/"), "file_name").alias("path"),
    )
    wanted = reports.items_with_files(links, downloads).select("item_id", "pos", "file_url")
    items = reports.nested_items(reports.paired(wanted, downloads))
    text = F.transform("files", lambda f: F.concat(f["pos"].cast("string"), F.lit("="), f["path"]))
    return items.select("item_id", F.size("files").alias("n_files"), F.array_join(text, "|").alias("files"))


def last_written(spark, sf_dir):
    links = html.links(table(spark, sf_dir, "pages"), "nav", None)
    links = reports.report_links(links).select(
        F.lit("basic_baskets").alias("dataset"), "file_name", "page_id", "pos", "file_url"
    )
    return reports.last_written(links, order=("page_id", "pos"))


# Grids


RENDERED: dict[tuple, str] = {}


def rendered(spark, sf_dir, make: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Grid cells made from the tables, written once a session: they stand for
    a table that is there, and are no part of what a query does."""
    key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
    if key not in RENDERED:
        RENDERED[key] = scratch_dir(spark, "cells", keep=True)
        make(spark, sf_dir).write.parquet(RENDERED[key])
    return read_cells(spark, RENDERED[key])


def baskets(spark, sf_dir):
    return basket_prices(rendered(spark, sf_dir, data.basket_cells))


LAID_OUT: dict[tuple, str] = {}


def baskets_laid_out(spark, sf_dir):
    """The same from cells that lie in buckets of page and block, written once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in LAID_OUT:
        name = f"cells_{len(LAID_OUT)}_{spark.sparkContext.startTime}"
        write_laid_out_cells(rendered(spark, sf_dir, data.basket_cells), name, scratch_dir(spark, "laid-out", keep=True), buckets=8)
        LAID_OUT[key] = name
    return basket_prices(spark.table(LAID_OUT[key]))


def medicines(spark, sf_dir):
    return medicine_prices(rendered(spark, sf_dir, data.medicine_cells))


def grid_guards(spark, sf_dir):
    """Short pages, blank descriptions and repeated cells."""
    return basket_prices(rendered(spark, sf_dir, data.uneven_cells))


def medicine_variants(spark, sf_dir):
    return written_variants(medicines(spark, sf_dir))


def observation_union(spark, sf_dir):
    """Bag union of basket and medicine observations under common names."""
    basket = baskets(spark, sf_dir).withColumnRenamed("description", "product")
    medicine = medicines(spark, sf_dir).withColumnRenamed("medication_name", "product")
    columns = ["dataset", "variant", "product", "unit", "vendor", "price"]
    return union_all(basket, medicine).select(*columns)


def price_parse(spark, sf_dir):
    """Every line's price, written in five ways; next to each a row without a price."""
    price = money("l_extendedprice")
    grouped = F.format_number(price, 2)
    way = F.col("l_linenumber") % 5
    text = (
        F.when(way == 1, F.concat(F.lit("RD$"), grouped))
        .when(way == 2, F.translate(grouped, ",.", ".,"))
        .when(way == 3, price.cast("string"))
        .when(way == 4, F.translate(F.format_number(F.floor(price), 0), ",", "."))
        .otherwise(F.concat(F.translate(price.cast("string"), ".", ","), F.lit(" c/u")))
    )
    lines = table(spark, sf_dir, "lineitem")
    none = F.when(way < 2, "0.00").when(way == 2, "--").otherwise("")
    texts = lines.select("l_orderkey", "l_linenumber", text.alias("text")).unionByName(
        lines.select("l_orderkey", "l_linenumber", none.alias("text"))
    )
    parsed = texts.select("l_orderkey", "l_linenumber", parse_price(F.col("text")).alias("price"))
    return parsed.filter(is_priced(F.col("price")))


# Prices


def breakdown(spark, sf_dir):
    return merchant_breakdown(data.prices(spark, sf_dir, "p_name", "s_name"))


def rank(spark, sf_dir):
    return merchant_rank(data.prices(spark, sf_dir, "p_name", "s_name"))


def cheapest(spark, sf_dir):
    return cheapest_merchant(data.prices(spark, sf_dir, "p_name", "s_name"))


def matrix(spark, sf_dir):
    result = merchant_matrix(data.prices(spark, sf_dir, "p_name", "r_name"), data.REGIONS)
    return result.withColumnRenamed("MIDDLE EAST", "MIDDLE_EAST")


def history(spark, sf_dir):
    return price_history(data.quantities(spark, sf_dir))


def on_month_starts(spark, sf_dir):
    """The price of every brand and region on the first of each order month."""
    months = table(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("day")
    )
    return price_on_days(history(spark, sf_dir), months)


def asof_order_day(spark, sf_dir):
    """For each order line the last price seen up to the day it was ordered."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(data.suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    probes = lines.select(
        "l_orderkey",
        F.col("p_brand").alias("product"),
        F.col("r_name").alias("vendor"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    return price_asof(probes, data.prices(spark, sf_dir, "p_brand", "r_name"))


def priced_lines(spark, sf_dir, price):
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("p_brand").alias("product"), F.col("p_type").alias("dataset"), price.alias("price"))
    )


def stats_of_large_prices(spark, sf_dir):
    """Prices above a thousand million that differ by less than one."""
    price = (F.lit(1_000_000_000) + money("l_quantity") / 100).cast("decimal(18,4)")
    result = price_stats(priced_lines(spark, sf_dir, price))
    return result.select("grain", "key", "n", "mode_price", F.round("stddev_price", 8).alias("stddev_price"))


def stats(spark, sf_dir):
    result = price_stats(priced_lines(spark, sf_dir, money("l_extendedprice")))
    rounded = {c: F.round(F.col(c), 2) for c in ("avg_price", "stddev_price")}
    return result.withColumns(
        {**rounded, "median_price": F.round(F.col("median_price").cast("double"), 3)}
    )


# Catalogue


def parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))


def search(spark, sf_dir):
    return product_search(parts(spark, sf_dir), "Small RÉD widget", k=20)


def search_scripts(spark, sf_dir):
    return product_search(data.spelled_parts(spark, sf_dir), "молоко Łódź 米", k=20)


def clusters_scripts(spark, sf_dir):
    return name_clusters(data.spelled_parts(spark, sf_dir))


def categories(spark, sf_dir):
    return categorise(parts(spark, sf_dir), RULES)


def indexed_search(spark, sf_dir):
    """The same search over a stored index."""
    path = scratch_dir(spark, "index")
    write_index(parts(spark, sf_dir), path)
    return search_index(spark, path, "Small RÉD widget", k=20)


def indexed_search_scripts(spark, sf_dir):
    path = scratch_dir(spark, "index")
    write_index(data.spelled_parts(spark, sf_dir), path)
    return search_index(spark, path, "молоко Łódź 米", k=20)


def categories_by_rules(spark, sf_dir):
    """Parts with their brand and number in the name, by a table of rules, one for each customer."""
    name = F.concat_ws(" ", "p_name", "p_brand", F.lit("no."), F.col("p_partkey").cast("string"))
    products = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), name.alias("name"))
    key = F.col("c_custkey")
    brand, text = (key % 25 + 1).cast("string"), key.cast("string")
    pattern = (
        F.when(key % 500 == 499, r"^[a-z]{3}\s[a-z]{3,4}\s")  # requires no text
        .when(key % 4 == 0, F.concat(F.lit(r"\bNO\. 0*"), text, F.lit(r"\z")))
        .when(key % 4 == 1, F.concat(F.lit(r"^(?:hot|cold) \w+ brand#"), brand, F.lit(r"\b")))
        .when(key % 4 == 2, F.concat(F.lit(r"\b(bolt|rod)s? Brand#"), brand, F.lit(r" no\. \d*"), (key % 10).cast("string"), F.lit("$")))
        .otherwise(F.concat(F.lit("(large|small) .*#"), brand, F.lit(" no")))
    )
    category = F.concat_ws("-", "c_mktsegment", text)
    # narrow rules come first
    number = F.when(key % 4 == 0, key).when(key % 4 == 2, 10**9 + key).when(key % 500 == 499, 3 * 10**9 + key).otherwise(2 * 10**9 + key)
    rules = table(spark, sf_dir, "customer").select(number.alias("rule_no"), pattern.alias("pattern"), category.alias("category"))
    return categorise_by_rules(products, rules).select("id", "name", "category")


def period_overlaps(spark, sf_dir):
    """Price steps that hold during the weeks of a quarter's reports, with the days they share."""
    steps = history(spark, sf_dir).select("product", "vendor", "price", "valid_from", F.date_sub("valid_to", 1).alias("valid_last"))
    orders = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderdate").cast("date").alias("first")).distinct()
    periods = orders.withColumn("last", F.date_add("first", 6))
    brands = table(spark, sf_dir, "part").select(F.col("p_brand").alias("product")).distinct()
    # a report covers one brand, by turns of the days
    turn = F.substring_index("product", "#", -1).cast("int")
    reports_ = periods.withColumn("turn", F.unix_date("first") % 25 + 1).join(brands.withColumn("turn", turn), "turn").drop("turn")
    met = overlaps(reports_, steps, ["product"], ("first", "last"), ("valid_from", "valid_last"))
    days = overlap_days((F.col("left.first"), F.col("left.last")), (F.col("right.valid_from"), F.coalesce("right.valid_last", F.lit("9999-12-31").cast("date"))))
    return met.select("left.product", "left.first", "left.last", "right.vendor", "right.price", "right.valid_from", days.alias("days"))


def clusters(spark, sf_dir):
    """Part names, spelled in four ways by type."""
    name, kind = F.col("p_name"), F.col("p_type")
    spelled = (
        F.when(kind == "PROMO", F.upper(name))
        .when(kind == "LARGE", F.regexp_replace(name, r"^(\w+) (\w+)$", "$2, $1"))
        .when(kind == "SMALL", F.concat(F.lit("* "), name, F.lit(" *")))
        .otherwise(name)
    )
    return name_clusters(table(spark, sf_dir, "part").select(spelled.alias("name")))


# Feeds, files, reloads


def event_feed(events: DataFrame) -> DataFrame:
    """Events as cleaned feed rows."""
    return events.select(
        observation_id("event_id", "event_type").alias("id"),
        F.col("event_type").alias("dataset"),
        F.col("ts").cast("date").alias("start_date"),
        "user_id",
        F.col("value").cast("decimal(18,4)").alias("price"),
    )


def feed_dedup(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("day"), "event_id", "value"
    )
    return drop_repeats(events, ["user_id", "event_type", "day"], ["event_id"])


def event_stream(spark, sf_dir):
    # a pattern, so that it may be one file or a folder of files
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")


def feed_dedup_stream(spark, sf_dir):
    """The keys of ``feed_dedup``, found by a stream of four files out of order.

    Keys that came late once are in the other output; both together are all.
    """
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.col("ts").cast("date").alias("day")
    )
    files = scratch_dir(spark, "events")
    events.repartition(4, F.hash("user_id", "ts")).write.parquet(files)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    key, (out, late, state) = ["user_id", "event_type", "day"], (scratch_dir(spark, n) for n in ("dedup", "late", "state"))
    stream_without_repeats(feed, key, "1 day", out, late, state)
    both = [spark.read.schema(events.schema).parquet(folder).select(*key) for folder in (out, late)]
    return union_all(*both).distinct()


def incremental_load(spark, sf_dir):
    """Events loaded as a feed, delivered twice."""
    archive = scratch_dir(spark, "archive")
    for run in ("first", "again"):
        load_increment(
            event_stream(spark, sf_dir), archive, scratch_dir(spark, f"load-{run}"), event_feed
        )
    return read_archive(spark, archive).select("id", "dataset", "start_date", "user_id", "price")


def order_archive(spark, sf_dir):
    """Orders as archive rows, dated by quarter."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("dataset"),
        F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("start_date"),
        money("o_totalprice").alias("price"),
    )


def corrected_orders(spark, sf_dir):
    """The new load: final and open orders only, at corrected prices."""
    price = (F.col("price") * F.lit(2)).cast("decimal(12,2)")
    return order_archive(spark, sf_dir).filter("dataset <> 'P'").withColumn("price", price)


def without_some_datasets(orders: DataFrame) -> DataFrame:
    """Some rows lose their dataset, others have an empty one."""
    kind = F.col("id") % 7
    return orders.withColumn("dataset", F.when(kind == 1, F.lit("")).when(kind > 1, F.col("dataset")))


def replace_rows(spark, sf_dir):
    return replaced(order_archive(spark, sf_dir), corrected_orders(spark, sf_dir), *YEAR_1996)


def archive_reload(spark, sf_dir):
    """The same replacement made in snapshots of an archive, twice, with datasets
    that are missing or empty and a quarter that the new load does not have."""
    path = scratch_dir(spark, "orders")
    append_rows(spark, path, without_some_datasets(order_archive(spark, sf_dir)))
    new = without_some_datasets(corrected_orders(spark, sf_dir)).filter("start_date <> date'1996-07-01'")
    for _ in range(2):
        reload_range(spark, path, new, *YEAR_1996)
    return read_snapshot(spark, path).select("id", "dataset", "start_date", "price")


def archive_reload_in_place(spark, sf_dir):
    """The same once more, folder by folder in the archive itself."""
    path = scratch_dir(spark, "orders")
    write_archive(without_some_datasets(order_archive(spark, sf_dir)), path)
    new = without_some_datasets(corrected_orders(spark, sf_dir)).filter("start_date <> date'1996-07-01'")
    for _ in range(2):
        replace_range(spark, path, new, *YEAR_1996)
    return read_archive(spark, path).select("id", "dataset", "start_date", "price")


def processed_orders(orders: DataFrame) -> DataFrame:
    """Orders as a careless run leaves them: some are lost, some come twice, some at another price."""
    key = F.col("id")
    price = F.when(key % 17 == 3, (F.col("price") + 1).cast("decimal(12,2)")).otherwise(F.col("price"))
    times = F.when(key % 11 == 5, 0).when(key % 13 == 2, 3).otherwise(1)
    changed = orders.withColumn("price", price).withColumn("times", times).filter("times > 0")
    return changed.withColumn("i", F.explode(F.sequence(F.lit(1), "times"))).drop("i", "times")


def archive_differences(spark, sf_dir):
    """Rows that a raw and a processed archive do not have equally often."""
    raw, done = scratch_dir(spark, "raw"), scratch_dir(spark, "processed")
    orders = without_some_datasets(order_archive(spark, sf_dir))
    write_archive(orders, raw)
    write_archive(processed_orders(orders), done)
    return differences(read_archive(spark, raw), read_archive(spark, done)).select("id", "dataset", "start_date", "price", "n_lost", "n_extra")


def archive_reconciled(spark, sf_dir):
    """The same per dataset and day, counted."""
    orders = without_some_datasets(order_archive(spark, sf_dir))
    return reconciled(orders, processed_orders(orders), ["dataset", "start_date"])


def archive_common(spark, sf_dir):
    """Rows of both archives, as often as both have them."""
    orders = order_archive(spark, sf_dir)
    return bag_intersect(orders.union(orders), processed_orders(orders))


def event_fields(spark, sf_dir):
    """The events' properties by path, with broken text, other types and deeper values among them."""
    key, props = F.col("event_id"), F.col("props")
    kind = key % 10
    text = (
        F.when(kind == 1, F.expr("substring(props, 1, length(props) - 1)"))
        .when(kind == 2, F.lit('{"k": "x"}'))
        .when(kind == 3, F.lit('{"k": null}'))
        .when(kind == 4, F.lit(None).cast("string"))
        .when(kind == 5, F.concat(F.lit('{"d": {"x": [0, '), key.cast("string"), F.lit("]}}")))
        .otherwise(props)
    )
    feed = table(spark, sf_dir, "events").select("event_id", text.alias("props"))
    return with_fields(feed, "props", {"k": ("$.k", "int"), "x": ("$.d.x[1]", "bigint")})


def stats_of_1996(spark, sf_dir):
    """Statistics of a year out of daily states of all years; the medians' ranks are tested elsewhere."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = lines.select("p_brand", "p_type", F.col("l_shipdate").cast("date").alias("start_date"), money("l_extendedprice").alias("price"))
    states = stage(daily_states(rows, ["p_brand", "p_type"]), "states")
    year = states.filter(F.col("start_date").between(*map(F.lit, YEAR_1996)))
    merged = stats_of_states(year, ["p_brand", "p_type"])
    return merged.select(
        "p_brand", "p_type", "n", "min_price", "max_price",
        F.round("avg_price", 2).alias("avg_price"), F.round("stddev_price", 2).alias("stddev_price"),
    )


def daily_price_stream(spark, sf_dir):
    """Daily prices of events from a stream of four files in order of time, with the days that are still open at the end."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset"), F.concat(F.lit("v"), F.col("user_id") % 5).alias("vendor"),
        F.col("value").cast("decimal(18,4)").alias("price"), F.col("ts").cast("timestamp").alias("ts"),
    )
    files, out, state = (scratch_dir(spark, n) for n in ("events", "days", "state"))
    week = F.floor((F.dayofmonth("ts") - 1) / 8).cast("int")
    for n in range(4):  # one file after the other, as they come
        events.filter(week == n).coalesce(1).write.mode("append").parquet(files)
    feed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(files)
    stream_daily_prices(feed, "1 day", out, state)
    written = spark.read.parquet(out).select("day", "dataset", "vendor", "n", "min_price", "max_price", "total")
    still = open_days(spark, state).join(daily_prices(events), ["day", "dataset", "vendor", "n"]).select(*written.columns)
    return written.withColumn("is_open", F.lit(False)).unionByName(still.withColumn("is_open", F.lit(True)))


def archive_range(spark, sf_dir):
    """A date range read back from an archive."""
    path = scratch_dir(spark, "orders")
    write_archive(order_archive(spark, sf_dir), path)
    return read_archive(spark, path, *YEAR_1996).select("id", "dataset", "start_date", "price")


def report_csv_export(spark, sf_dir):
    """Basket observations of two datasets that share their files' names, written
    as CSV per report, twice, and read back."""
    path = scratch_dir(spark, "reports")
    columns = schemas.PRICE_OBS.names
    # put down, as it is read twice by each of two writes
    own = stage(baskets(spark, sf_dir).select(*columns), "observations")
    both = union_all(own, own.withColumn("dataset", F.lit("dairy_products")))
    for _ in range(2):
        write_report_csv(both, path)
    return read_feed(spark, path, schemas.PRICE_OBS).select(*columns)


def medicine_csv_export(spark, sf_dir):
    """Medicine observations written as CSV per report and variant, twice."""
    path = scratch_dir(spark, "reports")
    columns = schemas.MEDICINE_OBS.names
    own = stage(medicines(spark, sf_dir).select("dataset", *columns), "observations")
    for _ in range(2):
        write_report_csv(own, path, "dataset", "file_id", "variant")
    return read_feed(spark, path, schemas.MEDICINE_OBS).select(*columns)


def feed_csv(spark, sf_dir):
    """The flower feed written as one run's CSV and read back."""
    feed = feeds.flowers(data.flower_pages(spark, sf_dir), RUN_DATE)
    fields = schemas.FLOWERS.names
    path = write_feed(feed, scratch_dir(spark, "feeds"), "flowers", "2020-01-15", fields)
    return read_feed(spark, path, schemas.FLOWERS).select(*fields)


def linked_reports(spark, sf_dir, dataset):
    """Index pages, their seeds, and the reports that are stored already.

    Another dataset holds all files under the same names, which changes nothing.
    """
    pages = stage(data.index_pages(spark, sf_dir), "index")
    index = pages.select("url", F.lit(dataset).alias("dataset"), F.lit(True).alias("active"))
    parts = data.parts_by_region(spark, sf_dir).select("file_url", "p_type", "p_brand", "p_size")
    held = parts.filter("p_type = 'PROMO' and p_brand = 'Brand#5' and p_size <= 5")
    own = held.select("file_url", F.lit(dataset).alias("dataset"))
    others = parts.select("file_url", F.lit("text_books").alias("dataset"))
    return pages, index, reports.report_links(own.union(others).distinct())


def survey_end_to_end(spark, sf_dir):
    """From index pages over links and new reports to observations, for two datasets that share their files."""
    pages, index, stored = linked_reports(spark, sf_dir, "hardware_products")
    # a second dataset has index pages of its own, which link to the same files
    other = pages.withColumn("url", F.concat("url", F.lit("?dairy")))
    pages = pages.union(other)
    index = index.union(other.select("url", F.lit("dairy_products"), F.lit(True)))
    cells = rendered(spark, sf_dir, data.basket_cells)
    found = new_reports(pages, index, stored)
    return survey(cells, found, stored).select(*schemas.PRICE_OBS.names)


def medicine_survey_end_to_end(spark, sf_dir):
    """The same for medicines, with pages that are too narrow for a vendor."""
    pages, index, stored = linked_reports(spark, sf_dir, "medicines")
    found = new_reports(pages, index, stored)
    observations = medicine_survey(rendered(spark, sf_dir, data.narrow_medicine_cells), found, stored)
    return observations.select(*schemas.MEDICINE_OBS.names)


def feed_cleanup(spark, sf_dir):
    return feeds.cleaned(data.untidy_feed(spark, sf_dir), "price", folded=("vendor", "unit"))


def daily_feed_load(spark, sf_dir):
    """The bus fare feed as CSV, picked up by a stream and archived."""
    feed = feeds.transport_fees(data.fee_pages(spark, sf_dir), RUN_DATE)
    root, archive = scratch_dir(spark, "feeds"), scratch_dir(spark, "archive")
    write_feed(feed, root, "fees", "2020-01-15", schemas.TRANSPORT_FEES.names)

    def clean(rows: DataFrame) -> DataFrame:
        tidy = feeds.cleaned(rows, "cost")
        return tidy.select(
            observation_id("phone_number", "line", "last_updated_at").alias("id"),
            F.lit("transportation_fees").alias("dataset"),
            F.col("last_updated_at").alias("start_date"),
            "representative",
            "stop",
            "cost",
        )

    stream = stream_feed(spark, f"{root}/fees/*", schemas.TRANSPORT_FEES)
    load_increment(stream, archive, scratch_dir(spark, "state"), clean)
    return read_archive(spark, archive).select("id", "dataset", "start_date", "representative", "stop", "cost")


QUERIES: dict[str, Query] = {
    "seed_pages": seed_pages,
    "link_extract": link_extract,
    "link_extract_parsed": link_extract_parsed,
    "link_markup": link_markup,
    "link_markup_parsed": link_markup_parsed,
    "page_first_text": page_first_text,
    "page_first_text_parsed": page_first_text_parsed,
    "stored_file_name": stored_file_names,
    "url_decode_twice": url_decode_twice,
    "html_table_rows": html_table_rows,
    "flowers_feed": flowers_feed,
    "transport_feed": transport_feed,
    "report_date_range": report_date_range,
    "new_reports_only": new_reports_only,
    "failed_download_pairing": failed_download_pairing,
    "last_written": last_written,
    "grid_to_long": baskets,
    "grid_to_long_laid_out": baskets_laid_out,
    "grid_guards": grid_guards,
    "medicine_split": medicines,
    "medicine_variants": medicine_variants,
    "observation_union": observation_union,
    "price_parse": price_parse,
    "merchant_breakdown": breakdown,
    "merchant_rank": rank,
    "cheapest_merchant": cheapest,
    "merchant_matrix": matrix,
    "price_history": history,
    "price_on_days": on_month_starts,
    "price_asof": asof_order_day,
    "price_stats": stats,
    "price_stats_large": stats_of_large_prices,
    "product_search": search,
    "product_search_scripts": search_scripts,
    "product_search_indexed": indexed_search,
    "product_search_indexed_scripts": indexed_search_scripts,
    "product_category": categories,
    "product_category_rules": categories_by_rules,
    "period_overlaps": period_overlaps,
    "name_cluster": clusters,
    "name_cluster_scripts": clusters_scripts,
    "feed_dedup": feed_dedup,
    "feed_dedup_stream": feed_dedup_stream,
    "incremental_load": incremental_load,
    "replace_range": replace_rows,
    "archive_reload": archive_reload,
    "archive_reload_in_place": archive_reload_in_place,
    "archive_range": archive_range,
    "archive_differences": archive_differences,
    "archive_reconciled": archive_reconciled,
    "archive_common": archive_common,
    "event_fields": event_fields,
    "price_stats_range": stats_of_1996,
    "daily_price_stream": daily_price_stream,
    "report_csv_export": report_csv_export,
    "medicine_csv_export": medicine_csv_export,
    "feed_csv": feed_csv,
    "survey_end_to_end": survey_end_to_end,
    "medicine_survey": medicine_survey_end_to_end,
    "feed_cleanup": feed_cleanup,
    "daily_feed_load": daily_feed_load,
}
