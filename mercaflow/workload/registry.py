"""Every operator as a query over the supplied tables.

Doubles that come from divisions or moments are rounded here, for a
comparison by value; the operators themselves return them in full.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mercaflow.config import JobConfig, TransactionFeed
from mercaflow.functions.columns import decimal_column
from mercaflow.operators import kpis, states
from mercaflow.operators.fact import FACT_KEYS, fact_sales_daily
from mercaflow.operators.quality import quality_report
from mercaflow.operators.transactions import standardize_transactions, to_silver_names, union_feeds
from mercaflow.operators.weather import attach_weather, prepare_weather_features
from mercaflow.plans.bronze import ingest, list_weather, read_weather_files, run_bronze
from mercaflow.plans.gold import run_gold
from mercaflow.plans.silver import run_silver
from mercaflow.plans.states import merged_frames
from mercaflow.session import SHUFFLES_GO, setting, shared_folder, sort_partitions
from mercaflow.sinks.swap import folder_names
from mercaflow.sinks.tables import fill_partitions, with_dt, write_table
from mercaflow.sources.borders import stored
from mercaflow.sources.feeds import read_json_source, read_parquet_source
from mercaflow.sources.tables import load_transactions, load_weather
from mercaflow.workload import views

Query = Callable[[SparkSession, str], DataFrame]
RUN_DATE = "2025-10-11"


def _rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _over_sales(
    kpi: Callable[[DataFrame], DataFrame],
    *columns: str,
    dirty: bool = False,
    yearly: bool = False,
    rounded: Sequence[str] = (),
) -> Query:
    """Query of an indicator over the sales view with the columns it reads."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = views.sales(spark, sf_dir, columns, dirty)
        if yearly:
            customer = F.concat_ws("-", "customer_id", F.year("txn_date"))
            df = df.withColumn("customer_id", customer)
        return _rounded(kpi(df), rounded)

    return query


def _silver_columns(df: DataFrame) -> DataFrame:
    txn_ts = F.date_format("txn_ts", "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("txn_ts", txn_ts).drop("load_ts", "ingestion_date", "run_date", "txn_date")


def silver_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = views.english_feed(spark, sf_dir).withColumn("source", F.lit("english"))
    return _silver_columns(standardize_transactions(feed))


def silver_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    english = views.english_feed(spark, sf_dir, "O").withColumn("source", F.lit("english"))
    spanish = views.spanish_feed(spark, sf_dir, "F").withColumn("source", F.lit("spanish"))
    return _silver_columns(union_feeds([english, spanish]))


def decimal_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.sales(spark, sf_dir, ["region", "txn_date", "revenue"])
    month = F.date_trunc("month", "txn_date").cast("date").alias("txn_month")
    revenue = F.sum(decimal_column(F.col("revenue"), 18, 4)).cast("double")
    return df.groupBy("region", month).agg(
        revenue.alias("revenue"), F.count(F.lit(1)).alias("records")
    )


def _daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather as gold meets it, computed once: the attachment looks at its
    size before it joins."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(spark, "checkpoint"))
    return prepare_weather_features(views.daily_weather_feed(spark, sf_dir)).checkpoint()


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = prepare_weather_features(views.hourly_weather_feed(spark, sf_dir))
    return _rounded(daily, ["weather_avg_temp", "weather_precipitation", "weather_wind_speed"])


def weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = prepare_weather_features(views.daily_weather_feed(spark, sf_dir))
    return _rounded(daily, ["weather_avg_temp", "weather_precipitation"])


def weather_no_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_weather_features(views.daily_weather_feed(spark, sf_dir).select("region", "time"))


ATTACH_COLUMNS = ["txn_id", "product_id", "txn_date", "region", "quantity"]


def attach_weather_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales(spark, sf_dir, ATTACH_COLUMNS)
    df = attach_weather(sales, _daily_weather(spark, sf_dir))
    return _rounded(df, ["weather_avg_temp", "weather_precipitation"])


def attach_weather_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    weather = _daily_weather(spark, sf_dir).withColumn("region", F.lit(None).cast("string"))
    df = attach_weather(views.sales(spark, sf_dir, ATTACH_COLUMNS), weather)
    return _rounded(df, ["weather_avg_temp", "weather_precipitation"])


def attach_weather_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_weather(views.sales(spark, sf_dir, ATTACH_COLUMNS), None)


WEATHER_IMPACT_DOUBLES = ["corr_temp_revenue", "corr_precip_revenue", "avg_temp", "avg_precip"]


def weather_impact(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales(spark, sf_dir, ["region", "txn_date", "revenue"])
    days = attach_weather(kpis.region_days(sales), _daily_weather(spark, sf_dir))
    impact = kpis.weather_impact_of_days(days)
    return _rounded(impact, WEATHER_IMPACT_DOUBLES)


FACT_COLUMNS = [
    *FACT_KEYS,
    "txn_id",
    "customer_id",
    "channel",
    "payment_method",
    "quantity",
    "revenue",
]


def _fact_partitions(spark: SparkSession, sf_dir: str) -> int:
    return sort_partitions(spark, [f"{sf_dir}/lineitem.parquet"])


def fact_with_weather(spark: SparkSession, sf_dir: str, exact: bool = True) -> DataFrame:
    sales = views.sales(spark, sf_dir, FACT_COLUMNS)
    return fact_sales_daily(sales, _daily_weather(spark, sf_dir), exact, partitions=_fact_partitions(spark, sf_dir))


def _fact_scalars(df: DataFrame) -> DataFrame:
    """The fact with the sizes of its maps, which have no order to compare."""
    sizes = {m: F.size(m) for m in ("channel_mix", "payment_mix")}
    return _rounded(df.withColumns(sizes), ["weather_avg_temp", "weather_precipitation"])


def fact_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_scalars(fact_with_weather(spark, sf_dir))


def fact_scalars_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = views.sales(spark, sf_dir, FACT_COLUMNS, dirty=True)
    return _fact_scalars(fact_sales_daily(sales, partitions=_fact_partitions(spark, sf_dir)))


def _mix_rows(mix: str, value: str, dirty: bool = False) -> Query:
    """A mix of the fact, one row per map entry."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        sales = views.sales(spark, sf_dir, FACT_COLUMNS, dirty)
        fact = fact_sales_daily(sales, partitions=_fact_partitions(spark, sf_dir))
        return fact.select(*FACT_KEYS, F.explode(mix).alias(value, "revenue"))

    return query


def partition_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["txn_id", "product_id", "store_id", "channel", "txn_date", "region", "category"]
    return fill_partitions(with_dt(views.sales(spark, sf_dir, columns, dirty=True), RUN_DATE))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["txn_id", "customer_id", "region", "channel"]
    return quality_report(views.sales(spark, sf_dir, columns, dirty=True), columns)


def bronze_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read_parquet_source(spark, f"{sf_dir}/orders.parquet", "orders", RUN_DATE)
    return df.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "source",
        "ingestion_date",
        F.element_at(F.split("file_name", "/"), -1).alias("file_name"),
        F.col("load_ts").isNotNull().alias("has_load_ts"),
    )


def bronze_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items written as JSON documents and read back through the source."""
    path = shared_folder(spark, "json")
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    lines = views.table(spark, sf_dir, "lineitem").select(columns)
    lines.write.json(path)
    df = read_json_source(
        spark, path, "lineitem", RUN_DATE, schema=lines.schema, multiline=False
    )
    file_type = F.element_at(F.split("file_name", r"\."), -1)
    return df.select(*columns, "source", "ingestion_date", file_type.alias("file_type"))


def bronze_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut short on one line in seven, through the bronze ingestion:
    the good and the set-apart rows together."""
    lines = views.table(spark, sf_dir, "lineitem")
    document = F.format_string(
        '{"transaction_id":"%s","line":%s', F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    )
    text = F.when(F.col("l_linenumber") == 7, document).otherwise(F.concat(document, F.lit("}")))
    raw_path, path, bad_path = (shared_folder(spark, n) for n in ("raw", "bronze", "badrecords"))
    lines.select(text.alias("value")).write.text(raw_path)
    raw = read_json_source(spark, raw_path, "lineitem", RUN_DATE, multiline=False)
    ingest(raw, path, bad_path, {"ingestion_date": RUN_DATE, "source": "lineitem"})
    good, bad = spark.read.parquet(path), spark.read.parquet(bad_path)
    return (
        good.select(
            F.lit(None).cast("string").alias("raw_text"),
            "transaction_id",
            "line",
            F.lit(False).alias("quarantined"),
        )
        .union(
            bad.select(
                F.col("_corrupt_record"),
                F.lit(None).cast("string"),
                F.lit(None).cast("bigint"),
                F.lit(True),
            )
        )
    )


def _new_lake(spark: SparkSession, sf_dir: str) -> JobConfig:
    """Raw feeds of all lines and events, taken through the bronze and the
    silver job."""
    base = shared_folder(spark, "lake")
    feeds = tuple(
        TransactionFeed(name, multiline=False, schema=rows.schema.simpleString()[len("struct<") : -1])
        for name, rows in (("english", views.english_feed(spark, sf_dir)), ("spanish", views.spanish_feed(spark, sf_dir)))
    )
    config = JobConfig(
        base, RUN_DATE, feeds=feeds, weather_feed="meteo", register=False
    )
    raw = {
        "english": views.english_feed(spark, sf_dir, "O"),
        "spanish": views.spanish_feed(spark, sf_dir, "F"),
    }
    for feed in feeds:
        path = f"{base}/raw/{feed.name}/ingestion_date={RUN_DATE}"
        with setting(spark, SHUFFLES_GO, "true"):
            raw[feed.name].write.json(path, compression="gzip")
    views.daily_weather_feed(spark, sf_dir).write.parquet(f"{base}/raw/api/{config.weather_feed}")
    run_bronze(spark, config)
    run_silver(spark, config)
    return config


# The lakes of each session and table folder; what reads them changes only gold
# tables and aggregates.
_LAKES: dict[tuple[str, str, str], JobConfig] = {}


def _once(kind: str, make: Callable[[SparkSession, str], JobConfig], spark: SparkSession, sf_dir: str) -> JobConfig:
    """One lake of a kind for all queries of a session over the same tables."""
    key = (kind, spark.sparkContext.applicationId, sf_dir)
    known = _LAKES.get(key)
    if known is None or not folder_names(spark, known.input_bucket, known.input_bucket):
        _LAKES[key] = make(spark, sf_dir)
    return _LAKES[key]


def _medallion(spark: SparkSession, sf_dir: str) -> JobConfig:
    return _once("feeds", _new_lake, spark, sf_dir)


def medallion_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _medallion(spark, sf_dir)
    stored = load_transactions(spark, config.silver_path(config.transactions_table), RUN_DATE)
    return _silver_columns(stored)


def medallion_weather_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _medallion(spark, sf_dir)
    stored = load_weather(spark, config.silver_path(config.weather_table), RUN_DATE)
    return _rounded(stored.drop("run_date"), ["weather_avg_temp", "weather_precipitation"])


def _medallion_gold(name: str, rounded: Sequence[str] = ()) -> Query:
    """A gold table as stored by the gold job."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _medallion(spark, sf_dir)
        run_gold(spark, config, [name])
        return _rounded(spark.read.parquet(config.gold_path(name)).drop("dt"), rounded)

    return query


def _stored_gold(name: str, adapt: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    """A gold table as stored, with its run date."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _medallion(spark, sf_dir)
        run_gold(spark, config, [name])
        return adapt(_text_dt(spark.read.parquet(config.gold_path(name))))

    return query


def _text_dt(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", F.col("dt").cast("string"))


def medallion_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date run twice: the second time one feed is gone, and with it all it
    had brought, such as the partition of lines without a date."""
    config = _new_lake(spark, sf_dir)
    run_gold(spark, config, ["customer_frequency_ticket"])
    again = replace(config, feeds=(replace(config.feeds[0], name="nothing"), config.feeds[1]))
    run_bronze(spark, again)
    run_silver(spark, again)
    run_gold(spark, again, ["customer_frequency_ticket"])
    return _text_dt(spark.read.parquet(config.gold_path("customer_frequency_ticket")))


def bronze_json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as files of one array, of a document a line, of documents side
    by side and printed over several lines, and of documents behind a byte-order
    mark and a scalar, read in the mode that takes a file for one document."""
    path = shared_folder(spark, "multiline")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    document = F.to_json(F.struct("o_orderkey", "o_custkey", "o_orderstatus"))
    printed = F.regexp_replace(document, "([{,])", "$1\n ")
    forms = ("lines", "printed", "side_by_side", "arrays", "marked")
    form = F.pmod(F.xxhash64("o_orderkey", "o_custkey"), F.lit(len(forms)))
    documents = orders.select(document.alias("document"), printed.alias("printed"), form.alias("form"))
    for number, name in enumerate(forms):
        own = documents.filter(F.col("form") == number)
        if name in ("lines", "printed"):
            own.select("document" if name == "lines" else "printed").write.text(f"{path}/{name}")
            continue
        some = F.transform(F.array_sort(F.collect_list(F.struct("document", "printed"))), lambda d: d["printed"])
        listed = F.array_join(some, {"arrays": ",\n", "marked": "\n", "side_by_side": " "}[name])
        whole = {
            "arrays": F.concat(F.lit("[\n"), listed, F.lit("\n]")),
            "marked": F.concat(F.lit("\ufeff0\n"), listed),
            "side_by_side": listed,
        }[name]
        bucket = F.pmod(F.xxhash64("document"), F.lit(64))
        files = own.groupBy(bucket).agg(whole.alias("value")).select("value")
        files.write.option("maxRecordsPerFile", 1).text(f"{path}/{name}")
    df = read_json_source(spark, f"{path}/*", "orders", RUN_DATE, schema=orders.schema)
    return df.filter("_corrupt_record is null").select("o_orderkey", "o_custkey", "o_orderstatus", "source")


def _weather_files(spark: SparkSession, sf_dir: str, folder: str, parts: Sequence[str]) -> None:
    """The readings in files of both formats, dealt by region and day; ``parts``
    names those to deliver."""
    readings = views.daily_weather_feed(spark, sf_dir)
    part = F.pmod(F.xxhash64("region", F.substring("time", 1, 10)), F.lit(4))
    for number, name in enumerate(("early.parquet", "early.json", "late.parquet", "late.json")):
        if name in parts:
            own = readings.filter(part == number).coalesce(2)
            write = own.write.mode("append")
            write.parquet(folder) if name.endswith("parquet") else write.json(folder)


def bronze_mixed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather delivered as parquet and as JSON into one folder, as read by the
    bronze job."""
    config = JobConfig(shared_folder(spark, "mixed"), RUN_DATE, weather_feed="meteo", register=False)
    folder = f"{config.input_bucket}/raw/api/{config.weather_feed}"
    _weather_files(spark, sf_dir, folder, ("early.parquet", "early.json", "late.parquet", "late.json"))
    files = [row.file for row in list_weather(spark, config)]
    file_type = F.element_at(F.split("file_name", r"\."), -1)
    return (
        read_weather_files(spark, config, files)
        .groupBy("region", F.substring("time", 1, 10).cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("readings"), (F.count_distinct(file_type) == 1).alias("one_format"))
    )


def medallion_weather_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather that arrives in two deliveries, taken by the runs of two dates: the
    second reads the new files only, and its weather is that of all files."""
    base = shared_folder(spark, "deliveries")
    first, second = (
        JobConfig(base, day, feeds=(), weather_feed="meteo", weather_ledger=True, register=False)
        for day in ("2025-10-10", RUN_DATE)
    )
    folder = f"{base}/raw/api/{first.weather_feed}"
    taken = []
    for config, parts in ((first, ("early.parquet", "early.json")), (second, ("late.parquet", "late.json"))):
        _weather_files(spark, sf_dir, folder, parts)
        taken.append(run_bronze(spark, config)[config.weather_feed]["records"])
        run_silver(spark, config)
    stored = load_weather(spark, second.silver_path(second.weather_table), RUN_DATE)
    daily = _rounded(stored.drop("run_date"), ["weather_avg_temp", "weather_precipitation"])
    return daily.withColumn("readings_taken", F.lit(sum(taken)).cast("long"))


HISTORY = ("2025-10-09", "2025-10-10", RUN_DATE)


def _deliveries(spark: SparkSession, sf_dir: str) -> JobConfig:
    """All lines as the silver rows of three run dates, dealt by order line, and
    the weather of the last."""
    config = JobConfig(
        shared_folder(spark, "history"), RUN_DATE, history_days=2, merge_states=True, exact_distinct=False, register=False
    )
    sales = views.sales(spark, sf_dir, (*views.SALES_COLUMNS, "l_linenumber"))
    # Stored, so that the dimensions are joined, and broadcast where small, once.
    lines = stored(sales, "sales").withColumn("txn_ts", F.col("txn_date").cast("timestamp"))
    for number, day in enumerate(HISTORY):
        own = lines.filter(F.col("l_linenumber") % len(HISTORY) == number).drop("txn_date", "l_linenumber")
        write_table(to_silver_names(own), config.silver_path(config.transactions_table), {"run_date": day}, rebalance=False)
    weather = prepare_weather_features(views.daily_weather_feed(spark, sf_dir))
    write_table(weather, config.silver_path(config.weather_table), {"run_date": RUN_DATE})
    return config


def _of_history(name: str, adapt: Callable[[DataFrame], DataFrame] = lambda df: df) -> Query:
    """A gold table over three run dates, merged from their daily aggregates."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        config = _once("history", _deliveries, spark, sf_dir)
        weather = load_weather(spark, config.silver_path(config.weather_table), RUN_DATE)
        return adapt(merged_frames(spark, config, [name], weather)[name]())

    return query


def revenue_by_region_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks and months of sketches that are stored by day, against exact ones."""
    path = shared_folder(spark, "sketches")
    states.region_day_sketches(views.sales(spark, sf_dir, (*_REGION_PERIOD, "customer_id"))).write.parquet(path)
    merged = _sketched(
        _over_sales(kpis.revenue_by_region, *_REGION_PERIOD),
        lambda spark, sf_dir: states.revenue_by_region(spark.read.parquet(path)),
        ["period_type", "period_start", "region"],
        ["weekly_orders", "monthly_orders"],
    )
    return merged(spark, sf_dir)


_PRODUCT_DAY = ("category", "product_id", "product_name", "txn_date", "revenue", "quantity")
_CUSTOMER_MONTH = ("customer_id", "region", "txn_date", "txn_id", "revenue", "quantity")
_REGION_PERIOD = ("region", "txn_date", "txn_id", "revenue", "quantity")
_CUSTOMER_DATES = ("customer_id", "txn_date")
_CHANNEL_DAY = ("channel", "payment_method", "region", "txn_date", "txn_id", "revenue", "quantity")
_REGION_DAY = ("txn_date", "region", "category", "revenue", "quantity")
_MARGIN = ("product_id", "product_name", "category", "revenue", "quantity", "unit_price", "unit_cost")


# Relative deviation that the sketches of approx_count_distinct keep to, and how
# many times of it one count out of thousands may be off.
SKETCH_DEVIATION = 0.05
SKETCH_BOUND = 5


def _sketched(exact: Query, approx: Query, keys: Sequence[str], counts: Sequence[str], derived: Sequence[str] = ()) -> Query:
    """The exact rows, each with whether its sketched counts are within their
    bound, and whether all else is equal; ``derived`` columns stem from counts."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows, sketch = exact(spark, sf_dir).alias("e"), approx(spark, sf_dir).alias("s")
        matching = [F.col(f"e.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
        rest = [c for c in rows.columns if c not in {*keys, *counts, *derived}]

        def close(count: str) -> Column:
            value, estimate = F.col(f"e.{count}"), F.col(f"s.{count}")
            bound = F.greatest(F.lit(1.0), SKETCH_BOUND * SKETCH_DEVIATION * value)
            return (F.abs(value - estimate) <= bound) | (value.isNull() & estimate.isNull())

        equal = reduce(and_, (F.col(f"e.{c}").eqNullSafe(F.col(f"s.{c}")) for c in rest))
        return rows.join(sketch, reduce(and_, matching), "left").select(
            "e.*",
            *[F.coalesce(close(c), F.lit(False)).alias(f"{c}_close") for c in counts],
            equal.alias("rest_equal"),
        )

    return query


def _sketched_kpi(kpi: Callable[..., DataFrame], columns: Sequence[str], keys, counts, derived=()) -> Query:
    exact = _over_sales(kpi, *columns)
    return _sketched(exact, _over_sales(lambda df: kpi(df, exact=False), *columns), keys, counts, derived)


def _anomalies(df: DataFrame) -> DataFrame:
    return _rounded(kpis.anomalies(df), ["std_revenue"], 4)


def queries() -> dict[str, Query]:
    return {
        "silver_standardize": silver_standardize,
        "silver_union": silver_union,
        "decimal_revenue": decimal_revenue,
        "top_products_by_category": _over_sales(kpis.top_products_by_category, *_PRODUCT_DAY),
        "top_products_by_category_nulls": _over_sales(
            kpis.top_products_by_category, *_PRODUCT_DAY, dirty=True
        ),
        "customer_frequency_ticket": _over_sales(
            kpis.customer_frequency_ticket, *_CUSTOMER_MONTH
        ),
        "customer_frequency_ticket_approx": _sketched_kpi(
            kpis.customer_frequency_ticket,
            _CUSTOMER_MONTH,
            ["txn_month", "customer_id", "region"],
            ["transaction_count"],
        ),
        "revenue_by_region": _over_sales(kpis.revenue_by_region, *_REGION_PERIOD),
        "revenue_by_region_nulls": _over_sales(
            kpis.revenue_by_region, *_REGION_PERIOD, dirty=True
        ),
        "revenue_by_region_approx": _sketched_kpi(
            kpis.revenue_by_region,
            _REGION_PERIOD,
            ["period_type", "period_start", "region"],
            ["weekly_orders", "monthly_orders"],
        ),
        "new_vs_returning": _over_sales(kpis.new_vs_returning, *_CUSTOMER_DATES),
        "new_vs_returning_nulls": _over_sales(
            kpis.new_vs_returning, *_CUSTOMER_DATES, dirty=True
        ),
        "new_vs_returning_yearly": _over_sales(
            kpis.new_vs_returning, *_CUSTOMER_DATES, yearly=True
        ),
        "new_vs_returning_customers": _over_sales(
            kpis.new_vs_returning_customers, *_CUSTOMER_DATES
        ),
        "new_vs_returning_customers_yearly": _over_sales(
            kpis.new_vs_returning_customers, *_CUSTOMER_DATES, yearly=True
        ),
        "price_volume_corr": _over_sales(
            kpis.price_volume_corr,
            *("category", "unit_price", "quantity"),
            rounded=["price_volume_corr", "avg_unit_price"],
        ),
        "margin_by_product": _over_sales(kpis.margin_by_product, *_MARGIN),
        "channel_payment_perf": _over_sales(kpis.channel_payment_perf, *_CHANNEL_DAY),
        "channel_payment_perf_nulls": _over_sales(
            kpis.channel_payment_perf, *_CHANNEL_DAY, dirty=True
        ),
        "channel_payment_perf_approx": _sketched_kpi(
            kpis.channel_payment_perf,
            _CHANNEL_DAY,
            ["channel", "payment_method", "region", "txn_date"],
            ["orders"],
        ),
        "anomalies": _over_sales(_anomalies, *_REGION_DAY, rounded=["z_score"]),
        "anomalies_nulls": _over_sales(_anomalies, *_REGION_DAY, dirty=True, rounded=["z_score"]),
        "weather_hourly": weather_hourly,
        "weather_daily": weather_daily,
        "weather_no_metrics": weather_no_metrics,
        "attach_weather": attach_weather_by_region,
        "attach_weather_by_date": attach_weather_by_date,
        "attach_weather_missing": attach_weather_missing,
        "weather_impact": weather_impact,
        "fact_sales_daily": fact_scalars,
        "fact_sales_daily_nulls": fact_scalars_nulls,
        "fact_sales_daily_approx": _sketched(
            fact_scalars,
            lambda spark, sf_dir: _fact_scalars(fact_with_weather(spark, sf_dir, exact=False)),
            FACT_KEYS,
            ["orders", "unique_customers"],
            ["avg_ticket"],
        ),
        "channel_mix": _mix_rows("channel_mix", "channel"),
        "channel_mix_nulls": _mix_rows("channel_mix", "channel", dirty=True),
        "payment_mix": _mix_rows("payment_mix", "payment_method"),
        "payment_mix_nulls": _mix_rows("payment_mix", "payment_method", dirty=True),
        "partition_fill": partition_fill,
        "quality_metrics": quality_metrics,
        "bronze_metadata": bronze_metadata,
        "bronze_json_roundtrip": bronze_json_roundtrip,
        "bronze_quarantine": bronze_quarantine,
        "medallion_silver": medallion_silver,
        "medallion_revenue_by_region": _medallion_gold("revenue_by_region"),
        "medallion_margin_by_product": _medallion_gold("margin_by_product"),
        "medallion_price_volume_corr": _medallion_gold(
            "price_volume_corr", ["price_volume_corr", "avg_unit_price"]
        ),
        "medallion_weather_daily": medallion_weather_daily,
        "medallion_weather_impact": _medallion_gold("weather_impact", WEATHER_IMPACT_DOUBLES),
        "medallion_top_products_by_category": _stored_gold("top_products_by_category"),
        "medallion_customer_frequency_ticket": _stored_gold("customer_frequency_ticket"),
        "medallion_new_vs_returning": _stored_gold("new_vs_returning"),
        "medallion_channel_payment_perf": _stored_gold("channel_payment_perf"),
        "medallion_anomalies": _stored_gold(
            "anomalies", lambda df: _rounded(_rounded(df, ["std_revenue"], 4), ["z_score"])
        ),
        "medallion_fact_sales_daily": _stored_gold("fact_sales_daily", _fact_scalars),
        "medallion_rerun": medallion_rerun,
        "bronze_json_multiline": bronze_json_multiline,
        "bronze_mixed_formats": bronze_mixed_formats,
        "revenue_by_region_merged": revenue_by_region_merged,
        "history_top_products_by_category": _of_history("top_products_by_category"),
        "history_margin_by_product": _of_history("margin_by_product"),
        "history_anomalies": _of_history(
            "anomalies", lambda df: _rounded(_rounded(df, ["std_revenue"], 4), ["z_score"])
        ),
        "history_weather_impact": _of_history("weather_impact", lambda df: _rounded(df, WEATHER_IMPACT_DOUBLES)),
        "history_new_vs_returning": _of_history("new_vs_returning"),
        "medallion_weather_ledger": medallion_weather_ledger,
    }
