"""The registered queries: each operator on the given tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orebed.functions import scalars as S
from orebed.operators import aggregates as A
from orebed.operators import alerts, cdc, governance, joins, projections, rules, scoring, sets
from orebed.operators import expectations as E
from orebed.operators.measures import Members, Ratio, Total, measured
from orebed.plans import customers, orders, quality, status, transactions, verify
from orebed.plans.layers import Layers
from orebed.session import configure, fit_shuffle, fresh_dir
from orebed.sources import files, tables
from orebed.sources.schemalog import ingest_inferred, read_inferred, schema_versions
from orebed.streaming.daily import keep_daily_counts, read_daily_counts
from orebed.streaming.history import apply_scd2_stream, read_history
from orebed.streaming.interval_join import interval_stream_join
from orebed.streaming.late_join import interval_join_keeping_late, with_rocksdb
from orebed.streaming.metriclog import read_metrics, run_counted
from orebed.streaming.run import run_available
from orebed.streaming.snapshot import apply_scd1_stream, read_current

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

AS_OF = "2001-01-01"
# The days-past-due buckets are also used on quantities, with these edges.
QUANTITY_EDGES = [("Al_Dia", 10), ("1-30", 20), ("31-60", 30), ("61-90", 40), ("Mayor_90", None)]
PRICE_RULES = [
    E.Expectation("valid_price", "o_totalprice > 50000"),
    E.Expectation("valid_status", "o_orderstatus IN ('F', 'O')"),
]


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return fit_shuffle(configure(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def overdue() -> Column:
    return F.col("o_orderstatus") == "P"


# Sources and sinks


def _order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        S.iso_text("o_orderdate").alias("order_timestamp"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        (F.col("o_orderpriority") == "1-URGENT").alias("wants_email"),
        overdue().alias("wants_sms"),
    )


def _ingest_arrivals(spark: SparkSession, sf_dir: str) -> tuple[str, list[int]]:
    """Land the orders in two arrivals; ingest after each and once more."""
    root = fresh_dir(spark, "ingest")
    feed = _order_feed(spark, sf_dir)
    added = []
    for late in (False, True, None):
        if late is not None:
            orders.land_orders(feed.filter(F.col("wants_sms") == late), root, "append")
        report = files.ingest_json(
            spark, f"{root}/orders", orders.ORDER_SCHEMA, f"{root}/bronze", f"{root}/checkpoint"
        )
        added.append(report.rows_read)
    return f"{root}/bronze", added


@query
def s1_ingest_incremental(spark, sf_dir):
    bronze, _ = _ingest_arrivals(spark, sf_dir)
    return spark.read.parquet(bronze).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "order_timestamp",
        F.col("customer_id").cast("bigint").alias("customer_id"),
        F.col("notifications.email").alias("wants_email"),
        F.col("notifications.sms").alias("wants_sms"),
    )


def _changing_feed(spark: SparkSession, sf_dir: str) -> str:
    """Land the orders by status, each arrival in a wider form than the one before, and ingest after each."""
    root = fresh_dir(spark, "schema")
    book = table(spark, sf_dir, "orders")
    key, price, buyer = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey").alias("id")
    forms = {
        "F": [key.alias("order_id"), F.floor(price).alias("amount"), F.struct(buyer).alias("customer")],
        "O": [
            key.alias("order_id"),
            price.alias("amount"),
            F.struct(buyer, F.col("o_orderpriority").alias("priority")).alias("customer"),
        ],
        "P": [
            F.concat(F.lit("P"), key).alias("order_id"),
            price.alias("amount"),
            F.struct(buyer).alias("customer"),
            F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("tags"),
        ],
    }
    for code, columns in forms.items():
        arrival = book.filter(F.col("o_orderstatus") == code).select(*columns)
        tables.export_jsonl(arrival, f"{root}/feed", "append")
        ingest_inferred(spark, f"{root}/feed", f"{root}/bronze")
    return f"{root}/bronze"


@query
def s1_schema_log(spark, sf_dir):
    """A feed that gains fields and widens types between runs, read in its newest schema."""
    return read_inferred(spark, _changing_feed(spark, sf_dir)).select(
        "order_id",
        "amount",
        F.col("customer.id").alias("customer_id"),
        F.col("customer.priority").alias("priority"),
        F.size("tags").alias("n_tags"),
        files.RESCUED,
    )


@query
def s1_schema_versions(spark, sf_dir):
    """The same feed as readers of each version see it: all rows, and what their version cannot hold."""
    bronze = _changing_feed(spark, sf_dir)
    lines = [
        read_inferred(spark, bronze, number).agg(
            F.lit(number).alias("version"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count("order_id").alias("n_ids"),
            F.count("amount").alias("n_amounts"),
            F.count(files.RESCUED).alias("n_rescued"),
        )
        for number in schema_versions(spark, bronze)
    ]
    return sets.union_all(lines)


@query
def l9_run_metrics(spark, sf_dir):
    _, added = _ingest_arrivals(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(added, 1)), "run bigint, rows_added bigint")


@query
def l9_metric_log(spark, sf_dir):
    """Counts of the price rules over batches of several files, from the logs of both kinds of sink."""
    root = fresh_dir(spark, "metrics")
    book = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    book.repartition(3, "o_orderkey").write.parquet(f"{root}/feed")
    stream = files.read_stream_table(spark, f"{root}/feed", book.schema, max_files=1)
    run_available(E.apply_expectations(stream, PRICE_RULES, "prices"), f"{root}/kept", f"{root}/file")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batches/b{number}")

    run_counted(stream, PRICE_RULES, write, f"{root}/batch", "prices")
    logs = [
        read_metrics(spark, f"{root}/{kind}").withColumn("sink", F.lit(kind)) for kind in ("file", "batch")
    ]
    return sets.union_all(logs).groupBy("sink", "metric").agg(F.sum("value").alias("value"))


@query
def p1_bronze_metadata(spark, sf_dir):
    return files.with_ingest_metadata(table(spark, sf_dir, "orders")).drop("processing_time")


@query
def s3_rescued(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "props")
    schema = T.StructType([T.StructField("other", T.StringType())])
    return files.parse_json_rescued(events, "props", schema).select("event_id", files.RESCUED)


@query
def s6_csv_export(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    source = table(spark, sf_dir, "orders").select(*columns)
    path = tables.export_csv(source, fresh_dir(spark, "csv"))
    return files.read_csv(spark, path, source.schema)


@query
def s7_jsonl_export(spark, sf_dir):
    source = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.struct("user_id", "event_type", "value").alias("payload")
    )
    path = tables.export_jsonl(source, fresh_dir(spark, "jsonl"))
    return spark.read.schema(source.schema).json(path).select("event_id", "ts", "payload.*")


@query
def s9_ensure_table(spark, sf_dir):
    facts = a2_monthly_fact(spark, sf_dir)
    path = fresh_dir(spark, "ensure")
    name = "orebed_" + path.rsplit("-", 1)[1]
    tables.ensure_table(spark, name, facts.schema, path)
    facts.write.insertInto(name)
    tables.ensure_table(spark, name, facts.schema, path)
    # Only the catalog entry goes; the files of a table with a path stay.
    spark.sql(f"DROP TABLE {name}")
    return spark.read.parquet(path)


@query
def s12_latest_status(spark, sf_dir):
    feed = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("order_id"), F.col("event_type").alias("order_status"), F.col("ts").alias("status_ts"),
        "event_id",
    )
    return cdc.scd1(feed, ["order_id"], ["status_ts", "event_id"], F.lit(False), ["event_id"])


@query
def s12_status_feed(spark, sf_dir):
    """The latest status by way of JSON files and the status job."""
    root = fresh_dir(spark, "status")
    feed = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("order_id"),
        F.col("event_type").alias("order_status"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("status_timestamp"),
    )
    tables.export_jsonl(feed, f"{root}/landing/status")
    status.run(spark, f"{root}/landing", root)
    return status.read_status(spark, root).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "order_status",
        F.col("status_time").cast("timestamp_ntz").alias("status_ts"),
    )


# Projections and filters


@query
def p2_silver_projection(spark, sf_dir):
    spec = {
        "order_id": "o_orderkey",
        "order_timestamp": S.to_ts(S.iso_text("o_orderdate")).cast("timestamp_ntz"),
        "customer_id": "o_custkey",
    }
    return projections.silver_projection(table(spark, sf_dir, "orders"), spec)


@query
def p3_star_except(spark, sf_dir):
    return projections.drop_columns(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query
def p4_filter_eq(spark, sf_dir):
    chosen = table(spark, sf_dir, "orders").filter(overdue())
    return chosen.select("o_orderkey", "o_custkey", "o_totalprice")


# Expectations


@query
def d1_expect_warn(spark, sf_dir):
    return E.with_flags(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), PRICE_RULES[:1])


@query
def d2_expect_drop(spark, sf_dir):
    rule = E.Expectation("valid_price", "o_totalprice > 50000", "drop")
    priced = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return E.apply_expectations(priced, [rule], Observation())


@query
def d3_expect_fail(spark, sf_dir):
    rule = E.Expectation("valid_key", "o_orderkey IS NOT NULL", "fail")
    priced = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return E.apply_expectations(priced, [rule], Observation())


@query
def d4_expect_metrics(spark, sf_dir):
    return E.expectation_metrics(table(spark, sf_dir, "orders"), PRICE_RULES)


@query
def d5_expect_conditional(spark, sf_dir):
    rule = E.Expectation("valid_value", "value > 20 OR event_type = 'error'", "drop")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return E.apply_expectations(events, [rule], Observation())


@query
def d7_ts_vs_string(spark, sf_dir):
    rule = E.Expectation("valid_timestamp", "o_orderdate > '2000-01-01'")
    return E.with_flags(table(spark, sf_dir, "orders"), [rule]).select("o_orderkey", "valid_timestamp")


@query
def d8_quarantine(spark, sf_dir):
    bad = E.quarantine(table(spark, sf_dir, "orders"), PRICE_RULES)
    return bad.select("o_orderkey", F.concat_ws(",", "failed_rules").alias("failed_rules"))


# Governance rules


@query
def q01_null(spark, sf_dir):
    """Customers whose profile lacks the date of a last overdue order."""
    last = (
        table(spark, sf_dir, "orders")
        .filter(overdue())
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderdate").alias("last_overdue"))
    )
    profile = joins.left_on_unique(table(spark, sf_dir, "customer"), last, ["c_custkey"])
    return rules.null_rule(profile, ["last_overdue"]).select("c_custkey", "c_name")


@query
def q02_future_date(spark, sf_dir):
    return rules.future_date(table(spark, sf_dir, "orders"), "o_orderdate", AS_OF).select("o_orderkey", "o_orderdate")


@query
def q03_duplicate_key(spark, sf_dir):
    return rules.duplicate_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q03_duplicate_rows(spark, sf_dir):
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return rules.duplicate_rows(table(spark, sf_dir, "lineitem").select(*columns), ["l_orderkey", "l_linenumber"])


@query
def q04_case_inconsistent(spark, sf_dir):
    """Part names that use a part type as first word, in the wrong case."""
    parts = table(spark, sf_dir, "part")
    words = parts.select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("code"))
    return rules.case_inconsistent(words, "code", parts.select("p_type"))


@query
def q05_out_of_range(spark, sf_dir):
    return rules.out_of_range(table(spark, sf_dir, "customer"), "c_acctbal", 0, 9000).select("c_custkey", "c_acctbal")


@query
def q06_zero_when_status(spark, sf_dir):
    found = rules.zero_when(table(spark, sf_dir, "lineitem"), "l_discount", F.col("l_returnflag") == "R")
    return found.select("l_orderkey", "l_linenumber", "l_partkey")


@query
def q07_orphan_fk(spark, sf_dir):
    """Lines whose order is not among the settled orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    settled = table(spark, sf_dir, "orders").filter(~overdue())
    return rules.orphan_fk(lines, settled, {"l_orderkey": "o_orderkey"})


@query
def q08_negative(spark, sf_dir):
    return rules.negative(table(spark, sf_dir, "supplier"), "s_acctbal").select("s_suppkey", "s_acctbal")


@query
def q09_date_order(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    dates = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return rules.date_order(joins.star_join(lines, [(dates, ["l_orderkey"])]), "o_orderdate", "l_shipdate")


@query
def q10_ratio_bound(spark, sf_dir):
    prices = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = joins.star_join(table(spark, sf_dir, "lineitem"), [(prices, ["l_partkey"])])
    bound = F.col("l_quantity") * F.col("p_retailprice")
    return rules.ratio_bound(lines, "l_extendedprice", bound, 1.2).select("l_orderkey", "l_linenumber", "l_partkey")


@query
def q11_bucket_mismatch(spark, sf_dir):
    """Buckets stored thirty days before the check, against the days of the check."""
    days = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.datediff(F.lit(AS_OF).cast("date"), F.to_date("l_shipdate")).alias("days")
    )
    stored = days.withColumn("stored", S.ladder(F.col("days") - 30, S.DPD_EDGES))
    return rules.bucket_mismatch(stored, "days", "stored", S.DPD_EDGES).select("l_orderkey", "l_linenumber", "stored")


@query
def q12_sentinel(spark, sf_dir):
    return rules.sentinel(table(spark, sf_dir, "part"), "p_retailprice", [900.0, 999.9]).select("p_partkey")


@query
def q13_unknown_code(spark, sf_dir):
    """Order states that no line has."""
    states = table(spark, sf_dir, "lineitem").select("l_linestatus")
    found = rules.unknown_code(table(spark, sf_dir, "orders"), "o_orderstatus", states)
    return found.select("o_orderkey", F.col("o_orderstatus").alias("code"))


@query
def q14_ratio_above_one(spark, sf_dir):
    ratios = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_retailprice") / 950).alias("ratio"))
    return rules.ratio_bound(ratios, "ratio", F.lit(1.0), 1.0)


@query
def q15_zero_with_activity(spark, sf_dir):
    """Orders without any discount that do have lines."""
    totals = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_discount").alias("total"), F.count(F.lit(1)).alias("n_lines")
    )
    return rules.zero_with_activity(totals, "total", F.col("n_lines") > 0).select("l_orderkey", "n_lines")


@query
def q15_zero_with_rows(spark, sf_dir):
    """Parts priced at the floor (excess zero) that have been sold."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), (F.col("p_retailprice") - 900).alias("excess")
    )
    return rules.zero_with_activity(parts, "excess", table(spark, sf_dir, "lineitem"), ["l_partkey"])


@query
def q16_dq_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    book = table(spark, sf_dir, "orders")
    negative_balance = {"negative_balance": rules.negative_when("c_acctbal")}
    return rules.dq_report(
        [
            rules.TableChecks(
                "customer",
                table(spark, sf_dir, "customer"),
                {**negative_balance, "out_of_range": rules.outside_when("c_acctbal", 0, 9000)},
            ),
            rules.TableChecks(
                "supplier", table(spark, sf_dir, "supplier"), {"negative_balance": rules.negative_when("s_acctbal")}
            ),
            rules.TableChecks("orders", book, {"future_date": rules.future_when("o_orderdate", AS_OF)}),
            rules.TableChecks(
                "lineitem",
                lines,
                {"zero_discount": rules.zero_while_when("l_discount", F.col("l_returnflag") == "R")},
                key_rules={
                    "duplicate_key": rules.Unique(["l_orderkey", "l_linenumber"]),
                    "orphan_order": rules.Known(["l_orderkey"], "orders", ["o_orderkey"], ~overdue()),
                },
            ),
        ],
        total="all",
    )


@query
def q16_bank_report(spark, sf_dir):
    """All rules of the bank tables, which are derived from the given ones."""
    people, book = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    rich = F.col("c_acctbal") > 9000
    segment = F.when(F.col("c_nationkey") < 12, "Retail").otherwise("PYME")
    account = people.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_acctbal") >= 0, "GY").alias("country_code"),
        F.when(rich, F.lower(segment)).otherwise(segment).alias("segment"),
        F.floor(F.col("c_acctbal") / 10).alias("credit_score"),
        F.date_add(F.lit("2000-01-01").cast("date"), F.col("c_nationkey") * 30).alias("acquisition_date"),
    )
    branch_type = F.when(F.col("s_nationkey") < 12, "Agencia").otherwise("Digital")
    branches = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("branch_id"),
        F.when(F.col("s_acctbal") >= 0, "PI").alias("country_code"),
        F.when(F.col("s_acctbal") > 9000, F.lower(branch_type)).otherwise(branch_type).alias("branch_type"),
    )
    urgent, price = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")
    moves = book.select(
        F.when(urgent, -F.col("o_custkey") - 1).otherwise(F.col("o_custkey")).alias("customer_id"),
        S.padded_id("Supplier#", "o_custkey", 9).alias("branch_id"),
        F.when(price > 5000, F.to_date("o_orderdate")).alias("transaction_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0.0).when(overdue(), -price).otherwise(price).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "Aprobada").otherwise("Pendiente").alias("status"),
    )
    days = F.datediff(F.lit(AS_OF).cast("date"), F.to_date("l_shipdate"))
    loans = table(spark, sf_dir, "lineitem").select(
        days.alias("days_past_due"),
        S.ladder(days - 30, S.DPD_EDGES).alias("dpd_bucket"),
        F.to_date("l_shipdate").alias("disbursement_date"),
        F.date_add(F.to_date("l_shipdate"), F.col("l_quantity").cast("int") - 5).alias("maturity_date"),
        F.col("l_extendedprice").alias("original_amount"),
        (F.col("l_extendedprice") * (F.col("l_discount") * 4 + 0.9)).alias("outstanding_balance"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("interest_rate"),
    )
    daily = book.groupBy(F.to_date("o_orderdate").alias("kpi_date")).agg(
        F.sum(F.when(overdue(), price).otherwise(0.0)).alias("late"),
        F.sum(F.when(~overdue(), price).otherwise(0.0)).alias("total_portfolio"),
        F.count(F.lit(1)).alias("new_disbursements"),
    )
    kpis = daily.select(
        F.try_divide("late", "total_portfolio").alias("npl_ratio"),
        "total_portfolio",
        "new_disbursements",
        F.when(F.month("kpi_date") == 2, 999.99).otherwise(0.04).alias("yoy_portfolio_growth"),
        F.when(F.dayofweek("kpi_date") == 1, "DESCONOCIDO").otherwise("LO").alias("country_code"),
    )
    names = (quality.CUSTOMERS, quality.BRANCHES, quality.TRANSACTIONS, quality.LOANS, quality.KPIS)
    return quality.bank_report(dict(zip(names, (account, branches, moves, loans, kpis))), AS_OF)


# Change data capture

EVENT_KEYS, EVENT_ORDER, EVENT_DELETE = ["user_id"], ["ts", "event_id"], "event_type = 'error'"


@query
def c1_scd1(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    return cdc.scd1(events, EVENT_KEYS, EVENT_ORDER, EVENT_DELETE, ["event_id", "event_type"])


@query
def c2_scd1_incremental(spark, sf_dir):
    """The same state from two arrivals, the second one full of late events."""
    root = fresh_dir(spark, "cdc")
    events = table(spark, sf_dir, "events").drop("props")
    for late in (False, True):
        arrival = events.filter(F.col("event_type").isin("view", "click") == late)
        arrival.write.mode("append").parquet(f"{root}/events")
        stream = files.read_stream_table(spark, f"{root}/events", events.schema)
        apply_scd1_stream(
            stream, f"{root}/state", f"{root}/checkpoint", EVENT_KEYS, EVENT_ORDER, EVENT_DELETE, buckets=4
        )
    return read_current(spark, f"{root}/state", ["event_id", "event_type"])


def _event_arrivals(spark: SparkSession, sf_dir: str, root: str) -> Iterator[DataFrame]:
    """A stream of the events after each arrival. One kind arrives at a time, as a batch however
    many files it has, so that most events come late."""
    events = table(spark, sf_dir, "events").drop("props")
    kinds = ["purchase", "click", "error", "view"]
    for arrived in [*[F.col("event_type") == kind for kind in kinds], ~F.col("event_type").isin(kinds)]:
        events.filter(arrived).write.mode("append").parquet(f"{root}/events")
        yield files.read_stream_table(spark, f"{root}/events", events.schema)


@query
def c4_keyed_log(spark, sf_dir):
    """The current state from a log whose buckets split and merge on the way."""
    root = fresh_dir(spark, "log")
    sizes = {"buckets": 2, "bucket_rows": 200, "folder_rows": 50}
    for stream in _event_arrivals(spark, sf_dir, root):
        apply_scd1_stream(stream, f"{root}/state", f"{root}/checkpoint", EVENT_KEYS, EVENT_ORDER, EVENT_DELETE, **sizes)
    return read_current(spark, f"{root}/state", ["event_id", "event_type"])


HISTORY_HIDDEN = ["event_id", "event_type", "ts"]
HISTORY_NAMES = {"start": "start_at", "end": "end_at", "current": "is_current"}


@query
def c5_scd2(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    return cdc.scd2(events, EVENT_KEYS, EVENT_ORDER, EVENT_DELETE, HISTORY_HIDDEN, **HISTORY_NAMES)


@query
def c5_scd2_incremental(spark, sf_dir):
    """The same history from several batches, each of which cuts intervals of those before."""
    root = fresh_dir(spark, "history")
    for stream in _event_arrivals(spark, sf_dir, root):
        apply_scd2_stream(stream, f"{root}/state", f"{root}/checkpoint", EVENT_KEYS, EVENT_ORDER, EVENT_DELETE, buckets=4)
    return read_history(spark, f"{root}/state", HISTORY_HIDDEN, **HISTORY_NAMES)


@query
def c6_merge(spark, sf_dir):
    book = table(spark, sf_dir, "orders")
    target = book.filter(~overdue()).select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    operation = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "DELETE")
        .when(F.col("o_orderpriority") == "2-HIGH", "UPDATE")
        .otherwise("INSERT")
    )
    source = book.filter(F.col("o_orderdate") >= "1997-01-01").select(
        F.col("o_orderkey").alias("k"), (F.col("o_totalprice") * 2).alias("v"), operation.alias("op")
    )
    return cdc.merge_into(target, source, ["k"], "op")


@query
def c7_dedupe_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").drop("props")
    latest = cdc.dedupe_latest(events, ["user_id", "event_type"], EVENT_ORDER)
    return latest.select("user_id", "event_type", "value")


# Aggregates


@query
def a1_daily_orders(spark, sf_dir):
    return A.daily_counts(table(spark, sf_dir, "orders"), "o_orderdate", "o_custkey")


@query
def a1_daily_incremental(spark, sf_dir):
    """The same counts from three batches, two of them full of late orders, by differences alone."""
    root = fresh_dir(spark, "daily")
    book = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("timestamp").alias("o_orderdate"), "o_orderstatus")
    for status in ("P", "O", "F"):
        book.filter(F.col("o_orderstatus") == status).write.mode("append").parquet(f"{root}/orders")
        stream = files.read_stream_table(spark, f"{root}/orders", book.schema)
        keep_daily_counts(stream, f"{root}/state", f"{root}/checkpoint", "o_orderdate", "o_custkey", buckets=4)
    return read_daily_counts(spark, f"{root}/state")


@query
def a2_monthly_fact(spark, sf_dir):
    return A.monthly_fact(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")


@query
def a3_table_counts(spark, sf_dir):
    return A.table_counts({name: table(spark, sf_dir, name) for name in ("orders", "customer", "events", "lineitem")})


@query
def a4_profile_summary(spark, sf_dir):
    profile = table(spark, sf_dir, "customer").toDF("customer_id", "name", "city", "balance", "state")
    return A.profile_summary(profile, customers.SUMMARY_COLUMNS).drop("last_refreshed")


@query
def a5_npl_ratio(spark, sf_dir):
    segments = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    price = F.col("o_totalprice")
    sums = A.sums_by_dimension(
        table(spark, sf_dir, "orders"),
        segments,
        "o_custkey",
        ["c_mktsegment"],
        {"portfolio": price, "overdue": F.when(overdue(), price).otherwise(0.0)},
    )
    return sums.select(
        "c_mktsegment",
        F.round("portfolio", 2).alias("portfolio"),
        F.round(F.try_divide("overdue", "portfolio"), 6).alias("npl_ratio"),
    )


@query
def a5_npl_by_flag(spark, sf_dir):
    """The ratio straight from a loan table: balance, days past due, threshold."""
    loans = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_extendedprice",
        F.datediff(F.lit(AS_OF).cast("date"), F.to_date("l_shipdate")).alias("days"),
    )
    return A.npl_ratio(loans, ["l_returnflag"], "l_extendedprice", "days", 90)


@query
def a6_dpd_bucket_mix(spark, sf_dir):
    return A.bucket_mix(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", QUANTITY_EDGES)


@query
def a7_yoy_growth(spark, sf_dir):
    monthly = table(spark, sf_dir, "orders").groupBy(
        F.year("o_orderdate").cast("bigint").alias("y"), F.month("o_orderdate").cast("bigint").alias("m")
    )
    return A.yoy(monthly.agg(F.sum("o_totalprice").alias("t")), "y", "m", "t")


def _customer_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return joins.star_join(table(spark, sf_dir, "customer"), [(nations, ["c_nationkey"]), (regions, ["n_regionkey"])])


@query
def a8_kpi_daily(spark, sf_dir):
    price = F.col("o_totalprice")

    def only(status: str) -> Column:
        return F.when(F.col("o_orderstatus") == status, price).otherwise(0.0)

    measures = {"portfolio": price, "overdue": only("P"), "new": only("O"), "paid": only("F")}
    homes = _customer_regions(spark, sf_dir).select(F.col("c_custkey").alias("o_custkey"), "n_regionkey")
    sums = A.kpi_daily(table(spark, sf_dir, "orders"), homes, "o_custkey", "n_regionkey", "o_orderdate", measures)
    return sums.select(
        "n_regionkey",
        "kpi_date",
        F.round("portfolio", 2).alias("total_portfolio"),
        F.round(F.try_divide("overdue", "portfolio"), 4).alias("npl_ratio"),
        F.round("new", 2).alias("new_disbursements"),
        F.round("paid", 2).alias("collections"),
        F.round(F.col("overdue") * 0.2, 2).alias("provision_expense"),
        "active_customers",
    )


@query
def a9_metric_rollup(spark, sf_dir):
    measures = {"n_customers": F.count(F.lit(1)), "balance": F.round(F.sum("c_acctbal"), 2)}
    return A.metric(_customer_regions(spark, sf_dir), ["r_name", "n_name"], measures, rollup=True)


@query
def a9_measures(spark, sf_dir):
    """The overdue share of the book and its customers, by region, by segment and in all."""
    homes = _customer_regions(spark, sf_dir).select("c_custkey", "c_mktsegment", "r_name")
    book = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice", "o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    measures = [
        Total("portfolio", price),
        Total("overdue", F.when(overdue(), price).otherwise(0)),
        Ratio("npl_ratio", "overdue", "portfolio"),
        Members("n_customers", "c_custkey"),
    ]
    found = measured(joins.star_join(book, [(homes, ["c_custkey"])]), measures, ["r_name", "c_mktsegment"], [["r_name"], ["c_mktsegment"], []])
    return found.select("r_name", "c_mktsegment", F.col("level").cast("bigint").alias("level"), *[
        F.col(name).cast("double").alias(name) for name in ("portfolio", "overdue", "npl_ratio")
    ], "n_customers")


@query
def a10_distinct(spark, sf_dir):
    return A.distinct_values(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


# Joins


@query
def j1_star_join(spark, sf_dir):
    book = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    homes = _customer_regions(spark, sf_dir).select("c_custkey", "c_name", "n_name", "r_name")
    return joins.star_join(book, [(homes, ["c_custkey"])]).drop("c_custkey")


def _book_and_customers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and the customers whose account is not overdrawn."""
    book = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    return book, table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)


@query
def j2_left_join(spark, sf_dir):
    book, solvent = _book_and_customers(spark, sf_dir)
    dim = joins.unique_on(solvent.select("c_custkey", "c_name", "c_acctbal"), ["c_custkey"])
    return joins.left_on_unique(book, dim, ["c_custkey"]).drop("c_custkey")


@query
def j3_lookup_default(spark, sf_dir):
    book, solvent = _book_and_customers(spark, sf_dir)
    dim = solvent.select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return joins.lookup_default(book, dim, ["c_custkey"], "segment", "NONE").drop("c_custkey")


@query
def j4_left_semi(spark, sf_dir):
    late = table(spark, sf_dir, "orders").filter(overdue()).select(F.col("o_custkey").alias("c_custkey"))
    return joins.keep_matching(table(spark, sf_dir, "customer"), late, ["c_custkey"]).select("c_custkey")


@query
def j5_left_anti(spark, sf_dir):
    late = table(spark, sf_dir, "orders").filter(overdue())
    return rules.orphan_fk(table(spark, sf_dir, "customer").select("c_custkey"), late, {"c_custkey": "o_custkey"})


@query
def j6_stream_stream(spark, sf_dir):
    root = fresh_dir(spark, "join")
    schema = table(spark, sf_dir, "events").schema
    # The glob lets the table be one file or a folder of files.
    stream = files.read_stream_table(spark, f"{sf_dir}/events.parquet*", schema)

    def side(event_type: str, key: str, ts: str) -> DataFrame:
        chosen = stream.filter(F.col("event_type") == event_type)
        return chosen.select("user_id", F.col("event_id").alias(key), F.col("ts").cast("timestamp").alias(ts))

    pairs = interval_stream_join(
        side("click", "click_id", "click_ts"),
        side("purchase", "purchase_id", "purchase_ts"),
        "user_id",
        "click_ts",
        "purchase_ts",
        3600,
        "2 hours",
    )
    run_available(pairs.select("click_id", "purchase_id"), f"{root}/pairs", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/pairs")


@query
def j6_stream_late(spark, sf_dir):
    """Clicks and purchases that come in four batches, by day; every fiftieth event comes one batch late."""
    root = fresh_dir(spark, "late")
    events = table(spark, sf_dir, "events").filter("event_type in ('click', 'purchase')")
    due = F.least(F.floor((F.dayofmonth("ts") - 1) / 8), F.lit(3))
    events = events.withColumn("batch", F.least(due + (F.col("event_id") % 50 == 7).cast("int"), F.lit(3)).cast("int"))
    events.repartition("batch").write.partitionBy("batch").parquet(f"{root}/due")
    schema = events.drop("batch").schema
    for batch in range(4):
        # A run takes the folders that have come in since the one before.
        came = spark.read.parquet(f"{root}/due").filter(F.col("batch") == batch).drop("batch")
        came.write.parquet(f"{root}/feed/{batch}")
        stream = files.read_stream_table(spark, f"{root}/feed/*", schema)

        def side(event_type: str) -> DataFrame:
            return stream.filter(F.col("event_type") == event_type).select("user_id", F.col("event_id").alias("id"), "ts")

        with with_rocksdb(spark):
            found = interval_join_keeping_late(side("click"), side("purchase"), "user_id", 3600, "2 hours", 86400, buckets=16)
            run_available(found, f"{root}/found", f"{root}/checkpoint")
    found = spark.read.schema("kind string, left_id bigint, right_id bigint").parquet(f"{root}/found")
    return found.select("kind", F.col("left_id").alias("click_id"), F.col("right_id").alias("purchase_id"))


# Sets, sorts, limits


@query
def u1_union_all(spark, sf_dir):
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return sets.union_all([buyers, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))])


@query
def u2_except_distinct(spark, sf_dir):
    late = table(spark, sf_dir, "orders").filter(overdue()).select("o_custkey")
    return sets.except_distinct(table(spark, sf_dir, "customer").select("c_custkey"), late)


@query
def o1_sort(spark, sf_dir):
    book = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return sets.sorted_view(book, ["o_orderdate", "o_orderkey"])


@query
def o2_topk_desc(spark, sf_dir):
    book = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    return sets.top_k(book, [F.desc("o_orderdate"), "o_orderkey"], 10)


@query
def o3_limit(spark, sf_dir):
    return sets.first_rows(table(spark, sf_dir, "orders"), 10).agg(F.count(F.lit(1)).alias("n"))


# Scalar functions


@query
def f1_rlike_email(spark, sf_dir):
    overdrawn = F.col("c_acctbal") < 0
    email = F.concat(F.lower("c_mktsegment"), F.when(overdrawn, "").otherwise("@"), F.lit("shop.example.com"))
    return table(spark, sf_dir, "customer").select("c_custkey", S.valid_email(email).alias("ok"))


@query
def f2_epoch_to_ts(spark, sf_dir):
    epoch = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    return table(spark, sf_dir, "events").select(
        "event_id",
        S.epoch_to_ts(epoch).cast("timestamp_ntz").alias("status_ts"),
        S.epoch_to_ts(epoch, "exact").cast("timestamp_ntz").alias("exact_ts"),
    )


@query
def f6_slug(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", S.slug("c_name").alias("slug"))


@query
def f7_id_format(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        S.padded_id("CUS-", "c_custkey", 6).alias("customer_id"),
        F.upper(S.text_prefix("c_mktsegment", 3)).alias("code"),
    )


@query
def f9_contains(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").contains("ring").alias("has_ring"))


@query
def f10_temporal(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_add(F.to_date("o_orderdate"), 360).alias("maturity"),
        F.datediff(F.lit(AS_OF).cast("date"), F.to_date("o_orderdate")).cast("bigint").alias("elapsed"),
        S.iso_text("o_orderdate").alias("iso"),
    )


@query
def f11_numeric(spark, sf_dir):
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.round(-F.abs(balance), 2).alias("neg"),
        F.greatest(F.lit(0.0), balance).alias("floored"),
        F.least(F.lit(1.0), balance / 5000).alias("capped"),
    )


@query
def f12_map_default(spark, sf_dir):
    frequency = {"1-URGENT": 25, "2-HIGH": 15, "3-MEDIUM": 12}
    known = S.map_default("o_orderpriority", frequency, 8).alias("freq")
    return table(spark, sf_dir, "orders").select("o_orderkey", known)


@query
def f13_json_extract(spark, sf_dir):
    number = F.get_json_object("props", "$.k").cast("bigint").alias("k")
    return table(spark, sf_dir, "events").select("event_id", number)


@query
def f15_calendar(spark, sf_dir):
    daily = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("kpi_date")).agg(F.count(F.lit(1)).alias("n"))
    return S.on_calendar(daily, "kpi_date", zero=["n"])


# Jobs


def _orders_run(spark: SparkSession, sf_dir: str) -> Layers:
    root = fresh_dir(spark, "orders")
    orders.land_orders(_order_feed(spark, sf_dir), f"{root}/landing")
    return orders.run(spark, f"{root}/landing", root).layers


@query
def l1_medallion_orders(spark, sf_dir):
    return orders.read_daily(spark, _orders_run(spark, sf_dir))


@query
def l1_verify_counts(spark, sf_dir):
    return verify.order_counts(spark, _orders_run(spark, sf_dir))


def _customer_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as customer change events; some updates carry a bad address."""
    kind = F.col("event_type")
    deleted = kind == "error"

    def unless_deleted(value: Column) -> Column:
        return F.when(~deleted, value)

    user = F.col("user_id").cast("string")
    email = F.when(F.col("value") < 5, "unknown").otherwise(F.concat(F.lit("user"), user, F.lit("@example.com")))
    return table(spark, sf_dir, "events").select(
        S.padded_id("CUS-", "user_id", 6).alias("customer_id"),
        unless_deleted(F.concat(F.lit("User "), user)).alias("name"),
        unless_deleted(email).alias("email"),
        unless_deleted(F.concat(F.col("event_id").cast("string"), F.lit(" Main Street"))).alias("address"),
        unless_deleted(kind).alias("city"),
        unless_deleted(F.upper(S.text_prefix("event_type", 2))).alias("state"),
        unless_deleted(S.padded_id("", "event_id", 5)).alias("zip_code"),
        F.when(deleted, "DELETE").when(kind == "signup", "INSERT").otherwise("UPDATE").alias("operation"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).alias("timestamp"),
    )


def _customers_run(spark: SparkSession, sf_dir: str) -> Layers:
    """Two arrivals: inserts and deletes first, then all updates, many of them late."""
    root = fresh_dir(spark, "customers")
    feed = _customer_feed(spark, sf_dir)
    for late in (False, True):
        arrival = feed.filter(F.col("operation").isin("UPDATE") == late)
        tables.export_jsonl(arrival, f"{root}/landing/customers", "append")
        layers = customers.run(spark, f"{root}/landing", root).layers
    return layers


@query
def l2_medallion_customers(spark, sf_dir):
    current = customers.read_customers(spark, _customers_run(spark, sf_dir))
    return current.withColumn("timestamp_datetime", F.col("timestamp_datetime").cast("timestamp_ntz"))


@query
def l2_verify_counts(spark, sf_dir):
    return verify.customer_counts(spark, _customers_run(spark, sf_dir))


@query
def l2_verify_deleted(spark, sf_dir):
    return verify.deleted_customers(spark, _customers_run(spark, sf_dir))


@query
def l2_verify_city(spark, sf_dir):
    return verify.customers_in(spark, _customers_run(spark, sf_dir), "purchase")


@query
def l3_csv_medallion(spark, sf_dir):
    root = fresh_dir(spark, "transactions")
    handed_over = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit("HQ").alias("branch_id"),
        F.to_date("o_orderdate").alias("transaction_date"),
        F.col("o_totalprice").alias("amount"),
        F.lit("Pago").alias("transaction_type"),
        F.col("o_orderpriority").alias("channel"),
        F.lit("Cuenta").alias("product"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("status"),
    )
    source = tables.export_csv(handed_over, f"{root}/landing/transactions")
    layers = transactions.run(spark, source, root).layers
    monthly = transactions.read_table(spark, layers, transactions.MONTHLY)
    return monthly.withColumn("customer_id", F.col("customer_id").cast("bigint"))


# Alerts, scoring, governance


@query
def m1_amount_outlier_alert(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return alerts.amount_outliers(lines, "l_suppkey", "l_extendedprice", 1.7).drop("l_suppkey")


@query
def m2_structuring_alert(spark, sf_dir):
    return alerts.frequent_movements(table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", "o_totalprice", 2)


@query
def m2_high_tier_alert(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))
    return alerts.tier_alerts(lines, table(spark, sf_dir, "part"), "p_partkey", "p_type", ["PROMO"])


@query
def m3_group_stats_pandas(spark, sf_dir):
    stats = alerts.group_stats(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"], "c_acctbal")
    return stats.select(
        "c_mktsegment",
        "c_nationkey",
        "n",
        # Cents over a count is the same number on any engine; a rounded mean is not.
        (F.round("total_value", 2) / F.col("n_known")).alias("mean_bal"),
        F.round("max_value", 2).alias("max_bal"),
    )


@query
def m4_risk_features(spark, sf_dir):
    return scoring.risk_features(table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", overdue())


@query
def m5_credit_score(spark, sf_dir):
    loans = m4_risk_features(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    people = joins.star_join(
        table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), [(loans, ["c_custkey"])]
    ).withColumn("late", (F.col("n_past_due") * 3 > F.col("n_loans")).cast("double"))
    card = scoring.train_score(people, ["n_loans", "max_amount", "c_acctbal"], "late")
    return scoring.credit_score(card, people).select("c_custkey", "late", F.round("score", 6).alias("score"))


@query
def m4_fixed_score(spark, sf_dir):
    """A score card with given weights."""
    card = scoring.ScoreCard({"n_loans": 0.05, "max_amount": -0.00001, "n_past_due": 0.5}, -1.0)
    scored = scoring.credit_score(card, m4_risk_features(spark, sf_dir))
    return scored.select("o_custkey", F.round("score", 6).alias("score"))


@query
def g1_row_filter(spark, sf_dir):
    seen = governance.row_filter(_customer_regions(spark, sf_dir), "r_name", ["ASIA", "EUROPE"])
    return seen.select("c_custkey", "r_name", "c_acctbal")


@query
def g2_column_mask(spark, sf_dir):
    masks = {
        "c_name": governance.partly_hidden("c_name"),
        "c_acctbal": governance.hidden_unless("c_acctbal", F.col("r_name").isin("ASIA", "EUROPE")),
    }
    masked = governance.mask_columns(_customer_regions(spark, sf_dir), masks)
    return masked.select("c_custkey", "c_name", "c_acctbal")


@query
def g1_policy_view(spark, sf_dir):
    """One view, two users: a nation's user sees its region, and balances where the region's number is even."""
    lands = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    members = lands.select(F.col("n_name").alias("user_name"), F.col("r_name").alias("role"))
    regions = table(spark, sf_dir, "region")
    rights = F.array(
        F.struct(F.lit("rows").alias("kind"), F.lit("r_name").alias("column_name"), F.col("r_name").alias("value")),
        F.struct(F.lit("plain").alias("kind"), F.when(F.col("r_regionkey") % 2 == 0, "c_acctbal").alias("column_name"), F.lit(None).cast("string").alias("value")),
    )
    policies = regions.select(F.lit("customer").alias("table_name"), F.col("r_name").alias("role"), F.inline(rights))
    users = [table(spark, sf_dir, "nation").agg(pick("n_name")).scalar() for pick in (F.min, F.max)]
    views = [
        governance.governed(
            _customer_regions(spark, sf_dir), "customer", policies, members, "r_name", {"c_acctbal": F.lit(None)}, user
        ).select(F.lit(place).alias("viewer"), "c_custkey", "r_name", "c_acctbal")
        for place, user in enumerate(users)
    ]
    return views[0].unionByName(views[1])


@query
def g3_audit_log(spark, sf_dir):
    """Two runs of a report in one trail."""
    path = fresh_dir(spark, "audit")
    people, book = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    hashes = {"customer": governance.schema_hash(people), "orders": governance.schema_hash(book)}
    for run_id, as_of in (("first", "2000-01-01"), ("second", AS_OF)):
        report = rules.dq_report(
            [
                rules.TableChecks("customer", people, {"negative_balance": rules.negative_when("c_acctbal")}),
                rules.TableChecks("orders", book, {"future_date": rules.future_when("o_orderdate", as_of)}),
            ]
        )
        governance.audit_append(path, run_id, report, hashes)
    return spark.read.parquet(path).drop("logged_at")
