"""The daily run: bronze to silver, silver into the warehouse, warehouse to gold, with a gate after each.

Each step is a few whole-table jobs over the days at hand; nothing loops over days on the driver.

* Silver is stored by event day and ingest day. A run replaces all that its own ingest days brought, and nothing else:
  late events join their event day without touching what earlier runs stored there, and a day that is run again
  leaves no rows in event days it no longer reaches.
* Items that break a check are set aside with the reason, and the run goes on with the others. It stops where a check
  takes more than ``REJECTED_SHARE`` of the items, or where items are lost between the layers.
* The warehouse merge rewrites the event days it touches, and gold is recomputed for those days.
* The ledger is the commit point: it names the days done and the version they went into, and is written
  when all gates have passed. Until then the earlier version stays current. A run that failed half way
  is repeated under a new version name and gives the same result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispatchlake.functions.keys import topic_name
from dispatchlake.operators import days, gold, quality, silver, sinks
from dispatchlake.operators.daytable import DayTable, day_key, read_stored
from dispatchlake.schemas import ITEM, LANDED_RECORD, SILVER_ITEMS, SILVER_ORDERS
from dispatchlake.session import configure
from dispatchlake.sources import feeds

GOLD = ["daily_metrics", "fulfillment_metrics", "delivery_time_metrics", "order_volume_metrics", "eta_accuracy_metrics"]
REJECTED_SHARE = 0.1  # of the items of a run, for each check
INGEST_DAY = T.StructField("ingest_date", T.DateType())
LEDGER = "day date, version string, finished_at timestamp"
# Items carry the time and day of their order: the one decides which item is newer, the other where it is stored.
WAREHOUSE_ITEMS = T.StructType(
    [*SILVER_ITEMS.fields, SILVER_ORDERS["event_timestamp"], SILVER_ORDERS["event_date"]]
)


@dataclass
class Lake:
    """Where the layers are stored."""

    root: str
    orders_topic: str = topic_name("orders")

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver_orders(self) -> str:
        return f"{self.root}/silver/orders"

    @property
    def silver_items(self) -> str:
        return f"{self.root}/silver/order_items"

    @property
    def rejects(self) -> str:
        return f"{self.root}/silver/rejects"

    @property
    def item_rejects(self) -> str:
        return f"{self.root}/silver/item_rejects"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    def gold(self, name: str, version: str) -> str:
        return f"{self.root}/gold/{name}/{version}"

    @property
    def warehouse(self) -> dict[str, DayTable]:
        path = f"{self.root}/warehouse"
        return {
            "orders": DayTable(f"{path}/orders", SILVER_ORDERS, ["order_id"], ["event_timestamp", "event_id"]),
            "order_items": DayTable(
                f"{path}/order_items",
                WAREHOUSE_ITEMS,
                ["order_id", "item_id"],
                ["event_timestamp", "name", "quantity", "unit_price", "total_price"],
            ),
        }


# ---------------------------------------------------------------------------
# what is done and what is current
# ---------------------------------------------------------------------------
def ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """Ingest days of finished runs and the table version each went into."""
    return read_stored(spark, T.StructType.fromDDL(LEDGER), lake.ledger)


def current_version(spark: SparkSession, lake: Lake) -> str | None:
    """The version of the last finished run."""
    return ledger(spark, lake).agg(F.max_by("version", "finished_at")).first()[0]


def current_table(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A warehouse or gold table of the last finished run."""
    version = current_version(spark, lake)
    if name in lake.warehouse:
        return lake.warehouse[name].read(spark, version).drop("day")
    return spark.read.parquet(lake.gold(name, version))


def pending_ingest_days(spark: SparkSession, lake: Lake, before: date) -> list[date]:
    """Closed landed days that no run has finished: a list of calendar days, short whatever the data size."""
    landed = spark.read.schema(LANDED_RECORD).parquet(lake.bronze).filter(
        (F.col("topic") == lake.orders_topic) & (F.col("ingest_date") < F.lit(before))
    )
    pending = days.pending_days(days.present_days(landed, "ingest_date"), ledger(spark, lake).select("day").distinct())
    return [r.day for r in pending.orderBy("day").collect()]


# ---------------------------------------------------------------------------
# silver
# ---------------------------------------------------------------------------
def silver_orders_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """Silver orders with their item lists, by event day and ingest day."""
    items = T.StructField("items", T.ArrayType(ITEM))
    return read_stored(spark, T.StructType([*SILVER_ORDERS.fields, items, INGEST_DAY]), lake.silver_orders)


def silver_items_table(spark: SparkSession, lake: Lake) -> DataFrame:
    return read_stored(spark, T.StructType([*WAREHOUSE_ITEMS.fields, INGEST_DAY]), lake.silver_items)


def item_rejects_table(spark: SparkSession, lake: Lake) -> DataFrame:
    """Items that broke a check, whole and with the check they broke first."""
    reason = T.StructField("reason", T.StringType())
    return read_stored(spark, T.StructType([*WAREHOUSE_ITEMS.fields, reason, INGEST_DAY]), lake.item_rejects)


def of_days(table: DataFrame, ingest_days: list[date]) -> DataFrame:
    return table.filter(F.col("ingest_date").isin(ingest_days))


def refresh_silver(spark: SparkSession, lake: Lake, ingest_days: list[date]) -> None:
    """Clean the given ingest days into silver orders, then cut their items out of what was stored.

    Records that cannot be read or break a rule go to the table of rejects, whole and with the reason, and so do
    items, to a table of their own. Reading the item lists back costs one nested column.
    """
    configure(spark)

    def replace(rows: DataFrame, path: str, *by: str) -> None:
        sinks.replace_days(rows, path, "ingest_date", ingest_days, *by)

    landed = feeds.read_lake_messages(spark, lake.bronze, lake.orders_topic, ingest_days)
    replace(silver.silver_orders(feeds.lake_orders(landed)), lake.silver_orders, "event_date", "ingest_date")
    replace(feeds.lake_rejects(landed), lake.rejects, "ingest_date")
    orders = of_days(silver_orders_table(spark, lake), ingest_days)
    items = silver.order_items(orders, carry=("event_timestamp", "event_date", "ingest_date"))
    items = items.withColumn("reason", quality.first_broken(quality.item_checks()))
    replace(items.filter(F.col("reason").isNull()).drop("reason"), lake.silver_items, "event_date", "ingest_date")
    replace(items.filter(F.col("reason").isNotNull()), lake.item_rejects, "ingest_date")


def check_silver(spark: SparkSession, lake: Lake, ingest_days: list[date]) -> DataFrame:
    """Gate over what the given ingest days brought."""
    checks = quality.silver_checks()
    checks.pop("event_timestamp is null")  # kept on purpose: such orders are reported, not refused
    orders, items, rejects = (
        of_days(table(spark, lake), ingest_days) for table in (silver_orders_table, silver_items_table, item_rejects_table)
    )
    listed = orders.select(F.greatest(F.size("items"), F.lit(0)).alias("items"))
    set_aside = quality.quarantine_report("silver_items", listed, items, rejects, quality.item_checks(), REJECTED_SHARE)
    return quality.gate_report({"silver_orders": (orders, checks)}).unionByName(set_aside)


# ---------------------------------------------------------------------------
# warehouse
# ---------------------------------------------------------------------------
def refresh_warehouse(spark: SparkSession, lake: Lake, version: str, ingest_days: list[date]) -> dict[str, list[str]]:
    """Merge the silver rows of ``ingest_days`` into the current tables, stored as ``version``.

    Several events of one order reduce to the newest. Returns the event days touched, per table.
    """
    configure(spark)
    current = current_version(spark, lake)
    loads = {"orders": silver_orders_table(spark, lake), "order_items": silver_items_table(spark, lake)}
    return {
        name: lake.warehouse[name].merge(spark, of_days(load, ingest_days), current, version)
        for name, load in loads.items()
    }


def check_warehouse(spark: SparkSession, lake: Lake, version: str, touched: dict[str, list[str]]) -> DataFrame:
    """No null keys, and every key once, on the days a merge touched."""

    def layer(table: DayTable, its_days: list[str]):
        no_key = F.greatest(*[F.col(k).isNull() for k in table.keys], F.lit(False))
        return (
            table.read(spark, version, its_days).groupBy(*table.keys).agg(F.count(F.lit(1)).alias("n")),
            {"key repeats": F.col("n") > 1, "key is null": no_key},
        )

    return quality.gate_report({f"warehouse.{n}": layer(lake.warehouse[n], d) for n, d in touched.items()})


# ---------------------------------------------------------------------------
# gold
# ---------------------------------------------------------------------------
def refresh_gold(spark: SparkSession, lake: Lake, version: str, touched_days: list[str]) -> DataFrame:
    """Gold tables of a version: touched days in one pass over their orders, other days from the current
    version. Returns the daily table the others are cut from."""
    configure(spark)
    current = current_version(spark, lake)
    daily = gold.daily_metrics(lake.warehouse["orders"].read(spark, version, touched_days))
    if current is not None:
        earlier = spark.read.parquet(lake.gold("daily_metrics", current))
        daily = daily.unionByName(earlier.filter(~day_key().isin(touched_days)))
    sinks.write_all(daily.hint("rebalance"), lake.gold("daily_metrics", version))
    stored = spark.read.parquet(lake.gold("daily_metrics", version))
    for name, table in gold.split_daily(stored).items():
        sinks.write_all(table, lake.gold(name, version))
    return stored


def check_gold(daily: DataFrame) -> DataFrame:
    """Gate over all days; orders without a readable time have none and are left to the silver report."""
    return quality.gate_report({"gold": (daily.filter(F.col("event_date").isNotNull()), quality.gold_checks())})


def publish_views(spark: SparkSession, lake: Lake, version: str) -> None:
    """Move SQL readers to a version."""
    for name, table in lake.warehouse.items():
        table.create_view(spark, name, version)
    for name in GOLD:
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{lake.gold(name, version)}`")


def run(
    spark: SparkSession, lake: Lake, version: str, before: date | None = None, again: Iterable[date] = ()
) -> list[date]:
    """One daily run over the landed days before ``before`` (default: today, as that day is still filling).

    ``again`` names finished days to run once more from what landed, such as after a contract or a check has changed:
    rejects that pass now move on, and a second replay changes nothing. The warehouse keeps the newest row of a key,
    so keys that a day no longer brings stay there.
    Readers are moved to the current version on every run. A failed gate raises before the next layer is written, and leaves the current version in place.
    Returns the ingest days done.
    """
    configure(spark)
    now = datetime.now(timezone.utc)
    todo = sorted({*pending_ingest_days(spark, lake, before or now.date()), *again})
    if not todo:
        current = current_version(spark, lake)
        if current is not None:
            publish_views(spark, lake, current)  # in case the run that made it failed to
        return todo
    refresh_silver(spark, lake, todo)
    quality.enforce(check_silver(spark, lake, todo))
    touched = refresh_warehouse(spark, lake, version, todo)
    quality.enforce(check_warehouse(spark, lake, version, touched))
    quality.enforce(check_gold(refresh_gold(spark, lake, version, touched["orders"])))
    done = spark.createDataFrame([(d, version, now) for d in todo], LEDGER)
    done.coalesce(1).write.mode("append").parquet(lake.ledger)
    publish_views(spark, lake, version)
    return todo
