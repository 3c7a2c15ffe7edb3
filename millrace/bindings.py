"""The driver's tables in the shapes the operators take. Always whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.times import ARCHIVE_STAMP_FORMAT

# Archive type names the events take; 'error' has none and stays, as an uncoded type.
ARCHIVE_TYPES = {
    "click": "PushEvent",
    "view": "WatchEvent",
    "purchase": "CreateEvent",
    "signup": "MemberEvent",
}
LATER = "2024-01-02 00:00:00"  # events before it count as stored, the others as incoming


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def _events(self) -> DataFrame:
        return self.table("events").withColumns(
            {
                "ts": F.col("ts").cast("timestamp"),
                "k": F.get_json_object("props", "$.k").cast("bigint"),
            }
        )

    def archive(self) -> DataFrame:
        """Events nested as in an archive file."""
        types = F.create_map(*[F.lit(text) for pair in ARCHIVE_TYPES.items() for text in pair])
        user = F.col("user_id")
        path = F.concat(F.lit("org"), user % 20, F.lit("/repo"), F.col("k") % 10)
        return self._events().select(
            F.col("event_id").cast("string").alias("id"),
            F.coalesce(F.try_element_at(types, F.col("event_type")), F.col("event_type")).alias("type"),
            F.struct(F.col("k").cast("string").alias("id"), path.alias("name")).alias("repo"),
            F.struct(
                user.cast("string").alias("id"),
                F.concat(F.lit("user_"), user).alias("login"),
            ).alias("actor"),
            F.date_format("ts", ARCHIVE_STAMP_FORMAT).alias("created_at"),
        )

    def trades(self) -> DataFrame:
        """Every event as a trade that lasts twice its value in seconds."""
        lasting = F.make_dt_interval(secs=(F.col("value") * 2).cast("decimal(18,6)"))
        return self._events().select(
            F.col("user_id").alias("login"),
            F.col("event_id").alias("ticket"),
            (F.col("event_type") == "click").cast("int").alias("cmd"),
            F.col("ts").alias("open_time"),
            (F.col("ts") + lasting).alias("close_time"),
        )

    def trade_marks(self) -> DataFrame:
        return self._events().select(
            F.col("event_id").alias("ticket"), F.col("k").cast("int").alias("type")
        )

    def deals(self) -> DataFrame:
        """Neighbouring events as the open and the close of a position."""
        return self._events().select(
            F.col("user_id").alias("login"),
            F.call_function("div", F.col("event_id"), F.lit(2)).alias("positionid"),
            (F.col("event_type") == "click").cast("int").alias("action"),
            (F.col("event_id") % 2).cast("int").alias("entry"),
            F.col("ts").alias("time"),
        )

    def deal_marks(self) -> DataFrame:
        return self.trade_marks().withColumnRenamed("ticket", "positionid")

    def raw_rates(self) -> DataFrame:
        """Orders as text rates with a decimal comma."""
        return self.table("orders").select(
            F.col("o_orderstatus").alias("code"),
            F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(",")).alias("rate"),
            F.col("o_orderpriority").alias("base"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        )

    def rate_documents(self) -> DataFrame:
        """Per base and date one document with the highest rate of each symbol."""
        highest = [
            F.max(F.when(F.col("o_orderstatus") == code, F.col("o_totalprice"))).alias(code)
            for code in ("F", "O", "P")
        ]
        pairs = [item for code in ("F", "O", "P") for item in (F.lit(code), F.col(code))]
        return (
            self.table("orders")
            .groupBy(
                F.col("o_orderpriority").alias("base"),
                F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            )
            .agg(*highest)
            .select("base", "date", F.create_map(*pairs).alias("rates"))
        )

    def ratings(self) -> DataFrame:
        """Order lines as text ratings of parts."""
        return self.table("lineitem").select(
            F.col("l_orderkey").cast("string").alias("userId"),
            F.col("l_partkey").cast("string").alias("movieId"),
            F.col("l_quantity").cast("string").alias("rating"),
            F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("string").alias("timestamp"),
        )

    def movies(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("movieId"), F.col("p_name").alias("title")
        )

    def lines(self) -> DataFrame:
        """Lines of all documents."""
        return self.table("documents").select(F.explode(F.split("text", "\n")).alias("value"))

    def part_names(self) -> DataFrame:
        """Part names in camel case: 'small ring' becomes 'SmallRing'."""
        return self.table("part").select(
            F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")).alias("name")
        ).distinct()

    def name_classes(self) -> DataFrame:
        """A dictionary of first words, from the words the part names use."""
        word = F.initcap(F.split_part("p_name", F.lit(" "), F.lit(1)))
        kind = F.when(word.isin("Small", "Large"), "size").when(word.isin("Red", "Blue"), "colour")
        return (
            self.table("part")
            .select(word.alias("token"), kind.alias("class"))
            .where("class is not null")
            .distinct()
        )
