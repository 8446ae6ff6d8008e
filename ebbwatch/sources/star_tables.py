"""View of the events, customer and nation tables as an activity log.

The layout of the log is that of ``activity_log.RAW_SCHEMA``. Each column comes from
the event itself, except the account columns (customer and nation) and the position
in the session (a ranking); both are built only if asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from ebbwatch.sources.activity_log import RAW_SCHEMA

# The first instant of the events and the length of a session window.
FIRST_MS = 1_704_067_200_000
SESSION_MS = 172_800_000
ACCOUNT_BASE_MS = 1_701_388_800_000

# Pages that remain after cleaning.
PAGES = [
    "AddtoPlaylist", "Cancel", "Error", "Home", "NextSong", "SubmitDowngrade", "SubmitUpgrade", "ThumbsUp",
]

_ACCOUNT_COLUMNS = {"gender", "location", "registration"}
_RANK_SLICE_MS = 60_000


def activity_log(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The log over the tables in ``sf_dir``, with all columns or the named ones."""
    names = list(columns) or RAW_SCHEMA.fieldNames()
    rows = _events(spark, sf_dir)
    if "itemInSession" in names:
        rows = _number_within_session(rows)
    if _ACCOUNT_COLUMNS & set(names):
        # Left to the adaptive planner: broadcast if customer is small, else a sort-merge
        # join whose hot users it splits. It can split because customer is one row per key
        # as it stands: an aggregate right below the join would rule the splitting out.
        rows = rows.join(_accounts(spark, sf_dir), "user_id", "left")
    derived = _derived_columns()
    rows = rows.withColumn("page", derived.pop("page"))
    return rows.select(*[derived.get(name, F.col(name)).cast(RAW_SCHEMA[name].dataType).alias(name) for name in names])


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = F.expr(f"{FIRST_MS} + 3 * (unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000 - {FIRST_MS})")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .select(
            "event_id", "user_id", "event_type", "value", ms.alias("ts"),
            F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"),
        )
        .withColumn("sessionId", (F.floor(F.col("ts") / SESSION_MS) * 2 + F.col("k") % 2).cast("bigint"))
    )


def _derived_columns() -> dict[str, Column]:
    kind, k, user = F.col("event_type"), F.col("k"), F.col("user_id")
    error = kind == "error"
    cancel = error & F.coalesce(F.col("value") > 200, F.lit(False))
    # Stated on the event columns rather than on the page: the cleaning filters on auth and
    # userId are pushed to the scan, and there this is cheaper than the whole page mapping.
    logout = error & ~F.coalesce(F.col("value") > 200, F.lit(False)) & (k < 10)
    song = kind == "view"
    page = F.col("page")
    pages = (
        F.when(cancel, "Cancel")
        .when(logout, "Logout")
        .when(error, "Error")
        .when(song, "NextSong")
        .when(kind == "click", F.when(k < 50, "Home").otherwise("Thumbs Up"))
        .when(kind == "purchase", "Add to Playlist")
        .when(kind == "signup", F.when(k < 50, "Submit Upgrade").otherwise("Submit Downgrade"))
    )
    return {
        "page": pages,
        "auth": F.when(cancel, "Cancelled").when(logout, "Logged Out").otherwise("Logged In"),
        "userId": F.when(logout & (k < 5), "").otherwise(user.cast("string")),
        "level": F.when(k >= 50, "paid").otherwise("free"),
        "length": F.when(song, F.col("value")),
        "artist": F.when(song, F.concat(F.lit("Artist "), F.col("event_id") % 97, F.lit(" & Co."))),
        "song": F.when(song, F.concat(F.lit("Song #"), k, F.lit(" (live)"))),
        "firstName": F.when(~logout, F.concat(F.lit("Name "), user % 50)),
        "lastName": F.when(~logout, F.concat(F.lit("O'Neil-"), user % 30)),
        "userAgent": F.when(~logout, F.concat(F.lit("Mozilla/5.0 (agent "), user % 5, F.lit(")"))),
        "method": F.when(page.isin("Error", "Home"), "GET").otherwise("PUT"),
        "status": F.when(page == "Error", 404)
        .when(page.isin("Cancel", "Logout", "Submit Upgrade", "Submit Downgrade"), 307)
        .otherwise(200),
    }


def _accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    key, nk = F.col("c_custkey"), F.col("n_nationkey")
    city = F.concat(F.lit("City "), nk)
    states = F.concat(F.lit(", "), F.char(65 + nk), F.lit("X-"), F.char(65 + nk % 5), F.lit("Y"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        key.alias("user_id"),
        F.when(key % 17 != 0, F.when(key % 2 == 0, "F").otherwise("M")).alias("gender"),
        F.when(key % 13 == 0, city).otherwise(F.concat(city, states)).alias("location"),
        (F.lit(ACCOUNT_BASE_MS) - (key % 200) * 86_400_000 - (key % 24) * 3_600_000).alias("registration"),
    )


def _number_within_session(rows: DataFrame) -> DataFrame:
    """Number each session's events from 0 in time order.

    One window over (user, session) would put a hot user's session into one task.
    Instead each minute is ranked on its own and shifted by the number of events
    in the session's earlier minutes. A session spans two days, so the running
    sum sees at most 2,880 rows per session however many events there are.
    """
    rows = rows.withColumn("slice", F.floor(F.col("ts") / _RANK_SLICE_MS))
    keys = ["user_id", "sessionId", "slice"]
    earlier = Window.partitionBy("user_id", "sessionId").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys).agg(F.count("*").alias("n"))
        .select(*keys, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    )
    within = Window.partitionBy(*keys).orderBy("ts", "event_id")
    return (
        rows.withColumn("position", F.row_number().over(within))
        .join(offsets, keys, "left")
        .withColumn("itemInSession", F.col("offset") + F.col("position") - 1)
        .drop("slice", "position", "offset")
    )
