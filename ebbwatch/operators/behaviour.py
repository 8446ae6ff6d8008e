"""Daily and monthly means of what a user does.

All means are means of period values, and durations are means of means: per session,
then per (user, period), then per user. One pipeline serves both grains.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRICS = ("duration", "items", "pages", "sessions")
GRAINS = ("daily", "monthly")

# Pages that have no visit features.
PAGES_WITHOUT_FEATURE = ("Cancel", "CancellationConfirmation")


def discover_pages(clean: DataFrame, limit: int = 1000) -> list[str]:
    """Page names in the log, sorted. They become columns, so there must be few of them; for more, see ``page_means_long``."""
    rows = clean.select("page").where(F.col("page").isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} distinct pages: too many columns; use page_means_long and ml.page_vectors")
    return sorted(row.page for row in rows)


def feature_pages(pages: Sequence[str]) -> list[str]:
    return sorted(set(pages) - set(PAGES_WITHOUT_FEATURE))


def _month(month_grain: str) -> Column:
    """Number of the month: of the year (years fall together), or of the calendar."""
    if month_grain == "month":
        return F.month("date")
    if month_grain == "yyyy-MM":
        return F.year("date") * 12 + F.month("date")
    raise ValueError(f"unknown month grain {month_grain!r}")


def user_behaviour(
    clean: DataFrame,
    pages: Sequence[str] = (),
    metrics: Sequence[str] = METRICS,
    grains: Sequence[str] = GRAINS,
    month_grain: str = "month",
    from_states: bool = False,
) -> DataFrame:
    """One row per user with avg_<grain>_* columns for the chosen metrics and grains.

    The rows are read once for the pages and once for all else; both come out hashed by user. Every
    step is a hash aggregate that combines on the map side, so a hot user or day never meets in
    one task before it has been reduced to sessions per period, then to periods, then to one row.
    A page of the log that is not among ``pages`` is an error. With ``from_states``, the rows are
    those of an activity cube instead of single events.
    """
    unknown = [*set(metrics) - set(METRICS), *set(grains) - set(GRAINS)]
    if unknown:
        raise ValueError(f"unknown metrics or grains: {sorted(unknown)}")
    duration, items, sessions = (m in metrics for m in ("duration", "items", "sessions"))
    per_session: dict[str, Column] = {}
    per_period: dict[str, Column] = {}
    first, last, position = ("start", "end", "items") if from_states else ("ts", "ts", "itemInSession")
    if duration:
        per_session |= {"start": F.min(first), "end": F.max(last)}
        per_period["duration"] = F.avg((F.col("end") - F.col("start")) * 0.001)
    if items:
        per_session["items"] = F.max(position)
        per_period["items"] = F.max("items")

    def mean(grain: str, name: str) -> Column:
        return F.avg(F.when(F.col("grain") == code[grain], F.col(name)))

    code = {g: i for i, g in enumerate(GRAINS)}
    out: dict[str, Column] = {}
    if duration:
        out |= {f"avg_{g}_session_duration": mean(g, "duration") for g in grains}
    if items:
        out |= {f"avg_{g}_items": mean(g, "items") for g in grains}
    before = ["userId", *out]
    if sessions:
        out |= {f"avg_{g}_sessions": mean(g, "sessions") for g in grains}
    if not out:
        return _page_means(clean, pages, grains, month_grain, from_states) if "pages" in metrics else clean.select("userId").distinct()

    # Each event counts towards its day and towards its month. The copies meet a hash
    # aggregate in the same stage, so only reduced rows are shuffled.
    periods = {"daily": F.unix_date("date"), "monthly": _month(month_grain)}
    slots = [F.struct(F.lit(code[g]).alias("grain"), periods[g].alias("period")) for g in grains]
    events = clean.select("*", F.inline(F.array(*slots)))
    if duration or sessions:
        if sessions:
            per_period["sessions"] = F.count("sessionId")
        by_session = _grouped(events, ["userId", "grain", "period", "sessionId"], per_session)
        by_period = _grouped(by_session, ["userId", "grain", "period"], per_period)
    else:
        # Only the metrics above look at single sessions.
        by_period = _grouped(events, ["userId", "grain", "period"], per_session)
    behaviour = _grouped(by_period, ["userId"], out)
    if "pages" not in metrics or not feature_pages(pages):
        return behaviour
    visits = _page_means(clean, pages, grains, month_grain, from_states)
    columns = [*before, *visits.columns[1:], *behaviour.columns[len(before):]]
    return behaviour.join(visits, "userId").select(*[F.col(f"`{c}`") for c in columns])


def page_counts(clean: DataFrame, pages: Sequence[str] | None = None, from_states: bool = False) -> DataFrame:
    """(userId, date, page, n): visits in long form, which stays as narrow with any number of pages.

    If pages are given, one that is neither listed nor without a feature is an error.
    """
    visits = F.sum("n") if from_states else F.count("*")
    counts = clean.groupBy("userId", "date", "page").agg(visits.alias("n"))
    if pages is None:
        return counts
    known = F.col("page").isNull() | F.col("page").isin(*{*pages, *PAGES_WITHOUT_FEATURE})
    message = F.concat(F.lit("page without a column: "), "page")
    return counts.withColumn("page", F.when(known, F.col("page")).otherwise(F.raise_error(message)))


def page_means(daily: DataFrame, grains: Sequence[str] = GRAINS, month_grain: str = "month") -> DataFrame:
    """(userId, page, grain, mean): mean visits over the periods with a visit, from the rows of ``page_counts``.

    Days are counted from the log and months from the days. Any number of pages will do.
    """
    monthly = daily.groupBy("userId", _month(month_grain).alias("period"), "page").agg(F.sum("n").alias("n"))
    periods = {"daily": daily, "monthly": monthly}
    parts = [
        periods[g].groupBy("userId", "page").agg(F.avg("n").alias("mean")).select("userId", "page", F.lit(g).alias("grain"), "mean")
        for g in grains
    ]
    return reduce(DataFrame.unionByName, parts)


def page_means_long(clean: DataFrame, grains: Sequence[str] = GRAINS, month_grain: str = "month", from_states: bool = False) -> DataFrame:
    """(userId, page, grain, mean) for all pages that have a feature, without a list of pages."""
    featured = clean.where(F.col("page").isNotNull() & ~F.col("page").isin(*PAGES_WITHOUT_FEATURE))
    return page_means(page_counts(featured, from_states=from_states), grains, month_grain)


def _page_means(
    clean: DataFrame, pages: Sequence[str], grains: Sequence[str], month_grain: str, from_states: bool = False
) -> DataFrame:
    """(userId, avg_<grain>_<page>...): 0 for a page never seen; only rows of a user and a page become columns."""
    means = page_means(page_counts(clean, pages, from_states), grains, month_grain)
    cells = {
        f"avg_{g}_{page}": F.coalesce(F.max(F.when((F.col("grain") == g) & (F.col("page") == page), F.col("mean"))), F.lit(0.0))
        for g in grains for page in feature_pages(pages)
    }
    return _grouped(means, ["userId"], cells)


def _grouped(rows: DataFrame, keys: list[str], measures: dict[str, Column]) -> DataFrame:
    if not measures:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).agg(*[column.alias(name) for name, column in measures.items()])


def session_duration(clean: DataFrame, month_grain: str = "month") -> DataFrame:
    return user_behaviour(clean, metrics=["duration"], month_grain=month_grain)


def items(clean: DataFrame, month_grain: str = "month") -> DataFrame:
    """Means of the highest position in a session, as it stands at the end of each period."""
    return user_behaviour(clean, metrics=["items"], month_grain=month_grain)


def session_counts(clean: DataFrame, month_grain: str = "month") -> DataFrame:
    return user_behaviour(clean, metrics=["sessions"], month_grain=month_grain)


def page_visits(
    clean: DataFrame, pages: Sequence[str], grains: Sequence[str] = GRAINS, month_grain: str = "month"
) -> DataFrame:
    return user_behaviour(clean, pages, metrics=["pages"], grains=grains, month_grain=month_grain)


def page_pivot(clean: DataFrame, period: str, pages: Sequence[str]) -> DataFrame:
    """Visits per (user, period) and page; null where a page was not visited. ``other`` counts the
    visits to pages that are not listed, and those without a page.

    With the pages given, the pivot needs no job of its own to find them.
    """
    listed = F.when(F.col("page").isin(*pages), F.col("page")).otherwise("other")
    return clean.withColumn("page", listed).groupBy("userId", period).pivot("page", [*pages, "other"]).count()
