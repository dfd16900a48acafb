"""Website activity: session summaries, most-viewed recipe per day, daily report.

Shape of the work (one shuffle of the event rows):

    events --parse JSON once--> typed events
           --aggregate by session (map-side partials)--> one row per session
           --aggregate by (day, ended-on-view, last recipe)--> a few rows per day
           --per day--> report

The "last event of the session" and the session start are aggregates (``max_by``
on (timestamp, event id) and ``min``), not windows, so no session is ever buffered
whole in a task: a bot session holding a third of all events is combined map-side
like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sousflow.functions.json import json_field, parse_json_safe
from sousflow.functions.text import strip_quotes
from sousflow.functions.time import epoch_seconds, seconds_between
from sousflow.operators.strings import sorted_string_agg
from sousflow.operators.windows import with_group_values

# Event names in the JSON details.
VIEW_EVENT = "view_recipe"
SEARCH_EVENT = "search"


def parse_events(website_activity: DataFrame) -> DataFrame:
    """session_id, event_id, event_timestamp, event, recipe_id; JSON parsed once."""
    parsed = website_activity.select("session_id", "event_id", "event_timestamp",
                                     parse_json_safe("event_details").alias("_v"))
    return parsed.select("session_id", "event_id", "event_timestamp",
                         json_field("_v", "$.event").alias("event"),
                         json_field("_v", "$.recipe_id").alias("recipe_id"))


def _session_grain(website_activity: DataFrame) -> DataFrame:
    ev = parse_events(website_activity).withColumn("_sec", epoch_seconds("event_timestamp"))
    last = F.max_by(F.struct("event", "recipe_id"), F.struct("event_timestamp", "event_id"))
    s = ev.groupBy("session_id").agg(
        F.min(F.to_date("event_timestamp")).alias("session_date"),
        last.alias("_last"),
        F.count_if(F.col("event") == SEARCH_EVENT).alias("num_searches"),
        F.count_if(F.col("event") == VIEW_EVENT).alias("num_views"),
        seconds_between(F.min("_sec"), F.max("_sec")).alias("session_length"),
    )
    viewed = F.coalesce(F.col("_last.event") == VIEW_EVENT, F.lit(False))
    return s.select("session_date", "session_id", viewed.alias("has_viewed_recipe"), "num_searches",
                    "session_length", "num_views", F.col("_last.recipe_id").alias("last_recipe_id"))


def session_summary(website_activity: DataFrame) -> DataFrame:
    """Per session: start date, ended-on-a-view flag, searches, length in seconds.

    The length counts second boundaries between the first and last event
    (truncate both ends, subtract), independent of the session timezone.
    """
    return _session_grain(website_activity).select(
        "session_date", "session_id", "has_viewed_recipe", "num_searches", "session_length")


def _day_recipe_grain(website_activity: DataFrame) -> DataFrame:
    """(day, ended on a view, last recipe) -> session counts and sums."""
    s = _session_grain(website_activity)
    rid = F.when(F.col("has_viewed_recipe"), F.col("last_recipe_id"))
    return (s.groupBy("session_date", "has_viewed_recipe", rid.alias("recipe_id"))
             .agg(F.count("session_id").alias("n_sessions"),
                  F.sum("session_length").alias("len_sum"),
                  F.count("session_length").alias("len_cnt"),
                  F.sum("num_searches").alias("search_sum"),
                  F.count("num_searches").alias("search_cnt"),
                  F.sum("num_views").alias("views")))


def most_viewed_daily(website_activity: DataFrame) -> DataFrame:
    """Per day, the recipe(s) with most views in sessions that ended on a view (ties kept).

    Views are all view events of such sessions, credited to the recipe of the last
    event.
    """
    g = _day_recipe_grain(website_activity)
    top = g.where("has_viewed_recipe").groupBy("session_date").agg(F.max("views").alias("_top"))
    return _winners(g, top).select(F.col("_day").alias("session_date"), "recipe_id")


def _winners(g: DataFrame, days: DataFrame) -> DataFrame:
    """The recipes whose views equal their day's ``_top``; a day's recipes never meet in one task."""
    viewed = g.where("has_viewed_recipe").select(F.col("session_date").alias("_day"), "views", "recipe_id")
    return viewed.join(days.select("session_date", "_top"), F.expr("_day <=> session_date AND views = _top"), "inner")


def _daily_metrics(g: DataFrame) -> list:
    viewed = F.col("has_viewed_recipe")
    return [
        F.sum("n_sessions").alias("num_sessions"),
        F.try_divide(F.sum("len_sum").cast("double"), F.sum("len_cnt")).alias("avg_session_length_seconds"),
        F.try_divide(F.sum(F.when(viewed, F.col("search_sum"))).cast("double"),
                     F.sum(F.when(viewed, F.col("search_cnt")))).alias("avg_num_searches_before_viewing_recipe"),
    ]


def daily_sessions(website_activity: DataFrame) -> DataFrame:
    """Per day: sessions, average length, average searches in sessions ending on a view."""
    g = _day_recipe_grain(website_activity)
    return g.groupBy("session_date").agg(*_daily_metrics(g))


def daily_report(website_activity: DataFrame) -> DataFrame:
    """Daily metrics with the most-viewed recipe ids as one ', '-joined string.

    Days whose average session length is not above 0 are dropped. Ties are joined
    in ascending id order; a day without a counted view gets ''. A day's top count is an
    aggregate joined back, and only the winners reach the string aggregate, so no task holds
    the recipes of a day.
    """
    g = _day_recipe_grain(website_activity)
    days = g.groupBy("session_date").agg(*_daily_metrics(g), F.max(F.when(F.col("has_viewed_recipe"), F.col("views"))).alias("_top"))
    ids = _winners(g, days).groupBy("_day").agg(sorted_string_agg("recipe_id").alias("_ids"))
    report = days.join(ids, days.session_date.eqNullSafe(ids["_day"]), "left").withColumn("_ids", F.coalesce("_ids", F.lit("")))
    return (report.where(F.col("avg_session_length_seconds") > 0)
                  .select("session_date", "num_sessions", "avg_session_length_seconds",
                          "avg_num_searches_before_viewing_recipe", strip_quotes("_ids").alias("most_viewed_recipe"))
                  .orderBy(F.col("session_date").asc_nulls_last()))


def session_start_and_last_event(website_activity: DataFrame) -> DataFrame:
    """Every event with its session's start date and the session's last event.

    Equivalent to MIN(date) and a whole-partition LAST_VALUE over the session
    window (ties on time broken by event id), computed as aggregates joined back.
    """
    ev = parse_events(website_activity)
    values = [F.min(F.to_date("event_timestamp")).alias("session_date"),
              F.max_by(F.struct("event", "recipe_id"), F.struct("event_timestamp", "event_id")).alias("_last")]
    out = with_group_values(ev, ["session_id"], values)
    return out.select("event_id", "session_id", "event_timestamp", "session_date",
                      F.col("_last.event").alias("last_event"), F.col("_last.recipe_id").alias("last_recipe_id"))


def recipe_views(website_activity: DataFrame) -> DataFrame:
    """View events with the recipe id read from the JSON details."""
    return (parse_events(website_activity).where(F.col("event") == VIEW_EVENT)
                                          .select("event_id", "session_id", "event_timestamp", "recipe_id"))
