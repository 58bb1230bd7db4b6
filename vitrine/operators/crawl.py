"""Fetch results of pages as mergeable states: what to fetch next, and when.

A page's state says how often it was tried, when it succeeded and how it failed last.  States of several
rounds add up in any order, so a crawl round appends its reduced results and nothing is rewritten.
Which pages are due follows from the state alone: a page that succeeded is never fetched again, one
that failed comes back after a pause that doubles with each attempt, until it is given up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import filled

KEYS = ["current_url"]
# Pause after the first failure, longest pause, and attempts after which a page is given up.
FIRST_PAUSE, LONGEST_PAUSE, ATTEMPTS = 3600, 7 * 86400, 8


def reduce_results(results: DataFrame, round_id: str | Column, fetched_at: str | Column = "fetched_at") -> DataFrame:
    """States of one round's extraction output (current_url, error, time of the fetch).

    The tries of a round are kept under its name, so a round that is reduced or stored twice counts once.
    """
    at = F.col(fetched_at) if isinstance(fetched_at, str) else fetched_at
    name = F.lit(round_id) if isinstance(round_id, str) else round_id
    tried = results.where(filled(F.col("current_url"))).select(
        "current_url", at.cast("timestamp").alias("at"), F.col("error").alias("error"))
    failed = F.col("error").isNotNull()
    return tried.groupBy("current_url").agg(
        F.min(F.when(~failed, F.col("at"))).alias("succeeded_at"),
        F.max(F.when(failed, F.struct("at", "error"))).alias("last_failure"),
        F.array_sort(F.collect_set(F.struct(name.alias("round"), F.col("at")))).alias("tries"))


def combine_results(stored: DataFrame) -> DataFrame:
    """States of several reduced parts."""
    return stored.groupBy(*KEYS).agg(
        F.min("succeeded_at").alias("succeeded_at"), F.max("last_failure").alias("last_failure"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("tries")))).alias("tries"))


def crawl_states(states: DataFrame, first_pause: int = FIRST_PAUSE, longest_pause: int = LONGEST_PAUSE,
                 attempts: int = ATTEMPTS) -> DataFrame:
    """current_url, attempts, succeeded_at, last_failed_at, last_error and due_at of combined states: when a
    page that has not succeeded is to be fetched again, NULL when never."""
    tried = F.size("tries")
    # The exponent is bounded before it is raised: the pause is bounded anyway.
    pause = F.least(F.lit(float(longest_pause)), F.lit(float(first_pause)) * F.pow(F.lit(2.0), F.least(tried - 1, F.lit(40))))
    failed_at = F.col("last_failure.at")
    due = F.when(F.col("succeeded_at").isNull() & (tried < attempts),
                 F.timestamp_seconds(F.unix_seconds(failed_at) + pause.cast("bigint")))
    return states.select("current_url", tried.alias("attempts"), "succeeded_at", failed_at.alias("last_failed_at"),
                         F.col("last_failure.error").alias("last_error"), due.alias("due_at"))


def due_pages(dim_prd: DataFrame, states: DataFrame | None, now: Column | None = None) -> DataFrame:
    """Distinct (product_id, current_url) to fetch at `now`, ordered by product: pages never tried and
    failed ones that are due.  `states` are those of `crawl_states`."""
    todo = (dim_prd.where(filled(F.col("current_url"))).select("product_id", "current_url").distinct())
    if states is not None:
        now = F.current_timestamp() if now is None else now
        rest = states.where(F.col("due_at").isNull() | (F.col("due_at") > now))
        todo = todo.join(rest.select("current_url"), "current_url", "left_anti")
    return todo.select("product_id", "current_url").orderBy("product_id", "current_url")


def outcome_counts(states: DataFrame) -> DataFrame:
    """Pages and attempts by outcome: success, retry (due again) and gave_up."""
    outcome = (F.when(F.col("succeeded_at").isNotNull(), "success").when(F.col("due_at").isNotNull(), "retry")
               .otherwise("gave_up"))
    return states.groupBy(outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("attempts").cast("bigint").alias("attempts"))
