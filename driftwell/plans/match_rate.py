"""Cross-system identity match rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftwell.functions.numbers import percent
from driftwell.functions.time import day_bounds_ms, previous_day
from driftwell.operators.joins import anti_nullsafe

# The names of the result columns; the site whose ids are compared with the partners'.
OWN_SITE = 1
_COUNTS = ("matched", "unmatched", "own", "partner_b", "partner_t")


def actions_for_url(spark: SparkSession, actions: DataFrame, url: str) -> DataFrame:
    """Actions whose name holds the text; the text is a bound parameter, not part of the SQL."""
    return spark.sql(
        "SELECT idaction FROM {actions} WHERE instr(name, :url) > 0", args={"url": url}, actions=actions
    )


def _given(column: str) -> Column:
    """How many values are neither null nor empty."""
    return F.count(F.when(F.col(column).isNotNull() & (F.col(column) != ""), 1)).alias(column)


def match_rate(
    spark: SparkSession,
    matched: DataFrame,
    actions: DataFrame,
    visits: DataFrame,
    links: DataFrame,
    profiles: DataFrame,
    *,
    url: str,
    run_date: str,
) -> DataFrame:
    """One row of counts and rates for a url on the day before ``run_date``.

    ``matched`` has ``mvid, pwid, pwsid``; ``actions`` ``idaction, name``; ``visits`` ``idvisit,
    idvisitor, visit_last_action_time`` (epoch ms); ``links`` ``idvisit, idaction_url``;
    ``profiles`` ``mvid, tdid, bmid``.

    A visitor not in ``matched`` counts once for each of the visits found, null included.  The
    visits are counted per visitor before the anti join, so a busy visitor is one row there.  The
    counts meet as rows of one long frame that is summed up: nothing is collected and nothing is
    cross joined.  A rate with a zero denominator is null.
    """
    day = previous_day(run_date)
    first, past = day_bounds_ms(day)
    known = matched.select(F.col("pwid").alias("idvisitor")).distinct()
    # constants on the column itself, which reach the scan
    at = F.col("visit_last_action_time")
    on_day = visits.where((at >= first) & (at < past)).select("idvisit", "idvisitor")
    hits = links.where("idaction_url is not null").join(
        actions_for_url(spark, actions, url), F.col("idaction_url") == F.col("idaction")
    )
    visitors = hits.join(on_day, "idvisit").groupBy("idvisitor").agg(F.count("*").alias("visits"))
    unmatched = anti_nullsafe(visitors, known, ["idvisitor"])

    own = matched.where(F.col("pwsid") == OWN_SITE).select("mvid").distinct()
    # counted per id before the join: an id with many profiles is one row there
    partners = profiles.groupBy("mvid").agg(_given("bmid"), _given("tdid")).join(own, "mvid")

    parts = [
        known.agg(F.count("*").alias("matched")),
        unmatched.agg(F.sum("visits").alias("unmatched")),
        own.agg(F.count("*").alias("own")),
        partners.agg(F.sum("bmid").alias("partner_b"), F.sum("tdid").alias("partner_t")),
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionByName(part, allowMissingColumns=True)
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in _COUNTS])

    total_users = F.col("matched") + F.col("unmatched")
    return totals.select(
        F.lit(day).alias("Date"),
        F.lit(url).alias("url"),
        total_users.cast("double").alias("total_piwik_users"),
        F.col("matched").cast("double").alias("matched_piwik_users"),
        F.col("unmatched").cast("double").alias("unmatched_piwik_users"),
        percent(F.col("matched"), total_users).alias("piwik_match_rate"),
        percent(F.col("partner_b"), F.col("own")).alias("bombora_match_rate"),
        percent(F.col("partner_t"), F.col("own")).alias("td_match_rate"),
    )
