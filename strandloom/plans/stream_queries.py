"""The streaming operators over the finite event table, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandloom.sources.tables import table
from strandloom.streaming import sessions as S


def st_sessions(spark, folder):
    """Sessions of every user."""
    return S.sessions(table(spark, folder, "events")).select("user_id", "n", F.unix_micros("first").alias("first_us"), F.unix_micros("last").alias("last_us"))


def st_tiles(spark, folder):
    """Events by type and hour."""
    return S.tiles(table(spark, folder, "events")).select("event_type", F.unix_micros("start").alias("start_us"), "n")


QUERIES = {f.__name__: f for f in (st_sessions, st_tiles)}
ORACLES = {
    "st_sessions": """WITH x AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events WHERE ts IS NOT NULL),
      y AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM x) SELECT user_id, count(*) AS n, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us FROM y GROUP BY user_id, g""",
    "st_tiles": "SELECT event_type, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2",
}
