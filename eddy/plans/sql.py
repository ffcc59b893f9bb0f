"""The continuous-query texts of Q3, Q5, Q8 and Q11 as Spark SQL over temporary views
of the bindings. Catalyst plans them like the DataFrame forms (filters reach the scans).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources import bindings as B


def register_views(spark: SparkSession, sf_dir: str) -> None:
    B.bids(spark, sf_dir).createOrReplaceTempView("eddy_bid")
    B.auctions_q3(spark, sf_dir).createOrReplaceTempView("eddy_auction")
    B.persons_q3(spark, sf_dir, states=None).createOrReplaceTempView("eddy_person")
    B.persons_q8(spark, sf_dir).createOrReplaceTempView("eddy_person_q8")
    B.auctions_q8(spark, sf_dir).createOrReplaceTempView("eddy_auction_q8")


Q3 = """SELECT p.name, p.city, p.state, a.id AS auction_id
FROM eddy_auction a JOIN eddy_person p ON a.seller = p.id
WHERE p.state IN ('NATION_1', 'NATION_2', 'NATION_3')"""

# The Q5 text over any bid view: the batch view here, a watermarked streaming view in
# ``streaming.queries.sliding_count_sql_stream`` (streaming SQL, append mode).
Q5_OVER = """SELECT auction, window.start AS window_start, window.end AS window_end, count(*) AS num
FROM {bid} GROUP BY window(date_time, '60 minutes', '1 minute'), auction"""
# The same windows by panes: bids are counted per minute first, then each count is spread
# over the 60 windows that hold its minute.
Q5 = """SELECT auction, window_start, window_start + INTERVAL '60' MINUTE AS window_end, sum(c) AS num
FROM (SELECT auction, c, explode(sequence(pane - INTERVAL '59' MINUTE, pane, INTERVAL '1' MINUTE)) AS window_start
      FROM (SELECT auction, window(date_time, '1 minute').start AS pane, count(*) AS c
            FROM eddy_bid GROUP BY auction, window(date_time, '1 minute')))
GROUP BY auction, window_start"""

# Sessions by lag and a running sum over the bidder's bids; the inner windows share one
# exchange. A bidder too large for a task needs the DataFrame form, which splits it.
Q11 = """SELECT bidder, min(date_time) AS session_start, max(date_time) + INTERVAL '6' HOUR AS session_end,
       count(*) AS num, max_by(auction, struct(date_time, event_id)) AS last_auction
FROM (SELECT *, sum(fresh) OVER (PARTITION BY bidder ORDER BY date_time, event_id ROWS UNBOUNDED PRECEDING) AS session
      FROM (SELECT *, CASE WHEN date_time - lag(date_time) OVER (PARTITION BY bidder ORDER BY date_time, event_id)
                                <= INTERVAL '6' HOUR THEN 0 ELSE 1 END AS fresh FROM eddy_bid))
GROUP BY bidder, session"""

Q8 = """SELECT p.id, p.name, a.reserve, p.w.start AS window_start, p.w.end AS window_end
FROM (SELECT id, name, window(date_time, '1 hour') AS w FROM eddy_person_q8) p
JOIN (SELECT seller, reserve, window(date_time, '1 hour') AS w FROM eddy_auction_q8) a
  ON p.id = a.seller AND p.w = a.w"""


def run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    register_views(spark, sf_dir)
    return spark.sql(text)


def q3_join_sql(spark, d):
    return run(spark, d, Q3)


def q5_sliding_count_sql(spark, d):
    return run(spark, d, Q5)


def q8_window_join_sql(spark, d):
    return run(spark, d, Q8)


def q11_session_count_sql(spark, d):
    return run(spark, d, Q11)
