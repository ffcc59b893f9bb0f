"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark plans: plain window functions over whole tables.
"""

from __future__ import annotations

from ..operators.records import AVRO_STATE_OPERATOR, KRYO_STATE_OPERATOR

EV = """ev AS (
  SELECT user_id AS key, ts AS event_time, event_type AS payload, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence_number
  FROM events)"""

BID = """bid AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS auction, user_id AS bidder,
         value AS price, ts AS date_time, event_id
  FROM events)"""

PERSON = """person AS (
  SELECT c_custkey AS id, c_name AS name, r_name AS city, n_name AS state,
         TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST((c_custkey * 37) % 2400 AS INTEGER)) AS date_time
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE n_name IN ('NATION_1', 'NATION_2', 'NATION_3'))"""

AUCTION = """auction AS (
  SELECT o_orderkey AS id, o_custkey AS seller, o_totalprice AS reserve, o_orderdate AS date_time FROM orders)"""

MOVED = """p2 AS (
  SELECT id, name, city, state, date_time, 0 AS copy FROM person
  UNION ALL
  SELECT id, name, city || '_2', state, date_time + INTERVAL 400 DAY, 1 FROM person),
a2 AS (
  SELECT id, seller, date_time, 0 AS copy FROM auction
  UNION ALL
  SELECT id, seller, date_time, 1 FROM auction WHERE id % 10 = 0),
fp AS (
  SELECT id, name, city, state FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY date_time, copy) AS rn FROM p2) WHERE rn = 1)"""

EMIT_LAST = f"""WITH {PERSON}, {AUCTION}, {MOVED},
u AS (
  SELECT id AS k, date_time, 0 AS side, id AS rid, copy, name, city, state FROM p2
  UNION ALL
  SELECT seller, date_time, 1, id, copy, NULL, NULL, NULL FROM a2),
r AS (
  SELECT k, side, rid,
    last_value(name IGNORE NULLS) OVER w AS b_name,
    last_value(city IGNORE NULLS) OVER w AS b_city,
    last_value(state IGNORE NULLS) OVER w AS b_state
  FROM u
  WINDOW w AS (PARTITION BY k ORDER BY date_time, side, rid, copy ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT r.*, fp.name AS f_name, fp.city AS f_city, fp.state AS f_state
      FROM r JOIN fp ON r.k = fp.id WHERE r.side = 1)
SELECT b_name AS name, b_city AS city, b_state AS state, rid AS auction_id FROM m WHERE b_name IS NOT NULL
UNION ALL
SELECT {{waiting}} FROM m WHERE b_name IS NULL {{group}}"""

SLIDE_MEMBERS = f"""{EV},
m AS (
  SELECT e.key, e.sequence_number,
         time_bucket(INTERVAL 1 HOUR, e.event_time) - to_hours(CAST(i AS BIGINT)) AS window_start
  FROM ev e, range(0, 3) r(i))"""

GAPPED = """g AS (SELECT * FROM ev WHERE payload <> 'error' OR key % 2 = 0)"""

# C4 / C5 over a members relation m(key, window_start, sequence_number).
SIGHTINGS = """wins AS (
  SELECT key, window_start, wmax,
         row_number() OVER (PARTITION BY key ORDER BY window_start) AS wrank,
         max(wmax) OVER (PARTITION BY key ORDER BY window_start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mprev
  FROM (SELECT key, window_start, max(sequence_number) AS wmax FROM mm GROUP BY key, window_start)),
x AS (
  SELECT mm.key, mm.window_start, mm.sequence_number, wins.wrank, wins.mprev,
         row_number() OVER (PARTITION BY mm.key, mm.sequence_number ORDER BY wins.wrank) AS rn
  FROM mm JOIN wins ON mm.key = wins.key AND mm.window_start = wins.window_start),
y AS (
  SELECT *, min(wrank) OVER (PARTITION BY key, sequence_number) AS r1,
         first_value(mprev) OVER (PARTITION BY key, sequence_number ORDER BY wrank
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS m1
  FROM x),
z AS (
  SELECT *, sum(CASE WHEN wrank - rn = r1 - 1 THEN 1 ELSE 0 END) OVER (PARTITION BY key, sequence_number) AS run,
         (m1 IS NULL OR sequence_number > m1) AS tracked
  FROM y)"""

EXTRA = """mm AS (
  SELECT key, window_start, sequence_number FROM m
  UNION ALL
  SELECT m.key, b.last_start + INTERVAL 1 HOUR, m.sequence_number
  FROM m JOIN (SELECT key, min(window_start) AS first_start, max(window_start) AS last_start FROM m GROUP BY key) b
    ON m.key = b.key AND m.window_start = b.first_start)"""


WORD_TOKENS = r"""l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents),
t AS (
  SELECT doc_id, line_no, unnest(regexp_split_to_array(lower(line), '\W+')) AS word,
         generate_subscripts(regexp_split_to_array(lower(line), '\W+'), 1) - 1 AS pos
  FROM l)"""

WORD_COUNT = r"""SELECT w AS word, count(*) AS n
FROM (SELECT unnest(regexp_split_to_array(lower(text), '\W+')) AS w FROM documents)
WHERE length(w) > 0 GROUP BY w"""

SEQ_CHECK = f"""WITH {EV}, {GAPPED},
d AS (
  SELECT key, event_time, sequence_number, event_id, 0 AS copy FROM g
  UNION ALL
  SELECT key, event_time, sequence_number, event_id, 1 FROM g WHERE event_id % 50 = 0),
p AS (
  SELECT *, coalesce(lag(sequence_number) OVER (PARTITION BY key ORDER BY event_time, event_id, copy), 0) AS previous
  FROM d)
SELECT key, previous, sequence_number,
       'Alert: ' || previous || ' -> ' || sequence_number || ' (' || key || ')' AS alert
FROM p WHERE {{cond}}"""


ORACLE: dict[str, str] = {
    "q3_join": f"""WITH {PERSON}, {AUCTION}
SELECT p.name, p.city, p.state, a.id AS auction_id FROM auction a JOIN person p ON a.seller = p.id""",

    "q3_emit_once_first": f"""WITH {PERSON}, {AUCTION}, {MOVED}
SELECT fp.name, fp.city, fp.state, a2.id AS auction_id FROM a2 JOIN fp ON a2.seller = fp.id""",

    "q3_emit_once_last": EMIT_LAST.format(
        waiting="f_name AS name, f_city AS city, f_state AS state, rid AS auction_id", group=""),

    "q3_emit_once_last_set": EMIT_LAST.format(
        waiting="any_value(f_name) AS name, any_value(f_city) AS city, any_value(f_state) AS state, rid AS auction_id",
        group="GROUP BY k, rid"),

    "q5_panes": f"""WITH {BID},
w AS (SELECT auction, time_bucket(INTERVAL 1 MINUTE, date_time) - to_minutes(CAST(i AS BIGINT)) AS window_start
      FROM bid, range(0, 60) r(i))
SELECT auction, window_start, window_start + INTERVAL 60 MINUTE AS window_end, count(*) AS num
FROM w GROUP BY auction, window_start""",

    "q8_window_join": """WITH
p AS (SELECT user_id AS id, 'user-' || CAST(user_id AS VARCHAR) AS name, time_bucket(INTERVAL 1 HOUR, ts) AS ws
      FROM events WHERE event_type = 'signup'),
a AS (SELECT user_id AS seller, value AS reserve, time_bucket(INTERVAL 1 HOUR, ts) AS ws
      FROM events WHERE event_type = 'purchase')
SELECT p.id, p.name, a.reserve, p.ws AS window_start, p.ws + INTERVAL 1 HOUR AS window_end
FROM p JOIN a ON p.id = a.seller AND p.ws = a.ws""",

    "q11_session_count": f"""WITH {BID},
s AS (SELECT *, CASE WHEN lag(date_time) OVER w IS NULL OR date_time - lag(date_time) OVER w > INTERVAL 6 HOUR
                     THEN 1 ELSE 0 END AS st
      FROM bid WINDOW w AS (PARTITION BY bidder ORDER BY date_time, event_id)),
g AS (SELECT *, sum(st) OVER (PARTITION BY bidder ORDER BY date_time, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT bidder, min(date_time) AS session_start, max(date_time) + INTERVAL 6 HOUR AS session_end,
       count(*) AS num, arg_max(auction, CAST(epoch_us(date_time) AS HUGEINT) * 1000000 + event_id) AS last_auction
FROM g GROUP BY bidder, sid""",

    "q11_session_early": f"""WITH {BID},
s AS (SELECT *, CASE WHEN lag(date_time) OVER w IS NULL OR date_time - lag(date_time) OVER w > INTERVAL 6 HOUR
                     THEN 1 ELSE 0 END AS st
      FROM bid WINDOW w AS (PARTITION BY bidder ORDER BY date_time, event_id)),
g AS (SELECT *, sum(st) OVER (PARTITION BY bidder ORDER BY date_time, event_id ROWS UNBOUNDED PRECEDING) AS sid FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY bidder, sid ORDER BY date_time, event_id) AS rn,
             min(date_time) OVER (PARTITION BY bidder, sid) AS session_start FROM g)
SELECT bidder, session_start, date_time + INTERVAL 6 HOUR AS session_end, rn AS num, false AS is_final
FROM n WHERE rn % 3 = 0
UNION ALL
SELECT bidder, min(date_time), max(date_time) + INTERVAL 6 HOUR, count(*), true FROM g GROUP BY bidder, sid""",

    "word_count": WORD_COUNT,

    "word_count_running": f"""WITH {WORD_TOKENS}
SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, CAST(pos AS BIGINT) AS pos, word,
       row_number() OVER (PARTITION BY word ORDER BY doc_id, line_no, pos) AS n
FROM t WHERE length(word) > 0""",

    "tumbling_pass": f"""WITH {EV}
SELECT key, event_time, sequence_number, payload, event_id,
       time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
       time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end
FROM ev""",

    "tumbling_by_events": f"""WITH {EV}
SELECT key, time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
       time_bucket(INTERVAL 1 HOUR, event_time) + INTERVAL 1 HOUR AS window_end, count(*) AS num
FROM ev GROUP BY 1, 2, 3""",

    "sliding_collect": f"""WITH {EV},
m AS (SELECT e.*, time_bucket(INTERVAL 1 HOUR, e.event_time) - to_hours(CAST(i AS BIGINT)) AS window_start
      FROM ev e, range(0, 3) r(i))
SELECT key, window_start, window_start + INTERVAL 3 HOUR AS window_end, part, count(*) AS num,
       string_agg(CAST(sequence_number AS VARCHAR) || ':' || payload, ',' ORDER BY sequence_number) AS events
FROM (SELECT *, (row_number() OVER (PARTITION BY key, window_start ORDER BY sequence_number) - 1) // 2 AS part FROM m)
GROUP BY key, window_start, part""",

    "state_first": f"""WITH {EV} SELECT key, arg_min(payload, sequence_number) AS payload FROM ev GROUP BY key""",

    "state_last": f"""WITH {EV} SELECT key, arg_max(payload, sequence_number) AS payload FROM ev GROUP BY key""",

    "state_concat": f"""WITH {EV}
SELECT key, (sequence_number - 1) // 16 AS part, min(sequence_number) AS first_seq,
       max(sequence_number) AS last_seq, string_agg(payload, '' ORDER BY sequence_number DESC) AS state
FROM ev GROUP BY 1, 2""",

    "state_list": f"""WITH {EV}
SELECT key, (sequence_number - 1) // 16 AS part, min(sequence_number) AS first_seq,
       max(sequence_number) AS last_seq, string_agg(payload, ',' ORDER BY sequence_number) AS state
FROM ev GROUP BY 1, 2""",

    "state_map": f"""WITH {EV}
SELECT key, (sequence_number - 1) // 16 AS part, min(sequence_number) AS first_seq,
       max(sequence_number) AS last_seq,
       '{{' || string_agg('"' || sequence_number || '":"' || payload || '"', ',' ORDER BY sequence_number) || '}}' AS state
FROM ev GROUP BY 1, 2""",

    "state_map_merge": """SELECT key, map_key, map_value FROM (
  SELECT user_id AS key, event_type AS map_key, value AS map_value,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""",

    "state_nested_latest": f"""WITH {EV}
SELECT key, event_time, CAST(key AS VARCHAR) || ',' || payload AS string_list,
       '{KRYO_STATE_OPERATOR}' AS str_payload, sequence_number AS inner_sequence_number
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY sequence_number DESC) AS rn FROM ev) WHERE rn = 1""",

    "check_exactly_once": SEQ_CHECK.format(cond="sequence_number - previous <> 1"),

    "check_at_least_once": SEQ_CHECK.format(cond="sequence_number - previous > 1"),

    "check_window_contiguity": f"""WITH {EV}, {GAPPED},
m AS (SELECT e.key, e.sequence_number,
             time_bucket(INTERVAL 1 HOUR, e.event_time) - to_hours(CAST(i AS BIGINT)) AS window_start
      FROM g e, range(0, 3) r(i)),
p AS (SELECT key, window_start, sequence_number,
             lag(sequence_number) OVER (PARTITION BY key, window_start ORDER BY sequence_number) AS previous FROM m)
SELECT key, window_start, previous, sequence_number FROM p
WHERE previous IS NOT NULL AND sequence_number - previous <> 1""",

    "check_missed_window": f"""WITH {SLIDE_MEMBERS},
mm AS (
  SELECT m.* FROM m JOIN (
    SELECT key, window_start, row_number() OVER (PARTITION BY key ORDER BY window_start) AS rk
    FROM (SELECT DISTINCT key, window_start FROM m)) k
  ON m.key = k.key AND m.window_start = k.window_start WHERE k.rk <> 5),
{SIGHTINGS}
SELECT z.key, z.sequence_number, CAST(z.run AS BIGINT) AS seen, wins.window_start AS missed_window
FROM z JOIN wins ON z.key = wins.key AND wins.wrank = z.r1 + z.run
WHERE z.rn = 1 AND z.tracked AND z.run < 3""",

    "check_seen_too_often": f"""WITH {SLIDE_MEMBERS}, {EXTRA},
{SIGHTINGS}
SELECT key, sequence_number, window_start FROM z WHERE NOT tracked OR rn > least(run, 3)""",

    "check_sequence_back": f"""WITH {SLIDE_MEMBERS}, {EXTRA},
w AS (SELECT key, window_start, wmax,
             max(wmax) OVER (PARTITION BY key ORDER BY window_start
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mprev
      FROM (SELECT key, window_start, max(sequence_number) AS wmax FROM mm GROUP BY key, window_start))
SELECT key, window_start, wmax AS last_sequence, mprev AS seen_so_far FROM w WHERE wmax < mprev""",

    "check_state_tag": f"""WITH {EV},
s AS (SELECT key, sequence_number,
             CASE WHEN sequence_number % 7 = 0 THEN '{AVRO_STATE_OPERATOR}' ELSE '{KRYO_STATE_OPERATOR}' END AS tag
      FROM ev),
p AS (SELECT *, lag(tag) OVER (PARTITION BY key ORDER BY sequence_number) AS ptag,
             lag(sequence_number) OVER (PARTITION BY key ORDER BY sequence_number) AS pseq FROM s)
SELECT key, sequence_number, '{KRYO_STATE_OPERATOR}' AS expected_tag, ptag AS actual_tag
FROM p WHERE ptag IS NOT NULL AND ptag <> '{KRYO_STATE_OPERATOR}' AND pseq = sequence_number - 1""",

    "reconcile": f"""WITH wc AS ({WORD_COUNT}),
ch AS (
  SELECT word, CASE WHEN length(word) % 10 = 2 THEN n + 1 ELSE n END AS n FROM wc WHERE length(word) % 10 <> 1
  UNION ALL
  SELECT word || '#', n FROM wc WHERE length(word) % 10 = 3),
j AS (SELECT coalesce(wc.word, ch.word) AS word, wc.n AS expected, ch.n AS actual, wc.e, ch.a
      FROM (SELECT *, true AS e FROM wc) wc FULL OUTER JOIN (SELECT *, true AS a FROM ch) ch ON wc.word = ch.word)
SELECT word, expected, actual,
       CASE WHEN a IS NULL THEN 'missing' WHEN e IS NULL THEN 'unexpected' ELSE 'wrong_value' END AS status
FROM j WHERE expected IS DISTINCT FROM actual OR e IS NULL OR a IS NULL""",

    "late_rows": """WITH d AS (SELECT event_id, ts, event_id + (event_id * 104729) % 20 AS arrival FROM events),
w AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark
      FROM d)
SELECT event_id, ts, arrival, watermark FROM w WHERE ts < watermark""",

    "json_decode": """SELECT o_orderkey AS msg_key, o_orderkey AS id, o_custkey AS seller FROM orders""",

    "upsert_latest": """SELECT seller, id, reserve FROM (
  SELECT o_custkey AS seller, o_orderkey AS id, o_totalprice AS reserve,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders) WHERE rn = 1""",

    "state_first_changes": """SELECT user_id AS key, ts AS event_time, event_type AS payload, event_id,
       first_value(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS state FROM events""",

    "state_last_changes": """SELECT user_id AS key, ts AS event_time, event_type AS payload, event_id,
       lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before, event_type AS state FROM events""",

    "state_nested_changes": f"""WITH {EV}
SELECT key, event_time, sequence_number, payload, event_id,
       CASE WHEN sequence_number > 1 THEN '{KRYO_STATE_OPERATOR}' END AS before_tag,
       CASE WHEN sequence_number > 1 THEN sequence_number - 1 END AS before_sequence
FROM ev""",

    "state_append_log": f"""WITH {EV}
SELECT key, event_time, payload, event_id, sequence_number AS position FROM ev""",

    "running_sum": """WITH e AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
SELECT user_id AS key, ts AS event_time, event_id, cents,
       CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM e""",

    "top_list": """SELECT event_type, place, value, event_id FROM (
  SELECT event_type, value, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS place
  FROM events WHERE value IS NOT NULL) WHERE place <= 5""",
}
ORACLE["q3_join_sql"] = ORACLE["q3_join"]
ORACLE["q5_sliding_count_sql"] = ORACLE["q5_panes"]
ORACLE["q11_session_count_sql"] = ORACLE["q11_session_count"]
ORACLE["q8_window_join_sql"] = ORACLE["q8_window_join"]

# Connected components as plain reachability: every vertex reaches itself, reach spreads
# along edges (UNION removes repeats, so the recursion ends), component = least reacher.
ORACLE["connected_components"] = """WITH RECURSIVE g AS (
  SELECT DISTINCT o_custkey * 2 AS x, o_orderkey * 2 + 1 AS y FROM orders),
u AS (SELECT x, y FROM g UNION SELECT y, x FROM g),
r(v, l) AS (SELECT DISTINCT x, x FROM u UNION SELECT u.y, r.l FROM r JOIN u ON r.v = u.x)
SELECT v AS vertex, min(l) AS component FROM r GROUP BY v"""

# TPC-H: written by hand on the raw tables, in other forms than the Spark texts (filters as
# CASE or FILTER, semi joins as IN or grouped flags, subqueries as window functions).
_NET = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_QTY = "CAST(l_quantity AS DECIMAL(12,2))"
ORACLE |= {
    "tpch_q1": f"""WITH l AS (
  SELECT l_returnflag, l_linestatus, {_QTY} AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p, {_NET} AS d,
         {_NET} * (1 + CAST(l_tax AS DECIMAL(4,2))) AS c, CAST(l_discount AS DECIMAL(4,2)) AS r
  FROM lineitem WHERE date_trunc('day', l_shipdate) < TIMESTAMP '2001-08-07')
SELECT l_returnflag, l_linestatus, sum(q)::DOUBLE AS sum_qty, sum(p)::DOUBLE AS sum_base_price, sum(d)::DOUBLE AS sum_disc_price,
       sum(c)::DOUBLE AS sum_charge, sum(q)::DOUBLE / count(q) AS avg_qty, sum(p)::DOUBLE / count(p) AS avg_price,
       sum(r)::DOUBLE / count(r) AS avg_disc, count(*) AS count_order
FROM l GROUP BY ALL""",

    "tpch_q3": f"""WITH c AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
o AS (SELECT o_orderkey, o_orderdate::DATE AS o_orderdate, o_orderpriority FROM orders
      WHERE o_custkey IN (FROM c) AND o_orderdate < TIMESTAMP '1998-03-15'),
l AS (SELECT l_orderkey, sum({_NET}) AS r FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-16' GROUP BY l_orderkey),
k AS (SELECT l_orderkey, r::DOUBLE AS revenue, o_orderdate, o_orderpriority,
             row_number() OVER (ORDER BY r::DOUBLE DESC, o_orderdate, l_orderkey) AS n FROM l JOIN o ON o_orderkey = l_orderkey)
SELECT l_orderkey, revenue, o_orderdate, o_orderpriority FROM k WHERE n <= 10""",

    "tpch_q5": f"""WITH n AS (SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')),
x AS (SELECT o_orderkey, c_nationkey FROM orders, customer WHERE o_custkey = c_custkey AND year(o_orderdate) = 1998)
SELECT n_name, sum({_NET})::DOUBLE AS revenue
FROM lineitem, x, supplier, n
WHERE l_orderkey = o_orderkey AND l_suppkey = s_suppkey AND s_nationkey = n_nationkey AND c_nationkey = n_nationkey
GROUP BY n_name""",

    "tpch_q6": """SELECT (sum(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)))
        FILTER (WHERE year(l_shipdate) = 1998 AND round(l_discount * 100) IN (5, 6, 7) AND l_quantity < 24))::DOUBLE AS revenue
FROM lineitem""",

    "tpch_q10": f"""WITH r AS (SELECT o_custkey, sum({_NET}) AS v FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_returnflag = 'R' AND year(o_orderdate) = 1998 AND quarter(o_orderdate) = 4 GROUP BY o_custkey),
k AS (SELECT *, row_number() OVER (ORDER BY v::DOUBLE DESC, o_custkey) AS n FROM r)
SELECT c_custkey, c_name, v::DOUBLE AS revenue, CAST(c_acctbal AS DECIMAL(12,2))::DOUBLE AS c_acctbal,
       (SELECT n_name FROM nation WHERE n_nationkey = c_nationkey) AS n_name
FROM k JOIN customer ON c_custkey = o_custkey WHERE n <= 20""",

    "tpch_q14": f"""SELECT 100 * coalesce(sum({_NET}) FILTER (WHERE starts_with(p_type, 'PROMO')), 0)::DOUBLE / sum({_NET})::DOUBLE AS promo_revenue
FROM part, lineitem WHERE p_partkey = l_partkey AND year(l_shipdate) = 1998 AND month(l_shipdate) = 9""",

    "tpch_q4": """WITH late AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
SELECT o_orderpriority, count(*) AS order_count FROM orders JOIN late ON l_orderkey = o_orderkey
WHERE year(o_orderdate) = 1998 AND quarter(o_orderdate) = 3 GROUP BY o_orderpriority""",

    "tpch_q13": """WITH n AS (SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderpriority <> '1-URGENT') AS c_count
  FROM customer)
SELECT c_count, count(*) AS custdist FROM n GROUP BY c_count""",

    "tpch_q17": f"""WITH l AS (SELECT l_partkey, {_QTY} AS q, CAST(l_extendedprice AS DECIMAL(12,2)) AS p,
         sum({_QTY}) OVER (PARTITION BY l_partkey) AS total, count(*) OVER (PARTITION BY l_partkey) AS n FROM lineitem)
SELECT sum(p)::DOUBLE / 7 AS avg_yearly, count(*) AS lines FROM l
WHERE 5 * q * n < total AND l_partkey IN (SELECT p_partkey FROM part WHERE p_brand = 'Brand#17')""",

    "tpch_q18": f"""WITH big AS (SELECT l_orderkey, sum({_QTY}) AS q FROM lineitem GROUP BY l_orderkey HAVING sum({_QTY}) > 250),
k AS (SELECT *, row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(12,2)) DESC, o_orderdate::DATE, o_orderkey) AS n
      FROM big JOIN orders ON o_orderkey = l_orderkey)
SELECT c_name, c_custkey, o_orderkey, o_orderdate::DATE AS o_orderdate, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS o_totalprice,
       q::DOUBLE AS sum_qty FROM k JOIN customer ON c_custkey = o_custkey WHERE n <= 100""",

    "tpch_q21": """WITH f AS (SELECT l_orderkey, count(DISTINCT l_suppkey) AS all_, count(DISTINCT l_suppkey) FILTER (WHERE l_returnflag = 'R') AS late
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY l_orderkey),
w AS (SELECT l_suppkey, count(*) AS numwait FROM lineitem JOIN f USING (l_orderkey)
      WHERE l_returnflag = 'R' AND all_ > 1 AND late = 1 GROUP BY l_suppkey),
k AS (SELECT s_name, sum(numwait) AS numwait FROM w JOIN supplier ON s_suppkey = l_suppkey
      WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_9') GROUP BY s_name)
SELECT s_name, CAST(numwait AS BIGINT) AS numwait FROM k ORDER BY numwait DESC, s_name LIMIT 100""",
}

# Components of customers and suppliers linked by order lines, by the same reachability.
ORACLE["trade_components"] = ORACLE["connected_components"].replace(
    "SELECT DISTINCT o_custkey * 2 AS x, o_orderkey * 2 + 1 AS y FROM orders",
    "SELECT DISTINCT o_custkey * 2 AS x, l_suppkey * 2 + 1 AS y FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
