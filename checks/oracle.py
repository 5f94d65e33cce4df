"""The registered queries once more, as SQL over the `events` view.

Written independently of the library: self-joins, recursive queries and numeric
integration where the library uses grouping sets, Python recursions and closed
forms.
"""

import re

from checks.parameters import (ALERT_AS_OF, AS_OF, DIGITS, END, FEW_BUCKETS, REPAIRED,
                               REPLICATES, SEED, START)
from checks.parameters import USER as USER_ID

TODAY, DAY, FIRST = "DATE '2024-01-30'", "DATE '2024-01-29'", "DATE '2024-01-22'"

# ---------------------------------------------------------------- event tables

USER = """user_id, ts AS time, user_id % 2 AS gender, 14 + (user_id * 7) % 50 AS age,
    CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os,
    CASE WHEN user_id % 10 < 4 THEN 'organic' ELSE 'ads' END AS source,
    CASE user_id % 5 WHEN 0 THEN 'Russia' WHEN 1 THEN 'Ukraine' WHEN 2 THEN 'Belarus'
         WHEN 3 THEN 'Kazakhstan' ELSE 'Turkey' END AS country,
    user_id % 4 AS exp_group"""

TABLES = f"""
feed AS (
  SELECT {USER}, CASE WHEN event_type = 'click' THEN 'like' ELSE 'view' END AS action
  FROM events WHERE event_type IN ('view', 'error', 'click')),
messages AS (
  SELECT {USER}, CAST(json_extract_string(props, '$.k') AS BIGINT) AS reciever_id
  FROM events WHERE event_type IN ('purchase', 'signup'))"""

LIKES = "count(*) FILTER (WHERE action = 'like')"
VIEWS = "count(*) FILTER (WHERE action = 'view')"


def query(select, *parts):
    return f"WITH RECURSIVE {', '.join([TABLES.strip(), *(p.strip() for p in parts)])}\n{select}"


def r(expression):
    """Rounded as the checks round; adding 0 turns -0.0 into 0.0."""
    return f"round({expression}, {DIGITS}) + 0.0"


def rounded(*names):
    return ", ".join(f"{r(n)} AS {n}" for n in names)


# ----------------------------------------------------------------- feed report

DAILY = f"""
daily AS (
  SELECT CAST(time AS DATE) AS Date, count(DISTINCT user_id) AS Feed_DAU,
         {LIKES} AS Likes, {VIEWS} AS Views, {LIKES} / nullif({VIEWS}, 0) AS CTR
  FROM feed GROUP BY 1 HAVING CAST(time AS DATE) BETWEEN {FIRST} AND {DAY})"""
DAILY_COLUMNS = "Date, Feed_DAU, Likes, Views, " + rounded("CTR")

# ------------------------------------------------------------------ daily cube


def cube_parts(where="true"):
    return f"""
feed_stats AS (
  SELECT user_id, os, CAST(gender AS VARCHAR) AS gender, CAST(age AS VARCHAR) AS age,
         {LIKES} AS likes, {VIEWS} AS views
  FROM feed WHERE {where} GROUP BY ALL),
received AS (
  SELECT m.reciever_id AS user_id, count(m.reciever_id) AS messages_received,
         count(DISTINCT m.user_id) AS users_received
  FROM messages m WHERE {where} GROUP BY m.reciever_id),
sent AS (
  SELECT user_id, os, CAST(gender AS VARCHAR) AS gender, CAST(age AS VARCHAR) AS age,
         count(user_id) AS messages_sent, count(DISTINCT reciever_id) AS users_sent
  FROM messages WHERE {where} GROUP BY ALL),
message_stats AS (
  SELECT user_id, os, gender, age, coalesce(messages_received, 0) AS messages_received,
         coalesce(users_received, 0) AS users_received,
         coalesce(messages_sent, 0) AS messages_sent, coalesce(users_sent, 0) AS users_sent
  FROM received FULL JOIN sent USING (user_id)),
activity AS (
  SELECT user_id, os, gender, age, views, likes, messages_received, messages_sent,
         users_received, users_sent
  FROM feed_stats JOIN message_stats USING (user_id, os, gender, age))"""


def cube(where="true"):
    sums = ", ".join(
        f"CAST(sum({m}) AS BIGINT) AS {m}"
        for m in ("views", "likes", "messages_received", "messages_sent",
                  "users_received", "users_sent"))
    return query(" UNION ALL ".join(
        f"SELECT {DAY} AS event_date, '{d}' AS dimension, {d} AS dimension_value, {sums} "
        f"FROM activity GROUP BY {d}" for d in ("os", "gender", "age")), cube_parts(where))


# -------------------------------------------------------------- audience report

FEED_DAY = f"SELECT user_id FROM feed WHERE CAST(time AS DATE) = {DAY}"
MESSAGE_DAY = f"SELECT user_id FROM messages WHERE CAST(time AS DATE) = {DAY}"


def set_size(left, operation, right, name):
    return (f"SELECT {DAY} AS date, count(*) AS {name} FROM ({left} {operation} {right}) "
            "HAVING count(*) > 0")


FEED_ONLY = set_size(FEED_DAY, "EXCEPT", MESSAGE_DAY, "purely_feed_users")
MESSENGER_ONLY = set_size(MESSAGE_DAY, "EXCEPT", FEED_DAY, "purely_messenger_users")
BOTH = set_size(FEED_DAY, "INTERSECT", MESSAGE_DAY, "both_func_users")
OVERLAP = f"""
overlap AS (
  SELECT {DAY} AS date, count(f) FILTER (WHERE m IS NULL) AS purely_feed_users,
         count(m) FILTER (WHERE f IS NULL) AS purely_messenger_users,
         count(*) FILTER (WHERE f = m) AS both_func_users, count(*) AS all_unique_users
  FROM (SELECT DISTINCT user_id AS f FROM ({FEED_DAY}))
    FULL JOIN (SELECT DISTINCT user_id AS m FROM ({MESSAGE_DAY})) ON f = m),
shares AS (
  SELECT date, purely_feed_users / all_unique_users * 100 AS purely_feed_users,
         purely_messenger_users / all_unique_users * 100 AS purely_messenger_users,
         both_func_users / all_unique_users * 100 AS both_func_users
  FROM overlap)"""

SEGMENT_KEYS = """CAST(time AS DATE) AS date,
    CASE WHEN age < 18 THEN '<18' WHEN age <= 30 THEN '18-30' WHEN age <= 45 THEN '30-45'
         ELSE '45+' END AS age_groups,
    country, os, source"""


def segments(join="JOIN"):
    def count(c):
        return f"coalesce({c}, 0) AS {c}"
    return f"""
message_segments AS (
  SELECT {SEGMENT_KEYS}, count(reciever_id) AS messages,
         count(reciever_id) / count(DISTINCT user_id) AS messages_per_user,
         count(DISTINCT user_id) AS messenger_users
  FROM messages GROUP BY ALL),
feed_segments AS (
  SELECT {SEGMENT_KEYS}, {LIKES} AS likes, {VIEWS} AS views,
         {LIKES} / count(DISTINCT user_id) AS likes_per_user,
         {VIEWS} / count(DISTINCT user_id) AS views_per_user,
         count(DISTINCT user_id) AS feed_users
  FROM feed GROUP BY ALL),
segments AS (
  SELECT date, age_groups, country, os, source, {count("messages")}, messages_per_user,
         {count("messenger_users")}, {count("likes")}, {count("views")}, likes_per_user,
         views_per_user, {count("feed_users")}
  FROM message_segments {join} feed_segments USING (date, age_groups, country, os, source)
  WHERE date BETWEEN {FIRST} AND {DAY}),
totals AS (
  SELECT date, CAST(sum(messages) AS BIGINT) AS messages, CAST(sum(likes) AS BIGINT) AS likes,
         CAST(sum(views) AS BIGINT) AS views
  FROM segments GROUP BY date)"""


SEGMENT_COLUMNS = ("date, age_groups, country, os, source, messages, messenger_users, likes, "
                   "views, feed_users, "
                   + rounded("messages_per_user", "likes_per_user", "views_per_user"))


def _cells(column, *values):
    sums = ", ".join(
        f"CAST(coalesce(sum(users) FILTER (WHERE {column} = '{v}'), 0) AS BIGINT) AS {v}"
        for v in values)
    return f"""SELECT date, {sums},
      CAST(sum(users) - coalesce(sum(users) FILTER (WHERE {column} IN {values}), 0) AS BIGINT)
        AS other, CAST(sum(users) AS BIGINT) AS total
    FROM source_os GROUP BY date"""


SOURCE_OS = f"""
source_os AS (
  SELECT CAST(time AS DATE) AS date, os, source, count(DISTINCT user_id) AS users
  FROM feed WHERE CAST(time AS DATE) = {DAY} GROUP BY ALL),
by_source AS ({_cells("source", "ads", "organic")}),
by_os AS ({_cells("os", "Android", "iOS")})"""


def shown(expression):
    """Two decimals, half to even, without trailing zeros."""
    return f"CAST(CAST(round_even({expression}, 2) AS DOUBLE) AS VARCHAR)"


SUMMARY = f"""
SELECT o.date,
  'Date: ' || CAST(o.date AS VARCHAR) || chr(10) || chr(10)
  || 'Unique users: ' || all_unique_users || chr(10)
  || '    Feed-only: ' || o.purely_feed_users || ' / ' || {shown("s.purely_feed_users")} || '%' || chr(10)
  || '    Messenger-only: ' || o.purely_messenger_users || ' / ' || {shown("s.purely_messenger_users")} || '%' || chr(10)
  || '    Both functions: ' || o.both_func_users || ' / ' || {shown("s.both_func_users")} || '%' || chr(10)
  || 'Messages: ' || messages || chr(10) || 'Likes: ' || likes || chr(10)
  || 'Views: ' || views || chr(10) || 'CTR: ' || {shown("likes / views")} || chr(10) || chr(10)
  || 'Sources:' || chr(10)
  || '    Organic: ' || {shown("organic / by_source.total * 100")} || '%' || chr(10)
  || '    Ads: ' || {shown("ads / by_source.total * 100")} || '%' || chr(10) || chr(10)
  || 'OS:' || chr(10)
  || '    iOS: ' || {shown("iOS / by_os.total * 100")} || '%' || chr(10)
  || '    Android: ' || {shown("Android / by_os.total * 100")} || '%' AS message
FROM overlap o JOIN shares s USING (date) JOIN totals USING (date)
  JOIN by_source USING (date) JOIN by_os USING (date)"""

# --------------------------------------------------------------- anomaly check


def interval_rows(where):
    return f"""
feed_intervals AS (
  SELECT time_bucket(INTERVAL 15 MINUTES, time) AS time, count(DISTINCT user_id) AS feed_users,
         {LIKES} AS likes, {VIEWS} AS views, {LIKES} / nullif({VIEWS}, 0) * 100 AS ctr
  FROM feed WHERE {where} GROUP BY 1),
message_intervals AS (
  SELECT time_bucket(INTERVAL 15 MINUTES, time) AS time,
         count(DISTINCT user_id) AS messenger_users, count(user_id) AS messages_sent
  FROM messages WHERE {where} GROUP BY 1),
metrics AS (
  SELECT CAST(time AS DATE) AS date, time, strftime(time, '%H:%M') AS interval, feed_users,
         likes, views, ctr, messenger_users, messages_sent
  FROM feed_intervals JOIN message_intervals USING (time))"""


# A day's midnight must not lie before the same moment of the previous day.
def live(as_of):
    return interval_rows(
        f"CAST(CAST(time AS DATE) AS TIMESTAMP) BETWEEN TIMESTAMP '{as_of}' - INTERVAL 1 DAY "
        f"AND TIMESTAMP '{as_of}' "
        f"AND time < time_bucket(INTERVAL 15 MINUTES, TIMESTAMP '{as_of}')")


LIVE = live(AS_OF)
METRIC_COLUMNS = ("date, time, interval, feed_users, likes, views, messenger_users, "
                  "messages_sent, " + rounded("ctr"))


def _points(source, *names):
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, date, time, interval, CAST({n} AS DOUBLE) AS value FROM {source}"
        for n in names)


def single(source="metrics"):
    return f"""
points_single AS (
  SELECT *, row_number() OVER (PARTITION BY metric, date ORDER BY time) AS i
  FROM ({_points(source, "messenger_users", "messages_sent")})),
single AS (
  SELECT metric, date, i, value AS smooth FROM points_single WHERE i = 1
  UNION ALL
  SELECT p.metric, p.date, p.i, 0.85::DOUBLE * p.value + (1 - 0.85::DOUBLE) * s.smooth
  FROM single s JOIN points_single p
    ON p.metric = s.metric AND p.date = s.date AND p.i = s.i + 1),
smooth_single AS (
  SELECT metric, date, time, interval, value, smooth
  FROM points_single JOIN single USING (metric, date, i))"""


def holt(source="metrics"):
    return f"""
points_holt AS (
  SELECT *, row_number() OVER (PARTITION BY metric, date ORDER BY time) AS i,
         lead(value) OVER (PARTITION BY metric, date ORDER BY time) AS following
  FROM ({_points(source, "views", "feed_users", "likes", "ctr")})),
holt AS (
  SELECT metric, date, i, value AS level, following - value AS trend, value AS smooth
  FROM points_holt WHERE i = 1
  UNION ALL
  SELECT metric, date, i, level, level - before, level + (level - before)
  FROM (SELECT p.metric, p.date, p.i, h.level AS before,
               0.35::DOUBLE * p.value + (1 - 0.35::DOUBLE) * (h.level + h.trend) AS level
        FROM holt h JOIN points_holt p
          ON p.metric = h.metric AND p.date = h.date AND p.i = h.i + 1)),
smooth_holt AS (
  SELECT metric, date, time, interval, value, smooth
  FROM points_holt JOIN holt USING (metric, date, i))"""


SINGLE, HOLT = single(), holt()


def band(source, frame):
    """Band limits and flag; a frame that is not full gives NULL."""
    return f"""
quartiles AS (
  SELECT *,
    CASE WHEN count(smooth) OVER recent = 6
         THEN quantile_cont(smooth, 0.75) OVER recent END AS smooth_75,
    CASE WHEN count(smooth) OVER recent = 6
         THEN quantile_cont(smooth, 0.25) OVER recent END AS smooth_25
  FROM ({source})
  WINDOW recent AS (PARTITION BY metric, date ORDER BY time ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
limits AS (
  SELECT *, smooth_75 - smooth_25 AS iqr,
         (value - smooth) / nullif(smooth, 0) * 100 AS deviation,
         smooth_75 + 2 * (smooth_75 - smooth_25) AS raw_upper,
         smooth_25 - 2 * (smooth_75 - smooth_25) AS raw_lower
  FROM quartiles),
banded AS (
  SELECT metric, date, time, interval, value, smooth, smooth_75, smooth_25, iqr, deviation,
    CASE WHEN count(raw_upper) OVER frame = 10 THEN avg(raw_upper) OVER frame END AS smooth_upper,
    CASE WHEN count(raw_lower) OVER frame = 10 THEN avg(raw_lower) OVER frame END AS smooth_lower
  FROM limits
  WINDOW frame AS (PARTITION BY metric, date ORDER BY time ROWS BETWEEN {frame})),
flagged AS (
  SELECT *, value > smooth_upper OR value < smooth_lower AS is_alert FROM banded)"""


TRAILING, CENTERED = "9 PRECEDING AND CURRENT ROW", "5 PRECEDING AND 4 FOLLOWING"
SMOOTHED = "SELECT * FROM smooth_single UNION ALL SELECT * FROM smooth_holt"
SMOOTH_COLUMNS = "metric, date, time, interval, " + rounded("value", "smooth")
BAND_COLUMNS = SMOOTH_COLUMNS + ", CAST(is_alert AS VARCHAR) AS is_alert, " + rounded(
    "smooth_75", "smooth_25", "iqr", "deviation", "smooth_upper", "smooth_lower")
ALERT_COLUMNS = BAND_COLUMNS + """,
  metric || ' = ' || CASE WHEN value = floor(value)
      THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
      ELSE coalesce(CAST(value AS VARCHAR), 'nan') END
  || ', Отклонение = '
  || coalesce(CAST(CAST(round_even(deviation, 2) AS DOUBLE) AS VARCHAR), 'nan') || ' %'
  AS message"""

# ----------------------------------------------------------------- experiments

USERS = f"""
ab AS (
  SELECT user_id, exp_group, {LIKES} AS likes, {VIEWS} AS views,
         {LIKES} / nullif({VIEWS}, 0) AS ctr
  FROM feed
  WHERE time >= TIMESTAMP '{START}' AND time <= TIMESTAMP '{END}'
  GROUP BY user_id, exp_group),
ab_totals AS (
  SELECT exp_group, CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
         sum(likes) / nullif(sum(views), 0) AS global_ctr
  FROM ab GROUP BY exp_group),
smoothed AS (
  SELECT ab.*, global_ctr, (ab.likes + 5 * global_ctr) / (5 + ab.views) AS smoothed_ctr
  FROM ab JOIN ab_totals USING (exp_group) WHERE exp_group IN (1, 2))"""


def bucket_rows(n, name="buckets"):
    return f"""
{name} AS (
  SELECT exp_group, ((((w1 % {n} * 4294967296 + w2) % {n}) * 4294967296 + w3) % {n}
                     * 4294967296 + w4) % {n} AS buckets,
         CAST(sum(likes) AS BIGINT) AS likes, CAST(sum(views) AS BIGINT) AS views,
         sum(likes) / nullif(sum(views), 0) AS bucket_ctr
  FROM (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS w1,
               CAST('0x' || substr(h, 9, 8) AS BIGINT) AS w2,
               CAST('0x' || substr(h, 17, 8) AS BIGINT) AS w3,
               CAST('0x' || substr(h, 25, 8) AS BIGINT) AS w4
        FROM (SELECT *, md5(CAST(user_id AS VARCHAR) || '-bucket') AS h FROM ab))
  WHERE exp_group IN (1, 2) GROUP BY ALL)"""


USERS = f"{USERS},{bucket_rows(50)},{bucket_rows(FEW_BUCKETS, 'few_buckets')}"


def linearized(control, *groups):
    return f"""
linearized AS (
  SELECT *, likes - (SELECT global_ctr FROM ab_totals WHERE exp_group = {control}) * views
         AS lin_likes
  FROM ab WHERE exp_group IN {(control, *groups)})"""


def sample(source, value, pair):
    """Values labelled by side; the tests below read this."""
    return (f"sample AS (SELECT CASE exp_group WHEN {pair[0]} THEN 'a' ELSE 'b' END AS side, "
            f"{value} AS x FROM {source} WHERE exp_group IN {pair})")


# Two-sided tail of Student's t: one minus twice the integral from 0 to |t|.
WELCH = """
moments AS (
  SELECT count(x) FILTER (WHERE side = 'a') AS n_a, count(x) FILTER (WHERE side = 'b') AS n_b,
         count(*) - count(x) AS n_dropped,
         avg(x) FILTER (WHERE side = 'a') AS mean_a, avg(x) FILTER (WHERE side = 'b') AS mean_b,
         var_samp(x) FILTER (WHERE side = 'a') AS var_a,
         var_samp(x) FILTER (WHERE side = 'b') AS var_b
  FROM sample),
welch AS (
  SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS statistic,
         (var_a / n_a + var_b / n_b) ** 2
         / ((var_a / n_a) ** 2 / (n_a - 1) + (var_b / n_b) ** 2 / (n_b - 1)) AS df
  FROM moments),
welch_p AS (
  SELECT welch.*, 1 - 2 * (
      SELECT sum(exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
                 * (1 + (abs(statistic) * (k + 0.5) / 20000) ** 2 / df) ** (-(df + 1) / 2))
             * abs(statistic) / 20000
      FROM range(20000) steps(k)) AS p_value
  FROM welch)"""
WELCH_COLUMNS = "n_a, n_b, n_dropped, " + rounded(
    "mean_a", "mean_b", "var_a", "var_b", "statistic", "df", "p_value")

# Midranks; the tail of the normal distribution by integration from 0 to |z|. With at most
# 8 values on a side and no ties, the distribution is exact: `ways` counts, rank by rank,
# how many choices of k ranks have the sum s.
MANN_WHITNEY = """
ranked AS (
  SELECT side, x, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS midrank
  FROM sample WHERE x IS NOT NULL),
tie_term AS (
  SELECT sum(t * t * t - t) AS ties FROM (SELECT count(*)::DOUBLE AS t FROM ranked GROUP BY x)),
rank_sums AS (
  SELECT count(*) FILTER (WHERE side = 'a') AS n_a, count(*) FILTER (WHERE side = 'b') AS n_b,
         (SELECT count(*) FROM sample WHERE x IS NULL) AS n_dropped,
         sum(midrank) FILTER (WHERE side = 'a') AS r_a
  FROM ranked),
u_values AS (
  SELECT *, r_a - n_a * (n_a + 1) / 2 AS u_a, n_a * n_b - (r_a - n_a * (n_a + 1) / 2) AS u_b
  FROM rank_sums),
u_scores AS (
  SELECT *, CASE WHEN least(n_a, n_b) = 0 THEN 'undefined'
                 WHEN least(n_a, n_b) <= 8 AND ties = 0 THEN 'exact'
                 ELSE 'asymptotic' END AS method,
         (greatest(u_a, u_b) - n_a * n_b / 2 - 0.5)
         / sqrt(n_a * n_b / 12 * ((n_a + n_b + 1)
                - ties / ((n_a + n_b) * (n_a + n_b - 1)))) AS z
  FROM u_values, tie_term),
ways AS (
  SELECT 0 AS i, 0 AS k, 0 AS s, 1::DOUBLE AS c
  UNION ALL
  SELECT i + 1, k + taken, s + taken * (i + 1), sum(c)
  FROM ways, (VALUES (0), (1)) choice(taken), u_scores
  WHERE method = 'exact' AND i < n_a + n_b AND k + taken <= n_a
  GROUP BY i + 1, k + taken, s + taken * (i + 1)),
exact_p AS (
  SELECT least(1, 2 * sum(c) FILTER (WHERE s - n_a * (n_a + 1) / 2 >= greatest(u_a, u_b))
                  / sum(c)) AS p
  FROM ways, u_scores WHERE i = n_a + n_b AND k = n_a),
mann_whitney AS (
  SELECT u_scores.*, CASE method WHEN 'exact' THEN (SELECT p FROM exact_p)
      WHEN 'asymptotic' THEN least(1, 1 - (
      SELECT 2 * sum(exp(-0.5 * (z * (k + 0.5) / 20000) ** 2)) / sqrt(2 * pi()) * z / 20000
      FROM range(20000) steps(k))) END AS p_value
  FROM u_scores)"""
MANN_WHITNEY_COLUMNS = "n_a, n_b, n_dropped, method, " + rounded("u_a", "u_b", "z", "p_value")


def welch(source, value, pair, *parts):
    return query(f"SELECT {WELCH_COLUMNS} FROM welch_p", USERS, *parts,
                 sample(source, value, pair), WELCH)


def mann_whitney(source, value, pair):
    return query(f"SELECT {MANN_WHITNEY_COLUMNS} FROM mann_whitney", USERS,
                 sample(source, value, pair), MANN_WHITNEY)


def _poisson_case(word):
    """Weight from the Poisson(1) distribution function, by its series in SQL."""
    steps, series, factorial = [], "1.0", 1
    for k in range(13):
        if k:
            factorial *= k
            series += f" + 1.0 / {factorial}"
        steps.append(f"CASE WHEN {word} >= floor(exp(-1.0) * ({series}) * 4294967296) "
                     "THEN 1 ELSE 0 END")
    return " + ".join(steps)


BOOTSTRAP = f"""
draws AS (
  SELECT exp_group, likes, views, block,
         md5(CAST(user_id AS VARCHAR) || '-' || CAST(block AS VARCHAR) || '-{SEED}') AS h
  FROM ab CROSS JOIN range({REPLICATES // 4}) blocks(block) WHERE exp_group IN (1, 2)),
words AS (
  SELECT exp_group, likes, views, block * 4 + i AS replicate,
         CAST('0x' || substr(h, CAST(1 + 8 * i AS BIGINT), 8) AS BIGINT) AS word
  FROM draws CROSS JOIN range(4) parts(i)),
weights AS (
  SELECT exp_group, replicate, likes, views, {_poisson_case("word")} AS w FROM words),
replicates AS (
  SELECT exp_group, replicate, sum(w * likes) / nullif(sum(w * views), 0) AS global_ctr
  FROM weights GROUP BY ALL)"""


def histogram(source, value, groups, *parts, common=True):
    """Edges from exact quartiles, then a range join of the values with the bins."""
    scope = "0" if common else "exp_group"
    return query(
        """
SELECT exp_group, bin, """ + rounded("bin_left", "bin_right") + """, count(*) AS n
FROM bins JOIN vals ON vals.scope = bins.scope AND x >= bin_left
     AND (x < next_left OR bin = bins - 1)
GROUP BY ALL""", USERS, *parts, f"""
vals AS (
  SELECT exp_group, {scope} AS scope, {value} AS x FROM {source}
  WHERE {value} IS NOT NULL AND exp_group IN {groups}),
extent AS (
  SELECT scope, min(x) AS low, max(x) AS high, max(x) - min(x) AS spread,
         2 * (quantile_cont(x, 0.75) - quantile_cont(x, 0.25)) / count(*) ** (1 / 3) AS robust,
         (max(x) - min(x)) / (log2(count(*)) + 1) AS sturges
  FROM vals GROUP BY scope),
edges AS (
  SELECT scope, low, high,
         CAST(ceil(spread / CASE WHEN robust > 0 THEN least(robust, sturges) ELSE sturges END)
              AS BIGINT) AS bins
  FROM extent),
bins AS (
  SELECT scope, bins, bin, low + bin * ((high - low) / bins) AS bin_left,
         low + (bin + 1) * ((high - low) / bins) AS bin_right,
         low + (bin + 1) * ((high - low) / bins) AS next_left
  FROM edges, LATERAL (SELECT unnest(range(bins)) AS bin))""")


def _numbered(parts, number):
    """Copies of test steps under numbered names, to hold several in one query."""
    names = ("sample", "moments", "welch_p", "welch", "ranked", "tie_term", "rank_sums",
             "u_values", "u_scores", "ways", "exact_p", "mann_whitney", "linearized")
    return re.sub(rf"\b({'|'.join(names)})\b", rf"\1_{number}", parts)


def experiment(tests):
    """Several tests stacked: (label, test name, source, value, pair, extra part)."""
    parts, rows = [USERS], []
    for number, (label, test, source, value, pair, extra) in enumerate(tests):
        mine = [extra] if extra else []
        mine += [sample(source, value, pair), WELCH if test == "welch_t" else MANN_WHITNEY]
        parts += [_numbered(p, number) for p in mine]
        table, statistic = (("welch_p", "statistic") if test == "welch_t"
                            else ("mann_whitney", "u_a"))
        rows.append(f"SELECT '{label}' AS metric, '{test}' AS test, n_a, n_b, "
                    f"{r(statistic)} AS statistic, {rounded('p_value')} FROM {table}_{number}")
    return query(" UNION ALL ".join(rows), *parts)


CTR_TESTS = [
    (value, test, source, value, (1, 2), None)
    for source, value in (("ab", "ctr"), ("smoothed", "smoothed_ctr"), ("buckets", "bucket_ctr"))
    for test in ("welch_t", "mann_whitney_u")]
LINEARIZED_TESTS = [
    test for pair in ((0, 3), (1, 2)) for test in (
        ("ctr_%d_%d" % pair, "welch_t", "ab", "ctr", pair, None),
        ("lin_likes_%d_%d" % pair, "welch_t", "linearized", "lin_likes", pair,
         linearized(*pair)))]

# The stream holds back intervals that end after its last watermark.
CLOSED = """
closed AS (
  SELECT * FROM metrics
  WHERE time + INTERVAL 15 MINUTES <= (
    SELECT max(time) - INTERVAL 15 MINUTES
    FROM (SELECT time FROM feed UNION ALL SELECT time FROM messages)))"""

# One series per metric for the whole history: the recursions know series by metric and date.
WHOLE = """
whole AS (SELECT * REPLACE (DATE '2024-01-01' AS date) FROM metrics)"""
WEEKLY_FEED = f"feed WHERE CAST(time AS DATE) BETWEEN {FIRST} AND {DAY}"
WEEKLY_MESSAGES = f"messages WHERE CAST(time AS DATE) BETWEEN {FIRST} AND {DAY}"

ORACLE = {
    "feed_daily": query(f"SELECT {DAILY_COLUMNS} FROM daily", DAILY),
    "feed_daily_by_day": query(f"SELECT {DAILY_COLUMNS} FROM daily", DAILY),
    "feed_week_head": query(f"SELECT {DAILY_COLUMNS} FROM daily ORDER BY Date LIMIT 7", DAILY),
    "feed_latest_message": query("""
SELECT Date, 'Date    ' || lpad(CAST(Date AS VARCHAR) || ' 00:00:00', 23, ' ') || chr(10)
  || 'Feed_DAU' || lpad(CAST(Feed_DAU AS VARCHAR), 23, ' ') || chr(10)
  || 'Likes   ' || lpad(CAST(Likes AS VARCHAR), 23, ' ') || chr(10)
  || 'Views   ' || lpad(CAST(Views AS VARCHAR), 23, ' ') || chr(10)
  || 'CTR     ' || lpad(CAST(round(CTR, 6) AS VARCHAR), 23, ' ') AS message
FROM daily ORDER BY Date DESC LIMIT 1""", DAILY),
    "user_feed_stats": query("SELECT * FROM feed_stats", cube_parts()),
    "user_feed_stats_tsv": query("SELECT * FROM feed_stats", cube_parts()),
    "tsv_escapes": """
WITH odd AS (
  SELECT event_type, min(props) AS props, min(ts) AS first,
         chr(34) || chr(39) || chr(9) || chr(10) || chr(92) || 'N' || chr(92) || 't ' || chr(13) AS signs
  FROM events GROUP BY event_type)
SELECT event_type, md5(signs || props || reverse(signs)) AS odd,
       CASE WHEN event_type <> 'view' THEN '' END AS empty, first
FROM odd""",
    "messages_received": query("SELECT * FROM received", cube_parts()),
    "messages_sent": query("SELECT * FROM sent", cube_parts()),
    "user_message_stats": query("SELECT * FROM message_stats", cube_parts()),
    "user_activity": query("SELECT * FROM activity", cube_parts()),
    "user_activity_bucketed": query("SELECT * FROM activity", cube_parts()),
    "user_history_clustered": query(
        "SELECT user_id, time, action, gender, age, os, source, country, exp_group "
        f"FROM {WEEKLY_FEED} AND user_id = {USER_ID}"),
    "daily_cube": cube(),
    "daily_cube_one_day": cube(f"CAST(time AS DATE) = {DAY}"),
    "daily_cube_stored": cube(),
    "daily_cube_incremental": cube(),
    "smooth_history": query(
        f"SELECT * REPLACE (CAST(time AS DATE) AS date) FROM (SELECT {SMOOTH_COLUMNS} "
        f"FROM ({SMOOTHED}))", interval_rows("true"), WHOLE, single("whole"), holt("whole")),
    "weekly_users_sketched": query(
        "SELECT os, country, count(DISTINCT user_id) AS exact_users, 'true' AS within "
        f"FROM {WEEKLY_FEED} GROUP BY os, country"),
    "weekly_users_bitmap": query(
        f"SELECT os, source, country, count(DISTINCT user_id) AS users FROM {WEEKLY_FEED} "
        "GROUP BY os, source, country"),
    "rolling_users_bitmap": query("""
SELECT date, os, count(DISTINCT user_id) AS users
FROM (SELECT DISTINCT CAST(time AS DATE) AS date FROM feed) days
  JOIN feed ON CAST(time AS DATE) BETWEEN date - 6 AND date
GROUP BY date, os"""),
    "weekly_overlap_sketched": query(
        f"SELECT {FIRST} AS first_date, {DAY} AS last_date, "
        "count(*) FILTER (WHERE m IS NULL) AS purely_feed_users, "
        "count(*) FILTER (WHERE f IS NULL) AS purely_messenger_users, "
        "count(*) FILTER (WHERE f = m) AS both_func_users, count(*) AS all_unique_users "
        f"FROM (SELECT DISTINCT user_id AS f FROM {WEEKLY_FEED}) "
        f"FULL JOIN (SELECT DISTINCT user_id AS m FROM {WEEKLY_MESSAGES}) ON f = m"),
    "feed_only_users": query(FEED_ONLY),
    "messenger_only_users": query(MESSENGER_ONLY),
    "both_users": query(BOTH),
    "user_overlap": query("SELECT * FROM overlap", OVERLAP),
    "user_overlap_by_name": query("SELECT * FROM overlap", OVERLAP),
    "user_overlap_pct": query("SELECT date, " + rounded(
        "purely_feed_users", "purely_messenger_users", "both_func_users") + " FROM shares",
        OVERLAP),
    "segment_daily": query(f"SELECT {SEGMENT_COLUMNS} FROM segments", segments()),
    "segment_daily_full": query(f"SELECT {SEGMENT_COLUMNS} FROM segments",
                                segments("FULL JOIN")),
    "per_user_daily_means": query(
        f"SELECT date, {r('avg(likes_per_user)')} AS likes_per_user, "
        f"{r('avg(views_per_user)')} AS views_per_user FROM segments GROUP BY date", segments()),
    "daily_totals": query("SELECT * FROM totals", segments()),
    "source_os_users": query("SELECT * FROM source_os", SOURCE_OS),
    "source_pivot": query("SELECT * FROM by_source", SOURCE_OS),
    "os_pivot": query("SELECT * FROM by_os", SOURCE_OS),
    "audience_summary": query(SUMMARY, OVERLAP, segments(), SOURCE_OS),
    "interval_metrics": query(f"SELECT {METRIC_COLUMNS} FROM metrics", LIVE),
    "interval_metrics_by_label": query(
        f"SELECT {METRIC_COLUMNS}, date AS messenger_date, time AS messenger_time FROM metrics",
        LIVE),
    "smooth_single": query(f"SELECT {SMOOTH_COLUMNS} FROM smooth_single", LIVE, SINGLE),
    "smooth_holt": query(f"SELECT {SMOOTH_COLUMNS} FROM smooth_holt", LIVE, HOLT),
    "band_single": query(f"SELECT {BAND_COLUMNS} FROM flagged", LIVE, SINGLE,
                         band("SELECT * FROM smooth_single", TRAILING)),
    "band_holt": query(f"SELECT {BAND_COLUMNS} FROM flagged", LIVE, HOLT,
                       band("SELECT * FROM smooth_holt", TRAILING)),
    "alerts_centered": query(f"SELECT {BAND_COLUMNS} FROM flagged", LIVE, SINGLE, HOLT,
                             band(SMOOTHED, CENTERED)),
    "alerts_trailing": query(f"SELECT {BAND_COLUMNS} FROM flagged", LIVE, SINGLE, HOLT,
                             band(SMOOTHED, TRAILING)),
    "check_alerts": query(
        f"SELECT metric, date, time, interval, value, is_alert, message FROM (SELECT {ALERT_COLUMNS} "
        "FROM flagged WHERE is_alert AND time = (SELECT max(time) FROM flagged))",
        live(ALERT_AS_OF), SINGLE, HOLT, band(SMOOTHED, TRAILING)),
    "alerts_latest": query(
        f"SELECT {ALERT_COLUMNS} FROM flagged "
        "WHERE time = (SELECT max(time) FROM flagged)", LIVE, SINGLE, HOLT,
        band(SMOOTHED, TRAILING)),
    "ab_users": query(f"SELECT user_id, exp_group, likes, views, {rounded('ctr')} FROM ab",
                      USERS),
    "ab_group_ctr": query(f"SELECT exp_group, likes, views, {rounded('global_ctr')} "
                          "FROM ab_totals WHERE exp_group IN (1, 2)", USERS),
    "ab_smoothed_ctr": query("SELECT user_id, exp_group, likes, views, " + rounded(
        "ctr", "global_ctr", "smoothed_ctr") + " FROM smoothed", USERS),
    "ab_linearized": query("SELECT user_id, exp_group, likes, views, " + rounded(
        "ctr", "lin_likes") + " FROM linearized", USERS, linearized(1, 2)),
    "ab_buckets": query(f"SELECT exp_group, buckets, likes, views, {rounded('bucket_ctr')} "
                        "FROM buckets", USERS),
    "welch_ctr": welch("ab", "ctr", (1, 2)),
    "welch_ctr_0_3": welch("ab", "ctr", (0, 3)),
    "welch_smoothed": welch("smoothed", "smoothed_ctr", (1, 2)),
    "welch_linearized_0_3": welch("linearized", "lin_likes", (0, 3), linearized(0, 3)),
    "welch_linearized_1_2": welch("linearized", "lin_likes", (1, 2), linearized(1, 2)),
    "welch_buckets": welch("buckets", "bucket_ctr", (1, 2)),
    "mwu_ctr": mann_whitney("ab", "ctr", (1, 2)),
    "mwu_smoothed": mann_whitney("smoothed", "smoothed_ctr", (1, 2)),
    "mwu_buckets": mann_whitney("buckets", "bucket_ctr", (1, 2)),
    "mwu_small": mann_whitney("few_buckets", "bucket_ctr", (1, 2)),
    "bootstrap_cells": query("SELECT exp_group, likes, views, count(*) AS k FROM ab "
                             "WHERE exp_group IN (1, 2) GROUP BY ALL", USERS),
    "bootstrap_by_cell": query(
        f"SELECT exp_group, range AS replicate FROM ab_totals, range({REPLICATES}) "
        "WHERE exp_group IN (1, 2)", USERS),
    "bootstrap_ctr": query(f"SELECT exp_group, replicate, {rounded('global_ctr')} "
                           "FROM replicates", USERS, BOOTSTRAP),
    "bootstrap_incremental": query(f"SELECT exp_group, replicate, {rounded('global_ctr')} "
                           "FROM replicates", USERS, BOOTSTRAP),
    "hist_ctr": histogram("ab", "ctr", (1, 2)),
    "hist_ctr_0_3": histogram("ab", "ctr", (0, 3)),
    "hist_smoothed": histogram("smoothed", "smoothed_ctr", (1, 2)),
    "hist_bootstrap": histogram("replicates", "global_ctr", (1, 2), BOOTSTRAP, common=False),
    "hist_buckets": histogram("buckets", "bucket_ctr", (1, 2)),
    "hist_linearized": histogram("linearized", "lin_likes", (0, 3), linearized(0, 3)),
    "hist_linearized_1_2": histogram("linearized", "lin_likes", (1, 2), linearized(1, 2)),
    "ctr_experiment": experiment(CTR_TESTS),
    "linearized_experiment": experiment(LINEARIZED_TESTS),
    "stream_interval_metrics": query(f"SELECT {METRIC_COLUMNS} FROM closed",
                                     interval_rows("true"), CLOSED),
    "stream_alerts": query(
        f"SELECT {ALERT_COLUMNS} FROM flagged WHERE is_alert", interval_rows("true"), CLOSED,
        single("closed"), holt("closed"), band(SMOOTHED, TRAILING)),
    "stream_alerts_stateful": query(
        f"SELECT {ALERT_COLUMNS} FROM flagged WHERE is_alert", interval_rows("true"), CLOSED,
        single("closed"), holt("closed"), band(SMOOTHED, TRAILING)),
    "stream_any_order": query(
        f"SELECT {ALERT_COLUMNS} FROM flagged WHERE is_alert AND date <= {DAY}",
        interval_rows("true"), CLOSED, single("closed"), holt("closed"), band(SMOOTHED, TRAILING)),
    "stream_repaired": query(
        f"SELECT {ALERT_COLUMNS} FROM flagged WHERE is_alert "
        f"AND date IN ({', '.join(f'DATE {str(d)!r}' for d in REPAIRED)})",
        interval_rows("true"), CLOSED, single("closed"), holt("closed"),
        band(SMOOTHED, TRAILING)),
}
