"""DuckDB statements that state each query's result independently of the Spark code.

The statements follow the plain definitions (one aggregate per feature, joins by user,
row numbers per session), not the shape of the Spark plans. Doubles are rounded as
round(x + 1e-9, 6) on both sides.
"""

from __future__ import annotations

# What the CASE below can give, as cleaning leaves it (rows of Logout go).
PAGES = [
    "AddtoPlaylist", "Cancel", "Error", "Home", "NextSong", "SubmitDowngrade", "SubmitUpgrade", "ThumbsUp",
]

FEATURE_PAGES = [p for p in PAGES if p != "Cancel"]

RAW = """
timed AS (
  SELECT event_id, user_id, event_type, value, props,
         1704067200000 + 3 * ((epoch_us(ts) // 1000) - 1704067200000) AS ts,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events),
paged AS (
  SELECT *, CAST(floor(ts / 172800000) AS BIGINT) * 2 + (k % 2) AS session_id,
         CASE WHEN event_type = 'error' AND value > 200 THEN 'Cancel'
              WHEN event_type = 'error' AND k < 10 THEN 'Logout'
              WHEN event_type = 'error' THEN 'Error'
              WHEN event_type = 'view' THEN 'NextSong'
              WHEN event_type = 'click' AND k < 50 THEN 'Home'
              WHEN event_type = 'click' THEN 'Thumbs Up'
              WHEN event_type = 'purchase' THEN 'Add to Playlist'
              WHEN event_type = 'signup' AND k < 50 THEN 'Submit Upgrade'
              WHEN event_type = 'signup' THEN 'Submit Downgrade' END AS page
  FROM timed),
raw AS (
  SELECT CASE WHEN page = 'NextSong' THEN 'Artist ' || (event_id % 97) || ' & Co.' END AS artist,
         CASE WHEN page = 'Cancel' THEN 'Cancelled' WHEN page = 'Logout' THEN 'Logged Out'
              ELSE 'Logged In' END AS auth,
         CASE WHEN page <> 'Logout' THEN 'Name ' || (user_id % 50) END AS "firstName",
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'F'
              WHEN c_custkey % 2 = 1 THEN 'M' END AS gender,
         row_number() OVER (PARTITION BY user_id, session_id ORDER BY ts, event_id) - 1 AS "itemInSession",
         CASE WHEN page <> 'Logout' THEN 'O''Neil-' || (user_id % 30) END AS "lastName",
         CASE WHEN page = 'NextSong' THEN value END AS length,
         CASE WHEN k >= 50 THEN 'paid' ELSE 'free' END AS level,
         CASE WHEN c_custkey % 13 = 0 THEN 'City ' || n_nationkey
              ELSE 'City ' || n_nationkey || ', ' || chr(65 + n_nationkey) || 'X-'
                   || chr(65 + n_nationkey % 5) || 'Y' END AS location,
         CASE WHEN page IN ('Error', 'Home') THEN 'GET' ELSE 'PUT' END AS method,
         page,
         1701388800000 - (c_custkey % 200) * 86400000 - (c_custkey % 24) * 3600000 AS registration,
         session_id AS "sessionId",
         CASE WHEN page = 'NextSong' THEN 'Song #' || k || ' (live)' END AS song,
         CASE WHEN page = 'Error' THEN 404
              WHEN page IN ('Cancel', 'Logout', 'Submit Upgrade', 'Submit Downgrade') THEN 307
              ELSE 200 END::BIGINT AS status,
         ts,
         CASE WHEN page <> 'Logout' THEN 'Mozilla/5.0 (agent ' || (user_id % 5) || ')' END AS "userAgent",
         CASE WHEN page = 'Logout' AND k < 5 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId"
  FROM paged LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""

# The raw columns in order, with the type names Spark reports.
RAW_COLUMNS = [
    ("artist", "string"), ("auth", "string"), ("firstName", "string"), ("gender", "string"),
    ("itemInSession", "bigint"), ("lastName", "string"), ("length", "double"), ("level", "string"),
    ("location", "string"), ("method", "string"), ("page", "string"), ("registration", "bigint"),
    ("sessionId", "bigint"), ("song", "string"), ("status", "bigint"), ("ts", "bigint"),
    ("userAgent", "string"), ("userId", "string"),
]
STRINGS = [c for c, t in RAW_COLUMNS if t == "string"]


def _q(name: str) -> str:
    return f'"{name}"'


def _r(expr: str) -> str:
    return f"round(({expr}) + 1e-9, 6)"


def _r_large(expr: str) -> str:
    """As _r, for values that may be epoch milliseconds: these have no sixth decimal to round."""
    return f"CASE WHEN abs({expr}) > 1e9 THEN {expr} ELSE {_r(expr)} END"


def _strip(name: str) -> str:
    return f"regexp_replace({_q(name)}, '[^a-zA-Z0-9,-]', '', 'g')"


_STRIPPED = ", ".join(f"{_strip(c)} AS {_q(c)}" if c in STRINGS else _q(c) for c, _ in RAW_COLUMNS)

CLEAN = (
    RAW
    + f""",
stripped AS (SELECT {_STRIPPED} FROM raw),
clean AS (
  SELECT * REPLACE (TRY_CAST("userId" AS BIGINT) AS "userId", string_split(location, ',')[2] AS location),
         make_timestamp((ts // 1000) * 1000000) AS interaction_time,
         month(make_timestamp((ts // 1000) * 1000000))::INTEGER AS "month",
         CAST(make_timestamp((ts // 1000) * 1000000) AS DATE) AS "date",
         CASE WHEN page IN ('Cancellation Confirmation', 'Cancel') OR auth = 'Cancelled' THEN 1 ELSE 0 END AS flag
  FROM stripped
  WHERE TRY_CAST("userId" AS BIGINT) IS NOT NULL AND auth <> 'LoggedOut'),
labels AS (
  SELECT "userId", CASE WHEN sum(flag) >= 1 THEN 1 ELSE 0 END AS label FROM clean GROUP BY "userId"),
lasts AS (SELECT "userId", max(ts) AS last_interaction FROM clean GROUP BY "userId"),
tenure AS (
  SELECT c.*, last_interaction,
         CAST(trunc((last_interaction - registration) / 86400000.0) AS INTEGER) AS registered_days, label
  FROM clean c JOIN lasts USING ("userId") JOIN labels USING ("userId")),
levels AS (
  SELECT "userId", level AS valid_level FROM (
    SELECT "userId", level,
           row_number() OVER (PARTITION BY "userId" ORDER BY ts DESC, "itemInSession" DESC NULLS LAST, level DESC NULLS LAST) AS rn
    FROM clean) WHERE rn = 1)"""
)


def _durations(period: str, out: str) -> str:
    return f"""
SELECT "userId", avg(x) AS {out} FROM (
  SELECT "userId", p, avg((hi - lo) * 0.001) AS x FROM (
    SELECT "userId", {period} AS p, "sessionId", max(ts) AS hi, min(ts) AS lo
    FROM clean GROUP BY "userId", p, "sessionId") GROUP BY "userId", p) GROUP BY "userId\""""


def _means(period: str, measure: str, out: str) -> str:
    return f"""
SELECT "userId", avg(x) AS {out} FROM (
  SELECT "userId", {period} AS p, {measure} AS x FROM clean GROUP BY "userId", p) GROUP BY "userId\""""


def _page_means(period: str, prefix: str) -> str:
    cells = ", ".join(
        f"coalesce(avg(x) FILTER (WHERE page = '{p}'), 0) AS {prefix}{p}" for p in FEATURE_PAGES
    )
    return f"""
SELECT "userId", {cells} FROM (
  SELECT "userId", {period} AS p, page, count(*) AS x FROM clean GROUP BY "userId", p, page) GROUP BY "userId\""""


DAY, MONTH = '"date"', '"month"'

FEATURES = (
    CLEAN
    + f""",
dur_d AS ({_durations(DAY, "avg_daily_session_duration")}),
dur_m AS ({_durations(MONTH, "avg_monthly_session_duration")}),
items_d AS ({_means(DAY, 'max("itemInSession")', "avg_daily_items")}),
items_m AS ({_means(MONTH, 'max("itemInSession")', "avg_monthly_items")}),
sess_d AS ({_means(DAY, 'count(DISTINCT "sessionId")', "avg_daily_sessions")}),
sess_m AS ({_means(MONTH, 'count(DISTINCT "sessionId")', "avg_monthly_sessions")}),
pages_d AS ({_page_means(DAY, "avg_daily_")}),
pages_m AS ({_page_means(MONTH, "avg_monthly_")}),
base AS (SELECT DISTINCT "userId", gender, location, registered_days, last_interaction, label FROM tenure),
features AS (
  SELECT * FROM base JOIN levels USING ("userId")
  JOIN dur_d USING ("userId") JOIN dur_m USING ("userId")
  JOIN items_d USING ("userId") JOIN items_m USING ("userId")
  JOIN pages_d USING ("userId") JOIN pages_m USING ("userId")
  JOIN sess_d USING ("userId") JOIN sess_m USING ("userId"))"""
)

DAILY_PAGES = [f"avg_daily_{p}" for p in FEATURE_PAGES]
MONTHLY_PAGES = [f"avg_monthly_{p}" for p in FEATURE_PAGES]
MEANS = [
    "avg_daily_session_duration", "avg_monthly_session_duration", "avg_daily_items", "avg_monthly_items",
    *DAILY_PAGES, *MONTHLY_PAGES, "avg_daily_sessions", "avg_monthly_sessions",
]
INPUTS = ["last_interaction", "registered_days", *MEANS]

_FEATURE_LIST = ", ".join(
    ['"userId"', "last_interaction", "gender", "location", "label", "registered_days", "valid_level"]
    + [f"{_r(m)} AS {m}" for m in MEANS]
)


def _uniform(key: str, seed: int) -> str:
    return f"CAST(CAST('0x' || substr(md5('{seed}:' || {key}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"


_FREQUENCY_RANK = """row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1"""

# Indexes are fitted one after the other, each on the rows the earlier ones kept.
MODEL_ROWS = (
    FEATURES
    + f""",
with_gender AS (SELECT * FROM features WHERE gender IS NOT NULL),
with_location AS (SELECT * FROM with_gender WHERE location IS NOT NULL),
with_level AS (SELECT * FROM with_location WHERE valid_level IS NOT NULL),
gender_rank AS (SELECT gender, {_FREQUENCY_RANK.format(c="gender")} AS gender_index FROM features
                WHERE gender IS NOT NULL GROUP BY gender),
location_rank AS (SELECT location, {_FREQUENCY_RANK.format(c="location")} AS location_index FROM with_gender
                  WHERE location IS NOT NULL GROUP BY location),
level_rank AS (SELECT valid_level, {_FREQUENCY_RANK.format(c="valid_level")} AS valid_level_index FROM with_location
               WHERE valid_level IS NOT NULL GROUP BY valid_level),
model_rows AS (
  SELECT *, CASE WHEN {_uniform('"userId"', 42)} >= 1 - 0.2 THEN 'test'
                 WHEN {_uniform('"userId"', 43)} >= 1 - 0.2 THEN 'validation' ELSE 'train' END AS split
  FROM with_level JOIN gender_rank USING (gender) JOIN location_rank USING (location)
  JOIN level_rank USING (valid_level)
  WHERE {" AND ".join(f"{c} IS NOT NULL" for c in INPUTS)}),
guesses AS (
  SELECT label, CASE WHEN avg_monthly_Error >= 1.5 AND registered_days < 200 THEN 1 ELSE 0 END AS prediction
  FROM model_rows)"""
)


def _histogram(values: str, by: str) -> str:
    """``values``: a statement giving (by, x)."""
    return f"""
nums AS (SELECT {by}, CAST(x AS DOUBLE) AS x FROM ({values}) WHERE x IS NOT NULL),
ranges AS (
  SELECT {by}, CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS a,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS b FROM nums GROUP BY {by}),
counted AS (
  SELECT {by}, least(CAST(floor((x - a) / (b - a) * 10) AS INTEGER), 9) AS bin, count(*) AS n
  FROM nums JOIN ranges USING ({by}) GROUP BY ALL),
edges AS (SELECT {by}, a, b, unnest(range(10))::INTEGER AS bin FROM ranges)
SELECT {by}, bin, {_r_large("a + (b - a) / 10 * bin")} AS lo, {_r_large("a + (b - a) / 10 * (bin + 1)")} AS hi,
       coalesce(n, 0) AS n
FROM edges LEFT JOIN counted USING ({by}, bin)"""


def _raw(select: str) -> str:
    return f"WITH {RAW}\n{select}"


def _clean(select: str) -> str:
    return f"WITH {CLEAN}\n{select}"


def _features(select: str) -> str:
    return f"WITH {FEATURES}\n{select}"


def _model(select: str) -> str:
    return f"WITH {MODEL_ROWS}\n{select}"


_RAW_LIST = ", ".join(_q(c) for c, _ in RAW_COLUMNS)
_CLEAN_LIST = _RAW_LIST + """, epoch_ms(interaction_time) // 1000 AS interaction_second, "month",
       CAST("date" AS VARCHAR) AS "date\""""

# Numeric columns with a histogram: all of them but the key.
HISTOGRAM_COLUMNS = ["last_interaction", "label", "registered_days", *MEANS]


def _pivot(period: str, out: str) -> str:
    cells = ", ".join(f"nullif(count(*) FILTER (WHERE page = '{p}'), 0) AS {p}" for p in PAGES)
    listed = ", ".join(f"'{p}'" for p in PAGES)
    other = f"nullif(count(*) FILTER (WHERE page IS NULL OR page NOT IN ({listed})), 0) AS other"
    return f'SELECT "userId", {out}, {cells}, {other} FROM clean GROUP BY "userId", {period}'


def _crosstab(source: str, index: str, column: str, values: list[tuple[str, str]]) -> str:
    cells = ", ".join(f'sum(n) FILTER (WHERE {column} = {lit})::BIGINT AS "{name}"' for lit, name in values)
    other = f"sum(n) FILTER (WHERE {column} NOT IN ({', '.join(lit for lit, _ in values)}))::BIGINT AS other"
    return f"""SELECT {index}, {cells}, {other}, sum(n) FILTER (WHERE {column} IS NULL)::BIGINT AS missing
FROM ({source}) GROUP BY {index}"""


_EVENTS_GENDER_LEVEL = "SELECT gender, level, count(*) AS n FROM tenure GROUP BY gender, level"
_EVENTS_LEVEL_LABEL = "SELECT level, label, count(*) AS n FROM tenure GROUP BY level, label"
_EVENTS_STATE_LABEL = "SELECT location, label, count(*) AS n FROM tenure GROUP BY location, label"
_DAYS = 'SELECT "userId", label, avg(registered_days) AS x FROM tenure GROUP BY "userId", label'
_SESSIONS = """SELECT "userId", label, count(*) AS x FROM (
  SELECT DISTINCT "userId", label, "sessionId" FROM tenure) GROUP BY "userId", label"""
_ITEMS = 'SELECT "userId", label, avg("itemInSession") AS x FROM tenure GROUP BY "userId", label'


def _describe(name: str, kind: str) -> str:
    c = _q(name)
    number = f"TRY_CAST({c} AS DOUBLE)"
    mean = f"avg({c})" if kind == "bigint" else f"avg({number})"
    bounds = (
        f"NULL::DOUBLE AS min_number, NULL::DOUBLE AS max_number, min({c}) AS min_text, max({c}) AS max_text"
        if kind == "string"
        else f"min({c})::DOUBLE AS min_number, max({c})::DOUBLE AS max_number, "
        "NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text"
    )
    return f"""SELECT '{name}' AS column_name, count({c}) AS n, {_r_large(mean)} AS mean,
       CASE WHEN stddev_samp({number}) < 1e6 THEN round(stddev_samp({number}) + 1e-9, 6)
            ELSE round(stddev_samp({number}), 2) END AS stddev, {bounds} FROM raw"""


_METRICS = """
cm AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1)::DOUBLE AS tp,
              count(*) FILTER (WHERE label = 0 AND prediction = 1)::DOUBLE AS fp,
              count(*) FILTER (WHERE label = 1 AND prediction = 0)::DOUBLE AS fn,
              count(*) FILTER (WHERE label = 0 AND prediction = 0)::DOUBLE AS tn FROM guesses),
rates AS (SELECT *, tp + fp + fn + tn AS total,
                 CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END AS r0,
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS r1,
                 CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END AS p0,
                 CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p1 FROM cm),
f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0 END AS f0,
                CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0 END AS f1 FROM rates)
"""
_METRIC_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS metric, {_r(expr)} AS value FROM f"
    for name, expr in [
        ("f1", "(f0 * (tn + fp) + f1 * (tp + fn)) / total"),
        ("accuracy", "(tp + tn) / total"),
        ("weighted_precision", "(p0 * (tn + fp) + p1 * (tp + fn)) / total"),
        ("weighted_recall", "(r0 * (tn + fp) + r1 * (tp + fn)) / total"),
        ("auc_hard", "(r0 + r1) / 2"),
        ("recall_stay", "r0"),
        ("recall_churn", "r1"),
    ]
)


# Five columns have values in every line, the others where they are not null.
_DRIFT = " UNION ALL ".join(
    [
        f"SELECT '{c}' AS column_name, '{t}' AS declared, '{t}' AS found, count({_q(c)}) AS n, 'same' AS status FROM raw"
        for c, t in RAW_COLUMNS if c not in ("status", "userAgent")
    ]
    + [
        "SELECT 'status', 'bigint', 'mixed', count(*), 'changed' FROM raw",
        "SELECT 'userAgent', 'string', NULL, 0, 'missing'",
        "SELECT 'device', NULL, 'string', count(*), 'new' FROM raw WHERE ts % 97 = 5",
    ]
)

# The hand-written tree as plain conditions.
_TREE = """
leaves AS (
  SELECT *, CASE WHEN avg_monthly_Error <= 1.25 THEN CASE WHEN valid_level_index = 0 THEN 2 ELSE 3 END
                 WHEN registered_days <= 120 THEN CASE WHEN avg_monthly_Error <= 2.0 THEN 6 ELSE 7 END ELSE 8 END AS leaf
  FROM model_rows),
leaf_totals AS (SELECT leaf, count(*) AS n, sum(label) AS churners FROM leaves GROUP BY leaf)"""

_TREE_NODES = """(VALUES
  (0, 'split', 'avg_monthly_Error', NULL, NULL, NULL, 0.0, [2, 3, 6, 7, 8]),
  (1, 'split', 'valid_level_index', 0, 'left', 'avg_monthly_Error <= 1.25', 0.0, [2, 3]),
  (2, 'leaf', 'stay', 1, 'left', 'valid_level_index in (0.0)', 0.0, [2]),
  (3, 'leaf', 'stay', 1, 'right', 'valid_level_index not in (0.0)', 0.0, [3]),
  (4, 'split', 'registered_days', 0, 'right', 'avg_monthly_Error > 1.25', 1.0, [6, 7, 8]),
  (5, 'split', 'avg_monthly_Error', 4, 'left', 'registered_days <= 120.0', 1.0, [6, 7]),
  (6, 'leaf', 'stay', 5, 'left', 'avg_monthly_Error <= 2.0', 0.0, [6]),
  (7, 'leaf', 'churn', 5, 'right', 'avg_monthly_Error > 2.0', 1.0, [7]),
  (8, 'leaf', 'stay', 4, 'right', 'registered_days > 120.0', 0.0, [8])
) AS t(id, kind, display, parent, side, reason, prediction, below)"""

_TREE_RULES = """(VALUES
  (2, 2, 'avg_monthly_Error <= 1.25 and valid_level_index in (0.0)', 'stay'),
  (3, 2, 'avg_monthly_Error <= 1.25 and valid_level_index not in (0.0)', 'stay'),
  (6, 3, 'avg_monthly_Error > 1.25 and registered_days <= 120.0 and avg_monthly_Error <= 2.0', 'stay'),
  (7, 3, 'avg_monthly_Error > 1.25 and registered_days <= 120.0 and avg_monthly_Error > 2.0', 'churn'),
  (8, 2, 'avg_monthly_Error > 1.25 and registered_days > 120.0', 'stay')
) AS t(leaf, depth, rule, class_name)"""

_PAGE_MEANS_LONG = " UNION ALL ".join(
    f"""SELECT "userId", page, '{grain}' AS grain, {_r("avg(x)")} AS mean FROM (
  SELECT "userId", {period} AS p, page, count(*) AS x FROM clean WHERE page NOT IN ('Cancel', 'CancellationConfirmation')
  GROUP BY "userId", p, page) GROUP BY "userId", page"""
    for grain, period in (("daily", DAY), ("monthly", MONTH))
)

_NULL_PATTERNS = """
marked AS (SELECT list_filter([{names}], lambda x: x IS NOT NULL) AS names FROM raw),
patterns AS (SELECT names, count(*) AS n FROM marked GROUP BY names)""".format(
    names=", ".join(f"CASE WHEN {_q(c)} IS NULL THEN '{c}' END" for c, _ in RAW_COLUMNS)
)

_SCORED = """
scored AS (SELECT label, avg_monthly_Error - floor(registered_days / 50) AS score FROM model_rows),
scores AS (
  SELECT score, count(*) AS n, count(*) FILTER (label = 1) AS n_pos, count(*) FILTER (label = 0) AS n_neg
  FROM scored GROUP BY score),
ranks AS (
  SELECT s.*, coalesce(sum(n) OVER b, 0)::BIGINT AS below, coalesce(sum(n_pos) OVER b, 0)::BIGINT AS pos_below,
         coalesce(sum(n_neg) OVER b, 0)::BIGINT AS neg_below, (sum(n_pos) OVER ())::BIGINT AS p, (sum(n_neg) OVER ())::BIGINT AS q
  FROM scores s WINDOW b AS (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""


def statements() -> dict[str, str]:
    features_all = _features(f"SELECT {_FEATURE_LIST} FROM features")
    clean_all = _clean(f"SELECT {_CLEAN_LIST} FROM clean")
    out = {
        # sources and actions
        "scan_activity": _raw(f"SELECT {_RAW_LIST} FROM raw"),
        "land_activity": clean_all,
        "features_sink": features_all,
        "row_count": _raw("SELECT count(*) AS n FROM raw"),
        "split_counts": _model("SELECT split, count(*) AS n FROM model_rows GROUP BY split"),
        "user_counts": _model(
            "SELECT (SELECT count(*) FROM features) AS n_feature_rows, (SELECT count(*) FROM model_rows) AS n_model_rows"
        ),
        "preview": _raw(f'SELECT {_RAW_LIST} FROM raw ORDER BY ts, "userId", "sessionId", "itemInSession" LIMIT 5'),
        "schema_report": _raw(
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, "
                f"{'false' if c in ('auth', 'level', 'method', 'status') else 'true'} AS nullable, "
                f"count(*) FILTER (WHERE {_q(c)} IS NULL) AS n_null FROM raw"
                for i, (c, t) in enumerate(RAW_COLUMNS)
            )
        ),
        # projections and filters
        "clean_strings": _clean(f"SELECT {_RAW_LIST} FROM stripped"),
        "event_time": _raw(
            """SELECT "userId", ts, ts // 1000 AS interaction_second,
       month(make_timestamp((ts // 1000) * 1000000))::INTEGER AS "month",
       CAST(CAST(make_timestamp((ts // 1000) * 1000000) AS DATE) AS VARCHAR) AS "date" FROM raw"""
        ),
        "clean_activity": clean_all,
        "null_pattern_rows": _raw(
            f"""SELECT {_RAW_LIST} FROM raw WHERE artist IS NULL
ORDER BY ts, "userId", "sessionId", "itemInSession" LIMIT 10"""
        ),
        "null_name_rows": _raw(f'SELECT {_RAW_LIST} FROM raw WHERE "lastName" IS NULL'),
        "null_by_auth": _raw(
            "SELECT auth, count(*) AS n, "
            + ", ".join(f'count(*) FILTER (WHERE {_q(c)} IS NULL) AS "{c}_nulls"' for c, _ in RAW_COLUMNS if c != "auth")
            + " FROM raw GROUP BY auth"
        ),
        "scan_quarantine": _raw(
            """SELECT CASE ts % 97 WHEN 0 THEN 'not JSON' WHEN 1 THEN 'not an object' WHEN 2 THEN 'type of ts'
       WHEN 3 THEN 'type of itemInSession' WHEN 4 THEN 'blank' ELSE 'none' END AS cause, count(*) AS n FROM raw GROUP BY cause"""
        ),
        "schema_drift": _raw(_DRIFT),
        "sketched_users": _raw(
            """SELECT count(DISTINCT CAST(make_timestamp((ts // 1000) * 1000000) AS DATE)) AS n_days,
       count(DISTINCT "userId") AS n_users, true AS within_error FROM raw"""
        ),
        "sketched_users_by_day": _raw(
            """SELECT CAST(CAST(make_timestamp((ts // 1000) * 1000000) AS DATE) AS VARCHAR) AS "date",
       count(DISTINCT "userId") AS n_users, true AS within_error FROM raw GROUP BY "date\""""
        ),
        "tree_scored": f"""WITH {MODEL_ROWS},{_TREE}
SELECT "userId", leaf, CASE leaf WHEN 7 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction FROM leaves""",
        "tree_flow": f"""WITH {MODEL_ROWS},{_TREE}
SELECT id, kind, display, parent, side, reason, prediction::DOUBLE AS prediction, coalesce(sum(n), 0)::BIGINT AS n_users,
       {_r("sum(churners) / sum(n)")} AS churn_rate
FROM {_TREE_NODES} LEFT JOIN leaf_totals ON list_contains(below, leaf) GROUP BY ALL""",
        "tree_leaf_rules": f"""WITH {MODEL_ROWS},{_TREE}
SELECT leaf, depth, rule, class_name, coalesce(n, 0) AS n_users, {_r("churners / n")} AS churn_rate FROM {_TREE_RULES} LEFT JOIN leaf_totals USING (leaf)""",
        "null_patterns": f"WITH {RAW},{_NULL_PATTERNS} "
        "SELECT array_to_string(names, ',') AS pattern, len(names)::INTEGER AS n_columns, n FROM patterns",
        "null_implications": f"""WITH {RAW},{_NULL_PATTERNS},
alone AS (SELECT unnest(names) AS name, n FROM patterns), totals AS (SELECT name, sum(n)::BIGINT AS n FROM alone GROUP BY name),
pairs AS (SELECT a, b, sum(n)::BIGINT AS n_both FROM patterns, unnest(names) AS x(a), unnest(names) AS y(b) WHERE a <> b GROUP BY a, b)
SELECT a AS if_null, b AS then_null, t.n AS n_if, n_both, {_r("n_both / t.n")} AS share, n_both = t.n AS always,
       n_both = t.n AND n_both = u.n AS together
FROM pairs JOIN totals t ON t.name = a JOIN totals u ON u.name = b""",
        "null_groups": _raw(
            "SELECT string_agg(name, ',' ORDER BY name) AS columns, any_value(n)::BIGINT AS n FROM ("
            + " UNION ALL ".join(
                f"SELECT '{c}' AS name, count(*) AS n, sum(hash(\"userId\", ts, page, \"sessionId\", \"itemInSession\")::HUGEINT) AS marks FROM raw WHERE {_q(c)} IS NULL"
                for c, _ in RAW_COLUMNS
            )
            + ") WHERE n > 0 GROUP BY marks HAVING count(*) > 1"
        ),
        # labels and account attributes
        "churn_label": _clean('SELECT "userId", label FROM labels'),
        "label_join": _clean(
            f'SELECT {_CLEAN_LIST}, label FROM clean JOIN labels USING ("userId")'
        ),
        "last_interaction": _clean('SELECT "userId", last_interaction FROM lasts'),
        "registered_days": _clean(
            'SELECT "userId", registration, last_interaction, registered_days, count(*) AS n_events FROM tenure GROUP BY ALL'
        ),
        "valid_level": _clean('SELECT "userId", valid_level FROM levels'),
        "avg_length": _clean(f'SELECT "userId", {_r("avg(length)")} AS avg_length FROM clean GROUP BY "userId"'),
        "dedup": _clean(
            'SELECT DISTINCT "userId", last_interaction, gender, location, label, registered_days, valid_level '
            'FROM tenure JOIN levels USING ("userId")'
        ),
        # behaviour
        "session_duration": _features(
            f"""SELECT "userId", {_r("avg_daily_session_duration")} AS avg_daily_session_duration,
       {_r("avg_monthly_session_duration")} AS avg_monthly_session_duration
FROM dur_d JOIN dur_m USING ("userId")"""
        ),
        "items": _features(
            f"""SELECT "userId", {_r("avg_daily_items")} AS avg_daily_items,
       {_r("avg_monthly_items")} AS avg_monthly_items FROM items_d JOIN items_m USING ("userId")"""
        ),
        "session_counts": _features(
            f"""SELECT "userId", {_r("avg_daily_sessions")} AS avg_daily_sessions,
       {_r("avg_monthly_sessions")} AS avg_monthly_sessions FROM sess_d JOIN sess_m USING ("userId")"""
        ),
        "page_pivot_daily": _clean(_pivot('"date"', 'CAST("date" AS VARCHAR) AS "date"')),
        "page_pivot_monthly": _clean(_pivot('"month"', '"month"')),
        "page_visits_daily": _features(
            f"""SELECT "userId", {", ".join(f"{_r(c)} AS {c}" for c in DAILY_PAGES)} FROM pages_d"""
        ),
        "page_visits_monthly": _features(
            f"""SELECT "userId", {", ".join(f"{_r(c)} AS {c}" for c in MONTHLY_PAGES)} FROM pages_m"""
        ),
        "page_visits": _features(
            f"""SELECT "userId", {", ".join(f"{_r(c)} AS {c}" for c in DAILY_PAGES + MONTHLY_PAGES)}
FROM pages_d JOIN pages_m USING ("userId")"""
        ),
        "user_features": features_all,
        "features_from_cubes": features_all,
        "land_increments": clean_all,
        "landed_days": _clean(
            """SELECT CAST("date" AS VARCHAR) AS "date", CASE "sessionId" % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS batch, count(*) AS n
FROM clean WHERE "sessionId" % 2 = 0 OR day("date") <= 15 GROUP BY ALL"""
        ),
        "activity_cube": _clean(
            f"""SELECT "userId", gender, location, registration, level, CAST("date" AS VARCHAR) AS "date", "sessionId", page, count(*) AS n,
       {_r("coalesce(sum(length), 0)")} AS length_sum, count(length) AS length_n, min(ts) AS start, max(ts) AS "end", max("itemInSession") AS items,
       max(flag) AS flag
FROM clean GROUP BY ALL"""
        ),
        "page_means_long": _clean(f"""SELECT "userId", page, grain, mean FROM ({_PAGE_MEANS_LONG})"""),
        "page_vector_entries": _clean(
            f"""SELECT "userId", position, 'avg_' || grain || '_' || page AS feature, mean AS value
FROM ({_PAGE_MEANS_LONG}) JOIN (
  SELECT grain, page, row_number() OVER (ORDER BY grain, page) - 1 AS position FROM (SELECT DISTINCT grain, page FROM ({_PAGE_MEANS_LONG})))
USING (grain, page)"""
        ),
        "feature_columns": _features(
            " UNION ALL ".join(
                f"SELECT {i} AS position, '{c}' AS feature, "
                f"'{ {'last_interaction': 'bigint', 'registered_days': 'int'}.get(c, 'double') }' AS data_type, "
                f"count({c}) AS n_present FROM features"
                for i, c in enumerate(INPUTS)
            )
        ),
        # log profile
        "distinct_users": _raw('SELECT count(DISTINCT "userId") AS n_users FROM raw'),
        "time_range": _raw(
            """SELECT CAST(min(CAST(make_timestamp((ts // 1000) * 1000000) AS DATE)) AS VARCHAR) AS first_date,
       CAST(max(CAST(make_timestamp((ts // 1000) * 1000000) AS DATE)) AS VARCHAR) AS last_date FROM raw"""
        ),
        "distinct_values": _raw(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM raw GROUP BY {c}"
                for c in ["page", "auth", "level", "gender", "status", "method"]
            )
        ),
        "null_counts": _raw(
            "SELECT "
            + ", ".join(f"count(*) FILTER (WHERE {_q(c)} IS NULL) AS {_q(c)}" for c, _ in RAW_COLUMNS)
            + " FROM raw"
        ),
        "feature_null_counts": _features(
            "SELECT "
            + ", ".join(
                f"count(*) FILTER (WHERE {c} IS NULL) AS {c}"
                for c in ["last_interaction", "gender", "location", "label", "registered_days", "valid_level", *MEANS]
            )
            + " FROM features"
        ),
        "describe": _raw(" UNION ALL ".join(_describe(c, t) for c, t in RAW_COLUMNS)),
        "pages_without_null_artist": _raw(
            "SELECT DISTINCT page FROM raw EXCEPT SELECT DISTINCT page FROM raw WHERE artist IS NULL"
        ),
        # breakdowns
        "count_gender_level_auth": _raw("SELECT gender, level, auth, count(*) AS n FROM raw GROUP BY gender, level, auth"),
        "users_by_state_label": _clean(
            'SELECT location, label, count(*) AS n FROM (SELECT DISTINCT "userId", location, label FROM tenure) GROUP BY ALL'
        ),
        "users_by_gender_label": _clean(
            'SELECT gender, label, count(*) AS n FROM (SELECT DISTINCT "userId", gender, label FROM tenure) GROUP BY ALL'
        ),
        "avg_registered_days": _clean(f'SELECT "userId", label, {_r("x")} AS avg_registered_days FROM ({_DAYS})'),
        "events_by_gender_level": _clean(_EVENTS_GENDER_LEVEL),
        "sessions_per_user": _clean(f'SELECT "userId", label, x AS n_sessions FROM ({_SESSIONS})'),
        "avg_item_in_session": _clean(f'SELECT "userId", label, {_r("x")} AS avg_item_in_session FROM ({_ITEMS})'),
        "events_by_level_label": _clean(_EVENTS_LEVEL_LABEL),
        "events_by_state_label": _clean(
            f"SELECT location, label, n, {_r('n / sum(n) OVER (PARTITION BY location)')} AS label_share "
            f"FROM ({_EVENTS_STATE_LABEL})"
        ),
        "crosstab_gender_level": _clean(
            _crosstab(_EVENTS_GENDER_LEVEL, "level", "gender", [("'F'", "F"), ("'M'", "M")])
        ),
        "crosstab_level_label": _clean(
            _crosstab(_EVENTS_LEVEL_LABEL, "label", "level", [("'free'", "free"), ("'paid'", "paid")])
        ),
        "crosstab_state_label": _clean(_crosstab(_EVENTS_STATE_LABEL, "location", "label", [("0", "0"), ("1", "1")])),
        # histograms
        "feature_histograms": f"WITH {FEATURES},\nrounded AS (SELECT {_FEATURE_LIST} FROM features),"
        + _histogram(
            " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM rounded" for c in HISTOGRAM_COLUMNS),
            "feature",
        ),
        "hist_registered_days": f"WITH {CLEAN}," + _histogram(_DAYS, "label"),
        "hist_sessions": f"WITH {CLEAN}," + _histogram(_SESSIONS, "label"),
        "hist_items": f"WITH {CLEAN}," + _histogram(f'SELECT label, {_r("x")} AS x FROM ({_ITEMS})', "label"),
        # preparation, splits, scores
        "string_index": _model(
            """SELECT 'gender' AS column_name, gender AS value, CAST(gender_index AS DOUBLE) AS idx FROM gender_rank
UNION ALL SELECT 'location', location, CAST(location_index AS DOUBLE) FROM location_rank
UNION ALL SELECT 'valid_level', valid_level, CAST(valid_level_index AS DOUBLE) FROM level_rank"""
        ),
        "prepare_features": _model(
            """SELECT "userId", label, CAST(gender_index AS DOUBLE) AS gender_index,
       CAST(location_index AS DOUBLE) AS location_index,
       CAST(valid_level_index AS DOUBLE) AS valid_level_index, split FROM model_rows"""
        ),
        "feature_vector": _model(
            " UNION ALL ".join(
                f'SELECT "userId", {i} AS position, {_r_large(f"CAST({c} AS DOUBLE)")} AS value FROM model_rows'
                for i, c in enumerate(INPUTS)
            )
        ),
        "value_indexes": _model(
            """SELECT 'gender' AS column_name, gender AS value, count(*) AS n, any_value(gender_index) AS idx
FROM features JOIN gender_rank USING (gender) GROUP BY gender
UNION ALL SELECT 'location', location, count(*), any_value(location_index) FROM with_gender JOIN location_rank USING (location) GROUP BY location
UNION ALL SELECT 'valid_level', valid_level, count(*), any_value(valid_level_index)
FROM with_location JOIN level_rank USING (valid_level) GROUP BY valid_level"""
        ),
        "indexed_rows": _model(
            """SELECT "userId", label, CAST(gender_index AS DOUBLE) AS gender_index,
       CAST(location_index AS DOUBLE) AS location_index,
       CAST(valid_level_index AS DOUBLE) AS valid_level_index, split FROM model_rows"""
        ),
        # ranks over all rows: the pairs that a score orders are counted one by one
        "auc_ranked": f"""WITH {MODEL_ROWS},{_SCORED},
pairs AS (SELECT sum(CASE WHEN x.score > y.score THEN 1.0 WHEN x.score = y.score THEN 0.5 ELSE 0 END) AS won
  FROM scored x JOIN scored y ON x.label = 1 AND y.label = 0)
SELECT {_r("won / (count(*) FILTER (label = 1) * count(*) FILTER (label = 0))")} AS auc, count(*) FILTER (label = 1) AS n_pos,
       count(*) FILTER (label = 0) AS n_neg FROM scored, pairs GROUP BY won""",
        "score_ranks": f"""WITH {MODEL_ROWS},{_SCORED}
SELECT {_r("score")} AS score, n, n_pos, n_neg, below, pos_below, neg_below, {_r("below + (n + 1) / 2")} AS mid_rank FROM ranks""",
        "roc_curve": f"""WITH {MODEL_ROWS},{_SCORED}
SELECT {_r("score")} AS score, {_r("(p - pos_below) / p")} AS tpr, {_r("(q - neg_below) / q")} AS fpr,
       {_r("(p - pos_below) / (p - pos_below + q - neg_below)")} AS precision FROM ranks""",
        "data_split": _model('SELECT "userId", split FROM model_rows'),
        "stratified_sample": _model(
            f"""SELECT "userId", label FROM model_rows WHERE split = 'train'
AND {_uniform('"userId"', 45)} < CASE WHEN label = 0 THEN 1 / 3.5 WHEN label = 1 THEN 1.0 ELSE 0 END"""
        ),
        "class_balance": _model("SELECT label, count(*) AS n FROM model_rows WHERE split = 'train' GROUP BY label"),
        "class_balance_stratified": _model(
            f"""SELECT label, count(*) AS n FROM model_rows WHERE split = 'train'
AND {_uniform('"userId"', 45)} < CASE WHEN label = 0 THEN 1 / 3.5 WHEN label = 1 THEN 1.0 ELSE 0 END GROUP BY label"""
        ),
        "users_by_gender_level": _clean(
            'SELECT gender, level, count(DISTINCT "userId") AS n FROM tenure GROUP BY gender, level'
        ),
        # what must hold of any fit
        "model_roundtrip": _model("SELECT count(*) AS n, count(*) AS n_same FROM model_rows WHERE split = 'validation'"),
        "leaf_totals": _model("SELECT count(*) AS n_users, sum(label)::BIGINT AS n_churners FROM model_rows"),
        "tree_shape": "SELECT 1::BIGINT AS n_roots, 1::BIGINT AS leaves_over_splits, 0::BIGINT AS leaves_without_rule",
        "grid_settings": """SELECT b::INTEGER AS max_bins, d::INTEGER AS max_depth, i AS impurity
FROM (VALUES (10), (40)) x(b), (VALUES (5), (10), (20), (30)) y(d), (VALUES ('entropy'), ('gini')) z(i)""",
        "best_setting": "SELECT 4::BIGINT AS n_settings, true AS is_best",
        "importance_total": f"SELECT {len(INPUTS)}::BIGINT AS n_features, 1.0::DOUBLE AS total, true AS none_negative",
        "compared_labels": _model(
            """SELECT model, label, count(*) AS n, count(*) AS n_probable
FROM model_rows, (VALUES ('decision_tree'), ('logistic_regression'), ('random_forest'), ('gradient_boosting')) m(model)
WHERE split = 'validation' GROUP BY model, label"""
        ),
        "score_identities": _model(
            "SELECT count(*) AS n, true AS accuracy_agrees FROM model_rows WHERE split = 'validation'"
        ),
        "confusion_matrix": _model("SELECT label, prediction, count(*) AS n FROM guesses GROUP BY label, prediction"),
        "classification_metrics": f"WITH {MODEL_ROWS},{_METRICS}{_METRIC_ROWS}",
    }
    return out
