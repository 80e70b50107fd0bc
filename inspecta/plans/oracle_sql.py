"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the operator semantics, not generated from the Spark code.
Fixture mappings are those of ``inspecta.fixtures``.
"""

AS_OF_HISTORY = "DATE '2001-08-01'"
AS_OF_DELTA = "DATE '2024-01-31'"



def enrich_sql(src: str, as_of: str) -> str:
    return f"""
  SELECT {src}.*,
         tests[-1].completedDate AS last_test_date,
         coalesce(tests[-1].testResult, 'NEVER MOT') AS last_test_result,
         CAST(tests[-1].odometerValue AS BIGINT) AS mileage,
         CAST(year({as_of}) - year(firstUsedDate) AS BIGINT) AS vehicle_age,
         n_pass AS pass_count, n_fail AS fail_count
  FROM {src}"""


# ---- F1: vehicles with their test history ---------------------------------
F1 = f"""
t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS registration, o_orderdate AS completedDate,
         o_orderkey AS motTestNumber,
         CASE o_orderstatus WHEN 'F' THEN 'PASSED' WHEN 'O' THEN 'FAILED'
                            WHEN 'P' THEN 'ABANDONED' END AS testResult,
         CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS odometerValue
  FROM orders
),
tagg AS (
  SELECT registration,
         min(completedDate) AS first_ts,
         max(completedDate) AS last_ts,
         list(struct_pack(completedDate := completedDate, motTestNumber := motTestNumber,
                          testResult := testResult, odometerValue := odometerValue)
              ORDER BY completedDate, motTestNumber) AS tests,
         count(*) FILTER (WHERE testResult = 'PASSED') AS n_pass,
         count(*) FILTER (WHERE testResult = 'FAILED') AS n_fail,
         count(*) AS n_tests
  FROM t GROUP BY registration
),
owners AS (
  SELECT CAST(c_custkey AS VARCHAR) AS registration, c_mktsegment AS make, c_nationkey AS nation, c_acctbal AS balance
  FROM customer
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), 'BUILDING', s_nationkey, s_acctbal FROM supplier
),
v AS (
  SELECT registration, make, n_name AS model,
         lower(r_name) AS primaryColour, 'Not Stated' AS secondaryColour,
         CASE WHEN balance >= 0 THEN 'PETROL' ELSE 'DIESEL' END AS fuelType,
         CAST(nation * 100 + 1000 AS VARCHAR) AS engineSize
  FROM owners LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region
                         ON n_regionkey = r_regionkey) g ON nation = g.n_nationkey
),
hist AS (
  SELECT v.*, CAST(first_ts AS DATE) AS manufactureDate, CAST(first_ts AS DATE) AS registrationDate,
         CAST(first_ts AS DATE) AS firstUsedDate, last_ts AS lastMotTestDate,
         'CREATED' AS modification, tests,
         CAST(coalesce(n_tests, 0) AS BIGINT) AS n_tests,
         CAST(coalesce(n_pass, 0) AS BIGINT) AS n_pass,
         CAST(coalesce(n_fail, 0) AS BIGINT) AS n_fail,
         '13-03-2026' AS date, DATE '2026-03-13' AS feed_date
  FROM v LEFT JOIN tagg USING (registration)
),
enriched AS ({enrich_sql("hist", AS_OF_HISTORY)})"""

ENRICH_COLS = ("registration, make, model, primaryColour, fuelType, engineSize, firstUsedDate, "
               "lastMotTestDate, last_test_date, last_test_result, mileage, vehicle_age, "
               "pass_count, fail_count, n_tests")

SQL = {}

SQL["enrich"] = f"WITH {F1} SELECT {ENRICH_COLS} FROM enriched"
SQL["enrich_flat"] = SQL["enrich"]
SQL["last_test"] = f"WITH {F1} SELECT registration, last_test_date, last_test_result FROM enriched"
SQL["mileage"] = f"WITH {F1} SELECT registration, mileage FROM enriched"
SQL["vehicle_age"] = f"WITH {F1} SELECT registration, vehicle_age FROM enriched"
SQL["result_counts"] = f"WITH {F1} SELECT registration, pass_count, fail_count FROM enriched"

DAILY = f"""
daily AS (
  SELECT last_test_date AS test_date, last_test_result AS result_type, count(*) AS count
  FROM enriched
  WHERE CAST(last_test_date AS DATE) >= {AS_OF_HISTORY} - 60
    AND last_test_result IN ('PASSED', 'FAILED')
  GROUP BY 1, 2
)"""
SQL["daily_counts"] = f"WITH {F1}, {DAILY} SELECT * FROM daily"
SQL["daily_counts_by_day"] = f"""WITH {F1}
SELECT CAST(CAST(last_test_date AS DATE) AS TIMESTAMP) AS test_date,
       last_test_result AS result_type, count(*) AS count
FROM enriched
WHERE CAST(last_test_date AS DATE) >= {AS_OF_HISTORY} - 60
  AND last_test_result IN ('PASSED', 'FAILED')
GROUP BY 1, 2"""

def newest(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT * FROM {src}
  QUALIFY row_number() OVER (PARTITION BY registration ORDER BY lastMotTestDate DESC, event_id DESC) = 1
)"""


def delta_enriched(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT {src}.*, lastMotTestDate AS last_test_date, test_result AS last_test_result,
         CAST(odometer AS BIGINT) AS mileage,
         CAST(year({AS_OF_DELTA}) - year(firstUsedDate) AS BIGINT) AS vehicle_age,
         CAST(test_result = 'PASSED' AS BIGINT) AS pass_count,
         CAST(test_result = 'FAILED' AS BIGINT) AS fail_count, CAST(1 AS BIGINT) AS n_tests
  FROM {src}
)"""


# ---- F2: delta records against a main table --------------------------------
F2 = F1 + f""",
ev AS (
  SELECT CASE WHEN event_id % 20 IN (11, 17) THEN 'N' ELSE '' END || CAST(user_id AS VARCHAR) AS registration,
         upper(event_type) AS make, event_type AS model,
         'silver' AS primaryColour, CAST(NULL AS VARCHAR) AS secondaryColour, 'ELECTRIC' AS fuelType,
         CAST(NULL AS VARCHAR) AS engineSize, CAST(ts AS DATE) AS manufactureDate,
         CAST(ts AS DATE) AS registrationDate, CAST(ts AS DATE) AS firstUsedDate,
         ts AS lastMotTestDate,
         CASE WHEN event_id % 10 IN (0, 3, 7) THEN 'DELETED' WHEN event_id % 10 = 1 THEN 'CREATED'
              WHEN event_id % 10 = 9 THEN 'NOISE' ELSE 'UPDATED' END AS modification,
         CASE event_type WHEN 'purchase' THEN 'PASSED' WHEN 'error' THEN 'FAILED'
                         ELSE 'ABANDONED' END AS test_result,
         CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS odometer,
         strftime(ts, '%d-%m-%Y') AS date, CAST(ts AS DATE) AS feed_date, event_id
  FROM events
),
valid AS (SELECT * FROM ev WHERE modification IN ('CREATED', 'UPDATED', 'DELETED')),
{newest('dd', 'valid')},
{delta_enriched('de', 'dd')},
mall AS ({enrich_sql("hist", AS_OF_DELTA)}),
mn AS (SELECT * FROM mall)"""

SET_COLS = ["modification", "make", "model", "primaryColour", "secondaryColour", "fuelType",
            "engineSize", "manufactureDate", "registrationDate", "firstUsedDate", "lastMotTestDate",
            "last_test_date", "last_test_result", "mileage", "vehicle_age", "pass_count",
            "fail_count", "n_tests"]
_set = ",\n  ".join(f"CASE WHEN d.registration IS NOT NULL THEN d.{c} ELSE m.{c} END AS {c}" for c in SET_COLS)

SQL["valid_delta"] = f"WITH {F2} SELECT registration, modification, lastMotTestDate, event_id FROM valid"
SQL["dedupe_delta"] = f"WITH {F2} SELECT registration, modification, lastMotTestDate, event_id FROM dd"
def merged(main: str, delta: str) -> str:
    return f"""SELECT coalesce(m.registration, d.registration) AS registration,
  {_set},
  m.date AS date, m.feed_date AS feed_date
FROM {main} m FULL OUTER JOIN {delta} d ON m.registration = d.registration
WHERE d.registration IS NULL OR d.modification <> 'DELETED'"""


def actions(main: str, delta: str) -> str:
    return f"""SELECT CASE WHEN d.registration IS NULL THEN 'keep'
            WHEN m.registration IS NULL AND d.modification = 'DELETED' THEN 'ignore'
            WHEN m.registration IS NULL THEN 'insert'
            WHEN d.modification = 'DELETED' THEN 'delete' ELSE 'update' END AS action
FROM {main} m FULL OUTER JOIN {delta} d ON m.registration = d.registration"""


SQL["upsert"] = f"WITH {F2} {merged('mn', 'de')}"
SQL["upsert_broadcast"] = SQL["upsert"]
SQL["upsert_shuffle"] = SQL["upsert"]
SQL["merge_report"] = f"WITH {F2} SELECT action, count(*) AS rows FROM ({actions('mn', 'de')}) GROUP BY 1"
# records of one event type lose their key, the others are deduped by it
ODD = F2 + f""",
named AS (SELECT * FROM valid WHERE model <> 'error'),
{newest('ddn', 'named')},
{delta_enriched('den', 'ddn')},
nameless AS (SELECT * FROM valid WHERE model = 'error'),
{delta_enriched('denull', 'nameless')}"""
SQL["upsert_odd_keys"] = f"""WITH {ODD}
{merged('mn', 'den')}
UNION ALL
SELECT NULL, {", ".join(SET_COLS)}, NULL, NULL FROM denull WHERE modification <> 'DELETED'"""
SQL["merge_report_null_keys"] = f"""WITH {ODD},
mo AS (SELECT * FROM mn WHERE fuelType <> 'DIESEL'),
acts AS (
  {actions('mo', 'den')}
  UNION ALL SELECT 'keep' FROM mn WHERE fuelType = 'DIESEL'
  UNION ALL SELECT CASE modification WHEN 'DELETED' THEN 'ignore' ELSE 'insert' END FROM denull
)
SELECT action, count(*) AS rows FROM acts GROUP BY 1"""
# week 1, then week 2 with changes of the same vehicles, and deletes of those it has no dated record of
WEEKLY = f"""{F2},
v1 AS (SELECT * FROM valid WHERE lastMotTestDate < TIMESTAMP '2024-01-15'),
{newest('dd1', 'v1')},
{delta_enriched('de1', 'dd1')},
m1 AS ({merged('mn', 'de1')}),
e2 AS (SELECT * FROM ev WHERE lastMotTestDate >= TIMESTAMP '2024-01-15'),
v2 AS (SELECT * FROM e2 WHERE modification IN ('CREATED', 'UPDATED', 'DELETED')),
{newest('dd2', 'v2')},
{delta_enriched('de2', 'dd2')},
gone AS (SELECT registration FROM v1 WHERE modification <> 'DELETED' AND registration NOT IN (SELECT registration FROM e2)),
m2 AS (SELECT * FROM ({merged('m1', 'de2')}) WHERE registration NOT IN (SELECT registration FROM gone))"""
SQL["weekly_delta_ingest"] = f"WITH {WEEKLY} SELECT * FROM m2"
SQL["changelog_read"] = SQL["changelog_compacted"] = SQL["weekly_delta_ingest"]
SQL["counts_incremental"] = f"""WITH {WEEKLY}
SELECT last_test_date AS test_date, last_test_result AS result_type, count(*) AS count FROM m2
WHERE last_test_result IN ('PASSED', 'FAILED') GROUP BY 1, 2"""
SQL["weekly_rows_affected"] = SQL["merge_report"]
SQL["new_vehicles"] = f"""WITH {F2}
SELECT registration, modification, lastMotTestDate, last_test_result, mileage
FROM de WHERE modification <> 'DELETED'
  AND registration NOT IN (SELECT registration FROM mn)"""
SQL["drop_deleted"] = f"""WITH {F2}
SELECT registration, last_test_result, mileage FROM mn
WHERE registration NOT IN (SELECT registration FROM de WHERE modification = 'DELETED')"""
SQL["stage_union"] = f"""WITH {F2}
SELECT registration, modification, lastMotTestDate, event_id,
       CASE WHEN lastMotTestDate < TIMESTAMP '2024-01-15' THEN engineSize END AS engineSize
FROM ev"""

# ---- F3: daily count series ------------------------------------------------
def training(src: str, n_types: int, p: str = "") -> str:
    """{p}complete and {p}train of the counts ``src`` (test_date, result_type, count)."""
    return f"""
{p}complete AS (
  SELECT test_date FROM {src} GROUP BY test_date HAVING count(DISTINCT result_type) = {n_types}
),
{p}train AS (
  SELECT CAST(test_date AS DATE) AS test_date, result_type, CAST(sum(count) AS BIGINT) AS count
  FROM {src}
  WHERE CAST(test_date AS DATE) BETWEEN CAST({AS_OF_HISTORY} - INTERVAL 3 YEAR AS DATE)
                                    AND (SELECT CAST(max(test_date) AS DATE) FROM {p}complete)
  GROUP BY 1, 2
)"""


def daily_filled(src: str, p: str = "") -> str:
    """{p}filled: a row per day from the daily series ``src``, gaps interpolated."""
    return f"""
{p}s AS (SELECT CAST(test_date AS DATE) AS test_date, result_type, CAST(count AS DOUBLE) AS y FROM {src}),
{p}span AS (SELECT result_type, min(test_date) AS lo, max(test_date) AS hi FROM {p}s GROUP BY 1),
{p}grid AS (
  SELECT result_type, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS test_date
  FROM {p}span
),
{p}near AS (
  SELECT g.result_type, g.test_date,
         max(s.test_date) FILTER (WHERE s.test_date <= g.test_date) AS d0,
         min(s.test_date) FILTER (WHERE s.test_date >= g.test_date) AS d1
  FROM {p}grid g JOIN {p}s s ON g.result_type = s.result_type AND abs(s.test_date - g.test_date) <= 400
  GROUP BY ALL
),
{p}filled AS (
  SELECT n.result_type, n.test_date,
         CASE WHEN d0 = d1 THEN a.y
              ELSE a.y + (b.y - a.y) * (CAST(n.test_date - d0 AS DOUBLE) / CAST(d1 - d0 AS DOUBLE)) END AS count,
         d0 <> d1 AS filled
  FROM {p}near n JOIN {p}s a ON a.result_type = n.result_type AND a.test_date = d0
                 JOIN {p}s b ON b.result_type = n.result_type AND b.test_date = d1
)"""


def counts_of_orders(name: str, statuses: str) -> str:
    return f"""
{name} AS (
  SELECT o_orderdate AS test_date,
         CASE o_orderstatus WHEN 'F' THEN 'PASSED' WHEN 'O' THEN 'FAILED' ELSE 'ABANDONED' END AS result_type,
         count(*) AS count
  FROM orders WHERE o_orderstatus IN ({statuses}) GROUP BY 1, 2
)"""


F3 = f"""{counts_of_orders('f3', "'F', 'O'")}, {training('f3', 2)}, {daily_filled('f3')}"""

SQL["complete_dates"] = f"WITH {F3} SELECT test_date FROM complete"
SQL["training_cutoff"] = f"WITH {F3} SELECT CAST(max(test_date) AS DATE) AS cutoff FROM complete"
SQL["forecast_training"] = f"WITH {F3} SELECT * FROM train"
SQL["fill_daily"] = f"WITH {F3} SELECT result_type, test_date, round(count, 6) AS count, filled FROM filled"


def without_spikes(src: str, p: str = "") -> str:
    """{p}clean: values over 3 robust deviations from the rolling median become the median."""
    return f"""
{p}sw AS (
  SELECT result_type, test_date, count,
         list(count) OVER (PARTITION BY result_type ORDER BY test_date
                           ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS win
  FROM {src}
),
{p}sm AS (SELECT *, list_median(win) AS med FROM {p}sw),
{p}sd AS (SELECT *, list_median(list_transform(win, lambda v: abs(v - med))) AS mad FROM {p}sm),
{p}sx AS (SELECT *, abs(count - med) > CAST(3.0 AS DOUBLE) * greatest(CAST(1.4826 AS DOUBLE) * mad, CAST(1.0 AS DOUBLE)) AS is_spike
          FROM {p}sd),
{p}clean AS (SELECT result_type, test_date, CASE WHEN is_spike THEN med ELSE count END AS count, is_spike FROM {p}sx)"""


def without_seasonal_spikes(src: str, p: str = "") -> str:
    """{p}clean: values over 3 robust deviations from the median of their weekday become that median."""
    return f"""
{p}cb AS (SELECT result_type, test_date, count, list_median(list(count) OVER (
            PARTITION BY result_type, dayofweek(test_date) ORDER BY test_date ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) AS usual FROM {src}),
{p}cl AS (SELECT *, list_median(list(abs(count - usual)) OVER (
            PARTITION BY result_type ORDER BY test_date ROWS BETWEEN 7 PRECEDING AND 7 FOLLOWING)) AS mad FROM {p}cb),
{p}cx AS (SELECT *, abs(count - usual) > CAST(3.0 AS DOUBLE) * greatest(CAST(1.4826 AS DOUBLE) * mad, CAST(1.0 AS DOUBLE)) AS is_spike FROM {p}cl),
{p}clean AS (SELECT result_type, test_date, CASE WHEN is_spike THEN usual ELSE count END AS count, is_spike FROM {p}cx)"""


SQL["clean_seasonal_spikes"] = f"""WITH {F3}, {without_seasonal_spikes('filled')}
SELECT result_type, test_date, round(count, 6) AS count, is_spike FROM clean"""
SQL["clean_spikes"] = f"""WITH {F3}, {without_spikes('filled')}
SELECT result_type, test_date, round(count, 6) AS count, is_spike FROM clean"""

# Bank-holiday rules (England & Wales) evaluated in SQL; Easter by the
# anonymous Gregorian computus.  DuckDB dayofweek: 0 = Sunday.
HOLIDAYS = """
yrs AS (SELECT CAST(unnest(range(1990, 2031)) AS BIGINT) AS y),
ea AS (
  SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs
),
eb AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f FROM ea),
ec AS (SELECT *, (b - f + 1) // 3 AS g, c // 4 AS i, c % 4 AS k FROM eb),
ed AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM ec),
ee AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM ed),
ef AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM ee),
easter AS (
  SELECT y, make_date(y, (h + l - 7 * m + 114) // 31, (h + l - 7 * m + 114) % 31 + 1) AS es FROM ef
),
base AS (
  SELECT y, es, make_date(y, 1, 1) AS ny, make_date(y, 5, 1) AS may1, make_date(y, 5, 25) AS may25,
         make_date(y, 8, 25) AS aug25, make_date(y, 12, 25) AS xmas, make_date(y, 12, 26) AS boxing
  FROM easter
),
hol AS (
  SELECT CAST(CASE dayofweek(ny) WHEN 6 THEN ny + 2 WHEN 0 THEN ny + 1 ELSE ny END AS DATE) AS holiday_date,
         'NewYear' AS holiday_name FROM base
  UNION ALL SELECT CAST(es - 2 AS DATE), 'GoodFriday' FROM base
  UNION ALL SELECT CAST(es + 1 AS DATE), 'EasterMonday' FROM base
  UNION ALL SELECT CAST(may1 + CAST((8 - dayofweek(may1)) % 7 AS INTEGER) AS DATE), 'EarlyMayBankHoliday' FROM base
  UNION ALL SELECT CAST(may25 + CAST((8 - dayofweek(may25)) % 7 AS INTEGER) AS DATE), 'SpringBankHoliday' FROM base
  UNION ALL SELECT CAST(aug25 + CAST((8 - dayofweek(aug25)) % 7 AS INTEGER) AS DATE), 'SummerBankHoliday' FROM base
  UNION ALL SELECT CAST(CASE WHEN dayofweek(xmas) IN (0, 6) THEN xmas + 2 ELSE xmas END AS DATE), 'Christmas' FROM base
  UNION ALL SELECT CAST(CASE WHEN dayofweek(boxing) IN (0, 6) THEN boxing + 2 ELSE boxing END AS DATE), 'BoxingDay' FROM base
),
wh AS (
  SELECT f.result_type, f.test_date, f.count, hol.holiday_name
  FROM filled f LEFT JOIN hol ON f.test_date = hol.holiday_date
)"""

SQL["with_holidays"] = f"""WITH {F3}, {HOLIDAYS}
SELECT result_type, test_date, round(count, 6) AS count, holiday_name FROM wh"""
SQL["holiday_effect"] = f"""WITH {F3}, {HOLIDAYS},
mw AS (SELECT *, avg(count) OVER (PARTITION BY result_type) AS mean FROM wh)
SELECT result_type, holiday_name, round(avg(count - mean), 6) AS effect, count(*) AS days
FROM mw WHERE holiday_name IS NOT NULL GROUP BY 1, 2"""

AR1 = f"""{daily_filled('train', 't_')},
lagged AS (
  SELECT result_type, test_date, CAST(count AS DOUBLE) AS y,
         lag(CAST(count AS DOUBLE)) OVER (PARTITION BY result_type ORDER BY test_date) AS ylag
  FROM t_filled
),
ar1 AS (
  SELECT result_type, regr_slope(y, ylag) AS phi, regr_intercept(y, ylag) AS c,
         arg_max(y, test_date) AS last_value, max(test_date) AS last_date, count(*) AS n
  FROM lagged GROUP BY 1
),
hs AS (SELECT CAST(unnest(range(1, 31)) AS INTEGER) AS h),
fc AS (
  SELECT CAST(last_date + h AS TIMESTAMP) AS forecast_timestamp, result_type,
         CASE WHEN phi = 1.0 THEN c * h ELSE c * (1 - pow(phi, h)) / (1 - phi) END
           + pow(phi, h) * last_value AS forecast_value
  FROM ar1, hs
)"""
SQL["ar1_baseline"] = f"""WITH {F3}, {AR1}
SELECT result_type, round(phi, 6) AS phi, round(c, 6) AS c, last_value, last_date, n FROM ar1"""
# ---- F4: feed folders written and read back ------------------------------------
F4 = F2 + """,
feed AS (
  SELECT registration, modification, lastMotTestDate, firstUsedDate, make, engineSize,
         DATE '2026-03-13' AS feed_date, '13-03-2026' AS date, n_tests, 'bulk' AS kind
  FROM hist
  UNION ALL
  SELECT registration, modification, lastMotTestDate, firstUsedDate, make, engineSize,
         CASE WHEN lastMotTestDate < TIMESTAMP '2024-01-15' THEN DATE '2024-01-14' ELSE DATE '2024-01-30' END,
         CASE WHEN lastMotTestDate < TIMESTAMP '2024-01-15' THEN '14-01-2024' ELSE '30-01-2024' END,
         CAST(1 AS BIGINT), 'delta'
  FROM ev
)"""
FEED_COLS = "registration, modification, lastMotTestDate, firstUsedDate, make, engineSize, feed_date, date, n_tests"

SQL["feed_round_trip"] = f"WITH {F4} SELECT {FEED_COLS} FROM feed"
SQL["feed_stats"] = f"""WITH {F4}
SELECT CASE WHEN kind = 'bulk' THEN 'bulk-light-vehicle_14-03-2026'
            WHEN feed_date = DATE '2024-01-14' THEN 'delta-light-vehicle_15-01-2024'
            ELSE 'delta-light-vehicle_31-01-2024' END AS folder, count(*) AS records
FROM feed GROUP BY 1"""
SQL["latest_feed"] = f"WITH {F4} SELECT {FEED_COLS} FROM feed WHERE kind = 'delta' AND feed_date = DATE '2024-01-30'"
SQL["feed_zip"] = SQL["feed_round_trip"]
SQL["feed_corrupt_split"] = f"""WITH {F2}
SELECT registration, modification, lastMotTestDate, DATE '2024-01-30' AS feed_date
FROM ev WHERE model <> 'error'
UNION ALL SELECT registration, modification, lastMotTestDate, DATE '2026-03-13' FROM hist WHERE fuelType <> 'DIESEL'"""
SQL["feed_corrupt_rows"] = f"""WITH {F2}
SELECT CAST(NULL AS VARCHAR) AS registration, CAST(25 AS BIGINT) AS raw_length
FROM ev WHERE model = 'error'
UNION ALL SELECT NULL, 25 FROM hist WHERE fuelType = 'DIESEL'"""
SQL["feed_load_malformed"] = f"""WITH {F2}
SELECT 'bulk-light-vehicle_14-03-2026' AS folder, count(*) FILTER (WHERE fuelType <> 'DIESEL') AS records FROM hist
UNION ALL SELECT 'delta-light-vehicle_31-01-2024', count(*) FILTER (WHERE model <> 'error') FROM ev
UNION ALL SELECT 'malformed', (SELECT count(*) FROM hist WHERE fuelType = 'DIESEL') + (SELECT count(*) FROM ev WHERE model = 'error')"""
SQL["drop_stage"] = f"WITH {F2} SELECT count(*) AS staged, false AS still_there FROM ev"
SQL["table_append_overwrite"] = f"""WITH {F2}
SELECT registration, modification, last_test_result, mileage, vehicle_age FROM mn
UNION ALL
SELECT registration, modification, last_test_result, mileage, vehicle_age FROM de"""
SQL["main_by_day"] = f"""WITH {F1}
SELECT CAST(lastMotTestDate AS DATE) AS p_day, count(*) AS vehicles FROM hist GROUP BY 1"""
SQL["counts_by_month"] = f"""WITH {F3}
SELECT test_date, result_type, count, CAST(date_trunc('month', test_date) AS DATE) AS p_month FROM f3
WHERE test_date >= TIMESTAMP '2001-05-10'"""
SQL["flat_export"] = f"""WITH {F1}
SELECT date, registration, make, model, primaryColour, secondaryColour, fuelType, engineSize,
       coalesce(strftime(manufactureDate, '%Y-%m-%d'), '') AS manufactureDate,
       coalesce(strftime(registrationDate, '%Y-%m-%d'), '') AS registrationDate,
       coalesce(strftime(firstUsedDate, '%Y-%m-%d'), '') AS firstUsedDate,
       coalesce(strftime(lastMotTestDate, '%Y-%m-%dT%H:%M:%S'), '') AS lastMotTestDate,
       modification, CAST(n_tests AS INTEGER) AS motTestCount,
       '[' || coalesce(array_to_string(list_transform(tests, lambda x:
         '{{"completedDate":"' || strftime(x.completedDate, '%Y-%m-%dT%H:%M:%S.%g') || '","motTestNumber":' || x.motTestNumber
         || ',"testResult":"' || x.testResult || '","odometerValue":"' || x.odometerValue || '"}}'), ','), '') || ']' AS motTests
FROM hist"""
SQL["versioned_upsert"] = SQL["upsert"]

# ---- classifier inputs -----------------------------------------------------------
TRAIN = """
tr AS (
  SELECT last_test_result, mileage, vehicle_age, upper(make) AS make, upper(model) AS model,
         upper(primaryColour) AS primaryColour
  FROM enriched
  WHERE last_test_result IN ('PASSED', 'FAILED') AND mileage IS NOT NULL AND vehicle_age IS NOT NULL
)"""
SQL["pass_fail_training"] = f"WITH {F1}, {TRAIN} SELECT * FROM tr"
SQL["class_weights"] = f"""WITH {F1}, {TRAIN},
cc AS (SELECT last_test_result, count(*) AS n_class FROM tr GROUP BY 1)
SELECT last_test_result, n_class,
       round(CAST(sum(n_class) OVER () AS DOUBLE) / (count(*) OVER () * n_class), 6) AS weight
FROM cc"""
SQL["pass_probability"] = f"""WITH {F1}
SELECT registration,
       round(CASE WHEN pass_count + fail_count > 0
                  THEN CAST(pass_count AS DOUBLE) / (pass_count + fail_count) END, 6) AS pass_probability
FROM enriched"""
SQL["lookup"] = f"""WITH {F2}
SELECT registration, mileage, vehicle_age, make, model, primaryColour FROM enriched
WHERE registration IN (SELECT registration FROM ev)"""

# ---- streams, alerts, jobs ---------------------------------------------------------
# Each delta record keeps the feed date of its folder; the merge does not set it.
SQL["stream_ingest"] = SQL["feed_round_trip"]
SQL["stream_upsert"] = SQL["upsert"]
SQL["budget_overruns"] = """
SELECT event_id, value AS costAmount, CAST(50.0 AS DOUBLE) AS budgetAmount
FROM events WHERE value > 50.0"""
# Schema inference keeps ISO timestamps as text (timestamp inference is off by default).
SQL["feed_infer"] = f"""WITH {F4}
SELECT registration, modification, strftime(lastMotTestDate, '%Y-%m-%dT%H:%M:%S.%f') AS lastMotTestDate,
       feed_date
FROM feed"""
SQL["read_latest_feed"] = SQL["latest_feed"]
SQL["feed_limit"] = f"""WITH {F4}
SELECT registration, feed_date FROM feed WHERE kind = 'bulk' ORDER BY registration LIMIT 100"""
SQL["upsert_bucketed"] = SQL["upsert"]
SQL["bulk_load"] = SQL["enrich"]
SQL["normalise_feed"] = f"""WITH {F4}
SELECT registration, modification, lastMotTestDate, date,
       CASE WHEN kind = 'bulk' THEN 'bulk-light-vehicle_14-03-2026'
            WHEN feed_date = DATE '2024-01-14' THEN 'delta-light-vehicle_15-01-2024'
            ELSE 'delta-light-vehicle_31-01-2024' END AS folder,
       n_tests
FROM feed"""
SQL["budget_overruns_stream"] = SQL["budget_overruns"]

# ---- classifier on one category: the weighted share of passes of each make ---------
def pass_share(name: str, balanced: bool) -> str:
    weight = "sum(count(*)) OVER () / (2 * count(*))" if balanced else "1"
    return f"""
{name}w AS (SELECT last_test_result, CAST({weight} AS DOUBLE) AS w FROM tr GROUP BY 1),
{name} AS (
  SELECT make, sum(w) FILTER (WHERE last_test_result = 'PASSED') / sum(w) AS p
  FROM tr JOIN {name}w USING (last_test_result) GROUP BY 1
)"""


SCORED = "CASE WHEN p > 0.5 THEN 'PASSED' ELSE 'FAILED' END AS predicted_last_test_result, round(p, 4) AS pass_probability"
SQL["score"] = f"""WITH {F1}, {TRAIN}, {pass_share('sh', True)}
SELECT registration, {SCORED} FROM enriched JOIN sh USING (make)"""
SQL["model_round_trip"] = f"""WITH {F1}, {TRAIN}, {pass_share('sh', False)}
SELECT registration, {SCORED} FROM enriched JOIN sh USING (make)"""
SQL["score_all_features"] = f"WITH {F1} SELECT registration, true AS has_probability FROM enriched"
SQL["lookup_score"] = f"""WITH {F2}, {TRAIN}, {pass_share('sh', True)}
SELECT registration, mileage, vehicle_age, make, model, primaryColour, {SCORED}
FROM enriched JOIN sh USING (make) WHERE registration IN (SELECT registration FROM ev)"""
SQL["what_if_score"] = f"""WITH {F1}, {TRAIN}, {pass_share('sh', True)}
SELECT CAST(40000 AS BIGINT) AS mileage, CAST(7 AS BIGINT) AS vehicle_age, 'Machinery' AS make, 'any' AS model,
       'blue' AS primaryColour, {SCORED} FROM sh WHERE make = 'MACHINERY'"""


# ---- candidate models per series, chosen by AIC, and their forecasts ----------------
def models(src: str) -> str:
    return f"""
x AS (SELECT result_type, test_date, count AS y,
             lag(count) OVER (PARTITION BY result_type ORDER BY test_date) AS y0 FROM {src}),
week AS (SELECT result_type, dayofweek(test_date) AS wd, avg(y) AS m FROM x GROUP BY 1, 2),
base AS (
  SELECT result_type, regr_slope(y, y0) AS phi, regr_intercept(y, y0) AS c, avg(y - y0) AS step,
         count(y0) AS n, arg_max(y, test_date) AS last_value, max(test_date) AS last_date
  FROM x GROUP BY 1
),
fitted AS (
  SELECT x.result_type, y, c + phi * y0 AS ar1, y0 + step AS drift, m AS weekday
  FROM x JOIN base USING (result_type)
         JOIN week ON week.result_type = x.result_type AND wd = dayofweek(test_date)
  WHERE y0 IS NOT NULL
),
sq AS (
  SELECT result_type, 'ar1' AS model, 2 AS k, avg((y - ar1) ** 2) AS sigma2 FROM fitted GROUP BY 1
  UNION ALL SELECT result_type, 'drift', 1, avg((y - drift) ** 2) FROM fitted GROUP BY 1
  UNION ALL SELECT result_type, 'weekday', 7, avg((y - weekday) ** 2) FROM fitted GROUP BY 1
),
likely AS (
  SELECT *, CASE WHEN sigma2 IS NOT NULL THEN -n / 2.0 * (ln(2 * pi() * greatest(sigma2, 1e-12)) + 1) END AS log_likelihood FROM sq JOIN base USING (result_type)
),
fits AS (
  SELECT *, aicc IS NOT NULL AND row_number() OVER (PARTITION BY result_type ORDER BY aicc NULLS LAST, model) = 1 AS chosen
  FROM (SELECT *, CASE WHEN n - k - 2 > 0 AND (model <> 'weekday' OR n >= 14)
                       THEN 2 * (k + 1) - 2 * log_likelihood + 2.0 * (k + 1) * (k + 2) / (n - k - 2) END AS aicc FROM likely)
),
steps AS (
  SELECT f.*, CAST(last_date + h AS TIMESTAMP) AS forecast_timestamp, h,
         CASE model WHEN 'ar1' THEN phi WHEN 'drift' THEN 1.0 END AS a,
         CASE model WHEN 'ar1' THEN c WHEN 'drift' THEN step END AS b, m
  FROM (SELECT *, CAST(unnest(range(1, 31)) AS INTEGER) AS h FROM fits WHERE chosen) f
       LEFT JOIN week ON week.result_type = f.result_type AND wd = dayofweek(last_date + h)
),
ahead AS (
  SELECT forecast_timestamp, result_type,
         CASE WHEN model = 'weekday' THEN m WHEN a = 1 THEN b * h + last_value
              ELSE b * (1 - pow(a, h)) / (1 - a) + pow(a, h) * last_value END AS forecast_value,
         sqrt(sigma2 * CASE WHEN model = 'weekday' THEN 1 WHEN abs(a) = 1 THEN h
                            ELSE (1 - pow(a, 2 * h)) / (1 - a * a) END) AS standard_error
  FROM steps
)"""


Z = "1.959963984540054"     # of a 95 % interval
FITS = f"""{counts_of_orders('f3a', "'F', 'O', 'P'")}, {training('f3a', 3, 'a_')}, {daily_filled('a_train', 'a_')},
{without_spikes('a_filled', 'a_')}, {models('a_clean')}"""
SQL["fit_forecast"] = f"""WITH {FITS}
SELECT result_type, model, n, round(sigma2, 4) AS sigma2, round(log_likelihood, 4) AS log_likelihood, round(aicc, 4) AS aicc,
       round(CASE model WHEN 'ar1' THEN phi WHEN 'drift' THEN 1.0 END, 4) AS phi,
       round(CASE model WHEN 'ar1' THEN c WHEN 'drift' THEN step END, 4) AS c, round(last_value, 4) AS last_value, last_date
FROM fits"""
SQL["evaluate_forecast"] = f"""WITH {FITS}
SELECT result_type, model, n, round(sigma2, 4) AS sigma2, round(log_likelihood, 4) AS log_likelihood,
       round(aicc, 4) AS aicc, chosen FROM fits"""
SQL["forecast"] = f"""WITH {FITS}
SELECT forecast_timestamp, result_type, round(forecast_value, 4) AS forecast_value, round(standard_error, 4) AS standard_error,
       CAST(0.95 AS DOUBLE) AS confidence_level,
       round(forecast_value - {Z} * standard_error, 4) AS prediction_interval_lower_bound,
       round(forecast_value + {Z} * standard_error, 4) AS prediction_interval_upper_bound
FROM ahead"""


def chart(counts: str, ahead: str = "ahead") -> str:
    """Days within 30 of the run date: counts before it, forecasts (not below 0) from it."""
    return f"""
SELECT test_date, chart_series, round(value, 4) AS count FROM (
  SELECT CAST(forecast_timestamp AS DATE) AS test_date, result_type || ' - FORECAST' AS chart_series,
         CASE WHEN forecast_value < 0 THEN 0.0 ELSE forecast_value END AS value
  FROM {ahead} WHERE CAST(forecast_timestamp AS DATE) BETWEEN {AS_OF_HISTORY} AND {AS_OF_HISTORY} + 30
  UNION ALL
  SELECT CAST(test_date AS DATE), result_type || ' - ACTUAL', CAST(count AS DOUBLE)
  FROM {counts} WHERE CAST(test_date AS DATE) BETWEEN {AS_OF_HISTORY} - 30 AND {AS_OF_HISTORY} - 1
)"""


SQL["prediction_output"] = f"""WITH {F3}, {AR1} {chart('f3', 'fc')}"""
SQL["prediction_view"] = SQL["prediction_output"]
SQL["forecast_blend"] = f"""WITH {counts_of_orders('f3', "'F', 'O'")}, {FITS} {chart('f3')}"""


# ---- regression with autoregressive errors: elimination, order search and forecast by recursion ----
HOLIDAY_LIST = "['NewYear', 'GoodFriday', 'EasterMonday', 'EarlyMayBankHoliday', 'SpringBankHoliday', 'SummerBankHoliday', 'Christmas', 'BoxingDay']"


def regressor_list(day: str, names: str) -> str:
    return f"""([1.0] || list_transform(range(1, 7), lambda k: CASE WHEN dayofweek({day}) = k THEN 1.0 ELSE 0.0 END)
       || list_transform({HOLIDAY_LIST}, lambda k: CASE WHEN list_contains({names}, k) THEN 1.0 ELSE 0.0 END))::DOUBLE[]"""


def seasonal(src: str) -> str:
    """CTEs up to ``sfits`` (every candidate) and ``sahead`` (30 days) of the regular series ``src``."""
    return f"""
snames AS (SELECT holiday_date, list(holiday_name) AS names FROM hol GROUP BY 1),
sraw AS (SELECT result_type, CAST(test_date AS DATE) AS test_date, CAST(count AS DOUBLE) AS y,
                {regressor_list('test_date', "coalesce(names, [])")} AS x
         FROM {src} LEFT JOIN snames ON CAST(test_date AS DATE) = holiday_date),
sprev AS (SELECT *, lag(y) OVER w AS y0, lag(x) OVER w AS x0 FROM sraw WINDOW w AS (PARTITION BY result_type ORDER BY test_date)),
sdays AS (
  SELECT result_type, 0 AS d, test_date, y, x, y AS raw_y, x AS raw_x FROM sprev
  UNION ALL
  SELECT result_type, 1, test_date, y - y0, list_transform(x, lambda v, i: CASE WHEN i = 1 THEN 1.0 ELSE v - x0[i] END), y, x
  FROM sprev WHERE y0 IS NOT NULL
),
scell AS (SELECT result_type, d, i, j, sum(xy[i] * xy[j]) AS v FROM (SELECT *, list_append(x, y) AS xy FROM sdays),
                 (SELECT unnest(range(1, 16)) AS i), (SELECT unnest(range(1, 17)) AS j) GROUP BY ALL),
srow AS (SELECT result_type, d, i, list(v ORDER BY j) AS r FROM scell GROUP BY ALL),
seq AS (SELECT result_type, d, list(r ORDER BY i) AS m FROM srow GROUP BY ALL),
selim AS (
  SELECT result_type, d, m AS orig, m, 0 AS j, CAST([] AS BOOLEAN[]) AS used FROM seq
  UNION ALL
  SELECT result_type, d, orig,
         CASE WHEN ok THEN list_transform(m, lambda r, i: CASE WHEN i = j + 1 THEN list_transform(r, lambda v: v / piv)
                ELSE list_transform(r, lambda v, c: v - r[j + 1] * m[j + 1][c] / piv) END) ELSE m END, j + 1, list_append(used, ok)
  FROM (SELECT *, m[j + 1][j + 1] AS piv, m[j + 1][j + 1] > 1e-9 * orig[j + 1][j + 1] AS ok FROM selim WHERE j < 15)
),
sbeta AS (
  SELECT result_type, d, regressors, CAST(orig[1][1] AS BIGINT) AS n, CAST(len(list_filter(used, lambda u: u)) AS INTEGER) AS rank,
         list_transform(range(1, 16), lambda c: CASE WHEN c <= size AND used[c] THEN m[c][16] ELSE 0.0 END) AS beta
  FROM selim JOIN (VALUES ('level', 1), ('week', 7), ('week_holidays', 15)) AS t(regressors, size) ON j = size
),
sres AS (
  SELECT result_type, d, regressors, n, rank, beta, test_date, raw_y, raw_x,
         y - list_sum(list_transform(x, lambda v, i: v * beta[i])) AS u,
         row_number() OVER (PARTITION BY result_type, d, regressors ORDER BY test_date) AS k
  FROM sdays JOIN sbeta USING (result_type, d)
),
sgam AS (
  SELECT a.result_type, a.d, a.regressors, h, sum(a.u * coalesce(b.u, 0)) / any_value(a.n) AS g
  FROM sres a CROSS JOIN (SELECT unnest(range(0, 8)) AS h)
       LEFT JOIN sres b ON b.result_type = a.result_type AND b.d = a.d AND b.regressors = a.regressors AND b.k = a.k - h
  GROUP BY ALL
),
sgl AS (SELECT result_type, d, regressors, list(g ORDER BY h) AS g FROM sgam GROUP BY ALL),
ssum AS (SELECT *, sum(u) OVER (PARTITION BY result_type, d, regressors ORDER BY test_date) AS upto FROM sres),
skp AS (
  SELECT result_type, any_value(g) AS g, sum(upto * upto) / pow(count(*), 2) AS spread, least(7, floor(4 * pow(count(*) / 100.0, 0.25))) AS width
  FROM ssum JOIN sgl USING (result_type, d, regressors) WHERE d = 0 AND regressors = 'level' GROUP BY result_type
),
skl AS (SELECT *, list_sum(list_transform(g, lambda v, i: CASE WHEN i = 1 THEN v WHEN i - 1 > width THEN 0
                                          ELSE 2 * v * (1 - (i - 1) / (width + 1)) END)) AS long_run FROM skp),
sks AS (SELECT result_type, CASE WHEN long_run > 1e-12 THEN spread / long_run END AS kpss FROM skl),
sdl AS (
  SELECT result_type, d, regressors, g, 0 AS p, CAST([] AS DOUBLE[]) AS phi, g[1] AS v FROM sgl
  UNION ALL
  SELECT result_type, d, regressors, g, p + 1,
         list_append(list_transform(phi, lambda a, i: a - kappa * phi[p + 1 - i]), kappa), v * (1 - kappa * kappa)
  FROM (SELECT *, CASE WHEN v > 1e-12 THEN (g[p + 2] - coalesce(list_sum(list_transform(phi, lambda a, i: a * g[p + 2 - i])), 0)) / v
                       ELSE 0.0 END AS kappa FROM sdl WHERE p < 7)
),
slik AS (
  SELECT *, -n / 2.0 * (ln(2 * pi() * greatest(v, 1e-12)) + 1) AS log_likelihood, rank + p + 1 AS k
  FROM sdl JOIN sbeta USING (result_type, d, regressors) JOIN sks USING (result_type)
),
scrit AS (
  SELECT *, CASE WHEN n - k - 1 > 0 AND (regressors = 'level' OR n >= 14)
                 THEN -2 * log_likelihood + 2 * k + 2.0 * k * (k + 1) / (n - k - 1) END AS aicc,
         CASE WHEN n - k + 1 > 0 THEN v * n / (n - k + 1) END AS sigma2,
         CASE WHEN coalesce(kpss, 0) > 0.463 THEN 1 ELSE 0 END AS use_d
  FROM slik
),
sfits AS (
  SELECT *, d = use_d AND aicc IS NOT NULL AND row_number() OVER (
           PARTITION BY result_type, d = use_d ORDER BY round(aicc, 6) NULLS LAST, rank, p, regressors) = 1 AS chosen
  FROM scrit
),
slast AS (
  SELECT result_type, d, regressors, max(test_date) AS last_date, arg_max(raw_y, test_date) AS last_value, arg_max(raw_x, test_date) AS last_x,
         list(u ORDER BY test_date DESC) AS past
  FROM sres GROUP BY ALL
),
sstep AS (
  SELECT result_type, 0 AS h, phi, beta, sigma2, d, last_date, last_value, last_x, past, CAST([1.0] AS DOUBLE[]) AS psi,
         CAST(0 AS DOUBLE) AS u, CAST(0 AS DOUBLE) AS total, CAST(0 AS DOUBLE) AS weight, CAST(0 AS DOUBLE) AS spread
  FROM sfits JOIN slast USING (result_type, d, regressors) WHERE chosen
  UNION ALL
  SELECT result_type, h + 1, phi, beta, sigma2, d, last_date, last_value, last_x, list_prepend(new, past),
         list_prepend(coalesce(list_sum(list_transform(phi, lambda a, i: a * coalesce(psi[i], 0))), 0), psi), new, total + new,
         CASE WHEN d = 1 THEN weight + psi[1] ELSE psi[1] END,
         spread + pow(CASE WHEN d = 1 THEN weight + psi[1] ELSE psi[1] END, 2)
  FROM (SELECT *, coalesce(list_sum(list_transform(phi, lambda a, i: a * coalesce(past[i], 0))), 0) AS new FROM sstep WHERE h < 30)
),
sday AS (
  SELECT s.*, {regressor_list('last_date + h', "coalesce(names, [])")} AS x
  FROM sstep s LEFT JOIN snames ON holiday_date = last_date + h WHERE h > 0
),
sahead AS (
  SELECT CAST(last_date + h AS TIMESTAMP) AS forecast_timestamp, result_type,
         CASE WHEN d = 1 THEN last_value + total + list_sum(list_transform(x, lambda a, i: CASE WHEN i = 1 THEN h ELSE a - last_x[i] END * beta[i]))
              ELSE u + list_sum(list_transform(x, lambda a, i: a * beta[i])) END AS forecast_value,
         sqrt(sigma2 * spread) AS standard_error
  FROM sday
)"""


FORECAST_COLS = f"""forecast_timestamp, result_type, round(forecast_value, 4) AS forecast_value, round(standard_error, 4) AS standard_error,
       CAST(0.95 AS DOUBLE) AS confidence_level, round(forecast_value - {Z} * standard_error, 4) AS prediction_interval_lower_bound,
       round(forecast_value + {Z} * standard_error, 4) AS prediction_interval_upper_bound"""
# HOLIDAYS also joins a series named filled
CALENDAR = HOLIDAYS[:HOLIDAYS.index("wh AS (")].rstrip().rstrip(",")
CLEAN = f"""{counts_of_orders('f3a', "'F', 'O', 'P'")}, {training('f3a', 3, 'a_')}, {daily_filled('a_train', 'a_')},
{without_seasonal_spikes('a_filled', 'a_')}"""
SEASONAL = f"{CLEAN}, {CALENDAR}, {seasonal('a_clean')}"
SQL["order_search"] = f"""WITH RECURSIVE {SEASONAL}
SELECT result_type, d, regressors, p, n, rank, round(sigma2, 4) AS sigma2, round(log_likelihood, 4) AS log_likelihood,
       round(aicc, 4) AS aicc, round(kpss, 4) AS kpss, chosen FROM sfits"""
SQL["calendar_effects"] = f"""WITH RECURSIVE {SEASONAL},
named AS (SELECT result_type, regressors, unnest(beta) AS effect,
                 unnest(['level', 'weekday2', 'weekday3', 'weekday4', 'weekday5', 'weekday6', 'weekday7'] || {HOLIDAY_LIST}) AS effect_of
          FROM sfits WHERE chosen)
SELECT result_type, regressors, effect_of, round(effect, 4) AS effect FROM named WHERE effect_of <> 'level'"""
SQL["seasonal_forecast"] = f"WITH RECURSIVE {SEASONAL} SELECT {FORECAST_COLS} FROM sahead"
# the first 1 to 14 days of each series, as series of their own
YOUNG = f"""{CLEAN},
young AS (
  SELECT a.result_type || ' ' || k AS result_type, a.test_date, a.count
  FROM a_clean a JOIN (SELECT result_type, min(test_date) AS lo FROM a_clean GROUP BY 1) USING (result_type),
       (SELECT unnest(range(1, 15)) AS k)
  WHERE a.test_date < lo + CAST(k AS INTEGER)
)"""
SQL["young_order_search"] = f"""WITH RECURSIVE {YOUNG}, {CALENDAR}, {seasonal('young')}
SELECT result_type, d, regressors, p, n, round(sigma2, 4) AS sigma2, round(aicc, 4) AS aicc, chosen FROM sfits"""
SQL["young_seasonal_forecast"] = f"WITH RECURSIVE {YOUNG}, {CALENDAR}, {seasonal('young')} SELECT {FORECAST_COLS} FROM sahead"
# the short series also for the closed-form models
SQL["young_fit_forecast"] = f"""WITH {YOUNG}, {models('young')}
SELECT result_type, model, n, round(sigma2, 4) AS sigma2, round(aicc, 4) AS aicc, chosen FROM fits"""
SQL["young_forecast"] = f"WITH {YOUNG}, {models('young')} SELECT {FORECAST_COLS} FROM ahead"
SQL["analytics_chain"] = f"""WITH RECURSIVE {F1}, {DAILY}, {training('daily', 2, 'a_')}, {daily_filled('a_train', 'a_')},
{without_seasonal_spikes('a_filled', 'a_')}, {CALENDAR}, {seasonal('a_clean')} {chart('daily', 'sahead')}"""
SQL["upsert_bloom"] = SQL["upsert_bloom_crowded"] = SQL["upsert"]
SQL["upsert_odd_keys_broadcast"] = SQL["upsert_odd_keys"]
SQL["merge_observed"] = SQL["merge_report"]
SQL["stream_log"] = SQL["upsert"]
SQL["feed_load_counts"] = SQL["feed_stats"]
SQL["feed_read_by_schema"] = SQL["feed_infer"]
# a field is in a folder that has a value of it; a text where the feed writes dates, numbers or text
_FIELDS = ["registration", "make", "model", "primaryColour", "secondaryColour", "fuelType", "engineSize", "manufactureDate",
           "registrationDate", "firstUsedDate", "lastMotTestDate", "modification"]
_TESTS = {"completedDate": "string", "motTestNumber": "bigint", "testResult": "string", "odometerValue": "string"}


def _fields_of(folder: str, src: str, tests: str) -> str:
    plain = [f"SELECT '{folder}' AS folder, '{c}' AS path, 'string' AS type FROM {src} HAVING count({c}) > 0" for c in _FIELDS]
    nested = [f"SELECT '{folder}', 'motTests[].{c}', '{k}' FROM {src} HAVING {tests}" for c, k in _TESTS.items()]
    return " UNION ALL ".join(plain + nested)


SQL["feed_schema"] = f"""WITH {F2},
early AS (SELECT * FROM ev WHERE lastMotTestDate < TIMESTAMP '2024-01-15'),
late AS (SELECT * FROM ev WHERE lastMotTestDate >= TIMESTAMP '2024-01-15'),
had AS ({_fields_of('bulk-light-vehicle_14-03-2026', 'hist', 'sum(n_tests) > 0')}
        UNION ALL {_fields_of('delta-light-vehicle_15-01-2024', 'early', 'count(*) > 0')}
        UNION ALL {_fields_of('delta-light-vehicle_31-01-2024', 'late', 'count(*) > 0')}),
whole AS (SELECT DISTINCT path, type AS feed_type FROM had),
folders AS (SELECT DISTINCT folder FROM had)
SELECT f.folder, w.path, h.type, w.feed_type FROM folders f CROSS JOIN whole w LEFT JOIN had h ON h.folder = f.folder AND h.path = w.path"""
SQL["score_hashed"] = f"WITH {F1} SELECT registration, true AS agree, true AS is_probability FROM enriched"
SQL["read_zips"] = SQL["stream_ingest_zips"] = SQL["feed_round_trip"]
