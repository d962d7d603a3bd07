"""DuckDB SQL for the registered queries.

The SQL goes step by step (running distinct counts, seeds, prior maxima), while the package
computes closed forms, so the two are independent readings.
"""

from __future__ import annotations

from datetime import date

ORDERS = """
transactions AS (
  SELECT o_orderkey AS Id,
    CASE WHEN o_orderkey % 29 = 0 THEN -o_custkey ELSE o_custkey END AS CustomerKey,
    CAST(CASE WHEN o_orderstatus = 'P' THEN -o_totalprice ELSE o_totalprice END
         AS DECIMAL(18,2)) AS Amount,
    o_orderdate + to_hours(CAST(o_orderkey * 7 % 24 AS INT))
                + to_minutes(CAST(o_orderkey * 13 % 60 AS INT)) AS CreatedAt,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
         THEN CAST(CASE WHEN floor(o_totalprice / 25000) = 5 THEN 105
                        ELSE floor(o_totalprice / 25000) END AS INT) END AS CompanyId,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'F' THEN 18 ELSE 17 END AS EntryType,
    CASE WHEN o_totalprice < 8000 THEN 1 ELSE 0 END AS IsCancellation,
    CASE WHEN o_totalprice > 492000 THEN o_custkey END AS OperatorCustomerKey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Fatura ödemesi'
                         WHEN '2-HIGH' THEN 'bill payment'
                         WHEN '3-MEDIUM' THEN 'Top-up' END AS StandardizedProductName
  FROM orders),
customer_types AS (
  SELECT o_custkey AS CustomerKey, o_orderdate + to_hours(12) AS CreatedAt,
    CAST(NULLIF(o_orderkey % 4, 3) AS INT) AS CustomerType
  FROM orders)"""

EVENTS = """
transactions AS (
  SELECT event_id AS Id, user_id AS CustomerKey, CAST(value AS DECIMAL(18,2)) AS Amount,
    ts AS CreatedAt,
    CASE WHEN event_type <> 'error' THEN CAST(length(event_type) AS INT) END AS CompanyId,
    17 AS EntryType, 0 AS IsCancellation, CAST(NULL AS BIGINT) AS OperatorCustomerKey
  FROM events)"""

DIMENSIONS = """
companies AS (
  SELECT n_nationkey AS Id, NULLIF(n_regionkey, 4) AS PaymentType
  FROM nation),
customers AS (
  SELECT c_custkey AS Customer_Key,
    TIMESTAMP '1994-06-01' + to_days(CAST(c_custkey * 97 % 900 AS INT))
                           + to_minutes(CAST(c_custkey * 31 % 1440 AS INT)) AS CreatedAt,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
         WHEN c_acctbal > 9000 THEN DATE '1899-05-05'
         WHEN c_acctbal > 8000 THEN DATE '2020-03-01'
         ELSE CAST(DATE '1950-01-01' + to_days(CAST(c_custkey * 37 % 18000 AS INT)) AS DATE)
    END AS DateOfBirth
  FROM customer)"""

AGE_YEARS = "CAST({} AS DOUBLE) / 365.25::DOUBLE"
TENURE_YEARS = "CAST({} AS DOUBLE) / 525960.0::DOUBLE"

CALENDAR = ["DTH", "MTD", "QTD", "SemiYTD", "YTD"]
LONG = ["2YTD", "3YTD", "FeatureLaunchedTD"]

# Period-pair table: prior count, long period, short period, period test, and the
# contribution, retained and rate columns. Fixed values.
PAIRS = [
    ("QTD", "MTD", "ThisMonthToTheQuarter", "RetainedUUThisMonthWithinTheQuarter",
     "ThisMonthWithinTheQuarter"),
    ("SemiYTD", "MTD", "ThisMonthToTheSemiYear", "RetainedUUThisMonthWithinTheSemiYear",
     "ThisMonthWithinTheSemiYear"),
    ("YTD", "MTD", "ThisMonthToTheYear", "RetainedUUThisMonthWithinTheYear",
     "ThisMonthWithinTheYear"),
    ("SemiYTD", "QTD", "ThisQuarterToTheSemiYear", "RetainedUUThisQuarterWithinTheSemiYear",
     "ThisQuarterWithinTheSemiYear"),
    ("YTD", "QTD", "ThisQuarterToTheYear", "RetainedUUThisQuarterWithinTheYear",
     "ThisQuarterWithinTheYear"),
    ("YTD", "SemiYTD", "ThisSemiYTDToTheYear", "RetainedUUThisSemiYearWithinTheYear",
     "ThisSemiYTDWithinTheYear"),
] + [
    (long, short, *(f"{prefix}This{label}ToThe{target}" for prefix in ("", "RetainUU", "")))
    for long, target, count in (("2YTD", "2YTD", 4), ("3YTD", "3YTD", 5),
                                ("FeatureLaunchedTD", "UUFeatureLaunchedTD", 6))
    for short, label in [("MTD", "Month"), ("QTD", "Quarter"), ("SemiYTD", "SemiYTD"),
                         ("YTD", "YTD"), ("2YTD", "2YTD"), ("3YTD", "3YTD")][:count]
]

KEY = "PaymentType, CompanyId"


def prior(long: str, short: str) -> str:
    return f"Previous{long}Before{short}"


class Day:
    """SQL for one base day, built up as common table expressions."""

    def __init__(self, base_day: str, launch: str, source: str = ORDERS,
                 dims: tuple[str, ...] = ("PaymentType", "CompanyId"), two_month: bool = False,
                 dth_average: str = "as_written", retained_2ytd: str = "as_written",
                 hour_offset: int = 0):
        self.base, self.launch, self.source = base_day, launch, source
        self.dims, self.dth_average, self.retained_2ytd = dims, dth_average, retained_2ytd
        self.calendar = CALENDAR + ["2MTD"] if two_month else CALENDAR
        self.hour = "date_trunc('hour', CreatedAt)"
        if hour_offset:
            self.hour = "CAST(CAST(CreatedAt AS DATE) AS TIMESTAMP) + " \
                f"to_hours(CAST((hour(CreatedAt) + {hour_offset}) % 24 AS INT))"
        base = date.fromisoformat(base_day)
        day = date.fromordinal(base.toordinal() - 1)
        self.day = day.isoformat()

        def first(months: int) -> str:
            return date(day.year, (day.month - 1) // months * months + 1, 1).isoformat()

        self.start = {
            "DTH": self.day, "MTD": first(1), "2MTD": first(2), "QTD": first(3),
            "SemiYTD": first(6), "YTD": first(12), "2YTD": f"{day.year - 1}-01-01",
            "3YTD": f"{day.year - 2}-01-01", "FeatureLaunchedTD": launch,
        }
        self.key = ", ".join(dims)

    # -- stages ---------------------------------------------------------------

    def enriched(self) -> str:
        product = type_join = type_column = ""
        if "StandardizedProductName" in self.dims:
            product = """, COALESCE(CAST(COALESCE(REPLACE(REPLACE(t.StandardizedProductName,
                'ödemesi', 'Payment'), 'payment', 'Payment'), 'NULL') AS VARCHAR), 'N/A')
                AS StandardizedProductName"""
        if "CustomerType" in self.dims:
            # The latest row counts whatever its type; no row at all drops the transaction.
            type_column = ", (SELECT coalesce(max(h.CustomerType), -80) FROM customer_types h " \
                "WHERE h.CustomerKey = t.CustomerKey AND h.CreatedAt = (SELECT max(g.CreatedAt) " \
                "FROM customer_types g WHERE g.CustomerKey = t.CustomerKey " \
                "AND g.CreatedAt <= t.CreatedAt) HAVING count(*) > 0) AS CustomerType"
            type_join = " WHERE CustomerType IS NOT NULL"
        return f"""WITH {self.source}, {DIMENSIONS},
eligible AS (
  SELECT t.* FROM transactions t
  WHERE EntryType = 17 AND IsCancellation = 0 AND OperatorCustomerKey IS NULL
    AND CreatedAt >= TIMESTAMP '{self.launch}' AND CreatedAt < TIMESTAMP '{self.base}'),
enriched AS (
  SELECT * FROM (
  SELECT t.Id, t.CustomerKey, t.Amount, t.CreatedAt,
    CASE WHEN c.PaymentType IS NULL THEN -80 ELSE c.PaymentType END AS PaymentType,
    CASE WHEN t.CompanyId IS NULL THEN -80 ELSE t.CompanyId END AS CompanyId,
    date_diff('minute', u.CreatedAt, t.CreatedAt) AS TenureMinutes,
    CASE WHEN year(u.DateOfBirth) >= 1900 AND year(u.DateOfBirth) < 2020
         THEN date_diff('day', u.DateOfBirth, CAST(t.CreatedAt AS DATE)) END AS AgeDays
    {product}{type_column}
  FROM eligible t LEFT JOIN companies c ON c.Id = t.CompanyId
  JOIN customers u ON u.Customer_Key = t.CustomerKey){type_join})"""

    def activity(self) -> str:
        """A bit for each month before the reported one, sixty of them, and one for all older."""
        return self.enriched() + f"""
            SELECT CustomerKey, CompanyId, CAST(sum(DISTINCT CASE WHEN back < 60
              THEN pow(2, back)::HUGEINT ELSE pow(2, 60)::HUGEINT END) AS BIGINT) AS Months
            FROM (SELECT CustomerKey, CompanyId, date_diff('month', CreatedAt,
                TIMESTAMP '{self.start["MTD"]}') - 1 AS back FROM eligible
              WHERE CreatedAt < TIMESTAMP '{self.start["MTD"]}') GROUP BY CustomerKey, CompanyId"""

    def windows(self, one: tuple[date, date], other: tuple[date, date]) -> str:
        """Distinct customers of two windows of days per cell."""
        first, second = (f"Date >= DATE '{a}' AND Date < DATE '{b}'" for a, b in (one, other))
        return self.cube() + f"""
            SELECT {self.key}, count(*) FILTER (a) AS UsersFirst, count(*) FILTER (b) AS UsersSecond,
              count(*) AS UsersEither, count(*) FILTER (a AND b) AS UsersBoth,
              CAST(count(*) FILTER (a AND b) AS DOUBLE) / nullif(count(*) FILTER (a), 0) AS ShareOfFirst
            FROM (SELECT {self.key}, CustomerKey, bool_or({first}) AS a, bool_or({second}) AS b
              FROM customer_cube WHERE ({first}) OR ({second}) GROUP BY {self.key}, CustomerKey)
            GROUP BY {self.key}"""

    def cube(self) -> str:
        labels = ", ".join(
            f"COALESCE({d}, {chr(39) + '(Overall)' + chr(39) if 'Product' in d else 10000}) AS {d}"
            for d in self.dims
        )
        return self.enriched() + f""",
levels AS (
  SELECT CustomerKey, DateHour, Date, {', '.join(f'{d}_ AS {d}' for d in self.dims)},
    TxCount, TotalVolume, AgeDays, TenureMinutes
  FROM (
    SELECT CustomerKey, {self.hour} AS DateHour,
      CAST(CreatedAt AS DATE) AS Date, {', '.join(f'{d} AS {d}_' for d in self.dims)},
      count(Id) AS TxCount, sum(Amount) AS TotalVolume, max(AgeDays) AS AgeDays,
      max(TenureMinutes) AS TenureMinutes
    FROM enriched
    GROUP BY CustomerKey, {self.hour}, CAST(CreatedAt AS DATE),
      CUBE({self.key}))),
customer_cube AS (
  SELECT CustomerKey, DateHour, Date, {labels}, TxCount, TotalVolume, AgeDays, TenureMinutes
  FROM levels)"""

    def totals(self) -> str:
        """Hourly measures of this year and their running sums by calendar period."""
        part = {
            "DTH": "CAST(DateHour AS DATE)",
            "MTD": "year(DateHour), month(DateHour)",
            "2MTD": "year(DateHour), (month(DateHour) - 1) // 2",
            "QTD": "year(DateHour), quarter(DateHour)",
            "SemiYTD": "year(DateHour), (month(DateHour) - 1) // 6",
            "YTD": "year(DateHour)",
        }
        columns = []
        for p in self.calendar:
            over = f"OVER (PARTITION BY {part[p]}, {self.key} ORDER BY DateHour)"
            source = "MTD" if p == "DTH" and self.dth_average == "as_written" else p
            avg = f"OVER (PARTITION BY {part[source]}, {self.key} ORDER BY DateHour)"
            columns += [
                f"CAST(sum(TxCountHourly) {over} AS BIGINT) AS TxCount{p}",
                f"CAST(sum(TxVolumeHourly) {over} AS DECIMAL(38,2)) AS TxVolume{p}",
                f"CAST(sum(age_days) {avg} AS DOUBLE) / NULLIF(sum(age_count) {avg} "
                f"* 365.25::DOUBLE, 0) AS AvgAge{p}",
                f"CAST(sum(tenure_minutes) {avg} AS DOUBLE) / NULLIF(sum(tenure_count) {avg} "
                f"* 525960.0::DOUBLE, 0) AS AvgTenureByYear{p}",
            ]
        return self.cube() + f""",
hourly AS (
  SELECT DateHour, {self.key}, count(DISTINCT CustomerKey) AS UUHourly,
    CAST(sum(TxCount) AS BIGINT) AS TxCountHourly,
    CAST(sum(abs(TotalVolume)) AS DECIMAL(38,2)) AS TxVolumeHourly,
    CAST(sum(AgeDays) AS DOUBLE) / NULLIF(count(AgeDays) * 365.25::DOUBLE, 0) AS AvgAgeHourly,
    CAST(sum(TenureMinutes) AS DOUBLE) / NULLIF(count(TenureMinutes) * 525960.0::DOUBLE, 0)
      AS AvgTenureByYearHourly,
    sum(AgeDays) AS age_days, count(AgeDays) AS age_count,
    sum(TenureMinutes) AS tenure_minutes, count(TenureMinutes) AS tenure_count
  FROM customer_cube
  WHERE DateHour < TIMESTAMP '{self.base}' AND DateHour >= TIMESTAMP '{self.start["YTD"]}'
  GROUP BY DateHour, {self.key}),
totals AS (SELECT *, {', '.join(columns)} FROM hourly)"""

    def users(self) -> str:
        """Running distinct users of each period: all customers counted up to each hour.

        Hours without a new customer are left out, as a carried value fills them later.
        """
        ctes = []
        for p in self.calendar + LONG:
            ctes.append(f"""
uu_{p} AS (
  SELECT DateHour, {self.key}, CAST(seen AS BIGINT) AS UU{p} FROM (
    SELECT *, lag(seen, 1, 0) OVER (PARTITION BY {self.key} ORDER BY DateHour) AS before FROM (
      SELECT DISTINCT DateHour, {self.key}, count(DISTINCT CustomerKey) OVER (
        PARTITION BY {self.key} ORDER BY DateHour) AS seen
      FROM customer_cube
      WHERE Date >= DATE '{self.start[p]}' AND Date < DATE '{self.base}'))
  WHERE seen > before)""")
        names = [f"uu_{p}" for p in self.calendar + LONG]
        points = " UNION ".join(f"SELECT DateHour, {self.key} FROM {n}" for n in names)
        joins = " ".join(f"LEFT JOIN {n} USING (DateHour, {self.key})" for n in names)
        return "," + ",".join(ctes) + f""",
users AS (
  SELECT DateHour, {self.key}, {', '.join(f'UU{p}' for p in self.calendar + LONG)}
  FROM ({points}) {joins})"""

    def frame(self) -> str:
        """Every hour of the day, and every older hour that has a value, per active key."""
        metrics = ", ".join(f"{m}{p}" for p in self.calendar
                            for m in ("TxCount", "TxVolume", "AvgAge", "AvgTenureByYear"))
        return self.totals() + self.users() + f""",
keys AS (SELECT DISTINCT {self.key} FROM uu_YTD),
hours AS (SELECT unnest(generate_series(TIMESTAMP '{self.day}',
            TIMESTAMP '{self.base}' - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS DateHour),
points AS (
  SELECT DateHour, {self.key} FROM keys, hours
  UNION (SELECT DateHour, {self.key} FROM users SEMI JOIN keys USING ({self.key}))
  UNION SELECT DateHour, {self.key} FROM totals),
frame AS (
  SELECT DateHour, {self.key}, COALESCE(UUHourly, 0) AS UUHourly,
    COALESCE(TxCountHourly, 0) AS TxCountHourly,
    COALESCE(TxVolumeHourly, CAST(0 AS DECIMAL(38,2))) AS TxVolumeHourly,
    AvgAgeHourly, AvgTenureByYearHourly, {metrics},
    {', '.join(f'UU{p}' for p in self.calendar + LONG)}
  FROM points LEFT JOIN totals USING (DateHour, {self.key})
              LEFT JOIN users USING (DateHour, {self.key}))"""

    def filled(self) -> str:
        """Seeds midnight, then carries each value forward to the next hour."""
        seeds, fills = [], []
        for p in self.calendar + LONG:
            metrics = ["UU"] if p in LONG else ["UU", "TxCount", "TxVolume", "AvgAge",
                                                "AvgTenureByYear"]
            for m in metrics:
                name = f"{m}{p}"
                pick = f"arg_max({name}, DateHour)" if m.startswith("Avg") else f"max({name})"
                seed = f"{pick} FILTER (DateHour < TIMESTAMP '{self.day}' AND {name} IS NOT NULL" \
                       f" AND DateHour >= TIMESTAMP '{self.start[p]}')"
                if p == "DTH" or (p in self.calendar and self.start[p] == self.day):
                    seed = "NULL"
                zero = "CAST(0 AS DECIMAL(38,2))" if m == "TxVolume" else "0"
                seeds.append(f"{seed} AS seed_{name}")
                fills.append(
                    f"COALESCE(last_value({name} IGNORE NULLS) OVER (PARTITION BY {self.key} "
                    f"ORDER BY DateHour ROWS UNBOUNDED PRECEDING), seed_{name}, {zero}) AS {name}")
        return self.frame() + f""",
seeds AS (SELECT {self.key}, {', '.join(seeds)} FROM frame GROUP BY {self.key}),
filled AS (
  SELECT DateHour, {self.key}, UUHourly, TxCountHourly, TxVolumeHourly, AvgAgeHourly,
    AvgTenureByYearHourly, {', '.join(fills)}
  FROM (SELECT * FROM frame WHERE DateHour >= TIMESTAMP '{self.day}'
        AND DateHour < TIMESTAMP '{self.base}') JOIN seeds USING ({self.key}))"""

    def compared(self) -> str:
        """Prior counts next to the filled metrics."""
        test = {
            "QTD": f"quarter(DateHour) = quarter(DATE '{self.start['QTD']}')",
            "SemiYTD": "make_date(year(DateHour), (month(DateHour) - 1) // 6 * 6 + 1, 1)"
                       f" = DATE '{self.start['SemiYTD']}'",
            "YTD": f"year(DateHour) = year(DATE '{self.start['YTD']}')",
        } | {p: f"DateHour >= TIMESTAMP '{self.start[p]}'" for p in LONG}
        priors = ", ".join(
            f"max(UU{long}) FILTER (DateHour < TIMESTAMP '{self.start[short]}' AND {test[long]})"
            f" AS {prior(long, short)}"
            for long, short, *_ in PAIRS
        )
        return self.filled() + f""",
priors AS (SELECT {self.key}, {priors} FROM frame GROUP BY {self.key}),
compared AS (SELECT * FROM filled LEFT JOIN priors USING ({self.key}))"""

    # -- pair columns -----------------------------------------------------------

    def contributions(self) -> list[str]:
        return [f"UU{long} - {prior(long, short)} AS HourlyContributerUU{name}"
                for long, short, name, _, _ in PAIRS]

    def retained(self) -> list[str]:
        out = []
        for long, short, _, name, _ in PAIRS:
            used = "3YTD" if short == "2YTD" and self.retained_2ytd == "as_written" else short
            out.append(f"UU{used} - UU{long} + {prior(long, short)} AS Hourly{name}")
        return out

    def rates(self) -> list[str]:
        return [
            f"COALESCE(CAST(UU{short} - UU{long} + {prior(long, short)} AS DOUBLE) / "
            f"NULLIF({prior(long, short)}, 0), 0) AS HourlyRetentionRate{name}"
            for long, short, _, _, name in PAIRS
        ]

    def metrics(self) -> list[str]:
        own = [f"{m}{p}" for p in self.calendar
               for m in ("UU", "TxCount", "TxVolume", "AvgAge", "AvgTenureByYear")]
        return ["UUHourly", "TxCountHourly", "TxVolumeHourly", "AvgAgeHourly",
                "AvgTenureByYearHourly", *own, *[f"UU{p}" for p in LONG]]

    # -- queries ----------------------------------------------------------------

    def select(self, stage: str, table: str, columns, where: str = "") -> str:
        return f"{stage}\nSELECT DateHour, {self.key}, {', '.join(columns)} FROM {table} {where}"

    def whole(self, where: str = "") -> str:
        columns = self.metrics() + self.contributions() + self.retained() + self.rates()
        return self.select(self.compared(), "compared", columns, where)


def period_starts(launch: str) -> str:
    """Period starts by truncating the reported day, for every order date."""
    def first(months: int) -> str:
        into = f"CAST((month(day) - 1) % {months} AS INT)"
        return f"CAST(date_trunc('month', day) - to_months({into}) AS DATE)"

    return f"""
WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS BaseDay,
  CAST(CAST(o_orderdate AS DATE) - 1 AS DATE) AS day FROM orders)
SELECT BaseDay, day AS StartDTH, {first(1)} AS StartMTD, {first(2)} AS Start2MTD,
  {first(3)} AS StartQTD, {first(6)} AS StartSemiYTD, {first(12)} AS StartYTD,
  CAST({first(12)} - INTERVAL 1 YEAR AS DATE) AS Start2YTD,
  CAST({first(12)} - INTERVAL 2 YEAR AS DATE) AS Start3YTD,
  DATE '{launch}' AS StartFeatureLaunchedTD
FROM days"""


def hour_spine() -> str:
    return f"""
WITH {ORDERS},
bounds AS (SELECT min(CAST(CreatedAt AS DATE)) AS a, max(CAST(CreatedAt AS DATE)) AS b
           FROM transactions)
SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) + INTERVAL 1 DAY,
  INTERVAL 1 HOUR)) AS DateHour FROM bounds"""
