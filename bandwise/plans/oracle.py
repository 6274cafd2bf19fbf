"""DuckDB SQL for the registered queries (the correctness oracle).

Each query is an independent SQL text over the TESTDATA views. The fixture
CTEs below restate ``sources/fixtures.py`` in SQL; dialect notes: DuckDB
rounds when casting DOUBLE to INT (so ``trunc`` first), returns BIGINT for
date parts, and reads decimal literals as DECIMAL (so doubles are spelled
``CAST(x AS DOUBLE)``).
"""

from __future__ import annotations

from bandwise.functions.scoring import band_key, band_label

# Fixed values, spelled out here again so that a wrong entry in the code under test shows.
_HOLIDAY_SQL = {
    "name": """
    WHEN '1-1' THEN 'NewYear'
    WHEN '5-2' THEN 'ChineseDay'
    WHEN '8-4' THEN 'Chakri'
    WHEN '13-4' THEN 'Songkran'
    WHEN '14-4' THEN 'Songkran'
    WHEN '15-4' THEN 'Songkran'
    WHEN '16-4' THEN 'Songkran'
    WHEN '1-5' THEN 'Labour'
    WHEN '6-5' THEN 'King'
    WHEN '9-5' THEN 'Ploughing'
    WHEN '3-6' THEN 'Queen'
    WHEN '12-8' THEN 'Mother'
    WHEN '14-10' THEN 'King9Passing'
    WHEN '23-10' THEN 'Chulalongkorn'
    WHEN '5-12' THEN 'King9'
    WHEN '10-12' THEN 'Constitution'
    WHEN '24-12' THEN 'BeforeChristmas'
    WHEN '25-12' THEN 'Christmas'
    WHEN '30-12' THEN 'NewYearEve'
    WHEN '31-12' THEN 'NewYearEve'""",
    "type": """
    WHEN '1-1' THEN 'National'
    WHEN '5-2' THEN 'Regional'
    WHEN '8-4' THEN 'National'
    WHEN '13-4' THEN 'National'
    WHEN '14-4' THEN 'National'
    WHEN '15-4' THEN 'National'
    WHEN '16-4' THEN 'National'
    WHEN '1-5' THEN 'National'
    WHEN '6-5' THEN 'National'
    WHEN '9-5' THEN 'Goverment'
    WHEN '3-6' THEN 'National'
    WHEN '12-8' THEN 'Public'
    WHEN '14-10' THEN 'National'
    WHEN '23-10' THEN 'National'
    WHEN '5-12' THEN 'Public'
    WHEN '10-12' THEN 'National'
    WHEN '24-12' THEN 'Public'
    WHEN '25-12' THEN 'Public'
    WHEN '30-12' THEN 'National'
    WHEN '31-12' THEN 'National'""",
}
_WELFARE_LOW_SQL = "'2019-5', '2019-6', '2020-10', '2020-11', '2020-12', '2021-1'"
_TIER_SQL = "WHEN 'T1' THEN '1' WHEN 'T2' THEN '2' WHEN 'T3' THEN '3' WHEN 'T4' THEN '4' ELSE '5'"
_BANDS = [
    (0, 0), (1, 1), (2, 2), (3, 3), (4, 6), (7, 10), (11, 15), (16, 25), (26, 40),
    (41, 60), (61, 100), (101, 200), (201, 400), (401, 700), (701, 1200), (1201, 1800), (1801, 3000),
]

FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "sales": (
        (),
        """
  SELECT d.SalDate, d.BranchCode, d.MaterialCode, d.TotalQtySale, d.avgPrice, d.avgPriceDis, d.totalNetSale,
         p.p_retailprice AS supPrice, CAST(day(d.SalDate) AS INTEGER) AS DayofMonth, d.TotalQtySale AS label
  FROM (
    SELECT CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS SalDate,
           CAST(l_suppkey AS INTEGER) AS BranchCode, CAST(l_partkey AS INTEGER) AS MaterialCode,
           CAST(trunc(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(0 AS DOUBLE) ELSE l_quantity END)) AS INTEGER)
             AS TotalQtySale,
           ROUND(AVG(l_extendedprice / l_quantity) + 1e-7, 4) AS avgPrice,
           ROUND(AVG(l_extendedprice * (1 - l_discount) / l_quantity) + 1e-7, 4) AS avgPriceDis,
           ROUND(SUM(l_extendedprice * (1 - l_discount)) + 1e-7, 4) AS totalNetSale
    FROM lineitem GROUP BY 1, 2, 3) d
  LEFT JOIN part p ON CAST(p.p_partkey AS INTEGER) = d.MaterialCode""",
    ),
    "scored": (
        ("sales",),
        """
  SELECT *, pred_lv1 * pred_lv2 AS pred_final FROM (
    SELECT *, CASE WHEN MaterialCode % 5 > 0 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS pred_lv1,
           CAST(TotalQtySale AS DOUBLE) * CAST(0.9 AS DOUBLE) + CAST(1 AS DOUBLE) AS pred_lv2
    FROM sales) s""",
    ),
    "sales_monthly": (
        ("sales",),
        """
  SELECT CAST(date_trunc('month', SalDate) AS DATE) AS SalDate, BranchCode,
         CAST(SUM(TotalQtySale) AS INTEGER) AS TotalQtySale, CAST(SUM(TotalQtySale) AS INTEGER) AS label
  FROM sales GROUP BY 1, 2""",
    ),
    "sales_yearly": (
        ("sales",),
        """
  SELECT CAST(date_trunc('year', SalDate) AS DATE) AS SalDate, BranchCode,
         CAST(SUM(TotalQtySale) AS INTEGER) AS TotalQtySale, CAST(SUM(TotalQtySale) AS INTEGER) AS label
  FROM sales GROUP BY 1, 2""",
    ),
    "categories": (
        (),
        """
  SELECT pr.BranchCode, pr.SalDate, pr.MaterialCode, pr.promotion, w.ProvinceEN, w.DistrictEN, w.ZipCode
  FROM (SELECT CAST(l_shipdate + INTERVAL 20 YEAR AS DATE) AS SalDate, CAST(l_suppkey AS INTEGER) AS BranchCode,
               CAST(l_partkey AS INTEGER) AS MaterialCode, MIN(l_returnflag) AS promotion
        FROM lineitem GROUP BY 1, 2, 3) pr
  LEFT JOIN (SELECT CAST(s_suppkey AS INTEGER) AS BranchCode, n_name AS ProvinceEN, s_name AS DistrictEN,
                    10000 + s_nationkey AS ZipCode
             FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey) w
  ON pr.BranchCode = w.BranchCode""",
    ),
    "sales_raw_text": (
        ("sales",),
        """
  SELECT CAST(SalDate AS VARCHAR) AS SalDate, CAST(BranchCode AS VARCHAR) AS BranchCode,
         CAST(MaterialCode AS VARCHAR) AS MaterialCode,
         CASE MaterialCode % 97 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '3.7'
              ELSE CAST(TotalQtySale AS VARCHAR) END AS TotalQtySale,
         CASE MaterialCode % 97 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '3.7'
              ELSE CAST(avgPrice AS VARCHAR) END AS avgPrice,
         CAST(avgPriceDis AS VARCHAR) AS avgPriceDis, CAST(totalNetSale AS VARCHAR) AS totalNetSale,
         CASE MaterialCode % 97 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '3.7'
              ELSE CAST(supPrice AS VARCHAR) END AS supPrice,
         CAST(DayofMonth AS VARCHAR) AS DayofMonth, CAST(label AS VARCHAR) AS label
  FROM sales""",
    ),
    "price_sensitivity": (
        (),
        """
  SELECT CAST(CASE WHEN l_partkey % 4 = 0 THEN -l_suppkey ELSE l_suppkey END AS INTEGER) AS Branch,
         CAST(l_partkey AS INTEGER) AS MaterialCode, ROUND(AVG(l_discount) + 1e-7, 4) AS f0_
  FROM lineitem GROUP BY 1, 2""",
    ),
    "tier": (
        (),
        """
  SELECT CAST(CASE WHEN l_partkey % 5 = 0 THEN -l_suppkey ELSE l_suppkey END AS INTEGER) AS BranchCode,
         CAST(l_partkey AS INTEGER) AS MaterailCode,
         CAST(year(CAST(l_shipdate + INTERVAL 20 YEAR AS DATE)) AS INTEGER) AS CALYEAR,
         CAST(month(CAST(l_shipdate + INTERVAL 20 YEAR AS DATE)) AS INTEGER) AS CALMONTH,
         'T' || MIN(substr(o_orderpriority, 1, 1)) AS Tier
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY 1, 2, 3, 4""",
    ),
    "welfare_branches": (
        (),
        """
  SELECT CAST(s_suppkey AS INTEGER) AS branchcode FROM supplier WHERE s_suppkey % 4 = 0""",
    ),
    "store_location_raw": (
        (),
        """
  SELECT CAST(s_suppkey AS INTEGER) AS code,
         5 + (s_suppkey * 37 % 160) / CAST(10 AS DOUBLE) AS lat,
         97 + (s_suppkey * 53 % 80) / CAST(10 AS DOUBLE) AS lng
  FROM supplier""",
    ),
    "stations": (
        (),
        """
  SELECT n_nationkey AS usaf, n_name AS name,
         5 + (n_nationkey * 61 % 160) / CAST(10 AS DOUBLE) AS lat,
         97 + (n_nationkey * 29 % 80) / CAST(10 AS DOUBLE) AS lon,
         CASE WHEN n_nationkey % 3 <> 0 THEN 'TH' ELSE 'XX' END AS country
  FROM nation""",
    ),
    "weather": (
        (),
        """
  SELECT CAST(user_id % 30 AS INTEGER) AS stn, CAST(ts AS DATE) AS date,
         ROUND(AVG(value) + 1e-7, 4) AS temp, MAX(value) AS "max", MIN(value) AS "min"
  FROM events GROUP BY 1, 2""",
    ),
}


def with_fixtures(body: str, *names: str) -> str:
    """``WITH <fixture CTEs in dependency order> <extra CTEs/SELECT>``.

    ``body`` either starts with ``SELECT`` or with further ``name AS (...)``
    CTE definitions followed by the final SELECT.
    """
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in FIXTURES[n][0]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n][1]}\n)" for n in order)
    body = body.strip()
    if body.upper().startswith("SELECT"):
        return f"WITH {ctes}\n{body}"
    return f"WITH {ctes},\n{body}"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def bands_values(bands=None) -> str:
    bands = _BANDS if bands is None else bands
    rows = ", ".join(
        f"({i + 1}, {sql_str(band_label(lo, hi))}, {sql_str(band_key(lo, hi))}, {lo}, {hi})"
        for i, (lo, hi) in enumerate(bands)
    )
    return f"SELECT * FROM (VALUES {rows}) AS t(band_id, Range, bounds, lower, upper)"


def band_case(col: str, bands=None) -> str:
    bands = _BANDS if bands is None else bands
    whens = " ".join(f"WHEN {col} BETWEEN {lo} AND {hi} THEN {i + 1}" for i, (lo, hi) in enumerate(bands))
    return f"CASE {whens} END"


def holiday_case(key: str, which: str) -> str:
    return f"COALESCE(CASE {key} {_HOLIDAY_SQL[which]} END, 'Normal')"


def welfare_case(key: str) -> str:
    return f"CASE WHEN {key} IN ({_WELFARE_LOW_SQL}) THEN '500' ELSE '700' END"


def tier_case(col: str) -> str:
    return f"CASE {col} {_TIER_SQL} END"


def r6(expr: str) -> str:
    """Registered queries round computed doubles to 6 places (see plans/registry.py)."""
    return f"ROUND(({expr}) + 1e-9, 6)"


def _calendar_sql() -> str:
    dm = "CAST(day(SalDate) AS VARCHAR) || '-' || CAST(month(SalDate) AS VARCHAR)"
    return f"""
  SELECT *, CAST(year(SalDate) AS INTEGER) AS YYYY, CAST(month(SalDate) AS INTEGER) AS MMMM,
         CAST(day(SalDate) AS INTEGER) AS DDDD, {dm} AS "DDDD-MMMM",
         CAST(year(SalDate) AS VARCHAR) || '-' || CAST(month(SalDate) AS VARCHAR) AS "YYYY-MMMM",
         CAST(year(SalDate) AS INTEGER) AS YY, CAST(month(SalDate) AS INTEGER) AS MM,
         {holiday_case(dm, 'name')} AS Holiday, {holiday_case(dm, 'type')} AS HolidayType
  FROM sales"""


def _dist(a: str, b: str) -> str:
    return f"sqrt(({a}.lat - {b}.lat) * ({a}.lat - {b}.lat) + ({a}.lng - {b}.lon) * ({a}.lng - {b}.lon))"


FIXTURES.update(
    {
        "calendar": (("sales",), _calendar_sql()),
        "store_location": (("store_location_raw",), "\n  SELECT code AS BranchCode, lat, lng FROM store_location_raw"),
        "latest_weather": (
            ("weather", "stations"),
            """
  WITH w AS (
    SELECT weather.*, s.name, s.lat, s.lon
    FROM weather LEFT JOIN stations s ON stn = usaf
    WHERE year(date) = 2024 AND stn IN (SELECT DISTINCT usaf FROM stations WHERE country = 'TH'))
  SELECT * FROM w a WHERE a.date = (SELECT MAX(date) FROM w b WHERE b.name = a.name)""",
        ),
        "branch_weather": (
            ("store_location", "latest_weather"),
            f"""
  SELECT BranchCode, name, temp, dis_store FROM (
    SELECT s.BranchCode, w.name, w.temp, {_dist("s", "w")} AS dis_store,
           row_number() OVER (PARTITION BY s.BranchCode ORDER BY {_dist("s", "w")}, w.name) AS rk
    FROM store_location s, latest_weather w) t
  WHERE rk = 1""",
        ),
        "features": (
            ("calendar", "price_sensitivity", "tier", "welfare_branches", "branch_weather"),
            f"""
  SELECT c.SalDate, c.BranchCode, c.MaterialCode, c.TotalQtySale, c.avgPrice, c.avgPriceDis, c.totalNetSale,
         c.supPrice, c.DayofMonth, c.label, c.YYYY AS Year, c.MMMM AS Month, c.DDDD AS Day, c."DDDD-MMMM",
         c."YYYY-MMMM", c.YY, c.MM, c.Holiday, c.HolidayType, ps.BC2, ps.MC2, ps.Price_Sensitivity,
         t.BC3, t.MC3, t.CALYEAR, t.CALMONTH, t.Tier, {tier_case("t.Tier")} AS TierNumeric,
         {welfare_case('c."YYYY-MMMM"')} AS Welfare,
         CASE WHEN wf.branchcode IS NOT NULL THEN '1' ELSE '0' END AS welfareFlag,
         CASE WHEN c.DDDD IN (1, 2, 3, 4, 5) THEN '1' ELSE '0' END AS welfareFlagDay,
         bw.name, bw.temp
  FROM calendar c
  LEFT JOIN (SELECT Branch AS BC2, MaterialCode AS MC2, f0_ AS Price_Sensitivity FROM price_sensitivity) ps
    ON c.BranchCode = ps.BC2 AND c.MaterialCode = ps.MC2
  LEFT JOIN (SELECT BranchCode AS BC3, MaterailCode AS MC3, CALYEAR, CALMONTH, Tier FROM tier) t
    ON c.BranchCode = t.BC3 AND c.MaterialCode = t.MC3 AND c.YY = t.CALYEAR AND c.MM = t.CALMONTH
  LEFT JOIN (SELECT DISTINCT branchcode FROM welfare_branches) wf ON c.BranchCode = wf.branchcode
  LEFT JOIN branch_weather bw ON c.BranchCode = bw.BranchCode""",
        ),
        "binary_features": (
            ("calendar", "welfare_branches"),
            """
  SELECT c.SalDate, c.BranchCode, c.MaterialCode, c.TotalQtySale, c.avgPrice, c.avgPriceDis, c.totalNetSale,
         c.supPrice, c.label, c.YYYY AS Year, z.ZipCode,
         CASE WHEN wf.branchcode IS NOT NULL THEN '1' ELSE '0' END AS welfareFlag,
         CASE WHEN c.DDDD IN (1, 2, 3, 4, 5) THEN '1' ELSE '0' END AS welfareFlagDay
  FROM calendar c
  LEFT JOIN (SELECT DISTINCT branchcode FROM welfare_branches) wf ON c.BranchCode = wf.branchcode
  LEFT JOIN (SELECT CAST(s_suppkey AS INTEGER) AS BranchCode, 10000 + s_nationkey AS ZipCode FROM supplier) z
    ON c.BranchCode = z.BranchCode""",
        ),
        "dow_profile": (
            ("sales",),
            """
  SELECT p.*, m.MostSalesUnitFreq FROM (
    SELECT BranchCode, MaterialCode, CAST(dayofweek(SalDate) + 1 AS INTEGER) AS DoW_Num,
           CAST(COUNT(*) AS INTEGER) AS Total_Bill_Dow, CAST(SUM(TotalQtySale) AS BIGINT) AS Total_SumQTY_Dow,
           AVG(TotalQtySale) AS AVG_SumQTY_Dow, CAST(MEDIAN(TotalQtySale) AS DOUBLE) AS MED_SumQTY_Dow,
           COALESCE(STDDEV_SAMP(TotalQtySale), CASE WHEN COUNT(TotalQtySale) = 1 THEN CAST(0 AS DOUBLE) END) AS SD_SumQTY_Dow,
           CAST(COUNT(DISTINCT CASE WHEN TotalQtySale > 0 THEN date_trunc('week', SalDate) END) AS INTEGER)
             AS NumWeekSale
    FROM sales GROUP BY 1, 2, 3) p
  JOIN (
    SELECT BranchCode, MaterialCode, DoW_Num, CAST(TotalQtySale AS DOUBLE) AS MostSalesUnitFreq FROM (
      SELECT BranchCode, MaterialCode, DoW_Num, TotalQtySale,
             row_number() OVER (PARTITION BY BranchCode, MaterialCode, DoW_Num ORDER BY n DESC, TotalQtySale) AS rk
      FROM (SELECT BranchCode, MaterialCode, CAST(dayofweek(SalDate) + 1 AS INTEGER) AS DoW_Num, TotalQtySale,
                   COUNT(*) AS n
            FROM sales GROUP BY 1, 2, 3, 4) c) r
    WHERE rk = 1) m
  USING (BranchCode, MaterialCode, DoW_Num)""",
        ),
        "dow_features": (
            ("binary_features", "dow_profile"),
            """
  SELECT b.*, p.DoW_Num, p.Total_Bill_Dow, p.Total_SumQTY_Dow, p.AVG_SumQTY_Dow, p.MED_SumQTY_Dow,
         p.SD_SumQTY_Dow, p.NumWeekSale, p.MostSalesUnitFreq,
         CAST(p.NumWeekSale >= 2 AS INTEGER) AS HighQualityFlag
  FROM binary_features b
  JOIN dow_profile p ON b.BranchCode = p.BranchCode AND b.MaterialCode = p.MaterialCode
   AND CAST(dayofweek(b.SalDate) + 1 AS INTEGER) = p.DoW_Num""",
        ),
    }
)
