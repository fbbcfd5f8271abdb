"""The fixture derivation and the pipeline stages as DuckDB SQL (the oracle side).

Each entry of ``CTES`` is one named common table expression; ``sql(select, *names)``
emits a WITH clause holding the named CTEs and everything they depend on.
The trailing-window features are written here as self-joins on calendar dates
(``Month > t - INTERVAL 12 MONTH``), an independent formulation of the Spark
month-index frames.
"""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


# --- raw and cleaned performance ------------------------------------------------------
cte("perf_raw", """
SELECT CAST(l_partkey AS VARCHAR) AS Loan_Num, Month,
  CAST(s_upb AS DOUBLE) AS Current_Actual_UPB,
  CASE WHEN r >= 3 THEN 'RA' WHEN r = 2 THEN (CASE WHEN mnl = 1 THEN '12' ELSE '3' END)
       WHEN r = 1 THEN (CASE WHEN mnl <= 3 THEN '1' ELSE '2' END) ELSE '0' END AS Current_Delinquency_Status,
  CAST(mxl AS INTEGER) AS Loan_Age,
  CAST(n - 1 AS INTEGER) AS Months_to_Maturity,
  CASE WHEN mxt >= 0.08 THEN 'Y' END AS Modification_Flag,
  CASE WHEN l_partkey % 97 = 0 AND mnq <= 2 THEN '96' WHEN mnq >= 49 THEN '03'
       WHEN mnq >= 48 THEN '01' END AS Zero_Balance_Code,
  mxt * CAST(100.0 AS DOUBLE) AS Current_Int_Rate,
  CAST(s_q AS DOUBLE) AS Current_Non_Int_UPB,
  CASE WHEN mxq >= 50 THEN 'Y' WHEN mxq >= 45 THEN 'N' END AS Step_Modification_Flag,
  CASE WHEN mnt = 0 THEN 'Y' ELSE 'N' END AS Payment_Deferral_Flag,
  CASE WHEN mxd >= 0.1 THEN CAST(999.0 AS DOUBLE) ELSE mxd * CAST(1000.0 AS DOUBLE) END AS ELTV,
  CASE WHEN mnd = 0 THEN 'Y' END AS Delinquency_Disaster_Flag,
  CASE WHEN mxl = 7 THEN 'F' WHEN mxl = 6 THEN 'R' WHEN mxl = 5 THEN 'T' END AS Borrower_Assistance_Status_Code
FROM (
  SELECT l_partkey, strftime(l_shipdate, '%Y%m') AS Month,
    SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS s_upb,
    SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r,
    MIN(l_linenumber) AS mnl, MAX(l_linenumber) AS mxl, MIN(l_quantity) AS mnq, MAX(l_quantity) AS mxq,
    MAX(l_tax) AS mxt, MIN(l_tax) AS mnt, MAX(l_discount) AS mxd, MIN(l_discount) AS mnd,
    COUNT(*) AS n, SUM(CAST(l_quantity AS DECIMAL(18,2))) AS s_q
  FROM lineitem GROUP BY 1, 2) g
""")

cte("perf", """
SELECT Loan_Num, last_day(CAST(strptime(Month, '%Y%m') AS DATE)) AS Month, Current_Actual_UPB,
  Current_Delinquency_Status, Loan_Age, Months_to_Maturity,
  COALESCE(Modification_Flag, 'N') AS Modification_Flag, Zero_Balance_Code, Current_Int_Rate,
  Current_Non_Int_UPB, Step_Modification_Flag, Payment_Deferral_Flag,
  CASE WHEN ELTV = 999 THEN NULL ELSE ELTV END AS ELTV,
  COALESCE(Delinquency_Disaster_Flag, 'N') AS Delinquency_Disaster_Flag, Borrower_Assistance_Status_Code
FROM perf_raw
""")

# --- raw and cleaned origination ------------------------------------------------------
cte("orig_raw", """
SELECT
  CASE WHEN p_size = 50 THEN 9999 ELSE p_size * 6 + 500 END AS Credit_Score,
  '1996' || lpad(CAST(p_partkey % 12 + 1 AS VARCHAR), 2, '0') AS First_Payment_Month,
  CASE p_partkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN '9' END AS First_Time_Home_Buyer_Flag,
  '202612' AS Maturity_Date, CAST(NULL AS VARCHAR) AS Metropolitan_Area,
  CASE WHEN p_size % 7 = 0 THEN CAST(999 AS DOUBLE) ELSE CAST(p_size % 40 AS DOUBLE) END AS MI_Percentage,
  CAST(CASE WHEN p_partkey % 50 = 0 THEN 99 ELSE p_partkey % 3 + 1 END AS INTEGER) AS Num_Units,
  CASE p_partkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'I' WHEN 2 THEN 'S' WHEN 3 THEN '9' END AS Occupancy_Status,
  CASE WHEN p_size % 10 = 0 THEN CAST(999 AS DOUBLE) ELSE CAST(p_size + 45 AS DOUBLE) END AS CLTV,
  CASE WHEN p_size % 13 = 0 THEN CAST(999 AS DOUBLE) ELSE CAST(p_size % 45 + 10 AS DOUBLE) END AS DTI,
  p_retailprice * CAST(1000.0 AS DOUBLE) AS UPB,
  CASE WHEN p_size % 10 = 0 THEN CAST(999 AS DOUBLE) ELSE CAST(p_size + 40 AS DOUBLE) END AS LTV,
  CAST(p_size AS DOUBLE) / CAST(20.0 AS DOUBLE) + CAST(2.5 AS DOUBLE) AS Int_Rate,
  CASE p_partkey % 5 WHEN 0 THEN 'R' WHEN 1 THEN 'C' WHEN 2 THEN 'B' WHEN 3 THEN 'T' WHEN 4 THEN '9' END AS Channel,
  CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS Prepay_Penalty,
  CASE WHEN p_partkey % 6 = 0 THEN 'C' ELSE 'R' END AS Amortization_Type,
  CASE p_partkey % 5 WHEN 0 THEN '1-URGENT' WHEN 1 THEN '2-HIGH' WHEN 2 THEN '3-MEDIUM'
       WHEN 3 THEN '4-NOT SPECIFIED' WHEN 4 THEN '5-LOW' END AS Property_State,
  CASE p_partkey % 6 WHEN 0 THEN 'CO' WHEN 1 THEN 'MH' WHEN 2 THEN 'SF' WHEN 3 THEN 'PU'
       WHEN 4 THEN 'CP' WHEN 5 THEN '99' END AS Property_Type,
  CASE WHEN p_partkey % 25 = 0 THEN '00' ELSE lpad(CAST(p_partkey % 25 AS VARCHAR), 3, '0') || '00' END AS ZIP_Code,
  CAST(p_partkey AS VARCHAR) AS Loan_Num,
  CASE p_partkey % 5 WHEN 0 THEN 'P' WHEN 1 THEN 'C' WHEN 2 THEN 'N' WHEN 3 THEN 'R' WHEN 4 THEN '9' END AS Loan_Purpose,
  CAST(360 - (p_partkey % 3) * 120 AS INTEGER) AS Loan_Term,
  CAST(CASE WHEN p_size = 1 THEN 99 ELSE p_size % 2 + 1 END AS INTEGER) AS Num_Borrowers,
  p_brand AS Seller_Name, p_brand AS Servicer_Name,
  CASE WHEN p_size > 45 THEN 'Y' END AS Sup_Conforming_Flag, CAST(NULL AS VARCHAR) AS Pre_Ref_Loan_Num,
  CASE WHEN p_size % 9 = 0 THEN '9' ELSE 'H' END AS Program_Indicator,
  CASE WHEN p_size % 3 = 0 THEN 'Y' END AS Ref_Indicator,
  CASE WHEN p_partkey % 11 = 0 THEN '9' ELSE CAST(p_partkey % 5 AS VARCHAR) END AS Property_Val_Meth,
  CASE WHEN p_partkey % 7 = 0 THEN 'Y' ELSE 'N' END AS Int_Only_Indicator,
  CASE p_partkey % 3 WHEN 0 THEN '7' WHEN 1 THEN '9' WHEN 2 THEN 'N' END AS MI_Canc_Indicator,
  2015 AS Year, CAST(p_partkey % 4 + 1 AS INTEGER) AS Quarter
FROM part
""")

cte("orig", """
SELECT NULLIF(Credit_Score, 9999) AS Credit_Score,
  last_day(CAST(strptime(First_Payment_Month, '%Y%m') AS DATE)) AS First_Payment_Month,
  NULLIF(First_Time_Home_Buyer_Flag, '9') AS First_Time_Home_Buyer_Flag, Maturity_Date, Metropolitan_Area,
  NULLIF(MI_Percentage, 999) AS MI_Percentage, NULLIF(Num_Units, 99) AS Num_Units,
  NULLIF(Occupancy_Status, '9') AS Occupancy_Status, NULLIF(CLTV, 999) AS CLTV, NULLIF(DTI, 999) AS DTI,
  UPB, NULLIF(LTV, 999) AS LTV, Int_Rate, NULLIF(Channel, '9') AS Channel, Prepay_Penalty,
  Amortization_Type, Property_State, NULLIF(Property_Type, '99') AS Property_Type,
  NULLIF(substring(ZIP_Code, 1, 3), '00') AS ZIP_Code, Loan_Num, NULLIF(Loan_Purpose, '9') AS Loan_Purpose,
  Loan_Term, NULLIF(Num_Borrowers, 99) AS Num_Borrowers, Seller_Name, Servicer_Name,
  COALESCE(Sup_Conforming_Flag, 'N') AS Sup_Conforming_Flag, Pre_Ref_Loan_Num, NULLIF(Program_Indicator, '9') AS Program_Indicator,
  COALESCE(Ref_Indicator, 'N') AS Ref_Indicator,
  CASE NULLIF(Property_Val_Meth, '9') WHEN '1' THEN 'AC' WHEN '2' THEN 'A' WHEN '3' THEN 'O' WHEN '4' THEN 'ACP'
       ELSE NULLIF(Property_Val_Meth, '9') END AS Property_Val_Meth,
  Int_Only_Indicator, NULLIF(MI_Canc_Indicator, '7') AS MI_Canc_Indicator, Year, Quarter
FROM orig_raw
""")

# --- labels and trailing features -----------------------------------------------------
cte("perf_cd", """
SELECT *, CAST(COALESCE(Current_Delinquency_Status >= '3', false)
               OR COALESCE(Zero_Balance_Code IN ('02', '03', '09', '15'), false) AS INTEGER) AS Current_Default,
  CASE WHEN Current_Delinquency_Status = 'RA' THEN 999 ELSE CAST(Current_Delinquency_Status AS INTEGER) END AS sev
FROM perf
""")

cte("fwd", """
SELECT *,
  MAX(Current_Default) OVER (PARTITION BY Loan_Num ORDER BY Month ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS "Default",
  COUNT(*) OVER (PARTITION BY Loan_Num ORDER BY Month ROWS BETWEEN 1 FOLLOWING AND 12 FOLLOWING) AS n_next,
  MAX(CASE WHEN Zero_Balance_Code = '96' THEN 1 ELSE 0 END) OVER (PARTITION BY Loan_Num) AS defect
FROM perf_cd
""")

cte("trail", """
SELECT p.Loan_Num, p.Month,
  MAX(q.sev) AS max_sev,
  CAST(SUM(CASE WHEN q.Modification_Flag = 'Y' THEN 1 ELSE 0 END) AS INTEGER) AS Num_Modifications_yoy,
  CAST(SUM(CASE WHEN q.Current_Delinquency_Status = '0' THEN 1 WHEN q.Current_Delinquency_Status IS NULL THEN NULL ELSE 0 END) AS INTEGER) AS Delinq_Status_0_Count,
  CAST(SUM(CASE WHEN q.Current_Delinquency_Status = '1' THEN 1 WHEN q.Current_Delinquency_Status IS NULL THEN NULL ELSE 0 END) AS INTEGER) AS Delinq_Status_1_Count,
  CAST(SUM(CASE WHEN q.Current_Delinquency_Status = '2' THEN 1 WHEN q.Current_Delinquency_Status IS NULL THEN NULL ELSE 0 END) AS INTEGER) AS Delinq_Status_2_Count
FROM perf_cd p JOIN perf_cd q
  ON q.Loan_Num = p.Loan_Num AND q.Month > CAST(p.Month - INTERVAL 12 MONTH AS DATE) AND q.Month <= p.Month
GROUP BY p.Loan_Num, p.Month
""")

cte("labelled", """
SELECT f.Loan_Num, f.Month, f.Current_Actual_UPB, f.Current_Delinquency_Status, f.Loan_Age,
  f.Months_to_Maturity, f.Modification_Flag, f.Zero_Balance_Code, f.Current_Int_Rate, f.Current_Non_Int_UPB,
  f.Step_Modification_Flag, f.Payment_Deferral_Flag, f.ELTV, f.Delinquency_Disaster_Flag,
  f.Borrower_Assistance_Status_Code, f.Current_Default, f."Default",
  CASE WHEN t.max_sev = 999 THEN 'RA' ELSE CAST(t.max_sev AS VARCHAR) END AS Max_Delinq_Severity_yoy,
  t.Num_Modifications_yoy, t.Delinq_Status_0_Count, t.Delinq_Status_1_Count, t.Delinq_Status_2_Count
FROM fwd f JOIN trail t ON t.Loan_Num = f.Loan_Num AND t.Month = f.Month
WHERE f.n_next = 12 AND f.defect = 0
""")

cte("joined", """
SELECT l.*, o.Credit_Score, o.First_Payment_Month, o.First_Time_Home_Buyer_Flag, o.MI_Percentage, o.Num_Units,
  o.Occupancy_Status, o.CLTV, o.DTI, o.UPB, o.LTV, o.Int_Rate, o.Channel, o.Prepay_Penalty, o.Amortization_Type,
  o.Property_State, o.Property_Type, o.ZIP_Code, o.Loan_Purpose, o.Loan_Term, o.Num_Borrowers,
  o.Sup_Conforming_Flag, o.Program_Indicator, o.Ref_Indicator, o.Property_Val_Meth, o.Int_Only_Indicator,
  o.MI_Canc_Indicator, o.Year, o.Quarter,
  (o.UPB - l.Current_Actual_UPB) / o.UPB AS Payment_Ratio,
  CASE WHEN l.Months_to_Maturity = 0 THEN
       CASE WHEN l.Current_Actual_UPB > 0 THEN CAST('inf' AS DOUBLE) WHEN l.Current_Actual_UPB < 0 THEN CAST('-inf' AS DOUBLE)
            ELSE CAST('nan' AS DOUBLE) END
       ELSE l.Current_Actual_UPB / l.Months_to_Maturity END AS Balance_Per_Month,
  CAST(l.Loan_Age AS DOUBLE) / CAST(o.Loan_Term AS DOUBLE) AS Maturity_Progress,
  log10(o.UPB + 1) AS Log_UPB, log10(l.Current_Actual_UPB + 1) AS Log_Curr_UPB,
  log10(l.Current_Non_Int_UPB + 1) AS Log_Non_Int_Bear_UPB
FROM labelled l JOIN orig o ON o.Loan_Num = l.Loan_Num
""")

cte("zagg", """
SELECT Year, Quarter, ZIP_Code, Month, SUM("Default") AS s, COUNT(*) AS n FROM joined GROUP BY ALL
""")

cte("zrate", """
SELECT a.Year, a.Quarter, a.ZIP_Code, a.Month,
  CAST(SUM(b.s) AS DOUBLE) / CAST(SUM(b.n) AS DOUBLE) AS ZIP_Default_Rate
FROM zagg a JOIN zagg b
  ON b.Year = a.Year AND b.Quarter = a.Quarter AND b.ZIP_Code IS NOT DISTINCT FROM a.ZIP_Code
 AND b.Month > CAST(a.Month - INTERVAL 12 MONTH AS DATE) AND b.Month <= a.Month
GROUP BY ALL
""")

cte("panel", """
SELECT j.* REPLACE (CASE WHEN j."Default" = 0 THEN -1 WHEN j."Default" = 1 THEN 1 END AS "Default"),
  z.ZIP_Default_Rate
FROM joined j JOIN zrate z
  ON z.Year = j.Year AND z.Quarter = j.Quarter AND z.ZIP_Code IS NOT DISTINCT FROM j.ZIP_Code AND z.Month = j.Month
""")

# --- economic series ------------------------------------------------------------------
cte("income_raw", """
SELECT strftime(o_orderdate, '%Y-%m') AS Month, o_orderpriority AS State,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS Median_Ann_Income
FROM orders WHERE month(o_orderdate) = 5 GROUP BY 1, 2
""")

cte("income_base", """
SELECT last_day(CAST(strptime(Month, '%Y-%m') AS DATE)) AS Month, State, Median_Ann_Income FROM income_raw
""")

cte("income", """
SELECT g.State, g.Month,
  last_value(b.Median_Ann_Income IGNORE NULLS) OVER (PARTITION BY g.State ORDER BY g.Month
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS Median_Ann_Income
FROM (SELECT State, last_day(CAST(d AS DATE)) AS Month FROM (
        SELECT State, unnest(generate_series(date_trunc('month', min(Month)), date_trunc('month', max(Month)),
                                             INTERVAL 1 MONTH)) AS d
        FROM income_base GROUP BY State)) g
LEFT JOIN income_base b ON b.State = g.State AND b.Month = g.Month
""")

cte("unemp_raw", """
SELECT strftime(o_orderdate, '%Y-%m') AS Month, o_custkey % 25 AS zip,
  CAST(COUNT(*) AS DOUBLE) / CAST(10.0 AS DOUBLE) AS unemp_rate
FROM orders GROUP BY 1, 2
""")

cte("unemp", """
SELECT last_day(CAST(strptime(Month, '%Y-%m') AS DATE)) AS Month,
  CASE WHEN length(CAST(zip AS VARCHAR)) >= 3 THEN CAST(zip AS VARCHAR) ELSE lpad(CAST(zip AS VARCHAR), 3, '0') END AS ZIP_Code,
  unemp_rate AS Unemp_Rate
FROM unemp_raw
""")

cte("infl_raw", """
SELECT year(o_orderdate) AS Year, 'M' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS Period,
  CAST(COUNT(*) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS Value
FROM orders GROUP BY 1, 2
UNION ALL
SELECT year(o_orderdate) AS Year, CASE WHEN month(o_orderdate) <= 6 THEN 'S01' ELSE 'S02' END AS Period,
  CAST(COUNT(*) AS DOUBLE) / CAST(600.0 AS DOUBLE) AS Value
FROM orders GROUP BY 1, 2
""")

cte("infl", """
SELECT last_day(make_date(CAST(Year AS INTEGER), CAST(substring(Period, 2, 2) AS INTEGER), 1)) AS Month,
  Value AS Infl_Rate
FROM infl_raw WHERE Period NOT IN ('S01', 'S02')
""")

cte("hpi_raw", """
SELECT o_custkey % 25 AS zip, year(o_orderdate) AS Year, quarter(o_orderdate) AS Quarter,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS idx
FROM orders GROUP BY 1, 2, 3
""")

cte("hpi_base", """
SELECT last_day(make_date(CAST(Year AS INTEGER), CAST(Quarter * 3 AS INTEGER), 1)) AS Month,
  lpad(CAST(zip AS VARCHAR), 3, '0') AS ZIP_Code, idx AS HP_Index
FROM hpi_raw
""")

cte("hpi", """
SELECT g.ZIP_Code, g.Month,
  last_value(b.HP_Index IGNORE NULLS) OVER (PARTITION BY g.ZIP_Code ORDER BY g.Month
     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS HP_Index
FROM (SELECT ZIP_Code, last_day(CAST(d AS DATE)) AS Month FROM (
        SELECT ZIP_Code, unnest(generate_series(date_trunc('month', min(Month)), date_trunc('month', max(Month)),
                                                INTERVAL 1 MONTH)) AS d
        FROM hpi_base GROUP BY ZIP_Code)) g
LEFT JOIN hpi_base b ON b.ZIP_Code = g.ZIP_Code AND b.Month = g.Month
""")

cte("rate_raw", """
SELECT CAST(o_orderdate AS DATE) AS Date,
  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) / CAST(50000.0 AS DOUBLE) AS US_30yr_FRM
FROM orders GROUP BY 1
""")

cte("rate", """
SELECT last_day(Date) AS Month, arg_max(US_30yr_FRM, Date) AS US_30yr_FRM FROM rate_raw GROUP BY 1
""")

# --- sampling ---------------------------------------------------------------------------
TRAIN_DATES = ["1997-03", "1997-06", "1997-09", "1997-12"]
TEST_DATES = ["1998-03", "1998-06"]


def _month_list(dates):
    return ", ".join(f"last_day(DATE '{d}-01')" for d in dates)


cte("obs", f"""
SELECT * FROM panel
WHERE Month IN ({_month_list(TRAIN_DATES + TEST_DATES)})
  AND Zero_Balance_Code IS NULL AND Current_Delinquency_Status IN ('0', '1', '2')
""")


def sampled_cte(name: str, dates: list, n: int | None, seed: int) -> None:
    if n is None:
        cte(name, f"SELECT * FROM obs WHERE Month IN ({_month_list(dates)})")
        return
    cte(name, f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY Year, Quarter, Month
      ORDER BY md5(concat_ws('|', Loan_Num, CAST(Month AS VARCHAR), '{seed}')), Loan_Num) AS rn
  FROM obs WHERE Month IN ({_month_list(dates)})) WHERE rn <= {n}
""")


def sql(select: str, *names: str) -> str:
    """WITH clause holding ``names`` and their dependencies (in dependency order)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES:
            if dep != n and re.search(rf"\b{re.escape(dep)}\b", CTES[n]):
                visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n" + select
