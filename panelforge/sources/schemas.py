"""Explicit schemas of the two loan-level text files and the economic series.

Fixed values: the column names, their order in the ``|``-separated files and their
types must equal the published file layout for the scans to line up.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _D = T.StringType(), T.IntegerType(), T.DoubleType()

# Origination file layout, in file order.
ORIGINATION_COLUMNS = [
    ("Credit_Score", _I), ("First_Payment_Month", _S), ("First_Time_Home_Buyer_Flag", _S),
    ("Maturity_Date", _S), ("Metropolitan_Area", _S), ("MI_Percentage", _D), ("Num_Units", _I),
    ("Occupancy_Status", _S), ("CLTV", _D), ("DTI", _D), ("UPB", _D), ("LTV", _D),
    ("Int_Rate", _D), ("Channel", _S), ("Prepay_Penalty", _S), ("Amortization_Type", _S),
    ("Property_State", _S), ("Property_Type", _S), ("ZIP_Code", _S), ("Loan_Num", _S),
    ("Loan_Purpose", _S), ("Loan_Term", _I), ("Num_Borrowers", _I), ("Seller_Name", _S),
    ("Servicer_Name", _S), ("Sup_Conforming_Flag", _S), ("Pre_Ref_Loan_Num", _S),
    ("Program_Indicator", _S), ("Ref_Indicator", _S), ("Property_Val_Meth", _S),
    ("Int_Only_Indicator", _S), ("MI_Canc_Indicator", _S),
]

# Monthly performance file layout, in file order.
PERFORMANCE_COLUMNS = [
    ("Loan_Num", _S), ("Month", _S), ("Current_Actual_UPB", _D),
    ("Current_Delinquency_Status", _S), ("Loan_Age", _I), ("Months_to_Maturity", _I),
    ("Defect_Settlement_Date", _S), ("Modification_Flag", _S), ("Zero_Balance_Code", _S),
    ("Zero_Balance_Effective_Date", _S), ("Current_Int_Rate", _D), ("Current_Non_Int_UPB", _D),
    ("DDLPI", _S), ("MI_Recoveries", _D), ("Net_Sale_Proceeds", _D), ("Non_MI_Recoveries", _D),
    ("Total_Expenses", _D), ("Legal_Costs", _D), ("Maintenance_And_Preservation_Costs", _D),
    ("Taxes_And_Insurance", _D), ("Miscellaneous_Expenses", _D), ("Actual_Loss", _D),
    ("Cum_Modification_Cost", _D), ("Step_Modification_Flag", _S), ("Payment_Deferral_Flag", _S),
    ("ELTV", _D), ("Zero_Bal_Removal_UPB", _D), ("Delinquent_Accrued_Int", _D),
    ("Delinquency_Disaster_Flag", _S), ("Borrower_Assistance_Status_Code", _S),
    ("Curr_Month_Modification_Cost", _D), ("Curr_Int_UPB", _D),
]


def _struct(cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


ORIGINATION_SCHEMA = _struct(ORIGINATION_COLUMNS)
PERFORMANCE_SCHEMA = _struct(PERFORMANCE_COLUMNS)

# Economic series as they arrive (raw column names of the published files).
INCOME_SCHEMA = T.StructType([
    T.StructField("_idx", T.LongType()), T.StructField("Month", _S),
    T.StructField("State", _S), T.StructField("Median_Ann_Income", _D)])
UNEMPLOYMENT_SCHEMA = T.StructType([
    T.StructField("Month", _S), T.StructField("zip", T.LongType()),
    T.StructField("unemp_rate", _D)])
INFLATION_SCHEMA = T.StructType([
    T.StructField("Year", T.LongType()), T.StructField("Period", _S), T.StructField("Value", _D)])
HPI_SCHEMA = T.StructType([
    T.StructField("ZIP Code", T.LongType()), T.StructField("Year", T.LongType()),
    T.StructField("Quarter", T.LongType()), T.StructField("Index", _D)])
RATE_SCHEMA = T.StructType([
    T.StructField("Date", T.DateType()), T.StructField("US_30yr_FRM", _D)])
