"""Parameters of the pipeline (a plain object instead of a YAML file).

The constants in the "fixed values" blocks must equal the published data
dictionary and the reference configuration for results to line up.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Sentinel codes that mean "not available" in the origination file.
# MI_Canc_Indicator: only '7' is treated as missing ('9' is kept as a value).
ORIGINATION_SENTINELS = {
    "Credit_Score": 9999,
    "MI_Percentage": 999,
    "Num_Units": 99,
    "CLTV": 999,
    "DTI": 999,
    "LTV": 999,
    "Num_Borrowers": 99,
    "First_Time_Home_Buyer_Flag": "9",
    "Occupancy_Status": "9",
    "Channel": "9",
    "Property_Type": "99",
    "ZIP_Code": "00",
    "Loan_Purpose": "9",
    "Program_Indicator": "9",
    "Property_Val_Meth": "9",
    "MI_Canc_Indicator": "7",
}
# Sentinel in the performance file.
PERFORMANCE_SENTINELS = {"ELTV": 999}
# Flags whose null means 'N'.
ORIGINATION_FLAG_DEFAULTS = ["Sup_Conforming_Flag", "Ref_Indicator"]
PERFORMANCE_FLAG_DEFAULTS = ["Delinquency_Disaster_Flag", "Modification_Flag"]
# Property valuation method codes.
PROPERTY_VAL_METH_CODES = {"1": "AC", "2": "A", "3": "O", "4": "ACP"}
# Zero-balance codes that count as a default event; code of defective loans.
DEFAULT_ZERO_BALANCE_CODES = ["02", "03", "09", "15"]
DEFECT_ZERO_BALANCE_CODE = "96"
# Delinquency status at or above this string (string order) is a default.
DEFAULT_STATUS_FLOOR = "3"
# Statuses of a performing loan at the observation date.
PERFORMING_STATUSES = ["0", "1", "2"]

# Feature lists of the development sample.
MORTGAGE_COLUMNS = [
    "Loan_Num", "Month", "Default", "Credit_Score", "First_Time_Home_Buyer_Flag", "MI_Percentage",
    "Occupancy_Status", "CLTV", "DTI", "Log_UPB", "LTV", "Int_Rate", "Channel", "Prepay_Penalty",
    "Amortization_Type", "Property_Type", "Loan_Purpose", "Num_Borrowers", "Sup_Conforming_Flag",
    "Property_Val_Meth", "Int_Only_Indicator", "Log_Curr_UPB", "Current_Delinquency_Status",
    "Modification_Flag", "Current_Int_Rate", "Log_Non_Int_Bear_UPB", "Step_Modification_Flag",
    "Payment_Deferral_Flag", "ELTV", "Delinquency_Disaster_Flag", "Borrower_Assistance_Status_Code",
    "Max_Delinq_Severity_yoy", "Num_Modifications_yoy", "Delinq_Status_0_Count",
    "Delinq_Status_1_Count", "Delinq_Status_2_Count", "Payment_Ratio", "Balance_Per_Month",
    "Maturity_Progress", "ZIP_Default_Rate",
]
ECONOMIC_COLUMNS = [
    "Unemp_Rate", "Log_Median_Ann_Income", "Infl_Rate", "US_30yr_FRM", "US_30yr_FRM_Orig",
    "HPI_Change_Orig", "HPI_Change_yoy", "Int_Rate_Diff", "Curr_Int_Rate_Diff",
]

# One-hot encodings (value, label) per categorical column.
CATEGORICAL_MAPPINGS = {
    "Occupancy_Status": [("P", "Primary Res."), ("I", "Investment"), ("S", "Second Home")],
    "Channel": [("R", "Retail"), ("C", "Correspondent"), ("B", "Broker"), ("T", "TPO")],
    "Amortization_Type": [("R", "FRM"), ("C", "ARM")],
    "Property_Type": [("CO", "Condominium"), ("MH", "Manufactured House"),
                      ("SF", "Single-Family Home"), ("PU", "PDU"), ("CP", "Cooperative Share")],
    "Loan_Purpose": [("P", "Purchase"), ("C", "Cash-out Refinance"),
                     ("N", "No Cash-Out Refinance"), ("R", "Refinance No Specified")],
    "Property_Val_Meth": [("AC", "ACE Loan"), ("A", "Full Appraisal"), ("O", "Other Appraisal"),
                          ("ACP", "ACE + PDR"), ("R", "GSE Refinance")],
    "Borrower_Assistance_Status_Code": [("F", "Forbearance"), ("R", "Repayment"),
                                        ("T", "Trial Period")],
    "Modification_Flag": [("Y", "Yes"), ("P", "Prev. Period")],
}
# The Y/N columns.
YN_COLUMNS = ["First_Time_Home_Buyer_Flag", "Prepay_Penalty", "Sup_Conforming_Flag",
              "Step_Modification_Flag", "Delinquency_Disaster_Flag"]
# Names given to the missing indicators of two columns.
MISSING_INDICATOR_NAMES = {"Credit_Score": "Credit_Score <= 300",
                           "MI_Percentage": "MI_Percentage not in 1-55"}
# Columns with which default becomes likelier, and less likely.
RISK_RISES_WITH = ["CLTV", "DTI", "LTV", "Int_Rate", "Delinquency_Status"]
RISK_FALLS_WITH = ["Credit_Score"]
# Columns never encoded as thresholds (keys and target).
ENCODER_KEY_COLUMNS = ["Loan_Num", "Month", "Default"]


@dataclass
class Settings:
    """Pipeline parameters; defaults follow the reference configuration."""
    quarters: list = field(default_factory=lambda: [(2015, 1), (2015, 2), (2015, 3), (2015, 4)])
    train_obs_dates: list = field(default_factory=lambda: ["2021-03", "2021-06", "2021-09", "2021-12"])
    test_obs_dates: list = field(default_factory=lambda: ["2022-03", "2022-06"])
    train_size: int | None = 1_500_000
    test_size: int | None = 3_000_000
    seed: int | None = 2001
    num_thresholds: int = 20
    dev_columns: list = field(default_factory=lambda: list(MORTGAGE_COLUMNS))
    economic_columns: list = field(default_factory=lambda: list(ECONOMIC_COLUMNS))
    categorical_mappings: dict = field(default_factory=lambda: dict(CATEGORICAL_MAPPINGS))
    yn_columns: list = field(default_factory=lambda: list(YN_COLUMNS))
    rf_num_trees: int = 200
    rf_max_depth: int = 7
    rf_balanced: bool = True
    sparse_max_support: int = 40
    sparse_num_lambda: int = 150
    sparse_scale_down: float = 0.8
