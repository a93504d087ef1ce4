"""Loan-specific names and values. No operator refers to them except as a default or argument.

Everything in this file is a fixed value: column names of the loan data, category lists,
cut points and defaults that results depend on.
"""

from __future__ import annotations

# Texts read as missing.
NULL_TOKENS = ["", "null", "NULL", "None", "none", "NaN", "nan"]

# Loan period kept and the split years.
START_DATE = "2014-01-01"
END_DATE = "2017-12-31"
TRAIN_YEARS = [2014, 2015, 2016]
TEST_YEAR = 2017
TRAIN_SHARE = 0.80
TRAIN_SAMPLE = 200_000
VAL_SAMPLE = 50_000
SEED = 42

TARGET = "charged_off"
POSITIVE_STATUS = "Charged Off"
NEGATIVE_STATUS = "Fully Paid"
CLASS_LABELS = {0: "Fully Paid", 1: "Charged Off"}

MISSING_THRESHOLD = 0.30

# Numeric fields of the raw loans.
NUMERIC_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "installment", "annual_inc", "dti", "delinq_2yrs",
    "fico_range_low", "fico_range_high", "inq_last_6mths", "mths_since_last_delinq",
    "mths_since_last_record", "open_acc", "pub_rec", "revol_bal", "total_acc", "out_prncp",
    "out_prncp_inv", "total_pymnt", "total_pymnt_inv", "total_rec_prncp", "total_rec_int",
    "total_rec_late_fee", "recoveries", "collection_recovery_fee", "last_pymnt_amnt",
    "last_fico_range_high", "last_fico_range_low", "collections_12_mths_ex_med",
    "mths_since_last_major_derog", "policy_code", "annual_inc_joint", "dti_joint", "acc_now_delinq",
    "tot_coll_amt", "tot_cur_bal", "open_acc_6m", "open_act_il", "open_il_12m", "open_il_24m",
    "mths_since_rcnt_il", "total_bal_il", "il_util", "open_rv_12m", "open_rv_24m", "max_bal_bc",
    "all_util", "total_rev_hi_lim", "inq_fi", "total_cu_tl", "inq_last_12m", "acc_open_past_24mths",
    "avg_cur_bal", "bc_open_to_buy", "bc_util", "chargeoff_within_12_mths", "delinq_amnt",
    "mo_sin_old_il_acct", "mo_sin_old_rev_tl_op", "mo_sin_rcnt_rev_tl_op", "mo_sin_rcnt_tl",
    "mort_acc", "mths_since_recent_bc", "mths_since_recent_bc_dlq", "mths_since_recent_inq",
    "mths_since_recent_revol_delinq", "num_accts_ever_120_pd", "num_actv_bc_tl", "num_actv_rev_tl",
    "num_bc_sats", "num_bc_tl", "num_il_tl", "num_op_rev_tl", "num_rev_accts", "num_rev_tl_bal_gt_0",
    "num_sats", "num_tl_120dpd_2m", "num_tl_30dpd", "num_tl_90g_dpd_24m", "num_tl_op_past_12m",
    "pct_tl_nvr_dlq", "percent_bc_gt_75", "pub_rec_bankruptcies", "tax_liens", "tot_hi_cred_lim",
    "total_bal_ex_mort", "total_bc_limit", "total_il_high_credit_limit", "revol_bal_joint",
    "sec_app_fico_range_low", "sec_app_fico_range_high", "sec_app_inq_last_6mths",
    "sec_app_mort_acc", "sec_app_open_acc", "sec_app_revol_util", "sec_app_open_act_il",
    "sec_app_num_rev_accts", "sec_app_chargeoff_within_12_mths",
    "sec_app_collections_12_mths_ex_med", "deferral_term", "hardship_amount", "hardship_length",
    "hardship_dpd", "orig_projected_additional_accrued_interest", "hardship_payoff_balance_amount",
    "hardship_last_payment_amount",
]

# Known only after the loan has closed.
LEAKAGE_COLUMNS = [
    "last_pymnt_amnt", "last_pymnt_d", "total_pymnt", "total_pymnt_inv", "total_rec_prncp",
    "total_rec_int", "total_rec_late_fee", "out_prncp", "out_prncp_inv", "hardship_flag",
    "recoveries", "collection_recovery_fee", "last_credit_pull_d", "last_fico_range_low",
    "last_fico_range_high", "debt_settlement_flag", "debt_settlement_flag_date",
    "settlement_status", "settlement_date", "settlement_amount", "settlement_percentage",
    "settlement_term",
]

# Identifiers, free text, near-copies and constants.
UNINFORMATIVE_COLUMNS = [
    "id", "member_id", "url", "desc", "title", "emp_title", "zip_code", "policy_code", "pymnt_plan",
    "funded_amnt", "funded_amnt_inv", "next_pymnt_d", "installment", "disbursement_method",
    "application_type", "Unnamed: 0", "unnamed_0", "grade", "tax_liens", "acc_now_delinq",
    "num_sats", "delinq_amnt", "num_tl_30dpd", "chargeoff_within_12_mths",
    "collections_12_mths_ex_med", "num_tl_120dpd_2m",
]

# One column of each strongly correlated pair.
CORRELATED_COLUMNS = [
    "fico_range_high", "total_bal_ex_mort", "tot_hi_cred_lim", "num_bc_tl", "num_rev_tl_bal_gt_0",
    "num_bc_sats", "percent_bc_gt_75", "mo_sin_old_il_acct", "avg_cur_bal", "total_bc_limit",
    "bc_util", "num_op_rev_tl", "num_actv_bc_tl",
]

EMP_LENGTH_ORDINALS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}

# Impossible values, set to NULL: column, condition.
IMPOSSIBLE_VALUES = {
    "dti": "dti < 0",
    "annual_inc": "annual_inc < 0",
    "open_acc": "open_acc < 0",
    "revol_util": "revol_util > 200",
}

# Consistency rules: label, columns needed, condition.
CONSISTENCY_RULES = [
    ("funded_amnt > loan_amnt", ["funded_amnt", "loan_amnt"], "funded_amnt > loan_amnt"),
    ("fico_range_low > fico_range_high", ["fico_range_low", "fico_range_high"], "fico_range_low > fico_range_high"),
    ("dti < 0", ["dti"], "dti < 0"),
    ("annual_inc < 0", ["annual_inc"], "annual_inc < 0"),
    ("open_acc < 0", ["open_acc"], "open_acc < 0"),
]

SUB_GRADES = [f"{letter}{number}" for letter in "ABCDEFG" for number in range(1, 6)]

# Feature groups.
SKEWED_COLUMNS = [
    "bc_open_to_buy", "annual_inc", "revol_bal", "tot_cur_bal", "total_rev_hi_lim", "dti",
    "inq_last_6mths", "num_accts_ever_120_pd", "pub_rec_bankruptcies", "loan_to_income",
    "monthly_payment_to_income", "delinq_rate", "credit_history_months",
]
BINARIZED_COLUMNS = ["tot_coll_amt", "num_tl_90g_dpd_24m", "pub_rec", "delinq_2yrs"]
CAPPED_COLUMNS = ["dti"]
CAP_QUANTILE = 0.99
MISSING_FLAG_COLUMNS = ["mths_since_recent_inq"]
ORDINAL_COLUMNS = {"sub_grade": SUB_GRADES}
ONE_HOT_COLUMNS = ["home_ownership", "verification_status", "purpose", "addr_state", "initial_list_status"]
RARE_COLUMNS = ["purpose", "home_ownership"]
RARE_THRESHOLD = 50
RARE_LABEL = "other"

# Macro series.
NATIONAL_SERIES = ["UNRATE", "FEDFUNDS", "CPIAUCSL"]
STATE_SERIES = {"CA": "CAUR", "TX": "TXUR", "NY": "NYUR", "FL": "FLUR", "IL": "ILUR"}
MACRO_FEATURES = [
    "UNRATE", "FEDFUNDS", "CPIAUCSL", "CPI_YOY", "state_unrate", "real_int_rate", "rate_spread",
]
LOW_RATE_LIMIT = 0.5
LOW_RATE_LABEL = "low rate (<=0.5%)"
HIGH_RATE_LABEL = "high rate (>0.5%)"
UNEMPLOYMENT_FALLBACK = 5.0

# Scoring: allowed values.
VALID_TERMS = [36, 60]
VALID_HOME_OWNERSHIP = ["ANY", "MORTGAGE", "NONE", "OTHER", "OWN", "RENT"]
VALID_VERIFICATION = ["Not Verified", "Source Verified", "Verified"]

# Scoring: inputs that must be given, and defaults of those that may be left out.
REQUIRED_INPUTS = [
    "loan_amnt", "term", "int_rate", "sub_grade", "annual_inc", "dti", "fico_score", "home_ownership",
    "purpose",
]
INPUT_DEFAULTS = {
    "open_acc": 10, "revol_util": 30.0, "total_acc": 20, "delinq_2yrs": 0, "pub_rec": 0,
    "inq_last_6mths": 0, "verification_status": "Not Verified", "earliest_cr_line": "2010-01",
}

# Scoring: values of the columns an applicant does not state.
SECONDARY_DEFAULTS = {
    "acc_open_past_24mths": 4.0, "mo_sin_old_rev_tl_op": 130.0, "mo_sin_rcnt_rev_tl_op": 12.0,
    "mo_sin_rcnt_tl": 8.0, "mort_acc": 1.0, "mths_since_recent_bc": 18.0,
    "mths_since_recent_inq": None, "num_actv_rev_tl": 5.0, "num_il_tl": 8.0, "num_rev_accts": 12.0,
    "num_tl_op_past_12m": 2.0, "pct_tl_nvr_dlq": 94.0, "total_il_high_credit_limit": 25000.0,
    "bc_open_to_buy": 5000.0, "revol_bal": 10000.0, "tot_cur_bal": 60000.0,
    "total_rev_hi_lim": 25000.0, "tot_coll_amt": 0.0, "num_tl_90g_dpd_24m": 0.0,
    "pub_rec_bankruptcies": 0.0, "num_accts_ever_120_pd": 0.0, "addr_state": "CA",
    "initial_list_status": "w", "emp_length": 5.0,
}

# Scoring: upper bound of the probability, level, tier, decision; the last has no bound.
RISK_TIERS = [
    (0.15, 1, "Very Low", "Approve"),
    (0.25, 2, "Low", "Approve"),
    (0.35, 3, "Moderate", "Review"),
    (0.50, 4, "High", "Decline"),
    (None, 5, "Very High", "Decline"),
]
HIGH_RISK_FROM = 0.35

# Ready applicant profiles.
SCENARIOS = {
    "Safe (A2, FICO 760)": {
        "loan_amnt": 8000.0, "term": 36, "int_rate": 6.5, "sub_grade": "A2", "purpose": "credit_card",
        "annual_inc": 95000.0, "dti": 8.0, "fico_score": 760, "home_ownership": "MORTGAGE",
        "verification_status": "Source Verified", "open_acc": 12, "revol_util": 12.0,
        "total_acc": 28, "delinq_2yrs": 0, "pub_rec": 0, "inq_last_6mths": 0,
        "earliest_cr_line": "2002-05",
    },
    "Borderline (C3, FICO 690)": {
        "loan_amnt": 18000.0, "term": 60, "int_rate": 14.5, "sub_grade": "C3",
        "purpose": "debt_consolidation", "annual_inc": 55000.0, "dti": 22.0, "fico_score": 690,
        "home_ownership": "RENT", "verification_status": "Verified", "open_acc": 8,
        "revol_util": 55.0, "total_acc": 18, "delinq_2yrs": 0, "pub_rec": 0, "inq_last_6mths": 1,
        "earliest_cr_line": "2009-08",
    },
    "Risky (E4, FICO 620)": {
        "loan_amnt": 32000.0, "term": 60, "int_rate": 24.5, "sub_grade": "E4",
        "purpose": "small_business", "annual_inc": 38000.0, "dti": 31.0, "fico_score": 620,
        "home_ownership": "RENT", "verification_status": "Not Verified", "open_acc": 6,
        "revol_util": 88.0, "total_acc": 12, "delinq_2yrs": 2, "pub_rec": 1, "inq_last_6mths": 4,
        "earliest_cr_line": "2012-11",
    },
}
