"""Fixed values that results depend on.

FIXED VALUES - these must stay equal to the behaviour being reproduced
(channel names and effectiveness, default costs, scenario margins, band edges
and labels, thresholds).  They are listed here plainly, in natural order.
"""

from __future__ import annotations

# ---- FIXED VALUES: outreach channels, in tie-break order --------------------
EMAIL = "Automated Email"
REP_CALL = "Rep Call + 5% Waiver"
SENIOR_CALL = "Senior Call + 10% Waiver"
SLEEPING_DOG = "Flagged: Sleeping Dog"
CHANNELS = (EMAIL, REP_CALL, SENIOR_CALL)
EFFECTIVENESS = {EMAIL: 0.5, REP_CALL: 0.8, SENIOR_CALL: 1.0}
ACTIONS = (EMAIL, REP_CALL, SENIOR_CALL, SLEEPING_DOG)

# ---- FIXED VALUES: default operating assumptions -----------------------------
COST_SENIOR = 40.0
COST_REP = 15.0
COST_EMAIL = 0.10
REP_WAIVER_RATE = 0.05      # share of monthly spend waived on a rep call
SENIOR_WAIVER_RATE = 0.10   # share of monthly spend waived on a senior call
DEFAULT_MARGIN = 0.025
DEFAULT_LOYALTY = 0.0
DEFAULT_CAPACITY = 100
DEFAULT_MANUAL_WEIGHT = 50
WEIGHT_STEP = 2

# ---- FIXED VALUES: margin scenarios (name, margin) ---------------------------
SCENARIOS = (
    ("Low Margin (1.5%)", 0.015),
    ("Base Margin (2.5%)", 0.025),
    ("High Margin (3.5%)", 0.035),
)

# ---- FIXED VALUES: decision thresholds ----------------------------------------
DOG_RISK = 0.85          # risk strictly above
DOG_INACTIVE = 4         # months inactive at least
DOG_CT_CHANGE = 0.4      # count change strictly below
AT_RISK = 0.5            # risk strictly above counts as at-risk
FAIRNESS_AGE_GAP = 3.0   # alert when mean ages differ by more than this
OBJECTIVE_EPS = 1e-9

# ---- FIXED VALUES: tenure bands, right-closed (lo, hi] -----------------------
TENURE_BANDS = (
    (0, 24, "New (<2y)"),
    (24, 36, "2-3y"),
    (36, 48, "3-4y"),
    (48, 100, "Loyal (4y+)"),
)

# ---- FIXED VALUES: churn label and model inputs -------------------------------
CHURNED_LABEL = "Attrited Customer"
DROP_COLUMNS = (
    "CLIENTNUM",
    "Naive_Bayes_Classifier_Attrition_Flag_Card_Category_Contacts_Count_12_mon_Dependent_count_Education_Level_Months_Inactive_12_mon_1",
    "Naive_Bayes_Classifier_Attrition_Flag_Card_Category_Contacts_Count_12_mon_Dependent_count_Education_Level_Months_Inactive_12_mon_2",
)
FEATURES = (
    "Customer_Age", "Credit_Limit", "Total_Revolving_Bal", "Total_Trans_Amt",
    "Total_Trans_Ct", "Months_Inactive_12_mon", "Total_Relationship_Count",
    "Total_Ct_Chng_Q4_Q1", "Total_Amt_Chng_Q4_Q1", "Avg_Utilization_Ratio",
    "Contacts_Count_12_mon", "Months_on_book",
)
RF_TREES = 150
RF_DEPTH = 8
SEED = 42
TEST_FRACTION = 0.2

# ---- FIXED VALUES: scenario export columns, in output order ------------------
SCENARIO_COLUMNS = (
    "Scenario", "Scenario_Interchange_Pct", "Optimal_Risk_Weight_Pct", "Recommended_Allocation",
    "Customer_ID", "Recommended_Action", "In_Target_List", "Priority_Rank",
    "Churn_Risk_Score", "Churn_Risk_Pct", "Total_Account_Value", "Value_At_Stake",
    "Net_ROI", "Save_Prob", "Is_Sleeping_Dog",
    "Card_Tier", "Tenure_Band", "Customer_Age", "Months_on_book",
    "Total_Relationship_Count", "Total_Trans_Amt", "Total_Trans_Ct", "Months_Inactive_12_mon",
)
