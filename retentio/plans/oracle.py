"""Oracle SQL (DuckDB) for the registered queries, keyed like ``catalog.QUERIES``.

Written as plain SQL over the raw tables, independently of the DataFrame
code.  Literals are in ``e0`` form so DuckDB computes in double like Spark;
``round_even(x * 10^d, 0) / 10^d`` matches Spark's ``rint`` rounding; where
Spark uses ``try_divide`` (null on a zero divisor) the SQL guards the
divisor, since DuckDB returns inf/NaN there.
"""

from __future__ import annotations

from retentio.constants import FEATURES, SCENARIOS
from retentio.plans.oracle_base import with_members

K = 100
MANUAL_W = 50
FEATURES_SQL = ("Customer_Age, Credit_Limit, Total_Revolving_Bal, Total_Trans_Amt, Total_Trans_Ct, "
                "Months_Inactive_12_mon, Total_Relationship_Count, Total_Ct_Chng_Q4_Q1, "
                "Total_Amt_Chng_Q4_Q1, Avg_Utilization_Ratio, Contacts_Count_12_mon, Months_on_book")


def _scen(scenarios) -> str:
    vals = ", ".join(f"('{n}', {m!r}e0)" if "e" not in repr(m) else f"('{n}', {m!r})"
                     for n, m in scenarios)
    return f"scen(Scenario, margin) as (values {vals})"


def _dec_ctes(scenarios, loyalty: float = 0.0) -> tuple[str, ...]:
    """Decision chain D1-D7 + normalised value for the given scenarios."""
    tgt = "tn" if loyalty >= 0 else "(1 - tn)"
    weight = f"1e0 + {abs(float(loyalty))!r}e0*0.5e0*{tgt}" if loyalty else "1e0"
    return (
        _scen(scenarios),
        """d1 as (
  select m.*, s.Scenario, s.margin,
    m.Total_Trans_Amt * s.margin as Annual_Margin,
    least(6e0, greatest(1e0, m.Months_on_book/12)) as Expected_Retention_Years,
    1e0 + (m.Total_Relationship_Count - 1)/5*0.5e0 as Relationship_Multiplier,
    m.Card_Category as Segment,
    least(1e0, greatest(0.1e0, 1 - m.Months_Inactive_12_mon/6)) as reach,
    least(1e0, greatest(0.1e0, m.Total_Ct_Chng_Q4_Q1)) as respond
  from members m cross join scen s)""",
        """d2 as (
  select *, Annual_Margin * Expected_Retention_Years as CLV,
    Annual_Margin * Expected_Retention_Years * Relationship_Multiplier as Total_Account_Value,
    least(0.85e0, greatest(0.05e0, 0.10e0 + 0.70e0*(0.5e0*reach + 0.5e0*respond))) as Save_Prob,
    (Churn_Risk_Score > 0.85e0 and Months_Inactive_12_mon >= 4 and Total_Ct_Chng_Q4_Q1 < 0.4e0) as Is_Sleeping_Dog
  from d1)""",
        """d3 as (
  select *, Total_Account_Value * Churn_Risk_Score as Value_At_Stake from d2)""",
        """d4 as (
  select *,
    Value_At_Stake * Save_Prob * 0.5e0 - 0.1e0 as ROI_Email,
    Value_At_Stake * Save_Prob * 0.8e0 - (15e0 + Total_Trans_Amt/12*0.05e0) as ROI_Rep,
    Value_At_Stake * Save_Prob * 1e0 - (40e0 + Total_Trans_Amt/12*0.1e0) as ROI_Senior
  from d3)""",
        """d5 as (
  select *, greatest(ROI_Email, ROI_Rep, ROI_Senior) as best_roi,
    case when ROI_Email = greatest(ROI_Email, ROI_Rep, ROI_Senior) then 'Automated Email'
         when ROI_Rep = greatest(ROI_Email, ROI_Rep, ROI_Senior) then 'Rep Call + 5% Waiver'
         else 'Senior Call + 10% Waiver' end as best_channel
  from d4)""",
        """d6 as (
  select *,
    case when Is_Sleeping_Dog then 'Flagged: Sleeping Dog' when best_roi > 0 then best_channel
         else 'Automated Email' end as Recommended_Action,
    case when Is_Sleeping_Dog then 0e0 when best_roi > 0 then best_roi else ROI_Email end as Net_ROI,
    case when Is_Sleeping_Dog then 0e0 else Value_At_Stake * Save_Prob end as Expected_Value_Saved
  from d5)""",
        """pop as (
  select Scenario, min(Months_on_book) pop_min_mob, max(Months_on_book) pop_max_mob,
         max(Total_Account_Value) pop_max_value
  from d6 group by Scenario)""",
        """dec0 as (
  select d6.*,
    case when pop.pop_max_mob - pop.pop_min_mob = 0 then 0e0
         else (Months_on_book - pop.pop_min_mob)/(pop.pop_max_mob - pop.pop_min_mob) end as tn,
    case when pop.pop_max_value = 0 then null else Total_Account_Value / pop.pop_max_value end
      as Normalized_Value
  from d6 join pop using (Scenario))""",
        f"""dec as (
  select *, {weight} as Loyalty_Weight from dec0)""",
    )


def _prio(w: str) -> str:
    return (f"case when Is_Sleeping_Dog then -1e0 else (Churn_Risk_Score*{w}/100 "
            f"+ Normalized_Value*(100-{w})/100)*Loyalty_Weight end")


SWEEP_CTES = (
    "wts as (select range as w from range(0, 101, 2))",
    f"""sx as (
  select d.Scenario, d.member_key, d.Churn_Risk_Score, d.Net_ROI, wts.w, {_prio('wts.w')} as p
  from dec d cross join wts)""",
    f"""topk as (
  select * from (select *, row_number() over (partition by Scenario, w order by p desc nulls last, member_key) rn
                 from sx) where rn <= {K})""",
    """curve as (
  select Scenario, cast(w as integer) Risk_Weight_Pct,
    round_even(cast(sum(cast(Net_ROI as decimal(38,8))) as double)*10000e0, 0)/10000e0 Captured_Net_ROI,
    cast(count(*) filter (where Churn_Risk_Score > 0.5e0) as bigint) At_Risk_Reached
  from topk group by Scenario, w)""",
    """obj as (
  select *, 0.5e0*((Captured_Net_ROI - min(Captured_Net_ROI) over s)
                    /(max(Captured_Net_ROI) over s - min(Captured_Net_ROI) over s + 1e-9))
          + 0.5e0*((At_Risk_Reached - min(At_Risk_Reached) over s)
                    /(max(At_Risk_Reached) over s - min(At_Risk_Reached) over s + 1e-9)) as Objective
  from curve window s as (partition by Scenario))""",
    """best as (
  select Scenario, Risk_Weight_Pct as Optimal_Risk_Weight_Pct, Objective as Best_Objective from (
    select *, row_number() over (partition by Scenario order by Objective desc, Risk_Weight_Pct) rn
    from obj) where rn = 1)""",
)

TABLE_CTES = (
    f"""ranked as (
  select dec.*, best.Optimal_Risk_Weight_Pct, {_prio('best.Optimal_Risk_Weight_Pct')} as Priority_Score
  from dec join best using (Scenario))""",
    """scored as (
  select *, cast(row_number() over (partition by Scenario order by Priority_Score desc nulls last, member_key)
                 as bigint) as Priority_Rank
  from ranked)""",
    f"""tab as (
  select Scenario, margin*100e0 as Scenario_Interchange_Pct, Optimal_Risk_Weight_Pct,
    printf('%d%% Risk / %d%% Value', Optimal_Risk_Weight_Pct, 100 - Optimal_Risk_Weight_Pct) as Recommended_Allocation,
    printf('M%05d', member_key) as Customer_ID, Recommended_Action, Priority_Rank <= {K} as In_Target_List,
    Priority_Rank, Churn_Risk_Score, round_even(Churn_Risk_Score*100e0*10e0, 0)/10e0 as Churn_Risk_Pct,
    round_even(Total_Account_Value*100e0, 0)/100e0 as Total_Account_Value,
    round_even(Value_At_Stake*100e0, 0)/100e0 as Value_At_Stake,
    round_even(Net_ROI*100e0, 0)/100e0 as Net_ROI,
    round_even(Save_Prob*100e0, 0)/100e0 as Save_Prob,
    Is_Sleeping_Dog, Card_Category as Card_Tier,
    case when Months_on_book > 0 and Months_on_book <= 24 then 'New (<2y)'
         when Months_on_book > 24 and Months_on_book <= 36 then '2-3y'
         when Months_on_book > 36 and Months_on_book <= 48 then '3-4y'
         when Months_on_book > 48 and Months_on_book <= 100 then 'Loyal (4y+)' end as Tenure_Band,
    Customer_Age, Months_on_book, Total_Relationship_Count, Total_Trans_Amt, Total_Trans_Ct,
    Months_Inactive_12_mon, member_key, Priority_Score
  from scored)""",
)

BASE = (SCENARIOS[1],)

# target list at the optimum of the base scenario
OPT_LIST_CTES = (
    f"""optlist as (
  select * from (
    select dec.*, {_prio('best.Optimal_Risk_Weight_Pct')} as Live_Priority, Recommended_Action as Intervention_Type
    from dec join best using (Scenario)) order by Live_Priority desc nulls last, member_key limit {K})""",
)
MAN_LIST_CTES = (
    f"""manlist as (
  select * from (select dec.*, {_prio(str(MANUAL_W))} as Live_Priority from dec)
  order by Live_Priority desc nulls last, member_key limit {K})""",
)

BAND_CASE = """case when Months_on_book > 0 and Months_on_book <= 24 then 'New (<2y)'
         when Months_on_book > 24 and Months_on_book <= 36 then '2-3y'
         when Months_on_book > 36 and Months_on_book <= 48 then '3-4y'
         when Months_on_book > 48 and Months_on_book <= 100 then 'Loyal (4y+)' end"""

TEST_FLAG = "('0x' || substr(md5('42:' || member_key), 1, 8))::BIGINT % 10000 < 2000"
RULE_PRED = "case when Churn_Risk_Score > 0.5e0 then 1e0 else 0e0 end"


def _r(x: str, d: int) -> str:
    return f"round_even(({x})*1e{d}, 0)/1e{d}"


def _base(body: str, *more: str) -> str:
    return with_members(body, *_dec_ctes(BASE), *more)


def _all(body: str, *more: str) -> str:
    return with_members(body, *_dec_ctes(SCENARIOS), *more)


def _base_opt(body: str, *more: str) -> str:
    return _base(body, *SWEEP_CTES, *OPT_LIST_CTES, *more)


def _table(body: str) -> str:
    return _all(body, *SWEEP_CTES, *TABLE_CTES)


TAB23 = ("Scenario, Scenario_Interchange_Pct, Optimal_Risk_Weight_Pct, Recommended_Allocation, Customer_ID, "
         "Recommended_Action, In_Target_List, Priority_Rank, Churn_Risk_Score, Churn_Risk_Pct, "
         "Total_Account_Value, Value_At_Stake, Net_ROI, Save_Prob, Is_Sleeping_Dog, Card_Tier, Tenure_Band, "
         "Customer_Age, Months_on_book, Total_Relationship_Count, Total_Trans_Amt, Total_Trans_Ct, "
         "Months_Inactive_12_mon")

CURVE_SQL = _all("select Scenario, Risk_Weight_Pct, Captured_Net_ROI, At_Risk_Reached from curve",
                 *SWEEP_CTES)
KPI_SQL = _base_opt(f"""select cast(count(*) as bigint) Target_List_Size,
  {_r('cast(sum(cast(Net_ROI as decimal(38,8))) as double)', 4)} Total_Net_ROI,
  {_r('avg(Churn_Risk_Score)', 6)} Avg_Churn_Risk,
  {_r('avg(Months_on_book)', 6)} Avg_Tenure_Months,
  {_r('avg(Total_Account_Value)', 4)} Avg_Account_Value,
  {_r('avg(Customer_Age)', 6)} Avg_Age,
  cast(count(*) filter (where contains(Recommended_Action, 'Call')) as bigint) High_Touch_Calls
from optlist""")

FAIRNESS_SQL = _base_opt(f"""select Strategy, Risk_Weight_Pct, {_r('t', 6)} Target_Mean_Age,
  {_r('p', 6)} Population_Mean_Age, {_r('abs(p - t)', 6)} Age_Gap, abs(p - t) > 3e0 Compliance_Alert
from (
  select 'optimal' Strategy, cast(o.w as integer) Risk_Weight_Pct, o.a t, p.a p
  from (select max(Optimal_Risk_Weight_Pct) w, avg(Customer_Age) a from optlist join best using (Scenario)) o,
       (select avg(Customer_Age) a from dec) p
  union all
  select 'manual', {MANUAL_W}, m.a, p.a
  from (select avg(Customer_Age) a from manlist) m, (select avg(Customer_Age) a from dec) p)""",
                         *MAN_LIST_CTES)

def _tree(body: str, depth: int = 4, bins: int = 32) -> str:
    """The single class-weighted tree, level by level, and ``body`` over its ``nodes`` and test ``leaves``."""
    values = ", ".join(f"cast({c} as double)" for c in FEATURES)
    names = ", ".join(f"'{c}'" for c in FEATURES)

    def impurity(p, n):
        return f"(1e0 - ({p})/(({p})+({n}))*(({p})/(({p})+({n}))) - ({n})/(({p})+({n}))*(({n})/(({p})+({n}))))"

    lp, ln, rp, rn = "lp*wp", "ln*wn", "(p - lp)*wp", "(n - ln)*wn"
    t = "(p*wp + n*wn)"
    gain = (f"{impurity('p*wp', 'n*wn')} - ({lp} + {ln})/{t}*{impurity(lp, ln)}"
            f" - ({rp} + {rn})/{t}*{impurity(rp, rn)}")
    ctes = [f"rows0 as (select member_key r, Churn_Flag y, {TEST_FLAG} as test, [{values}] x from members)",
            "cells as (select r, y, test, unnest(x) v, generate_subscripts(x, 1) - 1 f from rows0)",
            f"""cuts as materialized (
  select f, list_sort(list_distinct([lo + (hi - lo)*k/{bins}e0 for k in range(1, {bins})])) c
  from (select f, min(v) lo, max(v) hi from cells where not test group by f))""",
            """binned as materialized (
  select r, y, test, f, len([q for q in c if q < v]) b from cells join cuts using (f))""",
            """w as (select count(*)/(2e0*sum(y)) wp, count(*)/(2e0*(count(*) - sum(y))) wn, sum(y) p, count(*) - sum(y) n
  from rows0 where not test)""",
            "placed0 as (select r, y, test, cast(1 as bigint) node from rows0)"]
    for i in range(depth):
        ctes += [f"""hist{i} as (select node, f, b, sum(b1.y) cp, count(*) - sum(b1.y) cn
  from placed{i} join binned b1 using (r) where not b1.test and node >= {2 ** i} group by node, f, b)""",
                 f"""sums{i} as (select node, f, b, sum(cp) over u lp, sum(cn) over u ln, sum(cp) over a p, sum(cn) over a n
  from hist{i} window u as (partition by node, f order by b), a as (partition by node, f))""",
                 f"""gains{i} as (select node, f, b, lp, ln, p, n, round_even(({gain})*1e12, 0)/1e12 gain
  from sums{i}, (select wp, wn from w) where lp + ln < p + n)""",
                 f"""best{i} as materialized (select * from gains{i} where gain > 0
  qualify row_number() over (partition by node order by gain desc, f, b) = 1)""",
                 f"""placed{i + 1} as materialized (
  select r, pl.y, pl.test, case when s.node is null then pl.node when bi.b <= s.b then 2*pl.node else 2*pl.node + 1 end node
  from placed{i} pl left join best{i} s using (node) left join binned bi using (r, f))"""]
    every = " union all ".join(f"select * from best{i}" for i in range(depth))
    ctes += [f"splits as ({every})",
             """counted as (select 1 node, p, n from w union all select 2*node, lp, ln from splits
  union all select 2*node + 1, p - lp, n - ln from splits)""",
             f"""nodes as (select c.node, [{names}][s.f + 1] feature, q.c[s.b + 1] threshold, s.gain, c.p pos, c.n neg,
    c.p*wp + c.n*wn weight, c.p*wp/(c.p*wp + c.n*wn) p_churn
  from counted c left join splits s using (node) left join cuts q using (f), (select wp, wn from w))""",
             f"leaves as (select r member_key, node from placed{depth} where test)"]
    return with_members(body, *ctes)


COMPARE_SQL = _base_opt(f"""select o.w Optimal_Risk_Weight_Pct, {MANUAL_W} Manual_Risk_Weight_Pct,
  {_r('o.r', 4)} Optimal_Net_ROI, {_r('m.r', 4)} Manual_Net_ROI, {_r('m.r - o.r', 4)} Delta_vs_Optimum,
  '$' || format('{{:,.2f}}', o.r) Optimal_Net_ROI_Text
from (select max(Optimal_Risk_Weight_Pct) w, cast(sum(cast(Net_ROI as decimal(38,8))) as double) r
      from optlist join best using (Scenario)) o,
     (select cast(sum(cast(Net_ROI as decimal(38,8))) as double) r from manlist) m""", *MAN_LIST_CTES)

SQL: dict[str, str] = {
    "S8_preview": with_members(
        "select member_key, Customer_Age, Total_Trans_Ct, Churn_Flag, Card_Category from members "
        "order by member_key limit 5"),
    "P1_drop_columns": with_members(f"select member_key, {FEATURES_SQL}, Card_Category, Attrition_Flag from members"),
    "P2_churn_label": with_members("select member_key, Attrition_Flag, Churn_Flag from members"),
    "P3_scored_columns": with_members(
        f"select member_key, {FEATURES_SQL}, Card_Category, Churn_Flag, {RULE_PRED} as prediction, "
        "Churn_Risk_Score from members"),
    "P4_scenario_columns": _table(f"select {TAB23} from tab"),
    "P6_scenario_constants": _table(
        "select distinct Scenario, Scenario_Interchange_Pct, Optimal_Risk_Weight_Pct from tab"),
    "P7_allocation_text": _table("select distinct Scenario, Recommended_Allocation from tab"),
    "P8_tier_alias": with_members("select member_key, Card_Category as Card_Tier, Card_Category as Segment from members"),
    "P9_member_id": with_members("select member_key, printf('M%05d', member_key) as Customer_ID from members"),
    "P10_target_view": _base_opt(
        "select member_key, Intervention_Type, Churn_Risk_Score, Total_Account_Value, Net_ROI, Segment from optlist"),
    "B1_churned": with_members("select member_key, Attrition_Flag from members where Churn_Flag = 1"),
    "B2_true_positives": with_members(
        f"select member_key, Churn_Flag, {RULE_PRED} as prediction from members "
        "where Churn_Flag = 1 and Churn_Risk_Score > 0.5e0"),
    "B3_sleeping_dogs": _base(
        "select member_key, Churn_Risk_Score, Months_Inactive_12_mon, Total_Ct_Chng_Q4_Q1 from dec "
        "where Is_Sleeping_Dog"),
    "B4_at_risk": with_members("select member_key, Churn_Risk_Score > 0.5e0 as At_Risk from members"),
    "B5_target_rows": _table(
        "select Customer_ID, Recommended_Action, Net_ROI from tab "
        "where Scenario = 'Base Margin (2.5%)' and In_Target_List"),
    "B6_call_actions": _base_opt(
        "select member_key, Intervention_Type from optlist where contains(Intervention_Type, 'Call')"),
    "B7_email_fallback": _base(
        "select member_key, Recommended_Action, Net_ROI, ROI_Email from dec "
        "where not Is_Sleeping_Dog and best_roi <= 0"),
    "B8_dog_override": _base(
        "select member_key, Recommended_Action, Net_ROI, Expected_Value_Saved from dec where Is_Sleeping_Dog"),
    "J1_member_scenarios": _all("select member_key, Scenario, margin, Total_Account_Value from d6"),
    "J2_member_weights": _base(
        f"select member_key, cast(w as integer) Risk_Weight_Pct, {_prio('w')} as Priority_Score "
        "from dec cross join (select range as w from range(0, 101, 2))"),
    "J3_population_scalars": _base("select member_key, Normalized_Value, Loyalty_Weight from dec"),
    "J4_best_weight": _table("select member_key, Scenario, Optimal_Risk_Weight_Pct, Priority_Score from tab"),
    "A1_row_count": with_members("select cast(count(*) as bigint) members from members"),
    "A2_churn_rate": with_members(f"select {_r('avg(Churn_Flag)', 6)} churn_rate from members"),
    "A3_class_weights": with_members(f"""select n, pos,
  case when pos = 0 then null else {_r('n/(2e0*pos)', 6)} end w_pos,
  case when n = pos then null else {_r('n/(2e0*(n - pos))', 6)} end w_neg
from (select cast(count(*) as bigint) n, cast(count(*) filter (where Churn_Flag = 1) as bigint) pos from members)"""),
    "A4_confusion": with_members(f"""select tp, fp, fn, tn, tp + fp + fn + tn as test_set_size from (
  select cast(count(*) filter (where Churn_Flag = 1 and pred = 1) as bigint) tp,
         cast(count(*) filter (where Churn_Flag = 0 and pred = 1) as bigint) fp,
         cast(count(*) filter (where Churn_Flag = 1 and pred = 0) as bigint) fn,
         cast(count(*) filter (where Churn_Flag = 0 and pred = 0) as bigint) tn
  from (select Churn_Flag, {RULE_PRED} pred from members where {TEST_FLAG}))"""),
    "A5_precision_recall": with_members(f"""select
  case when tp + fp = 0 then 0e0 else {_r('tp/(tp + fp)', 6)} end "precision",
  case when tp + fn = 0 then 0e0 else {_r('tp/(tp + fn)', 6)} end recall,
  case when 2*tp + fp + fn = 0 then 0e0 else {_r('2*tp/(2*tp + fp + fn)', 6)} end churn_f1
from (
  select count(*) filter (where Churn_Flag = 1 and pred = 1) tp,
         count(*) filter (where Churn_Flag = 0 and pred = 1) fp,
         count(*) filter (where Churn_Flag = 1 and pred = 0) fn
  from (select Churn_Flag, {RULE_PRED} pred from members where {TEST_FLAG}))"""),
    "A6_population_minmax": _all("select Scenario, pop_min_mob, pop_max_mob, pop_max_value from pop"),
    "A7_max_expected_loss": with_members(
        "select max(Churn_Risk_Score * Total_Trans_Amt) max_expected_loss from members"),
    "A8_action_mix": _base_opt(
        "select Recommended_Action as Intervention, cast(count(*) as bigint) Count from optlist group by 1"),
    "A9_tier_mix": _base_opt("select Segment, cast(count(*) as bigint) Count from optlist group by 1"),
    "A10_tenure_mix": _base_opt(f"""select b.Tenure_Band, cast(coalesce(c.n, 0) as bigint) Count
from (values ('New (<2y)'), ('2-3y'), ('3-4y'), ('Loyal (4y+)')) b(Tenure_Band)
left join (select {BAND_CASE} as Tenure_Band, count(*) n from optlist group by 1) c using (Tenure_Band)"""),
    "A11_scenario_summary": _table("""select Scenario, max(Optimal_Risk_Weight_Pct) Optimal_Risk_Weight_Pct,
  cast(sum(cast(Net_ROI as decimal(38,2))) as double) Target_List_ROI,
  cast(count(*) as bigint) Target_List_Size,
  cast(count(*) filter (where Recommended_Action = 'Automated Email') as bigint) n_email,
  cast(count(*) filter (where Recommended_Action = 'Rep Call + 5% Waiver') as bigint) n_rep_call,
  cast(count(*) filter (where Recommended_Action = 'Senior Call + 10% Waiver') as bigint) n_senior_call,
  cast(count(*) filter (where Recommended_Action = 'Flagged: Sleeping Dog') as bigint) n_sleeping_dog
from tab where In_Target_List group by Scenario"""),
    "A11_action_counts": _table("""select Scenario, Recommended_Action, cast(count(*) as bigint) Members
from tab where In_Target_List group by Scenario, Recommended_Action"""),
    "A12_target_kpis": KPI_SQL,
    "A13_high_touch": _base_opt(
        "select cast(count(*) as bigint) Target_List_Size, "
        "cast(count(*) filter (where contains(Recommended_Action, 'Call')) as bigint) High_Touch_Calls from optlist"),
    "A14_population_age": _base(f"select {_r('avg(Customer_Age)', 6)} Population_Mean_Age from dec"),
    "A15_sweep_aggregates": CURVE_SQL,
    "A16_objective": _all(
        f"select Scenario, Risk_Weight_Pct, Captured_Net_ROI, At_Risk_Reached, {_r('Objective', 9)} Objective from obj",
        *SWEEP_CTES),
    "A17_best_weight": _all(
        f"select Scenario, Optimal_Risk_Weight_Pct, {_r('Best_Objective', 9)} Best_Objective from best", *SWEEP_CTES),
    "W1_global_rank": _table("select Customer_ID, Scenario, Priority_Rank from tab"),
    "W2_top_k_per_weight": _all(
        "select Scenario, cast(w as integer) Risk_Weight_Pct, member_key, cast(rn as integer) Position from topk",
        *SWEEP_CTES),
    "W3_top_k": _base_opt(
        "select member_key, Live_Priority, Intervention_Type, Net_ROI, Customer_Age from optlist"),
    "W4_target_flag": _table("select Customer_ID, Scenario, In_Target_List from tab"),
    "W5_full_sort": with_members(f"""select member_key, Expected_Loss,
  {_r('case when mx = 0 then null else Expected_Loss / mx end * 100', 1)} Priority_Score
from (select member_key, Churn_Risk_Score * Total_Trans_Amt Expected_Loss,
             max(Churn_Risk_Score * Total_Trans_Amt) over () mx from members)
order by Priority_Score desc nulls last, member_key"""),
    "W8_best_channel": _base("select member_key, best_channel Best_Channel, best_roi Best_Channel_ROI from dec"),
    "U1_union_scenarios": _all("select member_key, Scenario, Recommended_Action, Net_ROI from d6"),
    "F1_clip": _base("select member_key, Expected_Retention_Years, Save_Prob, respond as Responsive from dec"),
    "F2_arithmetic": _base("select member_key, Annual_Margin, CLV, Relationship_Multiplier from dec"),
    "F3_abs_gap": FAIRNESS_SQL,
    "F4_round_even": _all(
        "select member_key, Scenario, " + ", ".join(
            f"{_r(c, 2)} {c}" for c in ("Total_Account_Value", "Value_At_Stake", "Net_ROI", "Save_Prob"))
        + " from dec"),
    "F6_percent": _all(
        "select member_key, Scenario, round_even(Churn_Risk_Score*100e0*10e0, 0)/10e0 Churn_Risk_Pct, "
        "margin*100e0 Scenario_Interchange_Pct from dec"),
    "F7_tenure_band": with_members(f"select member_key, Months_on_book, {BAND_CASE} Tenure_Band from members"),
    "F8_band_counts": with_members(
        f"select {BAND_CASE} Tenure_Band, cast(count(*) as bigint) Count from members group by 1"),
    "F10_money_text": _base_opt("""select Intervention_Type,
  '$' || format('{:,.2f}', cast(sum(cast(Net_ROI as decimal(38,2))) as double)) Net_ROI_Text
from optlist group by 1"""),
    "F10_profile_text": f"""select format('{{:,.0f}}', Avg_Churn_Risk * 100e0) || '%' Avg_Churn_Risk_Text,
  format('{{:,.0f}}', Avg_Tenure_Months) || ' mo' Avg_Tenure_Text,
  '$' || format('{{:,.0f}}', Avg_Account_Value) Avg_Account_Value_Text,
  '$' || format('{{:,.2f}}', Total_Net_ROI) Total_Net_ROI_Text,
  High_Touch_Calls || ' / {K}' High_Touch_Calls_Text
from ({KPI_SQL})""",
    "F10_fairness_text": f"""select Strategy,
  case when Compliance_Alert then 'Age gap too wide' else 'Age gap within the limit' end || ': target list '
  || format('{{:,.1f}}', Target_Mean_Age) || ' years, population ' || format('{{:,.1f}}', Population_Mean_Age)
  || ' years' Fairness_Text
from ({FAIRNESS_SQL})""",
    "F10_strategy_text": f"""select printf('%d%% Risk / %d%% Value', Optimal_Risk_Weight_Pct, 100 - Optimal_Risk_Weight_Pct)
    Optimal_Allocation,
  printf('%d%% Risk / %d%% Value', Manual_Risk_Weight_Pct, 100 - Manual_Risk_Weight_Pct) Manual_Allocation,
  '$' || format('{{:,.2f}}', Optimal_Net_ROI) Optimal_Net_ROI_Text,
  '$' || format('{{:,.2f}}', Manual_Net_ROI) Manual_Net_ROI_Text,
  '$' || format('{{:,.2f}}', Delta_vs_Optimum) || ' vs optimum' Delta_Text
from ({COMPARE_SQL})""",
    "F12_min_max_scale": _base("select member_key, tn Tenure_Norm, Normalized_Value from dec"),
    "F13_loyalty_direction": _base("""select member_key, 1e0 + 0.5e0*0.5e0*tn as Protect_Loyal_Weight,
  1e0 + 0.5e0*0.5e0*(1 - tn) as Rescue_New_Weight from dec"""),
    "D1_account_value": _base(
        "select member_key, Expected_Retention_Years, Annual_Margin, CLV, Relationship_Multiplier, "
        "Total_Account_Value from dec"),
    "D2_save_probability": _base("select member_key, Save_Prob from dec"),
    "D3_sleeping_dogs": _base("select member_key, Is_Sleeping_Dog from dec"),
    "D4_channel_roi": _base("select member_key, Value_At_Stake, ROI_Email, ROI_Rep, ROI_Senior from dec"),
    "D5_best_action": _base("select member_key, Recommended_Action, Net_ROI from dec"),
    "D5_action_summary": _base(f"""select Recommended_Action, cast(count(*) as bigint) Members,
  {_r('cast(sum(cast(Net_ROI as decimal(38,8))) as double)', 2)} Net_ROI_Sum
from dec group by 1"""),
    "D6_expected_value_saved": _base("select member_key, Expected_Value_Saved from dec"),
    "D7_loyalty_weight": with_members("select member_key, Loyalty_Weight from dec", *_dec_ctes(BASE, 0.5)),
    "D8_priority": _base(f"select member_key, {_prio(str(MANUAL_W))} Priority_Score from dec"),
    "D9_tradeoff_curve": CURVE_SQL,
    "D10_optimal_weight": _all(
        f"select Scenario, Optimal_Risk_Weight_Pct, {_r('Best_Objective', 9)} Best_Objective from best", *SWEEP_CTES),
    "D11_target_list": _base_opt(
        "select member_key, Live_Priority, Intervention_Type, Net_ROI, Customer_Age from optlist"),
    "D12_compare_strategies": COMPARE_SQL,
    "D13_fairness_check": FAIRNESS_SQL,
    "D14_target_profile": f"""with k as ({KPI_SQL}), l as ({_base_opt("select Segment, Months_on_book from optlist")})
select 'kpi' Part, Item, Value from (
  unpivot (select cast(columns(*) as double) from k) on columns(*) into name Item value Value)
union all select 'tier', Segment, cast(count(*) as double) from l group by Segment
union all select 'tenure', b.Tenure_Band, cast(coalesce(c.n, 0) as double)
from (values ('New (<2y)'), ('2-3y'), ('3-4y'), ('Loyal (4y+)')) b(Tenure_Band)
left join (select {BAND_CASE} as Tenure_Band, count(*) n from l group by 1) c using (Tenure_Band)""",
    "D15_score_scenarios": _table(f"select {TAB23} from tab"),
    "D16_expected_loss_priority": with_members(f"""select member_key, Expected_Loss,
  {_r('case when mx = 0 then null else Expected_Loss / mx end * 100', 1)} Priority_Score
from (select member_key, Churn_Risk_Score * Total_Trans_Amt Expected_Loss,
             max(Churn_Risk_Score * Total_Trans_Amt) over () mx from members)"""),
    # frequency order, ties by name
    "L1_index_tier": with_members("""select member_key, Card_Category, cast(i as double) Card_Tier_Index
from members join (select Card_Category, row_number() over (order by count(*) desc, Card_Category) - 1 as i
                   from members group by Card_Category) using (Card_Category)"""),
    "L2_assemble": with_members("select member_key, " + ", ".join(
        f"cast({c} as double) as feature_{i}" for i, c in enumerate(FEATURES)) + " from members"),
    # one curve point a distinct score; trapezoids; the precision curve starts flat
    "L7_rule_curve_areas": with_members(f"""select {_r('sum((f - f0)*(r + r0)/2e0)', 6)} roc_auc,
  {_r('sum((r - r0)*(p + p0)/2e0)', 6)} pr_auc
from (select f, r, p, lag(f, 1, 0e0) over o f0, lag(r, 1, 0e0) over o r0, coalesce(lag(p) over o, p) p0
  from (select s, fp/n f, tp/t r, tp/(tp + fp) p
    from (select s, cast(sum(pos) over w as double) tp, cast(sum(neg) over w as double) fp,
                 cast(sum(pos) over () as double) t, cast(sum(neg) over () as double) n
      from (select Churn_Risk_Score s, count(*) filter (where Churn_Flag = 1) pos,
                   count(*) filter (where Churn_Flag = 0) neg
            from members where {TEST_FLAG} group by 1)
      window w as (order by s desc)))
  window o as (order by s desc))"""),
    "L9_rule_count_scores": with_members(f"""select {_r('(tp + tn)/n', 6)} accuracy,
  {_r('((tp + fn)*case when 2*tp + fp + fn = 0 then 0e0 else 2*tp/(2*tp + fp + fn) end'
      ' + (tn + fp)*case when 2*tn + fp + fn = 0 then 0e0 else 2*tn/(2*tn + fp + fn) end)/n', 6)} f1
from (select cast(count(*) filter (where Churn_Flag = 1 and pred = 1) as double) tp,
             cast(count(*) filter (where Churn_Flag = 0 and pred = 1) as double) fp,
             cast(count(*) filter (where Churn_Flag = 1 and pred = 0) as double) fn,
             cast(count(*) filter (where Churn_Flag = 0 and pred = 0) as double) tn, cast(count(*) as double) n
      from (select Churn_Flag, {RULE_PRED} pred from members where {TEST_FLAG}))"""),
    "L3_split": with_members(f"select member_key, {TEST_FLAG} as is_test from members"),
    "L4_gini_tree": _tree(f"""select cast(node as bigint) node, feature, {_r('threshold', 6)} threshold,
  {_r('gain', 9)} gain, cast(pos as bigint) pos, cast(neg as bigint) neg from nodes"""),
    "L5_tree_scores": _tree(f"""select member_key, cast(node as bigint) node,
  case when p_churn > 0.5e0 then 1e0 else 0e0 end prediction, {_r('p_churn', 9)} Churn_Risk_Score
from leaves join nodes using (node)"""),
    "L11_tree_importances": _tree("select feature, " + _r("coalesce(g, 0e0)/(select sum(gain*weight) from nodes)", 9)
                                  + " importance from (select unnest([" + ", ".join(f"'{c}'" for c in FEATURES)
                                  + "]) feature) left join (select feature, sum(gain*weight) g from nodes "
                                  "where feature is not null group by feature) using (feature)"),
}
