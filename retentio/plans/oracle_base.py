"""DuckDB-side building blocks for the oracle SQL.

The oracle is written independently of the DataFrame code: plain SQL over
the raw tables, so a mismatch shows a real difference between the two.
Integer outputs are cast to the Spark types (DuckDB sums are HUGEINT).
"""

from __future__ import annotations

# Stand-in member table, one row per customer with activity.
MEMBERS_CTE = """
tx as (
  select o.o_custkey k, l.l_shipdate d, o.o_orderpriority pri, l.l_returnflag rf,
         cast(l.l_extendedprice as decimal(18,2)) amt
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  where l.l_shipdate < timestamp '2000-10-01'),
f as (
  select k,
    sum(case when d>=timestamp '1999-06-01' and d<timestamp '2000-06-01' then 1 else 0 end) ct,
    sum(case when d>=timestamp '1999-06-01' and d<timestamp '2000-06-01' then amt else 0 end) amt,
    sum(case when d>=timestamp '1999-06-01' and d<timestamp '2000-06-01' and rf='R' then 1 else 0 end) contacts,
    sum(case when d>=timestamp '2000-03-01' and d<timestamp '2000-06-01' then 1 else 0 end) q4,
    sum(case when d>=timestamp '1999-06-01' and d<timestamp '1999-09-01' then 1 else 0 end) q1,
    sum(case when d>=timestamp '2000-03-01' and d<timestamp '2000-06-01' then amt else 0 end) a4,
    sum(case when d>=timestamp '1999-06-01' and d<timestamp '1999-09-01' then amt else 0 end) a1,
    min(case when d<timestamp '2000-06-01' then (2000-year(d))*12+6-month(d) end) inactive_raw,
    max(case when d<timestamp '2000-06-01' and pri='1-URGENT' then (2000-year(d))*12+6-month(d) end) mob_raw,
    count(distinct case when d<timestamp '2000-06-01' then pri end) rel,
    sum(case when d>=timestamp '2000-06-01' and d<timestamp '2000-10-01' then 1 else 0 end) fut
  from tx group by k),
members0 as (
  select c.c_custkey member_key,
    cast(26 + (c.c_custkey*37) % 48 as integer) Customer_Age,
    1438e0 + 3e0*greatest(c.c_acctbal, 0e0) Credit_Limit,
    greatest(c.c_acctbal, 0e0)/4e0 Total_Revolving_Bal,
    cast(f.amt as double)/20e0 Total_Trans_Amt,
    cast(f.ct as integer) Total_Trans_Ct,
    cast(least(12, coalesce(f.inactive_raw, 12)) as integer) Months_Inactive_12_mon,
    cast(greatest(1, f.rel) as integer) Total_Relationship_Count,
    cast(f.q4+1 as double)/cast(f.q1+1 as double) Total_Ct_Chng_Q4_Q1,
    cast(f.a4+1 as double)/cast(f.a1+1 as double) Total_Amt_Chng_Q4_Q1,
    (greatest(c.c_acctbal, 0e0)/4e0)/(1438e0 + 3e0*greatest(c.c_acctbal, 0e0)) Avg_Utilization_Ratio,
    cast(f.contacts as integer) Contacts_Count_12_mon,
    cast(coalesce(f.mob_raw, 0) as integer) Months_on_book,
    c.c_mktsegment Card_Category,
    case when f.fut=0 then 'Attrited Customer' else 'Existing Customer' end Attrition_Flag
  from customer c join f on c.c_custkey = f.k),
members as (
  select *, cast(case when Attrition_Flag='Attrited Customer' then 1 else 0 end as integer) Churn_Flag,
    least(1e0, greatest(0e0, round(0.06e0*Months_Inactive_12_mon + 0.04e0*greatest(0, 12-Total_Trans_Ct)
      + 0.20e0*greatest(0e0, 1e0-Total_Ct_Chng_Q4_Q1) - 0.10e0, 4))) Churn_Risk_Score
  from members0)"""


def with_members(body: str, *extra_ctes: str) -> str:
    """Prefix a query body with the member CTE and any further CTEs."""
    ctes = ",\n".join((MEMBERS_CTE.strip(),) + tuple(c.strip() for c in extra_ctes))
    return f"with {ctes}\n{body.strip()}"
