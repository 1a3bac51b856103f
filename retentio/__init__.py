"""retentio: retention decisions as Spark DataFrame operators.

Main entry points (all ``DataFrame -> DataFrame`` unless noted):

* ``member_table(spark, sf_dir)`` - members with features, label and rule risk
* ``decide(members, margin, costs)`` - value, save probability, sleeping dogs, channel ROI, action
* ``scenario_decisions(members, scenarios)`` - the above under every margin scenario
* ``tradeoff_curve(decisions, capacity)`` / ``optimal_weight(curve)`` - the weight sweep
* ``score_scenarios(members, scenarios, capacity)`` - the tidy ranked scenario table
* ``what_if(members, ...)`` - every dashboard table for one parameter set (dict)
* ``train_and_evaluate(members)`` / ``metrics_table(...)`` - the churn model
"""

from retentio.operators.decide import Costs, decide
from retentio.operators.learn import metrics_table, score_population, train_and_evaluate
from retentio.operators.report import what_if
from retentio.operators.scenarios import export_scenarios, scenario_decisions, score_scenarios
from retentio.operators.sweep import optimal_weight, tradeoff_curve
from retentio.sources.members import member_table

__all__ = [
    "Costs", "decide", "export_scenarios", "member_table", "metrics_table", "optimal_weight",
    "scenario_decisions", "score_population", "score_scenarios", "tradeoff_curve",
    "train_and_evaluate", "what_if",
]
