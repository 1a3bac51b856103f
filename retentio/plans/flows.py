"""Whole flows in one call: from members to the files that the reports read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from retentio.constants import RF_DEPTH, RF_TREES, SEED
from retentio.operators import learn
from retentio.operators.report import expected_loss_priority
from retentio.session import materialize
from retentio.sources.files import read_metrics, write_metrics, write_scored


def train_score_export(members: DataFrame, scored_path: str, metrics_path: str, trees: int = RF_TREES,
                       depth: int = RF_DEPTH, seed: int = SEED, how: str | None = None) -> DataFrame:
    """Fits and evaluates the forest, writes the metrics JSON and the scored CSV, returns the headline row.

    ``members``: prepared members (behaviour columns, card tier, label and
    ``member_key``).  They are stored once; training, evaluation and scoring
    read the stored table, and the headline is read back from the metrics file.
    """
    base = learn.arranged(materialize(members, how), how)
    fitted = learn.train_and_evaluate(base, trees, depth, seed)
    write_metrics(learn.metrics_table(fitted.predictions, fitted.model), metrics_path)
    scored = learn.score_population(fitted.model, base)
    write_scored(expected_loss_priority(scored, how=how), scored_path)
    return learn.headline(read_metrics(members.sparkSession, metrics_path))
