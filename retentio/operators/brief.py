"""Headline lines and chart table from the metrics document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.functions.scalar import spaced, today_text


def brief(metrics: DataFrame) -> DataFrame:
    """One row per headline line (line_no, text), from a one-row metrics table."""
    top = spaced(F.col("top_features").getItem(0).getField("feature"))
    recall_pct = F.col("recall") * F.lit(100.0)
    prec_pct = F.col("precision") * F.lit(100.0)
    lines = [
        F.format_string("Report date %s", today_text()),
        F.format_string("Ranking of members by risk: area under the curve %.3f; recall %.0f%%, precision %.0f%%.",
                        F.col("roc_auc"), recall_pct, prec_pct),
        F.format_string("Largest feature weight: %s.", top),
        F.format_string("In the test split the model found %d leavers and overlooked %d.",
                        F.col("confusion.tp"), F.col("confusion.fn")),
    ]
    arr = F.array(*[F.struct(F.lit(i + 1).alias("line_no"), t.alias("text")) for i, t in enumerate(lines)])
    return metrics.select(F.inline(arr))


def importance_chart(metrics: DataFrame) -> DataFrame:
    """Top features, spaced names, in reverse order (bottom-up bar chart)."""
    rows = metrics.select(F.posexplode("top_features").alias("pos", "f"))
    return (rows.select(F.col("pos"), spaced(F.col("f.feature")).alias("Feature"),
                        F.col("f.importance").alias("Importance"))
            .orderBy(F.col("pos").desc()).drop("pos"))
