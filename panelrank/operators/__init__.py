"""DataFrame -> DataFrame operators: windows, ranks, cleaning, scores, metrics, splits, models, audits."""
