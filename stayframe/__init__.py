"""stayframe: Spark-native operators that turn irregular per-entity event logs
into clean, labelled, fixed-length time windows, and evaluate models on them.

Every operator is a ``DataFrame -> DataFrame`` function over named columns.
Ordered per-entity work is partitioned by (entity, chunk) so that no single
entity, however large, ends up in one task (see ``operators.seq``).
"""

__all__ = ["session", "operators", "sources", "functions", "plans", "streaming"]
