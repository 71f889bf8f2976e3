"""Counts of the open period that are kept up by batch.

Each batch leaves one row per group with its partial counts. Reading adds these rows up,
so it costs what the groups cost, not what the period holds. A batch that is written
again loses its partial counts with its rows; a batch without any is counted from its
rows once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressmill.operators.periods import PeriodStore


class BatchCounts:
    """Additive ``counts`` (name to aggregate, such as ``count`` or ``sum``) per ``by``.

    ``name`` tells several counts of one store apart; another definition needs another
    name.
    """

    def __init__(self, store: PeriodStore, name: str, by: list[str], **counts: Column):
        self.store, self.name, self.by, self.counts = store, name, by, counts

    def _kept_up(self) -> list[str]:
        """The partial counts of all batches, made where they are missing."""
        paths = []
        for batch, rows in self.store.open_batches():
            path = self.store.derived(self.name, batch)
            if not self.store.committed(path):
                held = self.store.spark.read.parquet(rows)
                partial = held.groupBy(*self.by).agg(*[c.alias(n) for n, c in self.counts.items()])
                partial.write.mode("overwrite").parquet(path)
            paths.append(path)
        return paths

    def partials(self) -> DataFrame | None:
        """A row per batch and group; None when the period is empty."""
        paths = self._kept_up()
        return self.store.spark.read.parquet(*paths) if paths else None

    def current(self) -> DataFrame | None:
        """The counts of the whole open period."""
        rows = self.partials()
        return None if rows is None else rows.groupBy(*self.by).agg(*[F.sum(n).alias(n) for n in self.counts])
