"""Aggregates over a table's rows, taken by the job that writes the table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation


class Watch:
    """Named aggregates that come with a write instead of a read afterwards.

    Rows are looked at after the last shuffle, by the tasks that write them. Spark
    takes each such task's numbers once, however often the task is tried; a task
    before a shuffle may be repeated for a lost executor and then counts again, so
    ``on`` belongs right before the write.
    """

    def __init__(self, metrics: Mapping[str, Column]):
        self.metrics = dict(metrics)
        self._observation: Observation | None = None

    def on(self, frame: DataFrame) -> DataFrame:
        self._observation = Observation()
        return frame.observe(self._observation, *[metric.alias(name) for name, metric in self.metrics.items()])

    @property
    def values(self) -> dict:
        """One value per name, once the table has been written."""
        if self._observation is None:
            raise LookupError("nothing has been written under this watch")
        return self._observation.get
