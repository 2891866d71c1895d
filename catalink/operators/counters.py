"""Counters of a run, taken in the pass that writes its tables: no second job reads them back to count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation

from .work import saved


class Counters:
    """Observes frames as they are written, and has all counts afterwards.

    A name is counted once; a task that runs again doesn't count twice, since Spark takes the metrics of a job that has ended."""

    def __init__(self) -> None:
        self._seen: list[Observation] = []

    def written(self, df: DataFrame, name: str, **counts: Column) -> DataFrame:
        """``df`` written to the work folder and read again; ``counts`` are aggregates over it."""
        observation = Observation(name)
        self._seen.append(observation)
        return saved(df.observe(observation, *[c.alias(n) for n, c in counts.items()]), name)

    def counts(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for observation in self._seen:
            out |= observation.get
        return out
