"""Profiles and rule counts that come out of the job that writes the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .profile import blanks
from .rules import Rule

REPORT = "step string, measure string, column string, n long"


@dataclass
class Watch:
    """Counts of the rows that pass some steps of a plan, known once a job over it has ended.

    ``rows`` adds a step: its frame counts, on the way, rows, NULLs and empty texts per column, rows that break
    a rule, and what else is asked for. No data is read, shuffled or computed a second time: counts are
    summed up in the tasks that make the rows anyway. Rules that need a shuffle of their own are refused.

    Steps before a shuffle run in map tasks. If an executor is lost with their output, Spark runs
    those again and counts their rows twice, so such counts may be too high after a loss; the rows written and steps behind
    the last shuffle are not touched by it.
    """

    steps: dict[str, Observation] = field(default_factory=dict)
    told: dict[str, list[tuple[str, str]]] = field(default_factory=dict)
    none: dict[str, DataFrame] = field(default_factory=dict)

    def rows(
        self, df: DataFrame, step: str, columns: Sequence[str] = (), rules: Sequence[Rule] = (), more: dict[str, Column] | None = None
    ) -> DataFrame:
        if step in self.steps:
            raise ValueError(f"{step} is watched already")
        measures = [("n_rows", "*", F.count(F.lit(1)))]
        for name in columns:
            measures.append(("n_null", name, F.count_if(F.col(name).isNull())))
            measures.append(("n_blank", name, blanks(df, name)))
        for rule in rules:
            if rule.broken is None and rule.summary is None:
                raise ValueError(f"{rule.name} needs a shuffle of its own")
            failed = F.count_if(rule.broken) if rule.broken is not None else rule.summary
            measures.append((rule.name, rule.column, failed))
        measures += [(name, "*", value) for name, value in (more or {}).items()]
        self.steps[step] = Observation()
        self.told[step] = [(m, c) for m, c, _ in measures]
        values = [v.cast("long").alias(f"m{i}") for i, (_, _, v) in enumerate(measures)]
        self.none[step] = df.sparkSession.createDataFrame([], df.schema).agg(*values)
        return df.observe(self.steps[step], *values)

    def counts(self) -> list[tuple[str, str, str, int]]:
        """(step, measure, column, n) of all steps; waits for the job."""
        out = []
        for step, observation in self.steps.items():
            try:
                found = observation.get
            except Py4JJavaError as error:
                # Spark left a step without rows out of the plan and has an empty answer for it
                if "AssertionError" not in str(error.java_exception):
                    raise
                found = self.none[step].first().asDict()
            out += [(step, m, c, int(found.get(f"m{i}") or 0)) for i, (m, c) in enumerate(self.told[step])]
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        """The counts as a table of a few rows."""
        return spark.createDataFrame(self.counts(), REPORT)
