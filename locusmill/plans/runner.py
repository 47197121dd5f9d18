"""Named stages in order: each writes a table, and a finished one is not run again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, "Runner"], DataFrame]


@dataclass
class Runner:
    """``stages`` by name in order; results lie below ``folder``, in any store that Spark writes."""

    spark: SparkSession
    folder: str
    stages: dict[str, Build]
    options: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def done(self, name: str) -> bool:
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name) + "/_SUCCESS")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def result(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def listed(self) -> list[str]:
        return list(self.stages)

    def status(self) -> dict[str, str]:
        return {n: "done" if self.done(n) else "open" for n in self.stages}

    def plan(self, first: str | None = None, last: str | None = None) -> list[str]:
        """Names from ``first`` through ``last``."""
        names = self.listed()
        for n in (first, last):
            if n is not None and n not in self.stages:
                raise ValueError(f"no stage {n!r}; there are {', '.join(names)}")
        return names[names.index(first) if first else 0 : (names.index(last) + 1 if last else None)]

    def step(self, name: str, again: bool = True) -> None:
        if again or not self.done(name):
            self.stages[name](self.spark, self).write.mode("overwrite").parquet(self.path(name))

    def run(self, first: str | None = None, last: str | None = None, dry: bool = False) -> list[str]:
        """Runs what is not done, or all from ``first`` on if it is given; ``dry`` only tells."""
        names = [n for n in self.plan(first, last) if first is not None or not self.done(n)]
        if not dry:
            for n in names:
                self.step(n)
        return names
