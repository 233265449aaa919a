"""Folder layout and run guard shared by the medallion jobs."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from orebed import paths
from orebed.streaming.run import RunReport


class ResetNotAllowed(RuntimeError):
    """A full refresh was asked for on a job whose sources may be gone."""


@dataclass(frozen=True)
class Layers:
    """Where the tables and checkpoints of one generation of a job live."""

    base: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    @property
    def notes(self) -> str:
        return f"{self.base}/notes"


@dataclass
class JobReport:
    """The steps of one run: bronze and silver reports, or schemas when validating."""

    steps: dict[str, RunReport] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    layers: Layers | None = None


def open_layers(
    spark: SparkSession, root: str, job: str, full_refresh: bool = False, allow_reset: bool = False
) -> Layers:
    """The current generation of a job's folders.

    Bronze holds files that may no longer be in the landing folder, so reading
    everything again needs ``allow_reset``. It starts a new generation and
    leaves the old tables and checkpoints as they are.
    """
    home = f"{root}/medallion/{job}"
    numbers = [int(name[1:]) for name in paths.list_names(spark, home) if name.startswith("g")]
    current = max(numbers, default=0)
    if full_refresh and numbers:
        if not allow_reset:
            raise ResetNotAllowed(f"{job}: a full refresh needs allow_reset=True")
        current += 1
    base = f"{home}/g{current}"
    paths.make_dirs(spark, base)
    return Layers(base)
