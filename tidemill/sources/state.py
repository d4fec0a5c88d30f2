"""Fitted state: the weights and the optimizer's momentum, by step."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemill.sources.snapshots import latest_step, named_segments, publish, read_step

STATE = "step long, name string, values array<double>"
PARTS = ("weights", "momentum")


@dataclass
class State:
    """``classes * width`` numbers each; the size of the model, never of the data.

    ``segments`` names the parts of the log that tell of the steps so far.
    """

    step: int
    weights: np.ndarray
    momentum: np.ndarray
    segments: list[str] = field(default_factory=list)

    @classmethod
    def zero(cls, classes: int, width: int) -> State:
        return cls(0, np.zeros((classes, width)), np.zeros((classes, width)))

    def table(self, spark: SparkSession) -> DataFrame:
        values = [getattr(self, part).ravel() for part in PARTS]
        arrow = pa.table(
            {
                "step": pa.array([self.step] * len(PARTS), pa.int64()),
                "name": pa.array(PARTS),
                "values": pa.array(values, pa.list_(pa.float64())),
            }
        )
        return spark.createDataFrame(arrow, STATE)

    @classmethod
    def from_table(cls, table: DataFrame, classes: int) -> State:
        held = table.select("step", "name", "values").toArrow()  # one row per part
        at = {name: i for i, name in enumerate(held["name"].to_pylist())}
        arrays = {
            part: held["values"][at[part]].values.to_numpy().reshape(classes, -1) for part in PARTS
        }
        return cls(held["step"][at["weights"]].as_py(), **arrays)


def save_state(spark: SparkSession, root: str, state: State) -> None:
    publish(state.table(spark).coalesce(1), root, state.step, PARTS, state.segments)


def load_state(spark: SparkSession, roots: Sequence[str], classes: int) -> State | None:
    """The newest complete state of the first root that has one.

    The first root is the job's own; the others are where other runs keep
    theirs, tried in the order given. A state lacking a part does not count.
    """
    for root in roots:
        step = latest_step(spark, root, parts=PARTS)
        if step is not None:
            state = State.from_table(read_step(spark, root, step), classes)
            state.segments = named_segments(spark, root, step)
            return state
    return None
