"""Gridded time series on Spark: cubes as long tables, steps as DataFrame plans."""

from gridspark.cube import Cube
from gridspark.plans.steps import STEPS, process, step
from gridspark.session import configure, session

__all__ = ["STEPS", "Cube", "configure", "process", "session", "step"]
