"""Arithmetic between variables."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridspark.cube import Cube
from gridspark.plans.steps import step


@step
def rescale(cube: Cube, **kwargs: int | float) -> Cube:
    """Multiply variables by constants; names the cube lacks are skipped."""
    for name, factor in kwargs.items():
        if name in cube.variables:
            cube = cube.assign(cube.dims_of(name), **{name: F.col(name) * F.lit(factor)})
    return cube


@step
def products(cube: Cube, **kwargs: Iterable[str]) -> Cube:
    """Add variables that are products of others, on all the dimensions of their factors; missing
    factors give missing products."""
    for name, factors in kwargs.items():
        factors = list(factors)
        if not factors:
            raise ValueError(f"products: {name!r} has no factors")
        signatures = [cube.dims_of(f) for f in factors]
        widest = max(signatures, key=len)
        if not all(set(s) <= set(widest) for s in signatures):
            raise ValueError(f"products: the factors of {name!r} have no common dimensions")
        joined = cube.attached(widest, factors)
        product = reduce(lambda a, b: a * b, (F.col(f) for f in factors))
        own = [c for c in cube.frames[widest].columns if c != name]
        cube = cube.with_frame(widest, joined.select(*own, product.alias(name)))
        cube = replace(cube, var_attrs={k: v for k, v in cube.var_attrs.items() if k != name})
    return cube


@step
def divide_by(cube: Cube, variables: Iterable[str], by: str) -> Cube:
    """Divide variables by another where it is positive; missing elsewhere."""
    out = cube
    for name in variables:
        dims = cube.dims_of(name)
        joined = out.attached(dims, [by])
        quotient = F.when(F.col(by) > 0, F.col(name) / F.col(by))
        out = out.with_frame(dims, joined.withColumn(name, quotient).select(*out.frames[dims].columns))
    return out


@step
def sin_cos(
    cube: Cube,
    variable: str,
    sin_name: str,
    cos_name: str,
    unit: str = "degrees",
    keep: bool = False,
) -> Cube:
    """Replace an angle by its sine and cosine, which can be averaged."""
    if unit not in ("degrees", "radians"):
        raise ValueError(f"sin_cos: unit is degrees or radians, not {unit!r}")
    dims = cube.dims_of(variable)
    angle = F.col(variable) * F.lit(math.pi / 180.0) if unit == "degrees" else F.col(variable)
    described = cube.var_attrs.get(variable, {}).get("long_name", variable)
    cube = cube.assign(dims, **{sin_name: F.sin(angle), cos_name: F.cos(angle)})
    cube = cube.keep_attrs(
        **{
            sin_name: {"units": "1", "long_name": f"sine of {described}"},
            cos_name: {"units": "1", "long_name": f"cosine of {described}"},
        }
    )
    return cube if keep else cube.without([variable])


def mean_direction(sin: Column, cos: Column) -> tuple[Column, Column]:
    """The direction (degrees in [0, 360)) and steadiness (0 to 1) of an averaged pair."""
    degrees = F.degrees(F.atan2(sin, cos))
    return F.when(degrees < 0, degrees + 360).otherwise(degrees), F.sqrt(sin * sin + cos * cos)
