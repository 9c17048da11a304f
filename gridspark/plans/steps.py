"""Named steps ``Cube -> Cube`` and lists of them, as a recipe gives them."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from typing import Any

from gridspark.cube import Cube

STEPS: dict[str, Callable[..., Cube]] = {}


def step(function: Callable[..., Cube]) -> Callable[..., Cube]:
    """Register ``function`` as the step of its name."""
    STEPS[function.__name__] = function
    return function


def process(cube: Cube, steps: Iterable[Mapping[str, Any]]) -> Cube:
    """Apply ``steps`` in order; each is a table with the step's ``name`` and its arguments.

    Names and arguments are checked for every step before the first one is applied.
    """
    bound = []
    for number, table in enumerate(steps, start=1):
        arguments = dict(table)
        name = arguments.pop("name", None)
        if name not in STEPS:
            raise ValueError(f"step {number}: no step named {name!r}")
        try:
            inspect.signature(STEPS[name]).bind(cube, **arguments)
        except TypeError as error:
            raise ValueError(f"step {number} ({name}): {error}") from None
        bound.append((STEPS[name], arguments))
    return reduce(lambda state, call: call[0](state, **call[1]), bound, cube)
