"""The steps and reports on cubes. Importing the package registers every step."""

from gridspark.operators import (  # noqa: F401
    arith,
    blocks,
    cells,
    checks,
    climatology,
    coverage,
    forecast,
    masks,
    regrid,
    resample,
    select,
    vertical,
)
