"""The weights of a centred window over the bins of a period."""

from __future__ import annotations

import math


def window(size: int, weighting: str = "constant", scale: float | None = None) -> list[tuple[int, float]]:
    """``(offset, weight)`` of ``size`` bins; the middle one, or the later of the two in the middle, is 0.

    All weights are ``exp(-rate * |offset| ** power)``. ``constant`` has the rate 0. ``gaussian`` falls with the
    square, by its standard deviation ``scale`` (if not given, half of the farthest offset). ``geometric``
    falls by the ratio ``scale`` from bin to bin (if not given, to a tenth at the farthest).
    """
    first = -(size // 2)
    offsets = list(range(first, first + size))
    if not offsets:
        raise ValueError(f"{size} bins make no window")
    far = -first or 1
    match weighting:
        case "constant":
            rate, power = 0.0, 1
        case "gaussian":
            spread = far / 2 if scale is None else scale
            if not spread > 0:
                raise ValueError(f"a gaussian with the standard deviation {spread} has no width")
            rate, power = 0.5 / spread**2, 2
        case "geometric":
            ratio = 0.1 ** (1 / far) if scale is None else scale
            if not 0 < ratio <= 1:
                raise ValueError(f"weights that change by {ratio} from bin to bin do not fall")
            rate, power = -math.log(ratio), 1
        case _:
            raise ValueError(f"weights are constant, gaussian or geometric, not {weighting!r}")
    return [(k, math.exp(-rate * abs(k) ** power)) for k in offsets]
