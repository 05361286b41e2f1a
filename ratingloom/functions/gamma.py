"""The gamma function's logarithm and its derivative for positive numbers: as column expressions, or of arrays with
``ln`` for arrays."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, functions as F

# The series below are good to eight digits from here on; smaller numbers are shifted by a recurrence.
SHIFT = 6
HALF_LOG_TWO_PI = 0.5 * math.log(2 * math.pi)


def digamma(x: Column, ln=F.ln) -> Column:
    y = x + SHIFT
    square = y * y
    series = ln(y) - 1 / (2 * y) - (1 / square) * (1 / 12 - (1 / square) * (1 / 120 - 1 / (252 * square)))
    return reduce(lambda total, i: total - 1 / (x + i), range(SHIFT), series)


def log_gamma(x: Column, ln=F.ln) -> Column:
    y = x + SHIFT
    square = y * y
    series = (y - 0.5) * ln(y) - y + HALF_LOG_TWO_PI + (1 / y) * (1 / 12 - (1 / square) * (
        1 / 360 - 1 / (1260 * square)))
    return series - ln(reduce(lambda total, i: total * (x + i), range(1, SHIFT), x))
