"""Normal distribution as column expressions (Spark has neither erf nor a normal tail)."""

from __future__ import annotations

import math
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# W. J. Cody, "Rational Chebyshev approximations for the error function" (1969).
# Each list runs from the highest power down to the constant.
ERF_NUM = [1.85777706184603153e-1, 3.16112374387056560e0, 1.13864154151050156e2,
           3.77485237685302021e2, 3.20937758913846947e3]
ERF_DEN = [1.0, 2.36012909523441209e1, 2.44024637934444173e2, 1.28261652607737228e3,
           2.84423683343917062e3]
MID_NUM = [2.15311535474403846e-8, 5.64188496988670089e-1, 8.88314979438837594e0,
           6.61191906371416295e1, 2.98635138197400131e2, 8.81952221241769090e2,
           1.71204761263407058e3, 2.05107837782607147e3, 1.23033935479799725e3]
MID_DEN = [1.0, 1.57449261107098347e1, 1.17693950891312499e2, 5.37181101862009858e2,
           1.62138957456669019e3, 3.29079923573345963e3, 4.36261909014324716e3,
           3.43936767414372164e3, 1.23033935480374942e3]
TAIL_NUM = [1.63153871373020978e-2, 3.05326634961232344e-1, 3.60344899949804439e-1,
            1.25781726111229246e-1, 1.60837851487422766e-2, 6.58749161529837803e-4]
TAIL_DEN = [1.0, 2.56852019228982242e0, 1.87295284992346725e0, 5.27905102951428412e-1,
            6.05183413124413191e-2, 2.33520497626869185e-3]


def _polynomial(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def _erfc_of_magnitude(z: Column) -> Column:
    square = z * z
    inner = F.lit(1.0) - z * _polynomial(ERF_NUM, square) / _polynomial(ERF_DEN, square)
    middle = F.exp(-square) * _polynomial(MID_NUM, z) / _polynomial(MID_DEN, z)
    inverse = F.lit(1.0) / square
    correction = inverse * _polynomial(TAIL_NUM, inverse) / _polynomial(TAIL_DEN, inverse)
    outer = F.exp(-square) * (F.lit(1 / math.sqrt(math.pi)) - correction) / z
    return F.when(z <= 0.46875, inner).when(z <= 4.0, middle).otherwise(outer)


def erfc(x: Column) -> Column:
    tail = _erfc_of_magnitude(F.abs(x))
    return F.when(x < 0, F.lit(2.0) - tail).otherwise(tail)


def normal_cdf(z: Column) -> Column:
    return erfc(-z / F.lit(math.sqrt(2))) / 2


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / F.lit(math.sqrt(2)))


def quantile(probability: float) -> float:
    return NormalDist().inv_cdf(probability)
