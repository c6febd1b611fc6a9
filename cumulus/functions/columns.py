"""Column-expression helpers.  Everything here returns a ``Column`` built
from built-in functions, so it stays inside whole-stage codegen."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cumulus.functions import constants as K


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify(value, thresholds: Sequence[tuple[float, str]] = K.SCORING_THRESHOLDS,
             default: str = K.SCORING_DEFAULT) -> Column:
    """First threshold strictly exceeded wins; NULL falls through to ``default``."""
    v = col(value)
    expr = None
    for bound, label in thresholds:
        expr = F.when(v > F.lit(bound), F.lit(label)) if expr is None else expr.when(v > F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def ratio_or_one(num, den) -> Column:
    """``num / den`` with a zero (or NULL) denominator replaced by 1."""
    d = col(den)
    return col(num) / F.when(d.isNull() | (d == 0), F.lit(1)).otherwise(d)


def distinct_from(a, b) -> Column:
    """SQL ``a IS DISTINCT FROM b``."""
    return ~col(a).eqNullSafe(col(b))


def day_bit(days_since, width: int = K.DATELIST_DAYS) -> Column:
    """Bit for a day ``days_since`` days before the as-of day (as-of = MSB)."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(width - 1) - col(days_since)).cast("int"))


def bits_in(mask_col, mask: int) -> Column:
    return F.bit_count(col(mask_col).bitwiseAND(F.lit(mask).cast("bigint"))).cast("bigint")


def bit_string(value, width: int = K.DATELIST_DAYS) -> Column:
    """Render an unsigned bitmap as a fixed-width 0/1 string."""
    return F.lpad(F.bin(col(value)), width, "0")


def normal_cdf(z) -> Column:
    """Standard normal CDF as a column expression.

    Uses the Abramowitz-Stegun 7.1.26 erf approximation (|error| < 1.5e-7),
    since ``erf`` is not among the built-in functions.
    """
    z = col(z)
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (F.lit(0.254829592) + t * (F.lit(-0.284496736) + t * (F.lit(1.421413741)
               + t * (F.lit(-1.453152027) + t * F.lit(1.061405429)))))
    erf = F.lit(1.0) - poly * F.exp(-x * x)
    return F.when(z >= 0, (F.lit(1.0) + erf) / 2).otherwise((F.lit(1.0) - erf) / 2)


def two_sided_p(z) -> Column:
    return F.lit(2.0) * (F.lit(1.0) - normal_cdf(F.abs(col(z))))


def ipv4_to_long(ip) -> Column:
    """Dotted IPv4 text to its unsigned 32-bit value (NULL if malformed)."""
    parts = F.split(col(ip), r"\.")
    octet = [F.get(parts, i).try_cast("bigint") for i in range(4)]
    valid = (F.size(parts) == 4)
    for o in octet:
        valid = valid & o.between(0, 255)
    value = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    return F.when(valid, value)


def json_object(*pairs: tuple[str, Column]) -> Column:
    """JSON text of a flat object, keeping NULL fields (as json_build_object)."""
    return F.to_json(F.struct(*[col(c).alias(k) for k, c in pairs]), {"ignoreNullFields": "false"})


def string_map(*pairs: tuple[str, Column]) -> Column:
    """``map<string,string>`` from (key, column) pairs."""
    args = []
    for k, c in pairs:
        args += [F.lit(k), col(c).cast("string")]
    return F.create_map(*args)
