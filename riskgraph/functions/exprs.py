"""Column expressions shared by the reports. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ratio bucket labels and the component-size bin labels.
# The leading blanks make lexical order equal size order.
RATIO_ZERO, RATIO_ONE, RATIO_BETWEEN = "0", "1", "Between 0-1"
SIZE_BINS = [" 1", " 2", " 3", " 4-10", "11-50", ">50"]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ratio(num, den) -> Column:
    """num / den as double; null (never an error) when den is 0 or null."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def ratio_bucket(num, den) -> Column:
    """'0' / '1' / 'Between 0-1' of num/den, decided on the integers so no
    float equality is involved; a null ratio falls to the ELSE branch."""
    n, d = _c(num), _c(den)
    return (F.when((d != 0) & (n == 0), F.lit(RATIO_ZERO))
            .when((d != 0) & (n == d), F.lit(RATIO_ONE))
            .otherwise(F.lit(RATIO_BETWEEN)))


def size_bin(size) -> Column:
    s = _c(size)
    return (F.when(s == 1, F.lit(SIZE_BINS[0]))
            .when(s == 2, F.lit(SIZE_BINS[1]))
            .when(s == 3, F.lit(SIZE_BINS[2]))
            .when((s > 3) & (s <= 10), F.lit(SIZE_BINS[3]))
            .when((s > 10) & (s <= 50), F.lit(SIZE_BINS[4]))
            .when(s > 10, F.lit(SIZE_BINS[5])))


def uid8(guid) -> Column:
    """8-character display id. Integer guids are first turned into a string
    id with md5 so the prefix behaves like one of a random 128-bit id."""
    return F.left(F.md5(_c(guid).cast("string")), F.lit(8))


def inverse_degree_weight(degree) -> Column:
    """1/(degree-1); +Infinity for a degree-1 identifier (IEEE semantics)."""
    d = _c(degree).cast("double")
    return F.when(d == 1.0, F.lit(float("inf"))).otherwise(F.try_divide(F.lit(1.0), d - F.lit(1.0)))


def r6(x) -> Column:
    return F.round(_c(x), 6)


def r3(x) -> Column:
    return F.round(_c(x), 3)
