"""Rating validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewsieve.fixed_values import VALID_RATINGS

# Plain decimal notation with an optional exponent. The guard keeps out forms
# that a cast would accept, such as `5d`, and the text of a boolean.
DECIMAL_NUMBER = (
    r"^[ \t\r\n]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?[ \t\r\n]*$"
)


def validate_rating(value: Column) -> Column:
    """The rating as an int from 1 to 5, else null. Takes a column of any type."""
    as_text = value.cast("string")
    number = F.when(F.rlike(as_text, F.lit(DECIMAL_NUMBER)), as_text.try_cast("double"))
    return F.when(number.isin(*[float(r) for r in VALID_RATINGS]), number.cast("int"))
