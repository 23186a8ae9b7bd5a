"""Keep Catalyst from evaluating one costly expression many times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def evaluated_once(column: Column) -> Column:
    """The same value, computed once per row; use as a select item of its own.

    A filter on a derived column is pushed below the projection that derives it by
    substituting the expression, once per mention. For a parsed JSON document or a gate
    built from two dozen comparisons this repeats the work for every mention. Exploding
    an array of one element keeps rows and values as they are, and filters on the result
    stay above it, while filters on other columns still reach the scan.

    The expansion leaves generated code for one operator. That costs about a microsecond
    per row here, against several times more for the large method that the repeated
    expression compiles to, which the JVM then refuses to optimise.
    """
    return F.explode(F.array(column))
