"""Record quality on Spark: standardise extracted records, flatten, score and report.

Typical use::

    from labelqa import get_spark, standardize, leaves, scoring, stats
"""

__version__ = "0.1.0"

from .operators import extract, layout, leaves, prefix, scoring, standardize, stats  # noqa: E402,F401
from .session import durable, get_spark, spread  # noqa: E402,F401
