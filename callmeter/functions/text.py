"""Text checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted address format.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


def is_valid_email(email: Column | str) -> Column:
    """True where the text is an address; NULL counts as not valid."""
    col = F.col(email) if isinstance(email, str) else email
    return F.coalesce(col.rlike(EMAIL_PATTERN), F.lit(False))
