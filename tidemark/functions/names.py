"""Column references by exact name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """``F.col`` for a name taken literally (a dot or a space in a field name
    is part of the name, not a path)."""
    return F.col("`" + name.replace("`", "``") + "`")
