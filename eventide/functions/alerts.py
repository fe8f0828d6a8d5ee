"""Alert texts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def alert_text(template: str, **columns: Column | str) -> Column:
    """``template`` with each ``{name}`` replaced by the column given for it,
    or by the column of that name; ``{{`` and ``}}`` stand for braces.  A null
    value reads ``null``, so that an alert never loses its text."""
    parts = []
    for piece in re.split(r"(\{\{|\}\}|\{\w+\})", template):
        if piece in ("{{", "}}"):
            parts.append(F.lit(piece[0]))
        elif piece.startswith("{") and piece.endswith("}"):
            c = columns.get(piece[1:-1], piece[1:-1])
            parts.append(F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("null")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")
