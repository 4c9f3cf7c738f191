"""Join helpers with explicit size discipline.

``broadcast`` is used only for tables whose size is proven: either built
from a fixed literal asset (bytes known on the driver without a job),
or materialised to the shared checkpoint folder and counted first.  Above
the bound the caller's fallback (a shuffle join, with AQE skew handling)
is used instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casework.session import cut_lineage

# Size of a derived lookup table we are willing to ship to every executor.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def materialize_checked(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                        max_bytes: int = DEFAULT_BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """Checkpoint a derived table (reliable, shared folder), measure it (row
    count and an upper estimate of its bytes: string lengths plus 16 bytes
    per field) in one job, and say whether it may be broadcast.
    Returns (table, small_enough)."""
    from pyspark.sql import types as T
    table = cut_lineage(df)
    strings = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    width = 16 * max(len(table.columns), 1)
    size = F.lit(width) + sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in strings), F.lit(0))
    row = table.agg(F.count(F.lit(1)).alias("n"), F.sum(size.cast("long")).alias("b")).first()
    n, b = row["n"], row["b"] or 0
    return table, n <= max_rows and b <= max_bytes
