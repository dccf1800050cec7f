"""Column names that a caller's table does not have."""

from pyspark.sql import DataFrame


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """The stems behind so many underscores that none is a column of ``df``, in any case."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any(prefix + stem in taken for stem in stems):
        prefix += "_"
    return [prefix + stem for stem in stems]
