"""Column-name cleaning."""

from collections import Counter

from pyspark.sql import DataFrame


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim names, lower-case them and turn inner spaces into underscores, in one projection.

    Two names that become equal would make every later reference ambiguous, so that is an error.
    """
    cleaned = [name.strip().lower().replace(" ", "_") for name in df.columns]
    clashes = sorted(name for name, n in Counter(cleaned).items() if n > 1)
    if clashes:
        raise ValueError(f"column names collide after cleaning: {', '.join(clashes)}")
    return df.toDF(*cleaned)
