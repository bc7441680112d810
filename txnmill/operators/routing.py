"""Split a validated frame into quarantined and valid rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.schema import QUARANTINE_COLUMNS, VALID_COLUMNS


def _present(frame: DataFrame, columns: list[str]) -> list[str]:
    """Frames that were never stamped simply lack the stamp columns."""
    return [name for name in columns if name in frame.columns]


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.filter(~F.col("is_valid")).select(_present(validated, QUARANTINE_COLUMNS))


def valid(validated: DataFrame) -> DataFrame:
    return validated.filter("is_valid").select(_present(validated, VALID_COLUMNS))


def duplicates(bronze: DataFrame) -> DataFrame:
    return bronze.filter("is_duplicate")


def unique(bronze: DataFrame) -> DataFrame:
    return bronze.filter(~F.col("is_duplicate"))


def sample_by_id(rows: DataFrame, columns: list[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in id order, for display (a top-n, not a full sort)."""
    return rows.select(columns).orderBy(columns).limit(n)
