"""Landing: the ten source fields as text, stamped with source and load time."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnmill.functions.text import strip
from txnmill.functions.times import parse_iso
from txnmill.profiles import Profile
from txnmill.schema import LANDING_FIELDS, RECORD_FIELDS


def _cleaned(name: str) -> Column:
    """Merchant names keep their blanks: a name of blanks only is a rule violation of its own."""
    value = F.col(name).cast("string")
    if name == "merchant_name":
        return value
    return F.upper(strip(value)) if name == "transaction_id" else strip(value)


def land(records: DataFrame, profile: Profile, keep: Sequence[str] = ()) -> DataFrame:
    """Pick the ten fields as text; the incremental profile also cleans them. ``keep`` names other columns
    to pass on."""
    take = _cleaned if profile.cleans_text else (lambda name: F.col(name).cast("string"))
    fields = [take(field).alias(landed) for field, landed in zip(RECORD_FIELDS, LANDING_FIELDS)]
    return records.select(*fields, *keep)


def stamp(landed: DataFrame, source_system: str, loaded_at: str) -> DataFrame:
    """Add the batch constants. ``loaded_at`` is an ISO-Z text in whole seconds."""
    return landed.withColumns(
        {
            "source_system": F.lit(source_system),
            "ingestion_timestamp": parse_iso(F.lit(loaded_at)),
        }
    )
