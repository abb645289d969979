"""Raw tables: ``raw_data variant`` + ``loaded_at timestamp_ntz``.

``raw_data`` is the unwrapped record ``{extraction_date, source_file, record}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import iso_date


def landing_file_name(source: str, extraction_date: Column) -> Column:
    """``<source>_<yyyy-MM-dd>.json``, the landing file of one source and date."""
    return F.concat(F.lit(f"{source}_"), iso_date(extraction_date), F.lit(".json"))


def to_raw(records: DataFrame, source: str, record_col: str = "record",
           date_col: str = "extraction_date", loaded_at_col: str = "loaded_at",
           source_file: Column | None = None) -> DataFrame:
    """Wrap typed records as raw variant rows."""
    sf = source_file if source_file is not None else landing_file_name(source, F.col(date_col))
    envelope = F.struct(
        iso_date(F.col(date_col)).alias("extraction_date"),
        sf.alias("source_file"),
        F.col(record_col).alias("record"),
    )
    return records.select(F.to_variant_object(envelope).alias("raw_data"),
                          F.col(loaded_at_col).cast("timestamp_ntz").alias("loaded_at"))
