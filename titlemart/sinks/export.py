"""Export a table to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Keeps microseconds when times go through text.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
FORMATS = ("CSV", "NEWLINE_DELIMITED_JSON", "PARQUET", "AVRO")


def export_table(
    df: DataFrame,
    path: str,
    export_format: str = "CSV",
    compression: str = "NONE",
    field_delimiter: str = ",",
    print_header: bool = True,
) -> None:
    """Write rows as files, one per task. Delimiter and header count for CSV
    only, where nested columns become JSON text."""
    export_format = export_format.upper()
    if export_format not in FORMATS:
        raise ValueError(f"{export_format} is not one of {', '.join(FORMATS)}")
    writer_options = {"compression": compression.lower()}
    if export_format in ("CSV", "NEWLINE_DELIMITED_JSON"):
        writer_options |= {"timestampNTZFormat": TIME_FORMAT}
    if export_format == "CSV":
        nested = (T.ArrayType, T.StructType, T.MapType)
        df = df.select(
            *[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
              for f in df.schema.fields]
        )
        writer_options |= {"sep": field_delimiter, "header": str(print_header), "escape": '"'}
        df.write.options(**writer_options).csv(path)
    elif export_format == "NEWLINE_DELIMITED_JSON":
        df.write.options(**writer_options, ignoreNullFields="true").json(path)
    else:
        df.write.options(**writer_options).format(export_format.lower()).save(path)
