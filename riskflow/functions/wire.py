"""Registry wire framing as native column expressions (no UDF).

A framed message is ``0x00`` + a 4-byte big-endian schema id + the Avro body.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEADER_BYTES = 5


def strip_header(value: Column) -> Column:
    """Drop the 5 header bytes when the payload is longer than the header.

    Null stays null; a payload of 5 bytes or fewer is returned unchanged (the
    magic byte is not checked), which is how the reference behaves.
    ``substring`` on a binary column keeps the binary type.
    """
    n = F.length(value)
    return F.when(n > HEADER_BYTES, F.substring(value, HEADER_BYTES + 1, 2**31 - 1)).otherwise(value)


def magic_byte(value: Column) -> Column:
    """First byte as an int (0 for a registry frame), null for empty/null."""
    return F.when(F.length(value) >= 1,
                  F.conv(F.hex(F.substring(value, 1, 1)), 16, 10).cast("int"))


def schema_id(value: Column) -> Column:
    """Big-endian int in bytes 2..5, null when the frame is too short."""
    return F.when(F.length(value) >= HEADER_BYTES,
                  F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def header(schema_id_value: int) -> Column:
    """The 5-byte header for ``schema_id_value`` as a binary literal."""
    return F.lit(bytes([0]) + int(schema_id_value).to_bytes(4, "big"))


def frame(body: Column, schema_id_value: int) -> Column:
    """Header + body; null body stays null."""
    return F.concat(header(schema_id_value), body)
