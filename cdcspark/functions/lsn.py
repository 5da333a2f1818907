"""Names, operation codes and log positions of a change feed.

A log position (LSN) is ten bytes compared as an unsigned number. Spark orders
``BinaryType`` byte by byte without sign, which is the same order as long as
every value has the same width, so positions are padded to ten bytes once, on
the way in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column names and operation codes found in the change tables.
OP = "__$operation"
LSN = "__$start_lsn"
SEQ = "__$seqval"
SYNC = "__$last_sync"
DELETE, INSERT, UPDATE = 1, 2, 4
APPLIED_OPS = (DELETE, INSERT, UPDATE)

# Rows that end a transaction: their operation code, and the columns that say how many changes it has and which position the
# transaction before it has.
END = 0
TX_CHANGES = "__$changes"
TX_PREVIOUS = "__$previous"

LSN_BYTES = 10
ZERO_LSN = bytes(LSN_BYTES)


def pad_lsn(value: bytes | bytearray | None) -> bytes:
    """A Python-side position in its ten-byte form; ``None`` is the start of the log."""
    if value is None:
        return ZERO_LSN
    raw = bytes(value)
    if len(raw) > LSN_BYTES:
        raise ValueError(f"log position has {len(raw)} bytes, at most {LSN_BYTES} are allowed")
    return raw.rjust(LSN_BYTES, b"\x00")


def to_lsn(col: Column) -> Column:
    """Cast to binary and left-pad to ten bytes; longer values become null."""
    raw = col.cast("binary")
    return F.when(F.octet_length(raw) <= LSN_BYTES, F.call_function("lpad", raw, F.lit(LSN_BYTES), F.lit(b"\x00")))


def lsn_from_number(col: Column) -> Column:
    """Ten-byte position of a non-negative whole number."""
    return F.unhex(F.lpad(F.hex(col.cast("bigint")), 2 * LSN_BYTES, "0"))


def lsn_hex(col: Column) -> Column:
    """Position as text, the way it is shown in logs (``0x…``)."""
    return F.concat(F.lit("0x"), F.hex(col))


def lsn_literal(value: bytes | None) -> Column:
    return F.lit(pad_lsn(value))


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row that also tells nulls apart.

    ``xxhash64`` skips nulls, so ``(null, 'a')`` and ``('a', null)`` would meet;
    hashing the null flags as well separates them.
    """
    values = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(*values, *[v.isNull() for v in values])
