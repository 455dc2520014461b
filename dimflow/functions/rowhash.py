"""Order-independent table checksums.

A row becomes text, the text a SHA-256 digest, the low 64 bits of the digests are folded over the
table. The folds have map-side partials, so a table of any size sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(field: T.StructField) -> str:
    """One value as text that does not depend on the engine that wrote it, in SQL."""
    name = "`" + field.name.replace("`", "``") + "`"
    if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')"
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return f"to_json(struct({name}))"
    return f"cast({name} as string)"


def row_text(schema: T.StructType, strict: bool = False) -> Column:
    """All columns of a row joined with ``|``.

    By default NULL reads as the empty string and ``|`` inside a value is not escaped. ``strict``
    escapes the separator and gives NULL a mark of its own.
    """
    texts = [canonical_text(field) for field in schema.fields]
    if strict:
        texts = [rf"coalesce(replace(replace({t}, '\\', '\\\\'), '|', '\\|'), '\\N')" for t in texts]
    else:
        texts = [f"coalesce({t}, '')" for t in texts]
    return F.expr(f"concat_ws('|', {', '.join(texts)})")


def digest_halves(text: Column) -> list[Column]:
    """The low 64 bits of the SHA-256 of ``text``, as two non-negative 32-bit numbers."""
    low = F.conv(F.substring(F.sha2(text, 256), 49, 16), 16, -10).cast("bigint")  # a negative base: signed
    return [F.shiftrightunsigned(low, 32), low.bitwiseAND(F.lit(0xFFFFFFFF))]


def fold(halves: list[Column]) -> Column:
    """XOR of all digests as an unsigned decimal number in text; ``0`` for an empty table."""
    digits = [F.lpad(F.hex(F.coalesce(F.bit_xor(half), F.lit(0))), 8, "0") for half in halves]
    return F.conv(F.concat(*digits), 16, 10)


def strict_fold(halves: list[Column]) -> Column:
    """The XOR fold followed by the sums of both halves, so that equal rows do not cancel out."""
    sums = [F.coalesce(F.sum(half.cast("decimal(20,0)")), F.lit(0)).cast("string") for half in halves]
    return F.concat_ws(":", fold(halves), *sums)
