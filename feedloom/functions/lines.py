"""Column expressions for the ``id,name,address,continent`` line format."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whole field must be a plain decimal number; a cast alone would also take
# surrounding blanks.
STRICT_INTEGER = r"\A[+-]?[0-9]+\z"


def head(line: Column, n: int) -> Column:
    """The line up to, but without, its ``n``-th comma; all of it if it has fewer."""
    return F.substring_index(line, ",", n)


def last_field(part: Column) -> Column:
    return F.substring_index(part, ",", -1)


def rest(line: Column, start: Column) -> Column:
    """What follows the comma after ``start``, further commas included.

    Cut by bytes, not characters: a broken multi-byte character in front of a
    comma would shift a count of characters.
    """
    return F.substr(line.cast("binary"), F.octet_length(start) + 2).cast("string")


def strict_id(field: Column) -> Column:
    """The field as a signed 64-bit number, NULL unless it is exactly that."""
    return F.when(field.rlike(STRICT_INTEGER), field.try_cast("bigint"))


def name_of(line: Column) -> Column:
    return last_field(head(line, 2))


def continent_of(line: Column) -> Column:
    return rest(line, head(line, 3))


def format_line(*fields: Column) -> Column:
    """The inverse of the parser: fields joined by commas."""
    return F.concat_ws(",", *[field.cast("string") for field in fields])


def fingerprint(line: Column) -> Column:
    """Aggregate: a digest of a multiset of lines, whatever their order.

    Four sums, one per 16 bits of each line's hash: none can overflow before 2**47
    lines, and unlike a sum of whole hashes they need no decimals.
    """
    hashed = F.xxhash64(line)
    parts = [F.shiftrightunsigned(hashed, shift).bitwiseAND(0xFFFF) for shift in (0, 16, 32, 48)]
    return F.array(*[F.coalesce(F.sum(part), F.lit(0)) for part in parts])
