"""128-bit ids: Crockford base32 (ULID) and hexadecimal (UUID) printings of one value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Crockford alphabet and the base-32 digits that conv() reads.
CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

_BLANKS = " \t\n\r\f\v\u00a0\u2007\u202f\u3000\u200b\ufeff"


def trimmed(value: Column) -> Column:
    """Without blanks of any kind at either end; null stays null."""
    return F.btrim(value, F.lit(_BLANKS))


def present(value: Column) -> Column:
    """True where a reference is neither null nor blank."""
    return F.coalesce(F.length(trimmed(value)) > 0, F.lit(False))


def _hex(piece: Column, width: int) -> Column:
    return F.lpad(F.conv(piece, 32, 16), width, "0")


def id_text(value: Column) -> Column:
    """The canonical printing, 26 upper-case base32 characters, of an id in any usual one.

    Read are 26 base32 characters of either case (I and L count as 1, O as 0) and
    32 hexadecimal digits with or without hyphens, braces or ``urn:uuid:``.  Null,
    blank and malformed values (other lengths, foreign characters, more than 128
    bits) give null.  The common printing costs a trim and a test; only hexadecimal
    ones are converted.
    """
    text = F.upper(trimmed(value))
    bare = F.translate(F.replace(text, F.lit("URN:UUID:"), F.lit("")), "{}-", "")

    def part(start: int, width: int, chars: int) -> Column:
        return F.lpad(F.conv(F.substring(bare, start, width), 16, 32), chars, "0")

    from_hex = F.translate(F.concat(part(1, 2, 2), part(3, 15, 12), part(18, 15, 12)), DIGITS32, CROCKFORD)
    return F.when((F.length(text) == 26) & text.rlike("^[0-7][0-9A-TV-Z]{25}$"), F.translate(text, "ILO", "110")).when(
        (F.length(bare) == 32) & bare.rlike("^[0-9A-F]{32}$"), from_hex
    )


def id_hex(value: Column) -> Column:
    """The 32 upper-case hexadecimal digits of an id in any usual printing; else null."""
    digits = F.translate(id_text(value), CROCKFORD, DIGITS32)

    def part(start: int, chars: int, width: int) -> Column:
        return F.lpad(F.conv(F.substring(digits, start, chars), 32, 16), width, "0")

    return F.concat(part(1, 2, 2), part(3, 12, 15), part(15, 12, 15))


def id_key(kind: Column, value: Column) -> Column:
    """Typed key of a reference: a letter for its type and the canonical id; ids of
    different types never meet.  Null where the id is malformed."""
    return F.concat(kind, id_text(value))
