"""CRC-32C of bytes, in one value or in pieces that many tasks hold."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Castagnoli polynomial with its bits reversed, and the register's start.
POLYNOMIAL = 0x82F63B78
START = 0xFFFFFFFF

# Lengths below 2 to this power (in bytes) can be moved over.
_LENGTH_BITS = 48


def byte_table() -> list[int]:
    """What each byte value does to an empty register."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (POLYNOMIAL if value & 1 else 0)
        table.append(value)
    return table


def _apply(matrix: Sequence[int], register: int) -> int:
    out = 0
    for bit, column in enumerate(matrix):
        if register >> bit & 1:
            out ^= column
    return out


def _powers(matrix: list[int]) -> list[list[int]]:
    """A step over one byte, then over 2, 4, 8 ... bytes, each as 32 columns."""
    found = [matrix]
    while len(found) < _LENGTH_BITS:
        found.append([_apply(found[-1], column) for column in found[-1]])
    return found


def _forward() -> list[list[int]]:
    """The register after zero bytes."""
    table = byte_table()
    return _powers([table[1 << b & 255] ^ (1 << b >> 8) for b in range(32)])


def _backward() -> list[list[int]]:
    """The register before zero bytes: the step forward can be undone, as the polynomial ends in one."""
    def undo(register: int) -> int:
        for _ in range(8):
            register = (register ^ POLYNOMIAL) << 1 | 1 if register >> 31 else register << 1
        return register

    return _powers([undo(1 << b) for b in range(32)])


def _has_bit(value: Column, bit: Column) -> Column:
    return F.call_function("shiftright", value, bit).bitwiseAND(F.lit(1)) == 1


def _moved(register: Column, length: Column, steps: list[list[int]]) -> Column:
    """The register moved over ``length`` bytes, one step for every bit set in it."""
    columns = F.lit([column for matrix in steps for column in matrix])
    used = F.filter(F.sequence(F.lit(0), F.lit(_LENGTH_BITS - 1)), lambda power: _has_bit(length, power))

    def step(register: Column, power: Column) -> Column:
        places = F.sequence(F.lit(0), F.lit(31))
        return F.aggregate(
            F.filter(places, lambda b: _has_bit(register, b)), F.lit(0).cast("bigint"),
            lambda out, b: out.bitwiseXOR(F.get(columns, power * 32 + b)),
        )

    return F.aggregate(used, register, step)


def _folded(content: Column, start: int) -> Column:
    """The register after all bytes of ``content``, from ``start``."""
    table = F.lit(byte_table())
    # Signs of this character set are the bytes; splitting an empty text would leave one empty sign.
    signs = F.split(F.decode(content, "ISO-8859-1"), "")
    some = F.when(F.octet_length(content) > 0, signs).when(content.isNotNull(), F.array().cast("array<string>"))
    return F.aggregate(
        some, F.lit(start).cast("bigint"),
        lambda register, sign: F.get(table, register.bitwiseXOR(F.ascii(sign)).bitwiseAND(F.lit(255)).cast("int"))
        .bitwiseXOR(F.shiftright(register, 8)),
    )


def crc32c(content: Column | str) -> Column:
    """CRC-32C of a binary column as a bigint; null for null, 0 for no bytes."""
    value = F.col(content) if isinstance(content, str) else content
    return _folded(value, START).bitwiseXOR(F.lit(START))


def crc32c_of_pieces(pieces: DataFrame, *keys: str, start: str = "start", content: str = "content") -> DataFrame:
    """``keys, size, crc32c`` of objects given in pieces, each with the byte it begins at.

    A piece is folded by itself and moved back to byte 0, where the pieces of an
    object add up by exclusive or in any order: one aggregation, combined before the
    shuffle, whatever the size of an object.  An object without gaps or overlaps is
    taken for granted but for the sum of lengths, which must reach its last byte:
    ``crc32c`` is null where it does not, or where a piece is null.
    """
    length = F.octet_length(content).cast("bigint")
    end = F.col(start).cast("bigint") + length
    alone = _moved(_folded(F.col(content), 0), end, _backward())
    placed = pieces.select(*keys, alone.alias("_part"), end.alias("_end"), length.alias("_length"))
    sums = placed.groupBy(*keys).agg(
        F.bit_xor("_part").alias("_sum"), F.max("_end").alias("size"), F.sum("_length").alias("_bytes"),
        F.count_if(F.col("_part").isNull()).alias("_nulls"),
    )
    # The start of the register counts like bytes before the first one.
    whole = _moved(F.col("_sum").bitwiseXOR(F.lit(START)), F.col("size"), _forward()).bitwiseXOR(F.lit(START))
    complete = (F.col("_bytes") == F.col("size")) & (F.col("_nulls") == 0)
    return sums.select(*keys, "size", F.when(complete, whole).alias("crc32c"))


def crc_text(crc: Column | str, encoding: str = "base64") -> Column:
    """A 32-bit sum as shown in listings: its four bytes, highest first, in base64 or hex."""
    value = F.col(crc) if isinstance(crc, str) else crc
    digits = F.lpad(F.hex(value), 8, "0")
    return F.base64(F.unhex(digits)) if encoding == "base64" else digits
