"""64-bit image hashes as BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


def sign_hash(vector: Column) -> Column:
    """Bit ``i`` is set where component ``i`` is positive; NULL unless there are 64."""
    zero = F.lit(0).cast("bigint")
    values = F.array(*(F.lit(1 << i if i < 63 else -(1 << 63)).cast("bigint") for i in range(BITS)))
    bits = F.zip_with(vector, values, lambda x, value: F.when(x > 0, value).otherwise(zero))
    return F.when(
        F.size(vector) == BITS, F.aggregate(bits, zero, lambda acc, bit: acc.bitwiseOR(bit))
    )


def hamming(left: Column, right: Column) -> Column:
    """Number of differing bits."""
    return F.bit_count(left.bitwiseXOR(right))


def hash_hex(value: Column) -> Column:
    """The 64 bits as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))
