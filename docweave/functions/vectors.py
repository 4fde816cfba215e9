"""Vector, hash and box expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes held as BIGINT."""
    return F.bit_count(a.bitwiseXOR(b))


def hash_from_hex(text: Column) -> Column:
    """16 hex digits as a signed BIGINT; the halves avoid the overflow of the top bit."""
    padded = F.lpad(text, 16, "0")
    high = F.conv(F.substring(padded, 1, 8), 16, 10).cast("bigint")
    low = F.conv(F.substring(padded, 9, 8), 16, 10).cast("bigint")
    return F.shiftleft(high, 32).bitwiseOR(low)


def sign_hash(vector: Column) -> Column:
    """Sign bits of a vector of up to 64 values as a BIGINT, value i at bit i; a longer vector raises."""
    message = F.lit("sign_hash takes vectors of up to 64 values")
    vector = F.when(F.size(vector) > 64, F.raise_error(message).cast("array<double>")).otherwise(vector.cast("array<double>"))
    found = F.lit(0).cast("bigint")
    for i in range(64):
        bit = F.lit((1 << i) if i < 63 else -(1 << 63)).cast("bigint")
        found = found.bitwiseOR(F.when(F.get(vector, F.lit(i)) > 0, bit).otherwise(F.lit(0).cast("bigint")))
    return found


def iou(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column) -> Column:
    """Intersection over union of two boxes, 0 when the union is empty."""
    zero = F.lit(0.0)
    width = F.greatest(zero, F.least(ax + aw, bx + bw) - F.greatest(ax, bx))
    height = F.greatest(zero, F.least(ay + ah, by + bh) - F.greatest(ay, by))
    inter = width * height
    union = aw * ah + bw * bh - inter
    return F.when(union > 0, F.try_divide(inter, union)).otherwise(zero)
