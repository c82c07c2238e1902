"""String functions with Java semantics, written as built-in Spark expressions.

Nothing here is a Python UDF: every function returns a Column that runs inside
whole-stage code generation (higher-order functions run interpreted, but still
in the JVM).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: Java's String.hashCode multiplier and the 32-bit mask.
_JAVA_HASH_BASE = 31
_MASK32 = 0xFFFFFFFF
#: Characters that mean something other than themselves in a regular expression.
_REGEX_SIGNS = frozenset("\\.[]{}()*+?^$|")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, sep: str = ",") -> Column:
    """``String.split(sep)`` with Java's limit-0 semantics.

    ``sep`` is a regular expression, as in Java. Leading and inner empty
    strings are kept, trailing ones are dropped; ``""`` gives ``[""]`` and an
    input made only of separators gives ``[]``. Spark's ``split`` keeps
    trailing empties, so the array is cut after its last non-empty element.
    """
    s = _col(c)
    if len(sep) == 1 and sep not in _REGEX_SIGNS:
        cut = F.rtrim(s, F.lit(sep))  # one plain character: without those at the end there are no trailing empties
        return F.when(s == "", F.array(F.lit(""))).when(cut == "", F.array().cast("array<string>")).otherwise(F.split(cut, sep, -1))
    parts = F.split(s, sep, -1)
    last = F.array_max(F.transform(parts, lambda x, i: F.when(x != "", i + 1).otherwise(0)))
    return F.when(s == "", F.array(F.lit(""))).otherwise(F.slice(parts, F.lit(1), last))


def utf16_length(c) -> Column:
    """``String.length()``: UTF-16 code units (code points above U+FFFF count twice)."""
    s = _col(c)
    return (F.length(s) + F.size(F.regexp_extract_all(s, F.lit("([\\x{10000}-\\x{10FFFF}])"), 1))
            ).cast("int")


def java_hash(c, factor: int = 1) -> Column:
    """``String.hashCode() * factor`` with 32-bit wrap-around, as an int.

    h = 31*h + char over the UTF-16 code units, computed as an unsigned 32-bit
    fold in a bigint accumulator, then multiplied, masked and re-signed. A
    character above U+FFFF counts as its two surrogate units.
    """
    s = _col(c)
    chars = F.filter(F.split(s, ""), lambda x: x != "")

    def step(acc, ch):
        code = F.ascii(ch).cast("bigint")
        high = acc * _JAVA_HASH_BASE + F.lit(0xD800) + F.shiftright(code - 0x10000, 10)
        pair = high.bitwiseAND(F.lit(_MASK32)) * _JAVA_HASH_BASE + F.lit(0xDC00) + code.bitwiseAND(F.lit(0x3FF))
        return F.when(code < 0x10000, acc * _JAVA_HASH_BASE + code).otherwise(pair).bitwiseAND(F.lit(_MASK32))

    h = F.aggregate(chars, F.lit(0).cast("bigint"), step)
    u = (h * F.lit(factor % (1 << 32)).cast("bigint")).bitwiseAND(F.lit(_MASK32))
    signed = F.when(u >= F.lit(1 << 31), u - F.lit(1 << 32)).otherwise(u)
    return F.when(s.isNull(), F.lit(None)).otherwise(signed.cast("int"))


def java_hash_py(s: str, factor: int = 1) -> int:
    """Plain-Python twin of :func:`java_hash` (used by tests and the UDF path)."""
    h = 0
    for ch in s.encode("utf-16-be").decode("utf-16-be"):
        for unit in _utf16_units(ch):
            h = (h * _JAVA_HASH_BASE + unit) & _MASK32
    u = (h * (factor % (1 << 32))) & _MASK32
    return u - (1 << 32) if u >= (1 << 31) else u


def _utf16_units(ch: str):
    b = ch.encode("utf-16-be")
    return [int.from_bytes(b[i:i + 2], "big") for i in range(0, len(b), 2)]


def java_split_py(s: str, sep: str) -> list[str]:
    """Plain-Python twin of :func:`java_split` (reference semantics for tests)."""
    if s == "":
        return [""]
    parts = re.split(sep, s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts
