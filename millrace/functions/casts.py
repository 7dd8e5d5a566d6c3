"""Casts that give NULL instead of an error for values that do not fit.

Spark's `try_cast` of malformed text to a number or truth value throws and
catches an exception per value, some hundred times the cost of a good value.
A pattern therefore sorts out such text first; what it lets through casts.
Matching costs more than casting, so text that looks like a number at a glance
is cast at once, and only if that gives NULL does the pattern decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Decimal digits of the greatest value of each whole-number type.
_WHOLE_NUMBERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}

# What Spark's non-ANSI casts accept from text.
_EDGE = r"[\x00-\x20\x7f]*"
_DECIMAL = r"(\d+\.?\d*|\.\d+)(e[+-]?\d+)?"
_HEXADECIMAL = r"0x([0-9a-f]+\.?[0-9a-f]*|\.[0-9a-f]+)p[+-]?\d+"
_FLOAT = rf"(?i)^{_EDGE}[+-]?(({_DECIMAL}|{_HEXADECIMAL})[fd]?|nan|inf|infinity){_EDGE}$"
_EXACT_DECIMAL = rf"(?i)^{_EDGE}[+-]?{_DECIMAL}{_EDGE}$"
_TRUTH = rf"(?i)^{_EDGE}(t|true|y|yes|1|f|false|n|no|0){_EDGE}$"

_GUARDS = {
    T.FloatType: _FLOAT,
    T.DoubleType: _FLOAT,
    T.DecimalType: _EXACT_DECIMAL,
    T.BooleanType: _TRUTH,
}


def lenient_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast `value` from type `source` to `target`; NULL where it is malformed or too large.

    Text to whole number follows the non-ANSI rule: '12.7' is 12, '1e3' is NULL.
    """
    if source == target:
        return value
    if isinstance(source, T.StringType):
        if type(target) in _WHOLE_NUMBERS:
            return _text_to_whole_number(value, target)
        if type(target) in _GUARDS:
            checked = F.when(value.rlike(_GUARDS[type(target)]), value.try_cast(target))
            if type(target) in (T.FloatType, T.DoubleType):
                likely = F.when(_starts_like_a_number(value, 17), value.try_cast(target))
                return F.coalesce(likely, checked)
            return checked
    return value.try_cast(target)


def _starts_like_a_number(value: Column, longest: int) -> Column:
    """Short and a digit first: tests that copy no text and stay small when compiled."""
    return (F.octet_length(value) <= longest) & (value >= "0") & (value < ":")


def _text_to_whole_number(value: Column, target: T.DataType) -> Column:
    digits = _WHOLE_NUMBERS[type(target)]
    likely = _starts_like_a_number(value, digits - 1) & ~value.contains(".")
    # Sign, then digits after leading zeros; a fraction is cut off. A digit or
    # the point must be there.
    loose = rf"^{_EDGE}([+-]?)(?=[\d.])0*(\d{{0,{digits}}})(?:\.\d*)?{_EDGE}$"
    # The zero between sign and digits stands in for those missing in '.5'.
    number = F.regexp_replace(value, loose, "$10$2")
    return F.coalesce(
        F.when(likely, value.try_cast(target)),
        F.when(value.rlike(loose), number.try_cast(target)),
    )
