"""Text to typed values with an error policy of its own.

``spark.sql.ansi.enabled`` decides whether a plain cast turns bad text into
null or stops the job.  A validation step that drops nulls must not change its
meaning with that flag, so everything here is built on ``try_cast`` and the
policy is an argument:

* ``"null"`` - text that does not parse becomes null;
* ``"fail"`` - text that does not parse stops the job and names the column.

A ``try_cast`` that fails throws and catches an exception inside Spark, which
takes 10 to 20 microseconds, many times a cast that succeeds.  One bad column
in a large feed would dominate the job.  For integers and timestamps, which a
lenient cast rejects without exceptions, cheap checks keep hopeless text
(words, blanks, integers with a fraction) away from it.  Doubles cost the same
either way and go straight to ``try_cast``.

The expressions are also small on purpose: Spark compiles a whole projection
into one method, and the JVM never compiles methods beyond 8000 bytes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ON_ERROR = ("null", "fail")

# Characters that Spark trims before it parses.
_BLANK = r"[\x00-\x20\x7f]*"

_DIGITS = "0123456789"

# Integers, possibly with a sign, blanks, or a fraction that is to be cut off.
_INTEGER = rf"^{_BLANK}[+-]?\d+(\.\d*)?{_BLANK}$"
# A fraction alone is zero.
_FRACTION = rf"^{_BLANK}[+-]?\.\d*{_BLANK}$"

# How a timestamp must begin that does not begin with one of + , - . / 0-9.
_TIMESTAMP = rf"^{_BLANK}[0-9T+-]"


def _integer(text: Column, type_name: str) -> Column:
    # Digits with at most one dot after the first: what is left without the
    # digits is the start of ".".  Only other text is worth a regex.
    beyond_digits = F.translate(text, _DIGITS, "")
    plain = (text >= "0") & F.lit(".").startswith(beyond_digits)
    return F.when(
        plain | text.rlike(_INTEGER), F.substring_index(text, ".", 1).try_cast(type_name)
    ).when(text.rlike(_FRACTION), F.lit(0).cast(type_name))


def _timestamp(text: Column) -> Column:
    # The comparisons look at the first byte: from "+" to "9".
    promising = (text >= "+") & (text < ":") | text.rlike(_TIMESTAMP)
    return F.when(promising, text.try_cast("timestamp"))


def parse_text(
    text: Column, type_name: str, on_error: str = "null", label: str = "value"
) -> Column:
    """Parse ``text`` as ``string``, ``int``, ``bigint``, ``double`` or ``timestamp``."""
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}, not {on_error!r}")
    if type_name == "string":
        return text
    if type_name in ("int", "bigint"):
        parsed = _integer(text, type_name)
    elif type_name == "double":
        parsed = text.try_cast(type_name)
    elif type_name == "timestamp":
        parsed = _timestamp(text)
    else:
        raise ValueError(f"no text parser for type {type_name!r}")
    if on_error == "null":
        return parsed
    message = F.concat(F.lit(f"{label}: cannot read as {type_name}: "), text)
    return F.when(text.isNull() | parsed.isNotNull(), parsed).otherwise(
        F.raise_error(message).cast(type_name)
    )
