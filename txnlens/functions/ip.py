"""IPv4 addresses as integers, without a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IPV4_MAX = 2**32 - 1

# One octet: 0-255, no leading zeros.
_OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]|[0-9])"
_DOTTED_QUAD = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"


def ip_to_integer(column: Column, data_type: T.DataType) -> Column:
    """Integer form of an address held as dotted text or as a number.

    Text must be a dotted quad; a number must lie in ``[0, 2**32 - 1]`` before its
    fraction is cut off. Anything else is null.
    """
    if isinstance(data_type, T.StringType):
        text = F.trim(column)
        octets = F.split(text, r"\.")
        value = F.lit(0).cast("long")
        for position in range(4):
            value = value * 256 + F.try_element_at(octets, F.lit(position + 1)).try_cast("long")
        return F.when(text.rlike(_DOTTED_QUAD), value)
    number = column.cast("double")
    return F.when(number.between(0.0, float(IPV4_MAX)), F.floor(number).cast("long"))
