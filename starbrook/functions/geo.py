"""IPv4 addresses and location identity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BIN_BITS = 16


def ip_to_long(ip: Column) -> Column:
    """Numeric value of a dotted IPv4 text, null for anything else.

    A text is valid when its four numbers, written out again, give the same text.
    """
    octets = [
        F.substring_index(F.substring_index(ip, ".", n), ".", -1).try_cast("int")
        for n in (1, 2, 3, 4)
    ]
    valid = F.concat_ws(".", *(o.cast("string") for o in octets)) == ip
    value = F.lit(0).cast("bigint")
    for octet in octets:
        valid = valid & octet.between(0, 255)
        value = value * 256 + octet
    return F.when(valid, value)


def ip_bin(address: Column) -> Column:
    return F.shiftright(address, BIN_BITS).cast("int")


def location_id(country: Column, region: Column, city: Column) -> Column:
    """The short country code is not part of the identity."""
    return F.md5(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in (country, region, city))))
