"""Scalar rules on airport codes, runway and stand names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (patterns taken over as they are):
#   terminal of a stand      ^([A-K])[0-9]+
#   gate that gets a zero    ^[A-K][0-9][A-Z]*$
#   runway suffix removed    \.0$   then leading zeros ^0+
TERMINAL_PATTERN = r"^([A-K])[0-9]+"
SHORT_GATE_PATTERN = r"^[A-K][0-9][A-Z]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iata_from_icao(icao) -> Column:
    """Three-letter code from the four-letter one (``KDFW`` -> ``DFW``)."""
    return F.substring(_col(icao), 2, 3)


def clean_runway(code) -> Column:
    """Drop a trailing ``.0`` then leading zeros (``018.0`` -> ``18``); NULL stays NULL."""
    c = _col(code)
    return F.regexp_replace(F.regexp_replace(c, r"\.0$", ""), r"^0+", "")


def terminal_of_stand(stand) -> Column:
    """Terminal letter of a stand (``B12`` -> ``B``); NULL when it does not match."""
    t = F.regexp_extract(_col(stand), TERMINAL_PATTERN, 1)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def zero_pad_gate(gate) -> Column:
    """``A5`` -> ``A05`` for one-digit gates, other values unchanged."""
    g = _col(gate)
    return F.when(
        g.rlike(SHORT_GATE_PATTERN),
        F.concat(F.substring(g, 1, 1), F.lit("0"), F.substring(g, 2, 1 << 20)),
    ).otherwise(g)


def stand_group(stand) -> Column:
    """Leading letters of a stand (``B12`` -> ``B``), NULL when none."""
    t = F.regexp_extract(_col(stand), r"^([A-Za-z]+)[0-9]+", 1)
    return F.when(t == "", F.lit(None).cast("string")).otherwise(t)


def stand_number(stand) -> Column:
    """Trailing number of a stand (``B12`` -> 12), NULL when none."""
    t = F.regexp_extract(_col(stand), r"^[A-Za-z]+([0-9]+)", 1)
    return F.when(t == "", F.lit(None).cast("int")).otherwise(t.cast("int"))


def blank_to_null(c) -> Column:
    x = _col(c)
    return F.when(F.trim(x.cast("string")) == "", F.lit(None)).otherwise(x)
