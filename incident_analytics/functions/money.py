"""Currency text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A sign, a currency symbol, digits plain or in groups of three, decimals.
_AMOUNT = r"^\s*([-+]?)\s*[$€£]?\s*([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]*)?\s*$"


def currency_to_int(text: Column) -> Column:
    """Whole units of a currency text as bigint: ``$12,345.67`` is 12345, ``-$5`` is -5.

    Text of another form (``12.5k``, ``n/a``, a code behind the amount) is null, not a guess.
    """
    digits = F.regexp_replace(F.regexp_extract(text, _AMOUNT, 2), ",", "")
    signed = F.concat(F.regexp_extract(text, _AMOUNT, 1), digits)
    return F.when(text.rlike(_AMOUNT), signed.try_cast("bigint"))
