"""E-mail masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_email(email: Column, drop_trailing_empty_part: bool = False) -> Column:
    """First and last character of the local part stay, stars between.

    Local parts of one or two characters and texts without exactly one ``@`` stay as
    they are. With ``drop_trailing_empty_part`` an address that ends in ``@`` counts as
    having no domain and stays as it is.
    """
    at = F.instr(email, "@")
    maskable = (at > 3) & (F.position(F.lit("@"), email, at + 1) == 0)
    if drop_trailing_empty_part:
        maskable = maskable & (at < F.length(email))
    return F.when(maskable, F.overlay(email, F.repeat(F.lit("*"), at - 3), 2)).otherwise(email)
