"""Where published behaviours of the same job differ, each choice is one field.

``Rules()`` is the engine's default. ``Rules.python_job()`` and ``Rules.scala_job()``
give the two behaviours a user may be migrating from.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rules:
    # amount that cannot be decoded: keep NULL in the row, or store zero
    bad_amount_as_zero: bool = False
    # documents hold amounts as DECIMAL(12,2), or as DOUBLE; sums stay decimal
    amount_as_double: bool = False
    # "abc@": two parts (masked), or one part because trailing empties are dropped (kept as is)
    drop_trailing_empty_part: bool = False
    # a delete removes the document, or leaves the before-image in the store
    delete_documents: bool = True
    # customers:total goes up on a delete too
    count_customer_deletes: bool = False
    # label for a NULL status; None leaves such rows out of the status breakdown
    null_status: str | None = "UNKNOWN"
    # label for a NULL customer id in a score member
    null_member: str = "UNKNOWN"
    # documents carry the source columns besides _id, and keep NULLs
    wide_documents: bool = False
    # label for an event without a key; None sends it to the reject ledger
    null_key: int | None = None

    @staticmethod
    def python_job() -> Rules:
        return Rules(
            delete_documents=False,
            count_customer_deletes=True,
            null_status=None,
            null_member="None",
            wide_documents=True,
        )

    @staticmethod
    def scala_job() -> Rules:
        return Rules(
            bad_amount_as_zero=True,
            amount_as_double=True,
            drop_trailing_empty_part=True,
            null_member="0",
            null_key=0,
        )


DEFAULT = Rules()
