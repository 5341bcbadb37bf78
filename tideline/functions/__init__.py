"""Scalar functions, all native Spark expressions."""

from tideline.functions.amounts import decode_amount, encode_amount
from tideline.functions.keys import customer_key, counter_sign, or_empty, status_key
from tideline.functions.masking import mask_email
from tideline.functions.ratios import percent, per_second

__all__ = [
    "counter_sign",
    "customer_key",
    "decode_amount",
    "encode_amount",
    "mask_email",
    "or_empty",
    "per_second",
    "percent",
    "status_key",
]
