"""ERP format decoders and encoders as ``Column -> Column`` functions."""

from ledgerline.functions.formats import (
    alpha_in, alpha_out, amount, amount_encode, amount_factor, dats, dats_encode, flag, number,
    price_in, tabkey_decode, tabkey_encode, timestamp_of,
)

__all__ = ["alpha_in", "alpha_out", "amount", "amount_encode", "amount_factor", "dats",
           "dats_encode", "flag", "number", "price_in", "tabkey_decode", "tabkey_encode",
           "timestamp_of"]
