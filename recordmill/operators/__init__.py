"""Operators from DataFrame to DataFrame: framing, envelopes, packing, ledger, metrics."""
