"""Incremental versions of the daily operators (an extension: the batch operators are the contract)."""
