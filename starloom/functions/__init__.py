"""Column functions: built-in Spark expressions only."""

from starloom.functions.keys import UNKNOWN_KEY, key_or_unknown, surrogate_key
from starloom.functions.text import clean_column, legacy_int, plain_int

__all__ = ["UNKNOWN_KEY", "clean_column", "key_or_unknown", "legacy_int", "plain_int", "surrogate_key"]
