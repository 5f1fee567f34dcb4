"""Tokens, names and hashes, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN, TOKEN_SPLIT = r"[\p{L}\p{N}]", r"[^\p{L}\p{N}]+"


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), TOKEN_SPLIT), lambda t: t != "")


def query_tokens(query: str) -> list[str]:
    """The same tokens for a query string, in first-seen order, on the driver."""
    found = re.findall(r"[^\W_]+", query.lower())
    return list(dict.fromkeys(found))


def snake_case(name: str) -> str:
    """`createAt` -> `create_at`."""
    return re.sub(r"[A-Z]", lambda m: "_" + m.group().lower(), name)


def md5_int(value: Column) -> Column:
    """First 32 bits of the md5 as a non-negative BIGINT; any SQL engine can repeat it."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("bigint")


def slot_hash(value: Column, method: str = "xxhash64") -> Column:
    if method == "xxhash64":
        return F.xxhash64(value.cast("string"))
    if method == "md5":
        return md5_int(value)
    raise ValueError(f"unknown hash method [{method}]")


def not_blank(value: Column) -> Column:
    return F.trim(value) != ""
