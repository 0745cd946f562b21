"""Column-name normalisation and keyword matching."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# What a name is compared by, in this order: no white space around it, lower case, "_" for each blank inside.
NAME_RULES = ((r"^\s+|\s+$", ""), (" ", "_"))


def plain_name(name: str) -> str:
    """The form in which column names are compared."""
    for pattern, put in NAME_RULES:
        name = re.sub(pattern, put, name)
    return name.lower()


def plain_name_col(col: Column) -> Column:
    """P1 over a column of names (for name tables), by the same rules."""
    for pattern, put in NAME_RULES:
        col = F.regexp_replace(col, pattern, put)
    return F.lower(col)


def _tokens(normalized: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", normalized) if t]


def name_matches(name: str, keywords: Iterable[str], match: str = "substring") -> bool:
    """True when the normalised ``name`` contains a keyword (``substring``) or has it as a token (``token``).

    ``substring`` is the reference behaviour and over-matches (``id`` in *Holiday*); ``token`` only
    matches whole ``_``-separated words.
    """
    n = plain_name(name)
    if match == "token":
        toks = _tokens(n)
        return any(k in toks for k in keywords)
    if match != "substring":
        raise ValueError("match must be 'substring' or 'token'")
    return any(k in n for k in keywords)


def columns_matching(columns: Sequence[str], keywords: Iterable[str], match: str = "substring") -> list[str]:
    """Columns whose normalised name matches any keyword, in schema order."""
    keywords = list(keywords)
    return [c for c in columns if name_matches(c, keywords, match)]
