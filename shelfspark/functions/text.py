"""Small driver-side helpers for argument text; tables use the column forms in ``scalars``."""

from __future__ import annotations

import re


def sku_text(value: str) -> str:
    """The spelling ``scalars.normalize_sku`` gives, for one argument."""
    text = value.strip().upper()
    digits = "".join(re.findall("[0-9]", text))
    return f"SKU{digits:0>3}" if digits or text.startswith("SKU") else re.sub("SKU[_-]", "SKU", text)


def identifier(value: str) -> str:
    """A table or database name: letters, digits, underscore, not starting with a digit."""
    if not re.fullmatch(r"[a-zA-Z_][a-zA-Z0-9_]*", value):
        raise ValueError(f"not a valid name: {value!r}")
    return value
