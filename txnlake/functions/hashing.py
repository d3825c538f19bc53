"""Canonical request hash: SHA-256 of sorted-key, whitespace-free JSON.

The canonical text is ``{"body":{<fields sorted by name>},"endpoint":"..."}``
with JSON nulls kept, the form that Python's ``json.dumps(..., sort_keys=True,
separators=(",", ":"))`` produces: everything outside space to ``~`` is escaped,
with the short forms for quote, backslash, \\b, \\f, \\n, \\r and \\t, else as
``\\uXXXX`` in lower-case hex (UTF-16, so two of them above U+FFFF).  The escape
is a native ``transform`` over a field's characters, evaluated only for fields
that hold such a character.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short escapes (fixed values): code point and text.
_SHORT = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r", 34: '\\"', 92: "\\\\"}
_PLAIN = r'\A[ !#-\[\]-~]*\z'


def _unit(code: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))


def _escape_char(ch: Column) -> Column:
    cp = F.ascii(ch)  # code point of the character
    off = cp - F.lit(65536)
    out = None
    for code, text in _SHORT.items():
        out = (F if out is None else out).when(cp == code, F.lit(text))
    return (out.when(cp.between(32, 126), ch).when(cp < 65536, _unit(cp))
            .otherwise(F.concat(_unit(F.lit(55296) + F.shiftright(off, 10)),
                                _unit(F.lit(56320) + off.bitwiseAND(1023)))))


def json_text(value: Column) -> Column:
    """A string as a JSON string of ASCII characters; null as ``null``."""
    escaped = F.array_join(F.transform(F.split(value, ""), _escape_char), "")
    body = F.when(value.rlike(_PLAIN), value).otherwise(escaped)
    return F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit('"'), body, F.lit('"')))


def canonical_json(endpoint: str, fields: Sequence[str]) -> Column:
    parts = []
    for n, c in enumerate(sorted(fields)):
        parts += [F.lit(("," if n else "") + json.dumps(c) + ":"), json_text(F.col(c).cast("string"))]
    return F.concat(F.lit('{"body":{'), *parts, F.lit('},"endpoint":' + json.dumps(endpoint) + "}"))


def request_hash(endpoint: str, fields: Sequence[str]) -> Column:
    return F.sha2(F.encode(canonical_json(endpoint, fields), "UTF-8"), 256)
