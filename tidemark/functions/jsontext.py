"""Canonical JSON as Column expressions: one text for one value, whoever writes it.

Members are in the order of their names' code points, there is no white space, text outside ASCII stays as it is, control
characters are escaped as `\\u00xx` unless they have a short form, and floating numbers are the shortest
decimal that reads back as the same double, with an exponent below 1e-4 and from 1e16 on. ``to_json``
differs in the order, in the numbers from ten million on and below a thousandth, and in escapes. Doubles
that are not finite have no JSON form and are null.

Expressions are SQL texts: a document has some hundred members, and one call builds them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SHORT = {"\b": "b", "\t": "t", "\n": "n", "\f": "f", "\r": "r"}


def _quoted(text: str) -> str:
    """A SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def text_sql(value: str) -> str:
    """A string as a JSON string."""
    escaped = f"replace(replace({value}, '\\\\', '\\\\\\\\'), '\"', '\\\\\"')"
    for code in range(32):
        form = "\\" + _SHORT[chr(code)] if chr(code) in _SHORT else f"\\u{code:04x}"
        escaped = f"replace({escaped}, char({code}), {_quoted(form)})" if code else f"replace({escaped}, decode(X'00', 'utf-8'), {_quoted(form)})"
    plain = f"NOT ({value} RLIKE '[\\\\x00-\\\\x1f\"\\\\\\\\]')"
    return f"concat('\"', CASE WHEN {plain} THEN {value} ELSE {escaped} END, '\"')"


def double_sql(value: str) -> str:
    """A double's shortest text. The engine's own is that between a thousandth and ten million; beyond, it has an
    exponent, and sometimes a digit too many, so the fewest digits that read back are looked for."""
    own = f"string(abs({value}))"
    digits = f"replace(substring_index({own}, 'E', 1), '.', '')"
    # The first `k` digits as a rounded whole number, and its power of ten.
    power = "bigint(pow(10, length(w.d) - k))"
    rounded = f"(bigint(w.d) + CASE WHEN k < length(w.d) THEN 5 * ({power} div 10) ELSE 0 END) div {power}"
    tried = f"transform(sequence(1, length(w.d)), k -> named_struct('r', string({rounded}), 'x', w.e - k + 1))"
    shortest = f"filter({tried}, t -> double(concat(t.r, 'E', t.x)) = abs({value}))[0]"
    # Digits without trailing zeros, and the power of ten of the first one.
    parts = "named_struct('d', regexp_replace(t.r, '(?<=.)0+$', ''), 'e', t.x + length(t.r) - 1)"
    written = """CASE
        WHEN p.e BETWEEN 0 AND 15 AND length(p.d) <= p.e + 1 THEN concat(rpad(p.d, p.e + 1, '0'), '.0')
        WHEN p.e BETWEEN 0 AND 15 THEN concat(substr(p.d, 1, p.e + 1), '.', substr(p.d, p.e + 2))
        WHEN p.e BETWEEN -4 AND -1 THEN concat('0.', repeat('0', -p.e - 1), p.d)
        ELSE concat(substr(p.d, 1, 1), CASE WHEN length(p.d) > 1 THEN concat('.', substr(p.d, 2)) ELSE '' END,
          'e', CASE WHEN p.e < 0 THEN '-' ELSE '+' END, lpad(string(abs(p.e)), greatest(2, length(string(abs(p.e)))), '0')) END"""
    start = f"array(named_struct('d', {digits}, 'e', int(substring_index({own}, 'E', -1))))"
    found = f"transform(transform(transform({start}, w -> {shortest}), t -> {parts}), p -> {written})[0]"
    scientific = f"concat(CASE WHEN {value} < 0 THEN '-' ELSE '' END, {found})"
    return f"""CASE WHEN abs({value}) < double('Infinity') THEN
        CASE WHEN {own} LIKE '%E%' THEN {scientific} ELSE string({value}) END END"""


def value_sql(kind: T.DataType, value: str, depth: int = 0) -> str:
    """Any value as JSON; NULL is ``null``."""
    if isinstance(kind, T.StructType):
        written = struct_sql(kind, value, depth=depth)
    elif isinstance(kind, T.ArrayType):
        written = array_sql(kind, value, lambda item: value_sql(kind.elementType, item, depth + 1), depth)
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        written = double_sql(f"double({value})")
    elif isinstance(kind, (T.IntegralType, T.BooleanType, T.DecimalType)):
        written = f"string({value})"
    else:
        written = text_sql(f"string({value})")
    return f"coalesce({written}, 'null')"


def array_sql(kind: T.ArrayType, value: str, written, depth: int = 0) -> str:
    """The elements, each written by `written` (SQL of an element to SQL of its text)."""
    item = f"x{depth}"
    return f"concat('[', array_join(transform({value}, {item} -> {written(item)}), ','), ']')"


def struct_sql(kind: T.StructType, value: str, without: Sequence[str] = (), own: dict[str, str] | None = None, depth: int = 0) -> str:
    """A struct as JSON, without the named members; `own` has the text of members that are written elsewhere."""
    members = []
    for field in sorted(kind, key=lambda f: f.name):
        if field.name not in without:
            text = (own or {}).get(field.name) or value_sql(field.dataType, f"{value}.`{field.name}`", depth + 1)
            members.append(f"{_quoted(('' if not members else ',') + '\"' + field.name + '\":')}, {text}")
    return f"CASE WHEN {value} IS NOT NULL THEN concat('{{', {', '.join(members)}, '}}') END" if members else "'{}'"


def json_text(kind: T.DataType, value: str) -> Column:
    return F.expr(value_sql(kind, value))
