"""Lax coercion of JSON values to contract types, as SQL text over VARIANT expressions.

A value is taken if the JSON type allows it: numbers and numeric text for numbers, 0/1 and the usual
words for booleans, only text for text. Whatever can't be taken is null. Functions take and give SQL
text: a table of a hundred columns is then parsed at once, where as many Column calls take seconds.
"""

from __future__ import annotations

# The words that count as true and false.
TRUE_WORDS = ("1", "true", "t", "yes", "y", "on")
FALSE_WORDS = ("0", "false", "f", "no", "n", "off")
INT_TEXT, FLOAT_TEXT = r"^[+-]?[0-9]+(\.0*)?$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
NUMBERS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def quoted(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(texts) -> str:
    return ", ".join(map(quoted, texts))


def json_type(value: str) -> str:
    """The JSON type's tag: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>."""
    return f"schema_of_variant({value})"


def got(value: str, kind: str) -> str:
    return f"try_variant_get({value}, '$', '{kind}')"


def integral(text: str) -> str:
    """Text of a whole number as BIGINT; a zero fraction is allowed, white space around it too."""
    bare = f"trim({text})"
    return f"CASE WHEN {bare} RLIKE {quoted(INT_TEXT)} THEN try_cast(split_part({bare}, '.', 1) AS BIGINT) END"


def fractional(text: str) -> str:
    """Text of a finite number as DOUBLE; NaN and infinities are not taken."""
    bare = f"trim({text})"
    return f"CASE WHEN {bare} RLIKE {quoted(FLOAT_TEXT)} THEN try_cast({bare} AS DOUBLE) END"


def by_type(kind: str, boolean: str, text: str, number: str) -> str:
    return f"CASE WHEN {kind} = 'BOOLEAN' THEN {boolean} WHEN {kind} = 'STRING' THEN {text} WHEN {kind} RLIKE '{NUMBERS}' THEN {number} END"


def to_bigint(value: str, kind: str | None = None) -> str:
    """``kind``: SQL text of the value's JSON type where that is known already."""
    number, text = got(value, "double"), integral(got(value, "string"))
    whole = f"CASE WHEN {number} = floor({number}) THEN coalesce({text}, {got(value, 'bigint')}) END"
    kind = kind or json_type(value)
    return f"CASE WHEN {kind} = 'BIGINT' THEN {got(value, 'bigint')} ELSE {by_type(kind, f'CAST({got(value, "boolean")} AS BIGINT)', text, whole)} END"


def to_double(value: str, kind: str | None = None) -> str:
    return by_type(kind or json_type(value), f"CAST({got(value, 'boolean')} AS DOUBLE)", fractional(got(value, "string")), got(value, "double"))


def to_boolean(value: str, kind: str | None = None) -> str:
    word, number = f"lower({got(value, 'string')})", got(value, "double")
    known = f"CASE WHEN {word} IN ({listed(TRUE_WORDS)}) THEN true WHEN {word} IN ({listed(FALSE_WORDS)}) THEN false END"
    return by_type(kind or json_type(value), got(value, "boolean"), known, f"CASE WHEN {number} IN (0D, 1D) THEN {number} = 1D END")


def to_string(value: str, kind: str | None = None) -> str:
    return f"CASE WHEN {kind or json_type(value)} = 'STRING' THEN {got(value, 'string')} END"


#: How a value becomes each contract type.
COERCE = {"int": to_bigint, "float": to_double, "str": to_string, "bool": to_boolean}
