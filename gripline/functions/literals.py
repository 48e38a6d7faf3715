"""Python literals in replies, rewritten token by token as JSON.

A text is cut into tokens; numbers, words and strings are rewritten each for itself, and brackets from the inside out. Whatever a literal
may not hold becomes a mark that no JSON reader takes. Strings are set aside: until the structure is done a string is its number
among the tokens, so patterns see structure only, however long the strings are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gripline.functions.text import let

_DIGITS = r"\d(?:_?\d)*+"
_EXPONENT = rf"(?:[eE][+-]?{_DIGITS})?"
_NUMBER = (
    r"(?:[+-][ \t]*+)?(?:0[xX](?:_?[0-9a-fA-F])++|0[oO](?:_?[0-7])++|0[bB](?:_?[01])++"
    rf"|(?:{_DIGITS})?\.{_DIGITS}{_EXPONENT}|{_DIGITS}\.?{_EXPONENT})(?![\w.])"
)
_STRING = (
    r"[uUrR]?(?:'''[^'\\]*+(?:(?:\\.|''?(?!'))[^'\\]*+)*+'''|\"\"\"[^\"\\]*+(?:(?:\\.|\"\"?(?!\"))[^\"\\]*+)*+\"\"\""
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'|\"[^\"\\\n]*+(?:\\.[^\"\\\n]*+)*+\")"
)
_TOKEN = rf"(?s){_STRING}|{_NUMBER}|[^\W\d]\w*+|\s++|."
_ESCAPE = r"(?s)\\(?:x[0-9a-fA-F]{2}|u[0-9a-fA-F]{4}|[0-7]{1,3}|.)|[^\\]++"

#: Between tokens, and for commas and brackets of groups that are done: comma, list, object, tuple.
_GAP, _COMMA, _LIST, _OBJECT, _TUPLE = "\x01", "\x02", "\x03\x04", "\x05\x06", "\x07\x08"
_DONE = _COMMA + _LIST + _OBJECT + _TUPLE
#: Around the number of a string that is set aside.
_OPEN, _CLOSE = "\x0e", "\x0f"
_PIECE = rf"{_OPEN}\d++{_CLOSE}|[^{_OPEN}]++"
_BAD = "?"
_STRUCTURE = "()[]{},:"


#: Signs that JSON has as escapes in a string; Python's source holds no zero byte.
_SIGNS = "".join(map(chr, range(1, 32)))


def _plain(text: Column) -> Column:
    """Characters of a string in JSON."""
    text = F.replace(text, F.lit('"'), F.lit('\\"'))
    escaped = text
    for char in _SIGNS:
        escaped = F.replace(escaped, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return F.when(text.rlike(f"[{_SIGNS[0]}-{_SIGNS[-1]}]"), escaped).otherwise(text)


def _escaped(part: Column) -> Column:
    """A piece of a string: an escape, or characters without one."""
    kind = F.substr(part, F.lit(2), F.lit(1))
    kept = F.when(kind.isin("n", "t", "r", "b", "f", '"', "\\", "u"), part)
    octal = F.concat(F.lit("\\u"), F.lpad(F.lower(F.conv(F.substr(part, F.lit(2)), 8, 16)), 4, "0"))
    return (
        F.when(~part.startswith("\\"), _plain(part))
        .when(part.rlike(r"^\\u(?![0-9a-fA-F]{4})|^\\x(?![0-9a-fA-F]{2})|^\\[UN]"), _BAD + '"')  # ends the string too early
        .when(kind == "x", F.concat(F.lit("\\u00"), F.substr(part, F.lit(3))))
        .when(kind.rlike("[0-7]"), octal)
        .when(kind == "'", "'")
        .when(kind == "a", "\\u0007")
        .when(kind == "v", "\\u000b")
        .when(kind == "\n", "")
        .otherwise(F.coalesce(kept, F.concat(F.lit("\\\\"), _plain(kind))))
    )


def _is_string(token: Column) -> Column:
    """No other token has a quote at its end, but for a quote alone."""
    return (F.octet_length(token) > 1) & (token.endswith("'") | token.endswith('"'))


def _string(token: Column) -> Column:
    """Characters of a string token in JSON, without quotes around them."""
    first = F.lower(F.substr(token, F.lit(1), F.lit(1)))
    before = F.when(first.isin("u", "r"), 1).otherwise(0)
    opening = F.substr(token, before + 1, F.lit(3))
    skipped = before + F.when(opening.isin("'''", '"""'), 3).otherwise(1)
    inner = F.substr(token, skipped + 1, F.length(token) - 2 * skipped + before)
    raw = _plain(F.replace(inner, F.lit("\\"), F.lit("\\\\")))
    cooked = F.array_join(F.transform(F.regexp_extract_all(inner, F.lit(_ESCAPE), F.lit(0)), _escaped), "")
    return F.when(first == "r", raw).when(F.contains(inner, F.lit("\\")), cooked).otherwise(_plain(inner))


def _number(token: Column) -> Column:
    bare = F.regexp_replace(F.translate(token, "_ \t", ""), r"^\+", "")
    sign = F.when(bare.startswith("-"), "-").otherwise("")
    digits = F.regexp_replace(bare, "^-", "")
    based = lambda base: F.conv(F.substr(digits, F.lit(3)), base, 10)
    tidy = F.regexp_replace(F.regexp_replace(F.regexp_replace(digits, r"^\.", "0."), r"\.(?!\d)", ".0"), r"^0+(?=\d)", "")
    value = (
        F.when(digits.rlike("^0[xX]"), based(16))
        .when(digits.rlike("^0[oO]"), based(8))
        .when(digits.rlike("^0[bB]"), based(2))
        .when(digits.rlike(r"^0+[1-9]\d*$"), _BAD)
        .otherwise(tidy)
    )
    return F.concat(sign, value)


def _rewritten(token: Column, number: Column) -> Column:
    words = F.when(token == "None", "null").when(token == "True", "true").when(token == "False", "false")
    return (
        F.when(_is_string(token), F.concat(F.lit(f'"{_OPEN}'), number.cast("string"), F.lit(f'{_CLOSE}"')))
        .when(token.rlike(r"^\s"), "")
        .when(token.rlike(r"^[+-]?[ \t]*\.?\d"), _number(token))
        .when(token.isin(*_STRUCTURE), token)
        .otherwise(F.coalesce(words, F.lit(_BAD)))
    )


_GROUP = r"(?s)\[[^\[\](){}]*+\]|\{[^\[\](){}]*+\}|\([^\[\](){}]*+\)|[^\[\](){}]++|."


def _group(part: Column) -> Column:
    """A group without groups in it, with its commas and brackets marked as done; a tuple of one value without a comma is the value."""
    inner = F.regexp_replace(F.substr(part, F.lit(2), F.length(part) - 2), f"{_GAP}*$", "")
    trimmed = F.regexp_replace(inner, rf"(?<=[^,{_GAP}])({_GAP}*),$", "")
    named = F.regexp_replace(trimmed, rf"(^|,)({_GAP}*)(-?\d[^,:{_GAP}]*|true|false|null)(?={_GAP}*:)", '$1$2"$3"')
    done = lambda marks, text: F.concat(F.lit(marks[0]), F.translate(text, ",", _COMMA), F.lit(marks[1]))
    closed = lambda a, b: part.startswith(a) & part.endswith(b) & (F.length(part) > 1)
    return (
        F.when(closed("[", "]"), done(_LIST, trimmed))
        .when(closed("{", "}"), done(_OBJECT, named))
        .when(closed("(", ")") & (F.contains(inner, F.lit(",")) | (F.translate(inner, _GAP, "") == "")), done(_TUPLE, trimmed))
        .when(closed("(", ")"), inner)
        .otherwise(part)
    )


def literal_json(text: Column) -> Column:
    """The text of a Python literal as JSON; null where it is a tuple. What is no literal gives a text that is no JSON.

    Read: numbers of all bases, with underscores and open points, signs, strings with any quotes, escapes, raw and adjacent ones,
    None, True and False, lists, tuples, values in parentheses, trailing commas, keys that are numbers. Not read: bytes, sets,
    complex numbers, and the escapes for named and eight-digit characters.
    """
    def joined(tokens: Column) -> Column:
        flat = F.array_join(F.filter(F.transform(tokens, _rewritten), lambda t: t != ""), _GAP)
        return F.replace(flat, F.lit(f'"{_GAP}"'), F.lit(""))

    def closed(flat: Column) -> Column:
        opens = F.regexp_extract_all(flat, F.lit(r"[\[\](){}]"), F.lit(0))
        count = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))
        step = lambda now, most: F.struct(now.alias("now"), F.greatest(most, now).alias("most"))
        deepest = F.aggregate(opens, count, lambda acc, b: step(acc["now"] + F.when(b.isin("(", "[", "{"), 1).otherwise(-1), acc["most"]))["most"]
        levels = F.filter(F.sequence(F.lit(0), deepest), lambda i: i > 0)
        once = lambda flat_, _: F.array_join(F.transform(F.regexp_extract_all(flat_, F.lit(_GROUP), F.lit(0)), _group), "")
        return F.aggregate(levels, flat, once)

    def opened(done: Column) -> Column:
        back = F.translate(done, _GAP + _DONE, " ,[]{}[]")
        return F.when(~F.ltrim(done, F.lit(_GAP)).startswith(_TUPLE[0]), back)

    def filled(structure: Column, tokens: Column) -> Column:
        number = lambda piece: F.substr(piece, F.lit(2), F.length(piece) - 2).cast("int")
        whole = lambda piece: F.when(piece.startswith(_OPEN), let(F.get(tokens, number(piece)), _string)).otherwise(piece)
        return F.array_join(F.transform(F.regexp_extract_all(structure, F.lit(_PIECE), F.lit(0)), whole), "")

    structured = lambda tokens: let(let(joined(tokens), closed), opened)
    return let(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), lambda tokens: filled(structured(tokens), tokens))
