"""Text expressions."""

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# The characters with the Unicode White_Space property. Spark's one-argument trim only
# strips the space character, which would leave tabs and no-break spaces around names.
WHITESPACE = "".join(map(chr, [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]))


def trimmed(text: Column) -> Column:
    """Strips white space at both ends.

    The exact strip indexes the whole text. Nearly every value begins and ends with a printable
    ASCII character and has nothing to strip, which shows in its first and last byte.
    """
    last = F.substring(text.cast("binary"), -1, 1)
    clean = (text >= "!") & (text < "\x7f") & (last >= F.lit(b"!")) & (last < F.lit(b"\x7f"))
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trimmed(text), F.lit(""))


def _java(pattern: str) -> str:
    """The same RE2 meaning in Java syntax.

    Four constructs differ outside plain ASCII lines and are spelled out: word boundaries are
    ASCII, ``\\s`` has no vertical tab, ``$`` does not skip a final newline and ``.`` stops only
    at a newline.
    """
    pattern = re.sub(r"^\\b", "(?<![0-9A-Za-z_])", pattern)
    pattern = re.sub(r"\\b$", "(?![0-9A-Za-z_])", pattern)
    return "(?d)" + pattern.replace(r"\s", r"[\t\n\f\r ]").replace("$", r"\z")


def _alternatives(pattern: str) -> list[str]:
    """The alternatives at the top level; what the translation does not cover is refused, not matched wrongly."""
    parts, depth, start, i, in_class = [], 0, 0, 0, False
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and depth:
            raise ValueError(f"alternatives inside a group are not supported: {pattern}")
        elif c == "|":
            parts.append(pattern[start:i])
            start = i + 1
        i += 1
    parts.append(pattern[start:])
    for part in parts:
        inside = re.sub(r"^\\b|\\b$", "", part)
        if re.search(r"\\[bBpPQEAzZ$]|\$.|\[[^\]]*(\$|\\s)|\(\?", inside):
            raise ValueError(f"not supported in word patterns: {part}")
    return parts


def _opening_word(alternative: str) -> str:
    """The plain text every match of the alternative begins with."""
    word = re.match(r"(?:\\b)?([0-9A-Za-z ]*)", alternative)
    optional = alternative[word.end():word.end() + 1] in ("?", "*", "{")
    return word[1][:-1] if optional else word[1]


def matches(text: Column, pattern: str) -> Column:
    """True where an RE2-syntax pattern (alternatives of words) occurs in the text.

    A plain byte search is about ten times cheaper than a regular expression, so each alternative
    is searched by its opening word first, and the expression runs only on texts that hold it.
    """
    def occurs(alternative: str) -> Column:
        word = _opening_word(alternative)
        if word == alternative:
            return F.contains(text, F.lit(word))
        full = text.rlike(_java(alternative))
        return F.contains(text, F.lit(word)) & full if word else full

    return reduce(or_, map(occurs, _alternatives(pattern)))
