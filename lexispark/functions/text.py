"""Text expressions with Unicode-aware white space and line ends, all inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Java flags: only \n ends a line, Unicode classes.
FLAGS = "(?dU)"
LINE_BREAK = "\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085  ]"


def rx(pattern: str, flags: str = "") -> str:
    """A Java pattern with the flags of this library and more."""
    return f"(?dU{flags}){pattern}"


#: What a Unicode-aware \\s matches.
SPACES = "".join(map(chr, [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def key(c: Column) -> Column:
    """Headword key: stripped and lower-cased."""
    return F.lower(strip(c))


def tokens(c: Column) -> Column:
    """Words between white space, without empty ones."""
    return F.filter(F.split(c, rx(r"\s+")), lambda t: t != "")


def lines(c: Column) -> Column:
    """Stripped lines that aren't blank."""
    return F.filter(F.transform(F.split(c, LINE_BREAK), strip), lambda x: x != "")


def count(c: Column, pattern: str, flags: str = "") -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(rx(pattern, flags))), F.lit(0))


def gloss_norm(c: Column) -> Column:
    """For comparing glosses: stripped, lower-cased, without final dots."""
    return F.rtrim(key(c), F.lit("."))


def entry_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("#", *parts).cast("binary")), 1, 16)
