"""Cleaning expressions: safe casts, codes, labels and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
CODE_WIDTH = 7
CODE_PATTERN = r"^[0-9]{7}\z"
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+|(?i:inf|infinity))([eE][+-]?[0-9]+)?\s*\z"
_INTEGER = r"^\s*[+-]?[0-9]+\s*\z"
# First and last visible ASCII character, digits, and the characters behind them, as the bytes that texts are ordered by.
_VISIBLE, _DIGITS = ("!", "\x7f"), ("0", ":")

# Tokens read as true and as false.
TRUE_TOKENS = ("1", "sim", "s", "true")
FALSE_TOKENS = ("0", "nao", "não", "n", "false")


def trim_ws(text: Column, characters: str = WHITE_SPACE) -> Column:
    """Strip every kind of white space from both ends (plain ``trim`` strips blanks only).

    Stripping a character set is slow, so it runs only where, after the blanks, an end is not a
    visible ASCII character.
    """
    bare = F.trim(text)
    return F.when(_begins(bare, _VISIBLE) & _ends(bare, _VISIBLE), bare).otherwise(F.trim(bare, F.lit(characters)))


def _begins(text: Column, characters: tuple[str, str]) -> Column:
    """Whether the first character is an ASCII one from ``characters[0]`` on and before ``characters[1]``."""
    return (text >= characters[0]) & (text < characters[1])


def _ends(text: Column, characters: tuple[str, str]) -> Column:
    """The same of the last character; its byte is compared, as counting characters to find it takes longer."""
    last = F.substring(text.cast("binary"), -1, 1)
    return (last >= F.lit(characters[0].encode())) & (last < F.lit(characters[1].encode()))


def _plain(text: Column) -> Column:
    """Whether a text begins and ends with a digit: a cast takes no suffix then, and all but always succeeds."""
    return _begins(text, _DIGITS) & _ends(text, _DIGITS)


def _is_fractional(df: DataFrame, name: str) -> bool:
    kind = dict(df.dtypes)[name]
    return kind in ("float", "double") or kind.startswith("decimal")


def safe_long(df: DataFrame, name: str) -> Column:
    """Integer or NULL. Fractional numbers round half away from zero; '1.5' as text is NULL."""
    value = F.col(name)
    if _is_fractional(df, name):
        return F.round(value).try_cast("bigint")
    if dict(df.dtypes)[name] == "string":
        # A failing cast costs far more than these tests.
        return F.when(_plain(value) | value.rlike(_INTEGER), value.try_cast("bigint"))
    return value.try_cast("bigint")


def safe_double(df: DataFrame, name: str) -> Column:
    """Double or NULL; NaN is NULL because every comparison with it would be true."""
    value = F.col(name)
    if dict(df.dtypes)[name] == "string":
        # A cast alone would also take Java's suffixes and hexadecimal forms ('7d', '0x1p3').
        # No shortcut as for integers: tables have many such columns, and their stage would outgrow what the JVM compiles.
        return F.when(value.rlike(_DECIMAL), value.try_cast("double"))
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def safe_text(df: DataFrame, name: str) -> Column:
    """Text or NULL; whole fractional numbers lose the '.0' that would spoil a code."""
    value = F.col(name)
    if _is_fractional(df, name):
        whole = F.round(value).try_cast("bigint")
        return F.when(whole == value, whole.cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def safe_timestamp(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("timestamp")


def code(df: DataFrame, name: str, width: int = CODE_WIDTH) -> Column:
    """Zero-padded fixed-width code; longer text is cut to ``width``."""
    return F.lpad(safe_text(df, name), width, "0")


def lower_label(df: DataFrame, name: str) -> Column:
    return F.lower(trim_ws(safe_text(df, name)))


def upper_label(df: DataFrame, name: str) -> Column:
    return F.upper(trim_ws(safe_text(df, name)))


def is_code(text: Column) -> Column:
    """Exactly seven ASCII digits; ``\\z`` because ``$`` would allow a final newline."""
    return text.rlike(CODE_PATTERN)


def tristate_flag(label: Column, true=TRUE_TOKENS, false=FALSE_TOKENS) -> Column:
    """TRUE / FALSE for known tokens, NULL for anything else."""
    return F.when(label.isin(*true), F.lit(True)).when(label.isin(*false), F.lit(False))
