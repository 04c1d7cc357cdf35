"""Text columns: whitespace, masking, tokens and shingles, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace, the masking patterns
# and their placeholders, and the token pattern.
WHITESPACE_CLASS = (
    r"\u0009-\u000d\u001c-\u0020\u0085\u00a0\u1680\u2000-\u200a\u2028-\u2029\u202f\u205f\u3000"
)
EMAIL_PATTERN = r"(?U)\b[\w.+-]+@[\w.-]+\.[A-Za-z]{2,}\b"
EMAIL_PLACEHOLDER = "<EMAIL>"
# The look-behind stands after the first digit: most places fail on that digit first.
PHONE_PATTERN = r"(?U)1(?<!\d1)[3-9]\d{9}(?!\d)"
PHONE_PLACEHOLDER = "<PHONE>"
TOKEN_PATTERN = r"[A-Za-z0-9_]+|[\u4e00-\u9fff]"
SHINGLE_TOKENS = 5

# The same whitespace set as plain characters, for trimming without a regex.
WHITESPACE_CHARS = "".join(
    chr(code)
    for first, last in [
        (0x09, 0x0D),
        (0x1C, 0x20),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    ]
    for code in range(first, last + 1)
)


def strip_text(text: Column) -> Column:
    """Drop Unicode whitespace at both ends."""
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


# Runs that one space has to replace: a space before a printable ASCII character is one already.
# The range stands first, as one comparison rules out most characters.
_TO_SQUEEZE = f"(?! [!-~])[[^!-~]&&[{WHITESPACE_CLASS}]]+"


def normalize_whitespace(text: Column) -> Column:
    """One space for every run of Unicode whitespace, none at the ends."""
    return F.btrim(F.regexp_replace(text, _TO_SQUEEZE, " "), F.lit(" "))


def mask_email(text: Column) -> Column:
    """Replace mail addresses; the regex only runs on texts that hold an ``@``."""
    def masked(bound: Column) -> Column:
        replaced = F.regexp_replace(bound, EMAIL_PATTERN, EMAIL_PLACEHOLDER)
        return F.when(F.contains(bound, F.lit("@")), replaced).otherwise(bound)

    # Bound as a lambda variable, so that ``text`` is not worked out for each mention.
    return F.transform(F.array(text), masked)[0]


def mask_phone(text: Column) -> Column:
    """Replace 11-digit mobile numbers that are not part of a longer number."""
    return F.regexp_replace(text, PHONE_PATTERN, PHONE_PLACEHOLDER)


def clean_text(text: Column) -> Column:
    """Whitespace first, then mail addresses, then phone numbers."""
    return mask_phone(mask_email(normalize_whitespace(text)))


def char_count(text: Column) -> Column:
    return F.length(text)


def tokenize(text: Column) -> Column:
    """Lower-cased words, or single CJK ideographs."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def shingles(tokens: Column, width: int = SHINGLE_TOKENS) -> Column:
    """Overlapping runs of ``width`` tokens; a shorter text gives one run.

    The token array is bound as a lambda variable, so that the optimizer cannot
    fold the tokenizer into the inner lambda and run it once per shingle.
    """

    def runs(bound: Column) -> Column:
        last = F.greatest(F.lit(1), F.size(bound) - (width - 1))
        windows = F.transform(
            F.sequence(F.lit(1), last), lambda at: F.array_join(F.slice(bound, at, width), " ")
        )
        return F.when(F.size(bound) == 0, F.array().cast("array<string>")).otherwise(windows)

    return F.transform(F.array(tokens), runs)[0]
