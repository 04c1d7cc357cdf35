"""Sensitive data in texts: mail addresses, phone and card numbers, bank accounts, IP addresses, secrets.

Candidates come from one pattern; checksums, octets and entropy decide. All of it is JVM expressions.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

KINDS = ("email", "iban", "phone", "ip", "card", "secret")

# Length of a bank account number (IBAN) by country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25,
    "RO": 24, "SE": 24, "SI": 19, "SK": 24,
}

# A run this long may be a secret: one of hexadecimal digits from 32 on with HEX_BITS per
# character, another one from 20 on with TOKEN_BITS. Both need a digit and a letter.
TOKEN_CHARS, HEX_CHARS = 20, 32
TOKEN_BITS, HEX_BITS = 4.0, 3.0


def _ibans() -> str:
    countries = defaultdict(list)
    for country, length in IBAN_LENGTHS.items():
        countries[length].append(country)
    # Longest first; what follows without a gap belongs to the candidate and makes it too long.
    return "|".join(
        f"(?:{'|'.join(found)})[0-9]{{2}}(?: ?[A-Z0-9]){{{length - 4}}}[A-Za-z0-9]*"
        for length, found in sorted(countries.items(), reverse=True)
    )


# No look-around and no unbounded run before a fixed character, so that the cost is linear in the text.
CANDIDATE = "|".join(
    [
        r"[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
        _ibans(),
        r"\+[0-9]{1,3}(?:[ -]?\(?[0-9]{2,4}\)?){2,4}",
        r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}[0-9.]*",
        rf"[A-Za-z0-9_+/=-]{{{TOKEN_CHARS},}}",
        r"[0-9]{4}(?: [0-9]{4}){3}[0-9]*",
        r"[0-9]{4}(?:-[0-9]{4}){3}[0-9]*",
        r"[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}[0-9]*",
        r"[0-9]{13,}",
    ]
)

# The same matches in less time: no candidate starts in a run of less than TOKEN_CHARS letters with
# one of these characters after it, which are in none. Account numbers are tried where they can start.
_AFTER_WORD = " ,;:!?()\n\r\t"
SEARCH = (
    rf"(?![A-Za-z]{{1,{TOKEN_CHARS - 1}}}+[{_AFTER_WORD}])(?:"
    + CANDIDATE.replace("{1,64}@", "{1,64}+@", 1).replace(_ibans(), f"(?=[A-Z]{{2}}[0-9]{{2}})(?:{_ibans()})", 1)
    + ")"
)


def luhn(digits: Column) -> Column:
    """The checksum of card numbers holds; ``digits`` holds digits only."""

    def value(at: Column) -> Column:
        digit = F.substring(digits, at, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return F.when((F.length(digits) - at) % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda sum_, at: sum_ + value(at))
    return total % 10 == 0


def iban(compact: Column) -> Column:
    """A bank account number without gaps: its country's length, and 1 as remainder by 97."""
    wanted = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])[F.left(compact, F.lit(2))]
    turned = F.concat(F.substring(compact, F.lit(5), F.length(compact)), F.left(compact, F.lit(4)))

    def fold(rest: Column, at: Column) -> Column:
        value = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), F.substring(turned, at, F.lit(1))) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    rest = F.aggregate(F.sequence(F.lit(1), F.length(compact)), F.lit(0), fold)
    shaped = compact.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]+$") & (F.length(compact) == wanted)
    return F.when(F.coalesce(shaped, F.lit(False)), rest == 1).otherwise(False)


def entropy(token: Column) -> Column:
    """Bits per character by the token's own character counts, to nine places."""
    size = F.length(token)
    chars = F.array_distinct(F.split(token, ""))

    def part(char: Column) -> Column:
        share = (size - F.length(F.replace(token, char, F.lit("")))) / size
        return -share * F.log2(share)

    return F.round(F.aggregate(chars, F.lit(0.0), lambda sum_, char: sum_ + part(char)), 9)


def _secret(token: Column) -> Column:
    mixed = token.rlike(f"^[A-Za-z0-9_+/=-]{{{TOKEN_CHARS},}}$") & token.rlike("[0-9]") & token.rlike("[A-Za-z]")
    hexadecimal = token.rlike(f"^(?:[0-9a-f]{{{HEX_CHARS},}}|[0-9A-F]{{{HEX_CHARS},}})$")
    least = F.when(hexadecimal, HEX_BITS).otherwise(TOKEN_BITS)
    return F.when(mixed, entropy(token) >= least).otherwise(False)


def kind_of(found: Column) -> Column:
    """One of KINDS, or null for a candidate that fails its check."""
    compact = F.replace(found, F.lit(" "), F.lit(""))
    digits = F.regexp_replace(found, "[^0-9]", "")
    octets = F.split(found, r"\.")
    address = found.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$") & F.forall(
        octets, lambda octet: F.coalesce(octet.try_cast("int"), F.lit(256)) < 256
    )
    card = found.rlike("^[0-9 -]+$") & F.length(digits).between(13, 19)
    return (
        F.when(F.contains(found, F.lit("@")), "email")
        .when(iban(compact), "iban")
        .when(F.startswith(found, F.lit("+")) & F.length(digits).between(8, 15), "phone")
        .when(address, "ip")
        .when(F.when(card, luhn(digits)).otherwise(False), "card")
        .when(_secret(found), "secret")
    )


def findings(text: Column) -> Column:
    """Array of (found, kind), in text order; candidates that fail their check have a null kind.

    A text without a digit and an ``@`` holds none; a null text gives an empty array.
    """
    matches = F.regexp_extract_all(text, F.lit(SEARCH), F.lit(0))
    # Bound as a lambda variable, so that the search runs once.
    kinds = F.transform(matches, lambda m: F.struct(m.alias("found"), kind_of(m).alias("kind")))
    none = F.array().cast("array<struct<found:string,kind:string>>")
    return F.when(text.rlike("[0-9@]"), kinds).otherwise(none)


def mask_findings(text: Column, found: Column) -> Column:
    """``text`` with every finding of a kind replaced by the kind's name in angle brackets."""
    marks = F.transform(
        found,
        lambda f: F.when(f["kind"].isNull(), f["found"]).otherwise(
            F.concat(F.lit("<"), F.upper(f["kind"]), F.lit(">"))
        ),
    )
    pieces = F.split(text, SEARCH, -1)
    joined = F.zip_with(pieces, marks, lambda piece, mark: F.concat(piece, F.coalesce(mark, F.lit(""))))
    return F.when(F.exists(found, lambda f: f["kind"].isNotNull()), F.array_join(joined, "")).otherwise(text)
