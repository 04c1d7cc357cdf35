"""SQL fragments shared by the oracle statements."""

from __future__ import annotations

from quern.catalog import blake2b

WS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}-\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^{WS}+', ''), '{WS}+$', '')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def mask_email(x: str) -> str:
    return rf"regexp_replace({x}, '\b[\w.+-]+@[\w.-]+\.[A-Za-z]{{2,}}\b', '<EMAIL>', 'g')"


def mask_phone(x: str) -> str:
    # No lookaround: the borders are captured, and a second pass takes numbers
    # whose border the first pass used up.
    pattern = r"'(^|[^0-9])1[3-9][0-9]{9}($|[^0-9])', '\1<PHONE>\2', 'g'"
    return f"regexp_replace(regexp_replace({x}, {pattern}), {pattern})"


def clean(x: str) -> str:
    return mask_phone(mask_email(squeeze(x)))


def tokens(x: str) -> str:
    return rf"regexp_extract_all(lower({x}), '[A-Za-z0-9_]+|[\x{{4e00}}-\x{{9fff}}]')"


def shingles(t: str) -> str:
    return (
        f"CASE WHEN len({t}) = 0 THEN []::VARCHAR[] ELSE list_transform("
        f"range(1, greatest(1, len({t}) - 4) + 1), lambda i: array_to_string({t}[i:i + 4], ' ')) END"
    )


def signed(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 9223372036854775808 "
        f"THEN ({x}::HUGEINT - 18446744073709551616)::BIGINT ELSE {x}::BIGINT END"
    )


def votes_ctes(docs: str, key: str = "doc_id", text: str = "text", family: str = "md5") -> str:
    """CTEs votes(key, bit, votes) and prints(key, fp): SimHash of a relation.

    The BLAKE2b family needs WITH RECURSIVE.
    """
    hashes = f"h AS (SELECT {key}, ('0x' || substr(md5(s), 1, 16))::UBIGINT AS h FROM sh)"
    if family == "blake2b":
        hashes = f"{blake2b.ctes('sh')},\n    h AS (SELECT {key}, h FROM sh JOIN blake USING (s))"
    return f"""
    tok AS (SELECT {key}, {tokens(text)} AS t FROM {docs}),
    sh AS (SELECT {key}, unnest({shingles('t')}) AS s FROM tok),
    {hashes},
    votes AS (
      SELECT {key}, bit, sum(CASE WHEN (h >> bit) & 1 = 1 THEN 1 ELSE -1 END)::BIGINT AS votes
      FROM h, (SELECT unnest(range(0, 64))::UBIGINT AS bit) GROUP BY {key}, bit),
    set_bits AS (
      SELECT {key}, bit_or(CASE WHEN votes >= 0 THEN (1::HUGEINT << bit::INT)::UBIGINT ELSE 0::UBIGINT END) AS fp
      FROM votes GROUP BY {key}),
    prints AS (
      SELECT d.{key}, coalesce(b.fp, 0::UBIGINT) AS fp FROM {docs} d LEFT JOIN set_bits b USING ({key}))"""


def distinct_clean_ctes(min_chars: int = 80) -> str:
    """CTEs eligible(doc_id, text) and firsts(doc_id, text): first row per cleaned text."""
    return f"""
    cleaned AS (SELECT doc_id, {clean('text')} AS text FROM documents),
    eligible AS (SELECT * FROM cleaned WHERE length(text) >= {min_chars}),
    firsts AS (SELECT min(doc_id) AS doc_id, text FROM eligible GROUP BY text)"""


def greedy_ctes(prints: str, distance: int) -> str:
    """CTEs edges(a, b, distance) and losers(doc_id) of the greedy first-come rule."""
    return f"""
    edges AS (
      SELECT x.doc_id AS a, y.doc_id AS b, bit_count(xor(x.fp, y.fp))::BIGINT AS distance
      FROM {prints} x JOIN {prints} y ON x.doc_id < y.doc_id
      WHERE bit_count(xor(x.fp, y.fp)) <= {distance}),
    touched AS (
      SELECT n, row_number() OVER (ORDER BY n) AS i
      FROM (SELECT a AS n FROM edges UNION SELECT b FROM edges)),
    earlier AS (
      SELECT t.i, t.n, list(e.a) FILTER (e.a IS NOT NULL) AS before
      FROM touched t LEFT JOIN edges e ON e.b = t.n GROUP BY t.i, t.n),
    fold(i, kept) AS (
      SELECT 0::BIGINT, []::BIGINT[]
      UNION ALL
      SELECT e.i, CASE WHEN list_has_any(coalesce(e.before, []::BIGINT[]), f.kept)
                  THEN f.kept ELSE list_append(f.kept, e.n) END
      FROM fold f JOIN earlier e ON e.i = f.i + 1),
    final AS (SELECT kept FROM fold ORDER BY i DESC LIMIT 1),
    losers AS (SELECT n AS doc_id FROM touched, final WHERE NOT list_contains(kept, n))"""


ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "''"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]


def unescape(x: str) -> str:
    for name, char in ENTITIES:
        x = f"replace({x}, '{name}', '{char}')"
    return x


def html_tokens(html: str) -> str:
    return (
        f"regexp_extract_all({html}, '(?is)<!--.*?-->|<script[^>]*>.*?</script>|"
        "<style[^>]*>.*?</style>|<[^>]*>|[^<]+')"
    )


def raw_inner(t: str) -> str:
    return f"regexp_replace(regexp_replace({t}, '^<[^>]*>', ''), '</[^<>]*>$', '')"


def page_title(html: str) -> str:
    return strip(unescape(f"regexp_extract({html}, '(?is)<title[^>]*>(.*?)</title>', 1)"))


def page_text(html: str) -> str:
    chunk = (
        f"CASE WHEN starts_with(t, '<!') THEN '' "
        f"WHEN regexp_matches(t, '(?i)^<(script|style)') THEN {strip(raw_inner('t'))} "
        f"WHEN starts_with(t, '<') THEN '' ELSE {strip(unescape('t'))} END"
    )
    return (
        f"array_to_string(list_filter(list_transform({html_tokens(html)}, lambda t: {chunk}), "
        "lambda v: v <> ''), ' ')"
    )


def page_hrefs(html: str) -> str:
    href = unescape(r"regexp_extract(t, '(?i)\shref=\"([^\"]*)\"', 1)".replace('\\"', '"'))
    return (
        f"list_filter(list_transform(list_filter({html_tokens(html)}, "
        rf"lambda t: regexp_matches(t, '(?i)^<a\s')), lambda t: {href}), lambda v: v <> '')"
    )


NETLOC = r"regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1)"
SITE = r"regexp_extract({0}, '^[a-z]+://[^/?#]*')"
