"""Sensitive data and repeated text in ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.catalog import query, sql, table
from quern.functions import sensitive as rules
from quern.operators import repetition, sensitive
from quern.session import spread

# Documents have no bank accounts, so one is added to every text; one in 97 is valid.
_WITH_ACCOUNT = "text || ' DE' || lpad((2 + doc_id % 97)::VARCHAR, 2, '0') || ' 3704 0044 ' || lpad(doc_id::VARCHAR, 10, '0')"


def _docs(spark, sf):
    return spread(table(spark, sf, "documents"), "doc_id")


def _with_account(spark, sf):
    number = F.col("doc_id").cast("string")
    check = F.lpad((2 + F.col("doc_id") % 97).cast("string"), 2, "0")
    added = F.concat("text", F.lit(" DE"), check, F.lit(" 3704 0044 "), F.lpad(number, 10, "0"))
    return _docs(spark, sf).withColumn("text", added)


_CHARS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LENGTHS = ", ".join(f"('{country}', {length})" for country, length in rules.IBAN_LENGTHS.items())
_HEX = rf"regexp_matches(f, '^([0-9a-f]{{{rules.HEX_CHARS},}}|[0-9A-F]{{{rules.HEX_CHARS},}})$')"
_BITS = """round(list_sum(list_transform(list_distinct(string_split(f, '')),
        lambda c: -(length(f) - length(replace(f, c, ''))) / length(f)::DOUBLE
          * log2((length(f) - length(replace(f, c, ''))) / length(f)::DOUBLE))), 9)"""

# Findings by place: candidates, checks on each distinct one, its kind.
_KINDS = f"""d AS (SELECT doc_id, source, {_WITH_ACCOUNT} AS text FROM documents),
    m AS (SELECT doc_id, source, regexp_extract_all(text, '{rules.CANDIDATE}') AS fs FROM d),
    c AS (SELECT DISTINCT unnest(fs) AS f FROM m),
    lengths(country, size) AS (VALUES {_LENGTHS}),
    checks AS (SELECT f, size, replace(f, ' ', '') AS compact, regexp_replace(f, '[^0-9]', '', 'g') AS digits
      FROM c LEFT JOIN lengths ON country = left(f, 2)),
    tests AS (SELECT f, digits,
        length(compact) = size AND regexp_matches(compact, '^[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]+$') AND list_reduce(
          list_concat([0::BIGINT], list_transform(string_split(substr(compact, 5) || left(compact, 4), ''),
            lambda ch: (instr('{_CHARS}', ch) - 1)::BIGINT)),
          lambda acc, v: (acc * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1 AS iban,
        regexp_matches(f, '^[0-9 -]+$') AND length(digits) BETWEEN 13 AND 19 AND
          list_sum(list_transform(range(1, length(digits) + 1), lambda i:
            CASE WHEN (length(digits) - i) % 2 = 0 THEN substr(digits, i, 1)::INT
              ELSE (substr(digits, i, 1)::INT * 2) // 10 + (substr(digits, i, 1)::INT * 2) % 10 END)) % 10 = 0 AS card,
        regexp_matches(f, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') AND
          list_max(list_transform(string_split(f, '.'), lambda o: coalesce(try_cast(o AS INT), 256))) < 256 AS ip,
        regexp_matches(f, '^[A-Za-z0-9_+/=-]{{{rules.TOKEN_CHARS},}}$') AND regexp_matches(f, '[0-9]')
          AND regexp_matches(f, '[A-Za-z]')
          AND {_BITS} >= CASE WHEN {_HEX} THEN {rules.HEX_BITS} ELSE {rules.TOKEN_BITS} END AS secret
      FROM checks),
    kinds AS (SELECT f, CASE WHEN contains(f, '@') THEN 'email' WHEN iban THEN 'iban'
        WHEN f LIKE '+%' AND length(digits) BETWEEN 8 AND 15 THEN 'phone'
        WHEN ip THEN 'ip' WHEN card THEN 'card' WHEN secret THEN 'secret' END AS kind FROM tests),
    found AS (SELECT doc_id, source, unnest(fs) AS f, unnest(range(1, len(fs) + 1)) AS place FROM m),
    hits AS (SELECT doc_id, source, place, f, kind FROM found JOIN kinds USING (f))"""

_COUNTS = ", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in rules.KINDS)
_FILTERS = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in rules.KINDS)


@query(
    "mask_sensitive",
    f"""WITH {_KINDS},
    marks AS (SELECT doc_id, {_FILTERS},
        list(CASE WHEN kind IS NULL THEN f ELSE '<' || upper(kind) || '>' END ORDER BY place) AS marks
      FROM hits GROUP BY doc_id)
    SELECT d.doc_id, {_COUNTS}, array_to_string(list_transform(
        list_zip(string_split_regex(text, '{rules.CANDIDATE}'), coalesce(marks, [])),
        lambda p: p[1] || coalesce(p[2], '')), '') AS text
    FROM d LEFT JOIN marks USING (doc_id)""",
)
def mask_sensitive(spark, sf):
    masked = sensitive.mask_sensitive(_with_account(spark, sf))
    return masked.select("doc_id", "text", *[f"n_{kind}" for kind in rules.KINDS])


@query(
    "drop_sensitive",
    f"""WITH {_KINDS} SELECT doc_id, source FROM documents WHERE doc_id NOT IN
      (SELECT doc_id FROM hits WHERE kind IN ('card', 'iban', 'secret'))""",
)
def drop_sensitive(spark, sf):
    return sensitive.drop_sensitive(_with_account(spark, sf)).select("doc_id", "source")


@query(
    "sensitive_totals",
    f"""WITH {_KINDS} SELECT source, kind, count(DISTINCT doc_id) AS docs, count(*) AS findings
      FROM hits WHERE kind IS NOT NULL GROUP BY ALL""",
)
def sensitive_totals(spark, sf):
    return sensitive.sensitive_totals(_with_account(spark, sf), "source")


def _repeats(units: str) -> str:
    return f"CASE WHEN len({units}) > 0 THEN (len({units}) - len(list_distinct({units}))) / len({units})::DOUBLE ELSE 0.0::DOUBLE END"


def _blocks(separator: str) -> str:
    pieces = f"list_transform(string_split_regex(text, '{separator}'), lambda u: {sql.strip('u')})"
    return f"list_filter({pieces}, lambda u: u <> '')"


def _sizes(units: str) -> str:
    return f"coalesce(list_sum(list_transform({units}, lambda u: length(u))), 0)"


# Word runs by place: a run's words follow each other, the last ones of a text start none.
_RUNS = {
    w: " || ' ' || ".join(["w", *[f"lead(w, {i}) OVER p" for i in range(1, w)]]) for w in repetition.WIDTHS
}


@query(
    "repetition",
    rf"""WITH u AS (SELECT doc_id, {_blocks(repetition.LINES)} AS ls, {_blocks(repetition.PARAGRAPHS)} AS ps,
        {sql.tokens('text')} AS t FROM documents),
    words AS (SELECT doc_id, unnest(t) AS w, unnest(range(1, len(t) + 1)) AS place FROM u),
    runs AS (SELECT doc_id, {', '.join(f"{run} AS g{w}" for w, run in _RUNS.items())}
      FROM words WINDOW p AS (PARTITION BY doc_id ORDER BY place)),
    grams AS (SELECT doc_id,
        {', '.join(f"(count(g{w}) - count(DISTINCT g{w})) / nullif(count(g{w}), 0)::DOUBLE AS g{w}" for w in _RUNS)}
      FROM runs GROUP BY doc_id)
    SELECT doc_id, len(ls) AS n_lines, round({_repeats('ls')}, 9) AS line_repeats,
      round(coalesce(({_sizes('ls')} - {_sizes('list_distinct(ls)')}) / nullif({_sizes('ls')}, 0)::DOUBLE, 0), 9)
        AS line_repeat_chars,
      len(ps) AS n_paragraphs, round({_repeats('ps')}, 9) AS paragraph_repeats,
      {', '.join(f"round(coalesce(g{w}, 0), 9) AS gram{w}_repeats" for w in _RUNS)}
    FROM u LEFT JOIN grams USING (doc_id)""",
)
def repeats(spark, sf):
    found = repetition.repetition(_docs(spark, sf))
    return found.withColumns({c: F.round(c, 9) for c in found.columns if "repeat" in c})


_LINES = f"""pieces AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place FROM documents),
    units AS (SELECT doc_id, place, line, {sql.strip('line')} AS unit FROM pieces),
    common AS (SELECT unit, count(DISTINCT doc_id) AS docs, count(*) AS rows FROM units WHERE unit <> ''
      GROUP BY unit HAVING count(DISTINCT doc_id) >= {repetition.MIN_DOCS})"""


@query("common_lines", f"WITH {_LINES} SELECT md5(unit) AS digest, docs, rows FROM common")
def common_lines(spark, sf):
    found = repetition.common_units(_docs(spark, sf))
    return found.withColumn("digest", F.lower(F.hex("digest")))


@query(
    "strip_common_lines",
    f"""WITH {_LINES} SELECT u.doc_id,
      coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (c.unit IS NULL), '') AS text,
      count(c.unit) AS n_removed
    FROM units u LEFT JOIN common c USING (unit) GROUP BY u.doc_id""",
)
def strip_common_lines(spark, sf):
    return repetition.strip_common_lines(_docs(spark, sf)).select("doc_id", "text", "n_removed")
