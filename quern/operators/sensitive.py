"""Sensitive-data filter: findings per document, masked texts, totals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.sensitive import KINDS, findings, mask_findings


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda f: f["kind"] == kind)).cast("bigint")


def mask_sensitive(docs: DataFrame, text: str = "text", keep: Iterable[str] = ()) -> DataFrame:
    """``docs`` with masked ``text`` and ``n_<kind>`` for every kind. One pass, no shuffle.

    Kinds in ``keep`` are counted but not masked. A null text stays null with counts of 0.
    """
    known = set(keep)
    if known - set(KINDS):
        raise ValueError(f"unknown kinds {sorted(known - set(KINDS))}")
    found = docs.withColumn("_found", findings(F.col(text)))
    masked = F.transform(
        "_found",
        lambda f: F.struct(
            f["found"].alias("found"),
            F.when(~f["kind"].isin(*known), f["kind"]).alias("kind") if known else f["kind"].alias("kind"),
        ),
    )
    counts = {f"n_{kind}": _count(F.col("_found"), kind) for kind in KINDS}
    return found.withColumns({text: mask_findings(F.col(text), masked), **counts}).drop("_found")


def drop_sensitive(docs: DataFrame, kinds: Iterable[str] = ("card", "iban", "secret"), text: str = "text") -> DataFrame:
    """The documents without a finding of ``kinds``, texts unchanged."""
    wanted = list(kinds)
    return docs.where(~F.exists(findings(F.col(text)), lambda f: F.coalesce(f["kind"].isin(wanted), F.lit(False))))


def sensitive_totals(docs: DataFrame, by: str, text: str = "text") -> DataFrame:
    """(by, kind, docs, findings) for the kinds that occur.

    Folded to one count per document and kind before the shuffle, and per group on the map side.
    """
    found = findings(F.col(text))
    per_kind = F.array(*[F.struct(F.lit(k).alias("kind"), _count(F.col("_found"), k).alias("n")) for k in KINDS])
    rows = docs.select(by, found.alias("_found")).select(by, F.explode(per_kind).alias("x")).where("x.n > 0")
    return rows.groupBy(by, "x.kind").agg(F.count(F.lit(1)).alias("docs"), F.sum("x.n").alias("findings"))
