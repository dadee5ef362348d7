"""Selection of files from an open-data catalogue listing.

Input rows are resources with the text columns id, name, description, url,
format, mimetype, last_modified and created; missing ones count as null.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.scalars import parse_iso_instant
from weekloom.functions.text import norm_words, words_of

# Formats in order of preference, names of documentation, period patterns.
PREFERRED_FORMATS = ("CSV", "XLSX", "ZIP")
DATA_FORMATS = ("CSV", "XLSX", "XLS", "ZIP")
DOCUMENT_WORDS = ("dicionario", "dictionary", "glossario", "metadado", "metadata")
YEAR_MONTH = r"(20\d{2})[-_/.]?(0[1-9]|1[0-2])"
YEAR = r"(19\d{2}|20\d{2})"


def _text(df: DataFrame, name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")) if name in df.columns else F.lit(None).cast("string")


def _joined(df: DataFrame, *names: str) -> Column:
    parts = [F.coalesce(_text(df, n), F.lit("")) for n in names]
    return F.concat_ws(" ", *parts)


def _format(df: DataFrame) -> Column:
    return F.upper(F.coalesce(_text(df, "format"), _text(df, "mimetype"), F.lit("")))


def is_data_file(df: DataFrame) -> Column:
    """A data file by format, else by URL ending; never documentation."""
    documentation = F.lower(_joined(df, "name", "description")).rlike("|".join(DOCUMENT_WORDS))
    url = F.lower(F.coalesce(_text(df, "url"), _text(df, "download_url"), F.lit("")))
    by_format = _format(df).isin(*DATA_FORMATS)
    by_url = url.rlike(r"\.(" + "|".join(f.lower() for f in DATA_FORMATS) + ")$")
    return ~documentation & (by_format | by_url)


def period_key(df: DataFrame) -> Column:
    """``YYYY-MM`` or ``YYYY`` from the texts, else the month last changed, else the name or id."""
    text = _joined(df, "name", "description", "url")
    month = F.regexp_replace(F.regexp_extract(text, YEAR_MONTH, 0), YEAR_MONTH, "$1-$2")
    year = F.regexp_extract(text, YEAR, 1)
    changed = parse_iso_instant(F.coalesce(_text(df, "last_modified"), _text(df, "created")))
    empty = F.lit("")
    return F.coalesce(
        F.nullif(month, empty), F.nullif(year, empty), F.date_format(changed, "yyyy-MM"),
        F.nullif(F.trim(_text(df, "name")), empty), _text(df, "id"), F.lit("unknown"))


def _bound(text: str | None) -> tuple[int, int | None] | None:
    m = re.fullmatch(r"(\d{4})(?:-(\d{2}))?", text or "")
    return (int(m[1]), int(m[2]) if m[2] else None) if m else None


def first_day_of(text: str | None) -> str | None:
    """``YYYY`` or ``YYYY-MM`` (and longer) as the first day it names; None if unusable."""
    m = re.match(r"(\d{4})$|(\d{1,4})-(\d{1,2})(?:-|$)", text or "")
    if not m:
        return None
    return f"{int(m[1]):04d}-01-01" if m[1] else f"{int(m[2]):04d}-{int(m[3]):02d}-01"


def in_period(df: DataFrame, since: str | None = None, until: str | None = None) -> DataFrame:
    """Resources whose period lies between the bounds (``YYYY`` or ``YYYY-MM``).

    A resource known only by year fails a bound that names a month of that
    year. Without a period, the bound must occur in the name or description.
    """
    if not since and not until:
        return df
    text = _joined(df, "name", "description")
    bounds = [(b, later, _bound(b)) for b, later in ((since, True), (until, False)) if b]

    def between(ym: Column) -> Column:
        """Bounds on year and month as one number; month 0 where only the year is known."""
        inside, named = F.lit(True), F.lit(True)
        for bound, later, parsed in bounds:
            named = named & text.contains(bound)
            if parsed is None:
                continue
            y, m = parsed
            if later:
                inside = inside & (ym >= y * 100 + (m or 0))
            elif m is None:
                inside = inside & (ym < (y + 1) * 100)
            else:
                inside = inside & (ym <= y * 100 + m) & (ym != y * 100)
        return F.when(ym.isNotNull(), inside).otherwise(named)

    digits = F.regexp_replace(F.regexp_extract(period_key(df), r"^\d{4}(-\d{2})?$", 0), "-", "")
    number = F.rpad(F.nullif(digits, F.lit("")), 6, "0").try_cast("int")
    # A one-element array evaluates the long key expression once per row.
    return df.filter(F.transform(F.array(number), between)[0])


def format_rank(df: DataFrame, prefer: Sequence[str] = PREFERRED_FORMATS, fallback_mimetype: bool = False) -> Column:
    fmt = _format(df) if fallback_mimetype else F.upper(F.coalesce(_text(df, "format"), F.lit("")))
    rank = F.lit(len(prefer))
    for i, f in reversed(list(enumerate(prefer))):
        rank = F.when(fmt == f, i).otherwise(rank)
    return rank


def _changed(df: DataFrame) -> Column:
    return F.coalesce(_text(df, "last_modified"), _text(df, "created"), F.lit(""))


def best_per_period(df: DataFrame, prefer: Sequence[str] = PREFERRED_FORMATS, newest: bool = False,
                    tie: str = "id") -> DataFrame:
    """One resource per period: best format, then the oldest (``newest``: the latest) change.

    An aggregate rather than a window, so a period with very many resources
    combines before the shuffle.
    """
    rows = df.withColumns({"period": period_key(df), "_rank": format_rank(df, prefer), "_changed": _changed(df)})
    return _first_by(rows, ["period"], newest, tie, df.columns)


def best_overall(df: DataFrame, prefer: Sequence[str] = PREFERRED_FORMATS, newest: bool = False,
                 tie: str = "id") -> DataFrame:
    """The single best resource by the same order."""
    changed = F.desc("_changed") if newest else F.asc("_changed")
    ranked = df.withColumns({"_rank": format_rank(df, prefer, True), "_changed": _changed(df)})
    return ranked.orderBy("_rank", changed, tie).limit(1).drop("_rank", "_changed")


def _first_by(rows: DataFrame, keys: Sequence[str], newest: bool, tie: str, cols: Sequence[str]) -> DataFrame:
    row = F.struct(*[c for c in cols if c not in keys])
    if newest:
        # Best format is the smallest rank but the change must be the largest.
        pick = F.max_by(row, F.struct(-F.col("_rank"), "_changed", tie))
    else:
        pick = F.min_by(row, F.struct("_rank", "_changed", tie))
    return rows.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def filter_names(df: DataFrame, pattern: str) -> DataFrame:
    """Resources whose name or description matches; all of them when none does."""
    hit = _joined(df, "name", "description").rlike(pattern)
    # One aggregate row decides; no window over the whole listing.
    if df.filter(hit).isEmpty():
        return df
    return df.filter(hit)


def package_score(df: DataFrame, query: str, slug: str = "") -> Column:
    """Match of a package with a query: title containment, expected slug, penalty for detail sets."""
    wanted = words_of(query)
    title = norm_words(F.coalesce(_text(df, "title"), F.lit("")))
    name = F.lower(F.coalesce(_text(df, "name"), F.lit("")))
    score = F.when(title.contains(wanted) | F.lit(wanted).contains(title), 10).otherwise(0)
    if slug:
        score = score + F.when(name.contains(slug.lower()), 500).otherwise(0)
    detail = title.contains("detalh") | title.contains("detail") | name.contains("detail")
    return score - F.when(detail, 200).otherwise(0)


def best_package(df: DataFrame, query: str, slug: str = "", tie: str = "id") -> DataFrame:
    """The package for a query: one with the expected slug at once, else the best score, newest first."""
    direct = F.lower(F.coalesce(_text(df, "name"), F.lit(""))).contains(slug.lower()) if slug else F.lit(False)
    scored = df.withColumns({"_direct": direct, "score": package_score(df, query, slug)})
    return scored.orderBy(F.desc("_direct"), F.desc("score"), F.desc_nulls_last("metadata_modified"), tie).limit(1).drop("_direct")


def request_windows(df: DataFrame, start: str, end: str, span_days: int = 89) -> DataFrame:
    """Split each row's date range into inclusive windows of ``span_days`` + 1 days; the last is clipped."""
    last = F.greatest(F.col(start), F.col(end))
    starts = F.sequence(F.col(start), last, F.make_dt_interval(F.lit(span_days + 1)))
    rest = [c for c in df.columns if c not in (start, end)]
    return df.select(*rest, last.alias("_last"), F.explode(starts).alias("window_start")).select(
        *rest, F.col("window_start").cast("date").alias("window_start"),
        F.least(F.date_add(F.col("window_start").cast("date"), span_days), F.col("_last")).alias("window_end"),
    )

