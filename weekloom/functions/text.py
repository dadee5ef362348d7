"""Name and text normalisation with built-in string functions only."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spellings that all mean the Southeast/Centre-West submarket.
SOUTHEAST_ALIASES = (
    "seco",
    "se_co",
    "se",
    "sudeste_centrooeste",
    "sudeste_centro_oeste",
    "sudeste_centro_oeste_seco",
    "sudeste_centrooeste_seco",
    "sudeste",
    # Form that "SUDESTE/CENTRO-OESTE" normalises to.
    "sudestecentro_oeste",
)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str]:
    """Accented Latin letters and their base letters, derived from Unicode decompositions."""
    src, dst = [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        parts = [ch for ch in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(ch)]
        if len(parts) == 1 and parts[0] != chr(code):
            src.append(chr(code))
            dst.append(parts[0])
    return "".join(src), "".join(dst)


def strip_accents(x) -> Column:
    """Drop diacritics: precomposed Latin letters by table, separate marks by class. Plain ASCII text is left as it is."""
    src, dst = _accent_tables()
    text = _c(x)
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, text).otherwise(F.regexp_replace(F.translate(text, src, dst), r"\p{Mn}+", ""))


def _squeeze_edges(x: Column) -> Column:
    return F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def norm_key(x) -> Column:
    """Identifier form: lower case, no accents, ``/`` dropped, ``-`` and blanks to single ``_``."""
    low = F.lower(_c(x))
    text = strip_accents(_squeeze_edges(low))
    full = F.regexp_replace(F.replace(text, F.lit("/"), F.lit("")), "[- _]+", "_")
    # Most names are plain already; only the others take the long way.
    return F.when(low.rlike(r"^[a-z0-9]+(_[a-z0-9]+)*\z"), low).otherwise(full)


def norm_words(x) -> Column:
    """Word form: lower case, no accents, every run of other characters one blank."""
    text = strip_accents(F.lower(_c(x)))
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


def key_of(text: str) -> str:
    """``norm_key`` of one driver-side name (column names, targets)."""
    plain = unicodedata.normalize("NFKD", text.strip().lower())
    plain = "".join(ch for ch in plain if not unicodedata.combining(ch))
    return re.sub("[- _]+", "_", plain.replace("/", ""))


def words_of(text: str) -> str:
    """``norm_words`` of one driver-side text."""
    plain = unicodedata.normalize("NFKD", text.strip().lower())
    plain = "".join(ch for ch in plain if not unicodedata.combining(ch))
    return re.sub("[^a-z0-9]+", " ", plain).strip()


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its identifier form."""
    return df.toDF(*[key_of(c) for c in df.columns])


def is_alias_of(x, target: str, aliases: Iterable[str] = SOUTHEAST_ALIASES) -> Column:
    """True where the text names ``target``, directly or through the alias set."""
    aliases, wanted = set(aliases), key_of(target)
    names = sorted(aliases | {wanted}) if wanted in aliases else [wanted]
    return F.coalesce(norm_key(x).isin(names), F.lit(False))


def series_key(x, groups: Mapping[str, Iterable[str]] | None = None) -> Column:
    """Map spellings to one key per series, keeping names without an alias as they are."""
    groups = {"seco": SOUTHEAST_ALIASES} if groups is None else groups
    name = norm_key(x)
    out = None
    for key, aliases in groups.items():
        hit = name.isin(sorted(set(aliases) | {key}))
        out = F.when(hit, F.lit(key)) if out is None else out.when(hit, F.lit(key))
    return name if out is None else out.otherwise(name)
