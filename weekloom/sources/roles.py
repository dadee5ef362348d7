"""Which column plays which part in a raw feed, decided from normalised names.

Only names are looked at, so nothing is read; columns whose role also needs
numeric content are checked by ``numeric_among`` in one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekloom.functions.dates import month_from_parts
from weekloom.functions.scalars import to_instant, to_number

# Column names and keywords of the raw feeds.
SERIES_NAMES = ("submercado", "subsistema", "id_subsistema", "nom_subsistema")
INSTANT_NAMES = ("din_instante", "datahora", "data_hora", "data_e_hora", "datetime", "data")
DATE_WORDS = ("data", "date", "dia")
HOUR_NAMES = ("hora", "hr", "h")
GENERATION_WORDS = {
    "ger_hidreletrica_mwh": ("hidro", "hidraul"),
    "ger_termica_mwh": ("term",),
    "ger_eolica_mwh": ("eolic",),
    "ger_fv_mwh": ("solar", "fotov", "fv"),
}
ORIGIN_NAMES = ("de", "from", "origem", "subsistema_de")
DESTINATION_NAMES = ("para", "to", "destino", "subsistema_para")
FLOW_NAMES = ("valor", "mwmed", "mw", "potencia")
LOAD_PREFERRED = ("val_cargaglobalsmmg", "val_cargaglobal")
REFERENCE_NAMES = ("val_geracaoreferenciafinal", "val_geracaoreferencia", "val_disponibilidade")
POWER_NAMES = ("val_geracao", "val_geracaolimitada", "val_geracaoreferencia", "val_geracaoreferenciafinal")
CUT_WORDS = ("mwh", "energia_nao_gerada", "corte", "restricao")


class UnknownLayout(ValueError):
    """A feed without a column that a role needs."""


def first_where(cols: Sequence[str], test: Callable[[str], bool]) -> str | None:
    return next((c for c in cols if test(c)), None)


def any_word(name: str, words: Sequence[str]) -> bool:
    return any(w in name for w in words)


def series_column(cols: Sequence[str]) -> str | None:
    return first_where(cols, lambda c: c in SERIES_NAMES)


def instant(df: DataFrame) -> Column:
    """The instant of a row: a date-time column, date and hour together, or any date-like column."""
    cols = df.columns
    name = next((c for c in INSTANT_NAMES if c in cols), None)
    if "hora" in cols and "data" in cols and name in (None, "data"):
        # A date column that already carries a time wins over the pair.
        joined = to_instant(F.concat_ws(" ", F.col("data").cast("string"), F.col("hora").cast("string")))
        has_time = F.col("data").cast("string").contains(":")
        return F.when(has_time, to_instant("data")).otherwise(joined)
    name = name or first_where(cols, lambda c: any_word(c, DATE_WORDS))
    if name is None:
        raise UnknownLayout("no date or time column")
    return to_instant(name)


def day_of_period(df: DataFrame) -> Column:
    """The date of a daily or monthly row, also from separate year and month columns."""
    cols = df.columns
    for name in ("data", "din_instante", "competencia"):
        if name in cols:
            return to_instant(name)
    if "ano" in cols and "mes" in cols:
        return month_from_parts("ano", "mes").cast("timestamp")
    name = first_where(cols, lambda c: any_word(c, DATE_WORDS[:2]))
    if name is None:
        raise UnknownLayout("no date column")
    return to_instant(name)


def generation_columns(cols: Sequence[str]) -> dict[str, str]:
    """Standard name to raw column; a column serves the first source it names, a source its first column."""
    found: dict[str, str] = {}
    for c in cols:
        source = next((s for s, words in GENERATION_WORDS.items() if any_word(c, words)), None)
        if source and source not in found:
            found[source] = c
    if not found:
        raise UnknownLayout("no generation column")
    return {s: found[s] for s in GENERATION_WORDS if s in found}


def flow_columns(cols: Sequence[str]) -> tuple[str, str, str]:
    """(origin, destination, value) columns of an exchange feed."""
    origin = first_where(cols, lambda c: c in ORIGIN_NAMES or "origem" in c)
    dest = first_where(cols, lambda c: c in DESTINATION_NAMES or "destino" in c)
    value = first_where(cols, lambda c: c in FLOW_NAMES or "mwmed" in c or "intercambio" in c)
    if not (origin and dest and value):
        raise UnknownLayout("no origin, destination or value column")
    return origin, dest, value


def inflow_column(cols: Sequence[str]) -> str:
    name = first_where(cols, lambda c: "ena" in c and any_word(c, ("mw", "energia", "valor")))
    name = name or first_where(cols, lambda c: c in ("valor", "ena_mwmed"))
    if name is None:
        raise UnknownLayout("no inflow column")
    return name


def storage_column(cols: Sequence[str]) -> str:
    name = first_where(cols, lambda c: "ear" in c and (any_word(c, ("pct", "percent", "%")) or "_" not in c))
    name = name or ("valor" if "valor" in cols else None)
    if name is None:
        raise UnknownLayout("no storage column")
    return name


def numeric_among(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns in which every non-blank text is a number (one aggregate over the data)."""
    cols = list(cols)
    if not cols:
        return []
    kinds = dict(df.dtypes)
    texts = [c for c in cols if kinds[c] == "string"]
    if not texts:
        return cols
    aggs = []
    for i, c in enumerate(texts):
        filled = F.when(F.trim(c) != "", F.col(c))
        aggs += [F.count(filled).alias(f"a{i}"), F.count(to_number(filled)).alias(f"n{i}")]
    row = df.agg(*aggs).first()
    good = {c for i, c in enumerate(texts) if row[f"a{i}"] == row[f"n{i}"]}
    return [c for c in cols if c not in texts or c in good]


def not_a_number(df: DataFrame, name: str) -> Column:
    """Whether a row holds text in a column that is no number; blank text is none."""
    if dict(df.dtypes)[name] != "string":
        return F.lit(False)
    return F.coalesce((F.trim(name) != "") & to_number(name).isNull(), F.lit(False))


def load_columns(cols: Sequence[str]) -> list[str]:
    """Columns that may hold the load value: preferred names, names about load in power units, ``carga_mwh``, ``valor``."""
    named = [c for c in cols if any_word(c, ("carga", "demanda")) and any_word(c, ("mw", "valor"))]
    found = [c for c in (*LOAD_PREFERRED, *named, "carga_mwh", "valor") if c in cols]
    return list(dict.fromkeys(found))


def pick_load(candidates: Sequence[str], usable: Sequence[str]) -> str:
    """The first candidate of numbers alone; ``carga_mwh`` counts whatever it holds."""
    name = first_where(candidates, lambda c: c in usable or c == "carga_mwh" and not any(u in usable for u in candidates if u != "valor"))
    if name is None:
        raise UnknownLayout("no load column")
    return name


def load_column(df: DataFrame) -> str:
    """The load value among ``load_columns``, by one aggregate over the data."""
    candidates = load_columns(df.columns)
    return pick_load(candidates, numeric_among(df, candidates))


def is_subdaily(cols: Sequence[str]) -> bool:
    """Whether a load feed carries times rather than dates."""
    if "din_instante" in cols or "din_referenciautc" in cols:
        return True
    if "dat_referencia" in cols:
        return False
    return any(c in HOUR_NAMES or "hora" in c for c in cols)


def reference_column(cols: Sequence[str]) -> str | None:
    """The reference power column; the choice is per feed, not per row."""
    return next((c for c in REFERENCE_NAMES if c in cols), None)


def cut_energy_columns(cols: Sequence[str]) -> list[str]:
    """Columns that may hold curtailed energy, the first of numbers alone being the one."""
    return [c for c in cols if any_word(c, CUT_WORDS)]
