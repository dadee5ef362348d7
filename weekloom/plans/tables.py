"""The given tables read as operational feeds.

One series per region. Orders are the metered load (pending orders have no
verified value), line items are generation by unit number at the supplier's
region, and a line item shipped from a supplier to a customer is an exchange
between their regions. All measures are whole numbers, so sums are exact in
any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.plans.weekly import SOURCES, long_of

# Unit numbers of each generation source.
UNITS = {
    "ger_hidreletrica_mwh": (1, 2),
    "ger_eolica_mwh": (3, 4),
    "ger_fv_mwh": (5,),
    "ger_termica_mwh": (6, 7),
}
VARIABLES = [c for cols in SOURCES.values() for c in cols]
CUT_UNITS = {"corte_eolica_mwh": (3, 4), "corte_fv_mwh": (5,)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _region_of_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")


def load_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metered load: (series_key, ts, carga_mwh), null while an order is pending."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    value = F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 2500).cast("double"))
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_region_of_nation(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("r_name").alias("series_key"), F.col("o_orderdate").alias("ts"), value.alias("carga_mwh"))
    )


def unit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit output at the supplier's region, with the other readings of the same row."""
    line, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return (
        line.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_region_of_nation(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("r_name").alias("series_key"), F.col("l_shipdate").alias("ts"), *_unit_columns())
    )


def _unit_columns() -> list[Column]:
    cut = F.round(F.col("l_discount") * 100).cast("double")
    return [
        F.col("l_linenumber").alias("unit"),
        F.col("l_quantity").alias("mwh"),
        F.floor(F.col("l_quantity") * cut / 100).cast("double").alias("cut_mwh"),
        F.floor(F.col("l_extendedprice") / 1000).cast("double").alias("ena_mwmed"),
        (100 - 10 * cut).alias("ear_pct"),
        F.col("l_quantity").alias("ghi"),
        (F.round(F.col("l_tax") * 100).cast("double") * 4).alias("temp2m_c"),
        cut.alias("precipitacao_mm"),
    ]


def exchange_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchanges: (origin, destination, ts, mwh) from the supplier's to the customer's region."""
    return _exchanges(spark, sf_dir).select("origin", "destination", "ts", "mwh")


def _exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    supplier, customer = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "customer")
    place = _region_of_nation(spark, sf_dir)
    origin = place.select(F.col("n_nationkey").alias("_on"), F.col("r_name").alias("origin"))
    dest = place.select(F.col("n_nationkey").alias("_dn"), F.col("r_name").alias("destination"))
    return (
        line.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(origin, F.col("s_nationkey") == F.col("_on"))
        .join(dest, F.col("c_nationkey") == F.col("_dn"))
        .select("origin", "destination", F.col("l_shipdate").alias("ts"), *_unit_columns())
    )


def _of_units(col: str, units: tuple[int, ...]) -> Column:
    return F.sum(F.when(F.col("unit").isin(*units), F.col(col)))


def unit_metrics() -> dict[str, Column]:
    """Daily aggregates of unit rows, by standard column name."""
    return {
        **{name: _of_units("mwh", units) for name, units in UNITS.items()},
        **{name: _of_units("cut_mwh", units) for name, units in CUT_UNITS.items()},
        # Readings are whole units.
        **{name: F.round(F.avg(name)) for name in ("ena_mwmed", "ear_pct", "ghi", "temp2m_c", "precipitacao_mm")},
    }


def daily_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All daily series: load from orders, the rest from one pass over the line items.

    Each exchange row is expanded to its two ends, so generation at the origin
    and imports at the destination come out of a single join and grouping.
    """
    load = load_rows(spark, sf_dir).groupBy("series_key", F.col("ts").cast("date").alias("data")).agg(
        F.sum("carga_mwh").alias("carga_mwh"))
    ends = F.array(
        F.struct(F.col("origin").alias("series_key"), F.lit(True).alias("at_origin")),
        F.struct(F.col("destination").alias("series_key"), F.lit(False).alias("at_origin")),
    )
    rows = _exchanges(spark, sf_dir)
    value_cols = [c for c in rows.columns if c not in ("origin", "destination", "ts")]
    here = F.col("at_origin")
    sided = rows.select("ts", *value_cols, F.inline(ends)).select(
        "series_key", "ts", "at_origin", F.col("mwh").alias("moved_mwh"),
        *[F.when(here, F.col(c)).alias(c) for c in value_cols],
    )
    metrics = unit_metrics()
    units = sided.groupBy("series_key", F.col("ts").cast("date").alias("data")).agg(
        *[agg.alias(name) for name, agg in metrics.items()],
        # A day with rows on one side only has 0 on the other.
        F.coalesce(F.sum(F.when(~here, F.col("moved_mwh"))), F.lit(0.0)).alias("import_mwh"),
        F.coalesce(F.sum(F.when(here, F.col("moved_mwh"))), F.lit(0.0)).alias("export_mwh"),
        F.max(here).alias("has_units"),
    )
    present = {c: F.col("has_units") for c in metrics if c not in CUT_UNITS}
    present |= {c: F.col(c).isNotNull() for c in CUT_UNITS}
    present |= {"import_mwh": F.lit(True), "export_mwh": F.lit(True)}
    return long_of(load, {"carga_mwh": F.lit(True)}).unionByName(long_of(units, present))


# ---- the same tables dressed as raw files: text columns under raw names -------

def _text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def raw_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly balance: one column per source, the other sources blank on a row."""
    names = {"ger_hidreletrica_mwh": "val_gerhidraulica", "ger_termica_mwh": "val_gertermica",
             "ger_eolica_mwh": "val_gereolica", "ger_fv_mwh": "val_gersolar"}
    return _text(unit_rows(spark, sf_dir).select(
        F.col("series_key").alias("id_subsistema"), F.col("ts").alias("din_instante"),
        *[F.when(F.col("unit").isin(*UNITS[s]), F.col("mwh")).alias(n) for s, n in names.items()]))


def raw_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(exchange_rows(spark, sf_dir).select(
        F.col("ts").alias("din_instante"), F.col("origin").alias("id_subsistema_origem"),
        F.col("destination").alias("id_subsistema_destino"), F.col("mwh").alias("val_intercambiomwmed")))


def raw_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(unit_rows(spark, sf_dir).select(
        F.col("series_key").alias("nom_subsistema"), F.col("ts").cast("date").alias("ear_data"),
        F.col("ear_pct").alias("ear_verif_subsistema_percentual")))


def raw_inflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(unit_rows(spark, sf_dir).select(
        F.col("series_key").alias("nom_subsistema"), F.col("ts").cast("date").alias("ena_data"),
        F.col("ena_mwmed").alias("ena_bruta_regiao_mwmed")))


def raw_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly load; pending values are blank text."""
    return _text(load_rows(spark, sf_dir).select(
        F.col("series_key").alias("subsistema"), F.col("ts").alias("din_referenciautc"),
        F.col("carga_mwh").alias("val_cargaglobal"))).fillna("")


def raw_curtailment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday curtailment per plant: users are plants, event types the submarkets."""
    k = F.get_json_object("props", "$.k")
    return _text(table(spark, sf_dir, "events").select(
        F.col("event_type").alias("id_subsistema"), F.col("user_id").alias("id_ons"), F.col("ts").alias("din_instante"),
        F.col("event_id"), F.col("value").alias("val_geracaolimitada"), k.alias("val_geracaoreferencia")))


def raw_monthly_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly curtailed energy with separate year and month columns."""
    return _text(unit_rows(spark, sf_dir).select(
        F.col("series_key").alias("submercado"), F.year("ts").alias("ano"), F.month("ts").alias("mes"),
        F.col("cut_mwh").alias("energia_nao_gerada_mwh")))


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a catalogue listing: period in the name, format by priority."""
    day, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    shown = F.when(status == "F", F.date_format(day, "yyyy-MM")).when(status == "O", F.date_format(day, "yyyy"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat_ws(" ", F.lit("Serie"), shown).alias("name"),
        F.when(priority == "4", "Dicionario de dados").alias("description"),
        F.concat(F.lit("http://data.example/"), F.when(priority == "5", "file.CSV").otherwise("file")).alias("url"),
        F.when(priority == "1", "csv").when(priority == "2", "XLSX").when(priority == "3", "ZIP")
        .when(priority == "4", "CSV").alias("format"),
        F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss").alias("last_modified"))


def packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue packages."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.lower(F.concat_ws("-", "p_brand", "p_type")).alias("name"),
        F.col("p_name").alias("title"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd").alias("metadata_modified"))
