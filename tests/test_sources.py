"""Readers, role resolution, raw feeds, catalogue rules and writers."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import as_dict
from weekloom.functions import text
from weekloom.operators import catalog, energy, profile, selection
from weekloom.sources import delimited, feeds, json_feeds, roles, stores


def write(path, content, encoding="utf-8"):
    path.write_bytes(content.encode(encoding))
    return str(path)


@pytest.mark.parametrize("raw,key,words", [
    ("  Região-Sul ", "regiao_sul", "regiao sul"), ("SUDESTE/CENTRO-OESTE", "sudestecentro_oeste", "sudeste centro oeste"),
    ("A  -  B", "a_b", "a b"), ("ÇÃO__x", "cao_x", "cao x"), ("été", "ete", "ete"), ("seco", "seco", "seco"),
])
def test_names(spark, raw, key, words):
    row = spark.createDataFrame([(raw,)], "t string").select(text.norm_key("t").alias("k"), text.norm_words("t").alias("w")).first()
    assert (row["k"], row["w"]) == (key, words) == (text.key_of(raw), text.words_of(raw))


def test_aliases(spark):
    df = spark.createDataFrame([("SE/CO",), ("Sudeste/Centro-Oeste",), ("SE",), ("Nordeste",), (None,)], "t string")
    rows = df.select(text.is_alias_of("t", "SE/CO").alias("hit"), text.series_key("t").alias("k")).collect()
    assert [r["hit"] for r in rows] == [True, True, True, False, False]
    assert [r["k"] for r in rows] == ["seco", "seco", "seco", "nordeste", None]
    assert [r[0] for r in df.select(text.is_alias_of("t", "nordeste")).collect()] == [False, False, False, True, False]


def test_delimited_layouts(spark, tmp_path):
    latin = write(tmp_path / "a.csv", "Região;Valor\nSão;1\nÁgua;2;9;9\nsó\n", "latin-1")
    assert delimited.detect_layout(spark, latin) == delimited.Layout(";", "ISO-8859-1")
    df = delimited.read_raw(spark, latin)
    assert df.columns == ["regiao", "valor"]
    # The line with too many fields goes, the short one stays.
    assert sorted((r[0], r[1]) for r in df.collect()) == [("São", "1"), ("só", None)]
    tabbed = write(tmp_path / "b.csv", "﻿a\tb\n1,5\t2\n")
    assert delimited.detect_layout(spark, tabbed) == delimited.Layout("\t", "UTF-8")
    assert as_dict(delimited.read_delimited(spark, tabbed), "a") == {"1,5": {"b": "2"}}
    single = write(tmp_path / "c.csv", "only\nx\n")
    assert delimited.read_delimited(spark, single).collect()[0][0] == "x"


def test_consolidation_is_by_name(spark, tmp_path):
    a = write(tmp_path / "a.csv", "x,y\n1,2\n")
    b = write(tmp_path / "b.csv", "y;x;z\n3;4;5\n")
    c = write(tmp_path / "c.csv", "x,y\n6,7\n")
    out = as_dict(delimited.consolidate(spark, [a, b, c]), "x")
    assert out == {"1": {"y": "2", "z": None}, "4": {"y": "3", "z": "5"}, "6": {"y": "7", "z": None}}
    with pytest.raises(ValueError):
        delimited.consolidate(spark, [])


def test_a_folder_of_different_files(spark, tmp_path):
    folder = tmp_path / "raw files"
    folder.mkdir()
    write(folder / "a.csv", "a,b\n1,2\n" + "".join(f"{k},{k}\n" for k in range(10, 40)))
    write(folder / "b.csv", "b;a\n3;4\n")
    write(folder / "c.csv", "b,a\n1,2\n")
    write(folder / "d.csv", "a;Região\n7;São\n", "latin-1")
    df = delimited.read_raw(spark, str(folder))
    assert df.count() == 34 and df.groupBy().count().first()[0] == 34
    assert sorted(df.columns) == ["a", "b", "regiao"]
    got = {(r["a"], r["b"], r["regiao"]) for r in df.filter("cast(a as int) < 10").collect()}
    assert got == {("1", "2", None), ("4", "3", None), ("2", "1", None), ("7", None, "São")}
    assert df.select("b").count() == 34
    with pytest.raises(ValueError):
        delimited.detect_layout(spark, str(folder))


def test_series_needs_a_date_column(spark, tmp_path):
    with pytest.raises(ValueError):
        delimited.read_series(spark, write(tmp_path / "a.csv", "x\n1\n"))


def test_json_payloads(spark, tmp_path):
    nested = write(tmp_path / "n.json", json.dumps({"meta": 1, "zeta": [{"v": 1}, {"v": 2}], "alpha": [{"w": 3}]}))
    assert sorted(r["v"] for r in json_feeds.read_records(spark, nested).collect()) == [1, 2]
    lines = write(tmp_path / "l.json", "\n".join(map(json.dumps, [
        {"zeta": [{"v": 1}], "alpha": [{"w": 3}]}, {"other": [{"v": 2, "w": 4}]}, {"alpha": [{"w": 5}], "zeta": [{"v": 6}]}, {"meta": 1}])))
    got = {(r["v"], r["w"]) for r in json_feeds.read_records(spark, lines, one_per_line=True).collect()}
    assert got == {(1, None), (2, 4), (None, 5)}
    root = write(tmp_path / "r.json", json.dumps([{"v": 1}, {"v": 2}]))
    assert json_feeds.read_records(spark, root).count() == 2


def test_weather_is_matched_by_date(spark):
    payload = json.dumps({"properties": {"parameter": {
        "ALLSKY_SFC_SW_DWN": {"20240101": 5.0, "20240102": 6.0}, "T2M": {"20240102": 20.0}, "PRECTOTCORR": {"20240101": 1.0, "20240102": 2.0}}}})
    no_rain = json.dumps({"properties": {"parameter": {"T2M": {"20240101": 9.0}}}})
    df = spark.createDataFrame([("p", payload), ("q", no_rain)], "point string, payload string")
    out = as_dict(json_feeds.weather_rows(df, "payload", ["point"]), "point", "data")
    assert out["p", "2024-01-01"] == {"ghi": 5.0, "temp2m_c": None, "precipitacao_mm": 1.0}
    assert out["p", "2024-01-02"]["temp2m_c"] == 20.0
    assert out["q", "2024-01-01"] == {"ghi": None, "temp2m_c": 9.0, "precipitacao_mm": None}


def test_scoring_requests(spark):
    rows = ['{"features": {"a": "1.5", "b": 2, "other": 9}}', '{"body": "{\\"features\\": {\\"a\\": \\"x\\"}}"}', "[1]", "not json",
            '{"features": [1]}', '{"body": ""}', '{"x": 1}']
    df = spark.createDataFrame(list(enumerate(rows)), "i bigint, r string")
    out = as_dict(json_feeds.scoring_requests(df, "r", ["a", "b"], ["i"]), "i")
    assert (out[0]["a"], out[0]["b"], out[0]["error"]) == (1.5, 2.0, None)
    assert (out[1]["a"], out[1]["error"]) == (None, None)
    assert all(out[i]["error"] for i in (2, 3, 4)) and out[5]["error"] is None and out[6]["error"] is None


@pytest.mark.parametrize("content", [
    {"model": "m", "feature_importances": [{"feature": "a", "importance": 0.2}, {"feature": "b", "importance": 0.7}, {"feature": "bad"}, 3]},
    {"a": 0.2, "b": "0.7", "c": "x"},
    [{"feature": "b", "importance": 0.7}, {"feature": "a", "importance": 0.2}, {"feature": "c", "importance": "x"}],
])
def test_importance_layouts(spark, tmp_path, content):
    path = write(tmp_path / "i.json", json.dumps(content, indent=1))
    assert [tuple(r) for r in selection.importances_from_json(spark, path).collect()] == [("b", 0.7), ("a", 0.2)]


def test_column_roles():
    assert roles.generation_columns(["id", "val_gerhidraulica", "val_gertermica", "val_gereolica", "val_gersolar", "ger_hidro2"]) == {
        "ger_hidreletrica_mwh": "val_gerhidraulica", "ger_termica_mwh": "val_gertermica", "ger_eolica_mwh": "val_gereolica", "ger_fv_mwh": "val_gersolar"}
    assert roles.flow_columns(["id_subsistema_origem", "nom_subsistema_destino", "val_intercambiomwmed"]) == (
        "id_subsistema_origem", "nom_subsistema_destino", "val_intercambiomwmed")
    assert roles.inflow_column(["id", "ena_bruta_regiao_mwmed", "ena_x"]) == "ena_bruta_regiao_mwmed"
    assert roles.inflow_column(["data", "valor"]) == "valor"
    assert roles.storage_column(["ear_max_subsistema", "ear_verif_subsistema_percentual"]) == "ear_verif_subsistema_percentual"
    assert roles.series_column(["x", "nom_subsistema", "submercado"]) == "nom_subsistema"
    assert roles.is_subdaily(["data", "hora"]) and not roles.is_subdaily(["dat_referencia", "val"])
    for fn in (roles.generation_columns, roles.flow_columns, roles.inflow_column, roles.storage_column):
        with pytest.raises(roles.UnknownLayout):
            fn(["a", "b"])


def test_load_role_needs_numbers(spark):
    df = spark.createDataFrame([("x", "1", "2")], "val_cargaglobal string, carga_verificada_mw string, valor string")
    assert roles.load_column(df) == "carga_verificada_mw"
    assert roles.load_column(df.drop("carga_verificada_mw")) == "valor"
    with pytest.raises(roles.UnknownLayout):
        roles.load_column(df.select("val_cargaglobal"))


@pytest.mark.parametrize("hours", [[0, 1, 2, 3, 20, 40, 60, 80, 100, 120], [0, 7, 14, 21, 22, 23, 24, 25, 26, 27, 28], [0, 5, 12, 17, 24, 29, 36, 41, 48, 53],
                                   list(range(12)), list(range(0, 96, 8)), [0, 1], [5] * 10])
def test_intraday_without_order_where_it_is_settled(spark, hours):
    df = spark.createDataFrame([(h,) for h in hours], "h int").select((F.lit("2024-01-01").cast("timestamp") + F.make_interval(hours="h")).alias("ts"))
    wanted = energy.cadence(df.withColumn("k", F.lit(1)), ["k"], "ts").first()["is_intraday"]
    assert energy.is_intraday(df.groupBy("ts").agg(F.count(F.lit(1)).alias("n")), "ts", "n") == wanted


def test_instants(spark):
    df = spark.createDataFrame([("2024-01-02", "03:00"), ("bad", "1")], "data string, hora string")
    assert [str(r[0]) for r in df.select(roles.instant(df)).collect()] == ["2024-01-02 03:00:00", "None"]
    month = spark.createDataFrame([("2024", "2"), ("2024", "13")], "ano string, mes string")
    assert [str(r[0])[:10] for r in month.select(roles.day_of_period(month)).collect()] == ["2024-02-01", "None"]
    with pytest.raises(roles.UnknownLayout):
        roles.instant(spark.createDataFrame([(1,)], "x int"))


def test_feeds_merge_spellings(spark):
    rows = [("SE", "2024-01-01 00:00", "1"), ("Sudeste/Centro-Oeste", "2024-01-01 01:00", "2"), ("NE", "2024-01-01 00:00", "x"), ("SE", "bad", "9")]
    df = spark.createDataFrame(rows, "id_subsistema string, din_instante string, val_gereolica string")
    out = as_dict(feeds.generation(df), "series_key")
    assert out["seco"]["ger_eolica_mwh"] == 3.0 and out["ne"]["ger_eolica_mwh"] is None
    flows = spark.createDataFrame([("SE", "NE", "2024-01-01", "4"), ("sudeste", "NE", "2024-01-01", "1")], "origem string, destino string, data string, valor string")
    assert as_dict(feeds.exchange(flows), "series_key")["seco"] == {"data": "2024-01-01", "import_mwh": 0.0, "export_mwh": 5.0}
    alone = spark.createDataFrame([("2024-01-01", "7")], "data string, carga_mwh string")
    assert as_dict(feeds.load(alone), "series_key")["seco"]["carga_mwh"] == "7" or as_dict(feeds.load(alone), "series_key")["seco"]["carga_mwh"] == 7.0


def test_curtailment_chooses_its_method(spark):
    monthly = spark.createDataFrame([("2024-02-01", "29", "SE"), ("2024-02-05", None, "SE")], "competencia string, corte_mwh string, submercado string")
    out = feeds.curtailment(monthly, "fv")
    assert out.columns == ["series_key", "data", "corte_fv_mwh"] and out.count() == 29
    assert out.agg(F.sum("corte_fv_mwh")).first()[0] == pytest.approx(29.0)
    pair = spark.createDataFrame([("2024-02-01", "5", "3")], "data string, val_geracaoestimada string, val_geracaoverificada string")
    assert feeds.curtailment(pair, "eolica").agg(F.sum("corte_eolica_mwh")).first()[0] == pytest.approx(2 * 24 * 29)
    rows = [("u", f"2024-01-01 {h:02d}:{m}", "10", "4", "8") for h in range(6) for m in ("00", "30")]
    intraday = spark.createDataFrame(rows, "id_ons string, din_instante string, val_geracaoreferencia string, val_geracaolimitada string, val_geracao string")
    total = lambda **o: feeds.curtailment(intraday, "eolica", **o).agg(F.sum("corte_eolica_mwh")).first()[0]
    assert total() == pytest.approx(6 * 6) and total(method="ref_minus_gen") == pytest.approx(2 * 6)
    assert total(method="limited") == pytest.approx(4 * 6)
    with pytest.raises(roles.UnknownLayout):
        feeds.curtailment(spark.createDataFrame([("2024-01-01", "x")], "data string, other string"), "fv")
    # Several candidates: the first of numbers alone, judged over all rows; without one, the pair.
    cols = "competencia string, corte_txt string, corte_mwh string, val_geracaoestimada string, val_geracaoverificada string"
    several = [("2024-02-01", "x", "29", "5", "3"), ("bad", "1", "1", "0", "0")]
    some = lambda rows: feeds.curtailment(spark.createDataFrame(rows, cols), "fv").agg(F.sum("corte_fv_mwh")).first()[0]
    assert some(several) == pytest.approx(29.0)
    assert some([several[0], ("bad", "1", "y", "0", "0")]) == pytest.approx(2 * 24 * 29)
    with pytest.raises(roles.UnknownLayout):
        feeds.curtailment(spark.createDataFrame([("2024-01-01", "x")], "data string, corte_mwh string"), "fv")


def test_load_reads_the_first_numeric_column(spark):
    rows = [("SE", "2024-01-01 00:00", "x", "1", "5"), ("Sudeste", "2024-01-01 01:00", "2", " ", "6"), ("SE", None, "3", "2", "x")]
    cols = "subsistema string, din_instante string, val_cargaglobal string, carga_verificada_mw string, valor string"
    assert as_dict(feeds.load(spark.createDataFrame(rows, cols)), "series_key")["seco"]["carga_mwh"] == 1.0
    daily = spark.createDataFrame([("SE", "2024-01-01", "x", "1"), ("NE", "2024-01-01", "3", "2")],
                                  "subsistema string, dat_referencia string, val_cargaglobal string, valor string")
    assert {k: v["carga_mwh"] for k, v in as_dict(feeds.load(daily), "series_key").items()} == {"seco": 1.0, "ne": 2.0}
    both = daily.withColumn("carga_mwh", F.lit("7"))
    assert as_dict(feeds.load(both), "series_key")["ne"]["carga_mwh"] == 7.0
    with pytest.raises(roles.UnknownLayout):
        feeds.load(daily.drop("valor"))


RESOURCES = [
    # id, name, description, url, format, last_modified
    ("1", "Serie 2022-04", None, "http://x/a", "CSV", "2024-01-02T00:00:00"),
    ("2", "Serie 202204", None, "http://x/b", "csv", "2024-01-01T00:00:00"),
    ("3", "Serie 2022_04", None, "http://x/c", "XLSX", "2020-01-01T00:00:00"),
    ("4", "Serie 2022", None, "http://x/d.zip", None, None),
    ("5", "Serie", None, "http://x/e", "PDF", "2021-07-05T10:00:00.123Z"),
    ("6", "Dicionario 2022-04", None, "http://x/f", "CSV", None),
    ("7", None, None, None, None, "rubbish"),
]


@pytest.fixture(scope="module")
def resources(spark):
    return spark.createDataFrame(RESOURCES, "id string, name string, description string, url string, format string, last_modified string")


def test_periods(resources):
    keys = as_dict(resources.select("id", catalog.period_key(resources).alias("p")), "id")
    assert [keys[i]["p"] for i in "1234567"] == ["2022-04", "2022-04", "2022-04", "2022", "2021-07", "2022-04", "7"]
    data = as_dict(resources.select("id", catalog.is_data_file(resources).alias("d")), "id")
    assert [i for i in "1234567" if data[i]["d"]] == ["1", "2", "3", "4"]
    def ids(*bounds):
        return sorted(r["id"] for r in catalog.in_period(resources, *bounds).collect())
    assert ids("2022") == ["1", "2", "3", "4", "6"]
    assert ids("2022-04") == ["1", "2", "3", "6"]
    assert ids(None, "2022-04") == ["1", "2", "3", "5", "6"]
    assert ids(None, "2022") == ["1", "2", "3", "4", "5", "6"]
    assert ids("2021-08", "2022-03") == []
    assert ids() == list("1234567")
    assert catalog.first_day_of("2022") == "2022-01-01" and catalog.first_day_of("2022-4") == "2022-04-01" and catalog.first_day_of("x") is None


def test_best_resources(resources):
    files = resources.filter(catalog.is_data_file(resources))
    best = as_dict(catalog.best_per_period(files).select("period", "id"), "period")
    assert best == {"2022-04": {"id": "2"}, "2022": {"id": "4"}}
    assert as_dict(catalog.best_per_period(files, newest=True).select("period", "id"), "period")["2022-04"]["id"] == "1"
    assert catalog.best_overall(files).first()["id"] == "2"
    assert catalog.filter_names(resources, "Dici").count() == 1 and catalog.filter_names(resources, "zzz").count() == 7


def test_packages(spark):
    df = spark.createDataFrame([("1", "carga-detalhada", "Carga Verificada Detalhada", "2024-01-01"), ("2", "carga", "Carga Verificada", "2023-01-01"),
                                ("3", "other", "Outro", "2025-01-01")], "id string, name string, title string, metadata_modified string")
    scores = as_dict(df.select("id", catalog.package_score(df, "carga verificada").alias("s")), "id")
    assert [scores[i]["s"] for i in "123"] == [-190, 10, 0]
    assert catalog.best_package(df, "carga verificada").first()["id"] == "2"
    assert catalog.best_package(df, "carga verificada", "other").first()["id"] == "3"


def test_request_windows(frame):
    df = frame([("a", "2024-01-01", "2024-07-01"), ("b", "2024-01-05", "2024-01-01")], "k string, data string, z string", dates=("data", "z"))
    out = sorted((r["k"], str(r["window_start"]), str(r["window_end"])) for r in catalog.request_windows(df, "data", "z").collect())
    assert out == [("a", "2024-01-01", "2024-03-30"), ("a", "2024-03-31", "2024-06-28"), ("a", "2024-06-29", "2024-07-01"), ("b", "2024-01-05", "2024-01-05")]


def test_sources_round_trip(spark, frame, tmp_path):
    raw = str(tmp_path / "raw")
    load = frame([("2024-01-01", 1.0), ("2024-01-01", 3.0), ("2024-01-10", 5.0)], "data string, carga_mwh double")
    stores.write_table(load, f"{raw}/ons_carga.csv", fmt="csv")
    loaded = stores.load_sources(spark, raw)
    assert list(loaded) == ["carga"]
    out = as_dict(loaded["carga"], "data")
    assert len(out) == 10 and out["2024-01-08"]["carga_mwh"] == 2.0 and out["2024-01-09"]["carga_mwh"] is None
    assert out["2024-01-01"]["series_key"] == "seco"
    with pytest.raises(FileNotFoundError):
        stores.load_sources(spark, str(tmp_path / "nothing"))


def test_writers(spark, tmp_path):
    path, big = str(tmp_path / "t"), spark.range(1000)
    assert stores.write_table(big, path) and not stores.write_table(spark.range(1), path)
    assert spark.read.parquet(path).count() == 1000
    assert stores.write_table(spark.range(1), path, overwrite=True) and spark.read.parquet(path).count() == 1
    # A small result counts; an empty or unfinished one does not.
    assert not stores.write_table(big, path)
    os.remove(f"{path}/_SUCCESS")
    assert stores.write_table(spark.range(0), path) and stores.write_table(big, path)
    hist = str(tmp_path / "h")
    stores.append_scores(spark, hist, "a", 0.5, 0.6)
    assert stores.append_scores(spark, hist, "b", 0.7, 0.8).count() == 2
    # A named run is there once, with what it left last; other runs stay.
    for f1 in (0.1, 0.2):
        stores.append_scores(spark, hist, "c", f1, 0.9, run="night")
    got = stores.append_scores(spark, hist, "d", 0.3, 0.4, run="day").collect()
    assert sorted((r["modelo"], r["f1_macro"]) for r in got) == [("a", 0.5), ("b", 0.7), ("c", 0.2), ("d", 0.3)]


def test_run_history_with_odd_keys(spark, tmp_path):
    path = str(tmp_path / "runs")
    rows = lambda *r: spark.createDataFrame(r, "run_key string, v int")
    stores.record_runs(rows(("01", 1), ("a/b=c", 2), ("01", 3)), path)
    got = stores.record_runs(rows((None, 5), ("a/b=c", 4)), path).collect()
    assert sorted((r["run_key"] or "", r["v"]) for r in got) == [("", 5), ("01", 1), ("01", 3), ("a/b=c", 4)]
    assert stores.record_runs(rows().limit(0), path).count() == 4


def test_profiles(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (1, 2.0, None), (2, 3.0, 6.0), (3, 4.0, 8.0)], "k int, a double, b double")
    corr = as_dict(profile.correlation_matrix(df, ["a", "b"]), "var_a", "var_b")
    assert corr["a", "b"]["corr"] == pytest.approx(1.0) and corr["b", "b"]["corr"] == pytest.approx(1.0)
    d = as_dict(profile.describe(df, ["a", "b"]), "variable")
    assert (d["a"]["q50"], d["b"]["count"], d["b"]["q25"]) == (2.5, 3, 4.0)
    tests = as_dict(profile.data_tests(df, "t", [["k"]], ["b"], {"a": (None, 3.5)}), "test")
    assert [tests[t]["violations"] for t in ("unique(k)", "not_null(b)", "range(a)")] == [1, 1, 1]
    assert as_dict(profile.duplicate_keys(df, ["k"]), "k") == {1: {"surplus": 1}}
    parts = [r["part"] for r in profile.head_tail(df, ["k", "a"], 1).collect()]
    assert sorted(parts) == ["head", "tail"]
