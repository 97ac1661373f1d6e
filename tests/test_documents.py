"""Document reading, conversions and silver rows on hand-made cases."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions import casts, documents
from aerolake.operators import silver


def one(spark, expression, text):
    return spark.createDataFrame([(text,)], "s string").select(expression.alias("v")).head()[0]


@pytest.mark.parametrize("text,kind,want", [
    ("70", "int", 70), (" 7 ", "int", 7),
    ("70.5", "rounded int", 71), ("-70.5", "rounded int", -71),
    ("70." + "4" + "9" * 40, "rounded int", 70), ("1e3", "rounded int", 1000),
    ("1736164800.5", "rounded bigint", 1736164801),
    ("0.125", "decimal(5,2)", Decimal("0.13")), ("-0.125", "decimal(5,2)", Decimal("-0.13")),
    ("1e-5", "decimal(9,8)", Decimal("0.00001000")),
    ("2025-01-06T12:00:00-03:00", "timestamp", datetime(2025, 1, 6, 12)),
    ("2025-01-06T12:00:00Z", "timestamp", datetime(2025, 1, 6, 12)),
    ("ab  ", "varchar(3)", "ab "), ("abc", "varchar(3)", "abc"), ("São", "varchar(3)", "São"),
    (None, "int", None), (None, "varchar(3)", None),
])
def test_texts_that_fit(spark, text, kind, want):
    assert one(spark, casts.convert(F.col("s"), kind), text) == want
    assert one(spark, casts.try_convert(F.col("s"), kind), text) == want


@pytest.mark.parametrize("text,kind", [
    ("70.0", "int"), ("abc", "int"), ("3000000000", "int"), ("3e9", "rounded int"),
    ("123.45", "decimal(4,2)"), ("99.995", "decimal(4,2)"), ("{}", "timestamp"),
    ("abcd", "varchar(3)"), ("x", "decimal(5,2)"),
])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_texts_that_do_not_fit(spark, text, kind, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, casts.try_convert(F.col("s"), kind), text) is None
        with pytest.raises(Exception, match="does not fit"):
            one(spark, casts.convert(F.col("s"), kind, "c"), text)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def air(index=None, pollutants=None, **over):
    blocks = index if index is not None else [
        {"code": "uaqi", "aqi": 70, "aqiDisplay": "70", "displayName": "Universal AQI",
         "color": {"red": 0.1, "green": 0.2, "blue": 0.3}, "category": "Good",
         "dominantPollutant": "o3"},
        {"code": "bra", "aqi": 20, "aqiDisplay": "20", "displayName": "AQI (BR)",
         "color": {"red": 0.9, "green": 0.85}, "category": "Boa", "dominantPollutant": "o3"},
    ]
    items = pollutants if pollutants is not None else [
        {"code": p, "displayName": p.upper(), "fullName": f"name of {p}",
         "concentration": {"value": i + 0.5, "units": "PPB"}}
        for i, p in enumerate(model.POLLUTANTS)
    ]
    return {"datetime": "2025-01-06T12:00:00Z", "indexes": blocks, "pollutants": items, **over}


def checked(spark, document, build=silver.silver_air_quality, **options):
    text = document if isinstance(document, str) or document is None else json.dumps(document)
    rows = spark.createDataFrame([(1, text)], "id long, data string")
    return build(rows, ("id",), mode="checked", **options).head()


def test_whole_air_row(spark):
    row = checked(spark, {"Nazaré": air()})
    assert row.problems == "" and row.regiao == "Nazaré" and row.data_medicao == datetime(2025, 1, 6, 12)
    assert (row.aqi_universal, row.valor_display_universal, row.aqi_br) == (70, 70, 20)
    assert row.cor_br == Decimal("0.9")  # the green channel, one digit
    assert (row.cor_vermelho_universal, row.cor_azul_universal, row.cor_verde_universal) == (
        Decimal("0.1"), Decimal("0.3"), Decimal("0.2"))
    assert [row[f"{p}_valor"] for p in model.POLLUTANTS] == [Decimal(i) + Decimal("0.5") for i in range(6)]
    assert len(row) == 48 + 3


@pytest.mark.parametrize("indexes", [{}, [], "text", None])
def test_no_index_blocks(spark, indexes):
    row = checked(spark, {"P": air(indexes=indexes)})
    assert row.problems == ""
    assert all(row[leaf.column] is None for leaf in model.UNIVERSAL_INDEX + model.BR_INDEX)


def test_elements_that_are_no_objects(spark):
    document = air()
    row = checked(spark, {"P": air(indexes=[5, document["indexes"][1]],
                                   pollutants=[[1], *document["pollutants"][1:]])})
    assert (row.aqi_universal, row.aqi_br, row.co_code, row.so2_code) == (None, 20, None, "so2")
    assert row.problems == ""


def test_datetime_absent_and_null(spark):
    assert checked(spark, {"P": air(datetime={})}).problems == "data_medicao"
    row = checked(spark, {"P": air(datetime=None)})
    assert row.problems == "" and row.data_medicao is None


def test_missing_pollutant_by_position_and_by_code(spark):
    items = [p for p in air()["pollutants"] if p["code"] != "no2"]
    by_position = checked(spark, {"P": air(pollutants=items)})
    assert (by_position.no2_code, by_position.so2_code) == ("o3", None)
    by_code = checked(spark, {"P": air(pollutants=items)}, by="code")
    assert (by_code.no2_code, by_code.o3_code, by_code.so2_code) == (None, "o3", "so2")


@pytest.mark.parametrize("place", ["Pau d'Arco", 'Pau "d\' Arco', "São Brás", "a\\b", "a.b"])
def test_odd_place_names(spark, place):
    row = checked(spark, {place: air()})
    assert row.regiao == place and row.aqi_universal == 70 and row.problems == ""


def test_several_misfits_are_all_named(spark):
    document = air()
    document["indexes"][0]["aqi"] = 70.0
    row = checked(spark, {"x" * 21: document})
    assert row.problems == "regiao,aqi_universal" and row.aqi_universal is None


def test_root_key_shorter_first_and_last_duplicate(spark):
    assert checked(spark, {"Zeta": air(), "ab": air(datetime=None)}).regiao == "ab"
    twice = '{"a":{"datetime":"2025-01-01"},"a":{"datetime":"2025-01-02"}}'
    assert checked(spark, twice).data_medicao == datetime(2025, 1, 2)
    for keys, want in ((["ß", "aa", "b"], "b"), (["éa", "zzz"], "zzz"), (["b", "a"], "a")):
        text = json.dumps({k: 1 for k in keys}, ensure_ascii=False)
        assert one(spark, documents.root_key(F.col("s")), text) == want


@pytest.mark.parametrize("text,problems,root", [
    (None, "", None), ("{}", "", None), ("[1]", "document", None), ("no json", "document", None),
    ('"text"', "document", None), ('{"P":"text"}', "", "P"), ('{"P":null}', "", "P"),
    ('{"b":"text","a":{"datetime":"2025-01-01"}}', "", "a"),
])
def test_odd_documents(spark, text, problems, root):
    row = checked(spark, text)
    assert (row.problems, row.regiao) == (problems, root)


def test_strict_mode_stops(spark):
    rows = spark.createDataFrame([(1, "[1]")], "id long, data string")
    with pytest.raises(Exception, match="no JSON object"):
        silver.silver_weather(rows).collect()
    bad = json.dumps({"P": {"data": {"velocidade_vento": 123.45}}})
    rows = spark.createDataFrame([(1, bad)], "id long, data string")
    with pytest.raises(Exception, match="velocidade_vento"):
        silver.silver_weather(rows).collect()


def test_weather_row(spark):
    data = {"temperatura": 30.126, "sensacao_termica": "31.5", "umidade": 70.5, "pressao": -70.5,
            "velocidade_vento": 3.1, "direcao_vento": 90, "descricao": "céu limpo",
            "nascer_sol": 1736164800, "por_sol": 1736164800.5}
    row = checked(spark, {"P": {"latitude": -1.45, "longitude": -48, "data": data}},
                  silver.silver_weather)
    assert row.problems == ""
    assert (row.temperatura, row.sensacao_termica) == (Decimal("30.13"), Decimal("31.50"))
    assert (row.umidade, row.pressao, row.direcao_vento) == (71, -71, 90)
    assert (row.nascer_sol, row.por_sol) == (1736164800, 1736164801)
    assert row.latitude == Decimal("-1.45") and row.descricao == "céu limpo"


def test_one_parse_no_shuffle(spark, folder):
    spark.createDataFrame([(1, "{}")], "id long, data string").write.parquet(f"{folder}/b")
    bronze = spark.read.parquet(f"{folder}/b")
    for rows in (silver.silver_air_quality(bronze),
                 *silver.split_checked(silver.silver_air_quality(bronze, ("id",), mode="checked"))):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        # the typed parse, written once
        assert plan.count("from_json(ArrayType(MapType(StringType,StructType(StructField(datetime") == 1
    narrow = silver.silver_air_quality(bronze, ("id",)).select("aqi_br")
    scan = narrow._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<data:string>" in scan


@pytest.mark.parametrize("dt,want", [
    (1736164800, "2025-01-06 09:00:00"),
    (908074800, "1998-10-11 00:00:00"),  # an hour that this zone's clocks skipped
])
def test_epoch_to_local_text_ignores_the_session_zone(spark, dt, want):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        rows = spark.createDataFrame([(dt, -10800)], "dt long, tz int")
        text = documents.epoch_to_local_text(F.col("dt"), F.col("tz"))
        assert rows.select(text).head()[0] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("value", [1, 1.5, 70.0, -3, "text", 'q"\\\n', "", True, False, None, "true", "0", "1.50", "{x", "[chuva] leve",
                                   "null", [1, {"a": "b"}], {"k": None, "n": "5"}])
def test_json_values_keep_their_type(spark, value):
    text = json.dumps({"v": value, "w": 1})
    members = documents.json_members(F.col("s"))
    back = documents.wrap_document(F.lit("P"), documents.json_object({"v": members[0]["json"]}))
    got = json.loads(one(spark, back, text))["P"]["v"]
    assert got == value and type(got) is type(value)


@pytest.mark.parametrize("text", ["{'A':{'x':1}}", '{"A":{"x":1}} more', '{"A":{"x":1}},{"B":{}}', '{"A":{"x":1}}]', '{"A":{"x":1}',
                                  "", "[1]", "5", "null", '{"A":{"x":1}},'])
def test_what_is_no_json_object_is_refused(spark, text):
    assert one(spark, documents.json_members(F.col("s")), text) is None
    assert one(spark, documents.parse_document(F.col("s"), "struct<x:string>"), text) is None


def test_members_that_look_nested_keep_their_type(spark):
    text = '{"a":[1,"x"],"b":"[1]","c":{"k":[]},"d":"{\\"k\\":1}","e":[],"f":"[x","g":7.0,"h":"7.0"}'
    got = {m["key"]: m["json"] for m in one(spark, documents.json_members(F.col("s")), text)}
    assert got == {"a": '[1,"x"]', "b": '"[1]"', "c": '{"k":[]}', "d": '"{\\"k\\":1}"', "e": "[]", "f": '"[x"', "g": "7.0", "h": '"7.0"'}


def test_root_key_passes_over_objects(spark):
    rows = spark.createDataFrame([('{"long":{"a":1},"k":{"b":{"c":[2]}}}',), ('{"k":5,"x":{"y":1}}',), ('{"k":{}} 1',)], "s string")
    shown = rows.select(documents.root_key(F.col("s")).alias("k"))
    assert "StructField" in shown._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in shown.collect()] == ["k", "k", None]
