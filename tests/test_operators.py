"""Sources, reshaping, numbering, lookups, statistics and contracts."""

import json
import random

import pytest
from pyspark.sql import functions as F

from aerolake.operators import contracts, lookups, numbering, reshape, skew, stats
from aerolake.plans import etl, tables
from aerolake.sources import api, landed, places, synthetic


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# --- places and requests --------------------------------------------------------


def test_places_from_map(spark):
    text = json.dumps({"Nazaré": [-1.4523, -48.4776], "Pau d'Arco": [-1.3, -48.4, 7]})
    rows = places.places_from_map(frame(spark, [(text,)], "places string")).collect()
    assert [tuple(r) for r in rows] == [("Nazaré", -1.4523, -48.4776), ("Pau d'Arco", -1.3, -48.4)]
    with pytest.raises(Exception, match="no coordinate pair"):
        places.places_from_map(frame(spark, [('{"x":[1]}',)], "places string")).collect()


@pytest.mark.parametrize("value,text", [
    (0.0, "0.0"), (-0.0, "0.0"), (5.0, "5.0"), (-48.4776, "-48.4776"), (0.0005, "0.0005"), (1e-9, "0.000000001"),
    (-179.999999, "-179.999999"), (100.0, "100.0"), (10.01, "10.01"), (None, None),
])
@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_number(spark, value, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = frame(spark, [(value,)], "v double")
        assert rows.select(places.plain_number(F.col("v"))).head()[0] == text
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_requests(spark):
    rows = frame(spark, [("P", -1.4523, 0.0005)], "nome string, latitude double, longitude double")
    weather = places.weather_requests(rows).head()
    assert (weather.lat, weather.lon, weather.units) == ("-1.4523", "0.0005", "metric")
    body = json.loads(places.air_quality_requests(rows).head().body)
    assert body == {
        "universalAqi": True, "location": {"latitude": -1.4523, "longitude": 0.0005},
        "extraComputations": ["DOMINANT_POLLUTANT_CONCENTRATION", "POLLUTANT_CONCENTRATION", "LOCAL_AQI"],
        "languageCode": "pt-br",
    }
    assert not any("key" in c.lower() for c in places.weather_requests(rows).columns)


WEATHER = {
    "main": {"temp": 30.1, "feels_like": 33.25, "humidity": 70, "pressure": 1010},
    "wind": {"speed": 3.6, "deg": 90}, "weather": [{"description": 'chuva "leve"'}],
    "sys": {"sunrise": 1736164800, "sunset": 1736208000},
}
AIR = {"regionCode": "br", "dateTime": "2025-01-06T12:00:00Z",
       "indexes": [{"code": "uaqi", "aqi": 70, "extra": [1]}], "pollutants": []}


def weather_stub(method, url, params, payload):
    answer = json.loads(json.dumps(WEATHER))
    answer["main"]["temp"] = float(params["lat"])
    return 200, json.dumps(answer)


def air_stub(method, url, params, payload):
    where = json.loads(payload)["location"]["latitude"]
    return (404, "{}") if where > 89 else (200, json.dumps(AIR))


def test_data_source_and_fan_out_agree(spark):
    rows = spark.range(37).selectExpr(
        "concat('p', id) AS nome", "CAST(id AS double) AS latitude", "0.5D AS longitude")
    requests = places.weather_requests(rows)
    columns = ("nome", "latitude", "status", "body")
    read = api.weather_source(spark, requests, weather_stub, calls_per_task=5).select(*columns)
    fanned = api.fan_out(requests, weather_stub, 4).select(*columns)
    assert read.rdd.getNumPartitions() >= 8
    assert sorted(read.collect()) == sorted(fanned.collect())
    assert read.count() == 37


def test_data_source_without_requests(spark):
    none = spark.range(0).selectExpr("'x' AS nome", "1.0D AS latitude", "1.0D AS longitude")
    assert api.weather_source(spark, places.weather_requests(none), weather_stub).count() == 0


# --- reshaping ------------------------------------------------------------------


def responses(spark, *bodies):
    rows = [("P", 1.5, -2.0, i, 200, json.dumps(b)) for i, b in enumerate(bodies)]
    return frame(spark, rows, "nome string, latitude double, longitude double, ordinal long, "
                              "status int, body string")


def test_weather_document(spark):
    flat = reshape.weather_flatten(responses(spark, WEATHER))
    document = reshape.wrap_documents(reshape.weather_document(flat)).head().data
    assert json.loads(document) == {"P": {"latitude": 1.5, "longitude": -2.0, "data": {
        "temperatura": 30.1, "sensacao_termica": 33.25, "umidade": 70, "pressao": 1010,
        "velocidade_vento": 3.6, "direcao_vento": 90, "descricao": 'chuva "leve"',
        "nascer_sol": 1736164800, "por_sol": 1736208000}}}


@pytest.mark.parametrize("change,missing", [
    (lambda w: w["main"].pop("temp"), "main.temp"),
    (lambda w: w.update(weather=[]), "weather.description"),
    (lambda w: w.pop("wind"), "wind.speed"),
    (lambda w: w.clear() or w.update(cod=401, message="bad key"), "main.temp"),
])
def test_weather_members_are_mandatory(spark, change, missing):
    body = json.loads(json.dumps(WEATHER))
    change(body)
    rows = responses(spark, WEATHER, body)
    with pytest.raises(Exception, match="response without"):
        reshape.weather_flatten(rows).collect()
    tolerant = {r.ordinal: r.missing for r in reshape.weather_flatten(rows, mode="checked").collect()}
    assert tolerant[0] == [] and missing in tolerant[1]


def test_null_member_is_present(spark):
    body = json.loads(json.dumps(WEATHER))
    body["main"]["temp"] = None
    flat = reshape.weather_flatten(responses(spark, body))
    assert flat.head().temperatura is None
    assert json.loads(reshape.weather_document(flat).head().doc)["data"]["temperatura"] is None


@pytest.mark.parametrize("body,want", [
    (AIR, {"datetime": AIR["dateTime"], "indexes": AIR["indexes"], "pollutants": []}),
    ({}, {"datetime": {}, "indexes": {}, "pollutants": {}}),
    ({"dateTime": None, "indexes": None}, {"datetime": None, "indexes": None, "pollutants": {}}),
])
def test_air_quality_document(spark, body, want):
    document = reshape.air_quality_reshape(responses(spark, body)).head().doc
    assert json.loads(document) == want


def test_dict_to_rows_inverts_wrapping(spark):
    text = json.dumps({"a": {"x": [1, 2]}, 'b"c': {"y": None}})
    rows = reshape.dict_to_rows(frame(spark, [(text,)], "data string"))
    back = reshape.wrap_documents(rows, "place", "doc")
    merged = {}
    for r in back.collect():
        merged.update(json.loads(r.data))
    assert merged == json.loads(text)


def test_latest_per_place_whatever_the_order(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"p{rng.randrange(20)}", i, f"doc{i}") for i in range(500)]
    rows += [(None, 500, "nameless"), (None, 501, "last nameless")]
    want = {}
    for place, ordinal, doc in rows:
        want[place] = doc
    rng.shuffle(rows)
    df = frame(spark, rows, "place string, ordinal long, doc string").repartition(5)
    got = reshape.latest_per_place(df, "place", "ordinal").collect()
    assert {r.place: r.doc for r in got} == want and len(got) == len(want)


def test_error_classes(spark):
    rows = frame(spark, [(200,), (301,), (400,), (404,), (503,), (None,)], "status int")
    good, bad = reshape.ok_responses(rows)
    assert good.count() == 2
    assert {(r.status, r.error_class) for r in bad.collect()} == {
        (400, "bad_request"), (404, "not_found"), (503, "unexpected"), (None, "unexpected")}
    with pytest.raises(Exception, match="response status"):
        reshape.ok_responses(rows, mode="strict").collect()


def test_city_local_time(spark):
    body = {"dt": 1736164800, "timezone": -10800, "name": "Belém", "main": {"temp": 1}, "x": None}
    rows = frame(spark, [("Belem", 200, json.dumps(body))], "q string, status int, body string")
    row = reshape.city_local_time(rows).head()
    assert row.dt == "2025-01-06 09:00:00"
    assert json.loads(row.body) == {**body, "dt": "2025-01-06 09:00:00"}


# --- numbering, skew, paging ------------------------------------------------------


def test_ids_are_dense_under_copies_and_hot_keys(spark):
    rows = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 ELSE id % 700 END AS k", "'same' AS v").repartition(6)
    numbered = numbering.surrogate_id(rows, ("k",), start=10).collect()
    by_id = sorted(numbered, key=lambda r: r.id)
    assert [r.id for r in by_id] == list(range(11, 9011))
    assert [r.k for r in by_id] == sorted(r.k for r in by_id)
    assert sorted(r.id for r in numbering.surrogate_id(rows).collect()) == list(range(1, 9001))
    assert numbering.surrogate_id(rows.limit(0)).count() == 0


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_lookup_join_equals_a_plain_join(spark, how):
    rows = spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL "
              "WHEN id % 5 = 0 THEN 'hot but unknown' ELSE concat('k', id) END AS k")
    table = spark.range(0, 3000, 2).selectExpr("concat('k', id) AS k", "id AS v").union(
        frame(spark, [("hot", -1)], "k string, v long"))
    hot = skew.hot_keys(rows, "k", least=100, fraction=1.0)
    assert hot == ["hot", "hot but unknown"]
    assert skew.hot_keys(rows, "k") == []
    got = skew.lookup_join(rows, table, "k", how, hot)
    want = rows.join(table, "k", how)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))


def test_deep_pages_equal_shallow_ones(spark, monkeypatch):
    rows = spark.range(5000).selectExpr("concat('k', lpad(id, 6, '0')) AS k", "id AS v").repartition(7)
    shallow = [r.v for r in lookups.page_rows(rows, "k", 3200, 50).collect()]
    monkeypatch.setattr(lookups, "SHALLOW_ROWS", 100)
    deep = [r.v for r in lookups.page_rows(rows, "k", 3200, 50).collect()]
    assert deep == shallow == list(range(3200, 3250))
    assert [r.v for r in lookups.page_rows(rows, "k", 4990, 200).collect()] == list(range(4990, 5000))


@pytest.mark.parametrize("skip, limit", [(0, 3), (2, 4), (5, 100)])
def test_pages_over_null_and_repeated_keys_are_the_same_at_any_depth(spark, monkeypatch, skip, limit):
    rows = frame(spark, [("b", 1), (None, 2), ("a", 3), ("a", 3), ("a", 4), ("c", 5), (None, None)], "k string, v long")
    shallow = lookups.page_rows(rows, "k", skip, limit).collect()
    monkeypatch.setattr(lookups, "SHALLOW_ROWS", 0)
    assert lookups.page_rows(rows, "k", skip, limit).collect() == shallow
    assert len(shallow) == min(limit, 7 - skip)


def test_a_call_without_answer_is_a_row(monkeypatch):
    from urllib import error, request

    from aerolake.sources import api

    monkeypatch.setenv("KEY", "k")
    for failure in (TimeoutError("late"), error.URLError("refused"), ConnectionResetError("gone"), ValueError("bytes")):
        def fail(*_, failure=failure, **__):
            raise failure

        monkeypatch.setattr(request, "urlopen", fail)
        status, body = api.http_fetcher("KEY", "key")("GET", "http://nowhere.invalid/", {}, "")
        assert status is None and type(failure).__name__ in body


@pytest.mark.parametrize("text, kind, ok", [
    ("2025", "datetime", False), ("2025-01", "datetime", False), ("2025-01-02", "datetime", True),
    ("2025-01-02T03:04:05Z", "datetime", True), ("1.5d", "float", False), ("1f", "float", False), ("1d", "int", False),
    ("1.5", "float", True), (" 7 ", "int", True), ("-1e3", "float", True)])
def test_types_of_texts(spark, text, kind, ok):
    row = frame(spark, [(text,)], "v string").select(contracts.check_type(F.col("v"), kind)).head()
    assert row[0] is not ok


@pytest.mark.parametrize("email, ok", [
    ("a@example.com", True), ("a.b+c@mail.example.com", True), ("joão@example.com", True), ("a..b@example.com", False),
    (".a@example.com", False), ("a.@example.com", False), ("a@-x.com", False), ("a@x-.com", False), ("a@b", False),
    ("a b@example.com", False), ("a@@example.com", False)])
def test_email_forms(spark, email, ok):
    row = frame(spark, [(email,)], "v string").select(contracts.check_email().broken(F.col("v"))).head()
    assert row[0] is not ok


def test_contract_reads_either_name(spark):
    field = contracts.Field("phone_number", "text", (contracts.check_length(11, 20),), "phoneNumber")
    for name in ("phoneNumber", "phone_number"):
        rows = contracts.check_contract(frame(spark, [("12345678901",), ("1",)], f"{name} string"), (field,)).collect()
        assert [len(r.violations) for r in rows] == [0, 1]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, folder):
    spark.range(100).selectExpr(
        "concat('u', id) AS id", "concat(id, '@x.org') AS email", "'user' AS role",
        "'active' AS signatureStatus", "'no' AS notifications").write.parquet(f"{folder}/users")
    users = spark.read.parquet(f"{folder}/users")
    by_id = plan(lookups.lookup_by_id(users, "u7"))
    assert "EqualTo(id,u7)" in by_id
    assert "TakeOrderedAndProject" in plan(lookups.page_rows(users, "email", 5, 10))
    counted = plan(stats.user_stats(users))
    assert counted.count("FileScan") == 1 and "Expand" not in counted
    assert "email" not in counted.split("ReadSchema")[1]
    events = users.selectExpr("id AS nome", "1 AS ordinal", "email AS doc")
    for threshold in ("10485760", "-1"):  # small and large tables
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        last = plan(reshape.latest_per_place(events, "nome", "ordinal"))
        assert last.count("Exchange") == 1 and last.count("FileScan") == 1
        assert "partial_max_by" in last.split("Exchange")[1] and "Window" not in last and "Join" not in last
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    ids = numbering.surrogate_id(users.select("email"), ("email",))
    window = plan(ids).split("Window [")[1]
    assert "email" not in window.split("FileScan")[0].split("HashAggregate")[0]
    assert "CartesianProduct" not in plan(ids) and "NestedLoop" not in plan(ids)


@pytest.mark.parametrize("skip,limit", [(-1, 10), (0, 0), (0, -5)])
def test_page_arguments(spark, skip, limit):
    with pytest.raises(ValueError):
        lookups.page_rows(spark.range(3), "id", skip, limit)


def test_lookups(spark):
    rows = frame(spark, [("1", "a@x.org"), ("2", "b@x.org")], "id string, email string")
    assert lookups.lookup_by_id(rows, "2").head().email == "b@x.org"
    assert lookups.lookup_by_id(rows, "9").isEmpty()
    assert lookups.lookup_ids(rows, frame(spark, [("2",), ("9",)], "id string")).count() == 1
    wanted = frame(spark, [(0, "a@x.org"), (1, "z@x.org"), (2, "a@x.org")], "ordinal long, email string")
    got = {r.ordinal: (r.id, r.outcome) for r in lookups.lookup_by_email(rows, wanted).collect()}
    assert got == {0: ("1", "found"), 1: (None, "not_found"), 2: ("1", "found")}
    assert [r.id for r in lookups.sample_rows(rows, "id").collect()] == ["1", "2"]


def test_stats(spark):
    empty = frame(spark, [], "id string, role string, signatureStatus string, notifications string")
    assert [tuple(r) for r in stats.user_stats(empty).collect()] == [("total", None, 0)]
    rows = frame(spark, [("1", "admin", None, "yes"), ("2", "admin", "active", "yes")], empty.schema)
    assert {tuple(r) for r in stats.user_stats(rows).collect()} == {
        ("total", None, 2), ("role", "admin", 2), ("status", None, 1), ("status", "active", 1),
        ("notifications", "yes", 2)}


# --- contracts --------------------------------------------------------------------


def violations(spark, contract, schema, **values):
    row = frame(spark, [(1, *values.values())], f"key long, {schema}")
    found = contracts.validate_contract(row, contract, "key")[1].collect()
    return {(r.column, r.rule) for r in found}


USER = ("id string, name string, email string, signatureStatus string, phone_number string, "
        "role string, notifications string, password string")
GOOD_USER = dict(id="1", name="Ana", email="ana@example.com", signatureStatus=None,
                 phone_number="55919888777", role="user", notifications=None, password="x" * 8)


@pytest.mark.parametrize("change,found", [
    ({}, set()),
    ({"name": ""}, {("name", "length")}),
    ({"name": "x" * 101, "role": "root"}, {("name", "length"), ("role", "enum")}),
    ({"email": "no mail"}, {("email", "email")}),
    ({"email": None}, {("email", "required")}),
    ({"phone_number": "123"}, {("phone_number", "length")}),
    ({"password": "short", "signatureStatus": "x"}, {("password", "length"), ("signatureStatus", "enum")}),
])
def test_user_create(spark, change, found):
    assert violations(spark, "user_create", USER, **{**GOOD_USER, **change}) == found


def test_user_update_is_all_optional(spark):
    assert violations(spark, "user_update", "name string", name="") == set()
    assert violations(spark, "user_update", "password string", password="short") == {("password", "length")}
    assert violations(spark, "user_update", "email string", email=None) == set()


@pytest.mark.parametrize("contract,schema,values,found", [
    ("sensor", "id long, place_id long, source_id long, water_level string, water_level_unit string, "
               "created_at string",
     dict(i=1, p=0, s=1, w="1234.5", u="", c="2025-01-06T12:00:00Z"),
     {("place_id", "range"), ("water_level", "digits"), ("water_level_unit", "length")}),
    ("sensor", "id long, place_id long, source_id long, water_level string, water_level_unit string, "
               "created_at string",
     dict(i=1, p=1, s=1, w="1.234", u="m", c="soon"),
     {("water_level", "digits"), ("created_at", "type")}),
    ("message", "to string, place string, floor string", dict(t="123", p="x", f="1"), {("to", "length")}),
    ("subscription_plan", "id long, name string, description string, days_time_duration string, "
                          "price string", dict(i=1, n="n", d="", t="30", p="0"), {("price", "range")}),
    ("subscription", "id long, user_id string, place_id long, start_date string, end_date string, "
                     "status string, created_at string, updated_at string",
     dict(i=1, u="", p=1, s="2025-01-02", e="2025-01-01", st="lost", c="2025-01-01", x="2025-01-01"),
     {("user_id", "length"), ("status", "enum")}),
    ("favorite_place", "user_id string, place_id long, created_at string, name string",
     dict(u="uuid", p=1, c="2025-01-01", n=None), {("user_id", "type")}),
    ("favorite_place", "user_id long, place_id long, created_at string",
     dict(u=1, p=1, c="2025-01-01"), {("name", "required")}),
    ("air_quality", "id long, place_id long, source_id long, aqi_universal double, "
                    "name_display string, display_value string, created_at string",
     dict(i=1, p=1, s=1, a=-0.5, n="", d="x", c="2025-01-01"),
     {("aqi_universal", "range"), ("name_display", "length")}),
    ("data_source", "id long, name string", dict(i=0, n=None), {("id", "range"), ("name", "required")}),
    ("weather", "id long, place_id long, source_id long, temperature double, humidity double, "
                "wind_speed double, wind_direction string, created_at string",
     dict(i=1, p=1, s=1, t=1e30, h=1.0, w=1.123, d="1.5", c="2025-01-01"),
     {("temperature", "digits"), ("wind_speed", "digits"), ("wind_direction", "type")}),
    ("pollutant", "id long, place_id long, data_source_id long, dominant_pollutant string, "
                  "concentration double, metric_unit string, created_at string",
     dict(i=1, p=1, s=1, d="x" * 51, c=1.23456, m="ppb", t="2025-01-01"),
     {("dominant_pollutant", "length"), ("concentration", "digits")}),
])
def test_contracts(spark, contract, schema, values, found):
    assert violations(spark, contract, schema, **values) == found


def test_fractions_are_no_integers(spark):
    fields = (contracts.Field("n", "int", (contracts.check_range(gt=0),)),)
    rows = frame(spark, [(1, 1.0), (2, 1.5), (3, -2.0), (4, 1e30)], "key long, n double")
    found = contracts.violations(contracts.check_contract(rows, fields), "key").collect()
    assert {(r.key, r.rule) for r in found} == {(2, "type"), (3, "range"), (4, "type")}


def test_unique_and_not_null(spark):
    rows = frame(spark, [(1, "a"), (2, "b"), (3, "a"), (4, None)], "key long, email string")
    assert {r.key for r in contracts.check_unique(rows, "email", "key").collect()} == {1, 3}
    assert {(r.key, r.column) for r in contracts.check_not_null(rows, ("key", "email"), "key").collect()} == {
        (4, "email")}


# --- tables and jobs --------------------------------------------------------------


@pytest.fixture()
def catalog(spark, folder):
    prefix = f"t{random.randrange(10**9)}_"
    tables.create_schemas(spark, prefix, folder)
    tables.create_tables(spark, folder, prefix)
    return prefix


def test_tables_are_created_once_and_check_widths(spark, folder, catalog):
    tables.create_schemas(spark, catalog, folder)
    tables.create_tables(spark, folder, catalog)
    name = f"{catalog}silver.google_api_data"
    assert len(spark.table(name).columns) == 50
    spark.sql(f"INSERT INTO {name} (id, regiao) VALUES (1, 'Nazaré')")
    assert spark.table(name).head().created_at is not None
    with pytest.raises(Exception, match="(?i)exceeds|limit"):
        spark.sql(f"INSERT INTO {name} (id, regiao) VALUES (2, '{'x' * 21}')")


def test_silver_files_by_day(spark, folder):
    rows = spark.range(20).selectExpr(
        "id", "TIMESTAMP_NTZ '2025-01-06 23:00:00' + make_dt_interval(0, CAST(id % 4 AS INT)) AS data_medicao")
    for _ in range(2):
        tables.silver_append(rows, f"{folder}/silver", "data_medicao")
    stored = spark.read.parquet(f"{folder}/silver")
    assert stored.count() == 40
    assert {str(r[0]) for r in stored.select("dia").distinct().collect()} == {"2025-01-06", "2025-01-07"}
    assert "PartitionFilters: [isnotnull(dia" in plan(stored.filter("dia = DATE '2025-01-07'"))


def test_bronze_scan_pushes_the_id(spark, folder):
    spark.range(10).selectExpr("id", "'{}' AS data").write.parquet(f"{folder}/b")
    new = landed.bronze_scan(spark, f"{folder}/b", after_id=6)
    assert new.count() == 3 and "GreaterThan(id,6)" in plan(new)


def test_seeding(spark, catalog):
    name = f"{catalog}dev.users"
    first, second = synthetic.synthetic_users(spark, 30, 1), synthetic.synthetic_users(spark, 7, 2)
    assert tables.truncate_users(spark, name) == 0
    assert tables.seed_guard(spark, name, first) == "seeded"
    assert tables.seed_guard(spark, name, second) == "kept"
    assert landed.user_scan(spark, name).count() == 30
    assert tables.seed_guard(spark, name, second, clear_existing=True) == "replaced"
    assert {r.id for r in spark.table(name).collect()} == {r.id for r in second.collect()}
    assert tables.truncate_users(spark, name) == 7 and spark.table(name).count() == 0


def test_failed_replacement_keeps_the_rows(spark, catalog):
    name = f"{catalog}dev.users"
    tables.bulk_insert_users(synthetic.synthetic_users(spark, 5), name)
    broken = synthetic.synthetic_users(spark, 5).withColumn("name", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        tables.replace_rows(spark, name, broken)
    assert spark.table(name).count() == 5


def test_synthetic_users(spark):
    users = synthetic.synthetic_users(spark, 500, 3, F.lit("2025-01-01").cast("timestamp_ntz"))
    again = synthetic.synthetic_users(spark, 500, 3, F.lit("2025-01-01").cast("timestamp_ntz"))
    assert sorted(users.collect()) == sorted(again.repartition(3).collect())
    assert users.select("email").distinct().count() == users.select("id").distinct().count() == 500
    assert users.filter("length(phone_number) <> 20").isEmpty()
    assert contracts.validate_contract(users, "user_create", "id")[1].isEmpty()
    assert users.select("role", "signatureStatus", "notifications").distinct().count() == 8


def test_hourly_job(spark, catalog):
    rows = [("P0", 10.0, 1.0, 0), ("P1", 20.0, 1.0, 1), ("P0", 30.0, 2.0, 2)]
    where = frame(spark, rows, "nome string, latitude double, longitude double, ordinal long")
    for _ in range(2):
        etl.air_quality_etl(spark, where, weather_stub, air_stub, catalog)
    stored = spark.table(f"{catalog}bronze.weather_api_data").orderBy("id").collect()
    assert [r.id for r in stored] == [1, 2, 3, 4]
    assert [next(iter(json.loads(r.data))) for r in stored] == ["P1", "P0", "P1", "P0"]
    last = json.loads(stored[1].data)["P0"]
    assert last["latitude"] == 30.0 and last["data"]["temperatura"] == 30
    air = spark.table(f"{catalog}bronze.google_api_data")
    assert air.count() == 4 and json.loads(air.head().data).popitem()[1]["indexes"] == AIR["indexes"]
    for silver_name, bronze_rows in (("silver.weather_api_data", stored), ("silver.google_api_data", air.collect())):
        filled = spark.table(f"{catalog}{silver_name}").orderBy("id").collect()
        assert [r.id for r in filled] == sorted(r.id for r in bronze_rows) and all(r.created_at for r in filled)


def test_hourly_job_refuses_a_bad_document_everywhere(spark, catalog):
    def odd_weather(method, url, params, payload):
        status, body = weather_stub(method, url, params, payload)
        answer = json.loads(body)
        if float(params["lat"]) == 20.0:
            answer["wind"]["speed"] = 12345.6
        return status, json.dumps(answer)

    rows = [("P0", 10.0, 1.0, 0), ("P1", 20.0, 1.0, 1)]
    where = frame(spark, rows, "nome string, latitude double, longitude double, ordinal long")
    etl.air_quality_etl(spark, where, odd_weather, air_stub, catalog)
    bronze, filled = (spark.table(f"{catalog}{x}.weather_api_data").collect() for x in ("bronze", "silver"))
    assert [json.loads(r.data).popitem()[0] for r in bronze] == ["P0"] == [r.bairro for r in filled]
    refused = spark.read.parquet(tables.quarantine_of(spark, f"{catalog}bronze.weather_api_data")).collect()
    assert [r.problems for r in refused] == ["velocidade_vento"]
    assert spark.table(f"{catalog}silver.google_api_data").count() == 2


def test_hourly_job_stops_before_writing(spark, catalog):
    rows = [("P0", 10.0, 1.0, 0), ("Pole", 90.0, 1.0, 1)]
    where = frame(spark, rows, "nome string, latitude double, longitude double, ordinal long")
    with pytest.raises(Exception, match="response status"):
        etl.air_quality_etl(spark, where, weather_stub, air_stub, catalog)
    assert spark.table(f"{catalog}bronze.weather_api_data").isEmpty()


def test_prediction_job(spark):
    def stub(method, url, params, payload):
        return 200, json.dumps({"dt": 1736164800, "timezone": -10800, "name": params["q"]})

    row = etl.prediction_etl(spark, frame(spark, [("Belem",)], "city string"), stub).head()
    assert (row.q, row.dt) == ("Belem", "2025-01-06 09:00:00")


def test_only_the_wanted_arrays_are_read(spark):
    from aerolake.operators import silver

    text = '{"p":{"datetime":"2025-01-01T00:00:00Z","indexes":[{"aqi":5}],"pollutants":["odd",{"code":"co"}]}}'
    rows = frame(spark, [(text,)], "data string")
    for build, there, skipped in ((silver.aq_index_universal, "indexes", "pollutants"), (silver.aq_index_br, "indexes", "pollutants"),
                                  (silver.aq_pollutants_wide, "pollutants", "indexes")):
        shown = plan(build(rows))
        assert there in shown and skipped not in shown
    assert silver.aq_index_universal(rows).head().aqi_universal == 5
    assert silver.aq_pollutants_wide(rows).head().no2_code == "co"


@pytest.mark.parametrize("flag, status, price", [
    ("A", "F", 1234567), ("A\n", "é", 1234567), ('"', "\\", 10), (None, "O", 9), ("R", None, 0), (" ", "O", None)])
def test_documents_as_text_equal_the_json_writer(spark, flag, status, price):
    from aerolake import model
    from aerolake.plans import bindings as b

    rows = spark.createDataFrame([(flag, status, price, 7, 3)],
                                 "l_returnflag string, l_linestatus string, price long, quantity int, l_linenumber int").selectExpr(
        "*", "0.10 AS discount", "0.00 AS tax", "0.35 AS br_green",
        *[f"CAST(price * {i + 1} % 9999999999 AS DECIMAL(18,0)) * 0.0000001 AS p{i}" for i in range(len(model.POLLUTANTS))])
    for position in (0, 1):
        text, want = rows.selectExpr(b._block(position), f"to_json({b._BLOCKS[position]})").head()
        assert text == want
    for i, prefix in enumerate(model.POLLUTANTS):
        text, want = rows.selectExpr(b._pollutant(i, prefix), "to_json(named_struct("
                                     f"'code', '{prefix}', 'displayName', upper('{prefix}'), 'fullName', concat('name of ', '{prefix}'), "
                                     f"'concentration', named_struct('value', p{i}, 'units', 'PARTS_PER_BILLION')))").head()
        assert text == want
