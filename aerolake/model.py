"""Document shapes, column maps and table layouts (fixed values)."""

from __future__ import annotations

from typing import NamedTuple


class Leaf(NamedTuple):
    """A value below the document body, its column and its conversion."""

    path: str
    column: str
    kind: str


# --- document shapes: every leaf is read as text and converted afterwards ----

AIR_ARRAYS = {
    "indexes": "struct<code:string,displayName:string,aqi:string,aqiDisplay:string,"
    "color:struct<red:string,green:string,blue:string>,category:string,dominantPollutant:string>",
    "pollutants": "struct<code:string,displayName:string,fullName:string,"
    "concentration:struct<value:string,units:string>>",
}



def air_body(*arrays: str) -> str:
    """The shape of an air-quality document as far as it is read: its time and these arrays."""
    return "struct<" + ",".join(["datetime:string", *[f"{name}:array<{AIR_ARRAYS[name]}>" for name in arrays]]) + ">"


AIR_BODY = air_body(*AIR_ARRAYS)

WEATHER_BODY = (
    "struct<latitude:string,longitude:string,"
    "data:struct<temperatura:string,sensacao_termica:string,umidade:string,pressao:string,"
    "velocidade_vento:string,direcao_vento:string,descricao:string,nascer_sol:string,por_sol:string>>"
)

# Maps keep the difference between an absent key and a null value.
WEATHER_RESPONSE = (
    "struct<main:map<string,string>,wind:map<string,string>,"
    "weather:array<map<string,string>>,sys:map<string,string>>"
)

# --- weather response fields: (block, key) -> flat name ----------------------

WEATHER_FIELDS = (
    ("main", "temp", "temperatura"),
    ("main", "feels_like", "sensacao_termica"),
    ("main", "humidity", "umidade"),
    ("main", "pressure", "pressao"),
    ("wind", "speed", "velocidade_vento"),
    ("wind", "deg", "direcao_vento"),
    ("weather", "description", "descricao"),
    ("sys", "sunrise", "nascer_sol"),
    ("sys", "sunset", "por_sol"),
)

# --- silver column maps -------------------------------------------------------

UNIVERSAL_INDEX = (
    Leaf("aqi", "aqi_universal", "int"),
    Leaf("code", "codigo_universal", "varchar(4)"),
    Leaf("color.red", "cor_vermelho_universal", "decimal(9,8)"),
    Leaf("color.blue", "cor_azul_universal", "decimal(9,8)"),
    Leaf("color.green", "cor_verde_universal", "decimal(9,8)"),
    Leaf("category", "categoria_universal", "varchar(50)"),
    Leaf("aqiDisplay", "valor_display_universal", "int"),
    Leaf("displayName", "nome_display_universal", "varchar(20)"),
    Leaf("dominantPollutant", "poluente_dominante_universal", "varchar(10)"),
)

BR_INDEX = (
    Leaf("aqi", "aqi_br", "int"),
    Leaf("code", "codigo_br", "varchar(20)"),
    Leaf("color.green", "cor_br", "decimal(2,1)"),
    Leaf("category", "categoria_br", "varchar(20)"),
    Leaf("aqiDisplay", "valor_display_br", "int"),
    Leaf("displayName", "nome_display_br", "varchar(20)"),
    Leaf("dominantPollutant", "poluente_dominante_br", "varchar(10)"),
)

POLLUTANTS = ("co", "no2", "o3", "pm10", "pm25", "so2")


def pollutant_leaves(prefix: str) -> tuple[Leaf, ...]:
    name_width = 20 if prefix == "co" else 50
    return (
        Leaf("code", f"{prefix}_code", "varchar(10)"),
        Leaf("fullName", f"{prefix}_nome", f"varchar({name_width})"),
        Leaf("displayName", f"{prefix}_display_nome", "varchar(10)"),
        Leaf("concentration.units", f"{prefix}_concentracao_unidade", "varchar(30)"),
        Leaf("concentration.value", f"{prefix}_valor", "decimal(10,6)"),
    )


AIR_HEAD = (
    Leaf("body.datetime", "data_medicao", "timestamp"),
    Leaf("root", "regiao", "varchar(20)"),
)

WEATHER_LEAVES = (
    Leaf("root", "bairro", "varchar(100)"),
    Leaf("body.latitude", "latitude", "decimal(10,7)"),
    Leaf("body.longitude", "longitude", "decimal(10,7)"),
    Leaf("body.data.temperatura", "temperatura", "decimal(5,2)"),
    Leaf("body.data.sensacao_termica", "sensacao_termica", "decimal(5,2)"),
    Leaf("body.data.umidade", "umidade", "rounded int"),
    Leaf("body.data.pressao", "pressao", "rounded int"),
    Leaf("body.data.velocidade_vento", "velocidade_vento", "decimal(4,2)"),
    Leaf("body.data.direcao_vento", "direcao_vento", "rounded int"),
    Leaf("body.data.descricao", "descricao", "varchar(100)"),
    Leaf("body.data.nascer_sol", "nascer_sol", "rounded bigint"),
    Leaf("body.data.por_sol", "por_sol", "rounded bigint"),
)


def air_columns() -> tuple[Leaf, ...]:
    """All 48 filled air-quality columns in table order."""
    wide = tuple(leaf for p in POLLUTANTS for leaf in pollutant_leaves(p))
    return AIR_HEAD + UNIVERSAL_INDEX + BR_INDEX + wide


# --- stored tables ------------------------------------------------------------

_SQL_TYPES = {"timestamp": "TIMESTAMP_NTZ", "rounded int": "INT", "rounded bigint": "BIGINT"}


def sql_type(kind: str) -> str:
    return _SQL_TYPES.get(kind, kind.upper())


def silver_ddl(leaves: tuple[Leaf, ...]) -> str:
    middle = ", ".join(f"{leaf.column} {sql_type(leaf.kind)}" for leaf in leaves)
    return f"id BIGINT, {middle}, created_at TIMESTAMP_NTZ"


BRONZE_DDL = "id BIGINT, data STRING"

USER_NAME_WIDTH = 100
USERS_DDL = (
    f"id STRING, name VARCHAR({USER_NAME_WIDTH}), email STRING, password VARCHAR(255), "
    "signatureStatus STRING, phone_number VARCHAR(20), role STRING, notifications STRING, "
    "created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ"
)

USER_COLUMNS = (
    "id", "name", "email", "password", "signatureStatus", "phone_number",
    "role", "notifications", "created_at", "updated_at",
)
USER_NOT_NULL = ("id", "name", "email", "password", "phone_number", "created_at")

# Fields a change request may carry (the id and both stamps are the table's own).
USER_FIELDS = (
    "name", "email", "phone_number", "password", "signatureStatus", "role", "notifications",
)

# --- enumerations -------------------------------------------------------------

ROLES = ("admin", "user")
NOTIFICATIONS = ("yes", "no")
SIGNATURE_STATUSES = ("active", "inactive")
SUBSCRIPTION_STATUSES = (
    "active", "inactive", "cancelled", "expired", "pending",
    "suspended", "refunded", "failed", "disputed",
)
