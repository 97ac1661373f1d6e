"""Row contracts: declared fields and rules, checked in one narrow pass.

``check_contract`` adds ``violations`` (array of column and rule) to every row;
``validate_contract`` splits on it. A value is checked in this order and reported
once: present, parses, then its own rules.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions.casts import try_timestamp_ntz
from aerolake.operators.skew import lookup_join

# Accepted forms. A local part is made of letters of any script, digits and
# some marks, with single dots inside; a domain label neither begins nor ends with a hyphen.
_ATOM = r"[\p{L}\p{N}!#$%&'*+/=?^_`{|}~-]+"
_LABEL = r"[\p{L}\p{N}]([\p{L}\p{N}-]*[\p{L}\p{N}])?"
EMAIL_FORM = rf"^(?=.{{1,64}}@){_ATOM}(\.{_ATOM})*@({_LABEL}\.)+[\p{{L}}]{{2,63}}$"
NUMBER_FORM = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"

_PARSED = {"int": "bigint", "float": "double", "decimal": "decimal(38,18)",
           "datetime": "timestamp_ntz", "text": "string"}


class Rule(NamedTuple):
    name: str
    broken: Callable[[Column], Column]  # on the present, parsed value


# --- single rules -------------------------------------------------------------


def check_range(gt=None, ge=None, le=None) -> Rule:
    def broken(value):
        tests = []
        if gt is not None:
            tests.append(value <= gt)
        if ge is not None:
            tests.append(value < ge)
        if le is not None:
            tests.append(value > le)
        out = tests[0]
        for t in tests[1:]:
            out = out | t
        return out

    return Rule("range", broken)


def check_length(least: int = 0, most: int | None = None) -> Rule:
    def broken(value):
        n = F.char_length(value)
        return (n < least) if most is None else (n < least) | (n > most)

    return Rule("length", broken)


def check_digits(digits: int, places: int) -> Rule:
    def broken(value):
        exact = value.try_cast("decimal(38,18)")
        fitted = exact.try_cast(f"decimal({digits},{places})")
        return exact.isNull() | fitted.isNull() | (fitted != exact)

    return Rule("digits", broken)


def check_enum(*allowed: str) -> Rule:
    return Rule("enum", lambda value: ~value.isin(*allowed))


def check_email() -> Rule:
    return Rule("email", lambda value: ~value.rlike(EMAIL_FORM))


def check_type(value: Column, kind: str) -> Column:
    """Violated: there is a value and it does not parse."""
    return value.isNotNull() & _parsed(value.cast("string"), kind).isNull()


def _parsed(text: Column, kind: str) -> Column:
    """The text as a value of ``kind``, NULL where it is none."""
    if kind == "datetime":
        return try_timestamp_ntz(text)
    if kind in ("float", "decimal", "int"):  # a cast alone also takes suffixes as in 1.5d
        text = F.when(text.rlike(NUMBER_FORM), text)
    return text.try_cast(_PARSED[kind])


def check_required(value: Column) -> Column:
    """Violated: no value."""
    return value.isNull()


# --- contracts ----------------------------------------------------------------


class Field(NamedTuple):
    column: str
    kind: str
    rules: tuple[Rule, ...] = ()
    alias: str | None = None  # the outside name
    nullable: bool = False
    optional: bool = False  # the column may be absent


_POSITIVE = check_range(gt=0)
_CREATED = Field("created_at", "datetime", alias="createdAt")
_UPDATED = Field("updated_at", "datetime", alias="updatedAt")
_PHONE = check_length(11, 20)
_PASSWORD = check_length(8, 255)

# Fields, outside names, limits and enumerations.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "place": (
        Field("id", "int", (_POSITIVE,)),
        Field("name", "text", (check_length(1, 100),)),
        Field("latitude", "float", (check_range(ge=-90, le=90),)),
        Field("longitude", "float", (check_range(ge=-180, le=180),)),
        _CREATED, _UPDATED,
    ),
    "data_source": (
        Field("id", "int", (_POSITIVE,)),
        Field("name", "text"),
    ),
    "air_quality": (
        Field("id", "int", (_POSITIVE,)),
        Field("place_id", "int", (_POSITIVE,)),
        Field("source_id", "int", (_POSITIVE,)),
        Field("aqi_universal", "float", (check_range(ge=0),), "aqiUniversal"),
        Field("name_display", "text", (check_length(1),), "nameDisplay"),
        Field("display_value", "text", (check_length(1),), "displayValue"),
        _CREATED,
    ),
    "pollutant": (
        Field("id", "int", (_POSITIVE,)),
        Field("place_id", "int", (_POSITIVE,), "placeId"),
        Field("data_source_id", "int", (_POSITIVE,), "dataSourceId"),
        Field("dominant_pollutant", "text", (check_length(1, 50),), "dominantPollutant"),
        Field("concentration", "float", (check_digits(7, 4),)),
        Field("metric_unit", "text", (check_length(1, 20),), "metricUnit"),
        _CREATED,
    ),
    "sensor": (
        Field("id", "int", (_POSITIVE,)),
        Field("place_id", "int", (_POSITIVE,), "placeId"),
        Field("source_id", "int", (_POSITIVE,), "sourceId"),
        Field("water_level", "float", (check_digits(5, 2),), "waterLevel"),
        Field("water_level_unit", "text", (check_length(1, 20),), "waterLevelUnit"),
        _CREATED,
    ),
    "weather": (
        Field("id", "int"),
        Field("place_id", "int", (_POSITIVE,), "placeId"),
        Field("source_id", "int", (_POSITIVE,), "sourceId"),
        Field("temperature", "float", (check_digits(5, 2),)),
        Field("humidity", "float"),
        Field("wind_speed", "float", (check_digits(4, 2),), "windSpeed"),
        Field("wind_direction", "int", (), "windDirection"),
        _CREATED,
    ),
    "favorite_place": (
        Field("user_id", "int", (_POSITIVE,), "userId"),
        Field("place_id", "int", (_POSITIVE,), "placeId"),
        _CREATED,
        Field("name", "text", nullable=True),
    ),
    "subscription": (
        Field("id", "int"),
        Field("user_id", "text", (check_length(1),), "userId"),
        Field("place_id", "int", (_POSITIVE,), "placeId"),
        Field("start_date", "datetime", alias="startDate"),
        Field("end_date", "datetime", alias="endDate"),
        Field("status", "text", (check_enum(*model.SUBSCRIPTION_STATUSES),)),
        _CREATED, _UPDATED,
    ),
    "subscription_plan": (
        Field("id", "int"),
        Field("name", "text", (check_length(1, 100),)),
        Field("description", "text"),
        Field("days_time_duration", "text", alias="daysTimeDuration"),
        Field("price", "decimal", (_POSITIVE,)),
    ),
    "message": (
        Field("to", "text", (check_length(10, 15),)),
        Field("place", "text", (check_length(1),)),
        Field("floor", "text", (check_length(1),)),
    ),
    "user_create": (
        Field("id", "text"),
        Field("name", "text", (check_length(1, 100),)),
        Field("email", "text", (check_email(),)),
        Field("signatureStatus", "text", (check_enum(*model.SIGNATURE_STATUSES),), nullable=True),
        Field("phone_number", "text", (_PHONE,), "phoneNumber"),
        Field("role", "text", (check_enum(*model.ROLES),), nullable=True),
        Field("notifications", "text", (check_enum(*model.NOTIFICATIONS),), nullable=True),
        Field("password", "text", (_PASSWORD,)),
    ),
    "user_update": (
        Field("name", "text", nullable=True, optional=True),
        Field("email", "text", (check_email(),), nullable=True, optional=True),
        Field("phone_number", "text", (_PHONE,), "phoneNumber", True, True),
        Field("password", "text", (_PASSWORD,), None, True, True),
        Field("signatureStatus", "text", (check_enum(*model.SIGNATURE_STATUSES),), None, True, True),
        Field("role", "text", (check_enum(*model.ROLES),), None, True, True),
        Field("notifications", "text", (check_enum(*model.NOTIFICATIONS),), None, True, True),
    ),
}

# Outside names of the stored user for readers; id and password stay inside.
PUBLIC_USER = (
    ("name", "name"), ("email", "email"), ("signatureStatus", "signatureStatus"),
    ("phone_number", "phoneNumber"), ("role", "role"), ("notifications", "notifications"),
    ("created_at", "createdAt"), ("updated_at", "updatedAt"),
)


def public_user_view(users: DataFrame) -> DataFrame:
    return users.select(*[F.col(inner).alias(outer) for inner, outer in PUBLIC_USER])


def contract_rename(df: DataFrame, contract: str, outward: bool = True) -> DataFrame:
    """Stored names to outside names, or back. Names without an alias stay, and a
    column that already has the wanted name stays too."""
    pairs = {f.column: f.alias for f in CONTRACTS[contract] if f.alias}
    if not outward:
        pairs = {alias: column for column, alias in pairs.items()}
    return df.withColumnsRenamed({k: v for k, v in pairs.items() if k in df.columns})


def _present(df: DataFrame, field: Field) -> str | None:
    """The name under which the field is there: its outside name, else its own."""
    return next((n for n in (field.alias, field.column) if n and n in df.columns), None)


def _field_checks(df: DataFrame, field: Field) -> list[Column]:
    def report(rule: str) -> Column:
        return F.struct(F.lit(field.column).alias("column"), F.lit(rule).alias("rule"))

    name = _present(df, field)
    if name is None:
        return [] if field.optional else [report("required")]
    raw = F.col(f"`{name}`")
    checks = []
    if not field.nullable:
        checks.append(F.when(check_required(raw), report("required")))
    stored = dict(df.dtypes)[name]
    value = raw
    if field.kind != "text":
        value = _parsed(raw, field.kind) if stored == "string" else raw.try_cast(_PARSED[field.kind])
        if stored == "string":
            checks.append(F.when(check_type(raw, field.kind), report("type")))
        elif field.kind == "int" and stored not in ("tinyint", "smallint", "int", "bigint"):
            whole = F.coalesce(value.cast(stored) == raw, F.lit(False))
            checks.append(F.when(raw.isNotNull() & ~whole, report("type")))
            value = F.when(whole, value)
    for rule in field.rules:
        broken = value.isNotNull() & rule.broken(value)
        checks.append(F.when(broken, report(rule.name)))
    return checks


def check_contract(df: DataFrame, contract: str | tuple[Field, ...]) -> DataFrame:
    fields = CONTRACTS[contract] if isinstance(contract, str) else contract
    checks = [c for field in fields for c in _field_checks(df, field)]
    found = F.array_compact(F.array(*checks)).cast("array<struct<column:string,rule:string>>")
    return df.withColumn("violations", found)


def validate_contract(df: DataFrame, contract: str | tuple[Field, ...],
                      key: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, violations ``key, column, rule``)."""
    checked = check_contract(df, contract)
    valid = checked.filter(F.size("violations") == 0).drop("violations")
    return valid, violations(checked, key)


def violations(checked: DataFrame, key: str) -> DataFrame:
    return checked.select(F.col(key), F.inline("violations"))


def check_not_null(df: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    """``key, column, rule`` for every missing value in columns that need one."""
    checks = [
        F.when(F.col(c).isNull(),
               F.struct(F.lit(c).alias("column"), F.lit("not_null").alias("rule")))
        for c in columns
    ]
    return df.select(F.col(key), F.inline(F.array_compact(F.array(*checks))))


def check_unique(df: DataFrame, column: str, key: str) -> DataFrame:
    """``key, column, rule`` for every row whose value occurs more than once.
    Counts merge map-side; hot values then meet their rows by broadcast."""
    repeated = df.groupBy(column).agg(F.count("*").alias("_n")).filter("_n > 1").select(column)
    hits = lookup_join(df.select(key, column), repeated, column, "left_semi")
    return hits.select(key, F.lit(column).alias("column"), F.lit("unique").alias("rule"))
