"""Responses to bronze documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions.documents import (
    epoch_to_local_text, json_members, json_object, json_scalar, json_string, whole_json, wrap_document,
)
from aerolake.sources.places import plain_number


def error_class(status: Column) -> Column:
    """Class of a failed response; NULL for a good one."""
    return (
        F.when(status < 400, F.lit(None).cast("string"))
        .when(status.isNull(), "unexpected")  # no answer at all
        .when(status == 404, "not_found")
        .when(status == 400, "bad_request")
        .otherwise("unexpected")
    )


def ok_responses(responses: DataFrame, mode: str = "divert"):
    """``divert``: (good, failed with their class). ``strict``: good rows, and
    the first failed one stops the query."""
    failed = F.coalesce(F.col("status") >= 400, F.lit(True))
    if mode == "strict":
        message = F.concat_ws(" ", F.lit("response status"), F.col("status").cast("string"))
        # As a filter: a column that nobody reads would be pruned with its check.
        return responses.filter(F.when(failed, F.raise_error(message)).otherwise(F.lit(True)))
    good = responses.filter(~failed)
    bad = responses.filter(failed).withColumn("error_class", error_class(F.col("status")))
    return good, bad


def tag_response(responses: DataFrame) -> DataFrame:
    """The body with its place and, where the request had them, coordinates."""
    tags = [c for c in ("nome", "latitude", "longitude") if c in responses.columns]
    rest = [c for c in ("status", "ordinal") if c in responses.columns]
    return responses.select(*tags, *rest, "body")


def _last_member(members: Column, key: str) -> Column:
    """The last value of a key (a repeated JSON key counts once, by its last)."""
    hits = F.filter(F.map_entries(members), lambda e: e["key"] == key)
    return F.get(hits, F.size(hits) - 1)["value"]


def _member_or_empty(members: Column, key: str) -> Column:
    """JSON text of the last member of that name; ``{}`` only when the key is absent."""
    hits = F.filter(members, lambda m: m["key"] == key)
    return F.coalesce(F.get(hits, F.size(hits) - 1)["json"], F.lit("{}"))


def air_quality_reshape(responses: DataFrame, body: str = "body") -> DataFrame:
    """Keep three members of the body, as one document in JSON text (``doc``)."""
    others = [c for c in responses.columns if c not in (body, "status")]
    parsed = responses.select(*others, json_members(F.col(body)).alias("_members"))
    members = F.coalesce(
        F.col("_members"), F.raise_error(F.lit("air-quality body is no JSON object"))
    )
    checked = parsed.select(*others, members.alias("_members"))
    document = json_object({
        "datetime": _member_or_empty(F.col("_members"), "dateTime"),
        "indexes": _member_or_empty(F.col("_members"), "indexes"),
        "pollutants": _member_or_empty(F.col("_members"), "pollutants"),
    })
    return checked.select(*others, document.alias("doc"))


def first_element(array: Column, mode: str = "strict") -> Column:
    """First array element. An empty or missing array is an error, or NULL when
    ``mode`` is not strict."""
    first = F.get(array, F.lit(0))
    if mode != "strict":
        return first
    return F.when(
        F.coalesce(F.size(array), F.lit(0)) < 1, F.raise_error(F.lit("array has no first element"))
    ).otherwise(first)


def weather_flatten(responses: DataFrame, body: str = "body", mode: str = "strict") -> DataFrame:
    """Nine nested members under flat names, as text.

    All nine must be present (a null value is present). ``strict`` stops the
    query on a missing one; ``checked`` adds the ``missing`` names.
    """
    others = [c for c in responses.columns if c not in (body, "status")]
    parsed = responses.select(
        *others, body, whole_json(F.col(body), model.WEATHER_RESPONSE).alias("_r")
    )
    blocks = {
        "main": F.col("_r.main"),
        "wind": F.col("_r.wind"),
        "sys": F.col("_r.sys"),
        "weather": first_element(F.col("_r.weather"), "tolerant"),
    }

    def present(block, key):
        return F.coalesce(F.array_contains(F.map_keys(blocks[block]), key), F.lit(False))

    values = {
        name: _last_member(blocks[block], key) for block, key, name in model.WEATHER_FIELDS
    }
    if mode == "strict":
        columns = [
            F.when(~present(block, key),
                   F.raise_error(F.concat(F.lit(f"response without {block}.{key}: "), F.col(body))))
            .otherwise(values[name]).alias(name)
            for block, key, name in model.WEATHER_FIELDS
        ]
        return parsed.select(*others, *columns)
    missing = F.array_compact(F.array(*[
        F.when(~present(block, key), F.lit(f"{block}.{key}"))
        for block, key, _ in model.WEATHER_FIELDS
    ]))
    return parsed.select(
        *others, body, *[v.alias(n) for n, v in values.items()], missing.alias("missing")
    )


def weather_document(flat: DataFrame) -> DataFrame:
    """Flat weather rows as documents in JSON text (``doc``)."""
    fields = [name for _, _, name in model.WEATHER_FIELDS]
    data = json_object({
        f: F.coalesce(json_string(F.col(f)), F.lit("null")) if f == "descricao" else json_scalar(F.col(f))
        for f in fields
    })
    document = json_object({
        "latitude": F.coalesce(plain_number(F.col("latitude")), F.lit("null")),
        "longitude": F.coalesce(plain_number(F.col("longitude")), F.lit("null")),
        "data": data,
    })
    others = [c for c in flat.columns if c not in (*fields, "latitude", "longitude")]
    return flat.select(*others, document.alias("doc"))


def latest_per_place(rows: DataFrame, place: str, ordinal: str) -> DataFrame:
    """One row per place, the last by ordinal (unique within the batch).

    One aggregation, merged before the only shuffle: a place with a third of all rows is
    one row per task there, and documents that are not the last of their task never move.
    (Finding the last ordinals first and joining them back took 1.5 to 1.9 times as long,
    on 1500 places and on 500, with broadcasts and without.)
    """
    rest = [c for c in rows.columns if c != place]
    last = rows.groupBy(place).agg(F.max_by(F.struct(*rest), ordinal).alias("_last")).filter("_last IS NOT NULL")
    return last.select(*[F.col(c) if c == place else F.col("_last")[c].alias(c) for c in rows.columns])


def dict_to_rows(df: DataFrame, column: str = "data") -> DataFrame:
    """``{place: doc, ...}`` text to one ``place, doc`` row per place; ``doc``
    is JSON text."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.inline(json_members(F.col(column))).alias("place", "doc"))


def wrap_documents(rows: DataFrame, place: str = "nome", document: str = "doc") -> DataFrame:
    """Rows ready for bronze: ``data`` = ``{place: doc}``."""
    others = [c for c in rows.columns if c not in (place, document)]
    return rows.select(*others, wrap_document(F.col(place), F.col(document)).alias("data"))


def city_local_time(responses: DataFrame, body: str = "body") -> DataFrame:
    """The body with ``dt`` replaced by local time text; all else passes through."""
    parsed = responses.withColumn("_m", json_members(F.col(body)))

    def number(key: str) -> Column:
        hits = F.filter("_m", lambda m: m["key"] == key)
        return F.get(hits, F.size(hits) - 1)["json"].cast("bigint")

    local = epoch_to_local_text(number("dt"), number("timezone"))
    members = F.transform("_m", lambda m: F.concat(
        json_string(m["key"]), F.lit(":"), F.when(m["key"] == "dt", json_string(local)).otherwise(m["json"])))
    text = F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))
    return parsed.withColumn(body, text).withColumn("dt", local).drop("_m")
