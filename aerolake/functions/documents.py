"""JSON documents as text: reading the root entry, writing values back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# JSON knows double quotes only.
STRICT = {"allowSingleQuotes": "false"}


def whole_json(text: Column, shape: str) -> Column:
    """The text parsed as ``shape``; NULL unless it is one JSON value and nothing else.

    The parser stops after the first value. Inside a list with an object behind it,
    anything that follows the value breaks the list or changes its length. (The
    filter reads the parsed list once; a condition would parse once more.)
    """
    both = F.from_json(F.concat(F.lit("["), text, F.lit(",{}]")), f"array<{shape}>", STRICT)
    return F.get(F.get(F.filter(F.array(both), lambda b: F.size(b) == 2), F.lit(0)), F.lit(0))


def json_members(text: Column) -> Column:
    """The members of a JSON object, in order, as ``key`` and ``json``, the value in JSON text.

    The captured text of a value does not tell ``"0"`` from ``0``; its parsed type does.
    NULL when the text is no JSON object.
    """
    texts = F.map_entries(whole_json(text, "map<string,string>"))
    types = F.map_entries(whole_json(text, "map<string,variant>"))

    def member(both: Column) -> Column:
        value, parsed = both["0"]["value"], both["1"]["value"]
        # The schema of a list or object names all that is in it; that it is one can be told from its outside.
        nested = F.when(value.startswith("["), F.try_variant_get(parsed, "$", "array<variant>").isNotNull()).when(
            value.startswith("{"), F.try_variant_get(parsed, "$", "map<string,variant>").isNotNull()).otherwise(False)
        return F.struct(both["0"]["key"].alias("key"), F.when(value.isNull(), F.lit("null")).when(nested, value)
                        .when(F.schema_of_variant(parsed) == "STRING", json_string(value)).otherwise(value).alias("json"))

    return F.transform(F.arrays_zip(texts, types), member)


def parse_document(data: Column, body: str) -> Column:
    """``{place: body}`` as a map. NULL when the text is no JSON object.

    The typed parse covers every regular document. Only when it gives up
    (some value is not an object) are the keys read first and the values one by
    one, so a scalar value costs its own fields and not the whole document.
    """
    typed = whole_json(data, f"map<string,{body}>")
    by_value = F.transform_values(
        whole_json(data, "map<string,string>"), lambda _, v: F.from_json(v, body, STRICT)
    )
    return F.coalesce(typed, by_value)


def root_entry(entries: Column) -> Column:
    """The first entry of an object in stored-object order: shorter keys first,
    then by bytes; of a repeated key the last one counts."""
    ranked = F.transform(
        F.map_entries(entries),
        lambda e, i: F.struct(
            F.octet_length(e["key"]).alias("width"),
            e["key"].alias("root"),
            (-i).alias("turn"),
            e["value"].alias("body"),
        ),
    )
    return F.array_min(ranked)


def root_key(data: Column) -> Column:
    # Values that are objects are passed over; only when some are not is every value read as text.
    objects = F.map_keys(whole_json(data, "map<string,struct<_:struct<_:string>>>"))
    keys = F.coalesce(objects, F.map_keys(whole_json(data, "map<string,string>")))
    ranked = F.transform(
        keys, lambda k: F.struct(F.octet_length(k).alias("width"), k.alias("root"))
    )
    return F.array_min(ranked)["root"]


def element_by_element(data: Column, root: Column, name: str, element: str) -> Column:
    """An array below the root entry, each element parsed by itself. One that is
    no object becomes NULL here; in the typed parse the whole array would."""
    texts = F.try_element_at(whole_json(data, f"map<string,struct<{name}:array<string>>>"), root)
    return F.transform(texts[name], lambda text: F.from_json(text, element, STRICT))


def open_documents(bronze: DataFrame, body: str, keep: tuple[str, ...] = (),
                   strict: bool = False, arrays: dict[str, str] | None = None) -> DataFrame:
    """One row per document: ``root``, ``body`` and ``unreadable``; the last one
    stops the query when ``strict``. ``arrays`` names the body's arrays and their
    element types; one that the typed parse left NULL is read by element.

    The entry is produced by a generator on purpose. A filter on anything that
    was read from the document then stays above the parse; below it, Catalyst
    would repeat the parse inside the filter for every column mentioned.
    """
    parsed = bronze.select(*keep, "data", parse_document(F.col("data"), body).alias("_doc"))
    unreadable = F.col("_doc").isNull() & F.col("data").isNotNull()
    if strict:
        stop = F.raise_error(F.concat(F.lit("no JSON object: "), F.col("data")))
        unreadable = F.when(unreadable, stop).otherwise(F.lit(False))
    found = parsed.select(
        *keep, "data", unreadable.alias("unreadable"), root_entry(F.col("_doc")).alias("_entry")
    )
    root, content = F.col("_entry.root"), F.col("_entry.body")
    for name, element in (arrays or {}).items():
        spare = element_by_element(F.col("data"), root, name, element)
        content = content.withField(name, F.coalesce(F.col("_entry.body")[name], spare))
    row = F.struct(
        F.when(~F.col("unreadable"), root).alias("root"),
        F.when(~F.col("unreadable"), content).alias("body"),
        F.col("unreadable"),
    )
    return found.select(*keep, "data", F.inline(F.array(row)))


def path_text(body: Column, path: str) -> Column:
    """Text at a dotted path; digits are array positions. A missing step is NULL."""
    for step in path.split("."):
        body = F.get(body, F.lit(int(step))) if step.isdigit() else body[step]
    return body


def json_string(text: Column) -> Column:
    """A quoted JSON string."""
    boxed = F.to_json(F.array(text))
    return F.substr(boxed, F.lit(2), F.char_length(boxed) - 2)


# Fixed value: the JSON number grammar.
JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def json_scalar(text: Column) -> Column:
    """JSON of a plain value in text: numbers stay numbers, NULL is null, all else is quoted."""
    return F.when(text.isNull(), F.lit("null")).when(text.rlike(JSON_NUMBER), text).otherwise(json_string(text))


def json_object(members: dict[str, Column]) -> Column:
    """An object from JSON-text members, in order; no member is dropped."""
    parts = []
    for position, (name, value) in enumerate(members.items()):
        parts += [F.lit(("," if position else "{") + f'"{name}":'), value]
    return F.concat(*parts, F.lit("}"))


def wrap_document(place: Column, document: Column) -> Column:
    """``{place: document}`` from a name and a document in JSON text."""
    return F.concat(F.lit("{"), json_string(place), F.lit(":"), document, F.lit("}"))


def epoch_to_local_text(seconds: Column, offset: Column) -> Column:
    """Epoch seconds moved by an offset in seconds, as ``yyyy-MM-dd HH:mm:ss``.

    Counted from a zone-free origin and printed by a cast: ``date_format`` would
    go through the session zone and its missing hours.
    """
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    moved = origin + F.make_dt_interval(secs=(seconds + offset).cast("decimal(18,6)"))
    return F.substring(moved.cast("string"), 1, 19)


def name_based_uuid(*parts: Column) -> Column:
    """A uuid computed from a name, equal on every retry."""
    h = F.md5(F.concat_ws("\x1f", *[p.cast("string") for p in parts]))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(h, start, size) for start, size in cuts])
