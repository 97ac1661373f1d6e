"""Keyed changes on the user table.

Every operator takes the users (unique ``email``, unique ``id``) and a batch of
requests ``ordinal bigint, op string, email string, changes map<string,string>``
and returns the users afterwards and the requests with an ``outcome``:
``ok``, ``not_found``, ``conflict``, ``no_fields`` or ``rejected``. Ordinals are
distinct, not negative, and give the order in which one-at-a-time requests would
have run. In ``changes`` an absent key means "leave", a NULL value "set to null";
a field may have its stored or its outside name (of both the outside one counts), and
unknown keys count for nothing. A request that breaks its contract is ``rejected``
before anything is looked up.

``insert_if_absent``, ``partial_update`` and ``delete_by_email`` each take a batch
of one kind; ``apply_changes`` takes any mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions.documents import name_based_uuid
from aerolake.operators import moves
from aerolake.operators.contracts import CONTRACTS
from aerolake.operators.skew import hot_keys, lookup_join
from aerolake.session import shared_folder

CHANGEABLE = model.USER_FIELDS
_NOT_NULL = tuple(c for c in model.USER_NOT_NULL if c in CHANGEABLE)

# HTTP classes a service would answer with (fixed values).
OUTCOME_STATUS = {"ok": 200, "not_found": 404, "conflict": 409, "no_fields": 422, "rejected": 422}


def _sets(field: str) -> Column:
    return F.map_contains_key("changes", F.lit(field))


def _value(field: str) -> Column:
    return F.try_element_at("changes", F.lit(field))


def new_email() -> Column:
    """The address an update moves to; NULL when it keeps its address."""
    wanted = _value("email")
    return F.when((wanted != "") & (wanted != F.col("email")), wanted)


def has_fields() -> Column:
    return F.coalesce(F.size(F.map_keys("changes")), F.lit(0)) > 0


def breaks_not_null() -> Column:
    """An update that would store no value where the table needs one."""
    broken = F.lit(False)
    for field in _NOT_NULL:
        broken = broken | (_sets(field) & _value(field).isNull())
    return F.coalesce(broken, F.lit(False))


def _renamed(changes: Column, old: str, new: str) -> Column:
    """The key ``old`` as ``new``, in place of a ``new`` that is there too."""
    alone = F.map_filter(changes, lambda k, _: k != new)
    named = F.transform_keys(alone, lambda k, _: F.when(k == old, new).otherwise(k))
    return F.when(F.map_contains_key(changes, F.lit(old)), named).otherwise(changes)


def known_changes(requests: DataFrame) -> DataFrame:
    """The requests with only the known fields in ``changes``, by their stored names."""
    outside = {f.alias: f.column for f in CONTRACTS["user_update"] if f.alias}
    known = F.map_filter("changes", lambda k, _: k.isin(*CHANGEABLE, *outside))
    for alias, column in outside.items():
        known = _renamed(known, alias, column)
    return requests.withColumn("changes", known)


def breaks_contract(op: Column) -> Column:
    """An insert without a needed value, or a value against its field's rules. (A field
    that may be null may also be left out of an insert.)"""
    insert, update = F.lit(False), F.char_length(_value("name")) > model.USER_NAME_WIDTH
    for field in CONTRACTS["user_create"]:
        if field.column in CHANGEABLE:
            value = F.col("email") if field.column == "email" else _value(field.column)
            if not field.nullable:
                insert = insert | value.isNull()
            for rule in field.rules:
                insert = insert | F.coalesce(rule.broken(value), F.lit(False))
    update = F.coalesce(update, F.lit(False))
    for field in CONTRACTS["user_update"]:
        for rule in field.rules:
            update = update | F.coalesce(rule.broken(_value(field.column)), F.lit(False))
    return F.coalesce(F.when(op == "insert", insert).when(op == "update", update), F.lit(False))


def _split(requests: DataFrame, op: Column) -> tuple[DataFrame, DataFrame]:
    """(requests that keep their contract, the others as rejected)"""
    known = known_changes(requests)
    broken = breaks_contract(op)
    return known.filter(~broken), known.filter(broken).withColumn("outcome", F.lit("rejected"))


def request_outcome(op: Column, found: Column, taken: Column, fields: Column,
                    rejected: Column) -> Column:
    """Outcome from what is known about a request, in the order of the checks."""
    insert = F.when(found, "conflict").otherwise("ok")
    delete = F.when(found, "ok").otherwise("not_found")
    update = (
        F.when(~found, "not_found")
        .when(taken, "conflict")
        .when(~fields, "no_fields")
        .when(rejected, "rejected")
        .otherwise("ok")
    )
    return F.when(op == "insert", insert).when(op == "delete", delete).when(op == "update", update)


def outcome_status(outcome: Column) -> Column:
    pairs = [F.lit(x) for pair in OUTCOME_STATUS.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), outcome)


def inserted_rows(requests: DataFrame, now: Column, salt: str = "user",
                  extra: tuple[str, ...] = ()) -> DataFrame:
    """User rows of insert requests. The id is new: one in the request is ignored."""
    values = {f: _value(f) for f in CHANGEABLE}
    values["email"] = F.col("email")
    values["id"] = default_uuid(F.lit(salt), F.col("email"), F.col("ordinal"))
    values["created_at"] = now.cast("timestamp_ntz")
    values["updated_at"] = F.lit(None).cast("timestamp_ntz")
    return requests.select(*[values[c].alias(c) for c in model.USER_COLUMNS], *extra)


def default_uuid(*name: Column) -> Column:
    """A new id: computed from a name when given (equal on every retry), else random."""
    return name_based_uuid(*name) if name else F.uuid()


# --- batches of one kind ------------------------------------------------------


def _first_per_email(requests: DataFrame) -> DataFrame:
    return requests.groupBy("email").agg(F.min("ordinal").alias("ordinal"))


def _mark(requests: DataFrame, winners: DataFrame, otherwise: str) -> DataFrame:
    # (email, ordinal) is unique on both sides: a hot e-mail spreads out.
    marked = requests.join(winners.withColumn("_won", F.lit(True)), ["email", "ordinal"], "left")
    outcome = F.when(F.col("_won"), "ok").otherwise(otherwise)
    return marked.withColumn("outcome", outcome).drop("_won")


def insert_if_absent(users: DataFrame, requests: DataFrame, now: Column,
                     salt: str = "user") -> tuple[DataFrame, DataFrame]:
    """Of the valid inserts for one e-mail the first wins, unless the e-mail exists."""
    requests, refused = _split(requests, F.lit("insert"))
    winners = _first_per_email(requests).join(users.select("email"), "email", "left_anti")
    judged = _mark(requests, winners, "conflict")
    added = inserted_rows(judged.filter(F.col("outcome") == "ok"), now, salt)
    return users.unionByName(added), judged.unionByName(refused)


def delete_by_email(users: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(remaining users, deleted users, requests with outcome). Of the deletes
    for one e-mail the first finds the row."""
    first = _first_per_email(requests)
    judged = _mark(requests, first.join(users.select("email"), "email", "left_semi"), "not_found")
    remaining = users.join(first.select("email"), "email", "left_anti")
    deleted = users.join(first.select("email"), "email", "left_semi")
    return remaining, deleted, judged


def email_change_conflict(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Each update request with ``new_email`` and ``taken``: whether that address
    differs from its own and belongs to a row of ``users``."""
    wanted = requests.withColumn("new_email", new_email())
    owners = users.select(F.col("email").alias("new_email"), F.lit(True).alias("_owned"))
    met = lookup_join(wanted, owners, "new_email", "left")
    return met.withColumn("taken", F.coalesce("_owned", F.lit(False))).drop("_owned")


def judge_updates(users: DataFrame, requests: DataFrame) -> DataFrame:
    """Outcome of each update request taken on its own against ``users``."""
    requests, refused = _split(requests, F.lit("update"))
    met = lookup_join(
        email_change_conflict(users, requests),
        users.select("email", F.lit(True).alias("_there")), "email", "left",
        hot=hot_keys(requests, "email"),
    )
    found = F.coalesce("_there", F.lit(False))
    outcome = request_outcome(
        F.lit("update"), found, F.col("taken"), has_fields(), breaks_not_null()
    )
    return met.withColumn("outcome", outcome).drop("_there").unionByName(refused, allowMissingColumns=True)


def fold_changes(requests: DataFrame, key: str) -> DataFrame:
    """All changes of a key in one row: per field the last value set, and enough
    to tell whether any of the set values differed from a given one. Merged
    map-side, so a hot key is one row per task when it is shuffled."""
    aggregates = []
    for field in CHANGEABLE:
        at = F.when(_sets(field), F.col("ordinal"))
        aggregates += [
            F.max_by(F.struct(_value(field).alias("v")), at).alias(f"{field}_last"),
            F.min(_value(field)).alias(f"{field}_low"),
            F.max(_value(field)).alias(f"{field}_high"),
            F.count_if(_sets(field) & _value(field).isNull()).alias(f"{field}_nulls"),
        ]
    return requests.groupBy(key).agg(*aggregates)


def _differs(field: str, base: Column) -> Column:
    """Whether some value set for the field differs from ``base``."""
    low, high, nulls = (F.col(f"{field}_{x}") for x in ("low", "high", "nulls"))
    against_null = low.isNotNull()
    against_value = (nulls > 0) | (low != base) | (high != base)
    return F.coalesce(F.when(base.isNull(), against_null).otherwise(against_value), F.lit(False))


def touch_updated_at(touched: Column, now: Column, old: Column) -> Column:
    """The stamp moves only when a stored value really changed."""
    return F.when(touched, now.cast("timestamp_ntz")).otherwise(old)


def apply_fold(rows: DataFrame, now: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    """User rows that were left-joined with ``fold_changes``, changed."""
    touched = F.lit(False)
    values = {c: F.col(c) for c in model.USER_COLUMNS}
    for field in CHANGEABLE:
        last = F.col(f"{field}_last")
        values[field] = F.when(last.isNotNull(), last["v"]).otherwise(F.col(field))
        touched = touched | (last.isNotNull() & _differs(field, F.col(field)))
    values["updated_at"] = touch_updated_at(touched, now, F.col("updated_at"))
    return rows.select(*[values[c].alias(c) for c in model.USER_COLUMNS], *extra)


def partial_update(users: DataFrame, requests: DataFrame,
                   now: Column) -> tuple[DataFrame, DataFrame]:
    """Change only the fields that are set; several requests for one e-mail fold
    in ordinal order. A batch with e-mail moves belongs to ``apply_changes`` and
    stops here with an error."""
    requests, refused = _split(requests, F.lit("update"))
    moving = new_email().isNotNull()
    stays = F.when(
        moving, F.raise_error(F.lit("a change of e-mail needs apply_changes"))
    ).otherwise(F.col("email"))
    checked = requests.withColumn("email", stays)
    met = lookup_join(
        checked, users.select("email", F.lit(True).alias("_there")), "email", "left"
    )
    outcome = request_outcome(
        F.lit("update"), F.coalesce("_there", F.lit(False)), F.lit(False),
        has_fields(), breaks_not_null(),
    )
    judged = met.withColumn("outcome", outcome).drop("_there")
    # Requests for unknown e-mails fold to rows that meet no user.
    effective = checked.filter(has_fields() & ~breaks_not_null())
    folded = fold_changes(effective, "email")
    return apply_fold(users.join(folded, "email", "left"), now), judged.unionByName(refused)


# --- mixed batches ------------------------------------------------------------

# State of an e-mail address at some moment: the ordinal of the request that
# last put a user there, or one of these.
VACANT = -1
ORIGINAL = -2  # the user that had the address before the batch

# Ordinals per window partition; see state_before.
SPAN = 1 << 16


def _stage(df: DataFrame, purpose: str) -> DataFrame:
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def state_before(timeline: DataFrame, by: tuple[str, ...], span: int = SPAN,
                 initial: DataFrame | None = None) -> DataFrame:
    """``timeline`` (``ordinal, state`` and the ``by`` columns; ``state`` NULL
    where a row changes nothing) with ``before``: the state just before the row.
    The first state comes from the column ``start``, or is ``ORIGINAL`` for the
    keys in ``initial`` and ``VACANT`` for others.

    A running window per key would put a hot key on one task. Ordinals are cut
    into spans: the window runs inside (key, span), at most ``span`` rows, and a
    second one over one row per (key, span) carries the state across.
    """
    cut = timeline.withColumn("_span", F.floor(F.col("ordinal") / span))
    cells = [*by, "_span"]
    so_far = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*cells).orderBy("ordinal").rowsBetween(*so_far)
    across = Window.partitionBy(*by).orderBy("_span").rowsBetween(*so_far)
    totals = [F.max_by("state", F.when(F.col("state").isNotNull(), F.col("ordinal"))).alias("_end")]
    if initial is None:
        totals.append(F.max("start").alias("_start"))
    spans = cut.groupBy(*cells).agg(*totals).withColumn(
        "_carry", F.last("_end", ignorenulls=True).over(across))
    if initial is not None:
        known = initial.withColumn("_start", F.lit(ORIGINAL).cast("bigint"))
        spans = spans.join(known, list(by), "left")
    spans = spans.select(*cells, F.coalesce("_carry", "_start", F.lit(VACANT)).alias("_carry"))
    within = cut.withColumn("_prior", F.last("state", ignorenulls=True).over(inside))
    return (
        within.join(spans, cells)
        .withColumn("before", F.coalesce("_prior", "_carry"))
        .drop("_span", "_prior", "_carry")
    )


def _timeline(requests: DataFrame) -> DataFrame:
    """One row per request and address it touches."""
    source = F.struct(F.col("email").alias("key"), F.lit("from").alias("side"))
    target = F.struct(F.col("new_email").alias("key"), F.lit("to").alias("side"))
    sides = F.when(F.col("moves"), F.array(source, target)).otherwise(F.array(source))
    return requests.select("ordinal", "op", "moves", "rejected", F.inline(sides))


def _moved_to() -> Column:
    """What a successful move does to the address of a row."""
    return F.when(F.col("side") == "to", F.col("ordinal")).otherwise(F.lit(VACANT))


def _state_set(succeeds: Column) -> Column:
    """The state that a row leaves behind; NULL when it leaves the old one."""
    return (
        F.when(F.col("op") == "insert", F.col("ordinal"))
        .when(F.col("op") == "delete", F.lit(VACANT))
        .when(succeeds, _moved_to())
    )


def _by_request(stated: DataFrame, *more: Column) -> DataFrame:
    """The state of both addresses of a request: ``here`` and ``there``."""
    return stated.groupBy("ordinal").agg(
        F.max(F.when(F.col("side") == "from", F.col("before"))).alias("here"),
        F.max(F.when(F.col("side") == "to", F.col("before"))).alias("there"),
        *more,
    )


def _move_slots(timeline: DataFrame, initial: DataFrame, span: int) -> DataFrame:
    """The rows of moves with their slot: the address and the last insert or
    delete there. After an insert an address is taken and after a delete it is
    free, whatever came before, so moves only matter to each other within a slot
    (``key, since``) and the slot's first state (``start``) is known."""
    moving = timeline.filter("moves").select("key").distinct()
    decides = F.col("moves") | F.col("op").isin("insert", "delete")
    rows = timeline.filter(decides).join(moving, "key", "left_semi")
    taken = F.when(F.col("op") == "insert", F.col("ordinal") * 2 + 1).when(
        F.col("op") == "delete", F.col("ordinal") * 2)
    stated = state_before(rows.withColumn("state", taken), ("key",), span, initial)
    since = F.col("before")
    start = (since == ORIGINAL) | ((since >= 0) & (since % 2 == 1))
    return stated.filter("moves").select(
        "ordinal", "side", "key", since.alias("since"),
        F.when(start, F.lit(ORIGINAL)).otherwise(F.lit(VACANT)).cast("bigint").alias("start"),
    )


def _settle_moves(timeline: DataFrame, initial: DataFrame, span: int) -> DataFrame:
    """Which moves succeed (``ordinal, succeeds``): see ``operators/moves.py``."""
    real = timeline.filter(~F.col("rejected"))
    if real.filter("moves").isEmpty():
        return real.limit(0).select("ordinal", F.lit(True).alias("succeeds"))
    side = F.when(F.col("side") == "to", moves.TO).otherwise(moves.FROM)
    slots = _move_slots(real, initial, span).withColumn("side", side)
    events = state_before(slots.withColumn("state", moves.wire(F.col("ordinal"), F.col("side"))), ("key", "since"), span)
    taken = F.col("before") == ORIGINAL
    return _stage(moves.verdicts(events.select(
        "ordinal", "side", taken.alias("taken"), F.when(F.col("before") >= 0, F.col("before")).alias("last"))), "verdicts")


def _identities(ok: DataFrame, initial: DataFrame, span: int) -> DataFrame:
    """Successful requests with ``segment``: the request that last put a user at
    the address before them (``ORIGINAL`` if none did). Refused requests are
    left out, as they put nobody anywhere."""
    timeline = _timeline(ok).withColumn("state", _state_set(F.col("moves")))
    stated = state_before(timeline, ("key",), span, initial)
    found = stated.filter(F.col("side") == "from").select("ordinal", F.col("before").alias("segment"))
    return ok.join(found, "ordinal")


def _origins(named: DataFrame) -> DataFrame:
    """For each move the user it carries: ``segment`` (the move's ordinal),
    ``origin`` (``ORIGINAL`` or an insert's ordinal) and ``origin_email``.
    Chains of moves are halved every round."""
    pointers = _stage(
        named.filter("moves").select(
            F.col("ordinal").alias("segment"),
            F.col("segment").alias("origin"),
            F.col("email").alias("origin_email"),
        ),
        "origins",
    )
    while True:
        step = pointers.select(
            F.col("segment").alias("origin"),
            F.col("origin").alias("_next"),
            F.col("origin_email").alias("_email"),
        )
        if pointers.join(step, "origin", "left_semi").isEmpty():
            return pointers
        pointers = _stage(
            pointers.join(step, "origin", "left").select(
                "segment",
                F.coalesce("_next", "origin").alias("origin"),
                F.coalesce("_email", "origin_email").alias("origin_email"),
            ),
            "origins",
        )


def apply_changes(users: DataFrame, requests: DataFrame, now: Column, salt: str = "user",
                  span: int = SPAN) -> tuple[DataFrame, DataFrame]:
    """Any mix of inserts, updates, moves and deletes, with the result of running
    them one at a time in ordinal order."""
    requests, refused = _split(requests, F.col("op"))
    prepared = requests.withColumn("new_email", F.when(F.col("op") == "update", new_email()))
    prepared = prepared.withColumn("moves", F.col("new_email").isNotNull()).withColumn(
        "rejected", (F.col("op") == "update") & breaks_not_null())
    prepared = _stage(prepared, "requests")
    timeline = _timeline(prepared)
    touched = timeline.select("key").distinct()
    initial = _stage(
        touched.join(users.select(F.col("email").alias("key")), "key", "left_semi"), "initial"
    )
    verdicts = _settle_moves(timeline, initial, span)
    marked = timeline.join(verdicts, "ordinal", "left").withColumn(
        "state", _state_set(F.col("succeeds")))
    states = _by_request(state_before(marked, ("key",), span, initial))
    outcome = request_outcome(
        F.col("op"), F.col("here") != VACANT,
        F.coalesce(F.col("there") != VACANT, F.lit(False)), has_fields(), F.col("rejected"),
    )
    judged = _stage(
        prepared.join(states, "ordinal").withColumn("outcome", outcome), "judged"
    )

    # Every successful request belongs to one user: an original or an inserted one.
    ok = judged.filter(F.col("outcome") == "ok")
    named = _stage(_identities(ok, initial, span), "identities").withColumn(
        "segment", F.when(F.col("op") == "insert", F.col("ordinal")).otherwise(F.col("segment"))
    )
    named = lookup_join(named, _origins(named), "segment", "left")
    origin = F.coalesce("origin", "segment")
    owner = F.when(
        origin == ORIGINAL, F.concat(F.lit("u:"), F.coalesce("origin_email", "email"))
    ).otherwise(F.concat(F.lit("i:"), origin.cast("string")))
    owned = named.withColumn("owner", owner)

    folded = fold_changes(owned.filter(F.col("op") == "update"), "owner")
    gone = owned.filter(F.col("op") == "delete").select("owner")  # one delete per user
    base = users.withColumn("owner", F.concat(F.lit("u:"), F.col("email"))).unionByName(
        inserted_rows(
            owned.filter(F.col("op") == "insert"), now, salt, ("owner",),
        )
    )
    kept = base.join(gone, "owner", "left_anti").join(folded, "owner", "left")
    return apply_fold(kept, now), judged.select(*requests.columns, "outcome").unionByName(refused)
