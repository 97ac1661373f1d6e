"""Keyed changes against a one-at-a-time loop."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from aerolake import model
from aerolake.operators import changes, skew



@pytest.fixture(autouse=True, params=["hot", "plain"])
def hot_path(request, monkeypatch):
    """Every test with hot keys split off, and with plain joins."""
    if request.param == "hot":
        monkeypatch.setattr(skew, "HOT_ROWS", 10)
        monkeypatch.setattr(skew, "LOOK_AT", 1.0)


NOW = datetime(2025, 6, 1, 12)
THEN = datetime(2025, 1, 1)
REQUESTS = "ordinal bigint, op string, email string, changes map<string,string>"
REQUIRED = ("name", "email", "phone_number", "password")


def user(email, **over):
    row = dict(id=f"id-{email}", name=email.split("@")[0], email=email, password="hash",
               signatureStatus="active", phone_number="559100000000", role=None,
               notifications="no", created_at=THEN, updated_at=None)
    return {**row, **over}


def users_df(spark, rows):
    data = [tuple(r[c] for c in model.USER_COLUMNS) for r in rows]
    return spark.createDataFrame(
        data, "id string, name string, email string, password string, signatureStatus string, "
        "phone_number string, role string, notifications string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz")


def serial(users, requests):
    """What the service would do, request by request."""
    table = {u["email"]: dict(u) for u in users}
    outcomes = {}
    for ordinal, op, email, change in sorted(requests):
        there = table.get(email)
        if op == "insert":
            if there:
                outcomes[ordinal] = "conflict"
                continue
            fresh = {c: None for c in model.USER_COLUMNS}
            fresh.update({k: v for k, v in change.items() if k in model.USER_FIELDS})
            fresh.update(email=email, id=f"new-{ordinal}", created_at=NOW)
            table[email] = fresh
            outcomes[ordinal] = "ok"
        elif not there:
            outcomes[ordinal] = "not_found"
        elif op == "delete":
            del table[email]
            outcomes[ordinal] = "ok"
        else:
            target = change.get("email")
            if target and target != email and target in table:
                outcomes[ordinal] = "conflict"
            elif not change:
                outcomes[ordinal] = "no_fields"
            elif any(k in REQUIRED and not v for k, v in change.items()):
                outcomes[ordinal] = "rejected"
            else:
                outcomes[ordinal] = "ok"
                if any(there[k] != v for k, v in change.items()):
                    there["updated_at"] = NOW
                there.update(change)
                if target and target != email:
                    table[target] = table.pop(email)
    return table, outcomes


def shown(rows, new_ids=None):
    """Rows as comparable tuples; ids of new users are replaced by ``new``."""
    out = []
    for r in rows:
        d = r if isinstance(r, dict) else r.asDict()
        ident = d["id"] if str(d["id"]).startswith("id-") else "new"
        out.append((ident, *[d[c] for c in model.USER_COLUMNS[1:]]))
    return sorted(out, key=repr)


def random_requests(rng, n, kinds, emails, hot_share=0.33):
    rows = []
    for ordinal in range(n):
        email = emails[0] if rng.random() < hot_share else rng.choice(emails)
        op = rng.choice(kinds)
        change = {}
        if op == "insert":
            change = dict(name=f"n{ordinal}", phone_number="1" * 11, password="p" * 8, role="user",
                          signatureStatus=None, notifications="yes")
        elif op in ("update", "move"):
            for field, values in (("name", ["a", "b", None]), ("role", ["admin", None]),
                                  ("notifications", ["no", "yes"])):
                if rng.random() < 0.3:
                    change[field] = rng.choice(values if rng.random() < 0.3 else values[:1])
            if op == "move":
                change["email"] = rng.choice(emails)
        rows.append((ordinal, "update" if op == "move" else op, email, change))
    return rows


EMAILS = [f"e{i}@x.org" for i in range(12)]


@pytest.mark.parametrize("seed,span", [(1, 7), (2, 1000), (3, 1), (4, 20)])
def test_mixed_batches_equal_one_at_a_time(spark, seed, span):
    rng = random.Random(seed)
    users = [user(e) for e in EMAILS[:6]] + [user(f"idle{i}@x.org") for i in range(3)]
    requests = random_requests(rng, 150, ["insert", "delete", "update", "move", "move"], EMAILS)
    after, judged = changes.apply_changes(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS).repartition(3),
        F.lit(NOW), span=span)
    table, outcomes = serial(users, requests)
    assert {r.ordinal: r.outcome for r in judged.collect()} == outcomes
    rows = after.collect()
    assert shown(rows) == shown(table.values())
    assert len({r.id for r in rows}) == len(rows)


def test_chain_of_moves_through_freed_addresses(spark):
    users = [user("a@x.org"), user("b@x.org"), user("c@x.org")]
    requests = [
        (0, "update", "c@x.org", {"email": "d@x.org"}),
        (1, "update", "b@x.org", {"email": "c@x.org"}),
        (2, "update", "a@x.org", {"email": "b@x.org"}),
        (3, "update", "a@x.org", {"name": "gone"}),
        (4, "update", "b@x.org", {"email": "a@x.org", "name": "back"}),
        (5, "delete", "d@x.org", {}),
        (6, "insert", "d@x.org", dict(name="n", phone_number="1" * 11, password="p" * 8)),
        (7, "update", "d@x.org", {"email": "b@x.org"}),
    ]
    after, judged = changes.apply_changes(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS), F.lit(NOW), span=2)
    table, outcomes = serial(users, requests)
    assert {r.ordinal: r.outcome for r in judged.collect()} == outcomes
    assert shown(after.collect()) == shown(table.values())


def test_batch_without_moves(spark):
    rng = random.Random(9)
    users = [user(e) for e in EMAILS[:6]]
    requests = random_requests(rng, 120, ["insert", "delete", "update"], EMAILS, hot_share=0.5)
    after, judged = changes.apply_changes(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS), F.lit(NOW), span=16)
    table, outcomes = serial(users, requests)
    assert {r.ordinal: r.outcome for r in judged.collect()} == outcomes
    assert shown(after.collect()) == shown(table.values())


@pytest.mark.parametrize("kind", ["insert", "update", "delete"])
def test_batches_of_one_kind(spark, kind):
    rng = random.Random(5)
    users = [user(e) for e in EMAILS[:6]] + [user("idle@x.org", role="admin")]
    requests = random_requests(rng, 200, [kind], EMAILS)
    table, outcomes = serial(users, requests)
    u, r = users_df(spark, users), spark.createDataFrame(requests, REQUESTS)
    if kind == "insert":
        after, judged = changes.insert_if_absent(u, r, F.lit(NOW))
    elif kind == "update":
        after, judged = changes.partial_update(u, r, F.lit(NOW))
    else:
        after, deleted, judged = changes.delete_by_email(u, r)
        assert {d.email for d in deleted.collect()} == {x["email"] for x in users} - set(table)
    assert {j.ordinal: j.outcome for j in judged.collect()} == outcomes
    assert shown(after.collect()) == shown(table.values())


def test_set_to_null_is_not_unset(spark):
    users = [user("a@x.org", role="admin"), user("b@x.org", role="admin")]
    requests = [(0, "update", "a@x.org", {"role": None}), (1, "update", "b@x.org", {"name": "z"})]
    after, _ = changes.partial_update(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS), F.lit(NOW))
    assert {r.email: r.role for r in after.collect()} == {"a@x.org": None, "b@x.org": "admin"}


def test_unchanged_values_do_not_touch(spark):
    users = [user("a@x.org"), user("b@x.org")]
    requests = [(0, "update", "a@x.org", {"name": "a", "role": None}),
                (1, "update", "b@x.org", {"name": "x"}), (2, "update", "b@x.org", {"name": "b"})]
    after, _ = changes.partial_update(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS), F.lit(NOW))
    assert {r.email: r.updated_at for r in after.collect()} == {"a@x.org": None, "b@x.org": NOW}


def test_partial_update_refuses_moves(spark):
    requests = [(0, "update", "a@x.org", {"email": "b@x.org"})]
    users = users_df(spark, [user("a@x.org")])
    with pytest.raises(Exception, match="apply_changes"):
        changes.partial_update(
            users, spark.createDataFrame(requests, REQUESTS), F.lit(NOW))[0].collect()


def test_judged_on_their_own(spark):
    users = [user("a@x.org"), user("b@x.org")]
    requests = [
        (0, "update", "a@x.org", {"email": "b@x.org"}), (1, "update", "a@x.org", {"email": "a@x.org"}),
        (2, "update", "a@x.org", {}), (3, "update", "z@x.org", {"email": "b@x.org"}),
        (4, "update", "a@x.org", {"name": None}), (5, "update", "a@x.org", {"email": "c@x.org"}),
    ]
    judged = changes.judge_updates(
        users_df(spark, users), spark.createDataFrame(requests, REQUESTS))
    got = {r.ordinal: r.outcome for r in judged.collect()}
    assert got == {0: "conflict", 1: "ok", 2: "no_fields", 3: "not_found", 4: "rejected", 5: "ok"}
