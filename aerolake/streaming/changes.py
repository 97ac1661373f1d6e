"""Keyed changes as a stream: every batch of requests meets the stored users, kept beside the checkpoint.

The state of an e-mail is its user row. A batch reads the version of the state that the batch before
left and writes the next one, all by joins and aggregations over addresses, so the requests of one
address in one batch are spread like any others. The output is a change feed: an outcome per request
and, per address and batch, the user as it then is and was. Files of the feed come by a commit named
after the batch, so a batch that is run again adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerolake import model
from aerolake.operators.changes import (
    ORIGINAL, SPAN, apply_fold, breaks_contract, breaks_not_null, fold_changes, has_fields, inserted_rows,
    known_changes, new_email, state_before,
)
from aerolake.plans.commits import Folder, Output, commit, finish
from aerolake.session import shared_folder
from aerolake.streaming.silver import install_once

REQUESTS = "ordinal bigint, op string, email string, changes map<string,string>"
USER = ("id string, name string, email string, password string, signatureStatus string, phone_number string, "
        "role string, notifications string, created_at timestamp_ntz, updated_at timestamp_ntz")
FEED = f"kind string, email string, ordinal bigint, op string, outcome string, user struct<{USER}>, before struct<{USER}>"
READY = f"{REQUESTS}, refused boolean, fields boolean, rejected boolean, turn bigint"
STATE = f"email string, user struct<{USER}>"
_TYPES = [pair.split(" ") for pair in USER.split(", ")]


def ready_requests(requests: DataFrame) -> DataFrame:
    """Requests with all that can be said of them before their user is known, and the ``turn``
    of those with one ordinal.

    A change of e-mail touches two addresses and so is no request of this stream: it stops
    the stream with an error, as it stops ``partial_update``; ``apply_changes`` takes it.
    """
    known = known_changes(requests)
    moving = (F.col("op") == "update") & new_email().isNotNull()
    stays = F.when(moving, F.raise_error(F.lit("a change of e-mail needs apply_changes"))).otherwise(F.col("email"))
    return known.select(
        "ordinal", "op", stays.alias("email"), "changes", breaks_contract(F.col("op")).alias("refused"),
        has_fields().alias("fields"), breaks_not_null().alias("rejected"), F.monotonically_increasing_id().alias("turn"))


def _inserts() -> Column:
    return F.col("op").eqNullSafe("insert") & ~F.col("refused")


def _deletes() -> Column:
    return F.col("op").eqNullSafe("delete") & ~F.col("refused")


def in_lives(ready: DataFrame, span: int = SPAN) -> DataFrame:
    """Requests (with an e-mail) with ``life``: the ordinal of the last delete before them, ``ORIGINAL`` if
    there was none. Whoever had the address before, nobody has it where a later life begins."""
    deleted = ready.filter(_deletes()).select("email").distinct()
    if deleted.isEmpty():
        return ready.withColumn("life", F.lit(ORIGINAL).cast("bigint"))
    marked = ready.join(deleted.withColumn("_ends", F.lit(True)), "email", "left")
    some = marked.filter("_ends").drop("_ends").withColumn("state", F.when(_deletes(), F.col("ordinal")))
    some = state_before(some.withColumn("start", F.lit(ORIGINAL).cast("bigint")), ("email",), span)
    others = marked.filter("_ends IS NULL").drop("_ends").withColumn("life", F.lit(ORIGINAL).cast("bigint"))
    return some.withColumnRenamed("before", "life").drop("state", "start").unionByName(others)


def judge(lived: DataFrame, state: DataFrame) -> DataFrame:
    """Requests with the ``outcome`` that one at a time, in the order of (ordinal, turn), would have given.

    An address has a user where its life began with one or has seen an insert, so one row per
    life, made map-side, tells all of its requests what they meet."""
    at = F.struct("ordinal", "turn")
    # Which of several inserts came first; no life goes on after a delete.
    lives = lived.filter("email IS NOT NULL").groupBy("email", "life").agg(F.min(F.when(_inserts(), at)).alias("_first"))
    owned = state.select("email", F.lit(ORIGINAL).cast("bigint").alias("life"), F.lit(True).alias("_owned"))
    lives = lives.join(owned, ["email", "life"], "left")
    met = lived.join(lives, ["email", "life"], "left")
    present = F.coalesce("_owned", F.lit(False)) | F.coalesce(F.col("_first") < at, F.lit(False))
    outcome = (F.when(F.col("refused"), "rejected")
               .when(F.col("op").eqNullSafe("insert"), F.when(present, "conflict").otherwise("ok"))
               .when(~present, "not_found").when(F.col("op").eqNullSafe("delete"), "ok")
               .when(~F.col("fields"), "no_fields").when(F.col("rejected"), "rejected").otherwise("ok"))
    return met.select("ordinal", "op", "email", "life", outcome.alias("outcome"), F.when(outcome == "ok", F.col("changes")).alias("changes"))


def users_met(judged: DataFrame, state: DataFrame, now: Column, salt: str = "user") -> DataFrame:
    """Per address of the judged requests, in its last life: ``email, ordinal`` (its last one), the user
    ``before`` all of them and the ``user`` after them."""
    real = judged.filter("email IS NOT NULL")
    last_delete = F.max(F.when(F.col("op").eqNullSafe("delete") & (F.col("outcome") != "rejected"), F.col("ordinal")))
    touched = real.groupBy(F.col("email").alias("_address")).agg(
        F.max("ordinal").alias("_ordinal"), F.coalesce(last_delete, F.lit(ORIGINAL)).alias("_life"))
    ok = real.filter("outcome = 'ok'")
    come = inserted_rows(ok.filter("op = 'insert'"), now, salt, ("email", "life"))
    come = come.toDF(*model.USER_COLUMNS, "_address", "_life").select("_address", "_life", _user(come.columns).alias("_new"))
    key = F.struct("email", "life")
    changed = fold_changes(ok.filter("NOT op <=> 'insert' AND NOT op <=> 'delete'").withColumn("_key", key), "_key").select(
        F.col("_key.email").alias("_address"), F.col("_key.life").alias("_life"), "*").drop("_key")
    stored = state.select(F.col("email").alias("_address"), F.col("user").alias("_before"))
    met = (touched.join(stored, "_address", "left").join(come, ["_address", "_life"], "left")
           .join(changed, ["_address", "_life"], "left"))
    base = F.coalesce(F.when(F.col("_life") == ORIGINAL, F.col("_before")), F.col("_new"))
    rows = met.withColumn("_base", base).withColumns({c: F.col("_base")[c] for c in model.USER_COLUMNS})
    after = apply_fold(rows, now, ("_address", "_ordinal", "_before", "_base"))
    return after.select(
        F.col("_address").alias("email"), F.col("_ordinal").alias("ordinal"), F.col("_before").alias("before"),
        F.when(F.col("_base").isNotNull(), _user(model.USER_COLUMNS)).alias("user"))


def _user(columns) -> Column:
    return F.struct(*[F.col(c).cast(t).alias(c) for c, t in _TYPES])


def _stored(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def _fill(spark: SparkSession, users: DataFrame, home: str) -> None:
    """The first version of the state, written once."""
    if any("_SUCCESS" in Folder(spark, f"{home}/{n}").names() for n in Folder(spark, home).names() if n.startswith("v=")):
        return
    rows = users.filter("email IS NOT NULL").dropDuplicates(["email"])
    rows.select("email", _user(model.USER_COLUMNS).alias("user")).write.mode("overwrite").parquet(f"{home}/v=0")


def change_users(spark: SparkSession, requests: DataFrame, home: str, feed: str, version: int, now: Column,
                 salt: str = "user") -> None:
    """One batch of requests against version ``version`` of the state at ``home``: the next version, and what
    happened to ``feed``. Does nothing when the batch has reached the feed before."""
    run = f"batch-{version}"
    finish(spark, home)
    if f"{run}.done" in Folder(spark, f"{home}/_commits").names():
        return
    state = spark.read.schema(STATE).parquet(f"{home}/v={version}")
    folder = shared_folder(spark, "changes")
    ready = _stored(spark, ready_requests(requests), f"{folder}/ready")
    judged = _stored(spark, judge(in_lives(ready), state), f"{folder}/judged")
    met = _stored(spark, users_met(judged, state, now, salt).filter("NOT before <=> user"), f"{folder}/met")
    kept = state.join(met.select("email"), "email", "left_anti")
    changed = met.filter("user IS NOT NULL").select("email", "user")
    kept.unionByName(changed).write.mode("overwrite").parquet(f"{home}/v={version + 1}")
    none = F.lit(None)
    told = judged.select(F.lit("request").alias("kind"), "email", "ordinal", "op", "outcome",
                         none.cast(f"struct<{USER}>").alias("user"), none.cast(f"struct<{USER}>").alias("before"))
    told = told.unionByName(met.select(F.lit("user").alias("kind"), "email", "ordinal", none.cast("string").alias("op"),
                                       none.cast("string").alias("outcome"), "user", "before"))
    commit(spark, home, run, [Output(told, feed)])
    for old in (folder, f"{home}/v={version - 1}"):  # a batch that is run again needs the version before it only
        Folder(spark, old).delete()


def stream_changes(spark: SparkSession, users: DataFrame, requests: str, feed: str, checkpoint: str, name: str,
                   now: Column, salt: str = "user", files_per_batch: int | None = None) -> StreamingQuery:
    """Run what is new below ``requests`` (Parquet of ``REQUESTS``) against the users and stop.

    ``users`` (unique e-mails) fill the state when the stream is first started; later
    starts go on with the stored state, and the feed gets each batch once. In a batch the requests
    of an address run in ordinal order; a batch comes after the ones before it, so files
    should arrive in the order of their ordinals. Requests without an e-mail meet no user.
    """
    home = f"{checkpoint}-users"
    reader = spark.readStream.schema(REQUESTS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge(batch: DataFrame, batch_id: int) -> None:
        change_users(spark, batch, home, feed, batch_id, now, salt)

    def start() -> StreamingQuery:
        _fill(spark, users, home)
        return (reader.parquet(requests).writeStream.queryName(name).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).foreachBatch(merge).start())

    return install_once(spark, name, start)


def request_outcomes(feed: DataFrame) -> DataFrame:
    """``ordinal, op, email, outcome`` of every request of a change feed."""
    return feed.filter("kind = 'request'").select("ordinal", "op", "email", "outcome")


def users_after(users: DataFrame, feed: DataFrame) -> DataFrame:
    """The users that the stream started with, changed by its feed: an address of the feed
    is as its last entry says, every other one as it was."""
    entries = feed.filter("kind = 'user'")
    last = entries.groupBy("email").agg(F.max_by("user", "ordinal").alias("user"), F.count("*").alias("n"))
    kept = users.select(*model.USER_COLUMNS).join(last.select("email"), "email", "left_anti")
    changed = last.filter("user IS NOT NULL").select("user.*")
    return kept.select(*model.USER_COLUMNS).unionByName(changed.select(*model.USER_COLUMNS))
