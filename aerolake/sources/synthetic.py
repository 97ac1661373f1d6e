"""Generated users: the same rows for the same seed, whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import model
from aerolake.functions.casts import truncate_text
from aerolake.functions.documents import name_based_uuid

# Name parts.
FIRST_NAMES = ("Ana", "Bruno", "Carla", "Davi", "Elisa", "Heitor", "João", "Larissa")
LAST_NAMES = ("Almeida", "Barros", "Costa", "Farias", "Lima", "Moraes", "Souza")


def draw(seed: int, purpose: str, number: Column, choices: int) -> Column:
    """A number below ``choices`` computed from seed, purpose and row number."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), number.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % choices


def _pick(values, seed, purpose, number) -> Column:
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, draw(seed, purpose, number, len(values)).cast("int"))


def users_for(numbers: DataFrame, column: str, seed: int, created_at: Column) -> DataFrame:
    """One user per row number. The e-mail holds the number, so it is unique;
    the stored password is a digest, no literal."""
    n = F.col(column)
    name = F.concat_ws(
        " ", _pick(FIRST_NAMES, seed, "first", n), _pick(LAST_NAMES, seed, "last", n)
    )
    phone = F.concat(
        F.lit("55"),
        F.lpad(draw(seed, "area", n, 90).cast("string"), 2, "0"),
        F.lpad(draw(seed, "line", n, 1_000_000_000).cast("string"), 9, "0"),
        F.lit("0000000000"),
    )
    return numbers.select(
        name_based_uuid(F.lit(seed), n).alias("id"),
        name.alias("name"),
        F.concat(F.lit("user"), n.cast("string"), F.lit("@example.com")).alias("email"),
        F.md5(F.concat_ws("|", F.lit("pw"), F.lit(str(seed)), n.cast("string"))).alias("password"),
        _pick(model.SIGNATURE_STATUSES, seed, "status", n).alias("signatureStatus"),
        truncate_text(phone, 20).alias("phone_number"),
        _pick(model.ROLES, seed, "role", n).alias("role"),
        _pick(model.NOTIFICATIONS, seed, "notifications", n).alias("notifications"),
        created_at.cast("timestamp_ntz").alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"),
    )


def synthetic_users(spark: SparkSession, n: int = 50, seed: int = 0,
                    created_at: Column | None = None) -> DataFrame:
    stamp = F.current_timestamp() if created_at is None else created_at
    return users_for(spark.range(n), "id", seed, stamp)
