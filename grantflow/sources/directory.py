"""Principal directory and role configuration documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_REF = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("uuid", T.StringType())]))
PRINCIPAL = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("username", "email", "first_name", "last_name", "account_number", "org_id")]
    + [T.StructField("is_org_admin", T.BooleanType()), T.StructField("is_active", T.BooleanType())]
    + [T.StructField("groups", _REF), T.StructField("roles", _REF)]
)


def _fields(**kinds) -> list[T.StructField]:
    return [T.StructField(n, k()) for n, k in kinds.items()]


_GROUP = _fields(
    uuid=T.StringType, name=T.StringType, description=T.StringType, platform_default=T.BooleanType, system=T.BooleanType
)
_PERMISSIONS = T.StructField("permissions", T.ArrayType(T.StringType()))
DIRECTORY = T.StructType(
    [
        T.StructField("principals", T.ArrayType(PRINCIPAL)),
        T.StructField("groups", T.ArrayType(T.StructType(_GROUP))),
        T.StructField("roles", T.ArrayType(T.StructType([*_GROUP, _PERMISSIONS]))),
    ]
)
_ACCESS = T.StructField("access", T.ArrayType(T.StructType(_fields(permission=T.StringType))))
_ROLE = _fields(
    name=T.StringType, description=T.StringType, system=T.BooleanType, platform_default=T.BooleanType,
    admin_default=T.BooleanType, version=T.IntegerType,
)
ROLE_CONFIG = T.StructType([T.StructField("roles", T.ArrayType(T.StructType([*_ROLE, _ACCESS])))])
VERB = "array<struct<verb: string, description: string, requires: array<string>>>"


def read_directory(spark: SparkSession, path: str, *, lines: bool = False) -> DataFrame:
    """Directory documents, each a file, or with ``lines`` each a line (JSON Lines, which Spark splits)."""
    return spark.read.schema(DIRECTORY).json(path, multiLine=not lines)


def flatten_principals(df: DataFrame) -> dict[str, DataFrame]:
    """Principal rows (nested groups and roles) to ``principals``, ``membership`` and ``assignment``."""
    return {
        "principals": df.drop("groups", "roles"),
        "membership": df.select("username", F.explode("groups").alias("g")).select(
            "username", F.col("g.uuid").alias("group_uuid"), F.col("g.name").alias("group_name")
        ),
        "assignment": df.select("username", F.explode("roles").alias("r")).select(
            "username", F.col("r.uuid").alias("role_uuid"), F.col("r.name").alias("role_name")
        ),
    }


def flatten_directory(df: DataFrame) -> dict[str, DataFrame]:
    """Directory documents to flat tables; also ``groups``, ``roles`` and ``role_permissions``."""
    out = flatten_principals(df.select(F.explode("principals").alias("p")).select("p.*"))
    out["groups"] = df.select(F.explode("groups").alias("g")).select("g.*")
    roles = df.select(F.explode("roles").alias("r")).select("r.*")
    out["roles"] = roles.drop("permissions")
    out["role_permissions"] = roles.select(
        F.col("uuid").alias("role_uuid"), F.col("name").alias("role_name"), F.explode("permissions").alias("permission")
    )
    return out


def flatten_role_config(df: DataFrame) -> DataFrame:
    """Role documents with column ``roles`` to one row per role and permission; roles without access stay."""
    return df.select(F.explode("roles").alias("r")).select(
        F.col("r.name").alias("role"), F.col("r.system").alias("system"),
        F.col("r.platform_default").alias("platform_default"), F.col("r.admin_default").alias("admin_default"),
        F.col("r.version").alias("version"), F.explode_outer("r.access").alias("a"),
    ).select("role", "system", "platform_default", "admin_default", "version", F.col("a.permission").alias("permission"))


def flatten_permission_config(df: DataFrame) -> DataFrame:
    """``(app, value)`` permission documents ``{resource: [{verb, requires}]}`` to ``(app, resource, verb, requires)``.

    Comment entries, which are no lists, are left out.
    """
    entries = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return (
        df.select("app", F.explode(entries).alias("resource", "body"))
        .withColumn("verbs", F.from_json("body", VERB))
        .where("body like '[%'")
        .select("app", "resource", F.explode("verbs").alias("v"))
        .select("app", "resource", F.col("v.verb").alias("verb"), F.explode_outer("v.requires").alias("requires"))
    )
