"""Masking, row filters, tags and protected columns. Who asks is a plain set of group names."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.values import TAGS

ADMINS = "data_admins"


def mask_email(email: Column) -> Column:
    """First three characters, then ``***@`` and the domain; NULL where there is no domain."""
    return F.concat(F.substring(email, 1, 3), F.lit("***@"), F.get(F.split(email, "@"), F.lit(1)))


def mask_phone(phone: Column) -> Column:
    return F.concat(F.lit("***-***-"), F.right(phone, F.lit(4)))


def customer_360_secure(customers: DataFrame, customer_360: DataFrame, groups: Iterable[str]) -> DataFrame:
    """Customer profile with contact data in clear for administrators only."""
    admin = ADMINS in set(groups)
    metrics = customer_360.select(
        "customer_id", "total_transactions", "total_spend", "avg_order_value", "rfm_score", "value_segment", "preferred_channel"
    )
    return customers.join(metrics, "customer_id").select(
        "customer_id",
        (F.col("email") if admin else mask_email(F.col("email"))).alias("email"),
        (F.col("phone") if admin else mask_phone(F.col("phone"))).alias("phone"),
        "first_name", "last_name", "state", "customer_segment", "tenure_category",
        *metrics.columns[1:],
    )


def store_analytics_secure(store_analytics: DataFrame, groups: Iterable[str]) -> DataFrame:
    """Stores of the states named by the caller's ``region_<state>`` groups; administrators see all."""
    groups = set(groups)
    if ADMINS in groups:
        return store_analytics
    return store_analytics.where(F.concat(F.lit("region_"), F.lower("state")).isin(sorted(groups)))


def tag_catalog(spark: SparkSession, rows: Sequence[tuple] = TAGS) -> DataFrame:
    """Tags of tables (``column_name`` NULL) and columns."""
    return spark.createDataFrame(
        list(rows), "schema_name string, table_name string, column_name string, tag_name string, tag_value string"
    )


def table_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(schema_name, table_name, row_count)`` of ``schema.table`` frames, to put figures beside tags."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name.split(".")[0]).alias("schema_name"), F.lit(name.split(".")[1]).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def filled_counts(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """``(schema_name, table_name, column_name, filled_count)``: non-NULL values of the named columns."""
    parts = []
    for name, cols in columns.items():
        schema, table = name.split(".")
        counts = tables[name].agg(*[F.count(c).alias(c) for c in cols])
        parts.append(
            counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled_count")) for c in cols])))
            .select(F.lit(schema).alias("schema_name"), F.lit(table).alias("table_name"), "column_name", "filled_count")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pii_tables(tags: DataFrame) -> DataFrame:
    """Tables tagged ``pii = true``."""
    return tags.where("column_name IS NULL AND tag_name = 'pii' AND tag_value = 'true'").drop("column_name")


def pii_columns(tags: DataFrame) -> DataFrame:
    """Columns carrying a ``pii`` tag."""
    return tags.where("column_name IS NOT NULL AND tag_name = 'pii'")


def tables_by_domain(tags: DataFrame) -> DataFrame:
    """Tables with their domain, in domain and name order."""
    return (
        tags.where("column_name IS NULL AND tag_name = 'domain'")
        .select("schema_name", "table_name", F.col("tag_value").alias("domain"))
        .orderBy("domain", "table_name")
    )


def tag_summary(tags: DataFrame) -> DataFrame:
    """Number of distinct tables per table tag."""
    return tags.where("column_name IS NULL").groupBy("tag_name").agg(F.countDistinct("schema_name", "table_name").alias("table_count"))


def pseudonym(value: Column, salt: str) -> Column:
    """Irreversible stand-in: salted SHA-256 in hex; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    """Replace columns by base64 text of their AES-GCM cipher; ``key`` has 16, 24 or 32 characters.

    The key comes as a scalar subquery over a one-row table (``secrets.select("key").scalar()``), so neither plan, event log
    nor UI shows it; a literal would.
    """
    return df.withColumns({c: F.base64(F.aes_encrypt(F.col(c).cast("string"), key)) for c in columns})


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    """Undo :func:`encrypt_columns`; values come back as text."""
    return df.withColumns({c: F.aes_decrypt(F.unbase64(c), key).cast("string") for c in columns})
