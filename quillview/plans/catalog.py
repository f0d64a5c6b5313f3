"""Catalog queries as DataFrame plans over catalog tables (any DataFrames of the same columns)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Namespaces of the system, kinds of relations that changes are published for.
SYSTEM = ("information_schema", "pg_catalog", "pg_toast")
KINDS = ("r", "p")

Catalog = dict[str, DataFrame]


def index_columns(c: Catalog) -> DataFrame:
    """Key columns of primary and replica-identity indexes: relation, column, which of the two."""
    flagged = c["pg_index"].filter("indisprimary OR indisreplident")
    keys = flagged.select("indrelid", "indisprimary", "indisreplident", F.explode(F.slice("indkey", F.lit(1), F.col("indnkeyatts"))).alias("attnum"))
    return keys.groupBy("indrelid", "attnum").agg(F.bool_or("indisprimary").alias("in_primary"), F.bool_or("indisreplident").alias("in_replica"))


def old_in_log(identity: Column, in_primary: Column, in_replica: Column) -> Column:
    """Whether the log has a column's old value, by the table's replica identity."""
    no = F.lit(False)
    return (
        F.when(identity == "n", no).when(identity == "d", F.coalesce(in_primary, no)).when(identity == "i", F.coalesce(in_replica, no)).when(identity == "f", F.lit(True))
    )


def discover(c: Catalog, publication: str) -> DataFrame:
    """Published tables with their columns, comments, keys and replica identity, in column order."""
    namespaces = c["pg_namespace"].select(F.col("oid").alias("ns"), F.col("nspname").alias("schema")).filter(~F.col("schema").isin(*SYSTEM))
    published = c["pg_publication_tables"].filter(F.col("pubname") == publication).select(F.col("schemaname").alias("schema"), F.col("tablename").alias("table"))
    relations = c["pg_class"].filter(F.col("relkind").isin(*KINDS)).select(F.col("oid").alias("rel"), F.col("relname").alias("table"), F.col("relnamespace").alias("ns"), "relreplident")
    columns = c["pg_attribute"].filter("attnum > 0 AND NOT attisdropped").select(F.col("attrelid").alias("rel"), F.col("attname").alias("column"), "attnum", F.col("atttypid").alias("type_oid"))
    notes = c["pg_description"].select(F.col("objoid").alias("rel"), F.col("objsubid").alias("sub"), "description")
    of_table = notes.filter("sub = 0").select("rel", F.col("description").alias("table_comment"))
    of_column = notes.select("rel", F.col("sub").alias("attnum"), F.col("description").alias("column_comment"))
    keys = index_columns(c).withColumnRenamed("indrelid", "rel")
    rows = (
        relations.join(namespaces, "ns").join(published, ["schema", "table"]).join(columns, "rel")
        .join(keys, ["rel", "attnum"], "left").join(of_table, "rel", "left").join(of_column, ["rel", "attnum"], "left")
    )
    return rows.select(
        "schema", "table", "column", "attnum", "table_comment", "column_comment", F.coalesce("in_primary", F.lit(False)).alias("pk"), "type_oid",
        old_in_log(F.col("relreplident"), F.col("in_primary"), F.col("in_replica")).alias("old_in_log"),
    ).orderBy("schema", "table", "attnum")


def type_by_oid(c: Catalog, oid: int) -> DataFrame:
    """A user-defined type; none for types of the system."""
    spaces = c["pg_namespace"].filter(~F.col("nspname").isin(*SYSTEM)).select(F.col("oid").alias("typnamespace"))
    return c["pg_type"].filter(F.col("oid") == oid).join(spaces, "typnamespace", "left_semi").select("oid", "typname", "typtype", "typcategory", "typarray", "typelem", "typrelid")


def composite_attributes(c: Catalog, relation: int) -> DataFrame:
    return c["pg_attribute"].filter((F.col("attrelid") == relation) & (F.col("attnum") > 0)).select("attname", "atttypid", "attnum").orderBy("attnum")


def enum_members(c: Catalog) -> DataFrame:
    types = c["pg_type"].select(F.col("oid").alias("enum_oid"), F.col("typname").alias("enum_name"), "typnamespace")
    spaces = c["pg_namespace"].select(F.col("oid").alias("typnamespace"), F.col("nspname").alias("namespace"))
    values = c["pg_enum"].select(F.col("oid").alias("value_oid"), F.col("enumtypid").alias("enum_oid"), F.col("enumlabel").alias("value_text"))
    return values.join(types, "enum_oid").join(spaces, "typnamespace").select("value_oid", "enum_oid", "value_text", "enum_name", "namespace")


def enum_array_types(c: Catalog) -> DataFrame:
    enums = c["pg_enum"].select(F.col("enumtypid").alias("typelem")).distinct()
    return c["pg_type"].filter("typcategory = 'A'").join(enums, "typelem", "left_semi").select(F.col("oid").alias("array_typ"), F.col("typelem").alias("enum_typ"))


def enum_labels(c: Catalog, oid: int) -> DataFrame:
    return c["pg_enum"].filter(F.col("enumtypid") == oid).select("enumlabel")


def slot_lag(log: DataFrame, slots: DataFrame) -> DataFrame:
    """Positions between the end of the log and what each slot has confirmed, as a number and for reading."""
    # The end of the log is one row.
    end = log.agg(F.max("seq").alias("end_seq")).withColumn("one", F.lit(1))
    lag = slots.withColumn("one", F.lit(1)).join(end, "one").withColumn("lag", F.col("end_seq") - F.col("confirmed"))
    units = ["bytes", "kB", "MB", "GB", "TB", "PB"]
    text = F.concat(F.col("lag").cast("string"), F.lit(" bytes"))
    for k, unit in enumerate(units[1:], 1):
        text = F.when(F.col("lag") >= 10 * 1024**k, F.concat(F.round(F.col("lag") / 1024**k).cast("long").cast("string"), F.lit(f" {unit}"))).otherwise(text)
    return lag.select("slot_name", "end_seq", "confirmed", "lag", text.alias("size"), "status")
