"""Publishing and auditing of product tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verdance.functions import scalar as S
from verdance.functions import tables as K


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without a null or NaN in any column."""
    return df.na.drop("any")


def published_types(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the table's types, rows that don't fit): whole-number columns refuse fractions; the text 'nan' is null."""
    want = {c: t for c, t in K.PUBLISHED_TYPES.get(table, {}).items() if c in df.columns}
    wrong: Column = F.lit(False)
    out = []
    for c in df.columns:
        kind = want.get(c)
        number = F.nanvl(F.col(c).cast("string").try_cast("double"), F.lit(None).cast("double"))
        if kind == "bigint":
            wrong |= number.isNotNull() & (number != F.floor(number))
            out.append(number.try_cast("bigint").alias(c))
        elif kind == "double":
            out.append(number.alias(c))
        elif kind == "string":
            text = F.col(c).cast("string")
            out.append(F.when(F.lower(text) == "nan", None).otherwise(text).alias(c))
        else:
            out.append(F.col(c))
    wrong = F.coalesce(wrong, F.lit(False))
    return df.where(~wrong).select(*out), df.where(wrong)


def push_stats(files: DataFrame, columns: list[str], name: str = "file_name") -> DataFrame:
    """files, rows, clean, dropped, drop_pct by table, and of all together under a null table."""
    whole = F.lit(True)
    for c in columns:
        whole &= F.col(c).isNotNull()
    rows = files.select(S.published_table(F.col(name)).alias("table_name"), F.col(name).alias("f"), whole.alias("whole")).where("table_name is not null")
    out = rows.rollup("table_name").agg(F.count_distinct("f").alias("files"), F.count("*").alias("rows"), F.count_if("whole").alias("clean"))
    return out.withColumn("dropped", F.col("rows") - F.col("clean")).withColumn("drop_pct", F.round(F.when(F.col("rows") > 0, 100.0 * F.col("dropped") / F.col("rows")), 2))


def records(df: DataFrame) -> DataFrame:
    """One JSON text a row; nulls stay, dates are ISO."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"}).alias("record"))


REQUIRED = {"NDVI": ["ndvi_1", "ndvi_2"], "NDWI": ["ndwi_1", "ndwi_2"], "SMART_GROWTH": ["sg_mean"], "WEED": ["percent_maleza", "status_maleza"]}


def audit(df: DataFrame, product: str) -> DataFrame:
    """One row: row count, null ages, missing columns, null means, range of positive growth scores, critical weed count."""
    lacking = [c for c in REQUIRED.get(product, []) if c not in df.columns]
    mean = {"NDVI": "ndvi_mean", "NDWI": "ndwi_mean", "SMART_GROWTH": "sg_mean"}.get(product)
    null = lambda c: F.count_if(F.col(c).isNull()) if c in df.columns else F.count("*")
    positive = F.when(F.col("sg_mean") > 0, F.col("sg_mean")) if "sg_mean" in df.columns else F.lit(None).cast("double")
    critical = F.count_if(F.col("status_maleza") == "Critica") if "status_maleza" in df.columns else F.lit(0).cast("long")
    out = df.agg(F.count("*").alias("rows"), null("edad").alias("null_ages"), (null(mean) if mean else F.lit(0).cast("long")).alias("null_means"), F.min(positive).alias("sg_low"), F.max(positive).alias("sg_high"), critical.alias("critical"))
    return out.withColumns({"null_age_pct": F.when(F.col("rows") > 0, 100.0 * F.col("null_ages") / F.col("rows")), "missing_columns": F.array(*[F.lit(c) for c in lacking]).cast("array<string>"), "product": F.lit(product)})


def missing_starts(parcels: DataFrame) -> DataFrame:
    """The ids of the parcels that lack a start date, for the log: a row each."""
    return parcels.where("fecha_inicio is null").select("id_parcela")
