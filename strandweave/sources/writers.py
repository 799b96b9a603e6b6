"""Sinks: CSV, FASTA, one folder for each bin, report sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def csv(df: DataFrame, path: str, *, python_booleans: bool = False) -> None:
    """CSV with header; arrays joined by ";" (SNK-01)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        kind = f.dataType.simpleString()
        cols.append((F.array_join(c.cast("array<string>"), ";") if kind.startswith("array") else F.initcap(c.cast("string")) if kind == "boolean" and python_booleans else c).alias(f.name))
    df.select(*cols).write.csv(path, header=True, mode="overwrite")


def unique_ids(records: DataFrame, order: str = "ord") -> DataFrame:
    """Repeated accessions get `_1`, `_2`, … in order (SNK-02, WIN-15)."""
    n = F.row_number().over(Window.partitionBy("acc").orderBy(order)) - 1
    return records.withColumn("_n", n).withColumn("acc", F.when(F.col("_n") > 0, F.concat_ws("_", "acc", "_n")).otherwise(F.col("acc"))).drop("_n")


def fasta(records: DataFrame, path: str, *, order: str = "ord", compress: bool = True, partition_by: str | None = None) -> None:
    """Records `acc, comment, seq` as FASTA text, gzip by default; in folders by bin if asked (SNK-02, SNK-04)."""
    head = F.when(F.coalesce("comment", F.lit("")) != "", F.concat_ws(" ", "acc", "comment")).otherwise(F.col("acc")) if "comment" in records.columns else F.col("acc")
    text = unique_ids(records, order).select(F.concat(F.lit(">"), head, F.lit("\n"), F.col("seq")).alias("value"), *([partition_by] if partition_by else []))
    w = text.write.mode("overwrite").option("compression", "gzip" if compress else "none")
    (w.partitionBy(partition_by) if partition_by else w).text(path)


def filter_records(records: DataFrame, ids: DataFrame, *, keep: bool = True) -> tuple[DataFrame, DataFrame]:
    """(records kept or left by an id list, one row n_in, n_out) (SNK-03)."""
    marked = records.join(ids.select("acc").distinct().withColumn("_hit", F.lit(True)), "acc", "left")
    ok = F.col("_hit").isNotNull() if keep else F.col("_hit").isNull()
    return marked.where(ok).drop("_hit"), marked.agg(F.count("*").alias("n_in"), F.count_if(ok).alias("n_out"))


def sheets(tables: dict[str, DataFrame], root: str) -> list[str]:
    """A CSV for each sheet, `result_<name>`: lower case, the first blank an underscore (SNK-08)."""
    out = []
    for name, df in tables.items():
        path = f"{root.rstrip('/')}/result_{name.lower().replace(' ', '_', 1)}.csv"
        csv(df, path)
        out.append(path)
    return out


def workbook(tables: dict[str, DataFrame], path: str, most_rows: int = 1_000_000) -> None:
    """An Excel file on the driver, where a writer for it is installed; sheets beyond Excel's rows are refused (SNK-06)."""
    import pandas as pd

    with pd.ExcelWriter(path) as writer:
        for name, df in tables.items():
            if df.limit(most_rows + 1).count() > most_rows:
                raise ValueError(f"sheet {name} has over {most_rows} rows")
            df.toPandas().to_excel(writer, sheet_name=name[:31], index=False)


def cache_put(entries: DataFrame, path: str, name: str) -> None:
    """Appends `key, payload` to a lookup table (SNK-09)."""
    entries.select(F.lit(name).alias("cache"), "key", "payload", F.current_timestamp().alias("written")).write.mode("append").partitionBy("cache").parquet(path)


def bundle(tables: dict[str, DataFrame], root: str) -> None:
    """Named tables as Parquet, which run-length encodes depth columns by itself (SNK-07)."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
