"""Registered queries over CSV files that Spark first writes from the star tables.

The files go to the shared folder, a new one for each run.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerchecks.ingest import EXPORTS, RECORD_KEY, _input, _plain, projection_name, projection_rows_sql
from dealerlake import schemas as S
from dealerlake.plans.ingest import ORDER, run_job
from dealerlake.session import COMPILED, new_folder, setting
from dealerlake.sources.bronze import AMOUNTS, SERVICO, Bronze
from dealerlake.sources.csv import FILE, detect_dialects, read_dirty_csv
from dealerlake.sources.sink import Target
from dealerlake.sources.star import star_table

# ---------------------------------------------------------------- files with odd records

# Sixteen files whatever the scale; odd ones in Latin-1, every other pair separated by commas.
# One record in eight each: too short, too long, blank, quoted with a line break, missing values. A
# few are 21,000 fields long. The last record of each third file opens a quote that nothing closes.
_ROWS = f"""
SELECT l_orderkey % 16 AS file, case when l_partkey % 8 = 1 and l_linenumber = 1 and l_orderkey % 997 = 0 then 9 else l_partkey % 8 end AS kind, ord,
  cast(l_partkey as string) AS k, cast(cast(l_quantity as bigint) as string) AS q
FROM (SELECT *, {RECORD_KEY} AS ord FROM {{lineitem}}) t"""
_LINES = f'''
SELECT file, kind, ord, case kind
    when 0 then k || ';' || q
    when 1 then k || ';' || q || ';a;b;c'
    when 2 then ''
    when 3 then k || ';"' || q || '.5,6;7";"diz ""oi""\\n\\n";x'
    when 9 then k || repeat(';', 20999)
    when 4 then k || ';NA;;null'
    else k || ';' || q || ';JOSÉ;x y' end AS line
FROM ({_ROWS}) r'''
_HEADER = "Cod ; Valor  da Venda;Nome;Nome"


def _write_odd_files(spark: SparkSession, folder: str) -> str:
    lines = spark.sql(_LINES, lineitem=star_table(spark, folder, "lineitem")).select("file", "ord", "line")
    last = lines.groupBy("file").agg(F.lit("~").alias("ord"), F.lit('k;"never closed;').alias("line")).filter("file % 3 = 0")
    lines = lines.union(last)
    bom = F.when(F.col("file") % 3 == 0, F.lit("﻿")).otherwise(F.lit(""))
    bom = F.when(F.col("file") % 2 == 0, bom).otherwise(F.lit(""))
    headers = lines.select("file").distinct().select("file", F.lit("").alias("ord"), F.concat(bom, F.lit(_HEADER)).alias("line"))
    swapped = F.when(F.col("file") % 4 >= 2, F.translate("line", ";,", ",;")).otherwise(F.col("line"))
    latin = F.encode(swapped, "ISO-8859-1").cast("string")
    out = new_folder(spark)
    # Lines are sorted in parts of bounded size and put together in blocks, so that the task of a file sorts few rows.
    line = F.when(F.col("file") % 2 == 1, latin).otherwise(swapped)
    lines = lines.union(headers).select("file", "ord", F.coalesce(line, F.lit("")).alias("line")).repartitionByRange("file", "ord").sortWithinPartitions("file", "ord")
    lines = lines.select("file", F.struct(F.monotonically_increasing_id().alias("at"), "line").alias("line"))
    text = F.array_join(F.sort_array(F.collect_list("line"))["line"], "\n").alias("text")
    blocks = lines.groupBy("file", F.shiftright("line.at", 16).alias("block")).agg(text)
    blocks.repartition("file").sortWithinPartitions("file", "block").select("file", "text").write.partitionBy("file").text(out)
    return out


def _file_number(path: str):
    return F.regexp_extract(path, r"/file=(\d+)/", 1).cast("bigint")


def _dialects(spark: SparkSession, folder: str) -> DataFrame:
    found = detect_dialects(spark, _write_odd_files(spark, folder))
    return found.select(_file_number("path").alias("file"), "encoding", "sep", F.array_join("repeated", ",").alias("repeated"))


def _records(spark: SparkSession, folder: str) -> DataFrame:
    records, _, _ = read_dirty_csv(
        spark, _write_odd_files(spark, folder), expected=["Cod", "Valor_da_Venda", "Nome", "Nome_1"]
    )
    return records.select(_file_number(FILE).alias("file"), "Cod", "Valor_da_Venda", "Nome", "Nome_1")


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejects, _ = read_dirty_csv(spark, _write_odd_files(spark, folder))
    return rejects.select(_file_number("path").alias("file"), "line_number", "n_fields", "raw_row")


_SWAP = "CASE WHEN file % 4 >= 2 THEN translate({0}, ';,', ',;') ELSE {0} END"
_ODD_ROWS = "WITH r AS (" + _plain(_ROWS) + ")"
_ODD_SQL = {
    "csv_dialects": f"""{_ODD_ROWS} SELECT file, CASE WHEN file % 2 = 1 AND max(kind) >= 5 THEN 'latin-1' ELSE 'utf-8-sig' END AS encoding,
        CASE WHEN file % 4 >= 2 THEN ',' ELSE ';' END AS sep, 'Nome' AS repeated FROM r GROUP BY file""",
    "csv_records": f"""{_ODD_ROWS} SELECT file, k AS Cod,
        CASE kind WHEN 4 THEN NULL WHEN 3 THEN {_SWAP.format("(q || '.5,6;7')")} ELSE q END AS Valor_da_Venda,
        CASE kind WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 3 THEN 'diz "oi"' || chr(10) || chr(10) ELSE 'JOSÉ' END AS Nome,
        CASE kind WHEN 0 THEN NULL WHEN 4 THEN NULL WHEN 3 THEN 'x' ELSE 'x y' END AS Nome_1
      FROM r WHERE kind NOT IN (1, 2, 9)
      UNION ALL SELECT DISTINCT file, 'k', {_SWAP.format("'never closed;'")}, NULL, NULL FROM r WHERE file % 3 = 0""",
    "csv_rejects": f"""{_ODD_ROWS} SELECT file, line_number, CASE kind WHEN 0 THEN 2 WHEN 1 THEN 5 WHEN 2 THEN 0 ELSE 21000 END AS n_fields,
        CASE kind WHEN 0 THEN k || '|' || q WHEN 1 THEN k || '|' || q || '|a|b|c' WHEN 2 THEN '' ELSE k || repeat('|', 20999) END AS raw_row
      FROM (SELECT *, 1 + row_number() OVER (PARTITION BY file ORDER BY ord) AS line_number FROM r) WHERE kind <= 2 OR kind = 9
      UNION ALL SELECT file, count(*) + 2, 2, 'k|' || {_SWAP.format("'never closed;'")} FROM r WHERE file % 3 = 0 GROUP BY file""",
}

# ---------------------------------------------------------------- load jobs, from files to table


def _load(table: str):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # The star's narrow rows are sorted, not the export's wide ones.
        order = RECORD_KEY if ORDER in EXPORTS[table] else "l_orderkey"
        lines = star_table(spark, folder, "lineitem").withColumn(ORDER, F.expr(order)).orderBy(ORDER)
        out = new_folder(spark)
        with setting(spark, *COMPILED):
            export = spark.sql(EXPORTS[table], lineitem=lines).drop(ORDER)
            export.write.csv(f"{out}/export", header=True, sep=";", emptyValue="")
        run_job(spark, table, f"{out}/export", Target(path=f"{out}/bronze"))
        columns = S.SCHEMAS[table].fieldNames()[1:]
        return Bronze.from_path(spark, f"{out}/bronze").table(table, columns)

    return run


def _row_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys after loading an export in two parts of several files each, the first of them twice."""
    export = _input(spark, folder, EXPORTS[S.HIST_SERVICOS])
    out = new_folder(spark)
    target = Target(path=f"{out}/bronze")
    halves = [F.pmod(F.xxhash64(*export.columns), F.lit(2)) == i for i in (0, 1)]
    for i, half in enumerate(halves):
        part = export.filter(half)
        # A large export comes in several files by itself.
        part = part if part.rdd.getNumPartitions() >= 3 else part.repartition(3)
        with setting(spark, *COMPILED):
            part.write.csv(f"{out}/export{i}", header=True, sep=";", emptyValue="")
    for i in (0, 1, 0):
        run_job(spark, S.HIST_SERVICOS, f"{out}/export{i}", target)
    return Bronze.from_path(spark, f"{out}/bronze").table(S.HIST_SERVICOS, ["ID_SERVICO"])


def _monthly_after_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly services after two loads: from the sums that the loads brought, and from the rows themselves."""
    export = _input(spark, folder, EXPORTS[S.HIST_SERVICOS])
    out = new_folder(spark)
    for i in (0, 1):
        half = export.filter(F.pmod(F.xxhash64(*export.columns), F.lit(2)) == i)
        half.write.csv(f"{out}/export{i}", header=True, sep=";", emptyValue="")
        run_job(spark, S.HIST_SERVICOS, f"{out}/export{i}", Target(path=f"{out}/bronze"))
    b = Bronze.from_path(spark, f"{out}/bronze")
    columns, period = ["DT", "COD_FILIAL", *AMOUNTS], (date(1992, 6, 15), date(1998, 12, 31))
    sides = [b.sums(columns, period, [SERVICO]).withColumn("FROM_SUMS", F.lit(True)), b.transactions(columns, period, [SERVICO]).withColumn("FROM_SUMS", F.lit(False))]
    keys = ["FROM_SUMS", F.trunc("DT", "MM").alias("MES"), "COD_FILIAL"]
    return sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in AMOUNTS])


def _monthly_sql() -> str:
    sources = {"QTD": "QTDE_SERVICOS", "RECEITA": "VALOR_TOTAL_SERVICO", "LUCRO": "LUCRO_SERVICO"}
    sums = ", ".join(f"CAST(sum(CAST(coalesce({source}, 0) AS DECIMAL(28, 2))) AS DOUBLE) AS {c}" for c, source in sources.items())
    return f"""SELECT FROM_SUMS, CAST(date_trunc('month', DT_REALIZACAO_SERVICO) AS DATE) AS MES, COD_FILIAL, {sums}
        FROM ({_load_sql(S.HIST_SERVICOS)}), (VALUES (true), (false)) s(FROM_SUMS)
        WHERE DT_REALIZACAO_SERVICO BETWEEN DATE '1992-06-15' AND DATE '1998-12-31' GROUP BY ALL"""


def _load_sql(table: str) -> str:
    spec = S.TABLES[table]
    kept = [f"{c} IS NOT NULL" for c in spec.required]
    kept += [f"({c} IS NULL OR length({c}) <= {n})" for c, n in spec.max_lengths.items()]
    return f"SELECT * FROM ({projection_rows_sql(table)}) WHERE {' AND '.join(kept)}"


def file_queries() -> dict:
    loads = {projection_name(t).replace("bronze_projection", "load"): _load(t) for t in EXPORTS}
    return {"csv_dialects": _dialects, "csv_records": _records, "csv_rejects": _rejects, "load_row_keys": _row_keys, "services_monthly_after_loads": _monthly_after_loads} | loads


def file_sql() -> dict[str, str]:
    keys = f"SELECT row_number() OVER () - 1 AS ID_SERVICO FROM ({_load_sql(S.HIST_SERVICOS)})"
    return _ODD_SQL | {"load_row_keys": keys, "services_monthly_after_loads": _monthly_sql()} | {projection_name(t).replace("bronze_projection", "load"): _load_sql(t) for t in EXPORTS}
