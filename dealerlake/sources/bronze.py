"""Scans of the five bronze tables, and the unified transaction fact built on them."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions.amounts import or_zero
from dealerlake.sources.manifest import Log

Period = tuple[date | None, date | None]

VEICULO, PECA, SERVICO = "VEICULO", "PECA", "SERVICO"


@dataclass(frozen=True)
class Line:
    """Where a line of business keeps the columns of the unified fact."""

    table: str
    columns: dict[str, str]


LINES: dict[str, Line] = {
    VEICULO: Line(
        S.HIST_VENDAS_VEICULOS,
        {
            "ID": "ID_VENDA_VEICULO",
            "DT": "DT_VENDA",
            "CLIENTE": "NOME_COMPRADOR",
            "VENDEDOR": "NOME_VENDEDOR",
            "QTD": "QTDE_VENDIDA",
            "RECEITA": "VALOR_VENDA",
            "LUCRO": "LUCRO_VENDA",
        },
    ),
    PECA: Line(
        S.HIST_VENDAS_PECAS,
        {
            "ID": "ID_VENDA_PECA",
            "DT": "DT_VENDA",
            "CLIENTE": "NOME_COMPRADOR",
            "VENDEDOR": "NOME_VENDEDOR",
            "QTD": "QTDE_VENDIDA",
            "RECEITA": "VALOR_VENDA",
            "LUCRO": "LUCRO_VENDA",
        },
    ),
    SERVICO: Line(
        S.HIST_SERVICOS,
        {
            "ID": "ID_SERVICO",
            "DT": "DT_REALIZACAO_SERVICO",
            "CLIENTE": "NOME_CLIENTE",
            "VENDEDOR": "NOME_VENDEDOR_SERVICO",
            "QTD": "QTDE_SERVICOS",
            "RECEITA": "VALOR_TOTAL_SERVICO",
            "LUCRO": "LUCRO_SERVICO",
        },
    ),
}


#: Columns of the sums per day and branch.
BRANCH_DAY = ("DT", "COD_CONCESSIONARIA", "COD_FILIAL", "NOME_FILIAL")
AMOUNTS = ("QTD", "RECEITA", "LUCRO")


def day_sums(rows: DataFrame, line: Line) -> DataFrame:
    """The amounts of a line's table per day and branch, missing ones as 0, exact."""
    keys = [F.col(line.columns.get(c, c)).alias(c) for c in BRANCH_DAY]
    amounts = [F.sum(or_zero(F.col(line.columns[c]).cast(S.MONEY))).cast(SUM).alias(c) for c in AMOUNTS]
    return rows.groupBy(*keys).agg(*amounts)


#: Type of a sum of amounts.
SUM = "decimal(28,2)"
_SUMS = "DT date, COD_CONCESSIONARIA string, COD_FILIAL string, NOME_FILIAL string, " + ", ".join(f"{c} {SUM}" for c in AMOUNTS)


def between(column, period: Period | None):
    """Inclusive date range as a condition; either end may be open."""
    lo, hi = period or (None, None)
    condition = F.lit(True)
    if lo is not None:
        condition = condition & (column >= F.lit(lo))
    if hi is not None:
        condition = condition & (column <= F.lit(hi))
    return condition


def id_range_query(name: str) -> str:
    """The lowest and highest row key of a table, as a table expression for a database."""
    key = S.TABLES[name].id
    return f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {name}) r"


def slice_options(name: str, partitions: int, bounds: tuple[int | None, int | None] | None) -> dict[str, str]:
    """Reader options for parallel id slices; none for one partition or an empty table."""
    if partitions <= 1 or bounds is None or bounds[0] is None:
        return {}
    lo, hi = bounds
    return {"partitionColumn": S.TABLES[name].id, "lowerBound": str(lo), "upperBound": str(hi), "numPartitions": str(partitions)}


class Bronze:
    """The five tables of one store. Every scan names its columns and period, so both reach the files."""

    # Type of quantities and money in the unified fact.
    amount = S.MONEY.simpleString()

    # Sums that loads brought of a table, and the rows of loads without; None where there are no sums.
    _open_sums: Callable[[str], tuple[DataFrame, DataFrame] | None] = staticmethod(lambda name: None)

    def __init__(self, open_table: Callable[[str], DataFrame], open_sums: Callable[[str], tuple[DataFrame, DataFrame] | None] | None = None):
        self._open = open_table
        if open_sums is not None:
            self._open_sums = open_sums

    @classmethod
    def from_frames(cls, frames: dict[str, DataFrame]) -> Bronze:
        return cls(frames.__getitem__)

    @classmethod
    def from_path(cls, spark: SparkSession, root: str) -> Bronze:
        """Folders named after the tables under ``root``, as the append sink writes them: the loads that its log knows. Plain Parquet folders
        without a log are read as they are."""

        def open_table(name: str) -> DataFrame:
            table = S.TABLES[name]
            schema = table.schema.add(S.MONTH_PARTITION, "integer") if table.date else table.schema
            log = Log.of(spark, root, name)
            return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}") if log is None else log.rows(spark, schema)

        def open_sums(name: str) -> tuple[DataFrame, DataFrame] | None:
            log = Log.of(spark, root, name)
            return log and (log.sums(spark, _SUMS), log.rows(spark, S.TABLES[name].schema.add(S.MONTH_PARTITION, "integer"), summed=False))

        return cls(open_table, open_sums)

    @classmethod
    def from_catalog(cls, spark: SparkSession, database: str = "default") -> Bronze:
        return cls(lambda name: spark.table(f"{database}.{name}"))

    @classmethod
    def from_jdbc(
        cls,
        spark: SparkSession,
        url: str,
        partitions: int = 8,
        bounds: dict[str, tuple[int, int]] | None = None,
        **options: str,
    ) -> Bronze:
        """Tables of a database, each read in ``partitions`` parallel id slices.

        The id ranges are ``bounds`` (table -> lowest and highest id); the database is asked for those not given.
        """
        known = dict(bounds or {})

        def reader(table: str):
            return spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)

        def open_table(name: str) -> DataFrame:
            if partitions > 1 and name not in known:
                known[name] = tuple(reader(id_range_query(name)).load().first())
            return reader(name).options(**slice_options(name, partitions, known.get(name))).load()

        return cls(open_table)

    def table(self, name: str, columns: Iterable[str], period: Period | None = None) -> DataFrame:
        """Columns of one table; ``period`` filters its event date."""
        df = self._open(name)
        if period is not None:
            df = df.filter(between(F.col(S.TABLES[name].date), period))
            if S.MONTH_PARTITION in df.columns:
                lo, hi = (None if d is None else d.year * 100 + d.month for d in period)
                df = df.filter(between(F.col(S.MONTH_PARTITION), (lo, hi)))
        return df.select(*columns)

    def query(self, spark: SparkSession, sql: str, args: dict[str, object] | None = None, **tables: tuple[str, list[str]]) -> DataFrame:
        """The rows of an SQL text with named binds: ``:name`` takes its value from ``args``, None being null, and ``{alias}`` stands for
        some columns of a table, ``alias=(table, columns)``."""
        return spark.sql(sql, args=args, **{alias: self.table(name, columns) for alias, (name, columns) in tables.items()})

    def transactions(
        self, columns: Iterable[str], period: Period | None = None, origins: Iterable[str] = tuple(LINES)
    ) -> DataFrame:
        """The lines as one fact: ORIGEM plus the asked columns, missing amounts as 0."""
        parts = []
        columns = list(columns)
        for origin in origins:
            line = LINES[origin]
            source = {c: line.columns.get(c, c) for c in columns}
            df = self.table(line.table, list(dict.fromkeys(source.values())), period)
            parts.append(
                df.select(
                    F.lit(origin).alias("ORIGEM"),
                    *[self._unified(source[c], c).alias(c) for c in columns],
                )
            )
        return reduce(DataFrame.unionByName, parts)

    def sums(self, columns: Iterable[str], period: Period | None = None, origins: Iterable[str] = tuple(LINES)) -> DataFrame:
        """Rows whose amounts add up like those of ``transactions``: ORIGEM plus columns of BRANCH_DAY and AMOUNTS. For queries that sum only, and
        count no rows.

        In a folder they are the sums per day and branch that each load brought, a row per load, day and branch instead of one per transaction,
        plus the rows of loads without. Elsewhere they are the transactions.
        """
        columns, parts = list(columns), []
        held = {origin: self._open_sums(LINES[origin].table) for origin in origins}
        plain = [origin for origin, found in held.items() if found is None]
        if plain:
            parts.append(self.transactions(columns, period, plain))
        for origin, found in held.items():
            if found is not None:
                sums, rows = found
                parts.append(sums.filter(between(F.col("DT"), period)).select(F.lit(origin).alias("ORIGEM"), *columns))
                parts.append(Bronze.from_frames({LINES[origin].table: rows}).transactions(columns, period, [origin]))
        return reduce(DataFrame.unionByName, parts)

    def _unified(self, source: str, name: str) -> Column:
        if name in ("QTD", "RECEITA", "LUCRO"):
            return or_zero(F.col(source).cast(self.amount))
        return F.col(source)
