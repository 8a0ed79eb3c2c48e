"""The five bronze tables: columns, types, which are required, and what they mean."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

ESTOQUE_PECAS = "BRZ_ESTOQUE_PECAS"
ESTOQUE_VEICULOS = "BRZ_ESTOQUE_VEICULOS"
HIST_SERVICOS = "BRZ_HIST_SERVICOS"
HIST_VENDAS_PECAS = "BRZ_HIST_VENDAS_PECAS"
HIST_VENDAS_VEICULOS = "BRZ_HIST_VENDAS_VEICULOS"

MONEY = T.DecimalType(18, 2)
MARGIN = T.DecimalType(9, 4)

# Partition column the append sink adds to the dated tables (yyyymm of the event date).
MONTH_PARTITION = "ANO_MES"


@dataclass(frozen=True)
class Table:
    """One bronze table: surrogate key, event date (dated tables only), unique key if any, columns."""

    name: str
    id: str
    columns: tuple[tuple[str, T.DataType, int | None, bool, str], ...]
    date: str | None = None
    unique: str | None = None

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(self.id, T.LongType(), False, {"comment": "row key, stable per source record"})]
        for name, dtype, length, required, comment in self.columns:
            meta: dict = {"comment": comment}
            if length is not None:
                meta["max_length"] = length
            fields.append(T.StructField(name, dtype, not required, meta))
        return T.StructType(fields)

    @property
    def required(self) -> list[str]:
        return [c[0] for c in self.columns if c[3]]

    @property
    def max_lengths(self) -> dict[str, int]:
        return {c[0]: c[2] for c in self.columns if c[2] is not None}


def _text(name: str, length: int, comment: str, required: bool = False):
    return (name, T.StringType(), length, required, comment)


def _money(name: str, comment: str):
    return (name, MONEY, None, False, comment)


def _long(name: str, comment: str):
    return (name, T.LongType(), None, False, comment)


def _year(name: str, comment: str):
    return (name, T.IntegerType(), None, False, comment)


def _date(name: str, comment: str, required: bool = False):
    return (name, T.DateType(), None, required, comment)


_BRANCH = (
    _text("COD_CONCESSIONARIA", 10, "dealer group code", True),
    _text("COD_FILIAL", 10, "branch code inside the group", True),
    _text("NOME_CONCESSIONARIA", 100, "dealer group"),
    _text("NOME_FILIAL", 100, "branch"),
)
_BRAND = (_text("MARCA_FILIAL", 50, "brand the branch represents"),)

TABLES: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            ESTOQUE_PECAS,
            "ID_ESTOQUE_PECA",
            (
                *_BRANCH,
                *_BRAND,
                _money("VALOR_PECA_ESTOQUE", "stock value of the part line"),
                _money("QTDE_PECA_ESTOQUE", "units on hand"),
                _text("DESCRICAO_PECA", 200, "part"),
                _text("CATEGORIA_PECA", 100, "part category"),
                _date("DT_ULTIMA_VENDA_PECA", "last time the part sold"),
                _date("DT_ULTIMA_ENTRADA_PECA", "last time the part came in"),
                _text("PECA_OBSOLETA_FLAG", 3, "SIM when marked obsolete, else NAO"),
                _long("TEMPO_OBSOLETA_DIAS", "days without movement"),
                _text("MARCA_PECA", 100, "part maker"),
                _text("CODIGO_PECA_ESTOQUE", 50, "stock code of the part"),
            ),
        ),
        Table(
            ESTOQUE_VEICULOS,
            "ID_ESTOQUE_VEICULO",
            (
                *_BRANCH,
                *_BRAND,
                _money("CUSTO_VEICULO", "what the vehicle cost"),
                _text("MARCA_VEICULO", 50, "make"),
                _text("MODELO_VEICULO", 100, "model"),
                _text("COR_VEICULO", 50, "colour"),
                _text("VEICULO_NOVO_SEMINOVO", 20, "new or used"),
                _text("TIPO_COMBUSTIVEL", 30, "fuel"),
                _year("ANO_MODELO", "model year"),
                _year("ANO_FABRICACAO", "year built"),
                _text("CHASSI_VEICULO", 50, "chassis number, unique when present"),
                _long("TEMPO_TOTAL_ESTOQUE_DIAS", "days on the lot"),
                _long("KM_ATUAL", "odometer"),
                _text("PLACA_VEICULO", 20, "plate"),
                _date("DT_ENTRADA_ESTOQUE", "day it entered stock"),
            ),
            unique="CHASSI_VEICULO",
        ),
        Table(
            HIST_SERVICOS,
            "ID_SERVICO",
            (
                *_BRANCH,
                _date("DT_REALIZACAO_SERVICO", "day of the service", True),
                _long("QTDE_SERVICOS", "services in the record"),
                _money("VALOR_TOTAL_SERVICO", "revenue"),
                _money("LUCRO_SERVICO", "profit"),
                _text("DESCRICAO_SERVICO", 200, "what was done"),
                _text("SECAO_SERVICO", 100, "workshop section"),
                _text("DEPARTAMENTO_SERVICO", 100, "department"),
                _text("CATEGORIA_SERVICO", 100, "service category"),
                _text("NOME_VENDEDOR_SERVICO", 100, "who sold it"),
                _text("NOME_MECANICO", 100, "who did it"),
                _text("NOME_CLIENTE", 150, "customer"),
            ),
            date="DT_REALIZACAO_SERVICO",
        ),
        Table(
            HIST_VENDAS_PECAS,
            "ID_VENDA_PECA",
            (
                *_BRANCH,
                *_BRAND,
                _date("DT_VENDA", "day of the sale", True),
                _money("QTDE_VENDIDA", "units sold"),
                _text("TIPO_TRANSACAO", 50, "kind of transaction"),
                _money("VALOR_VENDA", "revenue"),
                _money("CUSTO_PECA", "cost"),
                _money("LUCRO_VENDA", "profit"),
                ("MARGEM_VENDA", MARGIN, None, False, "margin as exported"),
                _text("DESCRICAO_PECA", 200, "part"),
                _text("CATEGORIA_PECA", 100, "part category"),
                _text("DEPARTAMENTO_VENDA", 100, "department"),
                _text("TIPO_VENDA_PECA", 100, "sales channel"),
                _text("NOME_VENDEDOR", 100, "salesperson"),
                _text("NOME_COMPRADOR", 150, "buyer"),
                _text("CIDADE_VENDA", 100, "city"),
                _text("ESTADO_VENDA", 50, "state"),
                _text("MACROREGIAO_VENDA", 50, "macro-region"),
            ),
            date="DT_VENDA",
        ),
        Table(
            HIST_VENDAS_VEICULOS,
            "ID_VENDA_VEICULO",
            (
                *_BRANCH,
                *_BRAND,
                _date("DT_VENDA", "day of the sale", True),
                _long("QTDE_VENDIDA", "units sold"),
                _text("TIPO_TRANSACAO", 50, "kind of transaction"),
                _money("VALOR_VENDA", "revenue"),
                _money("CUSTO_VEICULO", "cost"),
                _money("LUCRO_VENDA", "profit"),
                ("MARGEM_VENDA", MARGIN, None, False, "margin as exported"),
                _text("MARCA_VEICULO", 50, "make"),
                _text("MODELO_VEICULO", 100, "model"),
                _text("FAMILIA_VEICULO", 100, "model family"),
                _text("CATEGORIA_VEICULO", 100, "segment"),
                _text("COR_VEICULO", 50, "colour"),
                _text("VEICULO_NOVO_SEMINOVO", 20, "new or used"),
                _text("TIPO_COMBUSTIVEL", 30, "fuel"),
                _year("ANO_MODELO", "model year"),
                _year("ANO_FABRICACAO", "year built"),
                _text("CHASSI_VEICULO", 50, "chassis number"),
                _long("DIAS_EM_ESTOQUE", "days in stock before the sale"),
                _text("TIPO_VENDA_VEICULO", 100, "sales channel"),
                _text("NOME_VENDEDOR", 100, "salesperson"),
                _text("NOME_COMPRADOR", 150, "buyer"),
                _text("CIDADE_VENDA", 100, "city"),
                _text("ESTADO_VENDA", 50, "state"),
                _text("MACROREGIAO_VENDA", 50, "macro-region"),
            ),
            date="DT_VENDA",
        ),
    )
}

SCHEMAS: dict[str, T.StructType] = {name: table.schema for name, table in TABLES.items()}


def create_tables(spark: SparkSession, database: str = "default") -> None:
    """Declare the five tables in the catalog; dated ones are partitioned by month."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES.values():
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()} COMMENT '{f.metadata['comment']}'" for f in table.schema
        )
        month = f", {MONTH_PARTITION} INT COMMENT 'yyyymm of {table.date}'" if table.date else ""
        layout = f" PARTITIONED BY ({MONTH_PARTITION})" if table.date else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table.name} ({columns}{month}) USING parquet{layout}")
