"""The five bronze tables as views over an order/lineitem star schema.

Lets every query run on the given parquet tables. A scan joins only the dimensions that the asked
columns need; the joins are left joins on unique keys, so leaving one out never changes the rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealerlake import schemas as S
from dealerlake.sources.bronze import LINES, PECA, SERVICO, VEICULO, Bronze, Period

STAR_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
}

# Which l_returnflag holds which line of business.
ORIGIN_FLAG = {VEICULO: "A", PECA: "N", SERVICO: "R"}


def star_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One star table under its declared schema (no footer scan to infer it)."""
    return spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


_DISCOUNT = "cast(l_discount as decimal(4,2))"
_PRICE = "cast(l_extendedprice as decimal(18,2))"
_SHIP_DAY = "cast(l_shipdate as date)"
_BRANCH_CODE = "concat_ws('-', cast(n_regionkey as string), cast(n_nationkey as string))"

# Fact column -> (SQL expression, dimensions it needs).
_LINE_COLUMNS: dict[str, tuple[str, tuple[str, ...]]] = {
    "ID": (
        "concat_ws('-', cast(l_orderkey as string), cast(l_linenumber as string), cast(l_partkey as string), "
        f"cast(l_suppkey as string), cast(cast(l_quantity as int) as string), cast({_SHIP_DAY} as string))",
        (),
    ),
    "COD_CONCESSIONARIA": ("cast(n_regionkey as string)", ("supplier", "nation")),
    "COD_FILIAL": (_BRANCH_CODE, ("supplier", "nation")),
    "NOME_FILIAL": ("n_name", ("supplier", "nation")),
    "DT": (_SHIP_DAY, ()),
    "CLIENTE": ("c_name", ("orders", "customer")),
    "VENDEDOR": ("s_name", ("supplier",)),
    "QTD": ("cast(l_quantity as decimal(18,4))", ()),
    "RECEITA": (f"cast({_PRICE} * (1 - {_DISCOUNT}) as decimal(18,4))", ()),
    "LUCRO": (f"cast({_PRICE} * (0.08 - {_DISCOUNT}) as decimal(18,4))", ()),
    "MARCA_VEICULO": ("p_brand", ("part",)),
    "MODELO_VEICULO": ("p_name", ("part",)),
    "DESCRICAO_PECA": ("p_name", ("part",)),
    "CATEGORIA_PECA": ("p_type", ("part",)),
    "DEPARTAMENTO_SERVICO": ("o_orderpriority", ("orders",)),
    "CATEGORIA_SERVICO": ("p_type", ("part",)),
    "DIAS_EM_ESTOQUE": (f"cast(datediff({_SHIP_DAY}, cast(o_orderdate as date)) as bigint)", ("orders",)),
}

# Dimension -> (key on its parent, its own key, parent). Orders, part and supplier hang on lineitem.
_DIMENSIONS = {
    "customer": ("o_custkey", "c_custkey", "orders"),
    "nation": ("s_nationkey", "n_nationkey", "supplier"),
    "orders": ("l_orderkey", "o_orderkey", "lineitem"),
    "part": ("l_partkey", "p_partkey", "lineitem"),
    "supplier": ("l_suppkey", "s_suppkey", "lineitem"),
}


class StarBronze(Bronze):
    """Bronze tables derived from the star tables in ``folder``."""

    # Discounted prices have four decimals.
    amount = "decimal(18,4)"

    def __init__(self, spark: SparkSession, folder: str, as_of: date):
        self._spark, self._folder, self._as_of = spark, folder, as_of

    def _star(self, name: str) -> DataFrame:
        return star_table(self._spark, self._folder, name)

    def _lines(self, columns: Iterable[str], period: Period | None) -> DataFrame:
        df = self._star("lineitem")
        lo, hi = period or (None, None)
        if lo is not None:
            df = df.filter(F.col("l_shipdate") >= F.lit(str(lo)).cast(T.TimestampNTZType()))
        if hi is not None:
            df = df.filter(F.col("l_shipdate") < F.lit(str(hi + timedelta(days=1))).cast(T.TimestampNTZType()))
        needed = {d for c in columns for d in _LINE_COLUMNS[c][1]}
        # Customer and nation are joined to the small side first, so lineitem is shuffled once per branch.
        sides = {name: self._star(name) for name in needed}
        sides["lineitem"] = df
        for dimension, (left, right, parent) in _DIMENSIONS.items():
            if dimension in needed:
                sides[parent] = sides[parent].join(sides[dimension], F.col(left) == F.col(right), "left")
        return sides["lineitem"]

    def transactions(
        self, columns: Iterable[str], period: Period | None = None, origins: Iterable[str] = tuple(LINES)
    ) -> DataFrame:
        """One scan for all lines: they are told apart by the return flag."""
        columns = list(columns)
        flags = {name: ORIGIN_FLAG[name] for name in origins}
        flag = F.col("l_returnflag")
        origin = F.lit(None).cast("string")
        for name, value in flags.items():
            origin = F.when(flag == value, name).otherwise(origin)
        return (
            self._lines(columns, period)
            .filter(flag.isin(*flags.values()))
            .select(origin.alias("ORIGEM"), *[F.expr(_LINE_COLUMNS[c][0]).alias(c) for c in columns])
        )

    def table(self, name: str, columns: Iterable[str], period: Period | None = None) -> DataFrame:
        columns = list(columns)
        for origin, line in LINES.items():
            if line.table == name:
                unified = {source: fact for fact, source in line.columns.items()}
                facts = [unified.get(c, c) for c in columns]
                df = self._lines(facts, period).filter(F.col("l_returnflag") == ORIGIN_FLAG[origin])
                return df.select(*[F.expr(_LINE_COLUMNS[f][0]).alias(c) for f, c in zip(facts, columns)])
        if name == S.ESTOQUE_PECAS:
            return self._part_stock(columns)
        return self._vehicle_stock(columns)

    def _stock(self, columns: list[str], expressions: dict[str, str], df: DataFrame) -> DataFrame:
        branch = {
            "COD_CONCESSIONARIA": "cast(n_regionkey as string)",
            "COD_FILIAL": _BRANCH_CODE,
            "NOME_FILIAL": "n_name",
        }
        if set(columns) & set(branch):
            df = df.join(self._star("nation"), F.col("p_partkey") % 25 == F.col("n_nationkey"), "left")
        expressions = expressions | branch
        return df.select(*[F.expr(expressions[c]).alias(c) for c in columns])

    def _part_stock(self, columns: list[str]) -> DataFrame:
        expressions = {
            "ID_ESTOQUE_PECA": "p_partkey",
            "VALOR_PECA_ESTOQUE": "cast(p_retailprice as decimal(18,2))",
            "QTDE_PECA_ESTOQUE": "cast(p_size % 5 as decimal(18,2))",
            "DESCRICAO_PECA": "p_name",
            "CATEGORIA_PECA": "p_type",
            "CODIGO_PECA_ESTOQUE": "cast(p_partkey as string)",
            "PECA_OBSOLETA_FLAG": "case when p_size >= 48 then 'SIM' else 'NAO' end",
            "DT_ULTIMA_VENDA_PECA": "last_sale",
            "TEMPO_OBSOLETA_DIAS": f"cast(datediff(date'{self._as_of}', last_sale) as bigint)",
        }
        df = self._star("part")
        if {"DT_ULTIMA_VENDA_PECA", "TEMPO_OBSOLETA_DIAS"} & set(columns):
            last = self._star("lineitem").groupBy("l_partkey").agg(F.max(F.expr(_SHIP_DAY)).alias("last_sale"))
            df = df.join(last, F.col("p_partkey") == F.col("l_partkey"), "left")
        return self._stock(columns, expressions, df)

    def _vehicle_stock(self, columns: list[str]) -> DataFrame:
        expressions = {
            "ID_ESTOQUE_VEICULO": "p_partkey",
            "CUSTO_VEICULO": "cast(cast(p_retailprice as decimal(18,2)) * 10 as decimal(18,2))",
            "TEMPO_TOTAL_ESTOQUE_DIAS": "cast(p_size * 10 as bigint)",
        }
        return self._stock(columns, expressions, self._star("part").filter(F.col("p_type").isin("LARGE", "PROMO")))
