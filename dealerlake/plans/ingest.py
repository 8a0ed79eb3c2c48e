"""The five load jobs: CSV exports to bronze tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.functions import clean
from dealerlake.operators import cleaning
from dealerlake.session import COMPILED, setting, written
from dealerlake.sources.csv import FILE, NAME, PLACE, REFUSED, ROW, SPLIT, Load, load_files, numbered, row_numbered
from dealerlake.sources.manifest import Log
from dealerlake.sources.sink import Target, append_bronze, loaded_files, log_of, next_id, stored_keys

Rule = Callable[[Column], Column]


def _margin(c: Column) -> Column:
    return clean.locale_number(c, S.MARGIN)


def _year(c: Column) -> Column:
    return clean.integer(c, "int")


def _state(c: Column) -> Column:
    return clean.one_of(c, clean.STATES)


def _region(c: Column) -> Column:
    return clean.one_of(c, clean.REGIONS)


def _as_is(c: Column) -> Column:
    return c


_BRANCH_TEXT = {
    "COD_CONCESSIONARIA": ("Cod_Concessionaria", _as_is),
    "COD_FILIAL": ("Cod_Filial", _as_is),
    "NOME_CONCESSIONARIA": ("Nome_da_Concessionaria", _as_is),
    "NOME_FILIAL": ("Nome_da_Filial", _as_is),
    "MARCA_FILIAL": ("Marca_da_Filial", _as_is),
}

# Bronze column -> (export column, rule on its trimmed text). Bronze columns not named stay null.
MAPPINGS: dict[str, dict[str, tuple[str, Rule]]] = {
    S.ESTOQUE_PECAS: {
        **_BRANCH_TEXT,
        "VALOR_PECA_ESTOQUE": ("Valor_da_Peca_em_Estoque", clean.strict_number),
        "QTDE_PECA_ESTOQUE": ("Quantidade_da_Peca_em_Estoque", clean.strict_number),
        "DESCRICAO_PECA": ("Descricao_da_Peca", _as_is),
        "CATEGORIA_PECA": ("Categoria_da_Peca", _as_is),
        "DT_ULTIMA_VENDA_PECA": ("Data_de_Ultima_Venda_da_Peca", clean.iso_date),
        "DT_ULTIMA_ENTRADA_PECA": ("Data_da_Ultima_Entrada_no_Estoque_da_Peca", clean.iso_date),
        "PECA_OBSOLETA_FLAG": ("Peca_Esta_Obsoleta", clean.flag),
        "MARCA_PECA": ("Nome_da_Marca_da_Peca", _as_is),
        "CODIGO_PECA_ESTOQUE": ("Codigo_da_Peca_no_Estoque", _as_is),
    },
    S.ESTOQUE_VEICULOS: {
        # Both codes are derived from the names before the mapping.
        **_BRANCH_TEXT,
        "COD_CONCESSIONARIA": ("COD_CONCESSIONARIA", _as_is),
        "COD_FILIAL": ("COD_FILIAL", _as_is),
        "CUSTO_VEICULO": ("Custo_do_Veiculo", clean.locale_number),
        "MARCA_VEICULO": ("Marca_do_Veiculo", _as_is),
        "MODELO_VEICULO": ("Modelo_do_Veiculo", _as_is),
        "COR_VEICULO": ("Cor_do_Veiculo", _as_is),
        "VEICULO_NOVO_SEMINOVO": ("Veiculo_Novo_ou_Semi_Novo", _as_is),
        "TIPO_COMBUSTIVEL": ("Tipo_do_Combustivel", _as_is),
        "ANO_MODELO": ("Ano_Modelo_do_Veiculo", _year),
        "ANO_FABRICACAO": ("Ano_Fabricacao_do_Veiculo", _year),
        "CHASSI_VEICULO": ("Chassi_do_Veiculo", _as_is),
        "TEMPO_TOTAL_ESTOQUE_DIAS": ("Tempo_Total_no_Estoque", clean.age_days),
        "KM_ATUAL": ("Kilometragem_Atual_do_Veiculo", clean.integer),
        "PLACA_VEICULO": ("Placa_do_Veiculo", _as_is),
        "DT_ENTRADA_ESTOQUE": ("Data_de_Entrada_do_Veiculo_no_Estoque", clean.br_date),
    },
    S.HIST_SERVICOS: {
        "COD_CONCESSIONARIA": ("Cod_Concessionaria", _as_is),
        "COD_FILIAL": ("Cod_Filial", _as_is),
        "NOME_CONCESSIONARIA": ("Nome_Da_Concessionaria", _as_is),
        "NOME_FILIAL": ("Nome_Da_Filial", _as_is),
        "DT_REALIZACAO_SERVICO": ("Data_De_Realizacao_Do_Servico", clean.iso_date),
        "QTDE_SERVICOS": ("Quantidade_De_Servicos_Realizados", clean.strict_integer),
        "VALOR_TOTAL_SERVICO": ("Valor_Total_Do_Servico_Realizado", clean.strict_number),
        "LUCRO_SERVICO": ("Lucro_Do_Servico", clean.strict_number),
        "DESCRICAO_SERVICO": ("Descricao_Do_Servico_Feito", _as_is),
        "SECAO_SERVICO": ("Secao_Que_O_Servico_Foi_Feito", _as_is),
        "DEPARTAMENTO_SERVICO": ("Departamento_Que_Realizou_O_Servico", _as_is),
        "CATEGORIA_SERVICO": ("Categoria_Do_Servico", _as_is),
        "NOME_VENDEDOR_SERVICO": ("Nome_Do_Vendedor_Que_Vendeu_O_Servico", _as_is),
        "NOME_MECANICO": ("Nome_Do_Mecanico_Que_Fez_O_Servico", _as_is),
        "NOME_CLIENTE": ("Nome_Do_Cliente_Que_Fez_O_Servico", _as_is),
    },
    S.HIST_VENDAS_PECAS: {
        **_BRANCH_TEXT,
        "DT_VENDA": ("Data_da_Venda", clean.iso_date),
        "QTDE_VENDIDA": ("Quantidade_Vendida", clean.locale_number),
        "TIPO_TRANSACAO": ("Tipo_de_Transacao", _as_is),
        "VALOR_VENDA": ("Valor_da_Venda", clean.locale_number),
        "CUSTO_PECA": ("Custo_da_Peca", clean.locale_number),
        "LUCRO_VENDA": ("Lucro_da_Venda", clean.locale_number),
        "MARGEM_VENDA": ("Margem_da_Venda", _margin),
        "DESCRICAO_PECA": ("Descricao_da_Peca", _as_is),
        "CATEGORIA_PECA": ("Categoria_da_Peca", _as_is),
        "DEPARTAMENTO_VENDA": ("Departamento_da_Venda", _as_is),
        "TIPO_VENDA_PECA": ("Tipo_de_Venda_da_Peca", _as_is),
        "NOME_VENDEDOR": ("Nome_do_Vendedor_que_Realizou_a_Venda", clean.fix_mojibake),
        "NOME_COMPRADOR": ("Nome_do_Comprador_da_Peca", clean.fix_mojibake),
        "CIDADE_VENDA": ("Cidade_da_Venda", _as_is),
        "ESTADO_VENDA": ("Estado_Brasileiro_da_Venda", _state),
        "MACROREGIAO_VENDA": ("Macroregiao_Geografica_da_Venda", _as_is),
    },
    S.HIST_VENDAS_VEICULOS: {
        **_BRANCH_TEXT,
        "COD_FILIAL": ("COD_FILIAL", _as_is),
        "DT_VENDA": ("Data_da_Venda", clean.br_date),
        "QTDE_VENDIDA": ("Quantidade_Vendida", clean.integer),
        "TIPO_TRANSACAO": ("Tipo_de_Transacao", _as_is),
        "VALOR_VENDA": ("Valor_da_Venda", clean.locale_number),
        "CUSTO_VEICULO": ("Custo_do_Veiculo", clean.locale_number),
        "LUCRO_VENDA": ("Lucro_da_Venda", clean.locale_number),
        "MARGEM_VENDA": ("Margem_da_Venda", _margin),
        "MARCA_VEICULO": ("Marca_do_Veiculo", _as_is),
        "MODELO_VEICULO": ("Modelo_do_Veiculo", _as_is),
        "FAMILIA_VEICULO": ("Familia_do_Veiculo", _as_is),
        "CATEGORIA_VEICULO": ("Categoria_do_Veiculo", _as_is),
        "COR_VEICULO": ("Cor_do_Veiculo", _as_is),
        "VEICULO_NOVO_SEMINOVO": ("Veiculo_Novo_ou_Semi_Novo", _as_is),
        "TIPO_COMBUSTIVEL": ("Tipo_do_Combustivel", _as_is),
        "ANO_MODELO": ("Ano_Modelo_do_Veiculo", _year),
        "ANO_FABRICACAO": ("Ano_Fabricacao_do_Veiculo", _year),
        "CHASSI_VEICULO": ("Chassi_do_Veiculo", _as_is),
        "DIAS_EM_ESTOQUE": ("Dias_que_o_Carro_Ficou_no_Estoque", clean.integer),
        "TIPO_VENDA_VEICULO": ("Tipo_de_Venda_do_Veiculo", _as_is),
        "NOME_VENDEDOR": ("Nome_do_Vendedor_que_Realizou_a_Venda", clean.fix_mojibake),
        "NOME_COMPRADOR": ("Nome_do_Comprador_do_Veiculo", clean.fix_mojibake),
        "CIDADE_VENDA": ("Cidade_da_Venda", _as_is),
        "ESTADO_VENDA": ("Estado_Brasileiro_da_Venda", _state),
        "MACROREGIAO_VENDA": ("Macroregiao_Geografica_da_Venda", _region),
    },
}

# What makes two exported stock vehicles the same one.
VEHICLE_IDENTITY = (
    "Nome_da_Concessionaria",
    "Nome_da_Filial",
    "Marca_do_Veiculo",
    "Modelo_do_Veiculo",
    "Cor_do_Veiculo",
    "Ano_Modelo_do_Veiculo",
    "Ano_Fabricacao_do_Veiculo",
    "Data_de_Entrada_do_Veiculo_no_Estoque",
)

# Export columns that carry nothing usable in a vehicle sale whose columns slid by one.
SHIFTED_AWAY = (
    "Tipo_de_Venda_do_Veiculo",
    "Nome_do_Vendedor_que_Realizou_a_Venda",
    "Nome_do_Comprador_do_Veiculo",
    "Cidade_da_Venda",
    "Estado_Brasileiro_da_Venda",
    "Macroregiao_Geografica_da_Venda",
)

ORDER = "_order"

#: Tables in which a row depends on others: repeats are dropped.
DEPENDENT = (S.ESTOQUE_VEICULOS,)


def _with_columns(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns, null where it lacked them."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def restructured(table: str, df: DataFrame) -> DataFrame:
    """Repairs of the export's columns and rows that come before the mapping."""
    if table == S.ESTOQUE_VEICULOS:
        df = cleaning.coalesce_duplicate_columns(df, "Data_de_Entrada_do_Veiculo_no_Estoque")
        if ORDER in df.columns:
            numbered_rows = dict(df.dtypes)[ORDER] == "bigint"
            df = (cleaning.dedupe_numbered if numbered_rows else cleaning.dedupe_keep_first)(df, ORDER, VEHICLE_IDENTITY)
        df = _with_columns(df, "Nome_da_Concessionaria", "Nome_da_Filial")
        return cleaning.derive_branch_codes(df, "Nome_da_Concessionaria", "Nome_da_Filial")
    if table == S.HIST_VENDAS_PECAS:
        return cleaning.default_zero(df, "Margem_da_Venda")
    if table == S.HIST_VENDAS_VEICULOS:
        df = cleaning.drop_unnamed_columns(df)
        df = _with_columns(df, "Cod_Concessionaria", "Cod_Filial", "Nome_da_Filial", "Dias_que_o_Carro_Ficou_no_Estoque")
        df = cleaning.clean_strings(df, "Cod_Concessionaria", "Nome_da_Filial")
        derived = clean.branch_code(F.col("Nome_da_Filial"), F.col("Cod_Concessionaria"))
        df = df.withColumn("COD_FILIAL", F.coalesce(derived, F.col("Cod_Filial")))
        return cleaning.repair_shifted_rows(df, "Dias_que_o_Carro_Ficou_no_Estoque", "Chassi_do_Veiculo", SHIFTED_AWAY)
    return df


def bronze_projection(table: str, df: DataFrame, *keep: str) -> DataFrame:
    """Typed bronze columns of a restructured export, plus the columns in ``keep``."""
    mapping = {name: pair for name, pair in MAPPINGS[table].items() if pair[0] in df.columns}
    trimmed = df.select(*keep, *[clean.text(F.col(c)).alias(c) for c in dict.fromkeys(c for c, _ in mapping.values())])
    columns = []
    for field in S.SCHEMAS[table].fields[1:]:
        source, rule = mapping.get(field.name, (None, None))
        value = F.lit(None) if source is None else rule(F.col(source))
        columns.append(value.cast(field.dataType).alias(field.name))
    return trimmed.select(*keep, *columns)


def transform(table: str, df: DataFrame, *keep: str) -> DataFrame:
    """Export rows to typed bronze rows, before the contract."""
    return bronze_projection(table, restructured(table, df), *keep)


@dataclass(frozen=True)
class JobReport:
    """Record counts of a load: parsed, left after duplicates, refused by the contract, written. All are counted in written tables."""

    read: int
    deduped: int
    rejected: int
    written: int


def _unique_first(rows: DataFrame, key: str, stored: DataFrame | None) -> DataFrame:
    """``rows`` in which a repeated ``key`` gets a REASON: all but the first valid one of the load, and those in ``stored``.

    A missing key is never a repeat, and such rows take no part in the joins.
    """
    present = F.col(key).isNotNull() & F.col("REASON").isNull()
    first = rows.filter(present).groupBy(key).agg(F.min(ORDER).alias("_first"))
    taken = first if stored is None else first.join(stored.select(F.col(key).alias("_taken")).distinct(), F.col(key) == F.col("_taken"), "left")
    repeated = F.col(ORDER) != F.col("_first")
    repeated = repeated if stored is None else repeated | F.col("_taken").isNotNull()
    judged = rows.filter(present).join(taken, key).withColumn("REASON", F.when(repeated, F.lit(f"repeats: {key}")))
    return judged.select(*rows.columns).unionByName(rows.filter(~present))


def _judged(table: str, rows: DataFrame) -> DataFrame:
    spec = S.TABLES[table]
    return rows.withColumn("REASON", cleaning.contract_reason(spec.required, spec.max_lengths))


def _by_rows(table: str) -> Callable[[DataFrame, tuple[str, ...]], DataFrame]:
    """Records to typed rows one by one, with the reason why one is refused."""
    return lambda records, kept: _judged(table, transform(table, records, *kept))


def _across_rows(load: Load, table: str, target: Target, log: Log | None) -> tuple[DataFrame, DataFrame, int, int]:
    """Of a table whose rows depend on each other, the (rows, refused rows, number of rows, number refused), each written: repeats are
    left out, and a unique value is admitted once."""
    spec, spark = S.TABLES[table], load.rows.sparkSession
    records = numbered(load, ORDER, 0).drop(FILE, SPLIT, NAME, PLACE, "n", "_ahead", "first_place")
    rows = written(_judged(table, transform(table, records, ORDER)))
    if spec.unique is not None:
        keys = rows.where(F.col("REASON").isNull() & F.col(spec.unique).isNotNull()).select(spec.unique)
        rows = written(_unique_first(rows, spec.unique, stored_keys(keys, table, target, log)))
    sizes = {r["refused"]: r["count"] for r in rows.groupBy(F.col("REASON").isNotNull().alias("refused")).count().collect()}
    return rows.where("REASON IS NULL"), rows.where("REASON IS NOT NULL"), sizes.get(False, 0), sizes.get(True, 0)


def run_job(
    spark: SparkSession,
    table: str,
    paths: str | Sequence[str],
    target: Target,
    *,
    rejects_path: str | None = None,
) -> JobReport:
    """Loads CSV files into a bronze table.

    The lines are scanned once; see ``load_files``. Typed rows are written to the shared
    folder, and from there to the table, in which they get the next unused keys without gaps. Files that have been
    loaded before (same path, size and time) are left out, so a load can be run again; a table's unique column admits each
    value once. In a folder, rows, files and keys count at once when the load is published, and of two loads at a time one fails; see ``append_bronze``.
    Odd records, if there are any, are listed under ``rejects_path``, or under ``_rejects`` in the folder of the tables; with ``rejects_path`` the
    rows refused by the contract, too.
    """
    with setting(spark, *COMPILED):
        return _run_job(spark, table, paths, target, rejects_path)


def _run_job(spark: SparkSession, table: str, paths: str | Sequence[str], target: Target, rejects_path: str | None) -> JobReport:
    spec = S.TABLES[table]
    log = log_of(spark, table, target)
    alone = table not in DEPENDENT
    load = load_files(spark, paths, _by_rows(table) if alone else lambda records, kept: records, loaded_files(spark, table, target, log))
    if load is None:
        return JobReport(0, 0, 0, 0)
    first = next_id(spark, table, target, log)
    read = load.sizes.get(ROW, 0) + load.sizes.get(REFUSED, 0)
    if alone:
        kept, rejected = load.sizes.get(ROW, 0), load.sizes.get(REFUSED, 0)
        rows, refused = numbered(load, spec.id, first), load.refused
    else:
        rows, refused, kept, rejected = _across_rows(load, table, target, log)
        rows = row_numbered(rows, spec.id, first)
    append_bronze(rows, table, target, count=kept, files=load.files, next_id=first + kept, log=log)
    audit = rejects_path if rejects_path is not None or target.path is None else f"{target.path.rstrip('/')}/_rejects"
    if audit is not None and load.odd:
        load.rejects.write.mode("append").parquet(f"{audit.rstrip('/')}/{table}/records")
    if rejects_path is not None and rejected:
        refused.select(*spec.schema.fieldNames()[1:], "REASON").write.mode("append").parquet(f"{rejects_path.rstrip('/')}/{table}/contract")
    return JobReport(read, kept + rejected, rejected, kept)
