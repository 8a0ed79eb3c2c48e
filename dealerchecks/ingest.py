"""Registered ingest queries: cleaning jobs over dirtied columns of the star tables.

The dirtied input of each is one SQL text that both engines run over the whole table; the repair is
our job on one side and plain DuckDB SQL on the other.
"""

from __future__ import annotations

from dealerlake import schemas as S
from dealerlake.functions import clean
from dealerlake.operators import cleaning
from dealerlake.plans.ingest import ORDER, VEHICLE_IDENTITY, transform
from dealerlake.sources.star import star_table

# ---------------------------------------------------------------- dirtied inputs, read by both engines

KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
# Unique per record, in an order both engines sort alike.
RECORD_KEY = (
    "lpad(cast(l_orderkey as string), 12, '0') || '-' || cast(l_linenumber as string) || '-' || "
    "lpad(cast(l_partkey as string), 12, '0') || '-' || lpad(cast(l_suppkey as string), 12, '0') || '-' || "
    "cast(cast(l_quantity as bigint) as string) || '-' || cast(cast(l_shipdate as date) as string)"
)
_PRICE = "cast(cast(l_extendedprice as decimal(18,2)) as string)"
_DAY = "cast(cast(l_shipdate as date) as string)"
_ISO = f"case when l_partkey % 7 = 0 then 'nan' when l_partkey % 7 = 1 then ' ' || {_DAY} || ' ' when l_partkey % 7 = 2 then {_DAY} || ' 10:00' when l_partkey % 7 = 3 then '1998-2-5' when l_partkey % 7 = 4 then '1998-02-30' else {_DAY} end"
_BR_DAY = f"substr({_DAY}, 9, 2) || '/' || substr({_DAY}, 6, 2) || '/' || substr({_DAY}, 1, 4)"
_BR = f"case when l_partkey % 7 = 0 then '31/02/1998' when l_partkey % 7 = 1 then '5/2/1998' when l_partkey % 7 = 2 then {_DAY} when l_partkey % 7 = 3 then '' else {_BR_DAY} end"
_WHOLE = f"substr({_PRICE}, 1, length({_PRICE}) - 3)"
_CENTS = f"substr({_PRICE}, length({_PRICE}) - 1, 2)"
_THOUSANDS = f"case when length({_WHOLE}) > 3 then substr({_WHOLE}, 1, length({_WHOLE}) - 3) || '.' || substr({_WHOLE}, length({_WHOLE}) - 2, 3) else {_WHOLE} end"
_LOCALE = f"case l_linenumber % 6 when 0 then {_THOUSANDS} || ',' || {_CENTS} when 1 then {_WHOLE} || ',' || {_CENTS} when 2 then ' ' || {_PRICE} when 3 then 'abc' when 4 then '1,234,567' else '-' || {_PRICE} end"
_STRICT = f"case l_linenumber % 5 when 0 then ' ' || {_PRICE} || ' ' when 1 then {_WHOLE} || ',' || {_CENTS} when 2 then 'nan' when 3 then '1e3' else '-' || {_PRICE} end"
_INT = f"case l_linenumber % 6 when 0 then {_WHOLE} || ',7' when 1 then '-' || {_WHOLE} || '.7' when 2 then '1.234,5' when 3 then 'inf' when 4 then '' else cast(l_partkey as string) end"
_FLAG = "case l_partkey % 6 when 0 then ' True ' when 1 then 'no' when 2 then 'x' when 3 then 'NÃO' when 4 then '1' else '' end"
_AGES = ["MENOS DE 1 MES", "1 a 3 meses", "3 A 6 MESES", "6 A 9 MESES", "9 A 12 MESES", "1 A 2 ANOS", " 2 A 3 anos", "MAIS DE 3 ANOS", "45"]
_AGE = "case l_partkey % 10 " + " ".join(f"when {i} then '{a}'" for i, a in enumerate(_AGES)) + " else null end"
_STATE = "case c_nationkey % 4 when 0 then ' sp ' when 1 then 'XX' when 2 then 'rj' else null end"
_DAYS = "case when l_orderkey % 11 = 0 then '9BW' || lpad(cast(l_orderkey as string), 14, '0') when l_orderkey % 11 = 1 then '' else cast(l_partkey % 400 as string) end"
# UTF-8 bytes of an accented letter read as Latin-1, a damaged one that cannot be read back, a sound one.
# As read wrongly, and as it should read; the second cannot be read back, the third needs nothing.
_NAMES = {
    "JOSÃ\u0089": "JOSÉ",
    "ANDRÃ‰": "ANDRÃ‰",
    "ANDRÉ": "ANDRÉ",
    "CONCEIÃ\u0087Ã\u0083O": "CONCEIÇÃO",
    "MÃ¼ller": "Müller",
}
_NAME = "case l_suppkey % 7 " + " ".join(f"when {i} then '{n} ' || cast(l_suppkey as string)" for i, n in enumerate(_NAMES)) + " else 'MARIA' end"
# Spelled out here once more, so that a wrong list in the library shows.
_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
_AGES = {"MENOS DE 1 MES": 15, "1 A 3 MESES": 60, "3 A 6 MESES": 135, "6 A 9 MESES": 225, "9 A 12 MESES": 315, "1 A 2 ANOS": 540, "2 A 3 ANOS": 900}
_CODES = {"CCM AUTOS 1": "0-1-1", "CCM AUTOS 2": "0-1-2", "CCM AUTOS 3": "0-1-3"}
_STATES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
_REGIONS = ("NORTE", "NORDESTE", "CENTRO-OESTE", "SUDESTE", "SUL")
_TOKEN = "case l_partkey % 23 " + " ".join(f"when {i} then '{t}'" for i, t in enumerate(_TOKENS)) + " when 21 then ' NA' else 'ok' end"
_BRANCH = "case when l_suppkey % 11 = 0 then null when l_suppkey % 11 = 1 then 'Outra ' else ' ccm autos ' || cast(l_suppkey % 5 as string) end"
_DEALER_NAME = "case l_partkey % 4 when 0 then ' ccm' when 1 then ' ' else 'Grupo ' || cast(l_partkey % 3 as string) end"
_DEALER = "case when l_suppkey % 13 = 0 then ' ' else cast(l_suppkey % 7 as string) end"


def _dirty(**columns: str) -> str:
    return f"SELECT {KEY}, " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + " FROM {lineitem}"


DIRTY = {
    "null_tokens": _dirty(raw=_TOKEN),
    "clean_strings": _dirty(
        raw="case l_linenumber % 4 when 0 then '  ' || l_returnflag || ' ' when 1 then '   ' when 2 then '' else chr(9) || 'x y' || chr(160) end"
    ),
    "parse_iso_dates": _dirty(raw=_ISO),
    "parse_br_dates": _dirty(raw=_BR),
    "parse_locale_numbers": _dirty(raw=_LOCALE),
    "parse_strict_numbers": _dirty(raw=_STRICT),
    "parse_integers": _dirty(raw=_INT),
    "parse_strict_integers": _dirty(raw=_INT),
    "normalize_flags": _dirty(raw=_FLAG),
    "bucket_to_days": _dirty(raw=_AGE),
    "default_zero": _dirty(raw=_STRICT.replace("'1e3'", "null")),
    "whitelist_values": "SELECT c_custkey, " + _STATE + " AS raw FROM {customer}",
    "fix_mojibake": _dirty(raw=_NAME),
    "derive_branch_codes": _dirty(dealer=_DEALER_NAME, branch=_BRANCH),
    "coalesce_duplicate_columns": _dirty(
        entrada="case when l_partkey % 2 = 0 then 'nan' when l_partkey % 2 = 1 and l_linenumber = 1 then ' a ' else null end",
        entrada_1="case when l_linenumber % 3 = 0 then ' b' else '' end",
        entrada_2="case when l_linenumber % 2 = 0 then 'c' else 'None' end",
    ),
    "repair_shifted_rows": _dirty(
        dias=_DAYS,
        tipo="'DIRETA'",
        vendedor=_NAME,
        chassi="case when l_partkey % 5 = 0 then 'C' || cast(l_partkey as string) else null end",
    ),
}
_COPY = f"SELECT {KEY}, cast(l_quantity as bigint) AS l_quantity, nullif(l_linenumber, 3) AS line, {RECORD_KEY} || "
DIRTY["dedupe_keep_first"] = (
    _COPY + "'-1' AS ord FROM {lineitem} UNION ALL " + _COPY + "'-2' AS ord FROM {lineitem} WHERE l_linenumber = 1"
)
_CONTRACT = _dirty(
    COD_CONCESSIONARIA="case when l_suppkey % 13 = 0 then null else cast(l_suppkey % 17 as string) end",
    DT_VENDA="case when l_partkey % 17 = 0 then null else cast(l_shipdate as date) end",
)
DIRTY["drop_unnamed_columns"] = _dirty(**{"`Unnamed: 3`": "l_partkey", "` `": "l_partkey", "raw": _NAME, "UNNAMED_1": "l_suppkey"})
DIRTY["contract_valid"] = DIRTY["contract_rejects"] = _CONTRACT
DIRTY["unique_violations"] = _dirty(chassi="case when l_partkey % 3 = 0 then null else 'C' || cast(l_orderkey as string) end")

# Whole exports, one per bronze table, under the exports' column names.
_EXPORT_BRANCH = {"Cod_Concessionaria": _DEALER, "Cod_Filial": "' F' || cast(l_suppkey % 3 as string)", "Nome_da_Filial": _BRANCH}
EXPORTS = {
    S.HIST_VENDAS_VEICULOS: _dirty(
        **_EXPORT_BRANCH,
        Data_da_Venda=_BR,
        Quantidade_Vendida="cast(cast(l_quantity as bigint) as string) || ',0'",
        Valor_da_Venda=_LOCALE,
        Custo_do_Veiculo=f"{_WHOLE} || ',' || {_CENTS}",
        Lucro_da_Venda=f"'-' || {_PRICE}",
        Margem_da_Venda="'0,' || lpad(cast(l_partkey % 10000 as string), 4, '0')",
        Modelo_do_Veiculo="' ' || l_linestatus || ' '",
        Ano_Modelo_do_Veiculo="substr(" + _DAY + ", 1, 4) || '.0'",
        Dias_que_o_Carro_Ficou_no_Estoque=_DAYS,
        Tipo_de_Venda_do_Veiculo="'DIRETA'",
        Nome_do_Vendedor_que_Realizou_a_Venda=_NAME,
        Nome_do_Comprador_do_Veiculo="' ANA '",
        Cidade_da_Venda="'RIO'",
        Estado_Brasileiro_da_Venda="case l_partkey % 3 when 0 then ' sp ' when 1 then 'XX' else null end",
        Macroregiao_Geografica_da_Venda="case l_partkey % 3 when 0 then 'Sudeste' when 1 then 'LESTE' else ' ' end",
    )
    + " WHERE l_returnflag = 'A'",
    S.HIST_VENDAS_PECAS: _dirty(
        **_EXPORT_BRANCH,
        Data_da_Venda=_ISO,
        Quantidade_Vendida="cast(cast(l_quantity as bigint) as string) || ',50'",
        Valor_da_Venda=_LOCALE,
        Custo_da_Peca=_PRICE,
        Lucro_da_Venda="'x'",
        Margem_da_Venda="case when l_partkey % 5 = 0 then null when l_partkey % 5 = 1 then 'nan' else '0,' || lpad(cast(l_partkey % 10000 as string), 4, '0') end",
        Descricao_da_Peca="' peca ' || cast(l_partkey as string)",
        Nome_do_Vendedor_que_Realizou_a_Venda=_NAME,
        Nome_do_Comprador_da_Peca="' ANA '",
        Estado_Brasileiro_da_Venda="case l_partkey % 3 when 0 then ' sp ' when 1 then 'XX' else null end",
        Macroregiao_Geografica_da_Venda="' Sudeste'",
    )
    + " WHERE l_returnflag = 'N'",
    S.HIST_SERVICOS: _dirty(
        Cod_Concessionaria=_DEALER,
        Cod_Filial="' F' || cast(l_suppkey % 3 as string)",
        Nome_Da_Filial=_BRANCH,
        Data_De_Realizacao_Do_Servico=_ISO,
        Quantidade_De_Servicos_Realizados="cast(cast(l_quantity as bigint) as string) || '.7'",
        Valor_Total_Do_Servico_Realizado=_STRICT,
        Lucro_Do_Servico=_PRICE,
        Departamento_Que_Realizou_O_Servico="' oficina '",
        Nome_Do_Cliente_Que_Fez_O_Servico="case when l_partkey % 9 = 0 then ' ' else ' ANA' end",
    )
    + " WHERE l_returnflag = 'R'",
    S.ESTOQUE_PECAS: _dirty(
        **_EXPORT_BRANCH,
        Valor_da_Peca_em_Estoque=_STRICT,
        Quantidade_da_Peca_em_Estoque="cast(l_quantity as string)",
        Descricao_da_Peca="' peca ' || cast(l_partkey as string)",
        Data_de_Ultima_Venda_da_Peca=_ISO,
        Peca_Esta_Obsoleta=_FLAG,
        Codigo_da_Peca_no_Estoque="'00' || cast(l_partkey as string)",
    ),
    S.ESTOQUE_VEICULOS: (
        f"SELECT {RECORD_KEY} AS {ORDER}, "
        + ", ".join(
            f"{sql} AS {name}"
            for name, sql in {
                "Nome_da_Concessionaria": _DEALER_NAME,
                "Nome_da_Filial": _BRANCH,
                "Custo_do_Veiculo": _LOCALE,
                "Marca_do_Veiculo": "' FORD '",
                "Modelo_do_Veiculo": "'m' || cast(l_partkey % 50 as string)",
                "Cor_do_Veiculo": "nullif(l_linestatus, 'F')",
                "Ano_Modelo_do_Veiculo": "substr(" + _DAY + ", 1, 4)",
                "Ano_Fabricacao_do_Veiculo": "substr(" + _DAY + ", 1, 4) || ',9'",
                "Tempo_Total_no_Estoque": _AGE,
                "Kilometragem_Atual_do_Veiculo": _INT,
                "Data_de_Entrada_do_Veiculo_no_Estoque": "case when l_partkey % 2 = 0 then 'nan' else null end",
                "Data_de_Entrada_do_Veiculo_no_Estoque_1": "case when l_partkey % 3 = 0 then '' else '01/0' || cast(1 + l_partkey % 7 as string) || '/1998' end",
                "Data_de_Entrada_do_Veiculo_no_Estoque_2": "'15/12/1997'",
            }.items()
        )
        + " FROM {lineitem}"
    ),
}


def _input(spark, folder: str, sql: str):
    tables = {t: star_table(spark, folder, t) for t in ("lineitem", "customer") if "{" + t + "}" in sql}
    return spark.sql(sql, **tables)


_JOBS = {
    "null_tokens": lambda df: cleaning.null_tokens(df, "raw"),
    "clean_strings": lambda df: cleaning.clean_strings(df, "raw"),
    "parse_iso_dates": lambda df: cleaning.parse_iso_dates(df, "raw"),
    "parse_br_dates": lambda df: cleaning.parse_br_dates(df, "raw"),
    "parse_locale_numbers": lambda df: cleaning.parse_locale_numbers(df, "raw"),
    "parse_strict_numbers": lambda df: cleaning.parse_strict_numbers(df, "raw"),
    "parse_integers": lambda df: cleaning.parse_integers(df, "raw"),
    "parse_strict_integers": lambda df: cleaning.parse_strict_integers(df, "raw"),
    "normalize_flags": lambda df: cleaning.normalize_flags(df, "raw"),
    "bucket_to_days": lambda df: cleaning.bucket_to_days(df, "raw"),
    "default_zero": lambda df: cleaning.default_zero(df, "raw", "absent"),
    "whitelist_values": lambda df: cleaning.whitelist_values(df, "raw", clean.STATES),
    "fix_mojibake": lambda df: cleaning.fix_mojibake(df, "raw"),
    "derive_branch_codes": lambda df: cleaning.derive_branch_codes(df, "dealer", "branch"),
    "coalesce_duplicate_columns": lambda df: cleaning.coalesce_duplicate_columns(df, "entrada"),
    "repair_shifted_rows": lambda df: cleaning.repair_shifted_rows(df, "dias", "chassi", ["tipo", "vendedor"]),
    "dedupe_keep_first": lambda df: cleaning.dedupe_keep_first(df, "ord", ["l_orderkey", "line", "absent"]),
    "drop_unnamed_columns": cleaning.drop_unnamed_columns,
    "contract_valid": lambda df: cleaning.contract_valid(df, ["COD_CONCESSIONARIA", "DT_VENDA"], {"COD_CONCESSIONARIA": 1}),
    "contract_rejects": lambda df: cleaning.contract_rejects(df, ["COD_CONCESSIONARIA", "DT_VENDA"], {"COD_CONCESSIONARIA": 1}),
    "unique_violations": lambda df: cleaning.unique_violations(df, "chassi"),
}


def projection_name(table: str) -> str:
    return "bronze_projection_" + table.removeprefix("BRZ_").lower()


def ingest_queries() -> dict:
    def job(name):
        return lambda spark, folder: _JOBS[name](_input(spark, folder, DIRTY[name]))

    def projection(table):
        return lambda spark, folder: transform(table, _input(spark, folder, EXPORTS[table]))

    return {n: job(n) for n in _JOBS} | {projection_name(t): projection(t) for t in EXPORTS}


# ---------------------------------------------------------------- the same repairs in DuckDB SQL

_WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"


def _text(x: str) -> str:
    return f"nullif(trim({x}, {_WS}), '')"


def _said(x: str) -> str:
    return f"CASE WHEN lower({_text(x)}) IN ('nan', 'none') THEN NULL ELSE {_text(x)} END"


def _date(x: str, shape: str, pattern: str) -> str:
    return f"CASE WHEN regexp_full_match({_text(x)}, '{shape}') THEN CAST(try_strptime({_text(x)}, '{pattern}') AS DATE) END"


def _iso(x: str) -> str:
    return _date(x, r"\d{4}-\d{1,2}-\d{1,2}", "%Y-%m-%d")


def _br(x: str) -> str:
    return _date(x, r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y")


def _dot(x: str) -> str:
    return f"replace(CASE WHEN contains({x}, ',') AND contains({x}, '.') THEN replace({x}, '.', '') ELSE {x} END, ',', '.')"


_SHAPE = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def _number(x: str, dtype: str) -> str:
    return f"CAST(CASE WHEN regexp_full_match({x}, '{_SHAPE}') THEN TRY_CAST({x} AS {dtype}) END AS DOUBLE)"


def _locale(x: str, dtype: str = "DECIMAL(18,2)") -> str:
    return _number(_dot(_said(x)), dtype)


def _strict(x: str) -> str:
    return _number(_text(x), "DECIMAL(18,2)")


def _whole(x: str, dtype: str = "BIGINT") -> str:
    return f"CASE WHEN regexp_full_match({x}, '{_SHAPE}') THEN CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS {dtype}) END"


def _int(x: str, dtype: str = "BIGINT") -> str:
    return _whole(f"replace({_said(x)}, ',', '.')", dtype)


def _yes_no(x: str) -> str:
    v = f"lower({_text(x)})"
    return f"CASE WHEN {v} IN ('true', '1', 'sim', 'yes', 'y') THEN 'SIM' WHEN {v} IN ('false', '0', 'nao', 'não', 'no', 'n') THEN 'NAO' END"


def _age(x: str) -> str:
    cases = " ".join(f"WHEN contains(upper({x}), '{label}') THEN {days}" for label, days in _AGES.items())
    return f"CAST(CASE {cases} ELSE {_int(x)} END AS BIGINT)"


def _dealer(x: str) -> str:
    return f"CASE WHEN upper({_text(x)}) = 'CCM' THEN '0' ELSE {_text(x)} END"


def _branch(x: str, dealer: str) -> str:
    v = _text(x)
    named = " ".join(f"WHEN upper({v}) = '{name}' THEN '{code}'" for name, code in _CODES.items())
    return f"CASE WHEN {v} IS NULL THEN NULL {named} WHEN ({dealer}) IS NOT NULL THEN ({dealer}) || '-1-0' ELSE {v} END"


def _member(x: str, allowed) -> str:
    listed = ", ".join(f"'{a}'" for a in allowed)
    return f"CASE WHEN upper({_text(x)}) IN ({listed}) THEN upper({_text(x)}) END"


def _repaired(x: str) -> str:
    for broken, sound in _NAMES.items():
        x = f"replace({x}, '{broken}', '{sound}')"
    return x


def _raw(expression: str) -> str:
    return f"SELECT {KEY}, {expression} AS raw FROM dirty"


_NULLS = ", ".join(f"'{t}'" for t in _TOKENS)
_SHIFTED = "coalesce(regexp_full_match(trim(dias), '[A-Z0-9]{10,20}'), false)"
_STATED = "CASE WHEN lower(trim({0})) IN ('nan', 'none', '') THEN NULL ELSE trim({0}) END"
_FIRST = "coalesce(" + ", ".join(_STATED.format(c) for c in ("entrada", "entrada_1", "entrada_2")) + ")"
_MISSING = "concat_ws(', ', CASE WHEN COD_CONCESSIONARIA IS NULL THEN 'missing: COD_CONCESSIONARIA' END, CASE WHEN DT_VENDA IS NULL THEN 'missing: DT_VENDA' END, CASE WHEN length(COD_CONCESSIONARIA) > 1 THEN 'longer than 1: COD_CONCESSIONARIA' END)"

REPAIRS = {
    "null_tokens": _raw(f"CASE WHEN raw IN ({_NULLS}) THEN NULL ELSE raw END"),
    "clean_strings": _raw(_text("raw")),
    "parse_iso_dates": _raw(_iso("raw")),
    "parse_br_dates": _raw(_br("raw")),
    "parse_locale_numbers": _raw(_locale("raw")),
    "parse_strict_numbers": _raw(_strict("raw")),
    "parse_integers": _raw(_int("raw")),
    "parse_strict_integers": _raw(_whole(_text("raw"))),
    "normalize_flags": _raw(_yes_no("raw")),
    "bucket_to_days": _raw(_age("raw")),
    "default_zero": _raw("CASE WHEN raw IS NULL OR lower(trim(raw)) IN ('', 'nan', 'none') THEN '0' ELSE raw END"),
    "whitelist_values": f"SELECT c_custkey, {_member('raw', _STATES)} AS raw FROM dirty",
    "fix_mojibake": _raw(_repaired("raw")),
    "derive_branch_codes": f"SELECT *, {_dealer('dealer')} AS COD_CONCESSIONARIA, {_branch('branch', _dealer('dealer'))} AS COD_FILIAL FROM dirty",
    "coalesce_duplicate_columns": f"SELECT {KEY}, {_FIRST} AS entrada FROM dirty",
    "repair_shifted_rows": f"""SELECT {KEY}, CASE WHEN NOT {_SHIFTED} THEN dias END AS dias, CASE WHEN NOT {_SHIFTED} THEN tipo END AS tipo,
        CASE WHEN NOT {_SHIFTED} THEN vendedor END AS vendedor, CASE WHEN {_SHIFTED} THEN trim(dias) ELSE chassi END AS chassi FROM dirty""",
    "dedupe_keep_first": """SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, line ORDER BY ord) AS place FROM dirty) WHERE place = 1""",
    "drop_unnamed_columns": _raw("raw"),
    "contract_valid": "SELECT * FROM dirty WHERE length(COD_CONCESSIONARIA) = 1 AND DT_VENDA IS NOT NULL",
    "contract_rejects": f"""SELECT *, {_MISSING} AS REASON FROM dirty
        WHERE COD_CONCESSIONARIA IS NULL OR length(COD_CONCESSIONARIA) > 1 OR DT_VENDA IS NULL""",
    "unique_violations": "SELECT chassi, count(*) AS OCORRENCIAS FROM dirty WHERE chassi IS NOT NULL GROUP BY chassi HAVING count(*) > 1",
}

_COMMON = {
    "COD_CONCESSIONARIA": _text("Cod_Concessionaria"),
    "COD_FILIAL": _text("Cod_Filial"),
    "NOME_FILIAL": _text("Nome_da_Filial"),
}
_VIN = "coalesce(regexp_full_match(trim(Dias_que_o_Carro_Ficou_no_Estoque), '[A-Z0-9]{10,20}'), false)"
_SALE = {
    "VALOR_VENDA": _locale("Valor_da_Venda"),
    "LUCRO_VENDA": _locale("Lucro_da_Venda"),
    "NOME_VENDEDOR": _repaired(_text("Nome_do_Vendedor_que_Realizou_a_Venda")),
    "ESTADO_VENDA": _member("Estado_Brasileiro_da_Venda", _STATES),
}


def _unless_shifted(x: str) -> str:
    return f"CASE WHEN NOT {_VIN} THEN {x} END"


PROJECTIONS = {
    S.HIST_VENDAS_VEICULOS: {
        **_COMMON,
        **_SALE,
        "COD_FILIAL": f"coalesce({_branch('Nome_da_Filial', _text('Cod_Concessionaria'))}, {_text('Cod_Filial')})",
        "DT_VENDA": _br("Data_da_Venda"),
        "QTDE_VENDIDA": _int("Quantidade_Vendida"),
        "CUSTO_VEICULO": _locale("Custo_do_Veiculo"),
        "MARGEM_VENDA": _locale("Margem_da_Venda", "DECIMAL(9,4)"),
        "MODELO_VEICULO": _text("Modelo_do_Veiculo"),
        "ANO_MODELO": _int("Ano_Modelo_do_Veiculo", "INTEGER"),
        "CHASSI_VEICULO": f"CASE WHEN {_VIN} THEN trim(Dias_que_o_Carro_Ficou_no_Estoque) END",
        "DIAS_EM_ESTOQUE": _unless_shifted(_int("Dias_que_o_Carro_Ficou_no_Estoque")),
        "TIPO_VENDA_VEICULO": _unless_shifted(_text("Tipo_de_Venda_do_Veiculo")),
        "NOME_VENDEDOR": _unless_shifted(_SALE["NOME_VENDEDOR"]),
        "NOME_COMPRADOR": _unless_shifted(_text("Nome_do_Comprador_do_Veiculo")),
        "CIDADE_VENDA": _unless_shifted(_text("Cidade_da_Venda")),
        "ESTADO_VENDA": _unless_shifted(_SALE["ESTADO_VENDA"]),
        "MACROREGIAO_VENDA": _unless_shifted(_member("Macroregiao_Geografica_da_Venda", _REGIONS)),
    },
    S.HIST_VENDAS_PECAS: {
        **_COMMON,
        **_SALE,
        "DT_VENDA": _iso("Data_da_Venda"),
        "QTDE_VENDIDA": _locale("Quantidade_Vendida"),
        "CUSTO_PECA": _locale("Custo_da_Peca"),
        "MARGEM_VENDA": f"coalesce({_locale('Margem_da_Venda', 'DECIMAL(9,4)')}, 0)",
        "DESCRICAO_PECA": _text("Descricao_da_Peca"),
        "NOME_COMPRADOR": _text("Nome_do_Comprador_da_Peca"),
        "MACROREGIAO_VENDA": _text("Macroregiao_Geografica_da_Venda"),
    },
    S.HIST_SERVICOS: {
        "COD_CONCESSIONARIA": _text("Cod_Concessionaria"),
        "COD_FILIAL": _text("Cod_Filial"),
        "NOME_FILIAL": _text("Nome_Da_Filial"),
        "DT_REALIZACAO_SERVICO": _iso("Data_De_Realizacao_Do_Servico"),
        "QTDE_SERVICOS": _whole(_text("Quantidade_De_Servicos_Realizados")),
        "VALOR_TOTAL_SERVICO": _strict("Valor_Total_Do_Servico_Realizado"),
        "LUCRO_SERVICO": _strict("Lucro_Do_Servico"),
        "DEPARTAMENTO_SERVICO": _text("Departamento_Que_Realizou_O_Servico"),
        "NOME_CLIENTE": _text("Nome_Do_Cliente_Que_Fez_O_Servico"),
    },
    S.ESTOQUE_PECAS: {
        **_COMMON,
        "VALOR_PECA_ESTOQUE": _strict("Valor_da_Peca_em_Estoque"),
        "QTDE_PECA_ESTOQUE": _strict("Quantidade_da_Peca_em_Estoque"),
        "DESCRICAO_PECA": _text("Descricao_da_Peca"),
        "DT_ULTIMA_VENDA_PECA": _iso("Data_de_Ultima_Venda_da_Peca"),
        "PECA_OBSOLETA_FLAG": _yes_no("Peca_Esta_Obsoleta"),
        "CODIGO_PECA_ESTOQUE": _text("Codigo_da_Peca_no_Estoque"),
    },
    S.ESTOQUE_VEICULOS: {
        "COD_CONCESSIONARIA": _dealer("Nome_da_Concessionaria"),
        "COD_FILIAL": _branch("Nome_da_Filial", _dealer("Nome_da_Concessionaria")),
        "NOME_CONCESSIONARIA": _text("Nome_da_Concessionaria"),
        "NOME_FILIAL": _text("Nome_da_Filial"),
        "CUSTO_VEICULO": _locale("Custo_do_Veiculo"),
        "MARCA_VEICULO": _text("Marca_do_Veiculo"),
        "MODELO_VEICULO": _text("Modelo_do_Veiculo"),
        "COR_VEICULO": _text("Cor_do_Veiculo"),
        "ANO_MODELO": _int("Ano_Modelo_do_Veiculo", "INTEGER"),
        "ANO_FABRICACAO": _int("Ano_Fabricacao_do_Veiculo", "INTEGER"),
        "TEMPO_TOTAL_ESTOQUE_DIAS": _age("Tempo_Total_no_Estoque"),
        "KM_ATUAL": _int("Kilometragem_Atual_do_Veiculo"),
        "DT_ENTRADA_ESTOQUE": _br("entrada"),
    },
}

_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE"}


def projection_rows_sql(table: str) -> str:
    columns = []
    for field in S.SCHEMAS[table].fields[1:]:
        dtype = _SQL_TYPES.get(field.dataType.simpleString(), "DOUBLE")
        columns.append(f"CAST({PROJECTIONS[table].get(field.name, 'NULL')} AS {dtype}) AS {field.name}")
    source = f"dirty AS ({_plain(EXPORTS[table])})"
    if table == S.ESTOQUE_VEICULOS:
        base = "Data_de_Entrada_do_Veiculo_no_Estoque"
        entry = "coalesce(" + ", ".join(_said(c) for c in (base, base + "_1", base + "_2")) + ")"
        identity = ", ".join([c for c in VEHICLE_IDENTITY if c != base] + ["entrada"])
        source += f""", merged AS (SELECT *, {entry} AS entrada FROM dirty),
          first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {identity} ORDER BY {ORDER}) AS place FROM merged)
            WHERE place = 1)"""
        return f"WITH {source} SELECT {', '.join(columns)} FROM first_rows"
    return f"WITH {source} SELECT {', '.join(columns)} FROM dirty"


def _plain(sql: str) -> str:
    return sql.replace("{lineitem}", "lineitem").replace("{customer}", "customer")


def ingest_sql() -> dict[str, str]:
    repairs = {name: f"WITH dirty AS ({_plain(DIRTY[name])}) {sql}" for name, sql in REPAIRS.items()}
    return repairs | {projection_name(t): projection_rows_sql(t) for t in EXPORTS}
