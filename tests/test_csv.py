from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.plans.ingest import run_job
from dealerlake.sources.bronze import Bronze
from dealerlake.sources.csv import (
    POSITION,
    column_names,
    detect_dialects,
    normalized_name,
    read_dirty_csv,
)
from dealerlake.sources.sink import Target


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_header_names():
    assert normalized_name("﻿ Nome  da Filial ") == "Nome_da_Filial"
    assert column_names(["a", "b", "A", "", "a"]) == ["a", "b", "A_1", "unnamed", "a_2"]


def test_dialects_of_many_files(spark, tmp_path):
    write(tmp_path / "a.csv", "x,y;z\n1,2;3\n")
    write(tmp_path / "b.csv", "x;y;z\nJOSÉ;2;3\n", "latin-1")
    write(tmp_path / "c.csv", "x;y;z\nJOSÉ;2;3\n", "utf-8-sig")
    # A character cut by a fixed-size sample must not decide the encoding.
    write(tmp_path / "d.csv", "x;y\n" + "é;1\n" * 30_000)
    found = {r.path.rsplit("/", 1)[1]: (r.encoding, r.sep) for r in detect_dialects(spark, str(tmp_path)).collect()}
    assert found == {
        "a.csv": ("utf-8-sig", ","),
        "b.csv": ("latin-1", ";"),
        "c.csv": ("utf-8-sig", ";"),
        "d.csv": ("utf-8-sig", ";"),
    }


def test_repeated_header_names(spark, tmp_path):
    write(tmp_path / "a.csv", 'a b;c;"a  b";c;d\n', "utf-8-sig")
    found = detect_dialects(spark, str(tmp_path)).first()
    assert (found.header, found.repeated) == (["a b", "c", "a  b", "c", "d"], ["a_b", "c"])


def test_mixed_dialects_read_as_one_table(spark, tmp_path):
    write(tmp_path / "b é+1%20 x.csv", "nome; valor\nJOSÉ;1\n", "latin-1")
    write(tmp_path / "c.csv", "nome, valor\nJOSÉ,2\n", "utf-8-sig")
    records, _, _ = read_dirty_csv(spark, str(tmp_path))
    assert sorted(rows(records, "nome", "valor")) == [("JOSÉ", "1"), ("JOSÉ", "2")]
    assert records.select(POSITION[2]).distinct().count() == 2


def test_short_long_and_blank_records(spark, tmp_path):
    path = write(tmp_path / "f.csv", 'a,b,c\n1,2,3\n4,5\n6,7,8,9\n\n"x,y",NA,"say ""hi"""\n')
    records, rejects, _ = read_dirty_csv(spark, path)
    assert rows(records.orderBy(*POSITION), "a", "b", "c") == [
        ("1", "2", "3"),
        ("4", "5", None),
        ("x,y", None, 'say "hi"'),
    ]
    assert rows(rejects.orderBy("line_number"), "line_number", "n_fields", "raw_row") == [
        (3, 2, "4|5"),
        (4, 4, "6|7|8|9"),
        (5, 0, ""),
    ]


def test_line_numbers_across_splits(spark, tmp_path):
    lines = ["a;b"] + [f"{i};{i}" if i % 97 else f"{i}" for i in range(1, 20_000)]
    path = write(tmp_path / "big.csv", "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        _, rejects, _ = read_dirty_csv(spark, path)
        found = rows(rejects, "line_number", "n_fields", "raw_row")
        assert rejects.rdd.getNumPartitions() > 1 or len(found) > 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(found) == [(i + 1, 1, str(i)) for i in range(1, 20_000) if i % 97 == 0]


def test_quoted_separator_is_not_a_field(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,b\n"1,5",2\n5" pipe,6" pipe\n')
    records, rejects, _ = read_dirty_csv(spark, path)
    assert rows(records.orderBy(*POSITION), "a", "b") == [("1,5", "2"), ('5" pipe', '6" pipe')]
    assert rejects.count() == 0


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n"1\n2",3\n4\n"x\ny",6,7\n8,9\n')
    records, rejects, _ = read_dirty_csv(spark, path)
    assert rows(records.orderBy(*POSITION), "a", "b") == [("1\n2", "3"), ("4", None), ("8", "9")]
    assert sorted(rows(rejects, "line_number", "n_fields", "raw_row")) == [(3, 1, "4"), (4, 3, "x\ny|6|7")]


def test_line_breaks_and_escapes_inside_quotes(spark, tmp_path):
    body = 'a;b;c\n1;"x\n""y"";\n\nz";3\n"";"";q\n2;"open" tail;4\n5;6"7;"8\n9"\n'
    write(tmp_path / "one.csv", body)
    write(tmp_path / "two.csv", "a;b;c\n1;2;3\n")
    records, rejects, _ = read_dirty_csv(spark, str(tmp_path))
    assert sorted(rows(records, "a", "b", "c"), key=str) == [
        ("1", '2', "3"), ("1", 'x\n"y";\n\nz', "3"), ("2", "open tail", "4"), ("5", '6"7', "8\n9"), (None, None, "q"),
    ]
    assert rejects.count() == 0


def test_an_unclosed_quote_reaches_to_the_end_and_is_listed(spark, tmp_path):
    path = write(tmp_path / "u.csv", 'a;b\n1;2\n"x;3\n4;5\n')
    records, rejects, _ = read_dirty_csv(spark, path)
    assert sorted(rows(records, "a", "b")) == [("1", "2"), ("x;3\n4;5", None)]
    assert rows(rejects, "line_number", "n_fields", "raw_row") == [(3, 1, "x;3\n4;5")]


def test_a_record_of_very_many_fields_is_left_out_and_listed(spark, tmp_path):
    path = write(tmp_path / "w.csv", "a;b\n1;2\n" + ";".join("x" * 21_000) + "\n3;4\n")
    records, rejects, _ = read_dirty_csv(spark, path)
    assert rows(records.orderBy("a"), "a", "b") == [("1", "2"), ("3", "4")]
    assert rows(rejects, "line_number", "n_fields") == [(3, 21_000)]


def test_records_and_rejects_share_one_scan(spark, tmp_path):
    path = write(tmp_path / "s.csv", "a;b\n1;2\n3\n")
    records, rejects, _ = read_dirty_csv(spark, path, staged=True)
    for df in (records, rejects):
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()
    assert records.count() == 2 and rejects.count() == 1


def test_missing_expected_column(spark, tmp_path):
    path = write(tmp_path / "e.csv", "a,b\n1,2\n")
    with pytest.raises(ValueError, match=r"\['c'\].*present.*\['a', 'b'\]"):
        read_dirty_csv(spark, path, expected=["a", "c"])


VEHICLE_SALES = """Cod Concessionaria;Cod Filial;Nome da Filial;Data da Venda;Quantidade Vendida;Valor da Venda;\
Dias que o Carro Ficou no Estoque;Tipo de Venda do Veiculo;Nome do Vendedor que Realizou a Venda;\
Estado Brasileiro da Venda;Macroregiao Geografica da Venda;
5;x;ccm autos 2;01/2/2025;1,0;1.234,56;35;DIRETA;JOSÃ\u0089; sp ;Sudeste;
5;x;OUTRA;31/01/2025;1;178139.58;9BWZZZ377VT004251;DIRETA;ANA;SP;SUL;
5;9-9;;31/01/2025;1;10;nan;;ANA;XX;LESTE;
5;x;OUTRA;31/02/2025;1;10;1;;ANA;SP;SUL;
;x;;31/01/2025;1;10;1;;ANA;SP;SUL;
"""


def test_vehicle_sales_job(spark, tmp_path):
    path = write(tmp_path / "v.csv", VEHICLE_SALES)
    target = Target(path=str(tmp_path / "bronze"))
    report = run_job(spark, S.HIST_VENDAS_VEICULOS, path, target, rejects_path=str(tmp_path / "rejects"))
    assert (report.read, report.deduped, report.rejected, report.written) == (5, 5, 2, 3)
    # The same file again is known; a copy of it is another file.
    again = run_job(spark, S.HIST_VENDAS_VEICULOS, path, target)
    assert (again.read, again.written) == (0, 0)
    copy = run_job(spark, S.HIST_VENDAS_VEICULOS, write(tmp_path / "v2.csv", VEHICLE_SALES), target)
    assert copy.written == 3
    b = Bronze.from_path(spark, str(tmp_path / "bronze"))
    columns = [
        "COD_FILIAL",
        "DT_VENDA",
        "QTDE_VENDIDA",
        "VALOR_VENDA",
        "CHASSI_VEICULO",
        "DIAS_EM_ESTOQUE",
        "TIPO_VENDA_VEICULO",
        "NOME_VENDEDOR",
        "ESTADO_VENDA",
        "MACROREGIAO_VENDA",
    ]
    stored = b.table(S.HIST_VENDAS_VEICULOS, ["ID_VENDA_VEICULO", *columns])
    assert sorted(r.ID_VENDA_VEICULO for r in stored.collect()) == [0, 1, 2, 3, 4, 5]
    assert sorted(set(rows(stored, *columns)), key=str) == [
        ("0-1-2", date(2025, 2, 1), 1, Decimal("1234.56"), None, 35, "DIRETA", "JOSÉ", "SP", "SUDESTE"),
        ("5-1-0", date(2025, 1, 31), 1, Decimal("178139.58"), "9BWZZZ377VT004251", None, None, None, None, None),
        ("9-9", date(2025, 1, 31), 1, Decimal("10.00"), None, None, None, "ANA", None, None),
    ]
    period = b.table(S.HIST_VENDAS_VEICULOS, ["DT_VENDA"], (date(2025, 2, 1), date(2025, 2, 28)))
    assert "ANO_MES" in period._jdf.queryExecution().toString() and period.count() == 2
    refused = spark.read.parquet(str(tmp_path / "rejects" / S.HIST_VENDAS_VEICULOS / "contract"))
    assert sorted(r.REASON for r in refused.collect()) == ["missing: COD_CONCESSIONARIA", "missing: DT_VENDA"]


VEHICLE_STOCK = """Nome da Concessionaria;Nome da Filial;Marca do Veiculo;Modelo do Veiculo;Cor do Veiculo;\
Ano Modelo do Veiculo;Ano Fabricacao do Veiculo;Data de Entrada do Veiculo no Estoque;Tempo Total no Estoque;\
Custo do Veiculo;Data de Entrada do Veiculo no Estoque;Data de Entrada do Veiculo no Estoque
CCM;CCM AUTOS 1;FORD;KA;AZUL;2024;2023;nan;1 a 3 meses;10,5;02/01/2025;03/01/2025
CCM;CCM AUTOS 1;FORD;KA;AZUL;2024;2023;;45;11,5;02/01/2025;
CCM;CCM AUTOS 1;FORD;KA;;2024;2023;02/01/2025;MAIS DE 3 ANOS;1;;
CCM;CCM AUTOS 1;FORD;KA;;2024;2023;02/01/2025;2 A 3 ANOS;2;;
"""


def test_vehicle_stock_job(spark, tmp_path):
    path = write(tmp_path / "s.csv", VEHICLE_STOCK)
    target = Target(path=str(tmp_path / "bronze"))
    report = run_job(spark, S.ESTOQUE_VEICULOS, path, target)
    assert (report.read, report.deduped, report.rejected, report.written) == (4, 2, 0, 2)
    stored = Bronze.from_path(spark, str(tmp_path / "bronze")).table(
        S.ESTOQUE_VEICULOS,
        ["COD_CONCESSIONARIA", "COD_FILIAL", "COR_VEICULO", "CUSTO_VEICULO", "TEMPO_TOTAL_ESTOQUE_DIAS", "DT_ENTRADA_ESTOQUE"],
    )
    assert sorted(rows(stored, "*"), key=str) == [
        ("0", "0-1-1", "AZUL", Decimal("10.50"), 60, date(2025, 1, 2)),
        ("0", "0-1-1", None, Decimal("1.00"), None, date(2025, 1, 2)),
    ]


def test_a_chassis_enters_the_stock_once(spark, tmp_path):
    header = "Nome da Concessionaria;Nome da Filial;Marca do Veiculo;Custo do Veiculo;Chassi do Veiculo;Data de Entrada do Veiculo no Estoque\n"
    row = "CCM;CCM AUTOS 1;{};1;{};02/01/2025\n"
    target, rejects = Target(path=str(tmp_path / "bronze")), str(tmp_path / "rejects")
    one = write(tmp_path / "1.csv", header + "".join(row.format(*r) for r in (("A", "X1"), ("B", "X1"), ("C", ""), ("D", ""), ("E", "X2"))))
    report = run_job(spark, S.ESTOQUE_VEICULOS, one, target, rejects_path=rejects)
    assert (report.read, report.rejected, report.written) == (5, 1, 4)
    two = write(tmp_path / "2.csv", header + "".join(row.format(*r) for r in (("F", "X2"), ("G", "X3"))))
    report = run_job(spark, S.ESTOQUE_VEICULOS, two, target, rejects_path=rejects)
    assert (report.read, report.rejected, report.written) == (2, 1, 1)
    stored = Bronze.from_path(spark, str(tmp_path / "bronze")).table(S.ESTOQUE_VEICULOS, ["ID_ESTOQUE_VEICULO", "CHASSI_VEICULO"])
    assert sorted(r[0] for r in stored.collect()) == [0, 1, 2, 3, 4]
    assert sorted(r[1] for r in stored.filter("CHASSI_VEICULO IS NOT NULL").collect()) == ["X1", "X2", "X3"]
    refused = spark.read.parquet(f"{rejects}/{S.ESTOQUE_VEICULOS}/contract")
    assert [r.REASON for r in refused.collect()] == ["repeats: CHASSI_VEICULO"] * 2


PART_SALES = "Cod_Concessionaria,Cod_Filial,Data_da_Venda,Valor_da_Venda,Margem_da_Venda\n1,1-1,2025-01-05,10.5,\n1,1-1,2025-01-06,1,0.25\n"
SERVICES = "Cod_Concessionaria,Cod_Filial,Data_De_Realizacao_Do_Servico,Quantidade_De_Servicos_Realizados\n1,1-1,2025-1-5,3.7\n,1-1,2025-1-5,3\n"
PART_STOCK = "Cod_Concessionaria,Cod_Filial,Peca_Esta_Obsoleta,Valor_da_Peca_em_Estoque\n007,1-1,True,1.5\n7,1-1,x,\"1,5\"\n"


def test_other_jobs(spark, tmp_path):
    target = Target(path=str(tmp_path / "bronze"))
    jobs = {S.HIST_VENDAS_PECAS: PART_SALES, S.HIST_SERVICOS: SERVICES, S.ESTOQUE_PECAS: PART_STOCK}
    written = {
        table: run_job(spark, table, write(tmp_path / f"{table}.csv", body), target).written for table, body in jobs.items()
    }
    assert written == {S.HIST_VENDAS_PECAS: 2, S.HIST_SERVICOS: 1, S.ESTOQUE_PECAS: 2}
    b = Bronze.from_path(spark, str(tmp_path / "bronze"))
    assert sorted(rows(b.table(S.HIST_VENDAS_PECAS, ["VALOR_VENDA", "MARGEM_VENDA"]), "*")) == [
        (Decimal("1.00"), Decimal("0.2500")),
        (Decimal("10.50"), Decimal("0.0000")),
    ]
    assert rows(b.table(S.HIST_SERVICOS, ["DT_REALIZACAO_SERVICO", "QTDE_SERVICOS"]), "*") == [(date(2025, 1, 5), 3)]
    assert sorted(
        rows(b.table(S.ESTOQUE_PECAS, ["COD_CONCESSIONARIA", "PECA_OBSOLETA_FLAG", "VALOR_PECA_ESTOQUE"]), "*"), key=str
    ) == [("007", "SIM", Decimal("1.50")), ("7", None, None)]


def test_empty_load_writes_nothing(spark, tmp_path):
    path = write(tmp_path / "h.csv", PART_SALES.splitlines()[0] + "\n")
    report = run_job(spark, S.HIST_VENDAS_PECAS, path, Target(path=str(tmp_path / "bronze")))
    assert (report.read, report.written) == (0, 0)


def test_catalog_target(spark, tmp_path):
    S.create_tables(spark, "dealer_test")
    path = write(tmp_path / "p.csv", PART_SALES)
    assert run_job(spark, S.HIST_VENDAS_PECAS, path, Target(database="dealer_test")).written == 2
    b = Bronze.from_catalog(spark, "dealer_test")
    assert b.table(S.HIST_VENDAS_PECAS, ["VALOR_VENDA"], (date(2025, 1, 6), None)).count() == 1
    comments = {r.col_name: r.comment for r in spark.sql("DESCRIBE dealer_test.BRZ_HIST_VENDAS_PECAS").collect()}
    assert comments["VALOR_VENDA"] == "revenue"
    assert b.transactions(["RECEITA"]).agg(F.sum("RECEITA")).first()[0] == Decimal("11.5000")
