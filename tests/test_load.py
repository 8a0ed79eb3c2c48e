"""Loads: records that cross splits, one scan of the lines, loads that die, keys looked up by bucket."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from dealerlake import schemas as S
from dealerlake.plans import ingest
from dealerlake.session import setting
from dealerlake.sources import csv, sink
from dealerlake.sources.bronze import Bronze
from dealerlake.sources.csv import load_files, numbered, read_dirty_csv
from dealerlake.sources.manifest import Log
from dealerlake.sources.sink import Target


def plain_records(text, sep):
    """Records of a text, each with its raw fields, letter by letter: a quote opens only at the start of a field."""
    records, fields, field, state = [], [], "", "start"
    for c in text.removesuffix("\n"):
        if state == "in":
            field += c
            state = "quote" if c == '"' else "in"
        elif state == "quote" and c == '"':
            field, state = field + c, "in"
        elif c == sep:
            fields, field, state = [*fields, field], "", "start"
        elif c == "\n":
            records.append([*fields, field])
            fields, field, state = [], "", "start"
        else:
            field += c
            state = "in" if state == "start" and c == '"' else "out"
    records.append([*fields, field])
    return [[] if r == [""] else r for r in records]


def unquoted(field):
    if not field.startswith('"'):
        return field
    out, at = "", 1
    while at < len(field):
        if field[at] == '"':
            if field[at + 1 : at + 2] != '"':
                return out + field[at + 1 :]
            at += 1
        out, at = out + field[at], at + 1
    return out


def dirty_text(seed, lines=60):
    draw = random.Random(seed)
    bits = ['"', '""', "a", "b;", ";", ",", "\n", "é", "x y", '";', ';"', '"\n']
    body = "".join(draw.choice(bits) for _ in range(lines * 4))
    return "k;v;w\n" + body.replace("\n\n\n", "\n") + ("\n" if seed % 2 else "")


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("size", ["40", "300"])
def test_records_across_splits(spark, tmp_path, seed, size):
    text = dirty_text(seed)
    (tmp_path / "f.csv").write_bytes(text.encode())
    _, *expected = plain_records(text, ";")
    with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "1"):
        records, rejects, _ = read_dirty_csv(spark, str(tmp_path))
        found = sorted((r.line_number, r.n_fields, r.raw_row) for r in rejects.collect())
        kept = [tuple(r) for r in records.orderBy(*csv.POSITION).select("k", "v", "w").collect()]
    assert found == [(i, len(r), "|".join(map(unquoted, r))) for i, r in enumerate(expected, 2) if len(r) != 3]
    values = [[unquoted(f) or None for f in [*r, "", ""][:3]] for r in expected if 0 < len(r) <= 3]
    assert kept == [tuple(v) for v in values]


def test_a_quote_left_open_in_a_large_file(spark, tmp_path, monkeypatch):
    """64 MB in 8 splits, a quote in the first line that nothing closes: one record, too long, and listed."""
    line = b"some;more;text and so on, to fill a line up to some hundred and twenty-eight letters or a little less than that many, say;x\n"
    with open(tmp_path / "f.csv", "wb") as f:
        f.write(b'a;b;c;d\n1;"open;3;4\n')
        f.write(line * (64 * 1024 * 1024 // len(line)))
    with setting(spark, "spark.sql.files.maxPartitionBytes", "8m"):
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() >= 8
        records, rejects, _ = read_dirty_csv(spark, str(tmp_path))
        assert records.count() == 0
        (only,) = rejects.collect()
        assert (only.line_number, only.n_fields) == (2, -1) and only.raw_row.startswith('1;"open;3;4\nsome;more;') and len(only.raw_row) == csv.LISTED
    (tmp_path / "small.csv").write_bytes(b'a;b;c;d\n1;"' + b"x\n" * 40 + b'";3;4\n5;6;7;8\n')
    monkeypatch.setattr(csv, "MAX_RECORD", 60)
    records, rejects, _ = read_dirty_csv(spark, str(tmp_path / "small.csv"))
    assert [tuple(r)[:4] for r in records.collect()] == [("5", "6", "7", "8")]
    assert [(r.line_number, r.n_fields) for r in rejects.collect()] == [(2, -1)]


def test_no_task_walks_a_whole_file(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b'a;b\n1;"x\ny"\n2;3\n')
    records, _, _ = read_dirty_csv(spark, str(tmp_path))
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line and "_file" in line]
    # Lines are ordered within a split; by file only its splits, or parts of one record, are.
    assert windows and all("_split" in line for line in windows)


def plans_written(monkeypatch):
    """The plans of all tables that the CSV source writes from now on."""
    plans, write = [], csv.written

    def noting(df, *a, **b):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, *a, **b)

    monkeypatch.setattr(csv, "written", noting)
    return plans


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("few", [2000, 0])
def test_records_over_batches_and_splits(spark, tmp_path, monkeypatch, seed, few):
    monkeypatch.setattr(csv, "_BATCHES", {"spark.sql.execution.arrow.maxRecordsPerBatch": "3"})
    monkeypatch.setattr("dealerlake.session.FEW", few)
    test_records_across_splits(spark, tmp_path, seed, "200")


def test_records_over_lines_are_joined_without_a_shuffle(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_bytes(b'a;b\n1;"x\ny"\n2;3\n')
    plans = plans_written(monkeypatch)
    records, _, _ = read_dirty_csv(spark, str(tmp_path))
    assert sorted((r.a, r.b) for r in records.collect()) == [("1", "x\ny"), ("2", "3")]
    walks = [p for p in plans if "MapInArrow" in p]
    assert len(walks) == 2 and not any(x in p for p in walks for x in ("Exchange hashpartitioning", "Sort ["))


def test_a_load_neither_shuffles_nor_sorts_the_lines(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text("k;v\n" + "1;2\n;;;\n" * 50)
    plans = plans_written(monkeypatch)
    load = load_files(spark, str(tmp_path), lambda df, kept: df)
    assert load.sizes == {"row": 50, "none": 50}
    (scan,) = [p for p in plans if "FileScan text" in p]
    assert "Exchange hashpartitioning(_file" not in scan and "Sort [_f" not in scan
    assert sorted(r.id for r in numbered(load, "id", 7).collect()) == list(range(7, 57))


FILES = {
    "plain.csv": "k;v;w\n1;2;3\n4;5\n\n6;7;8;9\nk;v;w\n",
    "late header.csv": "\n\nk;v;w\n1;é;3\nx\n",
    "latin.csv": "k;v;w\nJOSÉ;2;3\n1;2;3\nk;v;w\n",
    "both.csv": "k;v;w\nJOSÉ;2;3\n",
    "spans.csv": 'k;v;w\n1;"x\ny";3\nk;v;w\n4\n"";q;"\n\n"\n',
    "comma.csv": "w,k\n3,1\n",
    "other.csv": "v;k;extra\n2;1;e\n",
    "header only.csv": "k;v;w\n",
}


def write_files(folder):
    for name, text in FILES.items():
        raw = text.encode("latin-1" if name == "latin.csv" else "utf-8")
        # Some lines of this file are not UTF-8, others are and go beyond ASCII: it is Latin-1 throughout.
        (folder / name).write_bytes(raw + (b"\xe9;2;3\n" if name == "both.csv" else b""))
    (folder / "empty.csv").write_bytes(b"")


@pytest.mark.parametrize("size", ["128m", "12"])
def test_a_load_parses_what_the_two_scans_do(spark, tmp_path, size):
    write_files(tmp_path)
    with setting(spark, "spark.sql.files.maxPartitionBytes", size), setting(spark, "spark.sql.files.openCostInBytes", "1" if size == "12" else "4m"):
        records, rejects, _ = read_dirty_csv(spark, str(tmp_path))
        columns = records.columns[:-3]
        load = load_files(spark, str(tmp_path), lambda df, kept: df.withColumn("REASON", F.when(F.col("k") == "4", "four")))
        every = sorted((tuple(r) for r in records.select(csv.FILE, *columns).collect()), key=str)
        kept = sorted((tuple(r) for r in load.rows.select(csv.FILE, *columns).collect()), key=str)
        assert kept == [r for r in every if r[1] != "4"]
        assert load.sizes == {"row": len(kept), "refused": 2, "none": 4}
        assert sorted(r.k for r in load.refused.collect()) == ["4", "4"]
        assert sorted(map(tuple, load.rejects.collect())) == sorted(map(tuple, rejects.collect()))
        keys = numbered(load, "id", 100).collect()
        assert sorted(r.id for r in keys) == list(range(100, 100 + len(kept)))
        assert load.files.count() == len(FILES)


def test_the_lines_are_scanned_once(spark, tmp_path, monkeypatch):
    (tmp_path / "f.csv").write_text("k;v\n" + "1;2\n" * 50_000)
    scans = []
    lines = csv._lines
    monkeypatch.setattr(csv, "_lines", lambda *a: scans.append(1) or lines(*a))
    heads = csv.file_heads(spark, [str(tmp_path)])
    assert [(bytes(r.line), r.bytes) for r in heads.collect()] == [(b"k;v", 4 + 4 * 50_000)]
    scans.clear()
    load = load_files(spark, str(tmp_path), lambda df, kept: df)
    assert load.sizes == {"row": 50_000} and len(scans) == 2  # one of them for the first lines
    for df in (load.rows, load.refused, load.rejects, numbered(load, "id", 0)):
        assert "FileScan text" not in df._jdf.queryExecution().executedPlan().toString()


SERVICES = "Cod_Concessionaria,Cod_Filial,Data_De_Realizacao_Do_Servico,Quantidade_De_Servicos_Realizados\n"


def services(path, n, first=0):
    path.write_text(SERVICES + "".join(f"1,1-1,2025-{1 + i % 3}-5,{first + i}\n" for i in range(n)))
    return str(path)


def stored(spark, target, *columns):
    return sorted(tuple(r) for r in Bronze.from_path(spark, target.path).table(S.HIST_SERVICOS, columns).collect())


@pytest.mark.parametrize("dies", ["publish", "_write_keys", "files"])
def test_a_load_that_dies_leaves_nothing_and_runs_again(spark, tmp_path, monkeypatch, dies):
    target = Target(path=str(tmp_path / "bronze"))
    ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "a.csv", 5), target)

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if dies == "files":
            # The rows are there, the record of its many files is not.
            m.setattr(sink, "FEW", 0)
            m.setattr(sink, "new_load", lambda: "x")
            (tmp_path / "bronze" / "_loads" / S.HIST_SERVICOS / "files" / "LOAD=x").mkdir(parents=True)
        elif dies == "publish":
            m.setattr(sink, "publish", die)
        else:
            m.setattr(sink, "publish", die)
            m.setattr(sink, "_write_keys", die)
        with pytest.raises(Exception):
            ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "b.csv", 7, 100), target)
    assert len(stored(spark, target, "ID_SERVICO")) == 5
    report = ingest.run_job(spark, S.HIST_SERVICOS, str(tmp_path / "*.csv"), target)
    assert report.written == 7
    assert stored(spark, target, "ID_SERVICO") == [(i,) for i in range(12)]
    assert stored(spark, target, "QTDE_SERVICOS") == [(i,) for i in [*range(5), *range(100, 107)]]
    assert ingest.run_job(spark, S.HIST_SERVICOS, str(tmp_path / "*.csv"), target).written == 0


def test_odd_records_of_an_ordinary_load_are_listed(spark, tmp_path):
    target = Target(path=str(tmp_path / "bronze"))
    assert ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "a.csv", 2), target).written == 2
    assert not (tmp_path / "bronze" / "_rejects").exists()
    (tmp_path / "b.csv").write_text(SERVICES + "1,1-1,2025-1-5,3,x,y\n1,1-1,2025-1-6,3\n")
    assert ingest.run_job(spark, S.HIST_SERVICOS, str(tmp_path / "b.csv"), target).written == 1
    listed = spark.read.parquet(f"{target.path}/_rejects/{S.HIST_SERVICOS}/records").collect()
    assert [(r.line_number, r.n_fields, r.raw_row) for r in listed] == [(2, 6, "1|1-1|2025-1-5|3|x|y")]


def test_many_files_are_recorded_in_a_table(spark, tmp_path, monkeypatch):
    target = Target(path=str(tmp_path / "bronze"))
    monkeypatch.setattr(sink, "FEW", 2)
    monkeypatch.setattr("dealerlake.session.FEW", 1)
    for i in range(4):
        services(tmp_path / f"{i}.csv", 3, 10 * i)
    assert ingest.run_job(spark, S.HIST_SERVICOS, str(tmp_path / "*.csv"), target).written == 12
    assert (tmp_path / "bronze" / "_loads" / S.HIST_SERVICOS / "files").exists()
    services(tmp_path / "4.csv", 1, 99)
    assert ingest.run_job(spark, S.HIST_SERVICOS, str(tmp_path / "*.csv"), target).written == 1
    log = Log.of(spark, target.path, S.HIST_SERVICOS)
    assert [e["files"] is None for e in log.entries] == [True, False] and log.files(spark).count() == 5


def test_of_two_loads_at_a_time_one_fails(spark, tmp_path):
    target = Target(path=str(tmp_path / "bronze"))
    ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "a.csv", 2), target)
    log = Log.of(spark, target.path, S.HIST_SERVICOS)
    ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "b.csv", 3), target)
    rows = Log.of(spark, target.path, S.HIST_SERVICOS).rows(spark, S.SCHEMAS[S.HIST_SERVICOS])
    with pytest.raises(FileExistsError):
        sink.append_bronze(rows, S.HIST_SERVICOS, target, next_id=99, log=log)
    assert len(stored(spark, target, "ID_SERVICO")) == 5
    assert Log.of(spark, target.path, S.HIST_SERVICOS).next_id == 5


def test_rows_from_elsewhere_are_not_mixed_in(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / S.HIST_SERVICOS))
    with pytest.raises(ValueError, match="no load wrote"):
        ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "a.csv", 2), Target(path=str(tmp_path)))


STOCK = "Nome da Concessionaria;Nome da Filial;Marca do Veiculo;Custo do Veiculo;Chassi do Veiculo;Data de Entrada do Veiculo no Estoque\n"


def test_a_load_reads_only_the_buckets_of_its_keys(spark, tmp_path):
    target = Target(path=str(tmp_path / "bronze"))

    def load(name, numbers):
        (tmp_path / name).write_text(STOCK + "".join(f"CCM;CCM AUTOS 1;M{i};1;CH{i:08d};02/01/2025\n" for i in numbers))
        return ingest.run_job(spark, S.ESTOQUE_VEICULOS, str(tmp_path / name), target)

    assert load("1.csv", range(2000)).written == 2000
    assert load("2.csv", [5, 7, 5000]).written == 1
    log = Log.of(spark, target.path, S.ESTOQUE_VEICULOS)
    keys = spark.createDataFrame([("CH00000005",), ("CH00005000",)], "CHASSI_VEICULO string")
    found = sink.stored_keys(keys, S.ESTOQUE_VEICULOS, target, log)
    opened = {p.split("BUCKET=")[1].split("/")[0] for p in found.inputFiles()}
    assert 1 <= len(opened) <= 2 and len(log.entries[0]["buckets"]) > 200
    held = {r[0] for r in found.collect()}
    assert {"CH00000005", "CH00005000"} <= held and len(held) < 40
    # All keys of a load are found again.
    assert load("3.csv", range(1000, 3000)).written == 1000
    every = Bronze.from_path(spark, target.path).table(S.ESTOQUE_VEICULOS, ["CHASSI_VEICULO", "ID_ESTOQUE_VEICULO"]).collect()
    assert len({r[0] for r in every}) == len(every) == 3001 and sorted(r[1] for r in every) == list(range(3001))


def test_dates_and_months_after_two_loads(spark, tmp_path):
    target = Target(path=str(tmp_path / "bronze"))
    for name, n in (("a.csv", 3), ("b.csv", 6)):
        ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / name, n), target)
    period = Bronze.from_path(spark, target.path).table(S.HIST_SERVICOS, ["DT_REALIZACAO_SERVICO"], (date(2025, 2, 1), date(2025, 2, 28)))
    assert period.count() == 3
    assert "ANO_MES" in period._jdf.queryExecution().executedPlan().toString()


def test_period_queries_read_the_sums_of_loads(spark, tmp_path, monkeypatch):
    from dealerlake.plans import kpi

    target = Target(path=str(tmp_path / "bronze"))
    ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "a.csv", 40), target)
    # A load without sums is read by its rows.
    with monkeypatch.context() as m:
        m.setattr(sink, "SUMMED", {})
        ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "b.csv", 30), target)
    ingest.run_job(spark, S.HIST_SERVICOS, services(tmp_path / "c.csv", 20, 5), target)
    b = Bronze.from_path(spark, target.path)
    found = b.sums(["DT", "QTD", "COD_FILIAL"], (date(2025, 1, 1), date(2025, 2, 28)), ["SERVICO"])
    # A row per load, day and branch where there are sums.
    assert sum("_sums" in p for p in found.inputFiles()) >= 2 and found.count() == 2 + 20 + 2
    plain = b.transactions(["DT", "QTD"], (date(2025, 1, 1), date(2025, 2, 28)), ["SERVICO"])
    assert found.agg(F.sum("QTD")).first() == plain.agg(F.sum("QTD")).first()
    frames = {t: spark.createDataFrame([], S.SCHEMAS[t]) for t in S.SCHEMAS}
    whole = Bronze(lambda t: b._open(t) if t == S.HIST_SERVICOS else frames[t], lambda t: b._open_sums(t) if t == S.HIST_SERVICOS else None)
    rows = Bronze.from_frames(frames | {S.HIST_SERVICOS: b._open(S.HIST_SERVICOS)})
    period = date(2025, 1, 1), date(2025, 12, 31)
    for query in (kpi.kpis_period, kpi.pnl_monthly, kpi.revenue_monthly, kpi.cashflow_proxy):
        assert query(whole, *period).collect() == query(rows, *period).collect()
