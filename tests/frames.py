"""Small bronze tables for tests: rows as dicts, columns not given stay null."""

from datetime import date, timedelta
from decimal import Decimal

from dealerlake import schemas as S
from dealerlake.sources.bronze import Bronze


def bronze(spark, **tables):
    """``tables``: veic, pec, srv, ev, ep -> list of dicts of bronze columns."""
    names = {
        "veic": S.HIST_VENDAS_VEICULOS,
        "pec": S.HIST_VENDAS_PECAS,
        "srv": S.HIST_SERVICOS,
        "ev": S.ESTOQUE_VEICULOS,
        "ep": S.ESTOQUE_PECAS,
    }
    frames = {}
    for short, name in names.items():
        schema = S.SCHEMAS[name]
        rows = []
        for i, given in enumerate(tables.get(short, [])):
            row = {"COD_CONCESSIONARIA": "1", "COD_FILIAL": "1-1", "NOME_FILIAL": "A", schema[0].name: i}
            row |= {"DT_VENDA": D0, "DT_REALIZACAO_SERVICO": D0} | given
            rows.append(tuple(_typed(row.get(f.name), f) for f in schema))
        frames[name] = spark.createDataFrame(rows, schema)
    return Bronze.from_frames(frames)


def _typed(value, field):
    return Decimal(str(value)) if value is not None and field.dataType.typeName() == "decimal" else value


D0 = date(2025, 1, 1)


def day(n):
    return D0 + timedelta(days=n)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
