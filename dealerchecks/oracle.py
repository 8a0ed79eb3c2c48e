"""DuckDB SQL for every registered query, written from the query definitions, not from our plans."""

from __future__ import annotations

from dealerchecks.params import AS_OF, BRANCH_A, BRANCH_B, DEALER, DT_FIM, DT_INI, HORIZON, MA_WINDOW, N_SIM, SEED, WINDOW_DAYS

# The five bronze tables over the star schema.
TABLES = f"""
fact AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
              CAST(l_suppkey AS VARCHAR), CAST(CAST(l_quantity AS INTEGER) AS VARCHAR),
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS id,
    l_returnflag AS flag,
    CAST(n_regionkey AS VARCHAR) AS conc,
    CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS filial,
    n_name AS nome_filial,
    CAST(l_shipdate AS DATE) AS dt,
    CAST(l_quantity AS DECIMAL(18,4)) AS qtd,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS receita,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (CAST('0.08' AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
         AS DECIMAL(18,4)) AS lucro,
    c_name AS cliente, s_name AS vendedor, p_brand, p_name, p_type, o_orderpriority,
    CAST(CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS BIGINT) AS dias
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN part ON p_partkey = l_partkey
  JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation ON n_nationkey = s_nationkey
),
veic AS (
  SELECT id AS ID_VENDA_VEICULO, conc AS COD_CONCESSIONARIA, filial AS COD_FILIAL, nome_filial AS NOME_FILIAL,
    dt AS DT_VENDA, qtd AS QTDE_VENDIDA, receita AS VALOR_VENDA, lucro AS LUCRO_VENDA, cliente AS NOME_COMPRADOR,
    vendedor AS NOME_VENDEDOR, p_brand AS MARCA_VEICULO, p_name AS MODELO_VEICULO, dias AS DIAS_EM_ESTOQUE
  FROM fact WHERE flag = 'A'
),
pec AS (
  SELECT id AS ID_VENDA_PECA, conc AS COD_CONCESSIONARIA, filial AS COD_FILIAL, nome_filial AS NOME_FILIAL,
    dt AS DT_VENDA, qtd AS QTDE_VENDIDA, receita AS VALOR_VENDA, lucro AS LUCRO_VENDA, cliente AS NOME_COMPRADOR,
    vendedor AS NOME_VENDEDOR, p_name AS DESCRICAO_PECA, p_type AS CATEGORIA_PECA
  FROM fact WHERE flag = 'N'
),
srv AS (
  SELECT id AS ID_SERVICO, conc AS COD_CONCESSIONARIA, filial AS COD_FILIAL, nome_filial AS NOME_FILIAL,
    dt AS DT_REALIZACAO_SERVICO, qtd AS QTDE_SERVICOS, receita AS VALOR_TOTAL_SERVICO, lucro AS LUCRO_SERVICO,
    cliente AS NOME_CLIENTE, vendedor AS NOME_VENDEDOR_SERVICO, o_orderpriority AS DEPARTAMENTO_SERVICO,
    p_type AS CATEGORIA_SERVICO
  FROM fact WHERE flag = 'R'
),
last_sale AS (SELECT l_partkey, max(CAST(l_shipdate AS DATE)) AS last_sale FROM lineitem GROUP BY l_partkey),
ep AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS COD_CONCESSIONARIA,
    CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS COD_FILIAL, n_name AS NOME_FILIAL,
    CAST(p_retailprice AS DECIMAL(18,2)) AS VALOR_PECA_ESTOQUE, CAST(p_size % 5 AS DECIMAL(18,2)) AS QTDE_PECA_ESTOQUE,
    p_name AS DESCRICAO_PECA, p_type AS CATEGORIA_PECA, CAST(p_partkey AS VARCHAR) AS CODIGO_PECA_ESTOQUE,
    CASE WHEN p_size >= 48 THEN 'SIM' ELSE 'NAO' END AS PECA_OBSOLETA_FLAG, last_sale AS DT_ULTIMA_VENDA_PECA,
    CAST(DATE '{AS_OF}' - last_sale AS BIGINT) AS TEMPO_OBSOLETA_DIAS
  FROM part JOIN nation ON n_nationkey = p_partkey % 25 LEFT JOIN last_sale ON l_partkey = p_partkey
),
ev AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS COD_CONCESSIONARIA,
    CAST(n_regionkey AS VARCHAR) || '-' || CAST(n_nationkey AS VARCHAR) AS COD_FILIAL, n_name AS NOME_FILIAL,
    CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS CUSTO_VEICULO,
    CAST(p_size * 10 AS BIGINT) AS TEMPO_TOTAL_ESTOQUE_DIAS
  FROM part JOIN nation ON n_nationkey = p_partkey % 25 WHERE p_type IN ('LARGE', 'PROMO')
)"""

PERIOD = f"BETWEEN DATE '{DT_INI}' AND DATE '{DT_FIM}'"


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN NULL ELSE {_d(a)} / {_d(b)} END"


def _n(expression: str) -> str:
    return f"coalesce({expression}, 0)"


# All customer transactions, as the three lines share them.
TX = f"""
tx AS (
  SELECT upper(trim(NOME_COMPRADOR)) AS cliente, DT_VENDA AS dt, VALOR_VENDA AS receita, LUCRO_VENDA AS lucro, 'VEICULO' AS origem
  FROM veic WHERE DT_VENDA {PERIOD} AND NOME_COMPRADOR IS NOT NULL
  UNION ALL
  SELECT upper(trim(NOME_COMPRADOR)), DT_VENDA, VALOR_VENDA, LUCRO_VENDA, 'PECA'
  FROM pec WHERE DT_VENDA {PERIOD} AND NOME_COMPRADOR IS NOT NULL
  UNION ALL
  SELECT upper(trim(NOME_CLIENTE)), DT_REALIZACAO_SERVICO, VALOR_TOTAL_SERVICO, LUCRO_SERVICO, 'SERVICO'
  FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD} AND NOME_CLIENTE IS NOT NULL
)"""

KPIS = f"""
k AS (
  SELECT v.r + p.r + s.r AS RECEITA_TOTAL, v.l + p.l + s.l AS LUCRO_TOTAL, v.r AS RECEITA_VEIC, v.l AS LUCRO_VEIC,
    p.r AS RECEITA_PEC, p.l AS LUCRO_PEC, s.r AS RECEITA_SRV, s.l AS LUCRO_SRV, e.v AS VALOR_ESTOQUE_PEC
  FROM (SELECT sum(VALOR_VENDA) AS r, sum(LUCRO_VENDA) AS l FROM veic WHERE DT_VENDA {PERIOD}) v,
       (SELECT sum(VALOR_VENDA) AS r, sum(LUCRO_VENDA) AS l FROM pec WHERE DT_VENDA {PERIOD}) p,
       (SELECT sum(VALOR_TOTAL_SERVICO) AS r, sum(LUCRO_SERVICO) AS l FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD}) s,
       (SELECT sum(VALOR_PECA_ESTOQUE) AS v FROM ep) e
)"""
KPI_COLUMNS = ["RECEITA_TOTAL", "LUCRO_TOTAL", "RECEITA_VEIC", "LUCRO_VEIC", "RECEITA_PEC", "LUCRO_PEC",
               "RECEITA_SRV", "LUCRO_SRV", "VALOR_ESTOQUE_PEC"]

PNL = f"""
veic_m AS (SELECT CAST(date_trunc('month', DT_VENDA) AS DATE) AS mes, sum(VALOR_VENDA) AS r, sum(LUCRO_VENDA) AS l
           FROM veic WHERE DT_VENDA {PERIOD} GROUP BY 1),
pec_m AS (SELECT CAST(date_trunc('month', DT_VENDA) AS DATE) AS mes, sum(VALOR_VENDA) AS r, sum(LUCRO_VENDA) AS l
          FROM pec WHERE DT_VENDA {PERIOD} GROUP BY 1),
srv_m AS (SELECT CAST(date_trunc('month', DT_REALIZACAO_SERVICO) AS DATE) AS mes, sum(VALOR_TOTAL_SERVICO) AS r,
            sum(LUCRO_SERVICO) AS l
          FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD} GROUP BY 1),
months AS (SELECT mes FROM veic_m UNION SELECT mes FROM pec_m UNION SELECT mes FROM srv_m),
pnl AS (
  SELECT m.mes AS MES, {_n('v.r')} AS VEIC_RECEITA, {_n('v.l')} AS VEIC_LUCRO, {_n('p.r')} AS PEC_RECEITA,
    {_n('p.l')} AS PEC_LUCRO, {_n('s.r')} AS SRV_RECEITA, {_n('s.l')} AS SRV_LUCRO,
    {_n('v.l')} + {_n('p.l')} + {_n('s.l')} AS LUCRO_TOTAL, {_n('v.r')} + {_n('p.r')} + {_n('s.r')} AS RECEITA_TOTAL
  FROM months m LEFT JOIN veic_m v ON v.mes = m.mes LEFT JOIN pec_m p ON p.mes = m.mes LEFT JOIN srv_m s ON s.mes = m.mes
)"""
PNL_AMOUNTS = ["VEIC_RECEITA", "VEIC_LUCRO", "PEC_RECEITA", "PEC_LUCRO", "SRV_RECEITA", "SRV_LUCRO", "LUCRO_TOTAL",
               "RECEITA_TOTAL"]

ROI = f"""
lucro_f AS (
  SELECT COD_FILIAL, NOME_FILIAL, sum(l) AS lucro FROM (
    SELECT COD_FILIAL, NOME_FILIAL, LUCRO_VENDA AS l FROM veic WHERE DT_VENDA {PERIOD}
    UNION ALL SELECT COD_FILIAL, NOME_FILIAL, LUCRO_VENDA FROM pec WHERE DT_VENDA {PERIOD}
    UNION ALL SELECT COD_FILIAL, NOME_FILIAL, LUCRO_SERVICO FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD}
  ) GROUP BY 1, 2
),
ev_f AS (SELECT COD_FILIAL, NOME_FILIAL, sum(CUSTO_VEICULO) AS v FROM ev GROUP BY 1, 2),
ep_f AS (SELECT COD_FILIAL, NOME_FILIAL, sum(VALOR_PECA_ESTOQUE) AS v FROM ep GROUP BY 1, 2),
roi AS (
  SELECT l.COD_FILIAL, l.NOME_FILIAL, {_d('l.lucro')} AS LUCRO_TOTAL,
    {_d(_n('e.v') + ' + ' + _n('p.v'))} AS CAPITAL_ESTOQUE,
    {_ratio('l.lucro', '(' + _n('e.v') + ' + ' + _n('p.v') + ')')} AS ROI_ESTOQUE
  FROM lucro_f l LEFT JOIN ev_f e ON e.COD_FILIAL = l.COD_FILIAL LEFT JOIN ep_f p ON p.COD_FILIAL = l.COD_FILIAL
)"""

STOCK = f"""
stock_k AS (
  SELECT (SELECT sum(CUSTO_VEICULO) FROM ev) AS ESTOQUE_VEIC_VALOR,
    (SELECT {_d('sum(TEMPO_TOTAL_ESTOQUE_DIAS)')} / count(*) FROM ev) AS ESTOQUE_VEIC_DIAS_MEDIO_ATUAL,
    (SELECT sum(VALOR_PECA_ESTOQUE) FROM ep) AS ESTOQUE_PEC_VALOR
)"""

TURNOVER = f"""
sold AS (SELECT CATEGORIA_PECA, sum(VALOR_VENDA) AS v FROM pec WHERE DT_VENDA {PERIOD} GROUP BY 1),
held AS (SELECT CATEGORIA_PECA, sum(VALOR_PECA_ESTOQUE) AS v FROM ep GROUP BY 1),
cats AS (SELECT CATEGORIA_PECA FROM sold UNION SELECT CATEGORIA_PECA FROM held),
turnover AS (
  SELECT c.CATEGORIA_PECA, {_d(_n('s.v'))} AS RECEITA_PERIODO, {_d(_n('h.v'))} AS VALOR_ESTOQUE,
    {_ratio(_n('s.v'), _n('h.v'))} AS GIRO_PROXY
  FROM cats c LEFT JOIN sold s ON s.CATEGORIA_PECA = c.CATEGORIA_PECA LEFT JOIN held h ON h.CATEGORIA_PECA = c.CATEGORIA_PECA
)"""

STOCK_DAYS = f"""
stock_days AS (
  SELECT CAST(date_trunc('month', DT_VENDA) AS DATE) AS MES,
    {_d('sum(coalesce(DIAS_EM_ESTOQUE, 0))')} / count(*) AS DIAS_MEDIO_VENDA
  FROM veic WHERE DT_VENDA {PERIOD} GROUP BY 1
)"""


def _daily_line(name: str, table: str, day: str, quantity: str, revenue: str, profit: str) -> str:
    return f"""
{name}_d AS (
  SELECT {day} AS dia, sum({quantity}) AS q, sum({revenue}) AS r, sum({profit}) AS l,
    CAST({_ratio(f'sum({profit})', f'sum({revenue})')} AS DECIMAL(24,12)) AS m
  FROM {table} WHERE {day} BETWEEN DATE '{AS_OF}' - 30 AND DATE '{AS_OF}' GROUP BY 1
),
{name}_t AS (
  SELECT
    (SELECT q FROM {name}_d WHERE dia = DATE '{AS_OF}') AS q0, (SELECT r FROM {name}_d WHERE dia = DATE '{AS_OF}') AS r0,
    (SELECT l FROM {name}_d WHERE dia = DATE '{AS_OF}') AS l0,
    (SELECT q FROM {name}_d WHERE dia = DATE '{AS_OF}' - 1) AS q1, (SELECT r FROM {name}_d WHERE dia = DATE '{AS_OF}' - 1) AS r1,
    {_d('sum(q)')} / count(*) AS qm, {_d('sum(r)')} / count(*) AS rm, {_d('sum(m)')} / count(m) AS mm
  FROM {name}_d WHERE dia < DATE '{AS_OF}'
)"""


DAILY = ",".join(
    [
        _daily_line("v", "veic", "DT_VENDA", "QTDE_VENDIDA", "VALOR_VENDA", "LUCRO_VENDA"),
        _daily_line("p", "pec", "DT_VENDA", "QTDE_VENDIDA", "VALOR_VENDA", "LUCRO_VENDA"),
        _daily_line("s", "srv", "DT_REALIZACAO_SERVICO", "QTDE_SERVICOS", "VALOR_TOTAL_SERVICO", "LUCRO_SERVICO"),
    ]
)


def _branch_line(name: str, table: str, day: str, quantity: str, revenue: str, profit: str) -> str:
    return f"""
{name}_b AS (SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL, sum({quantity}) AS q, sum({revenue}) AS r, sum({profit}) AS l
  FROM {table} WHERE {day} {PERIOD} GROUP BY 1, 2, 3)"""


def _branch_columns(alias: str, prefix: str) -> str:
    return (
        f"{_d(_n(alias + '.q'))} AS {prefix}_QTD, {_d(_n(alias + '.r'))} AS {prefix}_RECEITA, "
        f"{_d(_n(alias + '.l'))} AS {prefix}_LUCRO, {_ratio(_n(alias + '.l'), _n(alias + '.r'))} AS {prefix}_MARGEM"
    )


_PROFIT = f"({_n('v.l')} + {_n('p.l')} + {_n('s.l')})"
_CAPITAL = f"({_n('ev_s.v')} + {_n('ep_s.v')})"
BRANCH_TIES = "COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL"
PERFORMANCE = f"""
{_branch_line('v', 'veic', 'DT_VENDA', 'QTDE_VENDIDA', 'VALOR_VENDA', 'LUCRO_VENDA')},
{_branch_line('p', 'pec', 'DT_VENDA', 'QTDE_VENDIDA', 'VALOR_VENDA', 'LUCRO_VENDA')},
{_branch_line('s', 'srv', 'DT_REALIZACAO_SERVICO', 'QTDE_SERVICOS', 'VALOR_TOTAL_SERVICO', 'LUCRO_SERVICO')},
ev_b AS (SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL, sum(CUSTO_VEICULO) AS v FROM ev GROUP BY 1, 2, 3),
ep_b AS (SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL, sum(VALOR_PECA_ESTOQUE) AS v FROM ep GROUP BY 1, 2, 3),
branches AS (
  SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL FROM v_b
  UNION SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL FROM p_b
  UNION SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL FROM s_b
  UNION SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL FROM ev_b
  UNION SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL FROM ep_b
),
perf AS (
  SELECT b.COD_CONCESSIONARIA, b.COD_FILIAL, b.NOME_FILIAL,
    {_branch_columns('v', 'VEIC')}, {_branch_columns('p', 'PEC')}, {_branch_columns('s', 'SRV')},
    {_d(_PROFIT)} AS LUCRO_TOTAL, {_d(_n('v.r') + ' + ' + _n('p.r') + ' + ' + _n('s.r'))} AS RECEITA_TOTAL,
    {_d(_n('ev_s.v'))} AS ESTOQUE_VEICULOS, {_d(_n('ep_s.v'))} AS ESTOQUE_PECAS, {_d(_CAPITAL)} AS CAPITAL_ESTOQUE,
    {_ratio(_PROFIT, _CAPITAL)} AS ROI_ESTOQUE
  FROM branches b
  LEFT JOIN v_b v ON v.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA AND v.COD_FILIAL = b.COD_FILIAL
  LEFT JOIN p_b p ON p.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA AND p.COD_FILIAL = b.COD_FILIAL
  LEFT JOIN s_b s ON s.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA AND s.COD_FILIAL = b.COD_FILIAL
  LEFT JOIN ev_b ev_s ON ev_s.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA AND ev_s.COD_FILIAL = b.COD_FILIAL
  LEFT JOIN ep_b ep_s ON ep_s.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA AND ep_s.COD_FILIAL = b.COD_FILIAL
)"""
BEST_ROI = f"ORDER BY ROI_ESTOQUE DESC NULLS LAST, LUCRO_TOTAL DESC, {BRANCH_TIES} LIMIT 50"

RISK = f"""
part_sales AS (SELECT DESCRICAO_PECA, CATEGORIA_PECA, sum(QTDE_VENDIDA) AS q FROM pec
  WHERE DT_VENDA BETWEEN DATE '{AS_OF}' - {WINDOW_DAYS} AND DATE '{AS_OF}' GROUP BY 1, 2),
part_stock AS (SELECT DESCRICAO_PECA, CATEGORIA_PECA, sum(QTDE_PECA_ESTOQUE) AS q FROM ep GROUP BY 1, 2),
risk AS (
  SELECT s.CATEGORIA_PECA, s.DESCRICAO_PECA, {_d('s.q')} AS ESTOQUE_ATUAL, {_d('v.q')} AS VENDAS_ND,
    {_d('v.q')} / {WINDOW_DAYS}.0::DOUBLE AS CONSUMO_MEDIO_DIA,
    {_d('s.q')} / ({_d('v.q')} / {WINDOW_DAYS}.0::DOUBLE) AS DIAS_COBERTURA
  FROM part_stock s JOIN part_sales v ON v.DESCRICAO_PECA = s.DESCRICAO_PECA AND v.CATEGORIA_PECA = s.CATEGORIA_PECA
  WHERE s.q > 0 AND v.q > 0 AND {_d('s.q')} / ({_d('v.q')} / {WINDOW_DAYS}.0::DOUBLE) <= 30
)"""

# Per sale the after-sales of the same buyer and dealer inside the window, by plain range joins.
INTEGRATED = f"""
sale AS (SELECT * FROM veic WHERE DT_VENDA {PERIOD}),
srv_w AS (
  SELECT b.ID_VENDA_VEICULO, sum(s.VALOR_TOTAL_SERVICO) AS r, sum(s.LUCRO_SERVICO) AS l
  FROM sale b JOIN srv s ON s.NOME_CLIENTE = b.NOME_COMPRADOR AND s.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA
    AND s.DT_REALIZACAO_SERVICO BETWEEN b.DT_VENDA AND b.DT_VENDA + {WINDOW_DAYS}
  GROUP BY 1
),
pec_w AS (
  SELECT b.ID_VENDA_VEICULO, sum(p.VALOR_VENDA) AS r, sum(p.LUCRO_VENDA) AS l
  FROM sale b JOIN pec p ON p.NOME_COMPRADOR = b.NOME_COMPRADOR AND p.COD_CONCESSIONARIA = b.COD_CONCESSIONARIA
    AND p.DT_VENDA BETWEEN b.DT_VENDA AND b.DT_VENDA + {WINDOW_DAYS}
  GROUP BY 1
),
integ AS (
  SELECT b.ID_VENDA_VEICULO, b.COD_CONCESSIONARIA, b.COD_FILIAL, b.NOME_FILIAL, b.DT_VENDA, b.NOME_COMPRADOR,
    b.MARCA_VEICULO, b.MODELO_VEICULO, b.VALOR_VENDA AS rv, b.LUCRO_VENDA AS lv, {_n('s.r')} AS rs, {_n('s.l')} AS ls,
    {_n('p.r')} AS rp, {_n('p.l')} AS lp, b.VALOR_VENDA + {_n('s.r')} + {_n('p.r')} AS ri,
    b.LUCRO_VENDA + {_n('s.l')} + {_n('p.l')} AS li
  FROM sale b LEFT JOIN srv_w s ON s.ID_VENDA_VEICULO = b.ID_VENDA_VEICULO
  LEFT JOIN pec_w p ON p.ID_VENDA_VEICULO = b.ID_VENDA_VEICULO
)"""
NEWEST = f"""
newest AS (
  SELECT COD_CONCESSIONARIA, COD_FILIAL, NOME_FILIAL, DT_VENDA, NOME_COMPRADOR, MARCA_VEICULO, MODELO_VEICULO,
    {_d('rv')} AS RECEITA_VEICULO, {_d('lv')} AS LUCRO_VEICULO, {_ratio('lv', 'rv')} AS MARGEM_VEICULO,
    {_d('rs')} AS RECEITA_SERVICOS, {_d('ls')} AS LUCRO_SERVICOS, {_ratio('ls', 'rs')} AS MARGEM_SERVICOS,
    {_d('rp')} AS RECEITA_PECAS, {_d('lp')} AS LUCRO_PECAS, {_ratio('lp', 'rp')} AS MARGEM_PECAS,
    {_d('li')} AS LUCRO_INTEGRADO, {_d('ri')} AS RECEITA_INTEGRADA, {_ratio('li', 'ri')} AS MARGEM_INTEGRADA, ri, li,
    ID_VENDA_VEICULO AS id
  FROM integ
)"""
MODELS = f"""
models AS (
  SELECT MARCA_VEICULO, MODELO_VEICULO, count(*) AS QTD_VENDAS, {_d('sum(rv)')} AS RECEITA_VEICULO,
    {_d('sum(rs)')} AS RECEITA_SERVICOS, {_d('sum(rp)')} AS RECEITA_PECAS, {_d('sum(ri)')} AS RECEITA_INTEGRADA,
    {_d('sum(li)')} AS LUCRO_INTEGRADO, {_ratio('sum(li)', 'sum(ri)')} AS MARGEM_INTEGRADA
  FROM integ GROUP BY 1, 2 HAVING sum(rv) >= 0
  ORDER BY MARGEM_INTEGRADA DESC NULLS LAST, RECEITA_INTEGRADA DESC, MARCA_VEICULO, MODELO_VEICULO LIMIT 15
)"""

RFM = f"""
rfm AS (
  SELECT cliente AS CLIENTE, max(dt) AS ULTIMA_DATA, CAST(DATE '{DT_FIM}' - max(dt) AS BIGINT) AS RECENCY_DIAS,
    count(*) AS FREQUENCY, sum(receita) AS MONETARY
  FROM tx GROUP BY cliente
)"""
# Quintile edges on places 1..n lie at 1 + k (n - 1) / 5; a place on an edge belongs below it.
SCORED = """
placed AS (
  SELECT *, count(*) OVER () AS n, row_number() OVER (ORDER BY RECENCY_DIAS, CLIENTE) AS pr,
    row_number() OVER (ORDER BY FREQUENCY, CLIENTE) AS pf, row_number() OVER (ORDER BY MONETARY, CLIENTE) AS pm
  FROM rfm
),
scored AS (
  SELECT CLIENTE, ULTIMA_DATA, RECENCY_DIAS, FREQUENCY, MONETARY,
    CAST(5 - ((pr - 1) * 5 > n - 1)::INT - ((pr - 1) * 5 > 2 * (n - 1))::INT - ((pr - 1) * 5 > 3 * (n - 1))::INT
      - ((pr - 1) * 5 > 4 * (n - 1))::INT AS INTEGER) AS R_SCORE,
    CAST(1 + ((pf - 1) * 5 > n - 1)::INT + ((pf - 1) * 5 > 2 * (n - 1))::INT + ((pf - 1) * 5 > 3 * (n - 1))::INT
      + ((pf - 1) * 5 > 4 * (n - 1))::INT AS INTEGER) AS F_SCORE,
    CAST(1 + ((pm - 1) * 5 > n - 1)::INT + ((pm - 1) * 5 > 2 * (n - 1))::INT + ((pm - 1) * 5 > 3 * (n - 1))::INT
      + ((pm - 1) * 5 > 4 * (n - 1))::INT AS INTEGER) AS M_SCORE
  FROM placed
),
segmented AS (
  SELECT *, CASE
      WHEN R_SCORE >= 4 AND F_SCORE >= 4 AND M_SCORE >= 4 THEN 'VIP'
      WHEN R_SCORE >= 4 AND F_SCORE >= 4 THEN 'Crescimento'
      WHEN R_SCORE < 4 AND (F_SCORE >= 4 OR M_SCORE >= 4) THEN 'Risco'
      ELSE 'Dorminte' END AS SEGMENTO
  FROM scored
)"""
RFM_OUT = f"CLIENTE, ULTIMA_DATA, RECENCY_DIAS, FREQUENCY, {_d('MONETARY')} AS MONETARY"

# Daily series of the three lines, one row per calendar day.
SERIES = f"""
calendar AS (SELECT CAST(unnest(generate_series(DATE '{DT_INI}', DATE '{DT_FIM}', INTERVAL 1 DAY)) AS DATE) AS dia),
raw_series AS (
  SELECT 'VEICULO' AS serie, DT_VENDA AS dia, sum(QTDE_VENDIDA) AS y FROM veic WHERE DT_VENDA {PERIOD} GROUP BY 2
  UNION ALL SELECT 'PECA', DT_VENDA, sum(VALOR_VENDA) FROM pec WHERE DT_VENDA {PERIOD} GROUP BY 2
  UNION ALL SELECT 'SERVICO', DT_REALIZACAO_SERVICO, sum(VALOR_TOTAL_SERVICO) FROM srv
    WHERE DT_REALIZACAO_SERVICO {PERIOD} GROUP BY 2
),
dense AS (
  SELECT s.serie, c.dia, coalesce(r.y, 0) AS y
  FROM (SELECT DISTINCT serie FROM raw_series) s CROSS JOIN calendar c
  LEFT JOIN raw_series r ON r.serie = s.serie AND r.dia = c.dia
)"""
BRANCH_SERIES = f"""
calendar AS (SELECT CAST(unnest(generate_series(DATE '{DT_INI}', DATE '{DT_FIM}', INTERVAL 1 DAY)) AS DATE) AS dia),
raw_series AS (
  SELECT COD_CONCESSIONARIA || '|' || COD_FILIAL AS serie, DT_VENDA AS dia, sum(VALOR_VENDA) AS y
  FROM pec WHERE DT_VENDA {PERIOD} GROUP BY 1, 2
),
dense AS (
  SELECT s.serie, c.dia, coalesce(r.y, 0) AS y
  FROM (SELECT DISTINCT serie FROM raw_series) s CROSS JOIN calendar c
  LEFT JOIN raw_series r ON r.serie = s.serie AND r.dia = c.dia
)"""
FITTED = f"""
numbered AS (
  SELECT serie, dia, y, row_number() OVER (PARTITION BY serie ORDER BY dia) AS place, count(*) OVER (PARTITION BY serie) AS n,
    sum(y) OVER (PARTITION BY serie ORDER BY dia ROWS BETWEEN {MA_WINDOW} PRECEDING AND 1 PRECEDING) AS before
  FROM dense
),
ends AS (
  SELECT serie, max(dia) AS last_day, max(n) AS n,
    {_d(f'sum(y) FILTER (WHERE place <= {MA_WINDOW})')} / {MA_WINDOW}.0::DOUBLE AS head,
    {_d(f'sum(y) FILTER (WHERE place > n - {MA_WINDOW})')} / {MA_WINDOW}.0::DOUBLE AS yhat
  FROM numbered GROUP BY serie
),
resid AS (
  SELECT d.serie, d.place, {_d('d.y')} -
    CASE WHEN d.place <= {MA_WINDOW} THEN e.head ELSE {_d('d.before')} / {MA_WINDOW}.0::DOUBLE END AS r
  FROM numbered d JOIN ends e ON e.serie = d.serie
)"""


def _percentile(values: str, n: str, p: str) -> str:
    """Linear interpolation between the two neighbours of position (n - 1) p in a sorted list."""
    pos = f"(({n} - 1) * {p}::DOUBLE)"
    lo, hi = f"{values}[CAST(floor({pos}) AS BIGINT) + 1]", f"{values}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return (
        f"CASE WHEN {lo} = {hi} THEN {lo} "
        f"ELSE (ceil({pos}) - {pos}) * {lo} + ({pos} - floor({pos})) * {hi} END"
    )


_BOUNDS = {"YHAT_80_LO": "0.1", "YHAT_80_HI": "0.9", "YHAT_95_LO": "0.025", "YHAT_95_HI": "0.975"}
FORECAST = f"""{FITTED},
sorted AS (
  SELECT r.serie, count(*) AS n, list(greatest(0.0::DOUBLE, e.yhat + r.r) ORDER BY greatest(0.0::DOUBLE, e.yhat + r.r)) AS v
  FROM resid r JOIN ends e ON e.serie = r.serie GROUP BY r.serie
),
forecast AS (
  SELECT e.serie, h.t AS T, e.last_day + CAST(h.t AS INTEGER) AS DIA, e.yhat AS YHAT,
    {', '.join(f"{_percentile('s.v', 's.n', p)} AS {name}" for name, p in _BOUNDS.items())}
  FROM ends e JOIN sorted s ON s.serie = e.serie
  CROSS JOIN (SELECT CAST(unnest(range(1, {HORIZON + 1})) AS INTEGER) AS t) h
)"""
BOOTSTRAP = f"""{FITTED},
picks AS (
  SELECT e.serie, e.yhat, h.t, 1 +
    CAST('0x' || substr(md5(concat_ws('|', '{SEED}', e.serie, CAST(m.sim AS VARCHAR), CAST(h.t AS VARCHAR))), 1, 8) AS BIGINT) % e.n
      AS place
  FROM ends e
  CROSS JOIN (SELECT CAST(unnest(range(1, {HORIZON + 1})) AS INTEGER) AS t) h
  CROSS JOIN (SELECT CAST(unnest(range(1, {N_SIM + 1})) AS INTEGER) AS sim) m
),
draws AS (
  SELECT k.serie, k.t, greatest(0.0::DOUBLE, k.yhat + r.r) AS d
  FROM picks k JOIN resid r ON r.serie = k.serie AND r.place = k.place
),
sorted AS (SELECT serie, t, count(*) AS n, list(d ORDER BY d) AS v FROM draws GROUP BY serie, t),
forecast AS (
  SELECT e.serie, s.t AS T, e.last_day + CAST(s.t AS INTEGER) AS DIA, e.yhat AS YHAT,
    {', '.join(f"{_percentile('s.v', 's.n', p)} AS {name}" for name, p in _BOUNDS.items())}
  FROM ends e JOIN sorted s ON s.serie = e.serie
)"""
FORECAST_OUT = f"T, DIA, YHAT, {', '.join(_BOUNDS)}"


def _q(*ctes: str, select: str) -> str:
    return "WITH " + ",".join([TABLES, *ctes]) + "\n" + select


def _doubles(columns) -> str:
    return ", ".join(f"{_d(c)} AS {c}" for c in columns)


def _text(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {_d(x)}), ',.', '.,')"


def _services_by(key: str, order: str) -> str:
    return f"""SELECT {key}, {_d('sum(QTDE_SERVICOS)')} AS QTDE_SERVICOS, {_d('sum(VALOR_TOTAL_SERVICO)')} AS RECEITA,
      {_d('sum(LUCRO_SERVICO)')} AS LUCRO, {_ratio('sum(LUCRO_SERVICO)', 'sum(VALOR_TOTAL_SERVICO)')} AS MARGEM
    FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD} GROUP BY {key} ORDER BY {order} DESC NULLS LAST, {key} LIMIT 20"""


def _series_sql(table: str, day: str, value: str) -> str:
    return f"SELECT {day} AS DIA, {_d(f'sum({value})')} AS Y FROM {table} WHERE {day} {PERIOD} GROUP BY 1"


DAILY_PARTS = f"""{_d('q0')} AS QTD_HOJE, {_d('r0')} AS RECEITA_HOJE, {_ratio('l0', 'r0')} AS MARGEM_HOJE,
    qm AS QTD_MEDIA_30D, rm AS RECEITA_MEDIA_30D, mm AS MARGEM_MEDIA_30D"""

# The metrics compared, their labels, and whether they are shares.
BENCH = [
    ("ROI (lucro/estoque)", "ROI_ESTOQUE", True),
    ("Lucro total", "LUCRO_TOTAL", False),
    ("Capital em estoque", "CAPITAL_ESTOQUE", False),
    ("Margem veículos", "VEIC_MARGEM", True),
    ("Margem peças", "PEC_MARGEM", True),
    ("Margem serviços", "SRV_MARGEM", True),
    ("Receita total", "RECEITA_TOTAL", False),
]


def _benchmark(formatted: bool) -> str:
    def cell(column: str, share: bool, branch: str) -> str:
        value = f"(SELECT {column} FROM perf WHERE NOME_FILIAL = '{branch}' ORDER BY ROI_ESTOQUE DESC NULLS LAST LIMIT 1)"
        if not formatted:
            return value
        return f"coalesce({_text(value + ' * 100')} || '%', '-')" if share else f"'R$ ' || {_text(_n(value))}"

    return " UNION ALL ".join(
        f"SELECT '{label}' AS METRICA, {cell(c, share, BRANCH_A)} AS FILIAL_A, {cell(c, share, BRANCH_B)} AS FILIAL_B"
        for label, c, share in BENCH
    )


def business_sql() -> dict[str, str]:
    """Queries and the analytics on their results."""
    perf_columns = "SELECT * FROM perf"
    return {
        "kpis_period": _q(KPIS, select=f"SELECT {_doubles(KPI_COLUMNS)} FROM k"),
        "revenue_monthly": _q(PNL, select=f"SELECT MES, {_d('RECEITA_TOTAL')} AS RECEITA_TOTAL FROM pnl"),
        "pnl_monthly": _q(PNL, select=f"SELECT MES, {_doubles(PNL_AMOUNTS)} FROM pnl"),
        "roi_by_branch": _q(ROI, select="SELECT * FROM roi"),
        "profit_by_vendor": _q(
            select=f"""SELECT vendedor AS VENDEDOR, {_d('sum(l)')} AS LUCRO_TOTAL, {_d('sum(r)')} AS RECEITA_TOTAL,
              {_ratio('sum(l)', 'sum(r)')} AS MARGEM
            FROM (
              SELECT NOME_VENDEDOR AS vendedor, LUCRO_VENDA AS l, VALOR_VENDA AS r FROM veic WHERE DT_VENDA {PERIOD}
              UNION ALL SELECT NOME_VENDEDOR, LUCRO_VENDA, VALOR_VENDA FROM pec WHERE DT_VENDA {PERIOD}
              UNION ALL SELECT NOME_VENDEDOR_SERVICO, LUCRO_SERVICO, VALOR_TOTAL_SERVICO FROM srv
                WHERE DT_REALIZACAO_SERVICO {PERIOD}
            ) WHERE vendedor IS NOT NULL GROUP BY vendedor ORDER BY sum(l) DESC, vendedor LIMIT 20"""
        ),
        "stock_kpis": _q(
            STOCK,
            select=f"""SELECT {_doubles(['ESTOQUE_VEIC_VALOR'])}, ESTOQUE_VEIC_DIAS_MEDIO_ATUAL,
              {_doubles(['ESTOQUE_PEC_VALOR'])} FROM stock_k""",
        ),
        "top_parts_stock_value": _q(
            select=f"""SELECT DESCRICAO_PECA, CATEGORIA_PECA, {_d('sum(QTDE_PECA_ESTOQUE)')} AS QTDE,
              {_d('sum(VALOR_PECA_ESTOQUE)')} AS VALOR_ESTOQUE
            FROM ep GROUP BY 1, 2 ORDER BY sum(VALOR_PECA_ESTOQUE) DESC, 1, 2 LIMIT 20"""
        ),
        "part_turnover_by_category": _q(TURNOVER, select="SELECT * FROM turnover"),
        "stock_days_monthly": _q(STOCK_DAYS, select="SELECT * FROM stock_days"),
        "daily_vehicles": _q(
            DAILY,
            select=f"""SELECT {_d('q0')} AS QTD_HOJE, {_d('q1')} AS QTD_ONTEM, qm AS QTD_MEDIA_30D,
              {_d('r0')} AS RECEITA_HOJE, {_d('r1')} AS RECEITA_ONTEM, rm AS RECEITA_MEDIA_30D FROM v_t""",
        ),
        "daily_parts": _q(DAILY, select=f"SELECT {DAILY_PARTS} FROM p_t"),
        "top10_parts_today": _q(
            select=f"""SELECT DESCRICAO_PECA, {_d('sum(QTDE_VENDIDA)')} AS QTD, {_d('sum(VALOR_VENDA)')} AS RECEITA
            FROM pec WHERE DT_VENDA = DATE '{AS_OF}' GROUP BY 1
            ORDER BY sum(QTDE_VENDIDA) DESC, sum(VALOR_VENDA) DESC, 1 LIMIT 10"""
        ),
        "daily_services": _q(
            DAILY,
            select=f"""SELECT {_d('q0')} AS QTD_HOJE, qm AS QTD_MEDIA_30D, {_d('r0')} AS RECEITA_HOJE,
              rm AS RECEITA_MEDIA_30D FROM s_t""",
        ),
        "series_vehicles_units": _q(select=_series_sql("veic", "DT_VENDA", "QTDE_VENDIDA")),
        "series_parts_revenue": _q(select=_series_sql("pec", "DT_VENDA", "VALOR_VENDA")),
        "series_services_revenue": _q(select=_series_sql("srv", "DT_REALIZACAO_SERVICO", "VALOR_TOTAL_SERVICO")),
        "branch_performance": _q(PERFORMANCE, select=f"{perf_columns} {BEST_ROI}"),
        "branch_performance_collapsed": _q(PERFORMANCE, select=f"{perf_columns} {BEST_ROI}"),
        "stockout_risk": _q(RISK, select="SELECT * FROM risk ORDER BY DIAS_COBERTURA, CATEGORIA_PECA, DESCRICAO_PECA LIMIT 30"),
        "obsolete_parts": _q(
            select=f"""SELECT CATEGORIA_PECA, DESCRICAO_PECA, CODIGO_PECA_ESTOQUE,
              {_doubles(['QTDE_PECA_ESTOQUE', 'VALOR_PECA_ESTOQUE'])}, PECA_OBSOLETA_FLAG, TEMPO_OBSOLETA_DIAS,
              DT_ULTIMA_VENDA_PECA
            FROM ep WHERE upper(trim(PECA_OBSOLETA_FLAG)) IN ('SIM', 'S', 'Y', 'YES', '1', 'TRUE')
              OR coalesce(TEMPO_OBSOLETA_DIAS, 0) >= 60
            ORDER BY coalesce(TEMPO_OBSOLETA_DIAS, 0) DESC, VALOR_PECA_ESTOQUE DESC, CODIGO_PECA_ESTOQUE LIMIT 50"""
        ),
        "services_kpis": _q(
            select=f"""SELECT count(*) AS REGISTROS, {_d('sum(QTDE_SERVICOS)')} AS QTDE_SERVICOS,
              {_d('sum(VALOR_TOTAL_SERVICO)')} AS RECEITA_SERVICOS, {_d('sum(LUCRO_SERVICO)')} AS LUCRO_SERVICOS,
              {_ratio('sum(LUCRO_SERVICO)', 'sum(VALOR_TOTAL_SERVICO)')} AS MARGEM_SERVICOS,
              {_d('sum(VALOR_TOTAL_SERVICO)')} / count(*) AS TICKET_MEDIO_POR_REGISTRO,
              {_d('sum(QTDE_SERVICOS)')} / count(*) AS QTDE_MEDIA_SERVICOS_POR_REGISTRO
            FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD}"""
        ),
        "named_binds": _q(
            select=" UNION ALL ".join(
                f"""SELECT '{label}' AS DEALER, COD_FILIAL, count(*) AS REGISTROS, {_d('sum(VALOR_TOTAL_SERVICO)')} AS RECEITA
            FROM srv WHERE DT_REALIZACAO_SERVICO BETWEEN DATE '{DT_INI}' AND DATE '{AS_OF}' AND {condition} GROUP BY COD_FILIAL"""
                for label, condition in ((DEALER, f"COD_CONCESSIONARIA = '{DEALER}'"), ("all", "true"))
            )
        ),
        "services_kpis_of_dealer": _q(
            select=f"""SELECT count(*) AS REGISTROS, {_d('sum(QTDE_SERVICOS)')} AS QTDE_SERVICOS,
              {_d('sum(VALOR_TOTAL_SERVICO)')} AS RECEITA_SERVICOS, {_d('sum(LUCRO_SERVICO)')} AS LUCRO_SERVICOS,
              {_ratio('sum(LUCRO_SERVICO)', 'sum(VALOR_TOTAL_SERVICO)')} AS MARGEM_SERVICOS,
              {_d('sum(VALOR_TOTAL_SERVICO)')} / count(*) AS TICKET_MEDIO_POR_REGISTRO,
              {_d('sum(QTDE_SERVICOS)')} / count(*) AS QTDE_MEDIA_SERVICOS_POR_REGISTRO
            FROM srv WHERE DT_REALIZACAO_SERVICO {PERIOD} AND COD_CONCESSIONARIA = '{DEALER}'"""
        ),
        "integrated_margin_of_dealer": _q(
            INTEGRATED,
            NEWEST,
            select=f"""SELECT * EXCLUDE (ri, li, id) FROM newest WHERE COD_CONCESSIONARIA = '{DEALER}'
              ORDER BY DT_VENDA DESC, id LIMIT 200""",
        ),
        "services_by_department": _q(select=_services_by("DEPARTAMENTO_SERVICO", "RECEITA")),
        "services_by_category": _q(select=_services_by("CATEGORIA_SERVICO", "LUCRO")),
        "integrated_margin": _q(
            INTEGRATED, NEWEST, select="SELECT * EXCLUDE (ri, li, id) FROM newest ORDER BY DT_VENDA DESC, id LIMIT 200"
        ),
        "model_ranking": _q(INTEGRATED, MODELS, select="SELECT * FROM models"),
        "cashflow_proxy": _q(
            select=f"""SELECT 'Capital imobilizado (estoque)' AS TIPO, 'Veículos (custo)' AS ITEM,
                {_d('sum(CUSTO_VEICULO)')} AS VALOR FROM ev
              UNION ALL SELECT 'Capital imobilizado (estoque)', 'Peças (valor)', {_d('sum(VALOR_PECA_ESTOQUE)')} FROM ep
              UNION ALL SELECT 'Entradas no período', 'Receita veículos', {_d('sum(VALOR_VENDA)')} FROM veic WHERE DT_VENDA {PERIOD}
              UNION ALL SELECT 'Entradas no período', 'Receita peças', {_d('sum(VALOR_VENDA)')} FROM pec WHERE DT_VENDA {PERIOD}
              UNION ALL SELECT 'Entradas no período', 'Receita serviços', {_d('sum(VALOR_TOTAL_SERVICO)')} FROM srv
                WHERE DT_REALIZACAO_SERVICO {PERIOD}"""
        ),
        "customer_funnel": _q(
            TX,
            """v AS (SELECT DISTINCT cliente FROM tx WHERE origem = 'VEICULO'),
               p AS (SELECT DISTINCT cliente FROM tx WHERE origem = 'PECA'),
               s AS (SELECT DISTINCT cliente FROM tx WHERE origem = 'SERVICO')""",
            select="""SELECT (SELECT count(*) FROM v) AS CLIENTES_VEIC,
              (SELECT count(*) FROM v JOIN s ON s.cliente = v.cliente) AS COM_SERVICO_POSTERIOR,
              (SELECT count(*) FROM v JOIN p ON p.cliente = v.cliente) AS COM_COMPRA_PECAS""",
        ),
        "customer_ltv": _q(
            TX,
            select=f"""SELECT cliente AS CLIENTE, count(*) AS TRANSACOES, min(dt) AS PRIMEIRA_DATA, max(dt) AS ULTIMA_DATA,
              {_d('sum(receita)')} AS RECEITA_TOTAL, {_d('sum(lucro)')} AS LUCRO_TOTAL
            FROM tx GROUP BY cliente ORDER BY sum(receita) DESC, cliente LIMIT 50""",
        ),
        "rfm_base": _q(TX, RFM, select=f"SELECT {RFM_OUT} FROM rfm"),
        "rfm_scores": _q(TX, RFM, SCORED, select=f"SELECT {RFM_OUT}, R_SCORE, F_SCORE, M_SCORE FROM scored"),
        "rfm_segments": _q(
            TX, RFM, SCORED, select=f"SELECT {RFM_OUT}, R_SCORE, F_SCORE, M_SCORE, SEGMENTO FROM segmented"
        ),
        "rfm_segment_summary": _q(
            TX,
            RFM,
            SCORED,
            select=f"""SELECT SEGMENTO, count(*) AS CLIENTES, {_d('sum(MONETARY)')} AS RECEITA,
              {_d('sum(FREQUENCY)')} / count(*) AS FREQ_MEDIA, {_d('sum(RECENCY_DIAS)')} / count(*) AS RECENCY_MEDIA
            FROM segmented GROUP BY 1""",
        ),
        "margins_period": _q(
            KPIS,
            select=f"""SELECT {_doubles(KPI_COLUMNS)},
              {', '.join(f"{_ratio(_n('LUCRO_' + k), _n('RECEITA_' + k))} AS MARGEM_{k}" for k in ('TOTAL', 'VEIC', 'PEC', 'SRV'))}
            FROM k""",
        ),
        "pnl_vs_goal": _q(
            PNL,
            select=f"""SELECT {_d('sum(LUCRO_TOTAL)')} AS LUCRO_TOTAL, 500000.0::DOUBLE AS META_LUCRO,
              {_d('sum(LUCRO_TOTAL)')} - 500000.0::DOUBLE AS DELTA_LUCRO,
              {', '.join(f"{_ratio(f'sum({k}_LUCRO)', f'sum({k}_RECEITA)')} AS {k}_MARGEM" for k in ('VEIC', 'PEC', 'SRV'))}
            FROM pnl""",
        ),
        "stock_vs_goal": _q(
            STOCK,
            select=f"""SELECT {_doubles(['ESTOQUE_VEIC_VALOR'])},
              {_d(_n('ESTOQUE_VEIC_VALOR'))} - 5000000.0::DOUBLE AS DELTA_ESTOQUE_VEIC, {_doubles(['ESTOQUE_PEC_VALOR'])},
              {_d(_n('ESTOQUE_PEC_VALOR'))} - 1000000.0::DOUBLE AS DELTA_ESTOQUE_PEC,
              {_n('ESTOQUE_VEIC_DIAS_MEDIO_ATUAL')} AS ESTOQUE_VEIC_DIAS_MEDIO_ATUAL FROM stock_k""",
        ),
        "top_roi": _q(
            ROI,
            select="SELECT * FROM roi WHERE ROI_ESTOQUE IS NOT NULL ORDER BY ROI_ESTOQUE DESC, COD_FILIAL, NOME_FILIAL LIMIT 20",
        ),
        "top_turnover": _q(
            TURNOVER,
            select="SELECT * FROM turnover WHERE GIRO_PROXY IS NOT NULL ORDER BY GIRO_PROXY DESC, CATEGORIA_PECA LIMIT 20",
        ),
        "stock_days_now_vs_history": _q(
            STOCK,
            STOCK_DAYS,
            select="""SELECT MES, 'Histórico (vendidos)' AS SERIE, DIAS_MEDIO_VENDA AS DIAS FROM stock_days
              UNION ALL SELECT MES, 'Atual (estoque)', ESTOQUE_VEIC_DIAS_MEDIO_ATUAL FROM stock_days, stock_k""",
        ),
        "top_branches_by_roi": _q(
            PERFORMANCE,
            select=f"SELECT * FROM perf WHERE ROI_ESTOQUE IS NOT NULL ORDER BY ROI_ESTOQUE DESC, {BRANCH_TIES} LIMIT 20",
        ),
        "top_branches_by_profit": _q(
            PERFORMANCE, select=f"SELECT * FROM perf ORDER BY LUCRO_TOTAL DESC, {BRANCH_TIES} LIMIT 20"
        ),
        "branch_table": _q(
            PERFORMANCE,
            select=f"SELECT NOME_FILIAL, RECEITA_TOTAL, LUCRO_TOTAL, CAPITAL_ESTOQUE, ROI_ESTOQUE FROM perf {BEST_ROI}",
        ),
        "last_12_months": _q(PNL, select=f"SELECT MES, {_doubles(PNL_AMOUNTS)} FROM pnl ORDER BY MES DESC LIMIT 12"),
        "yoy_by_month": _q(
            PNL,
            select=f"""SELECT CAST(year(MES) AS INTEGER) AS ANO, CAST(month(MES) AS INTEGER) AS MESNUM,
              {_d('sum(RECEITA_TOTAL)')} AS RECEITA_TOTAL
            FROM pnl WHERE (SELECT count(DISTINCT year(MES)) FROM pnl) >= 2 GROUP BY 1, 2""",
        ),
        "densify_daily": _q(SERIES, select=f"SELECT serie AS SERIE, dia AS DIA, {_d('y')} AS Y FROM dense"),
        "densify_daily_by_branch": _q(
            BRANCH_SERIES,
            select=f"""SELECT split_part(serie, '|', 1) AS COD_CONCESSIONARIA, split_part(serie, '|', 2) AS COD_FILIAL,
              dia AS DIA, {_d('y')} AS Y FROM dense""",
        ),
        "forecast_ma": _q(SERIES, FORECAST, select=f"SELECT serie AS SERIE, {FORECAST_OUT} FROM forecast"),
        "forecast_ma_by_branch": _q(
            BRANCH_SERIES,
            FORECAST,
            select=f"""SELECT split_part(serie, '|', 1) AS COD_CONCESSIONARIA, split_part(serie, '|', 2) AS COD_FILIAL,
              {FORECAST_OUT} FROM forecast""",
        ),
        "forecast_ma_bootstrap": _q(SERIES, BOOTSTRAP, select=f"SELECT serie AS SERIE, {FORECAST_OUT} FROM forecast"),
        "forecast_frame": _q(
            SERIES,
            FORECAST,
            select=f"""SELECT serie AS SERIE, dia AS DIA, {_d('y')} AS VALOR, 'Histórico' AS TIPO FROM dense
              UNION ALL SELECT serie, DIA, YHAT, 'Forecast' FROM forecast""",
        ),
        "forecast_intervals": _q(
            SERIES,
            FORECAST,
            select=f"SELECT serie AS SERIE, DIA, YHAT, {', '.join(_BOUNDS)} FROM forecast WHERE T > {HORIZON - 15}",
        ),
        "restock_recommendation": _q(
            RISK,
            select="""SELECT CATEGORIA_PECA, DESCRICAO_PECA, ESTOQUE_ATUAL, CONSUMO_MEDIO_DIA, DIAS_COBERTURA,
              CASE WHEN DIAS_COBERTURA <= 10 THEN 'Aumentar' WHEN DIAS_COBERTURA <= 30 THEN 'Manter' ELSE 'Reduzir' END
                AS RECOMENDACAO FROM risk""",
        ),
        "margin_uplift": _q(
            INTEGRATED,
            NEWEST,
            select="""SELECT DT_VENDA, NOME_FILIAL, NOME_COMPRADOR, MARCA_VEICULO, MODELO_VEICULO, RECEITA_VEICULO,
              MARGEM_VEICULO, RECEITA_SERVICOS, RECEITA_PECAS, RECEITA_INTEGRADA, MARGEM_INTEGRADA,
              coalesce(MARGEM_INTEGRADA, 0) - coalesce(MARGEM_VEICULO, 0) AS DELTA_MARGEM FROM newest""",
        ),
        "integrated_totals": _q(
            INTEGRATED,
            NEWEST,
            select=f"""SELECT {_d('sum(ri)')} AS RECEITA_INTEGRADA, {_d('sum(li)')} AS LUCRO_INTEGRADO,
              {_ratio('sum(li)', 'sum(ri)')} AS MARGEM_INTEGRADA FROM newest""",
        ),
        "model_label": _q(
            INTEGRATED,
            MODELS,
            select="SELECT *, MARCA_VEICULO || ' - ' || MODELO_VEICULO AS MODELO_LABEL FROM models",
        ),
        "branch_totals": _q(
            PERFORMANCE,
            select=f"""SELECT {_d("sum(CAST(LUCRO_TOTAL AS DECIMAL(28,4)))")} AS LUCRO_TOTAL,
              {_d("sum(CAST(CAPITAL_ESTOQUE AS DECIMAL(28,4)))")} AS CAPITAL_ESTOQUE,
              {_ratio("sum(CAST(LUCRO_TOTAL AS DECIMAL(28,4)))", "sum(CAST(CAPITAL_ESTOQUE AS DECIMAL(28,4)))")} AS ROI_ESTOQUE
            FROM perf""",
        ),
        "branch_benchmark": _q(PERFORMANCE, select=_benchmark(False)),
        "branch_benchmark_formatted": _q(PERFORMANCE, select=_benchmark(True)),
        "daily_deltas": _q(
            DAILY,
            select=f"""SELECT 'VEICULO' AS ORIGEM, {_d(_n('q0'))} - {_d(_n('q1'))} AS DELTA_QTD,
                {_d(_n('r0'))} - {_d(_n('r1'))} AS DELTA_RECEITA FROM v_t
              UNION ALL SELECT 'PECA', {_d(_n('q0'))} - {_n('qm')}, {_d(_n('r0'))} - {_n('rm')} FROM p_t
              UNION ALL SELECT 'SERVICO', {_d(_n('q0'))} - {_n('qm')}, {_d(_n('r0'))} - {_n('rm')} FROM s_t""",
        ),
        "format_report": _q(
            f"""v AS (SELECT NOME_VENDEDOR AS vendedor, sum(QTDE_VENDIDA) AS q, sum(VALOR_VENDA) AS r, sum(LUCRO_VENDA) AS l
              FROM veic WHERE DT_VENDA {PERIOD} GROUP BY 1)""",
            select=f"""SELECT vendedor AS VENDEDOR, CAST(CAST(q AS BIGINT) AS VARCHAR) AS QTD, 'R$ ' || {_text('r')} AS RECEITA,
              'R$ ' || {_text('l')} AS LUCRO,
              coalesce({_text('(' + _ratio('l', 'r') + ') * 100')} || '%', '-') AS MARGEM FROM v""",
        ),
        "safe_sql_own_limit": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 1000",
        "safe_sql": """SELECT n_name AS NOME_FILIAL, count(*) AS FORNECEDORES
            FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""",
    }
