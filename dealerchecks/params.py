"""Parameters of the registered queries. The period covers the whole of the given tables."""

from datetime import date

DT_INI = date(1995, 1, 1)
DT_FIM = date(2001, 12, 31)
AS_OF = date(1998, 6, 24)
WINDOW_DAYS = 30
HORIZON = 30
MA_WINDOW = 7
N_SIM = 1000
SEED = 42
DEALER = "1"
BRANCH_A = "NATION_1"
BRANCH_B = "NATION_2"
PROFIT_GOAL = 500_000
VEHICLE_STOCK_GOAL = 5_000_000
PART_STOCK_GOAL = 1_000_000
