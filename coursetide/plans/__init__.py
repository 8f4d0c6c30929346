from .daily import backfill, run_day
from .day_tables import read_day_tables, refresh_day_tables, refresher
from .exports import export_kpis

__all__ = ["backfill", "export_kpis", "read_day_tables", "refresh_day_tables", "refresher", "run_day"]
