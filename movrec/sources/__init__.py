from movrec.sources.fixtures import movimientos, solicitudes, ventanas
from movrec.sources.tables import TABLES, read_table

__all__ = ["TABLES", "movimientos", "read_table", "solicitudes", "ventanas"]
