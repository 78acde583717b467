from billscope.sources.encounters import billing_columns, read_encounters, stream_encounters, unreadable_rows
from billscope.sources.feeds import ledger_from_events, order_encounters
from billscope.sources.tables import read_admissions, read_quarantine, read_table

__all__ = [
    "billing_columns",
    "ledger_from_events",
    "order_encounters",
    "read_admissions",
    "read_encounters",
    "read_quarantine",
    "read_table",
    "stream_encounters",
    "unreadable_rows",
]
