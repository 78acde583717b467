from billscope.sinks.ledger import append_event, open_ledger
from billscope.sinks.tables import append, create_if_missing, publish, read_published, replace, write_load

__all__ = ["append", "append_event", "create_if_missing", "open_ledger", "publish", "read_published", "replace", "write_load"]
