"""All registered queries and the SQL each one is compared with."""

from millrace.registry import federation, hospital, stream, tables, university

_MODULES = [university, hospital, stream, tables, federation]

QUERIES = {name: body for module in _MODULES for name, body in module.QUERIES.items()}
ORACLES = {name: text for module in _MODULES for name, text in module.ORACLES.items()}
