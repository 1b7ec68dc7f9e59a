"""The driver tables in the library's roles, with the registered queries."""

from workload import analytics, documents, maintenance, models, quality, sql

GROUPS = (models, analytics, quality, documents, maintenance)

# name -> (query, check SQL or None); statements get the expressions they mention.
ENTRIES = {
    name: (run, sql.query(statement) if statement else None)
    for group in GROUPS
    for name, (run, statement) in group.ENTRIES.items()
}
