"""Named queries over the supplied tables, each with its SQL twin."""

from tallyforge.plans import files, frames, ratings, sales, streams, text

GROUPS = (text, ratings, sales, frames, streams, files)

QUERIES = {name: query for group in GROUPS for name, query in group.QUERIES.items()}
SQL = {name: sql for group in GROUPS for name, sql in group.SQL.items()}
