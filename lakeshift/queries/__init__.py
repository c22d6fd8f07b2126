from lakeshift.queries.registry import ORACLE_SQL, QUERIES  # noqa: F401
