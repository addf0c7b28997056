"""All registered queries outside the optional subpackage, and their SQL."""

from airshed.plans import catalog, load_catalog

QUERIES = {**catalog.QUERIES, **load_catalog.QUERIES}
ORACLE_SQL = {**catalog.ORACLE_SQL, **load_catalog.ORACLE_SQL}
