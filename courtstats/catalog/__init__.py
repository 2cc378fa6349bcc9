"""Every query by name, with the SQL that must give the same rows."""

from courtstats.catalog import columns, files, joins, pages, season, windows  # noqa: F401
from courtstats.catalog.registry import ORACLES, QUERIES  # noqa: F401
