"""All registered queries of the library and their SQL."""

from tidewell.registered import load, planning, prices, quality, storage, streams  # noqa: F401
from tidewell.registered.registry import ORACLE_SQL, QUERIES  # noqa: F401
