"""relload: bulk loading of CSV dumps of related tables with referential repair, on Spark."""

import sys as _sys

try:  # ship our pandas functions by value, so executors need not have the package installed
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from .plans.jobs import LoadResult, load  # noqa: E402
from .plans.load_all import Loaded, load_all  # noqa: E402
from .sources.assemble import Dump, read_dump  # noqa: E402
from .specs import CITED, CLUSTER, JOINED_BY, OPINION, PANEL, PARENTHETICAL, SEARCH_CITATION, SPECS  # noqa: E402

__all__ = [
    "CITED", "CLUSTER", "JOINED_BY", "OPINION", "PANEL", "PARENTHETICAL", "SEARCH_CITATION", "SPECS",
    "Dump", "LoadResult", "Loaded", "load", "load_all", "read_dump",
]
