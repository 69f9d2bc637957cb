"""All registered queries (importing the modules fills the registry)."""

from riskframe.plans import queries as _q
from riskframe.plans import queries_eval as _e  # noqa: F401
from riskframe.plans import queries_model as _m  # noqa: F401
from riskframe.plans import queries_jobs as _j  # noqa: F401
from riskframe.plans import queries_more as _o  # noqa: F401

QUERIES = _q.QUERIES
ORACLE = _q.ORACLE
