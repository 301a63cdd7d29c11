"""One query per operator, with the SQL another engine answers it by."""

from mailspark.queries import (  # noqa: F401
    functions,
    learning,
    relational,
    sinks,
    sources,
    streams,
)
from mailspark.queries.base import ORACLES, QUERIES  # noqa: F401
