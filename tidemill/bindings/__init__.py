"""All named queries; importing this package fills QUERIES and ORACLES."""

from tidemill.bindings.registry import ORACLES, QUERIES, Tables  # noqa: F401
from tidemill.bindings import changes, checks, filesio, functions, jobs, loads, relational, streams, windows  # noqa: F401
