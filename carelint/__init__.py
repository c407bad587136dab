"""carelint: data-quality checks for clinical tables, expressed as Spark DataFrame jobs.

Every check is a function ``(Context) -> DataFrame`` of long result rows.  Checks only
build lazy plans; nothing is collected until the caller writes or shows the result.
"""

from carelint.context import Context
from carelint.sources.tables import TableSource

__all__ = ["Context", "TableSource"]
