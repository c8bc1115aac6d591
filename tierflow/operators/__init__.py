"""DataFrame -> DataFrame operators."""

from tierflow.operators.dedup import latest_per_key  # noqa: F401
from tierflow.operators.upsert import upsert, checked_keys, check_unique_keys  # noqa: F401
from tierflow.operators.changes import apply_changes, dense_index  # noqa: F401
from tierflow.operators.items import low_stock, validity, lookup  # noqa: F401
