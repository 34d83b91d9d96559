"""Sources (readers, derived fixture tables) and sinks."""

from .fixtures import deliveries, deliveries_raw, restaurants, riders, table  # noqa: F401
from .readers import (  # noqa: F401
    date_range_filter,
    load_csv_orders,
    load_dimension,
    load_orders,
    load_training_data,
    load_validated,
    sort_by_time,
    validate_schema,
)
