"""Input readers, the fixture adapter, the calendar and output writers."""

from .calendar import SpineBounds, day_calendar, month_spine
from .catalog import TableStore
from .fixtures import fixture_config, fixture_inputs
from .sinks import expire_runs, write_noop, write_table
from .tables import InputError, Inputs, read_catalog, read_inputs

__all__ = [
    "SpineBounds",
    "day_calendar",
    "month_spine",
    "TableStore",
    "fixture_config",
    "fixture_inputs",
    "expire_runs",
    "write_noop",
    "write_table",
    "InputError",
    "Inputs",
    "read_catalog",
    "read_inputs",
]
