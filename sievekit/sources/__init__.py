from sievekit.sources.tables import (  # noqa: F401
    attach_label, load_table, read_split, table, write_confusion, write_split,
)
from sievekit.sources.artifacts import (  # noqa: F401
    fresh_inputs, load_model, read_runs, save_model, write_metrics,
)
