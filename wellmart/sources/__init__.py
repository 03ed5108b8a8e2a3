from wellmart.sources.sinks import cut_lineage, overwrite  # noqa: F401
from wellmart.sources.tables import SCHEMAS, Catalog, read_table, schema  # noqa: F401
