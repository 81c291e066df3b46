from ledgerlight.sources.catalog import SourceConfig, read_source, read_sources, table_exists
from ledgerlight.sources.staging import Staged
from ledgerlight.sources.testbed import Testbed

__all__ = ["SourceConfig", "read_source", "read_sources", "table_exists", "Staged", "Testbed"]
