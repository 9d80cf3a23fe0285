"""Sources: Parquet, JDBC and literal rows, plus the EAV intake and the test fixtures."""

from sectora.sources.eav import Eav, load_eav, read_eav_parquet
from sectora.sources.files import read_parquet
from sectora.sources.inline import inline
from sectora.sources.jdbc import read_jdbc

__all__ = ["Eav", "load_eav", "read_eav_parquet", "read_parquet", "inline", "read_jdbc"]
