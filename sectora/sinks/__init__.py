"""Sinks: table writes (overwrite / append / skip-empty) and partitioned section exports."""
