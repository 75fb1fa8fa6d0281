"""DataFrame -> DataFrame operators (keys, SCD, incremental, shape, union, windows, history)."""
