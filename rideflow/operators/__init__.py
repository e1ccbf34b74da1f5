"""DataFrame operators: every one is ``fn(df, ...) -> DataFrame``."""
