"""Column standardisers (D1: every per-element apply of the original is a native Column
expression here, so no Python UDF runs in the ETL; D2: extractors are plain
``Callable[[Column], Column]`` values that can be passed around)."""
