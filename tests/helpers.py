"""Helpers of the tests; a module of its own, since every folder may have a ``conftest``."""


def rows(df, *columns):
    """Rows as sorted tuples, floats rounded."""
    chosen = df.select(*columns) if columns else df
    plain = [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in chosen.collect()]
    return sorted(plain, key=repr)
