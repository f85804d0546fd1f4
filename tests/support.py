"""What several test modules use. Not in ``conftest.py``: each folder's is imported under that one name."""


def values(df):
    """Rows as a sorted list of tuples, columns in their order."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
