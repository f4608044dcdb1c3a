"""Small helpers that tests import."""


def plan_of(df, run=True):
    """Physical plan as text, the final adaptive one if the query is run."""
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
