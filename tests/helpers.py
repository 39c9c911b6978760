"""Small helpers for the tests."""


def rows(df):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=repr)


def ordered(df):
    return [tuple(row) for row in df.collect()]


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


def final_plan(df):
    """The physical plan after the run, with what the adaptive planner changed."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
