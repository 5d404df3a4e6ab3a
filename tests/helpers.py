import datetime as dt


def day(text):
    return dt.date.fromisoformat(text)


def frame(spark, schema, rows):
    """Rows with ISO dates as text; columns typed by `schema`."""
    fields = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} {'string' if t == 'date' else t}" for n, t in fields))
    return raw.selectExpr(*[f"cast({n} as {t}) as {n}" for n, t in fields])


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def one(df):
    collected = df.collect()
    assert len(collected) == 1
    return collected[0]
