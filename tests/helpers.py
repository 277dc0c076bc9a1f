import math


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def rows_of(df):
    return [tuple(norm(x) for x in r) for r in df.collect()]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT"}


def same_types(spark_df, con, sql):
    duck = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = [(c, t, duck.get(c)) for c, t in spark_df.dtypes if SPARK_TO_DUCK.get(t, t) != duck.get(c)]
    assert not bad, bad


def same_rows(spark_df, con, sql):
    same_types(spark_df, con, sql)
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = [tuple(norm(x) for x in r) for r in rel.fetchall()]
    scols = spark_df.columns
    assert sorted(scols) == sorted(dcols), (scols, dcols)
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    srows = rows_of(spark_df)
    key = lambda r: tuple((x is None, str(type(x)), str(x)) for x in r)
    assert len(srows) == len(drows)
    a, b = sorted(srows, key=key), sorted(drows, key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    assert not bad, bad[:3]
