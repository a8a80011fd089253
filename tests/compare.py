"""Tables as sorted lists of comparable tuples."""

import datetime
import decimal


def cell(x):
    if x is None or x != x:
        return "NULL"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)):
        return f"{float(x):.10g}"
    if isinstance(x, (datetime.datetime, datetime.date)):
        return x.isoformat()[:19]
    return str(x)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(cell(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    got = con.execute(sql)
    columns = [d[0] for d in got.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(columns), sorted(tuple(cell(r[k]) for k in order) for r in got.fetchall())
