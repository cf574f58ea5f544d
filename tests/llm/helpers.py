import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def rows(df):
    return sorted(map(repr, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


def duck_rows(sf, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    places = [names.index(c) for c in sorted(names)]
    return sorted(repr(tuple(r[i] for i in places)) for r in found.fetchall())
