"""Row multisets of a DataFrame and of a DuckDB statement, with columns in name order."""

from collections import Counter


def spark_rows(df) -> tuple[list[str], Counter]:
    columns = sorted(df.columns)
    return columns, Counter(tuple(r) for r in df.select(*columns).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in rel.fetchall())


def difference(got: Counter, want: Counter, limit: int = 3) -> str:
    return f"only in result: {list((got - want).items())[:limit]}\nonly in oracle: {list((want - got).items())[:limit]}"
