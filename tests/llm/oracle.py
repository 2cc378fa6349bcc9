"""Comparison of a query with its SQL on DuckDB."""

import os

import duckdb


def same_as_sql(df, sql, sf_dir):
    duck = duckdb.connect()
    for file in os.listdir(sf_dir):
        duck.execute(f"create view {file.removesuffix('.parquet')} as from '{sf_dir}/{file}'")
    want = duck.execute(sql)
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple((v is not None, v) for v in r)
    got = sorted((tuple(r) for r in df.select(names).collect()), key=key)
    assert got == sorted((tuple(r) for r in want.fetchall()), key=key)


def mirrored(letters="ab", bits=10):
    """A word whose letters follow the parity of the bits of their place, and its opposite.

    Polynomial hashes modulo a power of two do not tell them apart.
    """
    odd = [bin(i).count("1") % 2 for i in range(1 << bits)]
    return "".join(letters[x] for x in odd), "".join(letters[1 - x] for x in odd)
