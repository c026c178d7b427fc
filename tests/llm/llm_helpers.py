"""Shared by these tests; a module of its own, so that no test imports a conftest."""


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
