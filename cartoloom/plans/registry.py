"""Query registry: a Spark function and, where SQL can say it, the matching SQL."""

import re

from .views import SQL_VIEWS, Views

QUERIES = {}
ORACLES = {}


def _needed(text, seen):
    for name in SQL_VIEWS:
        if name not in seen and re.search(rf"\b(from|join|,)\s*{name}\b", text):
            _needed(SQL_VIEWS[name], seen)
            seen.append(name)


def with_views(body: str) -> str:
    """Put the derived views that a query names in front of it."""
    seen = []
    _needed(body, seen)
    ctes = [f"{n} AS ({SQL_VIEWS[n].strip()})" for n in seen]
    body = body.strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive"):
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[len("with recursive"):]
    if body.lower().startswith("with "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[len("with "):]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def query(name, sql=None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
