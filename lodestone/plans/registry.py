"""Where queries and their oracle SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of a table reader under a name, with the SQL that gives the same rows."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet"))

        run.__doc__ = f.__doc__
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return f

    return put


# pieces of SQL that state the scalars
def clean(c: str) -> str:
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&#x27;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        c = f"replace({c}, '{a}', '{b}')"
    return space(c)


def space(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '\\s+', ' ', 'g'))"


def title(c: str) -> str:
    wide = f"' ' || regexp_replace(lower({clean(c)}), '[^\\p{{L}}\\p{{N}}_]', '  ', 'g') || ' '"
    return f"trim(regexp_replace(regexp_replace({wide}, ' (the|a|an) ', ' ', 'g'), ' +', ' ', 'g'))"


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, '{pattern}'))"


def words(c: str) -> str:
    """The text with every separator doubled, so that bounded terms can be counted by the blanks around them."""
    return f"('  ' || regexp_replace(lower({space(c)}), '[^a-z0-9]', '  ', 'g') || '  ')"


def term(c: str, t: str) -> str:
    return f"contains({words(c)}, ' {t} ')"


def times(c: str, t: str) -> str:
    return f"((length({words(c)}) - length(replace({words(c)}, ' {t} ', ''))) / {len(t) + 2})::BIGINT"
