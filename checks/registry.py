"""Pairs of a Spark query and its SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.entities import ENTITIES
from martkit.session import prepare, scratch_path
from martkit.sources.staging import StagedTables

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables as attributes, and relations derived from them by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._views: set[str] = set()
        self._staged: StagedTables | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, df)  # one footer read per query and table
        return df

    def derived(self, name: str) -> DataFrame:
        """A source-shaped relation computed from the given tables."""
        text = with_entities(f"select * from {name}")
        for table in set(re.findall(r"[a-z]+", text)) & set(TABLES) - self._views:
            getattr(self, table).createOrReplaceTempView(table)
            self._views.add(table)
        return self.spark.sql(wall_clock(text, "to_timestamp_ntz('{}')"))

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write once to the shared scratch folder; the result is lazy, so its tables outlive the call."""
        if self._staged is None:
            self._staged = StagedTables(self.spark, self.scratch("stage"))
        return self._staged(df, name)

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)


def wall_clock(sql: str, form: str) -> str:
    """Write ``wallclock('...')`` as the dialect's literal for a timestamp without zone."""
    return re.sub(r"wallclock\('([^']*)'\)", lambda m: form.format(m.group(1)), sql)


def with_entities(sql: str) -> str:
    """Prefix the definitions of the derived relations the text mentions."""
    used: list[str] = []

    def visit(text: str) -> None:
        for word in re.findall(r"[a-z_0-9]+", text):
            if word in ENTITIES and word not in used:
                visit(ENTITIES[word])
                if word not in used:
                    used.append(word)

    visit(sql)
    heads = [f"{n} as ({ENTITIES[n].strip()})" for n in used]
    body = sql.strip()
    if not heads:
        return body
    if body.lower().startswith("with "):
        return "with " + ",\n".join(heads) + ",\n" + body[5:]
    return "with " + ",\n".join(heads) + "\n" + body


def check(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under a name with the SQL it must agree with."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = wall_clock(with_entities(sql), "timestamp '{}'")
        return fn

    return wrap
