"""Registered queries: every named result table and operator, bound to the test tables.

``QUERIES[name].run(spark, sf_dir)`` returns the result DataFrame in canonical form
(see ``canonical``); ``QUERIES[name].oracle()`` is the DuckDB statement computing the
same rows over the same parquet files.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.plans import access, enriched, query_cost, rates, spend
from ledgerlight.plans.canonical import canonical, sql_canonical
from ledgerlight.session import ensure_conf, materialize, save_bucketed
from ledgerlight.operators.fill import repeated_keys
from ledgerlight.sources.staging import Staged, first_query
from ledgerlight.sources.testbed import ACCOUNT, Testbed


@dataclass
class Query:
    name: str
    build: Callable[["Context"], DataFrame]
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)
    description: str = ""

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_conf(spark)
        return canonical(self.build(Context.shared(spark, sf_dir)))

    def oracle(self) -> str | None:
        return None if self.sql is None else sql_canonical(self.sql, self.doubles)


class _StagedTables(Staged):
    """Staging models; the deduplicated query log is materialized once (an
    incremental table in the reference)."""

    def __init__(self, sources, ctx: "Context"):
        super().__init__(sources)
        self._ctx = ctx

    def query_history(self) -> DataFrame:
        return self._ctx.memo("stg_query_history", lambda: materialize(self.log_plan(), "stg_query_history"))

    def log_plan(self) -> DataFrame:
        """The first rows of the log by a list of the ids that repeat: the log is wide, and only rows of
        such ids are shuffled and sorted."""
        return first_query(self.query_log(), repeated_keys(self.query_log(), ["query_id"]))


class Context:
    """Bindings for one data directory: test tables, staging models, the run date and
    the upstream result tables. Like a DAG run of the reference, every upstream model
    that the reference materializes (``table``/``incremental``) is computed once per
    Spark application and data directory, written to the checkpoint folder and read by
    the models downstream of it."""

    _shared: dict[tuple[str, str, str], "Context"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, account: str = ACCOUNT):
        self.spark, self.sf_dir, self.account = spark, sf_dir, account
        self.tb = Testbed(spark, sf_dir, account)
        self.st = _StagedTables(self.tb.sources_lazy(), self)
        self._memo: dict[str, DataFrame] = {}
        self._asked: set[str] = set()

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str, account: str = ACCOUNT) -> "Context":
        try:
            app = spark.sparkContext.applicationId
        except Exception:  # sessions without a local SparkContext handle
            app = str(id(spark))
        key = (app, sf_dir, account)
        if key not in cls._shared:
            cls._shared[key] = cls(spark, sf_dir, account)
        return cls._shared[key]

    @property
    def as_of(self) -> Column:
        """The run date: two days after the last event (stands in for current_date)."""
        return F.date_add(self.tb.ev().agg(F.max("day")).scalar(), 2)

    def memo(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def table(self, name: str) -> DataFrame:
        return self.tb.table(name)

    def _table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return self.memo(name, lambda: materialize(build(), name))

    def _table_if_shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A large table that most applications read once, for one result: its first reader gets the
        plan, which moves only the columns and rows that the result needs; a second one has it written."""
        if name not in self._asked and name not in self._memo:
            self._asked.add(name)
            return build()
        return self._table(name, build)

    def daily_rates(self) -> DataFrame:
        return self._table("daily_rates", lambda: rates.daily_rates(self.st, self.account, self.as_of))

    def cost_per_query(self) -> DataFrame:
        return self._table("cost_per_query", self.cost_plan)

    def cost_plan(self) -> DataFrame:
        return query_cost.cost_per_query(self.st, self.daily_rates())

    def hourly_spend(self) -> DataFrame:
        return self._table("hourly_spend",
                           lambda: spend.hourly_spend(self.st, self.daily_rates(), self.account))

    def query_history_enriched(self) -> DataFrame:
        return self._table_if_shared("query_history_enriched", lambda: enriched.query_history_enriched(
            self.st.query_history(), self.cost_per_query()))

    def bucketed(self, name: str, plan: Callable[[], DataFrame], key: str) -> DataFrame:
        """An upstream table bucketed by ``key``; it stands for the table itself if that is not written yet."""
        df = save_bucketed(self._memo[name] if name in self._memo else plan(), name, key)
        self._memo.setdefault(name, df)
        return df

    def access_history(self) -> DataFrame:
        return self._table_if_shared("stg_access_history", self.st.access_history)

    def access_history_table(self) -> DataFrame:
        """The access log for one that reads it several times."""
        return self._table("stg_access_history", self.st.access_history)

    def object_access(self, kind: str) -> DataFrame:
        build = access.query_base_object_access if kind == "base" else access.query_direct_object_access
        return self._table_if_shared(f"query_{kind}_object_access", lambda: build(self.access_history()))


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None, doubles: list[str] | None = None, description: str = ""):
    def deco(fn: Callable[[Context], DataFrame]):
        QUERIES[name] = Query(name, fn, sql, doubles or [], description or (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    # importing the modules fills QUERIES
    from ledgerlight.plans import model_queries, operator_queries  # noqa: F401
    return QUERIES
