import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.__main__ import main
from ledgerlight.plans.canonical import canonical
from ledgerlight.plans.registry import Context
from ledgerlight.streaming.incremental import read_target
from tests.conftest import SF_SMALL


def test_build_from_source_files(spark, tmp_path):
    ctx = Context(spark, SF_SMALL)
    src = tmp_path / "sources"
    for name, df in ctx.tb.sources().items():
        df.write.parquet(str(src / name))
    as_of = ctx.tb.ev().agg(F.max("day")).first()[0] + dt.timedelta(days=2)
    args = ["build", "--sources", str(src), "--target", str(tmp_path / "out"), "--account", ctx.account,
            "--as-of", as_of.isoformat()]
    first = main(args)
    assert first["cost_per_query"] is None
    again = main(args)                                   # incremental run over the same data
    assert again["cost_per_query"] is not None
    built = read_target(spark, str(tmp_path / "out" / "cost_per_query")).drop("_date")
    assert sorted(map(tuple, canonical(built).collect())) == sorted(map(tuple, canonical(ctx.cost_per_query()).collect()))
