import pytest
from pyspark.sql import functions as F

from adlake.plans import oracles, registry
from adlake.plans.lattice import Lattice, cross_filtered
from adlake.plans.semantic import CHARTS, DASHBOARDS, DATASETS, REPORTS, Chart

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def offline(spark):
    return registry.offline(spark, SF)


def stored(tmp_path):
    def store(df):
        path = str(tmp_path / f"r{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return store


def rows(df):
    return sorted(tuple(round(float(v), 5) if isinstance(v, float) or hasattr(v, "quantize") else str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("name", DASHBOARDS)
def test_roll_ups_answer_as_the_rows_do(spark, offline, tmp_path, name):
    charts, key_sets = DASHBOARDS[name]
    dataset = CHARTS[charts[0]].dataset
    df = offline.dataset(dataset)
    lattice = Lattice(dataset, df, key_sets, stored(tmp_path))
    sizes = [r.rows for r in lattice.roll_ups]
    assert sizes == sorted(sizes, reverse=True) or len(set(map(len, key_sets))) < len(key_sets)
    for chart in charts:
        answer = lattice.answer(CHARTS[chart])
        files = answer.inputFiles()
        assert files and all("/r" in f and "events" not in f for f in files), chart  # the events are not read again
        assert rows(answer) == rows(CHARTS[chart].run(df)), chart
        assert lattice.smallest(CHARTS[chart].needs).rows == min(r.rows for r in lattice.roll_ups if CHARTS[chart].needs <= r.keys)


def test_what_no_roll_up_holds_goes_back_to_the_rows(offline, tmp_path):
    df = offline.dataset("creative")
    lattice = Lattice("creative", df, [("day", "industry"), ("industry",)], stored(tmp_path))
    assert lattice.smallest({"advertiser_name"}) is None and lattice.smallest({"industry"}).keys == {"industry"}
    for chart in (REPORTS["report_active_creatives"], CHARTS["creative_top_advertisers"], Chart("creative", ("total_gmv", "ctr"), ("industry",), time_range="2024-01-05 : 2024-01-09"), Chart("creative", ("count",), filters={"industry": ("nothing",)})):
        assert rows(lattice.answer(chart)) == rows(chart.run(df))


def test_a_distinct_count_needs_its_column(offline, tmp_path):
    df = offline.dataset("creative")
    lattice = Lattice("creative", df, [("industry", "creative_id"), ("industry",)], stored(tmp_path))
    chart = Chart("creative", ("active_creatives", "row_count"), ("industry",))
    assert lattice.smallest(chart.needs).keys == {"industry", "creative_id"} and rows(lattice.answer(chart)) == rows(chart.run(df))


def test_selections_hold_in_the_other_charts():
    charts = {"a": Chart("attribution", ("count",), ("x",)), "b": Chart("attribution", ("count",), ("y",), filters={"x": (1, 2)}), "c": Chart("attribution", ("count",))}
    got = cross_filtered(charts, {"a": {"x": (2, 3)}, "b": {"y": (7,)}})
    assert got["a"].filters == {"y": (7,)} and got["b"].filters == {"x": (2,)} and got["c"].filters == {"x": (2, 3), "y": (7,)}
    assert charts["c"].filters == {}


def test_every_metric_is_stated_twice():
    assert {d: set(m) for d, m in oracles.METRICS.items()} == {d: {*s.metrics, *s.distinct} for d, s in DATASETS.items()}
    assert sum(len(m) for m in oracles.METRICS.values()) == 70
    assert {d: s.time for d, s in DATASETS.items()} == oracles._TIMES
